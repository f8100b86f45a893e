"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import ASCII
from fraudlens.llm.resample import WORD, WordSplit, bucket_gains, feature_spans, importance_resample


def features(text, longest, buckets):
    w = re.findall(WORD, (text or "").translate(ASCII))
    runs = [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    return len(w), [zlib.crc32(r.encode()) % buckets for r in runs]


def plain(docs, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    """``[(id, features, weight, score, rank)]``"""
    made = [(d, *features(t, longest, buckets)) for d, t in docs]
    s, t = Counter(b for _, _, f in made for b in f), Counter(b for x in target for b in features(x, longest, buckets)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in s}
    rows = []
    for d, n, f in made:
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least))
    enough = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, -r[2], -r[1]))
    drawn = Counter(r[:4] for r in rows if not r[4])
    out = [(*r, None) for r in drawn.elements()]
    k = percent * len(enough) // 100
    return out + [(*r[:4], i + 1 if i < k else None) for i, r in enumerate(enough)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = "the of Ünder tâche OTHER x1 éa ÉA straße 한국 data set".split() + [f"w{i}" for i in range(200)]
    out = [(i, " ".join(rng.choice(words) + rng.choice(["", ",", "\x00", "_"]) for _ in range(rng.randint(0, 90)))) for i in range(400)]
    same = "the data set of w1 and w2 " * 6
    out += [(400, None), (401, ""), (402, "... !"), (403, "the " * 200_000), (7, same), (7, same), (None, same), (None, "w5 " * 30), (None, None)]
    return out + [(1000 + i, same) for i in range(40)]


TARGET = ["the data set of Things", None, "", "data DATA w1 w2 w3", "éa ÉA 한국"]


def rows(df):
    return sorted((str(tuple(r)) for r in df.collect()))


@pytest.mark.parametrize("given", [{}, {"longest": 3, "buckets": 70_000, "percent": 33}, {"longest": 2, "buckets": 7, "least_words": 0, "percent": 100, "seed": 5}])
def test_against_plain(spark, texts, given):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in texts], "doc_id long, text string, id string, rank int").repartition(5)
    target = spark.createDataFrame([(t, 1) for t in TARGET], "text string, id int")
    found = importance_resample(docs, target, **given)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in found.dtypes} == {"bigint"}
    named = {"least": given["least_words"]} if "least_words" in given else {}
    want = plain(texts, TARGET, **{k: v for k, v in given.items() if k != "least_words"}, **named)
    assert rows(found) == sorted(str(r) for r in want)


def test_empty_tables(spark, texts):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert importance_resample(none, none).collect() == []
    docs = spark.createDataFrame(texts[:60], "doc_id long, text string")
    assert rows(importance_resample(docs, none)) == sorted(str(r) for r in plain(texts[:60], []))
    with pytest.raises(ValueError):
        importance_resample(docs, none, buckets=0)


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x y z"), ("a", "x y z")], "name string, body string")
    found = importance_resample(docs, docs, least_words=1, percent=50, id_col="name", text_col="body", target_text="body")
    assert found.filter("rank = 1").count() == 1 and found.filter(F.col("rank").isNull()).count() == 1


def test_spans():
    """Places are those of the runs in the text, and equal runs have equal buckets wherever they stand."""
    text = "Ab  äÖ, ab äÖ\nx"
    words = WordSplit()(text)
    assert [w for w, _ in words] == ["ab", "äÖ", "ab", "äÖ", "x"]
    spans, found = feature_spans(words, 3, 10_000)
    assert [text[a:b] for a, b in spans.tolist()] == ["Ab", "äÖ", "ab", "äÖ", "x", "Ab  äÖ", "äÖ, ab", "ab äÖ", "äÖ\nx", "Ab  äÖ, ab", "äÖ, ab äÖ", "ab äÖ\nx"]
    assert found.tolist() == features(text, 3, 10_000)[1]
    assert [len(x) for x in feature_spans([], 3, 10)] == [0, 0]


def test_gains():
    gains = bucket_gains(np.array([0, 9, 0]), np.array([0, 0, 3]))
    assert gains.tolist() == [math.floor(1000 * math.log(12 / 6)), math.floor(1000 * math.log(12 / 60)), math.floor(1000 * math.log(4 * 12 / 6))]

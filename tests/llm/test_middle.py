"""Boundary sets, and rearranged texts against a plain version and an exact round trip."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fraudlens.llm.middle import ARRAY_MOST, ArrayContainer, BitmapContainer, Boundaries, RunContainer, fill_in_middle, line_ends, restored


def plain(key, text, rate=100, spm=50, seed=7):
    """``(n, form, prefix length, middle length, output)`` by slicing the list of lines."""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(lines)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return n, "plain", None, None, text or ""
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("make, kind", [
    (lambda rng: rng.choice(1 << 16, 500, replace=False), ArrayContainer),
    (lambda rng: rng.choice(1 << 16, 3 * ARRAY_MOST, replace=False), BitmapContainer),
    (lambda rng: np.concatenate([np.arange(s, s + 900) for s in range(100, 60_000, 1000)]), RunContainer),
])
def test_containers(make, kind):
    places = np.sort(make(np.random.default_rng(3))).astype(np.int64)
    shifted = np.concatenate([places, places + (5 << 16), [(1 << 40) + 3]])  # spans without places between them
    found = Boundaries(shifted)
    assert [type(c) for c in found.containers] == [kind, kind, ArrayContainer]
    assert len(found) == len(shifted) and [found.select(k) for k in range(len(shifted))] == shifted.tolist()


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 200_000), max_size=300), st.integers(0, 70_000), st.integers(0, 9_000))
def test_select(places, first, length):
    places = np.array(sorted(places | set(range(first, first + length))), np.int64)
    found = Boundaries(places)
    assert len(found) == len(places)
    assert all(found.select(k) == places[k] for k in range(0, len(places), 7))
    assert found.cut(0) == 0 and all(found.cut(k) == places[k - 1] for k in (1, len(places)) if 0 < k <= len(places))


def test_line_ends():
    for text in ("", "\n", "a", "a\n", "\n\nä\nb", "ä\r\n\x0b x"):
        assert line_ends(text.encode()).tolist() == np.cumsum([len(u.encode()) for u in re.findall(r"[^\n]*\n|[^\n]+", text)], dtype=int).tolist()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    parts = ["ä", "x y", "<", "<P", "S>", "", "🙂", "\r", "<M"]
    out = [None, "", "\n", "no line feed", "a <M> in it\nb", "<P>", "\n" * 200_000, "\n" * 5000 + "x\n" * 80_000 + "longer line of text\n" * 9000]
    out += ["\n".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(120)]
    return [*enumerate(out), (3, "an id\nthat\nrepeats"), (None, "one\ntwo\nthree"), (None, "four\nfive"), (2**60 + 1, "a\nb")]


@pytest.mark.parametrize("rate, spm", [(100, 50), (40, 0), (0, 100)])
def test_against_plain(spark, texts, rate, spm):
    rows = [(d, t, "x", 3) for d, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int").repartition(3)
    found = fill_in_middle(docs, rate=rate, spm=spm).withColumn("again", restored(F.col("output"), F.col("form")))
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "again"]
    got = sorted(map(str, (tuple(r) for r in found.collect())))
    assert got == sorted(str((d, *plain(d, t, rate, spm), t or "")) for d, t in texts)


def test_other_tables(spark):
    assert fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    named = spark.createDataFrame([("ab", "x y z")], "name string, body string")

    def word_ends(text):
        return np.array([m.end() for m in re.finditer(rb"\S+\s*", text)], np.int64)

    row = fill_in_middle(named, ends=word_ends, id_col="name", text_col="body").first()
    assert row["name"] == "ab" and row["n"] == 3 and sorted(re.split("<[PSM]>", row["output"])) != [] and len(row["output"]) == 5 + 9

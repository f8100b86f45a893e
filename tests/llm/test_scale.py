"""What grows with more input: lines that meet by chance, shuffle files, rows of a bucket."""

import glob
import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import brute
from fraudlens.llm import lines as line_module, suffix
from fraudlens.llm.packed import Texts
from fraudlens.session import FILE_CLEANUP, settle


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(n))


def test_lines_that_share_a_key_by_chance():
    """Of lines under one band key only those go on that may be similar; short lines and large groups go on whole."""
    rng = random.Random(7)
    far = [sentence(rng, 40).encode() for _ in range(60)]
    pairs = [(text, text.replace(text[60:64], "zzzz", 1)) for text in (sentence(rng, 50) for _ in range(60))]
    near = [t.encode() for pair in pairs for t in pair]
    short = [b"one short line", b"another of them"]

    def found(lines, tile=256):
        _, marks = line_module.signatures(lines)
        ids, keys = np.arange(len(lines)) + 10, np.full(len(lines), 7, np.uint64)
        packets = line_module._packets(keys, ids, np.zeros(len(lines), np.int64), marks, np.zeros(len(lines), bool))
        table = line_module.candidates(pa.Table.from_batches([packets]), tile).to_pydict()
        return sorted(i - 10 for i in table["id"]), set(table["least"]), set(table["large"])

    ids, least, large = found(far + near)
    assert set(range(60, 180)) <= set(ids) and len(ids) < 150 and least == {ids[0] + 10} and large == {False}
    assert len(found(far)[0]) < 15
    assert found([far[0], short[0], short[1]])[0] == [0, 1, 2]
    assert found(far + near, tile=100) == (list(range(180)), {7}, {True})


def test_marks_of_similar_lines():
    """Marks of pairs at 0.8 and above are near: of 4,000 pairs none is lost."""
    rng = random.Random(8)
    first, second = [], []
    for _ in range(4000):
        words = sentence(rng, rng.randint(12, 60)).split()
        other = list(words)
        other[rng.randrange(len(words))] = sentence(rng, 1)
        first.append(" ".join(words).encode())
        second.append(" ".join(other).encode())
    like = [line_module.shared(a, b) for a, b in zip(line_module.shingle_sets(first), line_module.shingle_sets(second))]
    size = [len(a) + len(b) for a, b in zip(line_module.shingle_sets(first), line_module.shingle_sets(second))]
    (_, one), (_, two) = line_module.signatures(first), line_module.signatures(second)
    apart = np.bitwise_count(one ^ two).sum(axis=1)
    at = np.array([x / (n - x) for x, n in zip(like, size)])
    assert (at >= 0.8).sum() > 1000 and apart[at >= 0.8].max() <= line_module.APART


def test_settled_tables_leave_no_shuffle_files(spark):
    """What was shuffled to write a table goes when it is written, and the caller's setting stays."""
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in local for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}

    before = spark.conf.get(FILE_CLEANUP, None)
    seen = files()
    rows = settle(spark.range(1000, numPartitions=3).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    until = time.time() + 20
    while files() - seen and time.time() < until:
        time.sleep(0.2)
    assert not files() - seen and rows.count() == 7
    assert spark.conf.get(FILE_CLEANUP, None) == before


def test_chunks_of_suffix_removal_follow_the_text(spark, monkeypatch):
    """More text makes more chunks and buckets, not larger ones; what is removed stays the same."""
    rng = random.Random(9)
    passages = [sentence(rng, 20) for _ in range(6)]
    texts = {i: " ".join((sentence(rng, 30), rng.choice(passages), sentence(rng, 10))) for i in range(120)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    made, write = {}, suffix.settle

    def kept(df, label):
        made[label] = write(df, label)
        return made[label]

    monkeypatch.setattr(suffix, "settle", kept)
    monkeypatch.setattr(suffix, "CHUNK", 1000)
    found = {r["doc_id"]: (r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in suffix.suffix_dedup(docs).collect()}
    assert found == brute.byte_strings(texts.items(), 50)
    most = made["anchors"].groupBy().agg(F.count_distinct("chunk"), F.max("bucket")).first()
    assert most[0] > 40 and most[1] > 40


def test_memory_of_a_bucket():
    """Rows of a bucket are cut out and judged in a few times their own size."""
    rng = np.random.default_rng(5)
    words = [bytes(rng.integers(97, 117, 8, dtype=np.uint8)) for _ in range(5000)]
    text = [b" ".join(words[i] for i in rng.integers(0, 5000, 200)) for _ in range(1000)]
    texts = Texts(pa.table({"doc": pa.array(range(len(text)), pa.int64()), "text": pa.array(text, pa.binary())}))
    anchors = suffix.Anchors(texts, suffix.LENGTH)

    def peak(make):
        tracemalloc.start()
        made = make()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most, made

    most, sent = peak(lambda: suffix.Snippets(texts, anchors, lambda gram: np.tile([True, False], (len(gram), 1)), suffix.LENGTH, 4))
    assert len(sent.rows) > 100_000 and most < 900 * len(sent.rows)
    most, late = peak(lambda: suffix.late_windows(sent.rows, sent.least, suffix.LENGTH))
    assert late.shape == (len(sent.rows), suffix.LENGTH - suffix.GRAM + 1) and most < 2000 * len(sent.rows)

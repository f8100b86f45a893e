"""Importance resampling towards a target distribution (operator 13)."""

from __future__ import annotations

import math
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fraudlens.llm.common import in_chunks, pieces, ship
from fraudlens.operators.ordering import global_row_id
from fraudlens.session import settle

CHUNK = 4 << 20  # characters of text that a task takes at once
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MOST_BUCKETS = 1 << 20  # the histograms and gains are held whole by the driver and every worker
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


class WordSplit:
    """Words of ASCII-lowered texts with their places, by an untrained splitter of the tokenizers library."""

    def __init__(self, pattern: str = WORD):
        from tokenizers import Regex, pre_tokenizers

        self.splitter = pre_tokenizers.Split(Regex(pattern), behavior="removed", invert=True)

    def __call__(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        lowered = text.lower() if text.isascii() else text.translate(_LOWER)
        return self.splitter.pre_tokenize_str(lowered)


def feature_spans(words: list[tuple[str, tuple[int, int]]], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(first word's start, last word's end)`` of all runs of 1 to ``longest`` words, and their buckets.

    The checksum of a run goes on from that of the run without its last word, so no run is joined.
    """
    crc = zlib.crc32
    pieces = [w.encode() for w, _ in words]
    at = np.array([place for _, place in words], np.int64).reshape(-1, 2)
    sums = [crc(p) for p in pieces]
    spans, found = [at], [np.array(sums, np.int64) % buckets]
    tails = [b" " + p for p in pieces] if longest > 1 else []
    for n in range(2, min(longest, len(pieces)) + 1):
        sums = [crc(tail, s) for s, tail in zip(sums, tails[n - 1:])]
        spans.append(np.stack([at[:len(sums), 0], at[n - 1:, 1]], axis=1))
        found.append(np.array(sums, np.int64) % buckets)
    return np.concatenate(spans), np.concatenate(found)


def _kind(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def bucketed(texts: DataFrame, longest: int, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, n_words, found)``: the buckets of all features of each whole text, packed."""
    ship(texts.sparkSession)
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = WordSplit()
        for batch in batches:
            at = 0
            for part in in_chunks(pieces(batch.column(1)), lambda t: len(t or b""), CHUNK):
                words = (split((t or b"").decode("utf-8", "replace")) for t in part)
                made = [(len(w), feature_spans(w, longest, buckets)[1].astype(kind).tobytes()) for w in words]
                columns = [pa.array([n for n, _ in made], pa.int64()), pa.array([f for _, f in made], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), *columns], ["id", "n_words", "found"])
                at += len(part)

    rows = texts.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, found binary")


def histogram(found: DataFrame, buckets: int) -> np.ndarray:
    """Features of all rows by bucket. A task sends one row a bucket at most; ``buckets`` rows reach the driver."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in batch.column(0):
                counts += np.bincount(np.frombuffer(row.as_py(), kind), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    summed = found.select("found").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target share over source share, both smoothed by one, rounded down."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), len(source)
    ratios = ((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weighted(found: DataFrame, gains: np.ndarray) -> DataFrame:
    """``(id, n_words, n_features, weight)``: the summed gains of each row's features."""
    kind, shared = _kind(len(gains)), found.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            rows = [np.frombuffer(b, kind) for b in batch.column(2).to_pylist()]
            columns = [pa.array([len(r) for r in rows], pa.int64()), pa.array([int(table[r].sum()) for r in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "n_words", "n_features", "weight"])

    return found.mapInArrow(run, f"id {found.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def noise(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate that seed and id fix, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """``(id, n_features, weight, score, rank)`` of every row of ``docs``; ``rank`` counts the drawn ones from 1.

    Features are all runs of 1 to ``longest`` words of whole texts, hashed to ``buckets``; a bucket's gain
    compares its share of all features of ``target`` with that of all features of ``docs``. A row's weight
    is the sum of its features' gains, its score that and the noise its id draws. Of the rows with
    ``least_words`` words, ``percent`` in a hundred, rounded down, are drawn: highest scores first, ties
    to the smaller id, then to the larger weight and number of features. Texts are read once; what is kept of a text is
    two bytes a feature. Rows are ranked by one range sort of narrow rows, in which no task holds a score.

    Null and empty texts have no features and weight 0. Ids of any orderable type; a null id draws noise
    like the empty string and comes before others in ties; rows with one id draw alike. Other columns are
    not looked at. An empty target counts as one without features; an empty table gives no rows.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"1 to {MOST_BUCKETS} buckets")
    found = settle(bucketed(docs, longest, buckets, id_col, text_col), "features")
    wanted = settle(bucketed(target.select(F.lit(0).alias("id"), F.col(target_text).alias("text")), longest, buckets, "id", "text"), "target")
    gains = bucket_gains(histogram(found, buckets), histogram(wanted, buckets))
    scored = weighted(found, gains).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = scored.withColumn("enough", F.col("n_words") >= least_words).drop("n_words")
    order = [F.desc("enough"), F.desc("score"), F.asc("id"), F.desc("weight"), F.desc("n_features")]
    placed = global_row_id(scored, order, "rank", start=1)
    drawn = found.filter(F.col("n_words") >= least_words).count() * percent // 100
    rank = F.when(F.col("enough") & (F.col("rank") <= drawn), F.col("rank"))
    return placed.select(F.col("id").alias(id_col), "n_features", "weight", "score", rank.cast("long").alias("rank"))

"""Removal of repeated token windows by Rabin-Karp hashes (operator 3)."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.common import SPACE, mix64, run_starts, ship
from fraudlens.llm.packed import JUDGED, PACKED, Texts, chunked, judged, pack, returned

WINDOW = 20
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so that powers have inverses modulo 2^64
_OUT = pa.schema([("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def word_bounds(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words of a chunk; a text's end ends its last word."""
    word = ~SPACE[texts.bytes[:texts.size]]
    head, tail = word.copy(), word.copy()
    head[1:] &= ~word[:-1]
    tail[:-1] &= ~word[1:]
    inner = texts.starts[(texts.starts > 0) & (texts.starts < texts.size)]
    head[inner] = word[inner]
    tail[inner - 1] = word[inner - 1]
    return np.flatnonzero(head), np.flatnonzero(tail) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, eight bytes at a time; ``data`` is padded by eight bytes at least."""
    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    size = ends - starts
    hashes = size.astype(np.uint64) * np.uint64(BASES[0])
    rows, at = np.flatnonzero(size <= 64), 0
    while len(rows):
        left = np.minimum(size[rows] - at, 8).astype(np.uint64)
        value = lanes[starts[rows] + at] & (np.uint64(2**64 - 1) >> (np.uint64(64) - left * np.uint64(8)))
        hashes[rows] = mix64((hashes[rows] ^ value) * np.uint64(BASES[1]))
        at += 8
        rows = rows[size[rows] > at]
    for i in np.flatnonzero(size > 64):
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes())
    return hashes


def window_hashes(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """Rabin-Karp hash of every ``length`` consecutive words: differences of one running sum, each divided
    by the power of the base at its start."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    power = np.cumprod(np.append(np.uint64(1), np.full(len(words) - 1, base, np.uint64)))
    inverse = np.cumprod(np.append(np.uint64(1), np.full(len(words) - length, pow(base, -1, 2**64), np.uint64)))
    total = np.append(np.uint64(0), np.cumsum(words * power))
    return mix64((total[length:] - total[:-length]) * inverse)


class Windows:
    """All windows of a chunk: where they start, their hashes, and which of them are the chunk's first."""

    def __init__(self, texts: Texts, length: int, buckets: int):
        starts, ends = word_bounds(texts)
        self.doc = np.searchsorted(texts.ends, starts, side="right")  # index of the text of each word
        words = word_hashes(texts.bytes, starts, ends)
        one, two = (window_hashes(words if k == 0 else mix64(words + np.uint64(1)), length, base) for k, base in enumerate(BASES))
        self.at = np.flatnonzero(self.doc[:len(one)] == self.doc[length - 1:]) if len(one) else np.zeros(0, np.int64)
        key = one[self.at]
        self.bucket = (two[self.at] % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((key,)) if len(key) else np.zeros(0, np.int64)
        fresh = np.zeros(len(key), bool)
        # lexsort is stable, so a run begins with its earliest window; runs of one hash have one bucket
        fresh[order] = run_starts(key[order])
        self.fresh, self.key = fresh, key


def substring_dedup(docs: DataFrame, length: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_removed, kept)``: every text without the words of windows that also start earlier.

    Words are separated by ASCII white space. A window is ``length`` consecutive words of one text; it is
    repeated if the same words also start in a text with a smaller id, or earlier in the same text. All
    words that a repeated window covers are removed, judged on the input; overlapping windows make
    maximal intervals. ``kept`` joins the other words by one space. Every window is counted by its hash:
    64 bits beside those that choose its bucket, whose number grows with the shuffle partitions.

    Null and empty texts have no words. A null id comes before all ids; rows with the same id count as
    one document, in the order of their texts. Other columns are not looked at. No rows: no rows.
    """
    ship(docs.sparkSession)
    dealt, n = chunked(docs, id_col, text_col)

    def send(rows: pa.Table) -> pa.Table:
        texts = Texts(rows)
        found = Windows(texts, length, n)
        at = found.at[found.fresh]
        return pack(rows.column("chunk")[0].as_py(), found.bucket[found.fresh], texts.doc[found.doc[at]], found.key[found.fresh].view(np.uint8).reshape(-1, 8))

    def earliest(data: np.ndarray, doc: np.ndarray, _) -> np.ndarray:
        key = np.ascontiguousarray(data).view(np.uint64).ravel()
        order = np.argsort(key, kind="stable")
        first = run_starts(key[order])
        run = np.cumsum(first) - 1
        least = np.minimum.reduceat(doc[order], np.flatnonzero(first))
        late = np.zeros(len(key), bool)
        late[order] = doc[order] > least[run]
        return late

    def finish(_key: tuple[pa.Scalar, ...], rows: pa.Table, marks: pa.Table) -> pa.Table:
        texts = Texts(rows)
        found = Windows(texts, length, n)
        late = ~found.fresh
        late[found.fresh] = returned(marks, found.bucket[found.fresh])[:, 0]
        at = found.at[late]
        edge = np.zeros(len(found.doc) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        n_words = np.bincount(found.doc, minlength=len(texts.texts))
        ends = np.cumsum(n_words)
        removed, kept = [], []
        for text, a, b in zip(texts.texts, ends - n_words, ends):
            removed.append(int(gone[a:b].sum()))
            words = text.split()
            kept.append(b" ".join(compress(words, (~gone[a:b]).tolist()) if removed[-1] else words))
        return pa.table([texts.ids(), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], schema=_OUT)

    sent = dealt.groupBy("chunk").applyInArrow(send, PACKED)
    marks = sent.groupBy("bucket").applyInArrow(lambda rows: judged(rows, earliest, 8), JUDGED)
    done = dealt.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(finish, "doc long, n_words long, n_removed long, kept string")
    return done.select(F.col("doc").alias(id_col), "n_words", "n_removed", "kept")

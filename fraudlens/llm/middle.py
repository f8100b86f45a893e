"""Fill-in-the-middle rearrangement, cut at places selected in a Roaring-style boundary set (operator 11)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fraudlens.llm.common import in_chunks, pieces, run_starts, ship

CHUNK = 4 << 20  # bytes of text that a task rearranges at once
SPAN_BITS = 16  # a container covers 2^16 places
ARRAY_MOST = 4096  # beyond so many places a bitmap is smaller than an array
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


class ArrayContainer:
    """Few places, one by one."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """Many scattered places as one bit each, with the number of bits before each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << SPAN_BITS, bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.upto, k, side="right"))
        inside = k - (int(self.upto[word - 1]) if word else 0)
        bits = np.unpackbits(self.words[word:word + 1].view(np.uint8), bitorder="little")
        return word * 64 + int(np.flatnonzero(bits)[inside])


class RunContainer:
    """Places in a row as their first one, with the number of places up to each run's end."""

    def __init__(self, low: np.ndarray, starts: np.ndarray):
        self.first = low[starts].astype(np.uint16)
        self.upto = np.append(starts[1:], len(low)).astype(np.int64)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.upto, k, side="right"))
        return int(self.first[run]) + k - (int(self.upto[run - 1]) if run else 0)


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for sorted places of one span."""
    starts = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if 2 * len(starts) < min(len(low), ARRAY_MOST):  # four bytes a run, two a place, 8192 a bitmap
        return RunContainer(low, starts)
    return ArrayContainer(low) if len(low) <= ARRAY_MOST else BitmapContainer(low)


class Boundaries:
    """A sorted set of places, cut into containers by their high bits; ``select`` gives the k-th place."""

    def __init__(self, places: np.ndarray):
        high = places >> SPAN_BITS
        starts = np.flatnonzero(run_starts(high)) if len(places) else np.zeros(0, np.int64)
        self.high = high[starts]
        self.upto = np.append(starts[1:], len(places)).astype(np.int64)  # cumulative cardinalities
        low = places & ((1 << SPAN_BITS) - 1)
        self.containers = [container(part) for part in np.split(low, starts[1:])] if len(places) else []

    def __len__(self) -> int:
        return int(self.upto[-1]) if self.containers else 0

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.upto, k, side="right"))
        inside = k - (int(self.upto[at - 1]) if at else 0)
        return (int(self.high[at]) << SPAN_BITS) + self.containers[at].select(inside)

    def cut(self, units: int) -> int:
        """Where the first ``units`` units end."""
        return self.select(units - 1) if units else 0


def line_ends(text: bytes) -> np.ndarray:
    """Byte places behind each line, its line feed included."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if not text or text[-1:] == b"\n" else np.append(ends, len(text))


def draws(seed: int, key: str) -> list[int]:
    """Four 32-bit numbers that a seed and a row's id fix."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def code_points(text: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def rearranged(text: bytes, key: str, seed: int, rate: int, spm: int, ends: Callable[[bytes], np.ndarray]) -> tuple:
    """``(n, form, prefix characters, middle characters, output)`` of one text."""
    places = Boundaries(ends(text))
    n = len(places)
    h1, h2, h3, h4 = draws(seed, key)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not text or any(m in text for m in marks) or h3 % 100 >= rate:
        return n, PLAIN, None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = places.cut(a), places.cut(b)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    form = SPM if h4 % 100 < spm else PSM
    first = (marks[0], prefix, marks[1], suffix) if form == PSM else (marks[1], suffix, marks[0], prefix)
    return n, form, code_points(prefix), code_points(middle), b"".join((*first, marks[2], middle))


def fill_in_middle(
    docs: DataFrame,
    seed: int = 7,
    rate: int = 100,
    spm: int = 50,
    ends: Callable[[bytes], np.ndarray] = line_ends,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output)`` of every whole text.

    A text is cut into units (lines; ``ends`` gives the byte places behind units, which must not split a
    character). The hash of ``seed`` and id draws two of the places between units, which part prefix,
    middle and suffix; whether the text is rearranged at all (``rate`` in a hundred); and whether the
    suffix comes first (``spm`` in a hundred). Empty texts and texts that hold one of the marks stay as
    they are, form ``plain``, with null for both lengths. So do null texts, which count as empty.

    Ids of any type; a null id draws like the empty string, rows with one id draw alike, each for its own
    text. Other columns are not looked at. No shuffle; an empty table gives no rows.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in in_chunks(zip(batch.column(1).to_pylist(), pieces(batch.column(2))), lambda r: len(r[1] or b""), CHUNK):
                made = [rearranged(text or b"", key or "", seed, rate, spm, ends) for key, text in part]
                n, form, prefix, middle, output = zip(*made)
                columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
                ids = batch.column(0).slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays(
                    [ids, *columns, pa.array(output, pa.binary()).view(pa.string())], ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(id_col).cast("string").alias("key"), F.col(text_col).cast("string").alias("text"))
    kinds = f"id {rows.schema['id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(run, kinds).withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. A rearranged text holds no mark, and no mark can arise across
    the border of two parts, so the three marks are the only ones."""
    part = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)))
    prefix, suffix = (F.when(form == PSM, part[i]).otherwise(part[j]) for i, j in ((1, 2), (2, 1)))
    return F.when(form == PLAIN, output).otherwise(F.concat(prefix, part[3], suffix))

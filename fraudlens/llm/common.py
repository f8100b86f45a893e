"""Helpers shared by the corpus operators: shipping code, Arrow batches, packed exchanges."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens.session import settle

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package through Spark's own file service, once per application."""
    root = Path(__file__).resolve().parents[1]
    if any(f.endswith("/fraudlens-code.zip") for f in spark.sparkContext.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="fraudlens-code-"), "fraudlens-code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(Path(root.name) / file.relative_to(root)))
    spark.sparkContext.addPyFile(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets(spark: SparkSession) -> int:
    """Buckets of a packed exchange: several per shuffle partition, so they follow the cluster's setting."""
    return 8 * partitions(spark)


def pieces(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes | None]:
    """UTF-8 bytes of each text of a column, None for null; made one at a time, not for a whole batch at once."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    return (t.as_py() for t in column.cast(kind))


def in_chunks(rows: Iterator[tuple], size, most: int) -> Iterator[list]:
    """Lists of rows whose sizes add up to ``most`` at least, so that one task holds a bounded part."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= most:
            yield held
            held, total = [], 0
    if held:
        yield held


def carried(df: DataFrame, columns: list[str]) -> tuple[DataFrame, str, dict[str, str]]:
    """``columns`` under positional names, their schema as text, and the place of each: Python code between
    Arrow batches may then add columns whatever the names are."""
    rows = df.select(*(df[c].alias(f"c{i}") for i, c in enumerate(columns)))
    kinds = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(rows.schema.fields))
    return rows, kinds, {c: f"c{i}" for i, c in enumerate(columns)}


def keyed(df: DataFrame, columns: list[str], label: str = "rows") -> tuple[DataFrame, dict[str, str]]:
    """``columns`` under positional names with a number ``row`` for every row, and the place of each column.

    Written once, so that all passes agree on the numbers: what is found out about a row comes back by
    them, whatever its id is, and column names cannot clash with those used on the way.
    """
    rows, _, place = carried(df, columns)
    return settle(rows.withColumn("row", F.monotonically_increasing_id()), label), place


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit words (the finaliser of a well-known public hash)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def run_starts(sorted_keys: np.ndarray) -> np.ndarray:
    """Whether each position of a sorted array begins a run of equal keys."""
    first = np.ones(len(sorted_keys), bool)
    first[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return first


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the place of each key among them, and how often each occurs."""
    order = np.argsort(keys, kind="stable")
    first = run_starts(keys[order])
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(first) - 1
    at = np.flatnonzero(first)
    return keys[order[at]], place, np.diff(np.append(at, len(keys)))


def whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of a sorted partition, cut so that no run of the first column is torn apart."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            now = [np.concatenate(pair) for pair in zip(held, now)]
        cut = int(np.searchsorted(now[0], now[0][-1]))
        if cut:
            yield [c[:cut] for c in now]
        held = [c[cut:] for c in now]
    if held is not None:
        yield held


class Forest:
    """Union-find over 0..n-1; the smallest index is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True

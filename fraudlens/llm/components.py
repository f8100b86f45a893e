"""Connected components of links: union-find inside tasks, alternating star contractions between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.common import ship
from fraudlens.session import settle

BLOCK = 1_000_000  # links that a task joins by itself
_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One link from every node to the smallest node of its component; the links given are all there are."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[:len(u)], ends[len(u):]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            break
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    hung = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[hung], nodes[root[hung]]


def _joined(links: DataFrame, rows: int) -> DataFrame:
    """The same components from fewer links: a task takes ``BLOCK`` links at a time and leaves their stars."""
    if dict(links.dtypes) != {"u": "bigint", "v": "bigint"}:
        return links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def joined() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in stars(*(np.concatenate(c) for c in zip(*held)))], schema=_LINKS)

        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            n += batch.num_rows
            if n >= BLOCK:
                yield joined()
                held, n = [], 0
        if n:
            yield joined()

    ship(links.sparkSession)
    return links.select("u", "v").coalesce(rows // BLOCK + 1).mapInArrow(run, "u long, v long")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none itself."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionAll(
        links.select("v", F.lit(0), F.lit(1))
    )
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root")).filter("up > 1 OR up = 1 AND root = 1").isEmpty()


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(node, component)`` for every node with a link; the component is its smallest node.

    ``links`` holds pairs of any orderable type; loops, repeated and reversed pairs and nulls are fine.
    Links of one task are joined there, a bounded number at a time. Each round then joins links with the
    minimum of a node's neighbours: minima are combined before the shuffle and joins on a hub can be
    split, so no node's neighbours ever meet in one task. A round is written to the shared folder; it
    ends when every node hangs on a root. No links: no rows.
    """
    pairs = links.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u <> v")
    now = settle(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "links")
    now = settle(_joined(now, now.count()).distinct(), "links")
    while not _settled(now):
        now = settle(_small_star(_large_star(now)), "links")
        now = settle(_joined(now, now.count()).distinct(), "links")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)

"""Near-duplicate vectors by quantised tile products with proven error bounds (operator 2)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.common import ship
from fraudlens.llm.components import components
from fraudlens.llm.packed import NO_ID
from fraudlens.session import settle

TILE = 1024  # vectors of a tile
SLACK = 1e-9  # above the rounding of the bounds themselves

_FOUND = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("links", pa.int64())])


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows in double precision with length one; the largest component is divided out first."""
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


class Quantised:
    """Unit vectors as int8 times a scale, with the length of what the rounding left out."""

    def __init__(self, rows: np.ndarray):
        self.unit = unit(rows)
        self.scale = np.abs(self.unit).max(1) / 127
        self.int8 = np.rint(self.unit / self.scale[:, None]).astype(np.int8)
        rounded = self.int8 * self.scale[:, None]
        self.size = np.sqrt((rounded * rounded).sum(1))
        self.error = np.sqrt(((self.unit - rounded) ** 2).sum(1))


def possible(a: Quantised, b: Quantised, least: float) -> np.ndarray:
    """Pairs whose cosine may reach ``least``.

    With x = sq + r and y = tp + u, x.y differs from st(q.p) by sq.u + r.tp + r.u, which the lengths of
    the parts bound. Products of int8 are summed in floating point that holds them exactly.
    """
    kind = np.float32 if a.int8.shape[1] * 127 * 127 < 2**24 else np.float64
    product = (a.int8.astype(kind) @ b.int8.astype(kind).T).astype(np.float64)
    product *= a.scale[:, None] * b.scale
    product += a.size[:, None] * b.error + a.error[:, None] * (b.size + b.error)
    return product >= least - SLACK


def links_of(a: Quantised, b: Quantised, least: float) -> np.ndarray:
    """The boolean matrix of pairs with cosine ``least`` or more, in double precision."""
    found = possible(a, b, least)
    i, j = np.nonzero(found)
    for lo in range(0, len(i), 65536):
        x, y = i[lo:lo + 65536], j[lo:lo + 65536]
        found[x, y] = np.einsum("ij,ij->i", a.unit[x], b.unit[y]) >= least
    return found


def tile_components(links: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Component labels of the rows and columns of a link matrix; ``same``: rows and columns are one set."""
    n, m = links.shape
    rows, columns = np.arange(n), np.arange(n) if same else n + np.arange(m)
    while True:
        new_rows = np.minimum(rows, np.where(links, columns, n + m).min(1, initial=n + m))
        new_columns = new_rows if same else np.minimum(columns, np.where(links, new_rows[:, None], n + m).min(0, initial=n + m))
        if (new_rows == rows).all() and (new_columns == columns).all():
            return rows, columns
        rows, columns = new_rows, new_columns


def compare_tiles(ids: np.ndarray, rows: np.ndarray, copies: np.ndarray, tile: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
    """Links between the two tiles of a group, or inside its only tile: ``(u, v, links)``. Rows with
    u = v carry a vector's number of links found here, the others connect its component."""
    one, two = np.flatnonzero(tile == tile.min()), np.flatnonzero(tile == tile.max())
    same = tile.min() == tile.max()
    left = Quantised(rows[one])
    right = left if same else Quantised(rows[two])
    found = links_of(left, right, least)
    if same:
        np.fill_diagonal(found, False)
    here, there = tile_components(found, same)
    nodes, labels = (one, here) if same else (np.concatenate([one, two]), np.concatenate([here, there]))
    counts = found @ copies[two]
    if not same:
        counts = np.concatenate([counts, found.T @ copies[one]])
    some = counts > 0
    moved = labels != np.arange(len(nodes))
    u = np.concatenate([ids[nodes[some]], ids[nodes[moved]]])
    v = np.concatenate([ids[nodes[some]], ids[nodes[labels[moved]]]])
    return u, v, np.concatenate([counts[some], np.zeros(int(moved.sum()), np.int64)])


def vector_links(distinct: DataFrame, least: float, tile: int = TILE) -> DataFrame:
    """``(u, v, links)`` from all pairs of tiles of each label. A label with many vectors is cut into tiles
    by a hash; each pair of its tiles is a task's group, so no group holds more than about two tiles."""
    sizes = distinct.groupBy("label", "dim").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    cut = distinct.join(sizes, ["label", "dim"]).withColumn("own", own)
    sent = cut.withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sent = sent.select("label", "dim", F.least("own", "mate").alias("i"), F.greatest("own", "mate").alias("j"), "id", "vector", "copies", "own")

    def compare(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        _, dim, i, j = (k.as_py() for k in key)
        tiles = group.column("own").to_numpy()
        if i != j and tiles.min() == tiles.max():  # the other tile is empty
            return _FOUND.empty_table()
        vectors = group.column("vector").combine_chunks()
        vectors = pa.concat_arrays(vectors.chunks) if isinstance(vectors, pa.ChunkedArray) else vectors
        rows = vectors.flatten().to_numpy().reshape(-1, dim)
        found = compare_tiles(group.column("id").to_numpy(), rows, group.column("copies").to_numpy(), tiles, least)
        return pa.table([pa.array(c, pa.int64()) for c in found], schema=_FOUND)

    return sent.groupBy("label", "dim", "i", "j").applyInArrow(compare, "u long, v long, links long")


def vector_groups(
    vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row of ``vectors``.

    Rows of one label link at a cosine of ``least`` or more. Null, empty and zero vectors, vectors with
    null or non-finite components, vectors of other lengths and rows without a label link with nothing.
    Equal vectors are compared once and count as often as they occur. Only links that connect leave a
    task. Ids are integers; a null id is the smallest; rows with the same id, or without one, are different
    vectors; other columns are not looked at. No rows: no rows.
    """
    ship(vectors.sparkSession)
    value = F.col(vector_col)
    sound = F.coalesce(
        F.col(label_col).isNotNull() & (F.size(value) > 0)
        & F.forall(value, lambda x: F.coalesce((F.abs(x) < float("inf")), F.lit(False)))
        & F.exists(value, lambda x: x != 0),
        F.lit(False),
    )
    rows = vectors.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("id"), F.col(label_col).alias("label"), value.alias("vector"), sound.alias("sound")
    )
    good = rows.filter("sound").select("id", "label", "vector")
    distinct = good.groupBy("label", "vector").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    distinct = settle(distinct.withColumn("dim", F.size("vector")).withColumn("id", F.monotonically_increasing_id()), "distinct")  # a number of its own
    found = settle(vector_links(distinct.drop("least"), least), "found")
    links = found.filter("u = v").groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("links"))
    groups = settle(components(found.filter("u <> v")).withColumnRenamed("node", "id").join(distinct.select("id", "least"), "id"), "groups")
    first = groups.groupBy("component").agg(F.min("least").alias("first"))
    groups = groups.join(first, "component").select("id", "first")
    named = distinct.join(links, "id", "left").join(groups, "id", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("first", "least").alias("component_id")
    )
    done = good.join(named.hint("merge"), ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.filter("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    null = F.lit(int(NO_ID))
    return done.unionAll(alone).select(
        F.nullif("id", null).alias(id_col),
        "n_links",
        F.nullif("component_id", null).alias("component_id"),
        (F.col("id") == F.col("component_id")).alias("kept"),
    )

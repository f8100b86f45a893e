"""SimHash near-duplicates, found by a grid join over segment bit counts (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.common import batch_of, keyed, partitions, pieces, run_starts, ship, whole_runs
from fraudlens.llm.components import components
from fraudlens.session import settle

SEED = 42
BLOCKS = 4  # blocks of 16 bits
SEGMENT = 2  # bits of a segment, whose count is one grid coordinate
CELL = 4096  # fingerprints that are compared at once

_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def fingerprint(text: bytes | None, width: int) -> int:
    """Majority bits of the hashes of all word shingles; no words: zero."""
    words = (text or b"").lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    width = min(width, len(words))
    join, digest = b" ".join, xxhash.xxh64_intdigest
    hashes = np.array([digest(join(s), SEED) for s in zip(*(words[i:] for i in range(width)))], np.uint64)
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(rows: DataFrame, width: int = 3) -> DataFrame:
    """``(name, fp)``: one signed 64-bit fingerprint per row of ``(name, text)``, whole texts, no shuffle. Null
    is an empty text; names of any type pass through."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, width) for t in pieces(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], ["name", "fp"])

    return rows.select("name", "text").mapInArrow(run, f"name {rows.schema['name'].dataType.simpleString()}, fp long")


def block_counts(fp: np.ndarray) -> np.ndarray:
    """Per fingerprint and block the bit counts of its segments, two bits each, as one number per block."""
    odd = np.uint64(0x5555555555555555)
    return ((fp & odd) + ((fp >> np.uint64(1)) & odd)).view(np.uint16).reshape(-1, BLOCKS)


def grid_cells(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell keys and the row each belongs to, such that rows at a distance of 3 bits or fewer share one.

    The Manhattan distance of segment counts never exceeds the bit distance. Three bits spread over four
    blocks leave two blocks at count distance 0 (six cells of two whole blocks), or else one bit in each
    of three blocks: one block at distance 0 and the next at distance exactly 1. There the parities of
    the next block's bit counts differ, so even rows lie in their own cell and odd rows reach for the
    neighbour cells at distance 1.
    """
    counts = block_counts(fp).astype(np.uint64)
    rows = np.arange(len(fp))
    keys, owners = [], []
    kind = 0
    for a in range(BLOCKS):
        for b in range(a + 1, BLOCKS):
            keys.append(counts[:, a] << np.uint64(16) | counts[:, b] | np.uint64(kind << 32))
            owners.append(rows)
            kind += 1
    odd = np.bitwise_count(fp.view(np.uint16)).reshape(-1, BLOCKS) % 2 == 1
    for a in range(BLOCKS):
        b = (a + 1) % BLOCKS
        base = counts[:, a] << np.uint64(16) | np.uint64(kind << 32)
        even = ~odd[:, b]
        keys.append((base | counts[:, b])[even])
        owners.append(rows[even])
        for s in range(16 // SEGMENT):
            one = np.uint64(1 << (SEGMENT * s))
            count = (counts[:, b] >> np.uint64(SEGMENT * s)) & np.uint64(3)
            for fits, moved in ((count < SEGMENT, counts[:, b] + one), (count > 0, counts[:, b] - one)):
                take = odd[:, b] & fits
                keys.append((base | moved)[take])
                owners.append(rows[take])
        kind += 1
    return np.concatenate(keys), np.concatenate(owners)


def _spread(prints: DataFrame) -> DataFrame:
    """``(cell, fp, doc)`` for every cell of every fingerprint."""
    schema = pa.schema([("cell", pa.int64()), ("fp", pa.int64()), ("doc", pa.int64())])

    def run(batches):
        for batch in batches:
            fp, doc = (np.asarray(batch.column(c)) for c in ("fp", "doc"))
            if len(fp):
                keys, owners = grid_cells(np.ascontiguousarray(fp).view(np.uint64))
                yield batch_of(schema, keys.view(np.int64), fp[owners], doc[owners])

    return prints.select("fp", "doc").mapInArrow(run, "cell long, fp long, doc long")


def linked(fp: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Spanning links of the rows whose fingerprints differ in ``most`` bits or fewer."""
    label, out = np.arange(len(fp)), []
    for i in range(len(fp) - 1):
        near = np.flatnonzero(np.bitwise_count(fp[i + 1:] ^ fp[i]) <= most) + i + 1
        for j in near[label[near] != label[i]]:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                out.append((i, int(j)))
    return out


def linked_in_runs(cell: np.ndarray, fp: np.ndarray, most: int) -> np.ndarray:
    """Links between rows of one cell; ``cell`` is sorted. Small runs are compared offset by offset."""
    starts = np.flatnonzero(run_starts(cell))
    sizes = np.diff(np.append(starts, len(cell)))
    out = []
    for s, n in zip(starts[sizes > 32], sizes[sizes > 32]):
        out += [(s + i, s + j) for i, j in linked(fp[s:s + n], most)]
    small = np.repeat((sizes > 1) & (sizes <= 32), sizes)
    cell, fp, at = cell[small], fp[small], np.flatnonzero(small)
    parts = [np.array(out, np.int64).reshape(-1, 2)]
    for d in range(1, 32):
        same = cell[d:] == cell[:-d]
        if not same.any():
            break
        hit = np.flatnonzero(same & (np.bitwise_count(fp[d:] ^ fp[:-d]) <= most))
        parts.append(np.stack([at[hit], at[hit + d]], 1))
    return np.concatenate(parts)


def near_links(prints: DataFrame, most: int = 3, cell_rows: int = CELL) -> DataFrame:
    """``(u, v)``: links that connect all documents whose distinct fingerprints differ in ``most`` bits or fewer.

    ``prints`` has one row ``(doc, fp)`` per distinct fingerprint. Rows meet in grid cells; a cell beyond
    ``cell_rows`` is cut into parts that are compared part by part, each pair of parts in a task of its
    own. Only spanning links leave a task, never all pairs.
    """
    if not 0 <= most <= 3:
        raise ValueError("the grid serves distances of 3 bits or fewer")
    cells = _spread(prints.repartition(partitions(prints.sparkSession), "fp"))  # a row becomes some thirty
    big = settle(cells.groupBy("cell").count().filter(F.col("count") > cell_rows)
                 .select("cell", F.ceil(F.col("count") / cell_rows).cast("int").alias("parts")), "cells")
    rows = cells
    if not big.isEmpty():
        cut = cells.join(big, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        cut = cut.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        cut = cut.withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        part = F.xxhash64("cell", F.least("own", "mate"), F.greatest("own", "mate"))
        rows = cut.select(F.when(F.col("parts") > 1, part).otherwise(F.col("cell")).alias("cell"), "fp", "doc")

    def run(batches):
        for cell, fp, doc in whole_runs(batches):
            ends = linked_in_runs(cell, np.ascontiguousarray(fp).view(np.uint64), most)
            yield batch_of(_LINKS, doc[ends[:, 0]], doc[ends[:, 1]])

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "u long, v long")


def grouped_prints(prints: DataFrame, most: int) -> DataFrame:
    """``(fp, first)``: of every fingerprint in ``(name, fp)``, the least name in its group; nulls are left out."""
    distinct = settle(prints.groupBy("fp").agg(F.min("name").alias("name")), "distinct")
    groups = components(near_links(distinct.select(F.col("fp").alias("doc"), "fp"), most)).withColumnRenamed("node", "fp")
    named = settle(groups.join(distinct, "fp"), "named")
    first = named.groupBy("component").agg(F.min("name").alias("first"))
    joined = named.join(first, "component").select("fp", "first", F.lit(True).alias("joined"))
    return distinct.join(joined, "fp", "left").select("fp", F.when(F.col("joined"), F.col("first")).otherwise(F.col("name")).alias("first"))


def simhash_groups(docs: DataFrame, width: int = 3, most: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint, component_id)`` for every row of ``docs``.

    Texts are lower-cased in ASCII and split at ASCII white space; fewer words than ``width``: the whole
    sequence is the one shingle. Null and empty texts have fingerprint zero, which links like any other.
    Rows with one fingerprint are joined before the search; other columns are not looked at. Ids are of
    any orderable type and need not be unique. ``component_id`` is the least id of the group; rows without
    an id belong to groups but name none, so it is null only where no row of the group has one. An
    empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("name"), F.col(text_col).cast("string").alias("text"))
    prints = settle(fingerprints(rows, width), "prints")
    return prints.join(grouped_prints(prints, most).hint("merge"), "fp").select(
        F.col("name").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first").alias("component_id")
    )


def simhash_dedup(docs: DataFrame, width: int = 3, most: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each group of ``simhash_groups``: that with the least id, rows without one last;
    of equal ids the first that is read. All columns are kept, whatever their names; ids may be null or repeated."""
    rows, place = keyed(docs, docs.columns)
    key = F.col(place[id_col])
    name = F.struct(key.isNull().alias("none"), key.alias("id"), "row")
    prints = settle(fingerprints(rows.select(name.alias("name"), F.col(place[text_col]).cast("string").alias("text")), width), "prints")
    first = grouped_prints(prints, most)
    later = prints.join(first.hint("merge"), "fp").filter("name.row <> first.row").select("name.row")
    return rows.join(later, "row", "left_anti").select(*(F.col(place[c]).alias(c) for c in docs.columns))

"""Column statistics kept per partition of a table, so that a new day costs a day and not the whole table.

Every partition has a state of mergeable parts: counts, sums and sums of squares per number, a quantile
sketch per number, and the counts of every text value. A partition is read again only if its files have
changed, which their listing tells; the states of the others are merged as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens.operators.ordering import global_row_id
from fraudlens.session import settle
from fraudlens.sources.tables import read_optional

SKETCH_K = 400  # the sketches' size: their rank error is about 0.4 percent
MOST_PARTS = 10_000  # partitions that one update names in its filter


def partition_marks(spark: SparkSession, path: str, by: str) -> DataFrame:
    """``(part, mark)`` of every partition ``by=...`` below ``path``, from its files' names, sizes and times; nothing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
    part = F.regexp_extract("path", f"/{by}=([^/]*)/", 1)
    name = F.xxhash64(F.element_at(F.split("path", "/"), -1), "length", "modificationTime")
    found = files.select(part.alias("part"), name.alias("name")).filter("part <> ''")
    mark = F.concat_ws(":", F.count("*").cast("string"), F.sum(F.col("name").cast("decimal(38,0)")).cast("string"))
    return found.groupBy("part").agg(mark.alias("mark"))


def numeric_states(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    """``(part, column, n, total, squares, least, largest, sketch)``; one hash aggregation per partition and column."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols]))
    rows = df.select(F.col(by).cast("string").alias("part"), cells.alias("cell")).select("part", "cell.column", "cell.x")
    return rows.filter("x IS NOT NULL AND NOT isnan(x)").groupBy("part", "column").agg(
        F.count("*").alias("n"), F.sum("x").alias("total"), F.sum(F.col("x") * F.col("x")).alias("squares"),
        F.min("x").alias("least"), F.max("x").alias("largest"), F.kll_sketch_agg_double("x", SKETCH_K).alias("sketch"),
    )


def value_states(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    """``(part, column, value, n)`` of every text value."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
    rows = df.select(F.col(by).cast("string").alias("part"), cells.alias("cell")).select("part", "cell.column", "cell.value")
    return rows.filter("value IS NOT NULL").groupBy("part", "column", "value").agg(F.count("*").alias("n"))


@dataclass
class TableStates:
    """States of the table at ``source``, which is partitioned ``by`` a column, kept below ``base``."""

    spark: SparkSession
    source: str
    base: str
    by: str
    numbers: Sequence[str]
    texts: Sequence[str]

    def _write(self, df: DataFrame, name: str) -> None:
        # only the partitions at hand are replaced
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{self.base}/{name}")

    def _known(self) -> DataFrame:
        marks = read_optional(self.spark, f"{self.base}/marks", "parquet")
        return marks if marks is not None else self.spark.createDataFrame([], "mark string, part string")

    def stale(self) -> list[str]:
        """Partitions whose files are not those their state was made of."""
        now = partition_marks(self.spark, self.source, self.by)
        known = self._known().select(F.col("part").cast("string").alias("part"), "mark")
        return sorted(r["part"] for r in now.join(known, ["part", "mark"], "left_anti").select("part").collect())  # names of partitions

    def update(self, parts: Sequence[str] | None = None) -> list[str]:
        """Read the partitions that are new or changed, and write their states; their names.

        The marks are written after the states, so an interrupted update is repeated. More than
        ``MOST_PARTS`` stale partitions are taken in several turns.
        """
        todo = self.stale() if parts is None else list(parts)
        for i in range(0, len(todo), MOST_PARTS):
            turn = todo[i:i + MOST_PARTS]
            marks = settle(partition_marks(self.spark, self.source, self.by).filter(F.col("part").isin(turn)), "marks")
            rows = self.rows(turn)
            if self.numbers:
                self._write(numeric_states(rows, self.by, self.numbers), "numbers")
            if self.texts:
                self._write(value_states(rows, self.by, self.texts), "values")
            self._write(marks, "marks")
        return todo

    def rows(self, parts: Sequence[str]) -> DataFrame:
        """The partitions' rows: a filter on the partition column, so no other file is opened."""
        return self.spark.read.parquet(self.source).filter(F.col(self.by).cast("string").isin(list(parts)))

    def moments(self) -> DataFrame:
        """``(column, n, mean, std, least, largest, median)``; the median is that of the merged sketches."""
        states = self.spark.read.parquet(f"{self.base}/numbers")
        merged = states.groupBy("column").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.min("least").alias("least"),
            F.max("largest").alias("largest"), F.kll_merge_agg_double("sketch").alias("sketch"),
        )
        mean = F.col("total") / F.col("n")
        spread = F.sqrt(F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0)))
        median = F.kll_sketch_get_quantile_double("sketch", F.lit(0.5))
        return merged.select("column", "n", mean.alias("mean"), spread.alias("std"), "least", "largest", median.alias("median"))

    def codes(self) -> DataFrame:
        """``(column, value, n, code)``: distinct values of all partitions, coded by their text in code-point order."""
        counts = self.spark.read.parquet(f"{self.base}/values").groupBy("column", "value").agg(F.sum("n").alias("n"))
        placed = global_row_id(counts, ["column", "value"], "_at")  # in blocks: no task gets a whole column
        first = placed.groupBy("column").agg(F.min("_at").alias("_first"))  # a row per column
        return placed.join(F.broadcast(first), "column").select("column", "value", "n", (F.col("_at") - F.col("_first")).alias("code"))

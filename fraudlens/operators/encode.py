"""Label encoding and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fraudlens.operators.joins import lookup
from fraudlens.operators.ordering import global_row_id
from fraudlens.schema import existing

INLINE = 64  # dictionaries up to this size become a literal list, larger ones a joined table

# The classes an unseen value falls back to, in order of preference.
UNSEEN_TOKEN = "__UNKNOWN__"
FALLBACKS = (UNSEEN_TOKEN, "unknown")


class LabelEncoder:
    """Code of a value = rank of its text in code-point order among the fitted classes, from 0.

    All columns are fitted by one job: the distinct (column, text) pairs are ordered globally and
    numbered, and a column's codes start at its first pair. An unseen value gets the code of
    ``__UNKNOWN__`` if that is a class, else of ``unknown``, else 0; ``reserve_unseen`` adds the former
    as a class of its own.
    """

    def __init__(self, cols: Sequence[str], reserve_unseen: bool = False, missing: str = "unknown"):
        self.wanted, self.reserve_unseen, self.missing = list(cols), reserve_unseen, missing
        self._forget()

    def _forget(self) -> None:
        self.cols: list[str] = []
        self.dictionary: DataFrame | None = None
        self.sizes: dict[str, int] = {}
        self.fallback: dict[str, int] = {}
        self._inline: dict[str, list[str]] = {}

    def _text(self, col: str) -> Column:
        return F.coalesce(F.col(col).cast("string"), F.lit(self.missing))

    def fit(self, df: DataFrame) -> LabelEncoder:
        """Fit anew on ``df``; nothing of an earlier fit is kept. Without columns nothing is encoded."""
        self._forget()
        self.cols = existing(df, self.wanted)
        if not self.cols:
            return self
        pair = lambda c, v: F.struct(F.lit(c).alias("column"), v.alias("value"))
        cells = F.explode(F.array(*[pair(c, self._text(c)) for c in self.cols]))
        pairs = df.select(cells.alias("_cell")).select("_cell.*").distinct()
        if self.reserve_unseen:
            extra = [(c, UNSEEN_TOKEN) for c in self.cols]
            pairs = pairs.unionByName(df.sparkSession.createDataFrame(extra, "column string, value string")).distinct()
        placed = global_row_id(pairs, ["column", "value"], "_at")
        fallback = [F.min(F.when(F.col("value") == token, F.col("_at"))).alias(f"_f{i}") for i, token in enumerate(FALLBACKS)]
        heads = placed.groupBy("column").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"), *fallback).collect()
        start = {r["column"]: r["_first"] for r in heads}  # one row per column
        self.sizes = {r["column"]: r["_n"] for r in heads}
        for r in heads:
            found = [r[f"_f{i}"] for i in range(len(FALLBACKS)) if r[f"_f{i}"] is not None]
            self.fallback[r["column"]] = found[0] - r["_first"] if found else 0
        first = F.coalesce(*[F.when(F.col("column") == c, F.lit(v)) for c, v in start.items()]) if start else F.lit(0)
        self.dictionary = placed.select("column", "value", (F.col("_at") - first).alias("code"))
        small = [c for c, n in self.sizes.items() if n <= INLINE]
        for row in self.dictionary.filter(F.col("column").isin(*small)).orderBy("column", "code").collect():
            self._inline.setdefault(row["column"], []).append(row["value"])  # at most INLINE per column
        return self

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        cols = existing(df, self.cols)
        codes: dict[str, Column] = {}
        for c in cols:
            if c in self._inline:
                classes = F.array(*[F.lit(v) for v in self._inline[c]])
                place = F.array_position(classes, self._text(c)).cast("long")
                codes[c] = F.when(place > 0, place - 1).otherwise(F.lit(self.fallback[c]).cast("long"))
            else:
                part = self.dictionary.filter(F.col("column") == c).select(
                    F.col("value").alias(f"_text_{c}"), F.col("code").alias(f"_code_{c}")
                )
                df = lookup(df.withColumn(f"_text_{c}", self._text(c)), part, f"_text_{c}").drop(f"_text_{c}")
                codes[c] = F.coalesce(F.col(f"_code_{c}"), F.lit(self.fallback[c]).cast("long"))
        kept = [c for c in df.columns if not c.startswith("_code_") and (suffix or c not in codes)]
        order = [c for c in df.columns if not c.startswith("_code_")]
        if suffix:
            return df.select(*kept, *[v.alias(c + suffix) for c, v in codes.items()])
        return df.select(*[codes[c].alias(c) if c in codes else F.col(c) for c in order])


class Scaler:
    """(x - mean) / population standard deviation; a constant column becomes 0."""

    def __init__(self, cols: Sequence[str], fit_on: str = "train", split: str = "split"):
        if fit_on not in ("all", "train"):
            raise ValueError("fit_on is 'all' or 'train'")
        self.wanted, self.fit_on, self.split = list(cols), fit_on, split
        self.cols: list[str] = []
        self.mean: dict[str, float] = {}
        self.std: dict[str, float] = {}

    def fit(self, df: DataFrame) -> Scaler:
        rows = df if self.fit_on == "all" else df.filter(F.col(self.split) == "train")
        self.cols, self.mean, self.std = existing(df, self.wanted), {}, {}
        if not self.cols:
            return self
        num = {c: F.col(c).cast("double") for c in self.cols}
        stats = rows.agg(
            *[F.avg(num[c]).alias(f"m_{c}") for c in self.cols],
            *[F.stddev_pop(num[c]).alias(f"s_{c}") for c in self.cols],
        ).first()
        for c in self.cols:
            self.mean[c] = stats[f"m_{c}"]
            self.std[c] = stats[f"s_{c}"] or 1.0
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {
            c: (F.col(c).cast("double") - F.lit(self.mean[c])) / F.lit(self.std[c])
            for c in self.cols
            if self.mean[c] is not None
        }
        return df.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])

    def table(self, spark) -> DataFrame:
        """(column, mean, std) as fitted."""
        rows = [(c, self.mean[c], self.std[c]) for c in self.cols]
        return spark.createDataFrame(rows, "column string, mean double, std double")

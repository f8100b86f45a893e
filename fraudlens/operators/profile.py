"""Column profiles and label statistics. What reaches the driver is one value per column or class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from fraudlens.functions.scalars import nan_to_null, ratio
from fraudlens.operators.ordering import running
from fraudlens.schema import family_counts

SAMPLE_CELLS = 5_000_000  # values of all columns together that the brackets around medians are taken from
SAMPLE_ROWS = 1_000  # the least number of rows of that sample


def profile_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each stage of a job, one row per stage."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("stage"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns")
        )
        for name, df in stages.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _canonical_text(df: DataFrame, col: str):
    """Text that is equal exactly for equal values: -0.0 and 0.0 agree, NaN counts as missing."""
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        value = F.col(col).cast("double")
        return F.when(~F.isnan(value), (value + F.lit(0.0)).cast("string"))
    return F.col(col).cast("string")


def column_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n): value counts of every listed column from a single scan and one shuffle."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), _canonical_text(df, c).alias("value")) for c in cols])
    )
    return (
        df.select(cells.alias("_cell"))
        .select("_cell.column", "_cell.value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def distinct_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact number of distinct non-missing values per column.

    Value counts first (map-side combine takes care of frequent values), then a count per column:
    instead of one distinct aggregate per column, which would copy each row once per column.
    """
    cols = list(cols) if cols is not None else df.columns
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    counts = column_values(df, cols).groupBy("column").agg(F.count("*").alias("n"))
    return names.join(counts, "column", "left").select("column", F.coalesce("n", F.lit(0)).alias("n_distinct"))


def column_medians(df: DataFrame, cols: Sequence[str], sample_cells: int = SAMPLE_CELLS) -> dict[str, float | None]:
    """Exact median of each numeric column, missing values left out.

    Quantiles of a sample of bounded size give a bracket per column, as wide as the column's own number of
    sampled values asks for; one scan counts what lies below it, and only the values inside are ordered,
    all columns together, over all rows. A bracket that misses the median
    (checked by the counts) is widened to the column's whole range, so the sample decides cost, not result.
    """
    cols = list(cols)
    if not cols:
        return {}
    num = {c: nan_to_null(F.col(c).cast("double")) for c in cols}
    counted = df.agg(F.count("*").alias("_rows"), *[F.count(num[c]).alias(c) for c in cols]).first().asDict()
    n_rows, sizes = counted.pop("_rows"), counted
    share = min(1.0, max(SAMPLE_ROWS, sample_cells // len(cols)) / max(1, n_rows))
    bounds = _sampled_brackets(df, num, sizes, share)
    below, upto = _rank_counts(df, num, bounds)
    wide = [
        c for c in cols
        if sizes[c] and not (c in bounds and below[c] <= (sizes[c] - 1) // 2 and sizes[c] // 2 < upto[c])
    ]
    if wide:
        edge = df.agg(*[F.struct(F.min(num[c]), F.max(num[c])).alias(c) for c in wide]).first().asDict()
        bounds |= {c: tuple(edge[c]) for c in wide}
        below |= {c: 0 for c in wide}

    bounds = {c: b for c, b in bounds.items() if sizes[c]}
    if not bounds:
        return dict.fromkeys(cols)
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.when(num[c].between(lo, hi), num[c]).alias("value"))
                for c, (lo, hi) in bounds.items()
            ]
        )
    )
    inside = (
        df.select(cells.alias("_cell"))
        .select("_cell.column", "_cell.value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    cum, _ = running(inside, ["column", "value"], {"upto": ("sum", "n")})
    wanted, start = F.lit(False), 0
    held = {r["column"]: r["n"] for r in cum.groupBy("column").agg(F.sum("n").alias("n")).collect()}  # a row per column
    for c in sorted(held):
        for rank in {(sizes[c] - 1) // 2, sizes[c] // 2}:
            at = start + rank - below[c]
            wanted = wanted | ((F.col("column") == c) & (F.col("upto") > at) & (F.col("upto") - F.col("n") <= at))
        start += held[c]
    hits: dict[str, list[float]] = {c: [] for c in cols}
    for row in cum.filter(wanted).collect():  # at most two values per column
        hits[row["column"]].append(row["value"])
    return {c: (min(v) + max(v)) / 2 if v else None for c, v in hits.items()}


def _sampled_brackets(df, num, sizes: dict[str, int], share: float) -> dict[str, tuple[float, float]]:
    """Per column the values five standard errors of rank around the sample median; none if the sample has no value."""
    sample = df.sample(share, seed=42) if share < 1 else df
    half = {c: min(0.5, 2.5 / max(1.0, sizes[c] * share) ** 0.5) for c in num}
    ends = sample.agg(*[F.percentile(x, F.array(F.lit(0.5 - half[c]), F.lit(0.5 + half[c]))).alias(c) for c, x in num.items()])
    return {c: tuple(v) for c, v in ends.first().asDict().items() if v is not None}


def _rank_counts(df, num, bounds):
    """Per column: values below the bracket, and values up to its upper end."""
    if not bounds:
        return {}, {}
    counts = df.agg(
        *[F.count_if(num[c] < lo).alias(f"b_{c}") for c, (lo, _) in bounds.items()],
        *[F.count_if(num[c] <= hi).alias(f"u_{c}") for c, (_, hi) in bounds.items()],
    ).first()
    return {c: counts[f"b_{c}"] for c in bounds}, {c: counts[f"u_{c}"] for c in bounds}


def median_profile(df: DataFrame, cols: Sequence[str], sample_cells: int = SAMPLE_CELLS) -> DataFrame:
    """(column, median), one row per column."""
    found = column_medians(df, cols, sample_cells)
    return df.sparkSession.createDataFrame([(c, found[c]) for c in cols], "column string, median double")


def sketched_medians(df: DataFrame, cols: Sequence[str], k: int = 400) -> DataFrame:
    """(column, n, median, rank_error): medians of all columns in one scan, from mergeable sketches of fixed size.

    A sketched median's rank is off by at most ``rank_error`` (a share of the column's values) with a
    probability of 99 percent; ``column_medians`` is the exact way.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), nan_to_null(F.col(c).cast("double")).alias("x")) for c in cols]))
    found = df.select(cells.alias("_cell")).select("_cell.*").groupBy("column").agg(F.count("x").alias("n"), F.kll_sketch_agg_double("x", k).alias("s"))
    median = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(0.5)))
    return found.select("column", "n", median.alias("median"), F.lit(rank_error(k)).alias("rank_error"))


def rank_error(k: int) -> float:
    """Rank error of a sketch of size ``k`` at 99 percent, as its authors fitted it."""
    return 2.296 / k**0.9021


def label_rate(df: DataFrame, by: str, label: str) -> DataFrame:
    """Rows and share of positives per split."""
    return df.groupBy(by).agg(F.count("*").alias("n_rows"), F.avg(F.col(label).cast("double")).alias("label_rate"))


def rate_gap(df: DataFrame, by: str, label: str, first: str, second: str) -> DataFrame:
    """Absolute difference of the label rates of two splits."""
    rate = lambda s: F.avg(F.when(F.col(by) == s, F.col(label).cast("double")))
    return df.agg(F.abs(rate(first) - rate(second)).alias("rate_gap"))


def pos_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive, with at least one positive assumed."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(neg.alias("neg"), pos.alias("pos")).withColumn(
        "scale_pos_weight", F.col("neg") / F.greatest(F.lit(1), F.col("pos"))
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of each class; the total is a scalar formed from the class counts."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_rows"))
    total = counts.agg(F.sum("n_rows").alias("total")).scalar()
    return counts.select(label, "n_rows", (F.col("n_rows") / total).alias("share"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n/(k*n_c) of each of the k classes."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_rows"))
    mean_size = counts.agg(F.avg("n_rows").alias("mean_size")).scalar()
    return counts.select(label, (mean_size / F.col("n_rows")).alias("class_weight"))


def weight_profile(df: DataFrame, weight: str) -> DataFrame:
    """Smallest, largest and mean sample weight, and the ratio of the extremes."""
    return df.agg(
        F.min(weight).alias("min_weight"), F.max(weight).alias("max_weight"), F.avg(weight).alias("mean_weight")
    ).withColumn("weight_ratio", ratio(F.col("max_weight"), F.col("min_weight")))


def dataset_report(df: DataFrame, by: str, label: str, features: Sequence[str]) -> DataFrame:
    """Rows, positives, label rate and class weight of each split, with the number of features per family."""
    families = family_counts(features)
    stats = df.groupBy(by).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(label) == 1).alias("n_positive"),
        F.avg(F.col(label).cast("double")).alias("label_rate"),
    )
    weight = (F.col("n_rows") - F.col("n_positive")) / F.greatest(F.lit(1), F.col("n_positive"))
    sized = {"n_features": len(features), **{f"n_{f.lower()}_features": n for f, n in families.items()}}
    return stats.withColumn("scale_pos_weight", weight).withColumns(
        {name: F.lit(n).cast("long") for name, n in sized.items()}
    )

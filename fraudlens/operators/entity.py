"""Risk profiles of cards, e-mail domains and devices, from training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fraudlens.operators.joins import lookup
from fraudlens.operators.ordering import running

# Statistics of each entity kind, in the order they fill the node vector.
CARD_STATS = ("amt_mean", "amt_count", "fraud_rate", "fraud_count")
PAIR_STATS = ("amt_mean", "amt_count", "fraud_rate")


def named_entities(df: DataFrame, keys: Sequence[str], missing: str = "unknown") -> DataFrame:
    """Keys as every table of entities has them: a missing text is named ``missing``, a missing number stays
    missing and is an entity of its own, which null-safe lookups find."""
    return df.na.fill(missing, subset=list(keys))


def entity_stats(
    train: DataFrame,
    keys: Sequence[str],
    amount: str = "TransactionAmt",
    label: str = "isFraud",
    stats: Sequence[str] = CARD_STATS,
    missing: str | None = "unknown",
) -> DataFrame:
    """Amount mean and count, fraud rate and count per entity.

    A missing key is an entity of its own, a text then named ``missing``; with ``missing=None`` its rows
    are left out. One hash aggregation: a hub entity is combined in every task before the shuffle.
    """
    if missing is None:
        train = train.na.drop(subset=list(keys))
    else:
        train = named_entities(train, keys, missing)
    made = {
        "amt_mean": F.coalesce(F.avg(amount), F.lit(0.0)),
        "amt_count": F.count(amount),
        "fraud_rate": F.avg(F.col(label).cast("double")),
        "fraud_count": F.sum(F.col(label).cast("long")),
    }
    return train.groupBy(*keys).agg(*[made[s].alias(s) for s in stats])


def distinct_entities(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def _with_entity(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with its keys once more as profiles name them, so that the caller's columns stay as they are."""
    names = [f"_entity{i}" for i in range(len(keys))]
    return named_entities(df.withColumns({n: F.col(k) for n, k in zip(names, keys)}), names), names


def attach_stats(nodes: DataFrame, stats: DataFrame, keys: Sequence[str], default: float | None = 0.0, **tuning) -> DataFrame:
    """Add an entity's statistics to its rows; an unseen entity gets ``default`` (None keeps null).

    A missing key finds the profile of the missing one.
    """
    new = [c for c in stats.columns if c not in keys]
    named, names = _with_entity(nodes, keys)
    joined = lookup(named, stats.withColumnsRenamed(dict(zip(keys, names))), names, "left", null_safe=True, **tuning).drop(*names)
    return joined if default is None else joined.na.fill(default, subset=new)


def leave_one_out(train: DataFrame, keys: Sequence[str], label: str = "isFraud", name: str = "fraud_rate", default: float = 0.0, **tuning) -> DataFrame:
    """Rows with the fraud rate of their entity over its other rows; ``default`` where there are none.

    A training row's own label is not part of its feature. One aggregation and one lookup.
    """
    named, names = _with_entity(train, keys)
    totals = named.groupBy(*names).agg(F.sum(F.col(label).cast("long")).alias("_s"), F.count(label).alias("_n"))
    own = F.coalesce(F.col(label).cast("long"), F.lit(0))
    others = F.col("_n") - F.col(label).isNotNull().cast("long")
    joined = lookup(named, totals, names, "left", null_safe=True, **tuning)
    return joined.select(*train.columns, F.coalesce(F.try_divide(F.col("_s") - own, others), F.lit(default)).alias(name))


def time_causal(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], label: str = "isFraud", name: str = "fraud_rate", default: float = 0.0, **tuning
) -> DataFrame:
    """Rows with the fraud rate of their entity over its earlier rows; ``default`` for its first.

    ``order`` ends in a unique column. One range sort by entity and time gives running sums over the whole
    table, and an entity's sums are those since its first row: a busy entity is cut over many tasks.
    """
    named, names = _with_entity(rows, keys)
    named = named.withColumn("_y", F.coalesce(F.col(label).cast("long"), F.lit(0).cast("long")))
    named = named.withColumn("_one", F.col(label).isNotNull().cast("long"))
    ahead, _ = running(named, [*names, *order], {"_s": ("sum", "_y"), "_n": ("sum", "_one")}, inclusive=False)
    starts = ahead.groupBy(*names).agg(F.min("_s").alias("_s0"), F.min("_n").alias("_n0"))
    joined = lookup(ahead, starts, names, "left", null_safe=True, **tuning)
    rate = F.try_divide(F.col("_s") - F.col("_s0"), F.col("_n") - F.col("_n0"))
    return joined.select(*rows.columns, F.coalesce(rate, F.lit(default)).alias(name))

"""Which later transactions use entities that were risky in training?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fraudlens.operators.clean import MedianImputer, null_placeholders
from fraudlens.operators.entity import CARD_STATS, attach_stats, entity_stats
from fraudlens.operators.joins import merge_identity
from fraudlens.operators.ordering import time_split
from fraudlens.session import settle


def test_rows_with_card_risk(
    tx: DataFrame,
    idn: DataFrame | None,
    keys: Sequence[str] = ("card1", "card2", "card4"),
    frac: float = 0.7,
    time: str = "TransactionDT",
    key: str = "TransactionID",
    amount: str = "TransactionAmt",
    label: str = "isFraud",
) -> DataFrame:
    """Test transactions with amount statistics and fraud rate of their card in training (0 when unseen)."""
    needed = list(dict.fromkeys([key, time, amount, label, *keys]))
    if set(needed) <= set(tx.columns):  # an identity adds columns, never rows, so it is joined only if a key is among its columns
        merged = tx.select(*needed)
    else:
        merged = merge_identity(tx, idn, key).select(*needed)
    merged = settle(null_placeholders(merged), "merged")
    split = time_split(merged, frac, time, key)
    filled = MedianImputer([amount]).fit(split).transform(split)
    stats = settle(entity_stats(filled.filter("split = 'train'"), keys, amount, label), "stats")
    test = filled.filter("split = 'test'").drop("split")
    return attach_stats(test, stats, list(keys)).select(key, *keys, amount, label, *CARD_STATS)


def risky_cards(rows: DataFrame, keys: Sequence[str] = ("card1", "card2", "card4")) -> DataFrame:
    """Per card of the test rows: use in test beside its training profile."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n_test"),
        *[F.first(s).alias(s) for s in CARD_STATS],
    )

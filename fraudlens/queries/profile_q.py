"""Aggregations and profiles (A1-A12, A15) and dataset reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens import bindings as b
from fraudlens.operators import profile as p
from fraudlens.operators.clean import add_simple_device
from fraudlens.operators.encode import Scaler
from fraudlens.operators.entity import PAIR_STATS, distinct_entities, entity_stats
from fraudlens.operators.joins import attach_weights, merge_identity
from fraudlens.plans.risk import risky_cards, test_rows_with_card_risk
from fraudlens.queries.base import query, split_txn, steady, steady_sql
from fraudlens.session import settle


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("a01_profile_counts", """
    SELECT 'transactions' AS stage, count(*) AS n_rows, 11::BIGINT AS n_columns FROM txn
    UNION ALL SELECT 'identities', count(*), 4 FROM idn UNION ALL SELECT 'merged', count(*), 14 FROM merged""")
def a01(spark, d):
    tx, idn = b.txn(spark, d), b.idn(spark, d)
    return p.profile_counts({"transactions": tx, "identities": idn, "merged": merge_identity(tx, idn)})


_DISTINCT = ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "card2", "card4",
             "P_emaildomain", "C1", "D1", "DeviceType", "DeviceInfo", "id_01"]


@query("a02_distinct_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_distinct FROM merged" for c in _DISTINCT))
def a02(spark, d):
    return p.distinct_profile(merge_identity(b.txn(spark, d), b.idn(spark, d)))


_MEDIAN = ["TransactionDT", "TransactionAmt", "card1", "C1", "D1"]


@query("a03_median_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(median({c}) AS DOUBLE) AS median FROM txn" for c in _MEDIAN))
def a03(spark, d):
    return p.median_profile(settle(b.txn(spark, d), "txn"), _MEDIAN)


@query("a03_median_by_selection", " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(median({c}) AS DOUBLE) AS median FROM txn" for c in _MEDIAN))
def a03_selection(spark, d):
    """The same medians the way large tables get them: bracket, count, order what is inside."""
    return p.median_profile(settle(b.txn(spark, d), "txn"), _MEDIAN, sample_cells=0)


@query("a03_sketched_medians", " UNION ALL ".join(f"SELECT '{c}' AS column, count({c}) AS n, true AS within_bound FROM txn" for c in _MEDIAN))
def a03_sketched(spark, d):
    """Medians of all columns from one scan, and whether their ranks are within the stated error."""
    rows = settle(b.txn(spark, d), "txn")
    found = {r["column"]: r for r in p.sketched_medians(rows, _MEDIAN).collect()}  # one row a column
    x = {c: F.col(c).cast("double") for c in _MEDIAN}
    near = lambda c: (
        (F.count_if(x[c] < found[c]["median"]) <= F.count(x[c]) * (0.5 + found[c]["rank_error"]))
        & (F.count_if(x[c] <= found[c]["median"]) >= F.count(x[c]) * (0.5 - found[c]["rank_error"]))
    )
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(found[c]["n"]).cast("long").alias("n"), F.col(c).alias("within_bound")) for c in _MEDIAN])
    return rows.agg(*[near(c).alias(c) for c in _MEDIAN]).select(F.explode(cells).alias("r")).select("r.*")


@query("a04_scaler_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std FROM split WHERE split = 'train'"
    for c in ("TransactionAmt", "C1", "D1")))
def a04(spark, d):
    stats = Scaler(["TransactionAmt", "C1", "D1"]).fit(split_txn(spark, d, "TransactionAmt", "C1", "D1")).table(spark)
    return stats.select("column", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


@query("a05_label_rate", """
    SELECT split, count(*) AS n_rows, round(avg(isFraud), 6) AS label_rate FROM split GROUP BY split""")
def a05(spark, d):
    return _rounded(p.label_rate(split_txn(spark, d, "isFraud"), "split", "isFraud"), "label_rate")


@query("a05_rate_gap", """
    SELECT round(abs(avg(isFraud) FILTER (WHERE split = 'train') - avg(isFraud) FILTER (WHERE split = 'test')), 6) AS rate_gap FROM split""")
def a05_gap(spark, d):
    return _rounded(p.rate_gap(split_txn(spark, d, "isFraud"), "split", "isFraud", "train", "test"), "rate_gap")


@query("a06_pos_weight", """
    SELECT count(*) FILTER (WHERE isFraud = 0) AS neg, count(*) FILTER (WHERE isFraud = 1) AS pos,
           round(CAST(count(*) FILTER (WHERE isFraud = 0) AS DOUBLE) / greatest(1, count(*) FILTER (WHERE isFraud = 1)), 6)
           AS scale_pos_weight FROM split WHERE split = 'train'""")
def a06(spark, d):
    return _rounded(p.pos_weight(split_txn(spark, d, "isFraud").filter("split = 'train'"), "isFraud"), "scale_pos_weight")


@query("a07_class_weights", """
    SELECT isFraud, round((SELECT count(*) FROM txn) / (2 * CAST(count(*) AS DOUBLE)), 6) AS class_weight FROM txn GROUP BY isFraud""")
def a07(spark, d):
    return _rounded(p.class_weights(b.txn(spark, d), "isFraud"), "class_weight")


@query("a08_class_distribution", """
    SELECT event_type, count(*) AS n_rows, round(count(*) / CAST((SELECT count(*) FROM events) AS DOUBLE), 6) AS share
    FROM events GROUP BY event_type""")
def a08(spark, d):
    return _rounded(p.class_distribution(b.table(spark, d, "events"), "event_type"), "share")


@query("a09_card_stats", f"""
    SELECT card1, card2, card4, {steady_sql("coalesce(avg(TransactionAmt), 0)", 4)} AS amt_mean, count(TransactionAmt) AS amt_count,
           round(avg(isFraud), 6) AS fraud_rate, CAST(sum(isFraud) AS BIGINT) AS fraud_count
    FROM split WHERE split = 'train' GROUP BY 1, 2, 3""")
def a09(spark, d):
    stats = entity_stats(split_txn(spark, d, "card1", "card2", "card4", "TransactionAmt", "isFraud").filter("split = 'train'"), ["card1", "card2", "card4"])
    return _rounded(stats.withColumn("amt_mean", steady(F.col("amt_mean"), 4)), "fraud_rate")


@query("a10_email_stats", f"""
    SELECT coalesce(P_emaildomain, 'unknown') AS P_emaildomain, {steady_sql("avg(TransactionAmt)", 4)} AS amt_mean,
           count(TransactionAmt) AS amt_count, round(avg(isFraud), 6) AS fraud_rate
    FROM split WHERE split = 'train' GROUP BY 1""")
def a10(spark, d):
    stats = entity_stats(split_txn(spark, d, "P_emaildomain", "TransactionAmt", "isFraud").filter("split = 'train'"), ["P_emaildomain"], stats=PAIR_STATS)
    return _rounded(stats.withColumn("amt_mean", steady(F.col("amt_mean"), 4)), "fraud_rate")


@query("a11_device_stats", f"""
    WITH m AS (SELECT split.*, DeviceType, DeviceInfo FROM split LEFT JOIN idn USING (TransactionID))
    SELECT coalesce(DeviceType, 'unknown') AS DeviceType,
           coalesce(split_part(lower(DeviceInfo), '/', 1), 'unknown') AS DeviceInfo_simple,
           {steady_sql("coalesce(avg(TransactionAmt), 0)", 4)} AS amt_mean, count(TransactionAmt) AS amt_count, round(avg(isFraud), 6) AS fraud_rate
    FROM m WHERE split = 'train' GROUP BY 1, 2""")
def a11(spark, d):
    train = split_txn(spark, d, "TransactionAmt", "isFraud").filter("split = 'train'")
    rows = add_simple_device(merge_identity(train, b.idn(spark, d)))
    stats = entity_stats(rows, ["DeviceType", "DeviceInfo_simple"], stats=PAIR_STATS)
    return _rounded(stats.withColumn("amt_mean", steady(F.col("amt_mean"), 4)), "fraud_rate")


@query("a12_distinct_entities", "SELECT DISTINCT card1, card2, card4 FROM txn")
def a12(spark, d):
    return distinct_entities(b.txn(spark, d), ["card1", "card2", "card4"])


@query("a15_weight_profile", """
    WITH w AS (SELECT isFraud, sum(count(*)) OVER () / (count(*) OVER () * CAST(count(*) AS DOUBLE)) AS cw FROM txn GROUP BY 1)
    SELECT round(min(cw), 6) AS min_weight, round(max(cw), 6) AS max_weight, round(avg(cw), 6) AS mean_weight,
           round(max(cw) / min(cw), 6) AS weight_ratio FROM txn JOIN w USING (isFraud)""")
def a15(spark, d):
    rows = b.txn(spark, d)
    weighted = attach_weights(rows, settle(p.class_weights(rows, "isFraud"), "weights"), "isFraud")
    return _rounded(p.weight_profile(weighted, "class_weight"), "min_weight", "max_weight", "mean_weight", "weight_ratio")


@query("m11_dataset_report", """
    SELECT split, count(*) AS n_rows, CAST(sum(isFraud) AS BIGINT) AS n_positive, round(avg(isFraud), 6) AS label_rate,
           round((count(*) - sum(isFraud)) / CAST(greatest(1, sum(isFraud)) AS DOUBLE), 6) AS scale_pos_weight,
           7::BIGINT AS n_features, 1::BIGINT AS n_c_features, 1::BIGINT AS n_d_features, 0::BIGINT AS n_v_features, 0::BIGINT AS n_id_features
    FROM split GROUP BY split""")
def m11(spark, d):
    features = ["TransactionAmt", "ProductCD", "card1", "card2", "card4", "C1", "D1"]
    return _rounded(p.dataset_report(split_txn(spark, d, "isFraud"), "split", "isFraud", features), "label_rate", "scale_pos_weight")


CARD_RISK = """
    m AS (SELECT median(TransactionAmt) AS med FROM split WHERE split = 'train'),
    filled AS (SELECT split.* REPLACE (coalesce(TransactionAmt, med) AS TransactionAmt) FROM split, m),
    s AS (SELECT card1, card2, card4, avg(TransactionAmt) AS am, count(TransactionAmt) AS ac, avg(isFraud) AS fr, sum(isFraud) AS fc
          FROM filled WHERE split = 'train' GROUP BY 1, 2, 3)"""


@query("r01_test_rows_with_card_risk", f"""
    WITH {CARD_RISK}
    SELECT TransactionID, card1, card2, card4, TransactionAmt, isFraud, {steady_sql("coalesce(am, 0)", 4)} AS amt_mean, coalesce(ac, 0) AS amt_count,
           round(coalesce(fr, 0), 6) AS fraud_rate, CAST(coalesce(fc, 0) AS BIGINT) AS fraud_count
    FROM filled LEFT JOIN s USING (card1, card2, card4) WHERE split = 'test'""")
def r01(spark, d):
    rows = test_rows_with_card_risk(b.txn(spark, d), b.idn(spark, d))
    return _rounded(rows.withColumn("amt_mean", steady(F.col("amt_mean"), 4)), "fraud_rate")


@query("r02_risky_cards", f"""
    WITH {CARD_RISK}
    SELECT card1, card2, card4, count(*) AS n_test, {steady_sql("max(coalesce(am, 0))", 4)} AS amt_mean, max(coalesce(ac, 0)) AS amt_count,
           round(max(coalesce(fr, 0)), 6) AS fraud_rate, CAST(max(coalesce(fc, 0)) AS BIGINT) AS fraud_count
    FROM filled LEFT JOIN s USING (card1, card2, card4) WHERE split = 'test' GROUP BY 1, 2, 3""")
def r02(spark, d):
    rows = risky_cards(test_rows_with_card_risk(b.txn(spark, d), b.idn(spark, d)))
    return _rounded(rows.withColumn("amt_mean", steady(F.col("amt_mean"), 4)), "fraud_rate")

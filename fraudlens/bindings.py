"""The driver's star-schema tables seen as transactions, identities, scores, logs and histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens.functions.scalars import epoch_seconds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order, with missing values and placeholder texts."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    fraud = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return rows.select(
        F.col("o_orderkey").alias("TransactionID"),
        F.when(fraud, 1).otherwise(0).alias("isFraud"),
        epoch_seconds(F.col("o_orderdate")).alias("TransactionDT"),
        F.when(F.col("o_orderkey") % 19 != 0, F.col("o_totalprice")).alias("TransactionAmt"),
        F.col("o_orderpriority").alias("ProductCD"),
        F.col("o_custkey").alias("card1"),
        F.col("c_nationkey").alias("card2"),
        F.col("c_mktsegment").alias("card4"),
        F.when(F.col("o_custkey") % 11 == 0, "unknown")
        .when(F.col("o_custkey") % 13 == 0, "UNKN")
        .otherwise(F.lower("n_name"))
        .alias("P_emaildomain"),
        (F.col("o_orderkey") % 7).alias("C1"),
        F.when(F.col("o_custkey") % 5 != 0, F.col("c_acctbal")).alias("D1"),
    )


def idn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most one identity per order: its cheapest line that is no return. The minimum is a plain aggregation."""
    lines = table(spark, sf_dir, "lineitem").filter("l_returnflag <> 'R'")
    first = lines.groupBy(F.col("l_orderkey").alias("TransactionID")).agg(
        F.min(
            F.struct("l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_returnflag", "l_discount")
        ).alias("r")
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return first.join(part, F.col("r.l_partkey") == part.p_partkey).select(
        "TransactionID",
        F.col("r.l_returnflag").alias("DeviceType"),
        F.concat(F.upper("p_name"), F.lit("/"), F.col("p_type")).alias("DeviceInfo"),
        F.col("r.l_discount").alias("id_01"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two score columns of different tie density for the same labels."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("label"),
        F.col("value").alias("score_a"),
        F.get_json_object("props", "$.k").cast("double").alias("score_b"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log messages and job statuses."""
    error, kind = F.col("event_type") == "error", F.col("user_id") % 3
    return table(spark, sf_dir, "events").select(
        "ts",
        F.concat(F.lit("job-"), (F.col("user_id") % 8).cast("string")).alias("stream"),
        F.col("event_type").alias("status"),
        F.when(error & (kind == 0), "AccessDenied: not authorized to perform iam:PassRole")
        .when(error & (kind == 1), "AlgorithmError: exit code 2")
        .when(error, "Error: step failure")
        .otherwise(F.concat(F.lit("ok "), F.col("props")))
        .alias("message"),
        "event_id",
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One training-history row per day of events."""
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) + 1
    return (
        table(spark, sf_dir, "events")
        .groupBy(day.cast("long").alias("epoch"))
        .agg(F.round(F.avg("value"), 6).alias("auc"))
    )


def card_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 32-wide vector per card; cards beyond the table are unseen."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("card1"), F.slice(F.col("embedding").cast("array<double>"), 1, 32).alias("emb")
    )

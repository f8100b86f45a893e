"""Scans, sinks, manifests."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens import bindings as b
from fraudlens.operators.metrics import evaluate
from fraudlens.operators.model import load_model, save_model, score
from fraudlens.operators.ordering import head_sample, preview
from fraudlens.operators.profile import pos_weight
from fraudlens.plans.preprocess import training_config
from fraudlens.queries.base import query, split_txn
from fraudlens.queries.model_q import small_model
from fraudlens.session import settle, workspace
from fraudlens.sources import manifest as m
from fraudlens.sources.sinks import read_split, write_manifest, write_metrics, write_named_splits, write_splits, write_table
from fraudlens.sources.tables import read_config, read_dir, read_optional, read_table

TXN_SCHEMA = T.StructType(
    [
        T.StructField("TransactionID", T.LongType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("TransactionDT", T.LongType()),
        T.StructField("TransactionAmt", T.DoubleType()),
        T.StructField("ProductCD", T.StringType()),
        T.StructField("card1", T.LongType()),
        T.StructField("card2", T.IntegerType()),
        T.StructField("card4", T.StringType()),
        T.StructField("P_emaildomain", T.StringType()),
        T.StructField("C1", T.LongType()),
        T.StructField("D1", T.DoubleType()),
    ]
)


def _csv_with_tokens(spark, d):
    """Transactions as CSV whose missing values are written as different tokens."""
    rows = b.txn(spark, d)
    token = F.when(F.col("TransactionID") % 2 == 0, "NA").otherwise("nan")
    texts = rows.select(*[F.coalesce(F.col(c).cast("string"), token).alias(c) for c in rows.columns])
    return write_table(texts, workspace(spark, "csv"), "csv")


@query("s01_csv_scan", "SELECT * FROM txn")
def s01(spark, d):
    return read_table(spark, _csv_with_tokens(spark, d), "csv", TXN_SCHEMA)


@query("s01_csv_inferred", """
    SELECT TransactionID, CAST(isFraud AS BIGINT) AS isFraud, TransactionAmt, ProductCD, card1,
           CAST(card2 AS BIGINT) AS card2, P_emaildomain, D1 FROM txn""")
def s01_inferred(spark, d):
    found = read_table(spark, _csv_with_tokens(spark, d), "csv")
    return found.select("TransactionID", "isFraud", "TransactionAmt", "ProductCD", "card1", "card2", "P_emaildomain", "D1")


@query("s02_optional_source", """
    SELECT 'present' AS source, true AS found, count(*) AS n_rows, count(DeviceType) AS n_identified FROM merged
    UNION ALL SELECT 'absent', false, count(*), 0 FROM txn""")
def s02(spark, d):
    from fraudlens.operators.clean import ensure_column
    from fraudlens.operators.joins import merge_identity

    path = write_table(b.idn(spark, d), workspace(spark, "identity"))
    out = None
    for name, where in (("present", path), ("absent", f"{path}_none")):
        idn = read_optional(spark, where)
        rows = ensure_column(merge_identity(b.txn(spark, d), idn), "DeviceType", None)
        part = rows.agg(F.count("*").alias("n_rows"), F.count("DeviceType").alias("n_identified")).select(
            F.lit(name).alias("source"), F.lit(idn is not None).alias("found"), "n_rows", "n_identified"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query("s03_directory_scan", "SELECT TransactionID, ProductCD, D1 FROM txn")
def s03(spark, d):
    path = write_table(b.txn(spark, d).select("TransactionID", "ProductCD", "D1").repartition(4), workspace(spark, "parts"), "csv")
    schema = T.StructType([f for f in TXN_SCHEMA.fields if f.name in ("TransactionID", "ProductCD", "D1")])
    return read_dir(spark, path, schema)


@query("s04_preview", "SELECT * FROM txn ORDER BY TransactionID LIMIT 5")
def s04(spark, d):
    return preview(b.txn(spark, d), 5, ["TransactionID"])


@query("s05_head_sample", """
    WITH head AS (SELECT TransactionID FROM txn ORDER BY TransactionID LIMIT 1000)
    SELECT idn.* FROM idn WHERE TransactionID IN (SELECT TransactionID FROM head)""")
def s05(spark, d):
    return head_sample(b.txn(spark, d), b.idn(spark, d), 1000, "TransactionID", ["TransactionID"])[1]


@query("s06_table_sink", "SELECT * FROM merged")
def s06(spark, d):
    from fraudlens.operators.joins import merge_identity

    rows = merge_identity(b.txn(spark, d), b.idn(spark, d))
    path = write_table(rows, workspace(spark, "sink"), "csv")
    return read_table(spark, path, "csv", rows.schema, na_values=("",))


@query("s07_split_layout", """
    SELECT 'train' AS split, count(*) AS n_rows, sum(isFraud)::BIGINT AS n_fraud FROM split WHERE split = 'train'
    UNION ALL SELECT 'test', count(*), sum(isFraud)::BIGINT FROM split WHERE split = 'test'""")
def s07(spark, d):
    path = write_splits(split_txn(spark, d, "isFraud"), workspace(spark, "splits"))
    out = None
    for value in ("train", "test"):
        part = read_split(spark, path, value).agg(
            F.count("*").alias("n_rows"), F.sum("isFraud").alias("n_fraud")
        ).select(F.lit(value).alias("split"), "n_rows", "n_fraud")
        out = part if out is None else out.unionByName(part)
    return out


@query("s08_manifest", """
    SELECT 'tabular' AS model_type, round(CAST(sum(1 - isFraud) AS DOUBLE) / greatest(1, sum(isFraud)), 6) AS scale_pos_weight,
           count(*) AS n_rows FROM split WHERE split = 'train'""")
def s08(spark, d):
    train = split_txn(spark, d, "isFraud").filter("split = 'train'")
    stats = train.agg(F.count("*").alias("n")).first()
    weight = pos_weight(train, "isFraud").first()["scale_pos_weight"]
    content = {"model_type": "tabular", "scale_pos_weight": weight, "n_rows": stats["n"]}
    path = write_manifest(spark, content, workspace(spark, "manifest"))
    return read_config(spark, path).select(
        "model_type", F.round("scale_pos_weight", 6).alias("scale_pos_weight"), "n_rows"
    )


@query("s09_catalog", "SELECT true AS has_files, true AS sizes_add_up, true AS listed_rows_present FROM (SELECT 1)")
def s09(spark, d):
    base = workspace(spark, "catalog")
    write_named_splits(split_txn(spark, d), base, "xgb")
    files = settle(m.catalog(spark, base, exclude="_SUCCESS"), "files")
    totals = m.catalog_totals(files).first()
    return files.agg(
        (F.count("*") == totals["total_files"]).alias("has_files"),
        ((F.sum("size_mb") == totals["total_size_mb"]) & (F.min("size_bytes") > 0)).alias("sizes_add_up"),
        (F.count_if(F.col("path").contains("/part-")) == F.count("*")).alias("listed_rows_present"),
    )


@query("s09_catalog_totals")
def s09_totals(spark, d):
    """Files, total size and rows of every written split."""
    base = workspace(spark, "catalog")
    write_named_splits(split_txn(spark, d), base, "xgb")
    files = m.catalog(spark, base, exclude="_SUCCESS")
    folder = F.regexp_extract("path", "/xgb/([^/.]+)", 1).alias("split")
    return files.groupBy(folder).agg(F.count("*").alias("total_files"), F.sum("size_bytes").alias("total_bytes"), F.round(F.sum("size_mb"), 6).alias("total_size_mb"))


@query("s11_append_day", """
    WITH r AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_totalprice, CAST(o_custkey AS DOUBLE) AS cust, o_orderpriority, o_orderstatus FROM orders),
         v AS (SELECT unnest(['o_totalprice', 'cust']) AS name, unnest([o_totalprice, cust]) AS x FROM r),
         t AS (SELECT unnest(['o_orderpriority', 'o_orderstatus']) AS name, unnest([o_orderpriority, o_orderstatus]) AS x FROM r)
    SELECT name AS "column", CAST(count(*) AS BIGINT) AS n, round(avg(x), 4) AS mean, round(stddev_pop(x), 3) AS std, max(x) AS largest,
           CAST(NULL AS BIGINT) AS n_values, 0 AS unread, 1 AS read_again FROM v GROUP BY name
    UNION ALL SELECT name, CAST(count(*) AS BIGINT), NULL, NULL, NULL, CAST(count(DISTINCT x) AS BIGINT), 0, 1 FROM t GROUP BY name""")
def s11_append(spark, d):
    """Statistics kept per month: all months but the last, then the last one appended. The second update reads it alone
    (``read_again`` months) and leaves none stale (``unread``); merged states equal those of the whole table."""
    from fraudlens.sources.incremental import TableStates

    rows = b.table(spark, d, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_totalprice", F.col("o_custkey").cast("double").alias("cust"), "o_orderpriority", "o_orderstatus"
    )
    rows = settle(rows, "orders")
    source = workspace(spark, "months")
    last = rows.agg(F.max("month")).first()[0]
    rows.filter(F.col("month") < last).write.partitionBy("month").parquet(source)
    states = TableStates(spark, source, workspace(spark, "states"), "month", ["o_totalprice", "cust"], ["o_orderpriority", "o_orderstatus"])
    states.update()
    rows.filter(F.col("month") == last).write.mode("append").partitionBy("month").parquet(source)
    again = states.update()
    unread = states.stale()
    none = lambda kind: F.lit(None).cast(kind)
    numbers = states.moments().select(
        "column", "n", F.round("mean", 4).alias("mean"), F.round("std", 3).alias("std"), "largest", none("long").alias("n_values")
    )
    texts = states.codes().groupBy("column").agg(F.sum("n").alias("n"), (F.max("code") + 1).alias("n_values"))
    texts = texts.select("column", "n", none("double").alias("mean"), none("double").alias("std"), none("double").alias("largest"), "n_values")
    return numbers.unionByName(texts).withColumns({"unread": F.lit(len(unread)), "read_again": F.lit(len(again))})


@query("s15_scoring_pipeline", "SELECT count(*) AS n_rows, true AS equal_scores, true AS in_range FROM txn")
def s15_pipeline(spark, d):
    """Fitted preparation and trees as one pipeline model: written, loaded, applied to raw rows; equal scores."""
    from pyspark.ml import PipelineModel

    from fraudlens.operators.boosting import BoostParams, train_boosting
    from fraudlens.operators.joins import merge_identity
    from fraudlens.plans.preprocess import preprocess
    from fraudlens.plans.saved import scoring_pipeline
    from fraudlens.schema import FeatureSpec

    raw = settle(merge_identity(b.txn(spark, d), b.idn(spark, d)), "raw")
    spec = FeatureSpec(("ProductCD", "card4", "P_emaildomain"), ("TransactionAmt", "C1", "D1"))
    done = preprocess(b.txn(spark, d), b.idn(spark, d), spec)
    params = BoostParams(rounds=2, max_depth=2, learning_rate=0.3, max_bins=16)
    trees = train_boosting(done.rows.filter("split = 'train'"), done.spec.features, params, "isFraud")
    model, path = scoring_pipeline(done, trees), workspace(spark, "pipeline")
    model.write().overwrite().save(path)
    before = model.transform(raw).select("TransactionID", F.col("score").alias("before"))
    after = PipelineModel.load(path).transform(raw).select("TransactionID", F.col("score").alias("after"))
    both = before.join(after, "TransactionID")
    return both.agg(
        F.count("*").alias("n_rows"), F.bool_and(F.col("before") == F.col("after")).alias("equal_scores"), F.bool_and(F.col("after").between(0, 1)).alias("in_range")
    )


@query("s10_missing_outputs", """
    WITH required AS (SELECT DISTINCT strftime(o_orderdate, 'dt=%Y-%m-%d') AS path FROM orders),
         existing AS (SELECT DISTINCT strftime(l_shipdate, 'dt=%Y-%m-%d') AS path FROM lineitem)
    SELECT path FROM required WHERE path NOT IN (SELECT path FROM existing)""")
def s10(spark, d):
    """Daily partitions expected from the orders against those that shipped lines would have written."""
    day = lambda name, col: b.table(spark, d, name).select(
        F.concat(F.lit("dt="), F.date_format(col, "yyyy-MM-dd")).alias("path")
    ).distinct()
    return m.missing_outputs(day("orders", "o_orderdate"), day("lineitem", "l_shipdate"))


@query("s11_materialize", """
    WITH n AS (SELECT count(*) AS n FROM txn), f AS (SELECT count(*) AS n FROM txn WHERE isFraud = 1)
    SELECT 1 AS step, 'written' AS action, n FROM n UNION ALL SELECT 2, 'skipped', n FROM n
    UNION ALL SELECT 3, 'written', n FROM f""")
def s11(spark, d):
    """First run writes, the same inputs skip, changed inputs write again."""
    path = workspace(spark, "materialized")
    rows = b.txn(spark, d)
    fraud = rows.filter("isFraud = 1")
    out = []
    for step, source in enumerate((rows, rows, fraud), 1):
        done, action = m.materialize(spark, lambda s=source: s, path, m.fingerprint(source))
        out.append((step, action, done.count()))
    return spark.createDataFrame(out, "step int, action string, n bigint")


@query("s12_run_log", "SELECT 'preprocess' AS name, true AS success, true AS timed, count(*) AS n_rows FROM txn")
def s12(spark, d):
    path = workspace(spark, "runs")
    with m.RunLog(spark, path, "preprocess") as run:
        run.n_rows = settle(b.txn(spark, d), "txn").count()
    timed = (F.col("ended") >= F.col("started")) & (F.col("duration_s") >= 0)
    return m.read_runs(spark, path).select("name", "success", timed.alias("timed"), "n_rows")


@query("s13_snapshot", """
    SELECT 'transactions' AS channel, count(*) AS n_rows FROM txn UNION ALL SELECT 'identities', count(*) FROM idn""")
def s13(spark, d):
    inputs = {"transactions": b.txn(spark, d), "identities": b.idn(spark, d)}
    return m.snapshot(spark, inputs, workspace(spark, "snapshot")).select("channel", "n_rows")


@query("s14_metrics_sink", """
    WITH g AS (SELECT score_a AS s, sum(label) AS p, count(*) - sum(label) AS q FROM scored GROUP BY 1),
         c AS (SELECT *, sum(p) OVER (ORDER BY s DESC) AS tp, sum(q) OVER (ORDER BY s DESC) AS fp,
                      sum(p) OVER () AS pos, sum(q) OVER () AS neg FROM g)
    SELECT round(sum(CAST(p AS DOUBLE) * (neg - fp + q / 2)) / (max(pos) * CAST(max(neg) AS DOUBLE)), 6) AS auc,
           round(sum(CAST(p AS DOUBLE) / pos * tp / (tp + fp)), 6) AS average_precision FROM c""")
def s14(spark, d):
    path = write_metrics(evaluate(b.scored(spark, d), "label", "score_a"), workspace(spark, "metrics"))
    return spark.read.json(path).select(
        F.round("auc", 6).alias("auc"), F.round("average_precision", 6).alias("average_precision")
    )


@query("s15_model_roundtrip", "SELECT count(*) AS n_rows, 0.0::DOUBLE AS largest_change, 8 AS rounds, true AS has_auc FROM txn")
def s15(spark, d):
    model, ready, params, _ = small_model(spark, d)
    path = workspace(spark, "model")
    save_model(model, path, params, evaluate(score(model, ready), "isFraud", "score"))
    loaded, found, metrics = load_model(spark, path)
    same = score(model, ready, "before").join(score(loaded, ready, "after").select("TransactionID", "after"), "TransactionID")
    return same.agg(
        F.count("*").alias("n_rows"), F.max(F.abs(F.col("before") - F.col("after"))).alias("largest_change")
    ).withColumn("rounds", F.lit(found.rounds)).withColumn("has_auc", metrics.select(F.col("auc").between(0, 1)).scalar())


@query("s16_config", """
    SELECT 128 AS hidden_dim, 6 AS max_depth, 100 AS n_estimators,
           round(CAST(sum(1 - isFraud) AS DOUBLE) / greatest(1, sum(isFraud)), 6) AS scale_pos_weight FROM txn""")
def s16(spark, d):
    weight = pos_weight(b.txn(spark, d), "isFraud").first()["scale_pos_weight"]
    path = write_manifest(spark, training_config(weight, "data"), workspace(spark, "config"))
    return read_config(spark, path).select(
        F.col("gnn_config.hidden_dim").cast("int").alias("hidden_dim"),
        F.col("xgb_config.max_depth").cast("int").alias("max_depth"),
        F.col("xgb_config.n_estimators").cast("int").alias("n_estimators"),
        F.round("xgb_config.scale_pos_weight", 6).alias("scale_pos_weight"),
    )

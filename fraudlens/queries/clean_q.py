"""Projections, filters, predicates (P1-P17) and scalar functions (section G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens import bindings as b
from fraudlens.functions import scalars as s
from fraudlens.functions.vectors import padded
from fraudlens.operators import clean as c
from fraudlens.operators.joins import merge_identity, semi
from fraudlens.queries.base import query, split_txn
from fraudlens.schema import FeatureSpec, cols_by_dtype, infer_roles, select_existing


def _merged(spark, d):
    return merge_identity(b.txn(spark, d), b.idn(spark, d))


@query("p01_select_existing", "SELECT P_emaildomain, TransactionID, D1 FROM txn")
def p01(spark, d):
    return select_existing(b.txn(spark, d), ["P_emaildomain", "R_emaildomain", "TransactionID", "D1", "D2"])


@query("p02_null_placeholders", """
    SELECT TransactionID, CASE WHEN P_emaildomain IN ('unknown', 'Unknown', 'UNKN') THEN NULL ELSE P_emaildomain END
           AS P_emaildomain, card4 FROM txn""")
def p02(spark, d):
    return c.null_placeholders(b.txn(spark, d)).select("TransactionID", "P_emaildomain", "card4")


@query("p03_zero_default", """
    SELECT TransactionID, coalesce(TransactionAmt, 0.0) AS TransactionAmt, coalesce(D1, 0.0) AS D1 FROM txn""")
def p03(spark, d):
    return c.zero_defaults(b.txn(spark, d), ["TransactionAmt", "D1"]).select("TransactionID", "TransactionAmt", "D1")


@query("p04_infer_roles", """
    SELECT 'TransactionDT' AS column, CASE WHEN count(DISTINCT TransactionDT) < 20 THEN 'categorical' ELSE 'numerical' END AS role FROM merged
    UNION ALL SELECT 'TransactionAmt', CASE WHEN count(DISTINCT TransactionAmt) < 20 THEN 'categorical' ELSE 'numerical' END FROM merged
    UNION ALL SELECT 'ProductCD', 'categorical'
    UNION ALL SELECT 'card1', CASE WHEN count(DISTINCT card1) < 20 THEN 'categorical' ELSE 'numerical' END FROM merged
    UNION ALL SELECT 'card2', CASE WHEN count(DISTINCT card2) < 20 THEN 'categorical' ELSE 'numerical' END FROM merged
    UNION ALL SELECT 'card4', 'categorical'
    UNION ALL SELECT 'P_emaildomain', 'categorical'
    UNION ALL SELECT 'C1', CASE WHEN count(DISTINCT C1) < 20 THEN 'categorical' ELSE 'numerical' END FROM merged
    UNION ALL SELECT 'D1', CASE WHEN count(DISTINCT D1) < 20 THEN 'categorical' ELSE 'numerical' END FROM merged
    UNION ALL SELECT 'DeviceType', 'categorical'
    UNION ALL SELECT 'DeviceInfo', 'categorical'
    UNION ALL SELECT 'id_01', CASE WHEN count(DISTINCT id_01) < 20 THEN 'categorical' ELSE 'numerical' END FROM merged""")
def p04(spark, d):
    roles = infer_roles(_merged(spark, d), exclude=["TransactionID", "isFraud"])
    return spark.createDataFrame(list(roles.items()), "column string, role string")


@query("p05_fixed_roles", """
    SELECT TransactionID, ProductCD, CAST(card1 AS VARCHAR) AS card1, CAST(card2 AS VARCHAR) AS card2, card4, P_emaildomain,
           DeviceType, DeviceInfo, TransactionAmt, CAST(C1 AS DOUBLE) AS C1, D1, id_01, isFraud FROM merged""")
def p05(spark, d):
    rows = _merged(spark, d)
    spec = FeatureSpec.fixed(rows)
    return c.cast_roles(rows, spec).select("TransactionID", *spec.columns())


@query("p06_fill_categorical", """
    SELECT TransactionID, coalesce(DeviceType, 'missing') AS DeviceType, coalesce(DeviceInfo, 'missing') AS DeviceInfo,
           coalesce(CASE WHEN P_emaildomain IN ('unknown', 'Unknown', 'UNKN') THEN NULL ELSE P_emaildomain END, 'missing')
           AS P_emaildomain FROM merged""")
def p06(spark, d):
    cols = ["DeviceType", "DeviceInfo", "P_emaildomain"]
    return c.fill_categorical(c.null_placeholders(_merged(spark, d)), cols).select("TransactionID", *cols)


@query("p07_median_impute_train", """
    WITH m AS (SELECT median(TransactionAmt) AS ma, median(D1) AS md FROM split WHERE split = 'train')
    SELECT TransactionID, split, coalesce(TransactionAmt, ma) AS TransactionAmt, coalesce(D1, md) AS D1 FROM split, m""")
def p07(spark, d):
    rows = split_txn(spark, d, "TransactionAmt", "D1")
    filled = c.MedianImputer(["TransactionAmt", "D1"], "train").fit(rows).transform(rows)
    return filled.select("TransactionID", "split", "TransactionAmt", "D1")


@query("p07_median_impute_all", """
    WITH m AS (SELECT median(TransactionAmt) AS ma, median(D1) AS md FROM txn)
    SELECT TransactionID, coalesce(TransactionAmt, ma) AS TransactionAmt, coalesce(D1, md) AS D1 FROM txn, m""")
def p07_all(spark, d):
    rows = b.txn(spark, d)
    filled = c.MedianImputer(["TransactionAmt", "D1"], "all").fit(rows).transform(rows)
    return filled.select("TransactionID", "TransactionAmt", "D1")


@query("p08_simplify_device", """
    SELECT TransactionID, coalesce(split_part(lower(DeviceInfo), '/', 1), 'unknown') AS DeviceInfo_simple FROM merged""")
def p08(spark, d):
    return c.add_simple_device(_merged(spark, d)).select("TransactionID", "DeviceInfo_simple")


@query("p09_ensure_column", "SELECT TransactionID, card4, 'unknown' AS DeviceType FROM txn")
def p09(spark, d):
    rows = c.ensure_column(c.ensure_column(b.txn(spark, d), "DeviceType", "unknown"), "card4", "unknown")
    return rows.select("TransactionID", "card4", "DeviceType")


@query("p10_normalize_label", "SELECT TransactionID, isFraud AS is_fraud FROM txn")
def p10(spark, d):
    return c.normalize_label(b.txn(spark, d)).select("TransactionID", "is_fraud")


@query("p11_features_only", """
    SELECT TransactionID, TransactionAmt, D1, C1, card1 FROM txn WHERE TransactionAmt IS NOT NULL AND D1 IS NOT NULL""")
def p11(spark, d):
    rows = c.drop_missing_keys(b.txn(spark, d), ["TransactionAmt", "D1"])
    return c.features_only(rows, "isFraud", "TransactionDT", "ProductCD", "card2", "card4", "P_emaildomain")


@query("p12_cols_by_dtype", """
    SELECT TransactionID, ProductCD, card4, P_emaildomain, DeviceType, DeviceInfo FROM merged""")
def p12(spark, d):
    rows = _merged(spark, d)
    return rows.select("TransactionID", *cols_by_dtype(rows, "string"))


@query("p13_cast_roles", """
    SELECT TransactionID, CAST(card1 AS VARCHAR) AS card1, CAST(C1 AS DOUBLE) AS C1,
           TRY_CAST(substr(ProductCD, 1, 1) AS DOUBLE) AS product_rank, TRY_CAST(P_emaildomain AS DOUBLE) AS domain_number FROM txn""")
def p13(spark, d):
    rows = b.txn(spark, d).withColumns(
        {"product_rank": F.substring("ProductCD", 1, 1), "domain_number": F.col("P_emaildomain")}
    )
    spec = FeatureSpec(("card1",), ("C1", "product_rank", "domain_number"))
    return c.cast_roles(rows, spec).select("TransactionID", *spec.features)


@query("p14_entity_key", """
    SELECT TransactionID, 'card_' || card1 || '_' || card2 || '_unknown_' || card4 AS card_key,
           'device_' || coalesce(DeviceType, 'unknown') || '_' || coalesce(split_part(lower(DeviceInfo), '/', 1), 'unknown')
           AS device_key FROM merged""")
def p14(spark, d):
    rows = c.add_simple_device(c.ensure_column(_merged(spark, d), "card3", None))
    return rows.select(
        "TransactionID",
        s.entity_key("card", F.col("card1"), F.col("card2"), F.col("card3"), F.col("card4")).alias("card_key"),
        s.entity_key("device", F.col("DeviceType"), F.col("DeviceInfo_simple")).alias("device_key"),
    )


@query("p15_predicates", """
    SELECT id, CAST(score_a >= 50 AS INTEGER) AS predicted FROM scored WHERE label = 1""")
def p15(spark, d):
    hit = (F.col("score_a") >= 50).cast("int")
    return b.scored(spark, d).filter("label = 1").select("id", hit.alias("predicted"))


@query("p16_membership", """
    SELECT TransactionID, ProductCD FROM txn
    WHERE ProductCD IN ('1-URGENT', '5-LOW') AND TransactionID IN (SELECT TransactionID FROM idn)""")
def p16(spark, d):
    rows = b.txn(spark, d).filter(F.col("ProductCD").isin("1-URGENT", "5-LOW"))
    return semi(rows, b.idn(spark, d), "TransactionID").select("TransactionID", "ProductCD")


@query("p17_assemble_columns", """
    SELECT TransactionID, ProductCD, CAST(card1 AS VARCHAR) AS card1, card4, DeviceType, TransactionAmt,
           CAST(C1 AS DOUBLE) AS C1, isFraud FROM merged""")
def p17(spark, d):
    spec = FeatureSpec(("TransactionID", "ProductCD", "card1", "card4", "DeviceType"), ("TransactionAmt", "C1"))
    rows = c.assemble_columns(_merged(spark, d), spec)
    return c.cast_roles(rows, spec).withColumn("TransactionID", F.col("TransactionID").cast("long"))


@query("f01_scalars_string", """
    SELECT page_id, lower(url) AS low, trim(url) AS trimmed, split_part(url, '://', 1) AS scheme, string_split(url, '/')[3] AS host,
           url LIKE 'https%' AS secure, url LIKE '%.html' AS is_html, url LIKE '%news%' AS has_news,
           regexp_matches(url, '(?i)error|fail|blog') AS flagged,
           'page_' || page_id || '_' || length(html) AS page_key FROM pages""")
def f01_string(spark, d):
    url = F.col("url")
    return b.table(spark, d, "pages").select(
        "page_id",
        F.lower(url).alias("low"),
        F.trim(url).alias("trimmed"),
        F.split(url, "://", 2)[0].alias("scheme"),
        s.path_segment(url, 2).alias("host"),
        url.startswith("https").alias("secure"),
        url.endswith(".html").alias("is_html"),
        url.contains("news").alias("has_news"),
        url.rlike("(?i)error|fail|blog").alias("flagged"),
        s.entity_key("page", F.col("page_id"), F.length("html")).alias("page_key"),
    )


@query("f01_scalars_time", """
    SELECT event_id, strftime(ts, '%Y%m%d-%H%M%S') AS job_stamp, strftime(ts, '%d-%b-%Y-%H-%M-%S') AS report_stamp,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds,
           CAST(epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS DOUBLE) / 1e6 AS since_midnight,
           epoch_ms(CAST(epoch(date_trunc('second', ts)) AS BIGINT) * 1000 + event_id % 1000) AS from_millis FROM events""")
def f01_time(spark, d):
    ts = F.col("ts")
    return b.table(spark, d, "events").select(
        "event_id",
        s.job_stamp(ts).alias("job_stamp"),
        s.report_stamp(ts).alias("report_stamp"),
        s.iso_time(ts).alias("iso"),
        s.epoch_seconds(ts).alias("seconds"),
        s.duration_seconds(ts.cast("date").cast("timestamp_ntz"), ts).alias("since_midnight"),
        s.from_epoch_millis(s.epoch_seconds(ts) * 1000 + F.col("event_id") % 1000).alias("from_millis"),
    )


@query("f01_scalars_math", """
    SELECT event_id, CAST(floor(value * 0.7) AS BIGINT) AS truncated, greatest(1, CAST(value AS BIGINT) - 50) AS guarded,
           abs(value - 50) AS gap, round(1 / (1 + exp(-(value - 50) / 10)), 6) AS sigmoid, greatest(0.0::DOUBLE, value - 50) AS relu,
           round(value, 2) AS rounded, value / 1e6 AS mb, CASE WHEN value = 0 THEN NULL ELSE round((50 / value - 1) * 100, 6) END AS percent
    FROM (SELECT event_id, floor(value * 100) / 100 AS value FROM events)""")
def f01_math(spark, d):
    rows = b.table(spark, d, "events").select("event_id", (F.floor(F.col("value") * 100).cast("double") / 100).alias("value"))
    v = F.col("value")
    return rows.select(
        "event_id",
        F.floor(v * F.lit(0.7)).alias("truncated"),
        F.greatest(F.lit(1).cast("long"), F.rint(v).cast("long") - 50).alias("guarded"),
        F.abs(v - 50).alias("gap"),
        F.round(s.sigmoid((v - 50) / 10), 6).alias("sigmoid"),
        s.relu(v - 50).alias("relu"),
        F.round(v, 2).alias("rounded"),
        s.megabytes(v).alias("mb"),
        F.round(s.percent_change(F.lit(50.0), v), 6).alias("percent"),
    )


@query("f01_scalars_null", """
    SELECT TransactionID, coalesce(TransactionAmt, D1, 0.0) AS amount, coalesce(DeviceType, 'N/A') AS device FROM merged""")
def f01_null(spark, d):
    rows = _merged(spark, d)
    return rows.select(
        "TransactionID",
        F.coalesce("TransactionAmt", "D1", F.lit(0.0)).alias("amount"),
        F.coalesce("DeviceType", F.lit("N/A")).alias("device"),
    )


@query("f01_scalars_array", """
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
    SELECT vec_id, len(list_concat(list_concat(list_resize([]::DOUBLE[], 4, 0.0), e[1:3]), list_resize([]::DOUBLE[], 9, 0.0))) AS n,
           round(e[1], 6) AS slot_4, round(e[3], 6) AS slot_6, 0.0::DOUBLE AS slot_7, round(list_sum(e[1:32]), 6) AS first_half FROM v""")
def f01_array(spark, d):
    e = F.col("embedding").cast("array<double>")
    made = padded([F.get(e, F.lit(i)) for i in range(3)], 4, 16)
    total = F.aggregate(F.slice(e, 1, 32), F.lit(0.0), lambda acc, x: acc + x)
    return b.table(spark, d, "embeddings").select(
        "vec_id",
        F.size(made).cast("long").alias("n"),
        F.round(F.get(made, F.lit(4)), 6).alias("slot_4"),
        F.round(F.get(made, F.lit(6)), 6).alias("slot_6"),
        F.get(made, F.lit(7)).alias("slot_7"),
        F.round(total, 6).alias("first_half"),
    )


@query("f01_scalars_map", """
    SELECT TransactionID, CASE isFraud WHEN 0 THEN 0.5 WHEN 1 THEN 7.5 END::DOUBLE AS weight FROM txn""")
def f01_map(spark, d):
    weights = F.create_map(F.lit(0), F.lit(0.5), F.lit(1), F.lit(7.5))
    return b.txn(spark, d).select("TransactionID", F.element_at(weights, F.col("isFraud")).alias("weight"))


@query("f01_scalars_json", """
    SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS doc,
           regexp_matches(event_type, 'err|click') AS tested FROM events""")
def f01_json(spark, d):
    return b.table(spark, d, "events").select(
        "event_id",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.to_json(F.struct("event_id", "event_type")).alias("doc"),
        F.col("event_type").rlike("err|click").alias("tested"),
    )

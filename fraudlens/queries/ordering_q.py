"""Order, splits, ranking, encoding and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens import bindings as b
from fraudlens.operators import ordering as o
from fraudlens.operators.encode import LabelEncoder, Scaler
from fraudlens.operators.graph import node_offsets, vocab_sizes
from fraudlens.operators.joins import merge_identity
from fraudlens.operators.metrics import avg_rank
from fraudlens.plans.preprocess import preprocess
from fraudlens.queries.base import ORDER, TRAIN_SHARE, card_email_vocabs, clean_txn, query, split_txn, train_rows
from fraudlens.session import settle


@query("w01_global_row_id", """
    SELECT TransactionID, TransactionDT, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS row_id FROM txn""")
def w01(spark, d):
    return o.global_row_id(b.txn(spark, d).select("TransactionID", "TransactionDT"), ORDER)


@query("w02_time_split", "SELECT TransactionID, split FROM split")
def w02(spark, d):
    return split_txn(spark, d, "TransactionID").select("TransactionID", "split")


@query("w02_three_way_split", """
    SELECT TransactionID, CASE WHEN pos < CAST(floor(n_all * CAST(0.6 AS DOUBLE)) AS BIGINT) THEN 'train'
      WHEN pos < CAST(floor(n_all * (CAST(0.6 AS DOUBLE) + CAST(0.2 AS DOUBLE))) AS BIGINT) THEN 'valid' ELSE 'test' END AS split FROM placed""")
def w02_three(spark, d):
    rows = settle(clean_txn(spark, d).select(*ORDER), "txn")
    return o.three_way_split(rows, (0.6, 0.2), *ORDER).select("TransactionID", "split")


@query("w03_stratified_split", """
    WITH h AS (SELECT TransactionID, isFraud,
                      row_number() OVER (PARTITION BY isFraud ORDER BY md5(TransactionID || '|42'), TransactionID) AS rn,
                      count(*) OVER (PARTITION BY isFraud) AS n FROM txn)
    SELECT TransactionID, isFraud, CASE WHEN rn <= ceil(n * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM h""")
def w03(spark, d):
    rows = settle(b.txn(spark, d).select("TransactionID", "isFraud"), "txn")
    return o.stratified_split(rows, "isFraud", "TransactionID", 0.2)


@query("w04_first_seen_vocab", "SELECT card1, idx, n FROM cards")
def w04(spark, d):
    return o.first_seen_vocab(train_rows(spark, d, "card1"), ["card1"], ORDER)


@query("w05_label_encode", """
    SELECT TransactionID, dense_rank() OVER (ORDER BY coalesce(P_emaildomain, 'missing')) - 1 AS P_emaildomain,
           dense_rank() OVER (ORDER BY CAST(card1 AS VARCHAR)) - 1 AS card1,
           dense_rank() OVER (ORDER BY coalesce(DeviceInfo, 'missing')) - 1 AS DeviceInfo
    FROM clean LEFT JOIN idn USING (TransactionID)""")
def w05(spark, d):
    rows = settle(merge_identity(clean_txn(spark, d), b.idn(spark, d)), "merged")
    cols = ["P_emaildomain", "card1", "DeviceInfo"]
    return LabelEncoder(cols, missing="missing").fit(rows).transform(rows).select("TransactionID", *cols)


@query("w06_label_encode_unseen", """
    WITH k AS (SELECT card1, row_number() OVER (ORDER BY CAST(card1 AS VARCHAR)) - 1 AS code FROM cards),
         e AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM
               (SELECT DISTINCT coalesce(nullif(P_emaildomain, 'missing'), 'unknown') AS v FROM train))
    SELECT TransactionID, coalesce(k.code, 0) AS card1, coalesce(e.code, (SELECT code FROM e WHERE v = 'unknown'), 0) AS P_emaildomain
    FROM split LEFT JOIN k USING (card1) LEFT JOIN e ON e.v = coalesce(split.P_emaildomain, 'unknown')""")
def w06(spark, d):
    rows = split_txn(spark, d, "card1", "P_emaildomain")
    encoder = LabelEncoder(["card1", "P_emaildomain"]).fit(rows.filter("split = 'train'"))
    return encoder.transform(rows).select("TransactionID", "card1", "P_emaildomain")


@query("w06_label_encode_reserved", """
    WITH k AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM
               (SELECT CAST(card1 AS VARCHAR) AS v FROM cards UNION SELECT '__UNKNOWN__'))
    SELECT TransactionID, coalesce(k.code, (SELECT code FROM k WHERE v = '__UNKNOWN__')) AS card1
    FROM split LEFT JOIN k ON k.v = CAST(split.card1 AS VARCHAR)""")
def w06_reserved(spark, d):
    rows = split_txn(spark, d, "card1")
    encoder = LabelEncoder(["card1"], reserve_unseen=True).fit(rows.filter("split = 'train'"))
    return encoder.transform(rows).select("TransactionID", "card1")


@query("w07_node_offsets", """
    SELECT 'card' AS ntype, 0::BIGINT AS first_id FROM sizes UNION ALL SELECT 'email', n_cards FROM sizes
    UNION ALL SELECT 'txn', n_cards + n_emails FROM sizes""")
def w07(spark, d):
    cards, emails = card_email_vocabs(train_rows(spark, d, "card1"))
    found = node_offsets(vocab_sizes({"card": cards, "email": emails}))
    return spark.createDataFrame(list(found.items()), "ntype string, first_id bigint")


@query("w11_avg_rank", """
    SELECT id, rank() OVER (ORDER BY score_b) + (count(*) OVER (PARTITION BY score_b) - 1) / 2.0::DOUBLE AS rank FROM scored""")
def w11(spark, d):
    return avg_rank(b.scored(spark, d), "score_b").select("id", "rank")


@query("w12_top_k", """
    SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS position
    FROM customer QUALIFY position <= 20""")
def w12(spark, d):
    rows = b.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return o.top_k(rows, "c_acctbal", 20, "c_custkey").withColumn("position", F.col("position").cast("long"))


@query("w13_latest", "SELECT event_id, ts, status FROM log ORDER BY ts DESC, event_id DESC LIMIT 1")
def w13(spark, d):
    return o.latest(b.log(spark, d), ["ts", "event_id"]).select("event_id", "ts", "status")


@query("w13_latest_per_stream", """
    SELECT stream, max(event_id) AS event_id, arg_max(status, (ts, event_id)) AS status FROM log
    WHERE (stream, ts) IN (SELECT (stream, max(ts)) FROM log GROUP BY stream) GROUP BY stream""")
def w13_stream(spark, d):
    return o.latest(b.log(spark, d), ["ts", "event_id"], ["stream"]).select("stream", "event_id", "status")


@query("w14_status_changes", """
    SELECT event_id, stream, status, previous_status FROM (
      SELECT *, lag(status) OVER (PARTITION BY stream ORDER BY ts, event_id) AS previous_status FROM log)
    WHERE previous_status IS DISTINCT FROM status""")
def w14(spark, d):
    rows = b.log(spark, d).select("event_id", "stream", "status", "ts")
    return o.status_changes(rows, ["stream"], ["ts", "event_id"], "status").drop("ts")


@query("w15_early_stop", """
    WITH r AS (SELECT *, row_number() OVER (ORDER BY epoch) AS i,
                      max(auc) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM history),
         g AS (SELECT *, max(auc) OVER (ORDER BY epoch) AS best_metric,
                      max(CASE WHEN prior IS NULL OR auc > prior THEN epoch END) OVER (ORDER BY epoch) AS best_epoch,
                      i - max(CASE WHEN prior IS NULL OR auc > prior THEN i END) OVER (ORDER BY epoch) AS waited FROM r)
    SELECT epoch, auc, best_metric, best_epoch, waited,
           coalesce(epoch = (SELECT min(epoch) FROM g WHERE waited >= 5), false) AS stop FROM g""")
def w15(spark, d):
    return o.early_stop(settle(b.history(spark, d), "history"), "epoch", "auc", 5)


@query("w15_stop_summary", """
    WITH r AS (SELECT *, row_number() OVER (ORDER BY epoch) AS i,
                      max(auc) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM history),
         g AS (SELECT *, max(auc) OVER (ORDER BY epoch) AS best_metric,
                      max(CASE WHEN prior IS NULL OR auc > prior THEN epoch END) OVER (ORDER BY epoch) AS best_epoch,
                      i - max(CASE WHEN prior IS NULL OR auc > prior THEN i END) OVER (ORDER BY epoch) AS waited FROM r)
    SELECT best_epoch, best_metric, epoch AS stop_epoch FROM g
    WHERE epoch = coalesce((SELECT min(epoch) FROM g WHERE waited >= 5), (SELECT max(epoch) FROM g))""")
def w15_summary(spark, d):
    return o.stop_summary(o.early_stop(settle(b.history(spark, d), "history"), "epoch", "auc", 5), "epoch")


@query("w16_temporal_edges", """
    SELECT card1, src, dst FROM (
      SELECT card1, lag(TransactionID) OVER (PARTITION BY card1 ORDER BY TransactionDT, TransactionID) AS src, TransactionID AS dst FROM txn)
    WHERE src IS NOT NULL""")
def w16(spark, d):
    return o.temporal_edges(b.txn(spark, d).select("card1", *ORDER), ["card1"], ORDER, "TransactionID")


_SCALED = """
    SELECT TransactionID, round(coalesce((D1 - m) / nullif(s, 0), D1 - m), 6) AS D1, round(coalesce((C1 - mc) / nullif(sc, 0), C1 - mc), 6) AS C1
    FROM {rows}, (SELECT avg(D1) AS m, stddev_pop(D1) AS s, avg(C1) AS mc, stddev_pop(C1) AS sc FROM {rows} {where})"""


def _scaled(rows, fit_on):
    out = Scaler(["D1", "C1"], fit_on).fit(rows).transform(rows)
    return out.select("TransactionID", F.round("D1", 6).alias("D1"), F.round("C1", 6).alias("C1"))


@query("m01_standardise_train", _SCALED.format(rows="split", where="WHERE split = 'train'"))
def m01_train(spark, d):
    return _scaled(split_txn(spark, d, "D1", "C1"), "train")


@query("m01_standardise_all", _SCALED.format(rows="txn", where=""))
def m01_all(spark, d):
    return _scaled(settle(b.txn(spark, d), "txn"), "all")


_PREPROCESS = """
    WITH r AS (SELECT split.* EXCLUDE (pos), DeviceType, DeviceInfo, id_01 FROM split LEFT JOIN idn USING (TransactionID)),
         f AS (SELECT * FROM r {fit}),
         med AS (SELECT median(TransactionAmt) AS ma, median(D1) AS md, median(card1) AS mc FROM f),
         g AS (SELECT TransactionID, isFraud, split, coalesce(CAST(card1 AS VARCHAR), 'missing') AS key_card1,
                      coalesce(P_emaildomain, 'missing') AS key_email, coalesce(TransactionAmt, ma) AS amt, coalesce(D1, md) AS d1,
                      coalesce(card1, mc) AS card1, ProductCD AS product, coalesce(P_emaildomain, 'missing') AS email,
                      coalesce(DeviceInfo, 'missing') AS device FROM r, med),
         gf AS (SELECT * FROM g {fit}),
         st AS (SELECT avg(amt) AS ma, stddev_pop(amt) AS sa, avg(d1) AS md, stddev_pop(d1) AS sd, avg(card1) AS mc, stddev_pop(card1) AS sc FROM gf),
         ep AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT product AS v FROM gf)),
         ee AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT email AS v FROM gf)),
         ed AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT device AS v FROM gf))
    SELECT TransactionID, isFraud, split, key_card1, key_email AS key_P_emaildomain, round((amt - ma) / sa, 6) AS TransactionAmt,
           round((d1 - md) / sd, 6) AS D1, round((card1 - mc) / sc, 6) AS card1, coalesce(ep.code, 0) AS ProductCD,
           coalesce(ee.code, 0) AS P_emaildomain, coalesce(ed.code, 0) AS DeviceInfo
    FROM g, st LEFT JOIN ep ON ep.v = product LEFT JOIN ee ON ee.v = email LEFT JOIN ed ON ed.v = device"""


def _prepared(spark, d, fit_on):
    rows = preprocess(b.txn(spark, d), b.idn(spark, d), frac=TRAIN_SHARE, fit_on=fit_on).rows
    return rows.select(
        "TransactionID", "isFraud", "split", "key_card1", "key_P_emaildomain",
        *[F.round(c, 6).alias(c) for c in ("TransactionAmt", "D1", "card1")],
        "ProductCD", "P_emaildomain", "DeviceInfo",
    )


@query("m10_preprocess_fit_train", _PREPROCESS.format(fit="WHERE split = 'train'"))
def m10_train(spark, d):
    return _prepared(spark, d, "train")


@query("m10_preprocess_fit_all", _PREPROCESS.format(fit=""))
def m10_all(spark, d):
    return _prepared(spark, d, "all")

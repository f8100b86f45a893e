"""Joins (J1-J11) and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens import bindings as b
from fraudlens.operators.entity import attach_stats, entity_stats
from fraudlens.operators.joins import anti, attach_embedding, attach_weights, filter_unseen, lookup, merge_identity, semi, take
from fraudlens.operators.profile import class_weights
from fraudlens.queries.base import card_email_vocabs, named_email, numbered_train, query, split_txn, steady, steady_sql
from fraudlens.session import settle


@query("j01_merge_identity", "SELECT * FROM merged")
def j01(spark, d):
    return merge_identity(b.txn(spark, d), b.idn(spark, d))


@query("j01_merge_null_safe", """
    SELECT a.TransactionAmt, a.n_a, c.n_b FROM (SELECT TransactionAmt, count(*) AS n_a FROM txn GROUP BY 1) a
    LEFT JOIN (SELECT TransactionAmt, count(*) AS n_b FROM txn WHERE isFraud = 1 GROUP BY 1) c
      ON a.TransactionAmt IS NOT DISTINCT FROM c.TransactionAmt""")
def j01_null_safe(spark, d):
    """Missing keys match each other, as data-frame merges do."""
    rows = b.txn(spark, d)
    every = rows.groupBy("TransactionAmt").agg(F.count("*").alias("n_a"))
    fraud = rows.filter("isFraud = 1").groupBy("TransactionAmt").agg(F.count("*").alias("n_b"))
    return merge_identity(every, fraud, "TransactionAmt", null_safe=True)


@query("j02_semi", "SELECT * FROM idn WHERE TransactionID IN (SELECT TransactionID FROM txn WHERE isFraud = 1)")
def j02(spark, d):
    return semi(b.idn(spark, d), b.txn(spark, d).filter("isFraud = 1"), "TransactionID")


@query("j03_filter_unseen", """
    SELECT TransactionID, card1, P_emaildomain FROM test
    WHERE card1 IN (SELECT card1 FROM cards) AND P_emaildomain IN (SELECT P_emaildomain FROM emails)""")
def j03(spark, d):
    rows = split_txn(spark, d, "card1", "P_emaildomain")
    cards, emails = card_email_vocabs(named_email(rows.filter("split = 'train'")))
    kept, _ = filter_unseen(named_email(rows.filter("split = 'test'")), {"card1": cards, "P_emaildomain": emails})
    return kept.select("TransactionID", "card1", "P_emaildomain")


@query("j03_unseen_report", """
    SELECT count(*) AS rows_before, count(*) FILTER (WHERE seen) AS rows_after, count(*) FILTER (WHERE NOT seen) AS rows_dropped
    FROM (SELECT card1 IN (SELECT card1 FROM cards) AND P_emaildomain IN (SELECT P_emaildomain FROM emails) AS seen FROM test)""")
def j03_report(spark, d):
    rows = split_txn(spark, d, "card1", "P_emaildomain")
    cards, emails = card_email_vocabs(named_email(rows.filter("split = 'train'")))
    return filter_unseen(named_email(rows.filter("split = 'test'")), {"card1": cards, "P_emaildomain": emails})[1]


@query("j04_dictionary_encode", """
    SELECT TransactionID, cards.idx AS card_id FROM split JOIN cards USING (card1)""")
def j04(spark, d):
    rows = split_txn(spark, d, "card1", "P_emaildomain")
    cards, _ = card_email_vocabs(named_email(rows.filter("split = 'train'")))
    found = lookup(rows, cards.select("card1", F.col("idx").alias("card_id")), "card1", "inner")
    return found.select("TransactionID", "card_id")


@query("j05_optional_lookup", """
    SELECT TransactionID, cards.idx AS card_id FROM split LEFT JOIN cards USING (card1)""")
def j05(spark, d):
    rows = split_txn(spark, d, "card1", "P_emaildomain")
    cards, _ = card_email_vocabs(named_email(rows.filter("split = 'train'")))
    found = lookup(rows, cards.select("card1", F.col("idx").alias("card_id")), "card1", "left")
    return found.select("TransactionID", "card_id")


@query("j06_attach_stats", f"""
    WITH s AS (SELECT card1, avg(TransactionAmt) AS am, count(TransactionAmt) AS ac, avg(isFraud) AS fr, sum(isFraud) AS fc
               FROM split WHERE split = 'train' GROUP BY 1)
    SELECT TransactionID, {steady_sql("coalesce(am, 0)", 4)} AS amt_mean, coalesce(ac, 0) AS amt_count, round(coalesce(fr, 0), 6) AS fraud_rate,
           CAST(coalesce(fc, 0) AS BIGINT) AS fraud_count FROM split LEFT JOIN s USING (card1)""")
def j06(spark, d):
    rows = split_txn(spark, d, "card1", "TransactionAmt", "isFraud")
    stats = settle(entity_stats(rows.filter("split = 'train'"), ["card1"], missing=None), "stats")
    joined = attach_stats(rows, stats, ["card1"])
    return joined.select(
        "TransactionID", steady(F.col("amt_mean"), 4).alias("amt_mean"), "amt_count", F.round("fraud_rate", 6).alias("fraud_rate"), "fraud_count"
    )


@query("j07_attach_embedding", """
    SELECT TransactionID, coalesce(emb, list_resize([]::DOUBLE[], 32, 0.0))[1] AS first, coalesce(emb, list_resize([]::DOUBLE[], 32, 0.0))[32] AS last,
           emb IS NULL AS unseen FROM txn LEFT JOIN card_emb USING (card1)""")
def j07(spark, d):
    emb = b.card_embedding(spark, d).withColumn("known", F.lit(True))
    rows = attach_embedding(b.txn(spark, d), emb, "card1", "emb", 32)
    return rows.select(
        "TransactionID", F.col("emb")[0].alias("first"), F.col("emb")[31].alias("last"), F.col("known").isNull().alias("unseen")
    )


@query("j08_take_split", "SELECT TransactionID, TransactionDT, isFraud FROM split WHERE split = 'test'")
def j08(spark, d):
    return take(split_txn(spark, d, "isFraud"), "test").select("TransactionID", "TransactionDT", "isFraud")


@query("j09_attach_weights", """
    WITH w AS (SELECT isFraud, sum(count(*)) OVER () / (count(*) OVER () * CAST(count(*) AS DOUBLE)) AS cw FROM txn GROUP BY 1)
    SELECT TransactionID, round(cw, 6) AS class_weight FROM txn JOIN w USING (isFraud)""")
def j09(spark, d):
    rows = b.txn(spark, d)
    weighted = attach_weights(rows, settle(class_weights(rows, "isFraud"), "weights"), "isFraud")
    return weighted.select("TransactionID", F.round("class_weight", 6).alias("class_weight"))


@query("j10_required_minus_existing", """
    SELECT TransactionID FROM txn WHERE TransactionID NOT IN (SELECT TransactionID FROM idn)""")
def j10(spark, d):
    return anti(b.txn(spark, d).select("TransactionID"), b.idn(spark, d), "TransactionID")


@query("j11_features_on_edges", f"""
    WITH n AS (SELECT n_cards + n_emails + row_id AS src, coalesce(D1, 0.0) AS x FROM train, sizes)
    SELECT dst, count(*) AS n, {steady_sql("sum(x)", 4)} AS total FROM edges JOIN n USING (src) GROUP BY dst""")
def j11(spark, d):
    from fraudlens.functions.scalars import zero_default
    from fraudlens.operators.graph import build_edges_card_email, node_offsets, vocab_sizes

    train = numbered_train(spark, d, "D1")
    cards, emails = card_email_vocabs(train)
    start = node_offsets(vocab_sizes({"card": cards, "email": emails}))["txn"]
    feats = settle(train.select((F.col("row_id") + start).alias("src"), zero_default(F.col("D1")).alias("x")), "features")
    edges = build_edges_card_email(train, cards, emails)
    return lookup(edges, feats, "src", "inner").groupBy("dst").agg(
        F.count("*").alias("n"), steady(F.sum("x"), 4).alias("total")
    )


@query("u01_union_edges", """
    SELECT kind, count(*) AS n, CAST(sum(a) AS BIGINT) AS sum_a, CAST(sum(c) AS BIGINT) AS sum_c FROM (
      SELECT 'customer-nation' AS kind, c_custkey AS a, c_nationkey AS c FROM customer
      UNION ALL SELECT 'supplier-nation', s_suppkey, s_nationkey FROM supplier
      UNION ALL SELECT 'order-customer', o_orderkey, o_custkey FROM orders) GROUP BY kind""")
def u01(spark, d):
    from fraudlens.operators.graph import union_edges

    kinds = [("customer", "c_custkey", "c_nationkey", "customer-nation"), ("supplier", "s_suppkey", "s_nationkey", "supplier-nation"),
             ("orders", "o_orderkey", "o_custkey", "order-customer")]
    parts = [
        b.table(spark, d, t).select(F.lit(kind).alias("kind"), F.col(x).cast("long").alias("a"), F.col(y).cast("long").alias("c"))
        for t, x, y, kind in kinds
    ]
    return union_edges(parts).groupBy("kind").agg(F.count("*").alias("n"), F.sum("a").alias("sum_a"), F.sum("c").alias("sum_c"))


@query("u02_union_nodes", """
    SELECT idx AS node_id, 'card' AS ntype, CAST(card1 AS VARCHAR) AS key FROM cards
    UNION ALL SELECT n_cards + idx, 'email', P_emaildomain FROM emails, sizes
    UNION ALL SELECT n_cards + n_emails + row_id, 'txn', CAST(row_id AS VARCHAR) FROM train, sizes""")
def u02(spark, d):
    from fraudlens.operators.graph import node_ids

    train = numbered_train(spark, d)
    cards, emails = card_email_vocabs(train)
    return node_ids({"card": cards, "email": emails}, {"card": ["card1"], "email": ["P_emaildomain"]}, train)


@query("u03_entities_not_seen", """
    SELECT DISTINCT card1 FROM test WHERE card1 NOT IN (SELECT card1 FROM cards)""")
def u03(spark, d):
    rows = split_txn(spark, d, "card1")
    return anti(rows.filter("split = 'test'").select("card1").distinct(), rows.filter("split = 'train'"), "card1")

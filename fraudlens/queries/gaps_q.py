"""Missing keys (G1, G8, G11, J3, J7): a missing one is an entity of its own in vocabularies, edges and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens import bindings as b
from fraudlens.operators import graph as g
from fraudlens.operators.joins import attach_embedding, filter_unseen
from fraudlens.operators.ordering import first_seen_vocab, global_row_id
from fraudlens.queries import graph_q  # noqa: F401
from fraudlens.queries.base import ORDER, VIEWS, query, split_txn

KEYS = ["card1", "card2"]
VIEWS["gaps"] = """
    SELECT TransactionID, TransactionDT, pos, split, TransactionAmt, C1, D1, CASE WHEN card1 % 7 <> 0 THEN card1 END AS card1,
           CASE WHEN card1 % 5 <> 0 THEN card2 END AS card2, P_emaildomain FROM split"""
VIEWS["gap_train"] = "SELECT *, pos AS row_id FROM gaps WHERE split = 'train'"
VIEWS["gap_cards"] = "SELECT card1, row_number() OVER (ORDER BY min(row_id)) - 1 AS idx FROM gap_train GROUP BY card1"
VIEWS["gap_emails"] = "SELECT P_emaildomain, row_number() OVER (ORDER BY min(row_id)) - 1 AS idx FROM gap_train GROUP BY P_emaildomain"
VIEWS["gap_sizes"] = "SELECT (SELECT count(*) FROM gap_cards) AS n_cards, (SELECT count(*) FROM gap_emails) AS n_emails"
VIEWS["gap_seen"] = """
    SELECT gaps.*, c.idx AS c, e.idx AS e FROM gaps JOIN gap_cards c ON gaps.card1 IS NOT DISTINCT FROM c.card1
    JOIN gap_emails e ON gaps.P_emaildomain IS NOT DISTINCT FROM e.P_emaildomain"""
# a vector for every pair of a card and its country, missing parts included
VIEWS["gap_emb"] = """
    SELECT card1, card2, CAST(embedding[1:32] AS DOUBLE[]) AS emb FROM (
      SELECT card1, card2, row_number() OVER (ORDER BY min(pos)) - 1 AS i FROM gaps WHERE split = 'train' GROUP BY card1, card2)
    JOIN embeddings ON vec_id = i"""


def gap_rows(spark, d, *cols):
    """Transactions with cards, countries and e-mail domains missing."""
    rows = split_txn(spark, d, "card1", "card2", "P_emaildomain", *cols)
    return rows.withColumns(
        {"card2": F.when(F.col("card1") % 5 != 0, F.col("card2")), "card1": F.when(F.col("card1") % 7 != 0, F.col("card1"))}
    )


def gap_vocabs(rows):
    train = rows.filter("split = 'train'")
    return {k: first_seen_vocab(train, [k], ORDER) for k in ("card1", "P_emaildomain")}


def gap_embedding(spark, d, rows):
    pairs = first_seen_vocab(rows.filter("split = 'train'"), KEYS, ORDER)
    vecs = b.table(spark, d, "embeddings").select(F.col("vec_id").alias("idx"), F.slice(F.col("embedding").cast("array<double>"), 1, 32).alias("emb"))
    return pairs.join(vecs, "idx").select(*KEYS, "emb")


@query("g01_edges_missing_keys", """
    SELECT unnest([c, t, t, e]) AS src, unnest([t, e, c, t]) AS dst
    FROM (SELECT c, n_cards + e AS e, n_cards + n_emails + pos AS t FROM gap_seen, gap_sizes WHERE split = 'train')""")
def g01_gaps(spark, d):
    rows = gap_rows(spark, d)
    vocabs = gap_vocabs(rows)
    train = global_row_id(rows.filter("split = 'train'"), ORDER, "row_id")
    return g.build_edges_card_email(train, vocabs["card1"], vocabs["P_emaildomain"])


@query("g11_test_graph_missing_keys", """
    WITH k AS (SELECT c, e, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS row_id FROM gap_seen WHERE split = 'test')
    SELECT unnest([c, t, t, e]) AS src, unnest([t, e, c, t]) AS dst FROM (SELECT c, n_cards + e AS e, n_cards + n_emails + row_id AS t FROM k, gap_sizes)""")
def g11_gaps(spark, d):
    rows = gap_rows(spark, d)
    vocabs = gap_vocabs(rows)
    return g.build_test_graph(rows.filter("split = 'test'"), vocabs["card1"], vocabs["P_emaildomain"], ORDER)[1]


@query("j03_unseen_missing_keys", """
    SELECT (SELECT count(*) FROM gaps WHERE split = 'test') AS rows_before, (SELECT count(*) FROM gap_seen WHERE split = 'test') AS rows_after,
           (SELECT count(*) FROM gaps WHERE split = 'test') - (SELECT count(*) FROM gap_seen WHERE split = 'test') AS rows_dropped""")
def j03_gaps(spark, d):
    rows = gap_rows(spark, d)
    return filter_unseen(rows.filter("split = 'test'"), gap_vocabs(rows))[1]


@query("j07_embedding_missing_keys", """
    SELECT TransactionID, coalesce(emb, list_resize([]::DOUBLE[], 32, 0.0))[1] AS first, coalesce(emb, list_resize([]::DOUBLE[], 32, 0.0))[32] AS last
    FROM gaps LEFT JOIN gap_emb ON gaps.card1 IS NOT DISTINCT FROM gap_emb.card1 AND gaps.card2 IS NOT DISTINCT FROM gap_emb.card2""")
def j07_gaps(spark, d):
    rows = gap_rows(spark, d)
    out = attach_embedding(rows, gap_embedding(spark, d, rows), KEYS, "emb", 32)
    return out.select("TransactionID", F.col("emb")[0].alias("first"), F.col("emb")[31].alias("last"))


@query("g08_features_missing_keys", """
    SELECT TransactionID, 81 AS n, coalesce(TransactionAmt, 0) AS amt, round(coalesce(list_sum(emb), 0), 6) AS card_part, 0.0::DOUBLE AS device_part
    FROM gaps LEFT JOIN gap_emb ON gaps.card1 IS NOT DISTINCT FROM gap_emb.card1 AND gaps.card2 IS NOT DISTINCT FROM gap_emb.card2""")
def g08_gaps(spark, d):
    rows = gap_rows(spark, d, "TransactionAmt", "C1", "D1")
    out = g.txn_features(rows, gap_embedding(spark, d, rows), None, KEYS)
    part = lambda at: F.aggregate(F.slice("features", at, 32), F.lit(0.0), lambda acc, x: acc + x)
    return out.select(
        "TransactionID", F.size("features").alias("n"), F.col("features")[0].alias("amt"),
        F.round(part(18), 6).alias("card_part"), F.round(part(50), 6).alias("device_part"),
    )

"""Registry of queries and the named subqueries their oracle SQL is put together from."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens import bindings
from fraudlens.functions.scalars import MISSING
from fraudlens.operators.clean import null_placeholders
from fraudlens.operators.ordering import first_seen_vocab, global_row_id, time_split
from fraudlens.session import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ORDER = ["TransactionDT", "TransactionID"]
TRAIN_SHARE = 0.7

# Means of cents over 2^k rows often lie exactly between two roundings, where the engines disagree by
# the last bit of a sum. Both sides scale by this factor before rounding, which decides such ties alike.
TIE_FACTOR = 1.000000000001


def steady(col, digits: int):
    return F.round(col * F.lit(TIE_FACTOR), digits)


def steady_sql(expr: str, digits: int) -> str:
    return f"round(({expr}) * CAST({TIE_FACTOR!r} AS DOUBLE), {digits})"


VIEWS = {
    "txn": """
        SELECT o_orderkey AS TransactionID,
               CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS isFraud,
               CAST(epoch(o_orderdate) AS BIGINT) AS TransactionDT,
               CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_totalprice END AS TransactionAmt,
               o_orderpriority AS ProductCD,
               o_custkey AS card1, c_nationkey AS card2, c_mktsegment AS card4,
               CASE WHEN o_custkey % 11 = 0 THEN 'unknown' WHEN o_custkey % 13 = 0 THEN 'UNKN'
                    ELSE lower(n_name) END AS P_emaildomain,
               o_orderkey % 7 AS C1,
               CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS D1
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "idn": """
        SELECT TransactionID, DeviceType, DeviceInfo, id_01 FROM (
          SELECT l_orderkey AS TransactionID, l_returnflag AS DeviceType,
                 upper(p_name) || '/' || p_type AS DeviceInfo, l_discount AS id_01,
                 row_number() OVER (PARTITION BY l_orderkey
                   ORDER BY l_extendedprice, l_partkey, l_suppkey, l_quantity, l_tax) AS rn
          FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R') WHERE rn = 1""",
    "merged": "SELECT txn.*, DeviceType, DeviceInfo, id_01 FROM txn LEFT JOIN idn USING (TransactionID)",
    # placeholders nulled, the e-mail entity named, the time split and the train/test row numbers
    "clean": """
        SELECT * REPLACE (CASE WHEN P_emaildomain IN ('unknown', 'Unknown', 'UNKN') THEN NULL ELSE P_emaildomain END
                          AS P_emaildomain) FROM txn""",
    "placed": """
        SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS pos, count(*) OVER () AS n_all
        FROM clean""",
    "split": """
        SELECT * EXCLUDE (n_all),
               CASE WHEN pos < CAST(floor(n_all * CAST(0.7 AS DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split
        FROM placed""",
    "train": "SELECT * REPLACE (coalesce(P_emaildomain, 'missing') AS P_emaildomain), pos AS row_id FROM split WHERE split = 'train'",
    "test": "SELECT * REPLACE (coalesce(P_emaildomain, 'missing') AS P_emaildomain) FROM split WHERE split = 'test'",
    "cards": """
        SELECT card1, row_number() OVER (ORDER BY min(row_id)) - 1 AS idx, count(*) AS n FROM train GROUP BY card1""",
    "emails": """
        SELECT P_emaildomain, row_number() OVER (ORDER BY min(row_id)) - 1 AS idx, count(*) AS n
        FROM train GROUP BY P_emaildomain""",
    "sizes": """
        SELECT (SELECT count(*) FROM cards) AS n_cards, (SELECT count(*) FROM emails) AS n_emails""",
    "edges": """
        SELECT unnest([card_node, tx_node, tx_node, email_node]) AS src,
               unnest([tx_node, email_node, card_node, tx_node]) AS dst
        FROM (SELECT cards.idx AS card_node, n_cards + emails.idx AS email_node,
                     n_cards + n_emails + train.row_id AS tx_node
              FROM train JOIN cards USING (card1) JOIN emails USING (P_emaildomain), sizes)""",
    "scored": """
        SELECT event_id AS id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
               value AS score_a, CAST(props->>'$.k' AS DOUBLE) AS score_b FROM events""",
    "log": """
        SELECT ts, 'job-' || (user_id % 8) AS stream, event_type AS status,
               CASE WHEN event_type = 'error' AND user_id % 3 = 0 THEN 'AccessDenied: not authorized to perform iam:PassRole'
                    WHEN event_type = 'error' AND user_id % 3 = 1 THEN 'AlgorithmError: exit code 2'
                    WHEN event_type = 'error' THEN 'Error: step failure'
                    ELSE 'ok ' || props END AS message, event_id FROM events""",
    "history": """
        SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS BIGINT) AS epoch,
               round(avg(value), 6) AS auc FROM events GROUP BY 1""",
    "card_emb": "SELECT vec_id AS card1, CAST(embedding[1:32] AS DOUBLE[]) AS emb FROM embeddings",
}


def oracle(body: str) -> str:
    """``body`` with the views it uses, directly or not, as a WITH list."""
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name, sql in VIEWS.items():
            if name not in needed and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                visit(sql)
                needed[name] = None

    visit(body)
    body = body.strip()
    views = ", ".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    if not views:
        return body
    return f"WITH {views}, {body[5:].lstrip()}" if body.upper().startswith("WITH ") else f"WITH {views} {body}"


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; without ``sql`` only its rows are checked."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return add


# --- inputs that several queries start from ------------------------------------------------

def clean_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_placeholders(bindings.txn(spark, sf_dir))


def split_txn(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Cleaned transactions with their time split, written once since several passes follow.

    With ``cols`` only these and the order columns are read and written.
    """
    rows = clean_txn(spark, sf_dir)
    if cols:
        rows = rows.select(*dict.fromkeys([*ORDER, *cols]))
    return time_split(settle(rows, "txn"), TRAIN_SHARE, *ORDER)


def named_email(df: DataFrame) -> DataFrame:
    return df.withColumn("P_emaildomain", F.coalesce("P_emaildomain", F.lit(MISSING)))


def train_rows(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return named_email(split_txn(spark, sf_dir, "P_emaildomain", *cols).filter("split = 'train'"))


def numbered_train(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return global_row_id(train_rows(spark, sf_dir, "card1", *cols), ORDER, "row_id")


def card_email_vocabs(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    return first_seen_vocab(train, ["card1"], ORDER), first_seen_vocab(train, ["P_emaildomain"], ORDER)

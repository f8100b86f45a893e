import pytest
from pyspark.sql import functions as F

from fraudlens.operators import joins as j
from fraudlens.operators.entity import attach_stats, entity_stats
from fraudlens.session import settle

SPREAD = {"broadcast_bytes": 0}


def test_merge_identity(spark):
    tx = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "TransactionID long, v int")
    idn = spark.createDataFrame([(2, "d", 9)], "TransactionID long, dev string, v int")
    out = j.merge_identity(tx, idn).orderBy("TransactionID").collect()
    assert [(r.TransactionID, r.v_x, r.dev, r.v_y) for r in out] == [(1, 5, None, None), (2, 6, "d", 9), (3, 7, None, None)]
    assert j.merge_identity(tx, None) is tx
    doubled = idn.union(idn)
    assert j.merge_identity(tx, doubled).count() == 4
    with pytest.raises(ValueError):
        j.merge_identity(tx, doubled, check_unique=True)


def test_null_safe_merge(spark):
    a = spark.createDataFrame([(None, 1), (2, 2)], "TransactionID long, x int")
    b = spark.createDataFrame([(None, 8)], "TransactionID long, y int")
    assert {(r.x, r.y) for r in j.merge_identity(a, b, null_safe=True).collect()} == {(1, 8), (2, None)}
    assert {(r.x, r.y) for r in j.merge_identity(a, b).collect()} == {(1, None), (2, None)}


def facts(spark):
    """A third of the rows on one key, a fifth without a key, some keys unseen."""
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 != 0, (F.col("id") % 40).cast("string")).alias("k"),
        (F.col("id") % 2).alias("k2"),
    )


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("salts", [1, 7, None])
def test_spread_lookup_equals_broadcast(spark, how, salts):
    df = facts(spark)
    dim = spark.createDataFrame([("hot", 0, 1.0), ("hot", 1, 1.5)] + [(str(i), i % 2, float(i)) for i in range(30)], "k string, k2 long, v double")
    wide = j.lookup(df, dim, ["k", "k2"], how, salts=salts, **SPREAD)
    flat = j.lookup(df, dim, ["k", "k2"], how)
    plain = df.join(dim, ["k", "k2"], how)
    key = lambda out: sorted((r.id, r.v or -1.0) for r in out.collect())
    assert key(wide) == key(flat) == key(plain)


def test_hot_rows_meet_in_many_partitions(spark):
    df = facts(spark)
    dim = spark.createDataFrame([("hot", 1.0)] + [(str(i), float(i)) for i in range(30)], "k string, v double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = j.lookup(df, dim, "k", salts=8, **SPREAD)
        hot = out.filter("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(hot) > 1 and sum(r["count"] for r in hot) == 1000


def test_hot_keys_are_few(spark):
    found = j.hot_keys(facts(spark), ["k"], parts=4).collect()
    assert [r.k for r in found] == ["hot"]
    assert len(j.hot_keys(facts(spark), ["k"], parts=50).collect()) <= 50


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abc", [1.0, 2.0], 1)], "s string, a array<double>, n long")
    assert j.measured_bytes(df) == 8 + (3 + 16) + (16 + 16) + 8
    assert j.measured_bytes(df.limit(0)) == 0


@pytest.mark.parametrize("tuning", [{}, SPREAD])
def test_filter_unseen(spark, tuning):
    test = spark.createDataFrame([("a", "x"), ("c", "x"), ("a", "y")], "card string, email string")
    cards, emails = spark.createDataFrame([("a",), ("b",)], "card string"), spark.createDataFrame([("x",)], "email string")
    kept, report = j.filter_unseen(test, {"card": cards, "email": emails}, **tuning)
    assert [tuple(r) for r in kept.collect()] == [("a", "x")]
    assert tuple(report.first()) == (3, 1, 2)


@pytest.mark.parametrize("tuning", [{}, SPREAD])
def test_embedding_default(spark, tuning):
    df = spark.createDataFrame([("k1",), ("k9",), (None,)], "k string")
    emb = spark.createDataFrame([("k1", [1.0, 2.0])], "k string, emb array<double>")
    out = {r.k: r.emb for r in j.attach_embedding(df, emb, "k", "emb", 2, **tuning).collect()}
    assert out == {"k1": [1.0, 2.0], "k9": [0.0, 0.0], None: [0.0, 0.0]}


def test_set_differences(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,)], "k int")
    assert [r.k for r in j.anti(a, b, "k").collect()] == [1]
    assert [r.k for r in j.semi(a, b, "k").collect()] == [2]


def test_entity_stats(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), ("a", 3.0, 0), (None, 5.0, 1), (None, None, 0)], "card string, TransactionAmt double, isFraud int"
    )
    out = {r.card: tuple(r)[1:] for r in entity_stats(df, ["card"]).collect()}
    assert out == {"a": (2.0, 2, 0.5, 1), "unknown": (5.0, 1, 0.5, 1)}
    assert [r.card for r in entity_stats(df, ["card"], missing=None).collect()] == ["a"]
    joined = attach_stats(spark.createDataFrame([("a",), ("z",)], "card string"), settle(entity_stats(df, ["card"])), ["card"])
    assert {r.card: (r.amt_mean, r.fraud_count) for r in joined.collect()} == {"a": (2.0, 1), "z": (0.0, 0)}

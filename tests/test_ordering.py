import math

import pytest
from pyspark.sql import Window, functions as F

from fraudlens.operators import ordering as o


def events(spark, n, parts=3):
    """A third of the rows have one key and one time."""
    return spark.range(n).repartition(parts).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("key"),
        F.when(F.col("id") % 3 == 1, F.lit(50).cast("long")).otherwise(F.abs(F.hash("id")) % 100).alias("t"),
        (F.col("id") % 4).alias("status"),
    )


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_row_id_for_any_partitioning(spark, parts):
    df = events(spark, 997, parts)
    got = {r.id: r.row_id for r in o.global_row_id(df, ["t", "id"]).collect()}
    want = {r.id: r.n - 1 for r in df.withColumn("n", F.row_number().over(Window.orderBy("t", "id"))).collect()}
    assert got == want


@pytest.mark.parametrize("n,train", [(0, 0), (1, 0), (10, 7), (90, 62), (100, 70)])
def test_time_split_truncates(spark, n, train):
    df = events(spark, n)
    out = o.time_split(df, 0.7, "t", "id").collect()
    assert sum(r.split == "train" for r in out) == train and len(out) == n
    cut = max(((r.t, r.id) for r in out if r.split == "train"), default=(-1, -1))
    assert all((r.t, r.id) > cut for r in out if r.split == "test")


def test_kth_row(spark):
    df = events(spark, 300)
    want = sorted((r.t, r.id) for r in df.collect())
    for k in (0, 99, 150, 299):
        row = o.kth_row(df, ["t", "id"], k)
        assert (row.t, row.id) == want[k]
    assert o.kth_row(df, ["t", "id"], 300) is None


def test_stratified_split_sizes(spark):
    df = spark.range(10).select("id", (F.col("id") >= 7).cast("int").alias("y"))
    out = o.stratified_split(df, "y", "id", 0.2).collect()
    assert [sum(r.split == "test" and r.y == y for r in out) for y in (0, 1)] == [2, 1]


def test_time_split_with_missing_times(spark):
    """Missing times come last, whether the cut lies before, among or behind them."""
    rows = [(i, None if i in (1, 4, 8) else (i * 7) % 10) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, t int")
    want = [i for i, t in sorted(rows, key=lambda r: (r[1] is None, r[1] if r[1] is not None else 0, r[0]))]
    for frac in (0.0, 0.3, 0.7, 0.8, 0.9, 1.0):
        out = o.time_split(df, frac, "t", "id").filter("split = 'train'").collect()
        assert {r.id for r in out} == set(want[: int(10 * frac)])


@pytest.mark.parametrize("frac", [0.0, 0.2, 0.5, 1.0])
def test_stratified_split_is_exact_and_repeatable(spark, frac):
    df = spark.range(2000).select("id", (F.col("id") % 13 == 0).cast("int").alias("y"))
    a = {r.id: r.split for r in o.stratified_split(df, "y", "id", frac).collect()}
    b = {r.id: r.split for r in o.stratified_split(df.repartition(7), "y", "id", frac).collect()}
    assert a == b
    for y in (0, 1):
        ids = [i for i in range(2000) if (i % 13 == 0) == bool(y)]
        assert sum(a[i] == "test" for i in ids) == math.ceil(len(ids) * frac)
    assert a != {r.id: r.split for r in o.stratified_split(df, "y", "id", frac, seed=7).collect()} or frac in (0.0, 1.0)


def test_three_way_split(spark):
    out = o.three_way_split(events(spark, 100), (0.6, 0.2), "t", "id").collect()
    order = {"train": 0, "valid": 1, "test": 2}
    placed = sorted(((r.t, r.id), order[r.split]) for r in out)
    assert [p for _, p in placed] == sorted(p for _, p in placed)
    assert [sum(p == i for _, p in placed) for i in range(3)] == [60, 20, 20]


def test_first_seen_vocab(spark):
    df = spark.createDataFrame([(1, "c7"), (2, "c3"), (3, "c7"), (4, "c1")], "t int, card string")
    out = o.first_seen_vocab(df, ["card"], ["t"])
    assert {r.card: (r.idx, r.n) for r in out.collect()} == {"c7": (0, 2), "c3": (1, 1), "c1": (2, 1)}


@pytest.mark.parametrize("inclusive", [True, False])
def test_running(spark, inclusive):
    df = events(spark, 500).withColumn("x", F.col("t") * 0.5)
    out, totals = o.running(df, ["t", "id"], {"s": ("sum", "t"), "m": ("max", "x"), "l": ("min", "status")}, inclusive)
    rows = sorted(out.collect(), key=lambda r: (r.t, r.id))
    for i, r in enumerate(rows):
        before = rows[: i + inclusive]
        assert r.s == sum(q.t for q in before)
        assert r.m == max((q.x for q in before), default=None)
        assert r.l == min((q.status for q in before), default=None)
    assert totals == {"s": sum(r.t for r in rows), "m": max(r.x for r in rows), "l": 0}


@pytest.mark.parametrize("parts", [1, 8])
def test_previous_in_group_with_hot_key(spark, parts):
    df = events(spark, 800, parts)
    got = {r.id: (r.p, r.q) for r in o.previous_in_group(df, ["key"], ["t", "id"], {"p": "status", "q": "id"}).collect()}
    w = Window.partitionBy("key").orderBy("t", "id")
    want = {r.id: (r.p, r.q) for r in df.withColumns({"p": F.lag("status").over(w), "q": F.lag("id").over(w)}).collect()}
    assert got == want


def test_status_changes(spark):
    polls = spark.createDataFrame([(1, "j", "InProgress"), (2, "j", "InProgress"), (3, "j", "Completed")], "t int, job string, status string")
    out = o.status_changes(polls, ["job"], ["t"], "status").orderBy("t").collect()
    assert [(r.t, r.status) for r in out] == [(1, "InProgress"), (3, "Completed")]


def test_early_stop(spark):
    history = spark.createDataFrame(list(enumerate([0.5, 0.6, 0.55, 0.58, 0.59, 0.7], 1)), "epoch int, auc double")
    stopped = o.early_stop(history, "epoch", "auc", 3)
    assert [r.epoch for r in stopped.orderBy("epoch").collect() if r.stop] == [5]
    assert tuple(o.stop_summary(stopped, "epoch").first()) == (2, 0.6, 5)
    running_on = o.early_stop(history, "epoch", "auc", 10)
    assert tuple(o.stop_summary(running_on, "epoch").first()) == (6, 0.7, 6)


def test_top_k_and_latest(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", 2.0)], "f string, v double")
    assert [(r.f, r.position) for r in o.top_k(df, "v", 3, "f").orderBy("position").collect()] == [("b", 1), ("c", 2), ("d", 3)]
    assert o.latest(df, ["v", "f"]).first().f == "c"


def test_head_sample(spark):
    tx = spark.range(10).withColumnRenamed("id", "k")
    idn = spark.createDataFrame([(1,), (5,)], "k long")
    head, ids = o.head_sample(tx, idn, 3, "k", ["k"])
    assert head.count() == 3 and [r.k for r in ids.collect()] == [1]
    assert o.head_sample(tx, idn, 0, "k", ["k"]) == (tx, idn)
    assert o.head_sample(tx, None, 3, "k", ["k"])[1] is None


def test_temporal_edges_skip_missing_entities(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "a", 3), (4, None, 4)], "n int, e string, t int")
    assert [(r.src, r.dst) for r in o.temporal_edges(df, ["e"], ["t"], "n").collect()] == [(1, 3)]

"""Missing keys, empty roles, refitting, nested sizes, qualified paths, odd numbers."""

import pytest
from pyspark.sql import functions as F

from fraudlens.operators.clean import cast_roles
from fraudlens.operators.encode import LabelEncoder, Scaler
from fraudlens.operators.entity import CARD_STATS, attach_stats, entity_stats, leave_one_out, time_causal
from fraudlens.operators.graph import build_edges_hetero, entity_nodes
from fraudlens.operators.joins import lookup, measured_bytes
from fraudlens.operators.ordering import first_seen_vocab
from fraudlens.plans.risk import test_rows_with_card_risk as rows_with_card_risk
from fraudlens.schema import FeatureSpec
from fraudlens.sources.manifest import existing_outputs
from fraudlens.sources.tables import read_table
from fraudlens.streaming.scoring import drain, file_stream, with_profiles

KEYS = ["card1", "card2", "card4"]
ROWS = [(i, i, 10.0 + i, i % 2, 1 + i % 2, None if i % 3 else 7, "unknown" if i % 5 == 0 else "visa") for i in range(30)]
SCHEMA = "TransactionID int, TransactionDT int, TransactionAmt double, isFraud int, card1 int, card2 int, card4 string"


@pytest.fixture
def tx(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_cards_with_missing_parts_keep_their_risk(spark, tx):
    out = rows_with_card_risk(tx, None).collect()
    train = [r for r in ROWS if r[0] < 21]
    for r in out:
        key = (r["card1"], r["card2"], r["card4"] or "unknown")  # the caller's column stays as it is
        mates = [t for t in train if (t[4], t[5], "unknown" if t[6] == "unknown" else t[6]) == key]
        assert r["amt_count"] == len(mates) and len(mates) > 0
        assert r["fraud_rate"] == pytest.approx(sum(t[3] for t in mates) / len(mates))


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_attach_finds_missing_keys(spark, tx, limit):
    facts = tx.withColumn("card4", F.nullif("card4", F.lit("unknown")))
    stats = entity_stats(facts, KEYS)
    out = attach_stats(facts, stats, KEYS, broadcast_bytes=limit).collect()
    assert len(out) == 30 and all(r["amt_count"] > 0 for r in out)


def test_graph_of_cards_with_missing_parts(spark, tx):
    train = tx.withColumn("row_id", F.col("TransactionID").cast("long"))
    keys = {"card": KEYS}
    vocabs = {"card": first_seen_vocab(train, KEYS, ["TransactionID"])}
    assert build_edges_hetero(train, vocabs, keys).count() == 60
    stats = {"card": entity_stats(train, KEYS, stats=CARD_STATS)}
    nodes = entity_nodes(vocabs, stats, keys)[0].collect()
    assert len(nodes) == vocabs["card"].count() and all(any(r["feat"]) for r in nodes)


def test_null_safe_lookup(spark):
    facts = spark.createDataFrame([(1, "a"), (None, "a"), (None, None), (0, ""), (2, "b")] * 5, "k int, t string")
    dim = spark.createDataFrame([(1, "a", 10), (None, "a", 20), (None, None, 30), (0, "", 40)], "k int, t string, v int")
    for limit in (1 << 20, 0):
        got = {(r["k"], r["t"]): r["v"] for r in lookup(facts, dim, ["k", "t"], broadcast_bytes=limit, null_safe=True).collect()}
        assert got == {(1, "a"): 10, (None, "a"): 20, (None, None): 30, (0, ""): 40, (2, "b"): None}


def test_refit_forgets(spark):
    encoder = LabelEncoder(["v"])
    encoder.fit(spark.createDataFrame([("b",), ("c",)], "v string"))
    second = spark.createDataFrame([("a",), ("b",)], "v string")
    assert sorted(r["v"] for r in encoder.fit(second).transform(second).collect()) == [0, 1]
    scaler = Scaler(["x", "y"], fit_on="all")
    scaler.fit(spark.createDataFrame([(1.0,)], "x double"))
    assert scaler.fit(spark.createDataFrame([(1.0,), (3.0,)], "y double")).mean == {"y": 2.0}


def test_empty_roles(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert LabelEncoder([]).fit(df).transform(df).collect() == df.collect()
    assert Scaler([], fit_on="all").fit(df).transform(df).collect() == df.collect()


def test_nested_values_are_measured(spark):
    wide = spark.range(1).select(
        F.array(F.struct(F.repeat(F.lit("x"), 100_000).alias("t"))).alias("a"),
        F.create_map(F.lit("k"), F.repeat(F.lit("y"), 50_000)).alias("m"),
        F.struct(F.array(F.repeat(F.lit("z"), 25_000))).alias("s"),
        F.lit(None).cast("array<string>").alias("n"),
    )
    assert 175_000 < measured_bytes(wide) < 180_000


@pytest.mark.parametrize("base", ["/out", "hdfs:///out", "hdfs://nn:8020/out/", "s3a://bucket/out"])
def test_outputs_by_qualified_paths(spark, base):
    files = spark.createDataFrame([(p,) for p in ("hdfs://nn:8020/out/a/b.csv", "hdfs://nn:8020/out/c/part-0.csv", "hdfs://nn:8020/out/c/_SUCCESS")], "path string")
    assert {r["path"] for r in existing_outputs(files, base).collect()} == {"a/b.csv", "c"}


def test_only_numbers_are_numbers(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c,d\n10d,1f,1e3,-.5\n2d,2f,7,+3.\n")
    df = read_table(spark, str(tmp_path / "t.csv"), "csv")
    assert [t for _, t in df.dtypes] == ["string", "string", "double", "double"]
    typed = cast_roles(spark.createDataFrame([("10d", " 4 "), ("2", "inf")], "x string, y string"), FeatureSpec((), ("x", "y")))
    assert [tuple(r) for r in typed.collect()] == [(None, 4.0), (2.0, float("inf"))]


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_stream_joins_without_broadcast(spark, tmp_path, threshold):
    """Also profiles beyond the broadcast size join a stream, and a missing key finds its profile."""
    spark.createDataFrame([(1, 1), (2, None), (3, 9)], "id int, card1 int").write.parquet(str(tmp_path / "in"))
    stats = spark.createDataFrame([(1, 0.5), (None, 0.25)], "card1 int, fraud_rate double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        arriving = file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
        out = drain(with_profiles(arriving, stats, ["card1"]), str(tmp_path / "out"))
        assert {r["id"]: r["fraud_rate"] for r in out.collect()} == {1: 0.5, 2: 0.25, 3: 0.0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_profiles_without_own_label(spark, limit):
    rows = [(i, i // 2, [None, 1, 1, 2, 1][i % 5], ["a", None][i % 2], (i * 7) % 3 % 2) for i in range(40)] + [(99, 99, 8, "z", 1)]
    df = spark.createDataFrame(rows, "id int, t int, k int, s string, isFraud int").repartition(5)
    loo = {r["id"]: r["fraud_rate"] for r in leave_one_out(df, ["k", "s"], broadcast_bytes=limit).collect()}
    causal = {r["id"]: r["fraud_rate"] for r in time_causal(df, ["k", "s"], ["t", "id"], broadcast_bytes=limit).collect()}
    for i, t, k, s, _ in rows:
        mates = [r for r in rows if (r[2], r[3]) == (k, s) and r[0] != i]
        before = [r for r in mates if (r[1], r[0]) < (t, i)]
        assert loo[i] == pytest.approx(sum(r[4] for r in mates) / len(mates) if mates else 0)
        assert causal[i] == pytest.approx(sum(r[4] for r in before) / len(before) if before else 0)

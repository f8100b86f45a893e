import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.plans.preprocess import preprocess, write_outputs
from fraudlens.schema import FeatureSpec
from fraudlens.session import settle, shared_dir, workspace
from fraudlens.sources import manifest as m
from fraudlens.sources.sinks import read_split, write_manifest, write_splits, write_table
from fraudlens.sources.tables import read_config, read_dir, read_optional, read_table


def write_text(path, text):
    path.write_text(text)
    return str(path)


def test_csv_types_and_tokens(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", 'id,gap,num,txt,flag,none\n1,NA,1.5,"a,b",True,\n2,3,nan,NULL,false,N/A\n3,4,2,"say ""x""",True,\n')
    df = read_table(spark, path, "csv")
    assert dict(df.dtypes) == {"id": "bigint", "gap": "double", "num": "double", "txt": "string", "flag": "boolean", "none": "double"}
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, None, 1.5, "a,b", True, None), (2, 3.0, None, None, False, None), (3, 4.0, 2.0, 'say "x"', True, None)
    ]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("gap", T.DoubleType()), T.StructField("num", T.StringType())])
    typed = read_table(spark, write_text(tmp_path / "u.csv", "id,gap,num\n1,x,007\n"), "csv", schema)
    assert tuple(typed.first()) == (1, None, "007")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_round_trip(spark, fmt):
    df = spark.createDataFrame([(1, 'a "quoted", text'), (2, None)], "id long, s string")
    path = write_table(df, workspace(spark, "t"), fmt)
    assert sorted((r.id, r.s) for r in read_table(spark, path, fmt, df.schema).collect()) == [(1, 'a "quoted", text'), (2, None)]


def test_optional_and_directory(spark):
    df = spark.range(100).repartition(5)
    path = write_table(df, workspace(spark, "d"), "csv")
    assert read_dir(spark, path).count() == 100
    assert read_dir(spark, write_table(df, workspace(spark, "d"))).count() == 100
    assert read_optional(spark, path + "_absent") is None
    assert read_optional(spark, path + "_absent", "csv") is None
    with pytest.raises(FileNotFoundError):
        read_dir(spark, write_table(df, workspace(spark, "d"), "orc"))


def test_split_layout_prunes(spark):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 7, "train").otherwise("test"))
    path = write_splits(df, workspace(spark, "s"))
    plan = read_split(spark, path, "test")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert read_split(spark, path, "test").count() == 3


def test_single_file_and_manifest(spark):
    path = write_table(spark.range(10).repartition(4), workspace(spark, "one"), "csv", single_file=True)
    assert sum(f.startswith("part-") for f in os.listdir(path)) == 1
    doc = write_manifest(spark, {"a": {"b": [1, 2]}}, workspace(spark, "m"))
    assert read_config(spark, doc).select("a.b").first().b == [1, 2]


def test_catalog_and_missing(spark):
    base = workspace(spark, "c")
    write_table(spark.range(5), f"{base}/keep")
    write_table(spark.range(5), f"{base}/skip")
    files = m.catalog(spark, base, exclude="/skip/")
    size = sum(
        os.path.getsize(os.path.join(root, f)) for root, _, names in os.walk(f"{base}/keep") for f in names if not f.startswith((".", "_"))
    )
    total = m.catalog_totals(files.filter("path not like '%_SUCCESS'")).first()
    assert total.total_size_mb == pytest.approx(size / 1e6)
    need = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    have = spark.createDataFrame([("a",), ("c",)], "path string")
    assert [r.path for r in m.missing_outputs(need, have).collect()] == ["b"]
    assert not m.is_complete(need, have) and m.is_complete(have, need)


def test_fingerprint_and_materialize(spark):
    df = spark.range(50).withColumn("x", F.col("id") % 3)
    assert m.fingerprint(df) == m.fingerprint(df.repartition(7))
    assert m.fingerprint(df) != m.fingerprint(df.union(df.limit(1)).union(df.limit(1)))
    path, calls = workspace(spark, "mat"), []

    def build():
        calls.append(1)
        return df

    assert [m.materialize(spark, build, path, mark)[1] for mark in ("1", "1", "2")] == ["written", "skipped", "written"]
    assert len(calls) == 2


def test_run_log(spark):
    path = workspace(spark, "runs")
    with m.RunLog(spark, path, "good", n_rows=3):
        pass
    with pytest.raises(KeyError):
        with m.RunLog(spark, path, "bad"):
            raise KeyError("x")
    runs = {r.name: r for r in m.read_runs(spark, path).collect()}
    assert runs["good"].success and runs["good"].n_rows == 3 and not runs["bad"].success


def test_snapshot(spark):
    out = m.snapshot(spark, {"a": spark.range(4), "b": spark.range(0)}, workspace(spark, "snap"))
    assert {r.channel: r.n_rows for r in out.collect()} == {"a": 4, "b": 0}


def test_settle_uses_the_named_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = settle(spark.range(3).withColumn("v", F.array(F.lit(1.0))))
    assert df.inputFiles()[0].replace("file://", "").startswith(shared_dir(spark)) and df.count() == 3


def frames(spark):
    tx = spark.range(200).select(
        F.col("id").alias("TransactionID"), (F.col("id") % 9 == 0).cast("int").alias("isFraud"), (F.col("id") * 7 % 60).alias("TransactionDT"),
        F.when(F.col("id") % 6 != 0, F.col("id") * 1.5).alias("TransactionAmt"), F.when(F.col("id") % 4 != 0, F.concat(F.lit("c"), F.col("id") % 3)).alias("ProductCD"),
        (F.col("id") % 25).alias("card1"), F.when(F.col("id") % 5 != 0, "mail").otherwise("unknown").alias("P_emaildomain"),
    )
    idn = spark.range(0, 200, 3).select(F.col("id").alias("TransactionID"), F.lit("mobile").alias("DeviceType"))
    return tx, idn


@pytest.mark.parametrize("fit_on", ["all", "train"])
def test_preprocess(spark, fit_on):
    done = preprocess(*frames(spark), fit_on=fit_on)
    assert set(done.spec.numerical) == {"TransactionAmt", "card1"}
    assert set(done.spec.categorical) == {"ProductCD", "P_emaildomain", "DeviceType"}
    rows = done.rows.collect()
    assert len(rows) == 200 and sum(r.split == "train" for r in rows) == 140
    assert all(v is not None for r in rows for v in r)
    fitted = [r.TransactionAmt for r in rows if fit_on == "all" or r.split == "train"]
    assert abs(sum(fitted) / len(fitted)) < 1e-9
    assert {r.key_P_emaildomain for r in rows} == {"mail", "missing"}
    without = preprocess(frames(spark)[0], None, FeatureSpec(("ProductCD",), ("TransactionAmt",)))
    assert "DeviceType" not in without.rows.columns


def test_outputs_are_complete(spark):
    base = workspace(spark, "out")
    done = preprocess(*frames(spark))
    write_outputs(done, base)
    need = spark.createDataFrame([(p,) for p in m.REQUIRED_OUTPUTS], "path string")
    have = m.existing_outputs(m.catalog(spark, base), base)
    assert m.missing_outputs(need, have).isEmpty()
    read = lambda p: spark.read.option("header", True).csv(f"{base}/{p}")
    nodes, edges = read("gnn/train_gnn/nodes/node.csv"), read("gnn/train_gnn/edges/node_to_node.csv")
    labels = read("gnn/train_gnn/nodes/node_label.csv")
    offset = read_config(spark, f"{base}/gnn/train_gnn/nodes/offset_range_of_training_node.json").first()
    ids = sorted(int(r.node_id) for r in nodes.collect())
    assert ids == list(range(offset.start, offset.end)) and len(ids) == 140
    assert edges.count() == 4 * 140 and labels.count() == 140
    assert "isFraud" not in nodes.columns
    assert read("xgb/training.csv").columns.count("isFraud") == 1
    config = read_config(spark, f"{base}/config/config.json").first()
    assert config.xgb_config.scale_pos_weight > 1


def test_job_writes_once_per_input(spark, tmp_path):
    from fraudlens.plans.job import arguments, run

    tx, idn = frames(spark)
    paths = [write_table(tx, f"{tmp_path}/tx.csv", "csv"), write_table(idn, f"{tmp_path}/idn.parquet")]
    args = arguments(["--transactions", paths[0], "--identities", paths[1], "--output", f"{tmp_path}/out"])
    assert [run(spark, args), run(spark, args)] == ["written", "skipped"]
    small = arguments(["--transactions", paths[0], "--output", f"{tmp_path}/out", "--sample-size", "50"])
    assert run(spark, small) == "written"
    runs = m.read_runs(spark, f"{tmp_path}/out/runs").orderBy("started").collect()
    assert [(r.name, r.n_rows, r.success) for r in runs] == [("preprocess", 200, True), ("preprocess", 50, True)]

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from fraudlens.operators import model as mo
from fraudlens.operators.metrics import average_precision, evaluate
from fraudlens.plans.training import compare_runs, tabular_run
from fraudlens.schema import FeatureSpec
from fraudlens.session import settle, workspace

PARAMS = mo.TreeParams(rounds=4, learning_rate=0.3, max_depth=3)


@pytest.fixture(scope="module")
def rows(spark):
    a, b = F.abs(F.hash("id")) % 100 / 100.0, F.abs(F.hash(F.col("id") + 7)) % 100 / 100.0
    df = spark.range(1200).select("id", a.alias("a"), b.alias("b"), (F.col("id") % 3).cast("string").alias("c"))
    return settle(df.withColumn("label", ((F.col("a") + F.col("b") > 1.2) | (F.col("id") % 29 == 0)).cast("int")))


@pytest.fixture(scope="module")
def fitted(spark, rows):
    ready, slots = mo.assemble(rows, FeatureSpec(("c",), ("a", "b"), label="label", key="id"))
    ready = settle(ready)
    return mo.train_gbt(ready, PARAMS, "label"), ready, slots


def test_parameters(rows, fitted):
    model, _, slots = fitted
    assert slots == ["c_code", "a_num", "b_num"] and model.getNumTrees == 4
    with pytest.raises(ValueError):
        mo.train_gbt(fitted[1], mo.TreeParams(num_parallel_tree=2), "label")
    with pytest.raises(ValueError):
        mo.regime_weights(rows, "label", "other")


def test_nominal_slot_survives_writing(fitted):
    attrs = fitted[1].schema["features"].metadata["ml_attr"]["attrs"]
    assert [a["name"] for a in attrs["nominal"]] == ["c_code"] and len(attrs["nominal"][0]["vals"]) == 3


def test_staged_scores_end_at_the_model(spark, fitted):
    model, ready, _ = fitted
    last = mo.staged_scores(model, ready.select("id", "features")).filter(f"rounds = {PARAMS.rounds}")
    both = last.join(mo.score(model, ready).select("id", F.col("score").alias("final")), "id")
    r = both.agg(F.count("*").alias("n"), F.max(F.abs(F.col("score") - F.col("final"))).alias("d")).first()
    assert r.n == 1200 and r.d < 1e-9


def test_staged_ap_and_best_rounds(spark, fitted):
    model, ready, _ = fitted
    staged = {r.rounds: r.average_precision for r in mo.staged_ap(model, ready).collect()}
    assert sorted(staged) == [1, 2, 3, 4]
    final = average_precision(mo.score(model, ready)).first().average_precision
    assert staged[4] == pytest.approx(final, abs=1e-9)
    best = mo.best_rounds(model, ready, patience=10).first()
    assert best.best_metric == max(staged.values()) and best.stop_epoch == 4


def test_quality_and_importances(spark, fitted):
    model, ready, slots = fitted
    assert evaluate(mo.score(model, ready)).first().auc > 0.9
    table = mo.importances(model, slots, spark).collect()
    assert sum(r.importance for r in table) == pytest.approx(1.0)
    assert mo.top_importances(model, slots, spark, 2).count() == 2


def test_regimes(rows):
    pos = rows.filter("label = 1").count()
    neg = rows.count() - pos
    mean = lambda r, y: mo.regime_weights(rows, "label", r).filter(f"label = {y}").agg(F.avg("weight")).first()[0]
    assert mean("none", 1) == 1.0
    assert mean("sample", 1) == pytest.approx((pos + neg) / (2 * pos)) and mean("sample", 0) == pytest.approx((pos + neg) / (2 * neg))
    assert mean("pos", 1) == pytest.approx(neg / pos) and mean("pos", 0) == 1.0
    assert mean("both", 1) == pytest.approx((pos + neg) / (2 * pos) * neg / pos)
    weights = mo.regime_weights(rows, "label", "sample").agg(F.avg("weight")).first()[0]
    assert weights == pytest.approx(1.0)


def test_save_and_load(spark, fitted):
    model, ready, _ = fitted
    path = workspace(spark, "saved")
    mo.save_model(model, path, PARAMS, evaluate(mo.score(model, ready)))
    loaded, params, metrics = mo.load_model(spark, path)
    assert params == PARAMS and 0 <= metrics.first().auc <= 1
    assert mo.score(loaded, ready).agg(F.sum("score")).first()[0] == pytest.approx(mo.score(model, ready).agg(F.sum("score")).first()[0])


def test_head(spark, rows):
    nodes = rows.withColumn("feat", F.array("a", "b"))
    head = mo.train_head(nodes)
    scored = mo.score(head, nodes.withColumn("features", array_to_vector("feat")))
    assert evaluate(scored).first().auc > 0.85


def test_runs_compared(spark, rows):
    spec = FeatureSpec(("c",), ("a", "b"), label="label", key="id")
    first, second = tabular_run(rows, spec, PARAMS, "none"), tabular_run(rows, spec, PARAMS, "both")
    table = {r.metric: r for r in compare_runs(first, second, "id").collect()}
    assert table["auc"].first > 0.8 and table["auc"].second > 0.8 and table["spearman"].first > 0.5


def test_missing_flags(spark):
    df = spark.createDataFrame([(1, 1.0, "x", 1), (2, None, None, 0)], "id long, a double, c string, label int")
    out, slots = mo.assemble(df, FeatureSpec(("c",), ("a",), label="label", key="id"), flag_missing=True)
    assert slots == ["c_code", "a_num", "a_missing"]
    assert [list(r.features.toArray()) for r in out.orderBy("id").collect()] == [[1.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    vals = out.schema["features"].metadata["ml_attr"]["attrs"]
    assert vals["nominal"][0]["name"] == "c_code"


def test_learner_reads_bounded_partitions(rows, monkeypatch):
    """Rows that lie in one written file are dealt out before a learner keeps them; none is lost."""
    ready, _ = mo.assemble(rows, FeatureSpec(("c",), ("a", "b"), label="label", key="id"))
    ready = settle(ready.coalesce(1))
    seen = {}

    def fit(self, df):
        parts = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        seen.update(most=max(r["count"] for r in parts), total=sum(r["count"] for r in parts), ones=df.agg(F.sum("_label")).first()[0])

    monkeypatch.setattr(mo.GBTClassifier, "fit", fit)
    monkeypatch.setattr(mo, "CELLS", 300, raising=False)
    mo.train_gbt(ready, PARAMS, "label")
    assert seen["total"] == 1200 and seen["ones"] == ready.agg(F.sum("label")).first()[0]
    assert seen["most"] <= 200  # 100 on average

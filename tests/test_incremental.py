"""Statistics kept per partition, saved pipelines, the training job, results of the reduced learner queries."""

import json
import os

import duckdb
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from fraudlens.operators.boosting import BoostedTrees, BoostParams, train_boosting
from fraudlens.operators.graph import build_edges_card_email, build_test_graph, txn_features
from fraudlens.operators.joins import attach_embedding, filter_unseen
from fraudlens.operators.metrics import average_precision, evaluate
from fraudlens.operators.model import assemble
from fraudlens.operators.ordering import first_seen_vocab
from fraudlens.operators.profile import rank_error, sketched_medians
from fraudlens.plans import train_job
from fraudlens.plans.preprocess import preprocess
from fraudlens.plans.saved import Preparation, scoring_pipeline
from fraudlens.plans.training import hybrid_features
from fraudlens.queries import base, model_q, sources_q  # noqa: F401
from fraudlens.schema import FeatureSpec
from fraudlens.session import settle, workspace
from fraudlens.sources.incremental import TableStates, partition_marks
from fraudlens.sources.sinks import write_table

SF = "/root/testdata/sf0.001"


def daily(spark, days, start=0):
    rows = spark.range(start, start + 40 * len(days)).withColumn("day", F.element_at(F.array(*map(F.lit, days)), (F.col("id") % len(days) + 1).cast("int")))
    x = F.when(F.col("id") % 9 > 0, (F.col("id") * 37 % 101).cast("double"))
    return rows.select("id", "day", x.alias("x"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("v"), F.col("id") % 13)).alias("t"))


def plain_states(frame):
    rows = frame.toPandas()  # noqa: F841
    x = duckdb.sql("SELECT count(x), avg(x), stddev_pop(x), min(x), max(x) FROM rows WHERE x = x").fetchall()[0]
    t = duckdb.sql("SELECT t, count(*), row_number() OVER (ORDER BY t) - 1 FROM rows WHERE t IS NOT NULL GROUP BY t").fetchall()
    return x, sorted(t)


def check(states, frame):
    x, t = plain_states(frame)
    m = states.moments().first()
    assert tuple(m)[1:6] == pytest.approx(x, rel=1e-12)
    at = frame.filter("x IS NOT NULL").agg(F.avg((F.col("x") < m["median"]).cast("int")), F.avg((F.col("x") <= m["median"]).cast("int"))).first()
    assert at[0] <= 0.5 + rank_error(400) and at[1] >= 0.5 - rank_error(400)
    assert sorted(tuple(r)[1:] for r in states.codes().collect()) == t


def test_a_new_day_reads_the_new_day(spark, monkeypatch):
    source, stored = workspace(spark, "days"), workspace(spark, "states")
    first = daily(spark, ["2024-01-01", "2024-01-02", "2024-01-03"])
    first.write.partitionBy("day").parquet(source)
    states = TableStates(spark, source, stored, "day", ["x"], ["t"])
    assert states.update() == ["2024-01-01", "2024-01-02", "2024-01-03"] and states.stale() == []
    check(states, first)
    more = daily(spark, ["2024-01-04"], 500)
    more.write.mode("append").partitionBy("day").parquet(source)
    read = []
    rows = TableStates.rows

    def listed(self, parts):
        out = rows(self, parts)
        read.extend(r[0] for r in out.select(F.col("_metadata.file_path")).distinct().collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan
        return out

    monkeypatch.setattr(TableStates, "rows", listed)
    assert states.update() == ["2024-01-04"]
    assert read and all("day=2024-01-04" in f for f in read)
    check(states, first.unionByName(more))
    fresh = TableStates(spark, source, workspace(spark, "states"), "day", ["x"], ["t"])
    fresh.update()
    assert sorted(map(str, fresh.codes().collect())) == sorted(map(str, states.codes().collect()))
    assert states.update() == []


def test_a_changed_day_replaces_its_state(spark):
    source, stored = workspace(spark, "days"), workspace(spark, "states")
    daily(spark, ["a", "b"]).write.partitionBy("day").parquet(source)
    states = TableStates(spark, source, stored, "day", ["x"], ["t"])
    states.update()
    daily(spark, ["b"], 900).write.mode("append").partitionBy("day").parquet(source)
    assert partition_marks(spark, source, "day").count() == 2 and states.stale() == ["b"]
    states.update()
    check(states, spark.read.parquet(source))


def test_sketched_medians(spark):
    """Many columns, some of them nearly empty."""
    wide = spark.range(5000).select(*[F.when(F.col("id") % (1 + 40 * (i % 2)) == 0, F.hash("id", F.lit(i)).cast("double")).alias(f"c{i}") for i in range(12)], F.lit(None).cast("double").alias("none"))
    found = {r["column"]: r for r in sketched_medians(wide, wide.columns).collect()}
    assert found["none"]["n"] == 0 and found["none"]["median"] is None
    for c in wide.columns[:-1]:
        m, n = found[c]["median"], found[c]["n"]
        below, upto = wide.agg(F.count_if(F.col(c) < m), F.count_if(F.col(c) <= m)).first()
        assert below / n <= 0.5 + rank_error(400) and upto / n >= 0.5 - rank_error(400)


@pytest.fixture(scope="module")
def raw(spark):
    return settle(base.clean_txn(spark, SF))


def test_saved_pipeline(spark, raw):
    spec = FeatureSpec(("ProductCD", "card4", "P_emaildomain", "card1"), ("TransactionAmt", "D1"))
    done = preprocess(raw, None, spec)
    trees = train_boosting(done.rows.filter("split = 'train'"), done.spec.features, BoostParams(rounds=2, max_depth=2, max_bins=8), "isFraud")
    path = workspace(spark, "pipeline")
    scoring_pipeline(done, trees).write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert isinstance(again.stages[0], Preparation) and again.stages[0].encoder.sizes == done.encoder.sizes
    prepared = again.stages[0].transform(raw).select("TransactionID", *done.spec.features)
    same = done.rows.select("TransactionID", *done.spec.features)
    assert prepared.exceptAll(same).isEmpty() and same.exceptAll(prepared).isEmpty()
    scored = again.transform(raw)
    want = trees.score(done.rows).select("TransactionID", F.col("score").alias("want"))
    assert scored.count() == raw.count() and scored.join(want, "TransactionID").filter("score <> want").isEmpty()
    assert again.stages[0].transform(raw.withColumn("card4", F.lit("never seen"))).count() == raw.count()


def test_prepared_rows_are_written_by_split(spark, raw):
    done = preprocess(raw, None, FeatureSpec(("ProductCD",), ("TransactionAmt",)))
    plan = done.rows.filter("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "Exchange" not in plan


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_training_job(spark, raw, tmp_path, fmt):
    rows = raw.select("TransactionID", "isFraud", F.hash("ProductCD").alias("product"), "TransactionAmt", "D1", "card4")
    for name, part in (("train", "TransactionID % 4 > 0"), ("valid", "TransactionID % 4 = 0")):
        write_table(rows.filter(part), f"{tmp_path}/{name}", fmt)
    (tmp_path / "config.json").write_text(json.dumps({"xgb_config": {"max_depth": 2, "learning_rate": 0.3, "n_estimators": 9, "scale_pos_weight": 3.0}}))
    out = f"{tmp_path}/out"
    args = ["--train", f"{tmp_path}/train", "--validation", f"{tmp_path}/valid", "--output", out, "--config", f"{tmp_path}/config.json"]
    model = train_job.run(spark, train_job.arguments([*args, "--key", "TransactionID", "--patience", "2", "--max-bins", "8"]))
    assert (model.params.rounds, model.params.max_depth, model.params.patience) == (9, 2, 2) and list(model.bins.cuts) == ["product", "TransactionAmt", "D1"]
    history = spark.read.json(f"{out}/history").orderBy("round").collect()
    assert [(r["round"], r["average_precision"]) for r in history] == model.history
    assert BoostedTrees.load(f"{out}/model", spark).trees == model.trees
    scored = spark.read.parquet(f"{out}/scores")
    assert scored.count() == rows.filter("TransactionID % 4 = 0").count()
    assert average_precision(scored).first()[0] == pytest.approx(max(ap for _, ap in model.history))
    metrics = spark.read.json(f"{out}/metrics").first()
    assert metrics["auc"] == pytest.approx(evaluate(scored).first()["auc"]) and metrics["best_round"] == model.best_round
    assert spark.read.json(f"{out}/importances").count() == 3 and os.path.isdir(f"{out}/runs")


# --- missing keys are entities of their own ---------------------------------------------------------

ROWS = [(0, 10, None, "a", 1.0), (1, 20, 5, None, 2.0), (2, 30, 5, "a", 3.0), (3, 40, None, None, 4.0)]
GAPS = "row_id long, TransactionDT long, card1 int, P_emaildomain string, TransactionAmt double"


@pytest.mark.parametrize("tuning", [{}, {"broadcast_bytes": 0}])
def test_missing_keys(spark, tuning):
    tx = spark.createDataFrame(ROWS, GAPS)
    cards, emails = (first_seen_vocab(tx, [k], ["TransactionDT"]) for k in ("card1", "P_emaildomain"))
    edges = build_edges_card_email(tx, cards, emails, **tuning)
    assert edges.groupBy("src").count().filter("src >= 4 AND count <> 2").isEmpty() and edges.count() == 16
    kept, report = filter_unseen(tx, {"card1": cards, "P_emaildomain": emails}, **tuning)
    assert kept.count() == 4 and tuple(report.first()) == (4, 4, 0)
    seen = cards.filter("card1 IS NOT NULL")
    assert [r["row_id"] for r in filter_unseen(tx, {"card1": seen}, **tuning)[0].orderBy("row_id").collect()] == [1, 2]
    numbered, test_edges, _ = build_test_graph(tx.drop("row_id"), cards, emails, ["TransactionDT"], **tuning)
    assert numbered.count() == 4 and test_edges.count() == 16
    emb = spark.createDataFrame([(5, "a", [1.0, 2.0]), (None, "a", [3.0, 4.0]), (5, None, [5.0, 6.0])], "card1 int, P_emaildomain string, emb array<double>")
    got = attach_embedding(tx, emb, ["card1", "P_emaildomain"], "emb", 2, **tuning).orderBy("row_id").collect()
    assert [r["emb"] for r in got] == [[3.0, 4.0], [5.0, 6.0], [1.0, 2.0], [0.0, 0.0]]
    built = txn_features(tx, emb, emb, ["card1", "P_emaildomain"], ["card1", "P_emaildomain"], dim=2, features=("TransactionAmt",), **tuning).orderBy("row_id")
    assert [r["features"] for r in built.collect()] == [[1.0, 3.0, 4.0, 3.0, 4.0], [2.0, 5.0, 6.0, 5.0, 6.0], [3.0, 1.0, 2.0, 1.0, 2.0], [4.0] + [0.0] * 4]


def test_assemble_keeps_other_codes(spark):
    df = spark.createDataFrame([(1, "x", 3, 2.0)], "id int, kind string, zip_code int, amount double")
    rows, slots = assemble(df, FeatureSpec(("kind",), ("amount",), label="id", key="id"))
    assert rows.columns == ["id", "kind", "zip_code", "amount", "features"] and slots == ["kind_code", "amount_num"]


def test_hybrid_features_hide_own_labels(spark, raw):
    """Another label in one training row changes no feature of that row, and some of its card's other rows."""
    rows = settle(base.split_txn(spark, SF).withColumns({"DeviceType": F.lit("d"), "DeviceInfo_simple": F.lit("i"), "card3": F.col("card2")}))
    busy = rows.filter("split = 'train'").groupBy("card1").count().orderBy(F.desc("count"), "card1").first()["card1"]
    one = rows.filter((F.col("split") == "train") & (F.col("card1") == busy)).orderBy("TransactionID").first()["TransactionID"]
    other = rows.withColumn("isFraud", F.when(F.col("TransactionID") == one, 1 - F.col("isFraud")).otherwise(F.col("isFraud")))
    built = [
        {r["TransactionID"]: r["features"] for r in hybrid_features(d, base.ORDER, hops=1).select("TransactionID", "features").collect()} for d in (rows, settle(other))
    ]
    assert built[0][one] == built[1][one]
    mates = [r["TransactionID"] for r in rows.filter(F.col("card1") == busy).collect() if r["TransactionID"] != one]
    assert mates and all(built[0][m] != built[1][m] for m in mates)


# --- results of the learner queries, recomputed -------------------------------------------------------

def test_reduced_results(spark):
    scored = settle(base.QUERIES["m05_score_reduced"](spark, SF))
    labels = base.clean_txn(spark, SF).select("TransactionID", F.col("isFraud").alias("label"))
    held = settle(scored.filter("split = 'test'").join(labels, "TransactionID"))
    staged = {r["rounds"]: r["average_precision"] for r in base.QUERIES["m04_staged_ap_reduced"](spark, SF).collect()}
    assert sorted(staged) == list(range(1, 9)) and staged[8] == pytest.approx(average_precision(held).first()[0])
    best = base.QUERIES["m04_best_rounds_reduced"](spark, SF).first()
    upto = {k: v for k, v in staged.items() if k <= best["stop_epoch"]}
    assert best["best_metric"] == pytest.approx(max(upto.values())) == pytest.approx(upto[best["best_epoch"]])
    shares = base.QUERIES["m08_importances_reduced"](spark, SF).collect()
    assert len(shares) == 11 and sum(r["importance"] for r in shares) == pytest.approx(1)
    compared = {r["metric"]: r for r in base.QUERIES["m03_regimes_compared_reduced"](spark, SF).collect()}
    assert compared["prevalence"]["first"] == compared["prevalence"]["second"] and compared["auc"]["first"] != compared["auc"]["second"]
    hybrid = base.QUERIES["m07_hybrid_reduced"](spark, SF)
    assert hybrid.count() == base.split_txn(spark, SF).filter("split = 'test'").count()
    totals = base.QUERIES["s09_catalog_totals"](spark, SF).collect()
    assert len(totals) == 2 and all(r["total_files"] > 0 and r["total_size_mb"] == pytest.approx(r["total_bytes"] / 1e6, abs=1e-5) for r in totals)


def test_linear_head_is_at_its_optimum(spark):
    """The weighted residuals of a converged unpenalised logit sum to zero: the intercept's gradient."""
    from pyspark.ml.functions import array_to_vector

    from fraudlens.operators import model as mo

    rows = spark.range(600).select((F.col("id") % 7 / 7.0).alias("a"), (F.col("id") % 5 / 5.0).alias("b"), (F.hash("id") % 3 == 0).cast("int").alias("y"), (1 + F.col("id") % 2).cast("double").alias("w"))
    rows = settle(rows.select(F.array("a", "b").alias("feat"), "y", "w"))
    head = mo.train_head(rows, "feat", "y", "w")
    scored = mo.score(head, rows.withColumn("features", array_to_vector("feat")))
    residual, slope = scored.agg(F.sum(F.col("w") * (F.col("score") - F.col("y"))), F.sum(F.col("w") * (F.col("score") - F.col("y")) * F.col("feat")[0])).first()
    assert mo.head_converged(head) and abs(residual) < 1e-2 and abs(slope) < 1e-2


def test_leaves_of_one_tree(spark):
    """A one-tree model's leaf holds the mean of the labels (as -1 and 1) of the rows that reach it."""
    from pyspark.ml.functions import vector_to_array

    from fraudlens.operators import model as mo

    rows = spark.range(800).select("id", (F.abs(F.hash("id")) % 50).cast("double").alias("a"), (F.abs(F.hash("id")) % 50 + F.col("id") % 9 > 30).cast("int").alias("y"))
    ready, _ = assemble(rows, FeatureSpec((), ("a",), label="y", key="id"))
    model = mo.train_gbt(settle(ready), mo.TreeParams(rounds=1, max_depth=2, subsample=1.0, colsample=1.0), "y")
    values = mo.leaf_values(model, spark)[0]
    reached = model.transform(ready).groupBy(vector_to_array("leaf")[0].cast("int").alias("leaf")).agg(F.avg(2.0 * F.col("y") - 1).alias("mean"))
    for r in reached.collect():
        assert values[r["leaf"]] == pytest.approx(r["mean"], abs=1e-9)

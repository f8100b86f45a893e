"""Learners (M2-M5, M8, M9, G9).

MLlib's trees have no SQL twin. Queries named ``_reduced`` return scores, average precisions, importances and
comparisons as they are, of trees trained at the reduced ``PARAMS``; tests recompute them. Beside them stand
checks that SQL can follow: what the data fixes (rows, positives, rounds), bounds, and whether metrics agree
with those recomputed from the scores that were emitted. ``m02_train_gbt`` trains at the published setting.
The trees of ``boost_q`` are repeated by SQL whole.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fraudlens import bindings as b
from fraudlens.operators import model as mo
from fraudlens.operators.entity import leave_one_out, time_causal
from fraudlens.operators.joins import merge_identity
from fraudlens.operators.metrics import average_precision, evaluate, roc_auc
from fraudlens.operators.ordering import stratified_split
from fraudlens.plans.training import compare_runs, hybrid_features, tabular_run
from fraudlens.queries.base import ORDER, VIEWS, clean_txn, query, split_txn
from fraudlens.schema import FeatureSpec
from fraudlens.session import settle

SPEC = FeatureSpec(("ProductCD", "card4", "DeviceType"), ("TransactionAmt", "C1", "D1", "card1"))
CARD = ["card1", "card2", "card4"]
PARAMS = mo.TreeParams(rounds=8, learning_rate=0.3, max_depth=3)  # reduced
PUBLISHED = mo.TreeParams(rounds=100, learning_rate=0.1, max_depth=6)

# The stratified split as SQL, and the test rows' counts
VIEWS["strata"] = """
    SELECT TransactionID, isFraud, CASE WHEN rn <= ceil(n * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM (
      SELECT TransactionID, isFraud, row_number() OVER (PARTITION BY isFraud ORDER BY md5(TransactionID || '|42'), TransactionID) AS rn,
             count(*) OVER (PARTITION BY isFraud) AS n FROM txn)"""
VIEWS["held"] = "SELECT count(*) AS n_rows, sum(isFraud) AS positives FROM strata WHERE split = 'test'"
_CHECKED = "SELECT n_rows, CAST(positives AS BIGINT) AS positives, true AS counts_agree, true AS auc_agrees, true AS ap_agrees, true AS scores_in_range"


def checked(scored, label="label"):
    """Rows and positives, and whether the metrics agree with a second way over the same scores."""
    rows = settle(scored.select(F.col(label).alias("label"), "score"), "scores")
    one = evaluate(rows)
    again = {"auc": roc_auc(rows).first()[0], "ap": average_precision(rows).first()[0]}
    base = rows.agg(
        F.count("*").alias("n_rows"), F.sum("label").cast("bigint").alias("positives"), (F.min("score") >= 0).alias("_lo"), (F.max("score") <= 1).alias("_hi")
    )
    near = lambda col, value: F.abs(F.col(col) - F.lit(value)) < 1e-9
    found = base.crossJoin(one)  # one row each
    hits = F.col("true_positives") + F.col("false_negatives")
    return found.select(
        "n_rows", "positives",
        ((hits == F.col("positives")) & (hits + F.col("true_negatives") + F.col("false_positives") == F.col("n_rows"))).alias("counts_agree"),
        near("auc", again["auc"]).alias("auc_agrees"),
        near("average_precision", again["ap"]).alias("ap_agrees"),
        (F.col("_lo") & F.col("_hi")).alias("scores_in_range"),
    )


@query("m03_regimes_compared_reduced")
def m03_reduced(spark, d):
    """Metrics of unweighted and weighted training on the same rows."""
    rows = settle(_merged(spark, d), "rows")
    return compare_runs(tabular_run(rows, SPEC, PARAMS, "none"), tabular_run(rows, SPEC, PARAMS, "both"), "TransactionID")


@query("m04_staged_ap_reduced")
def m04_reduced(spark, d):
    """Average precision per number of rounds."""
    model, ready, _, _ = small_model(spark, d)
    return mo.staged_ap(model, ready.filter("split = 'test'").withColumn("label", F.col("isFraud")))


@query("m04_best_rounds_reduced")
def m04_best_reduced(spark, d):
    model, ready, _, _ = small_model(spark, d)
    return mo.best_rounds(model, ready.filter("split = 'test'").withColumn("label", F.col("isFraud")), patience=3)


@query("m05_score_reduced")
def m05_reduced(spark, d):
    """The probability of every row."""
    model, ready, _, _ = small_model(spark, d)
    return mo.score(model, ready).select("TransactionID", "split", "score")


@query("m08_importances_reduced")
def m08_reduced(spark, d):
    model, _, _, slots = small_model(spark, d)
    return mo.top_importances(model, slots, spark)


@query("m07_hybrid_reduced")
def m07_reduced(spark, d):
    """Scores of the held-out rows by graph features and boosted trees."""
    return hybrid_scores(spark, d).select("TransactionID", "isFraud", "score")


def _merged(spark, d):
    return merge_identity(clean_txn(spark, d), b.idn(spark, d))


def small_model(spark, d, params=PARAMS):
    """Boosted trees on training rows: (model, assembled rows with ``split``, parameters, slot names)."""
    rows = settle(stratified_split(settle(_merged(spark, d), "rows"), "isFraud", "TransactionID", 0.2), "split")
    ready, slots = mo.assemble(rows, SPEC, flag_missing=True, fit_on=rows.filter("split = 'train'"))
    ready = settle(ready.select("TransactionID", "isFraud", "split", "features"), "features")
    train = mo.regime_weights(ready.filter("split = 'train'"), "isFraud", "pos")
    return mo.train_gbt(train, params, "isFraud", weight="weight"), ready, params, slots


@query("m02_train_gbt", f"{_CHECKED}, 100 AS trees FROM held")
def m02(spark, d):
    """The published 100 rounds of depth 6."""
    model, ready, _, _ = small_model(spark, d, PUBLISHED)
    return checked(mo.score(model, ready.filter("split = 'test'")), "isFraud").withColumn("trees", F.lit(model.getNumTrees))


@query("m03_regime_weights", """
    WITH w AS (SELECT count(*) AS n, sum(isFraud) AS ones, count(*) - sum(isFraud) AS zeros FROM split WHERE split = 'train'),
         v AS (SELECT TransactionID, n / (2.0::DOUBLE * CASE isFraud WHEN 1 THEN ones ELSE zeros END) AS balanced,
                      CASE isFraud WHEN 1 THEN zeros / CAST(ones AS DOUBLE) ELSE 1.0 END AS positive FROM split, w WHERE split = 'train')
    SELECT TransactionID, 1.0::DOUBLE AS none, round(balanced, 6) AS sample, round(positive, 6) AS pos, round(balanced * positive, 6) AS both FROM v""")
def m03(spark, d):
    rows = split_txn(spark, d, "isFraud").filter("split = 'train'").select("TransactionID", "isFraud")
    for regime in mo.REGIMES:
        rows = mo.regime_weights(rows, "isFraud", regime, regime)
    return rows.select("TransactionID", *[F.round(r, 6).alias(r) for r in mo.REGIMES])


@query("m03_regimes_compared", """
    SELECT unnest(['auc', 'average_precision', 'best_f1_score', 'spearman', 'prevalence']) AS metric, true AS in_range,
           unnest([NULL, NULL, NULL, NULL, round(positives / CAST(n_rows AS DOUBLE), 6)]) AS fixed FROM held""")
def m03_compared(spark, d):
    """Unweighted against weighted training on the same rows; the prevalence is fixed by the data."""
    rows = settle(_merged(spark, d), "rows")
    first = tabular_run(rows, SPEC, PARAMS, "none")
    second = tabular_run(rows, SPEC, PARAMS, "both")
    found = compare_runs(first, second, "TransactionID")
    low = F.when(F.col("metric") == "spearman", -1).otherwise(0)
    inside = F.col("first").between(low, 1) & F.col("second").between(low, 1)
    return found.select("metric", inside.alias("in_range"), F.when(F.col("metric") == "prevalence", F.round("first", 6)).alias("fixed"))


@query("m04_staged_ap", """
    SELECT CAST(unnest(range(1, 9)) AS INTEGER) AS rounds, true AS in_range, unnest([NULL, NULL, NULL, NULL, NULL, NULL, NULL, true]) AS last_agrees""")
def m04(spark, d):
    """Average precision per number of rounds; after the last one it is that of the model's own scores."""
    model, ready, _, _ = small_model(spark, d)
    valid = ready.filter("split = 'test'").withColumn("label", F.col("isFraud"))
    whole = average_precision(mo.score(model, valid)).first()[0]
    ap = F.col("average_precision")
    agrees = F.when(F.col("rounds") == PARAMS.rounds, F.abs(ap - F.lit(whole)) < 1e-9)
    return mo.staged_ap(model, valid).select("rounds", ((ap > 0) & (ap <= 1)).alias("in_range"), agrees.alias("last_agrees"))


@query("m04_best_rounds", "SELECT true AS best_is_largest, true AS stop_in_range FROM (SELECT 1)")
def m04_best(spark, d):
    """The best round has the largest average precision up to the stop, and the stop lies within patience of it."""
    model, ready, _, _ = small_model(spark, d)
    valid = ready.filter("split = 'test'").withColumn("label", F.col("isFraud"))
    found = mo.best_rounds(model, valid, patience=3).first()
    stages = mo.staged_ap(model, valid).filter(F.col("rounds") <= found["stop_epoch"])
    largest = F.max_by("rounds", F.struct("average_precision", -F.col("rounds")))
    stop = min(found["best_epoch"] + 3, PARAMS.rounds)
    return stages.agg((largest == found["best_epoch"]).alias("best_is_largest"), F.lit(found["stop_epoch"] == stop).alias("stop_in_range"))


@query("m05_score", "SELECT TransactionID, split, true AS in_range FROM strata")
def m05(spark, d):
    model, ready, _, _ = small_model(spark, d)
    return mo.score(model, ready).select("TransactionID", "split", F.col("score").between(0, 1).alias("in_range"))


@query("m08_importances", """
    SELECT unnest(['ProductCD_code', 'card4_code', 'DeviceType_code', 'TransactionAmt_num', 'TransactionAmt_missing', 'C1_num', 'C1_missing',
                   'D1_num', 'D1_missing', 'card1_num', 'card1_missing']) AS feature, true AS in_range, 1.0::DOUBLE AS total""")
def m08(spark, d):
    model, _, _, slots = small_model(spark, d)
    found = mo.top_importances(model, slots, spark)
    total = found.agg(F.round(F.sum("importance"), 9)).first()[0]
    return found.select("feature", F.col("importance").between(0, 1).alias("in_range"), F.lit(total).alias("total"))


@query("m09_assemble", """
    WITH k AS (SELECT ProductCD, row_number() OVER (ORDER BY ProductCD) - 1 AS code FROM (SELECT DISTINCT ProductCD FROM txn))
    SELECT TransactionID, 11 AS n, code::DOUBLE AS product, coalesce(TransactionAmt, 0) AS amt, CASE WHEN TransactionAmt IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS amt_missing
    FROM txn JOIN k USING (ProductCD)""")
def m09(spark, d):
    rows, slots = mo.assemble(settle(_merged(spark, d), "rows"), SPEC, flag_missing=True)
    values = vector_to_array("features")
    slot = lambda name: values[slots.index(name)]
    return rows.select(
        "TransactionID", F.size(values).alias("n"), slot("ProductCD_code").alias("product"), slot("TransactionAmt_num").alias("amt"),
        slot("TransactionAmt_missing").alias("amt_missing"),
    )


@query("g09_embedding_head", f"""
    WITH own AS (SELECT count(*) AS n_rows, sum(isFraud) AS positives FROM train) {_CHECKED}, true AS converged FROM own""")
def g09(spark, d):
    """Linear head on propagated transaction vectors, positives weighted."""
    from fraudlens.operators.graph import propagate_k
    from fraudlens.queries.graph_q import small_graph

    train, cards, emails, nodes, edges = small_graph(spark, d)
    start = cards.count() + emails.count()
    wide = propagate_k(nodes, edges, 2, hops=2)
    rows = train.select((F.col("row_id") + start).alias("node_id"), "isFraud").join(wide, "node_id")
    rows = settle(mo.regime_weights(rows, "isFraud", "pos"), "head")
    head = mo.train_head(rows, "feat", "isFraud", "weight")
    from pyspark.ml.functions import array_to_vector

    scored = mo.score(head, rows.withColumn("features", array_to_vector("feat")))
    return checked(scored, "isFraud").withColumn("converged", F.lit(mo.head_converged(head)))


@query("m07_hybrid_model", f"""
    WITH own AS (SELECT count(*) AS n_rows, sum(isFraud) AS positives FROM split WHERE split = 'test') {_CHECKED} FROM own""")
def m07_hybrid(spark, d):
    """Graph features and boosted trees end to end: profiles, propagation, entity vectors, training, evaluation."""
    return checked(hybrid_scores(spark, d), "isFraud")


def hybrid_scores(spark, d):
    from fraudlens.operators.clean import add_simple_device

    rows = split_txn(spark, d)
    full = settle(add_simple_device(merge_identity(rows, b.idn(spark, d))), "rows")
    ready = settle(hybrid_features(full, ORDER).select("TransactionID", "isFraud", "split", "features"), "features")
    train = mo.regime_weights(ready.filter("split = 'train'"), "isFraud", "both")
    model = mo.train_gbt(train, PARAMS, "isFraud", weight="weight")
    return mo.score(model, ready.filter("split = 'test'"))


@query("x02_leave_one_out", """
    SELECT TransactionID, CASE WHEN n > 1 THEN (s - isFraud) / CAST(n - 1 AS DOUBLE) ELSE 0.0 END AS fraud_rate FROM (
      SELECT TransactionID, isFraud, count(*) OVER w AS n, sum(isFraud) OVER w AS s FROM split WHERE split = 'train' WINDOW w AS (PARTITION BY card1, card2, card4))""")
def x02(spark, d):
    """Card risk of training rows without their own label."""
    train = split_txn(spark, d, "isFraud", *CARD).filter("split = 'train'")
    return leave_one_out(train, CARD).select("TransactionID", "fraud_rate")


@query("x03_time_causal", """
    SELECT TransactionID, CASE WHEN n > 0 THEN s / CAST(n AS DOUBLE) ELSE 0.0 END AS fraud_rate FROM (
      SELECT TransactionID, count(*) OVER w AS n, sum(isFraud) OVER w AS s FROM clean
      WINDOW w AS (PARTITION BY card1, card2, card4 ORDER BY TransactionDT, TransactionID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
def x03(spark, d):
    """Card risk of all rows as it was known before each of them."""
    rows = clean_txn(spark, d).select(*ORDER, "isFraud", *CARD)
    return time_causal(rows, CARD, ORDER).select("TransactionID", "fraud_rate")

import random

import pytest
from pyspark.sql import functions as F

from fraudlens.operators import metrics as m

SCHEMA = "label int, score double"


def small(spark):
    return spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], SCHEMA)


def brute_auc(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(rows):
    total, out, seen = sum(y for y, _ in rows), 0.0, 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        hit = [y for y, s in rows if s >= t]
        recall = sum(hit) / total
        out += (recall - seen) * sum(hit) / len(hit)
        seen = recall
    return out


def brute_rank(values):
    return [sum(w < v for w in values) + (sum(w == v for w in values) + 1) / 2 for v in values]


def test_hand_case(spark):
    r = m.evaluate(small(spark)).first()
    assert r.auc == 0.875 and round(r.average_precision, 6) == 0.833333
    assert round(r.best_f1_score, 6) == 0.8 and r.best_threshold == 0.8
    assert (r.true_positives, r.false_positives, r.true_negatives, r.false_negatives) == (2, 1, 1, 0)
    assert round(r.precision, 6) == 0.666667 and r.recall == 1.0 and r.specificity == 0.5


@pytest.mark.parametrize("seed,digits", [(1, 1), (2, 2), (3, 6)])
def test_against_brute_force(spark, seed, digits):
    rng = random.Random(seed)
    rows = [(int(rng.random() < 0.3), round(rng.random() ** 2, digits)) for _ in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert abs(m.roc_auc(df).first().auc - brute_auc(rows)) < 1e-12
    assert abs(m.average_precision(df).first().average_precision - brute_ap(rows)) < 1e-12
    flipped = df.withColumn("score", -F.col("score"))
    assert abs(m.roc_auc(flipped).first().auc - (1 - brute_auc(rows))) < 1e-12
    spread = df.repartition(13)
    assert m.evaluate(spread).first() == m.evaluate(df.coalesce(1)).first()


def test_curves(spark):
    pr = m.pr_curve(small(spark)).collect()
    assert {(r.threshold, round(r.precision, 6), r.recall) for r in pr} == {(0.9, 1.0, 0.5), (0.8, 0.666667, 1.0), (0.1, 0.5, 1.0), (None, 1.0, 0.0)}
    roc = m.roc_curve(small(spark)).collect()
    assert {(r.threshold, r.fpr, r.tpr) for r in roc} == {(float("inf"), 0.0, 0.0), (0.9, 0.0, 0.5), (0.8, 0.5, 1.0), (0.1, 1.0, 1.0)}


def test_best_f1_prefers_lowest_threshold(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5)], SCHEMA)
    assert m.best_f1(df).first().best_threshold == 0.9
    none = spark.createDataFrame([(0, 0.9), (0, 0.5)], SCHEMA)
    assert tuple(m.best_f1(none).first()) == (0.0, 0.5)


def test_one_class(spark):
    none = spark.createDataFrame([(0, 0.9), (0, 0.5)], SCHEMA)
    r = m.evaluate(none).first()
    assert r.auc is None and r.average_precision == 0.0 and r.recall == 0.0


def test_confusion_and_points(spark):
    r = m.point_metrics(m.confusion(small(spark), 0.8)).first()
    assert (r.tn, r.fp, r.fn, r.tp) == (1, 1, 0, 2) and r.accuracy == 0.75 and round(r.f1, 6) == 0.8
    assert m.point_metrics(m.confusion(small(spark), 5.0)).first().precision == 0.0


@pytest.mark.parametrize("tuning", [{}, {"broadcast_bytes": 0}])
def test_spearman(spark, tuning):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (2.0, 2.0), (4.0, 4.0)], "a double, b double")
    assert round(m.spearman(df, "a", "b", **tuning).first().spearman, 6) == 0.948683
    ranks = m.avg_rank(df, "a", **tuning).collect()
    assert sorted((r.a, r["rank"]) for r in ranks) == [(1.0, 1.0), (2.0, 2.5), (2.0, 2.5), (4.0, 4.0)]


def test_rank_against_brute_force(spark):
    rng = random.Random(5)
    values = [float(rng.randint(0, 9)) if i % 3 else 4.0 for i in range(200)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = [r["rank"] for r in m.avg_rank(df, "v").orderBy("i").collect()]
    assert got == brute_rank(values)


def test_average_precision_by_group(spark):
    rng = random.Random(9)
    rows = [(g, int(rng.random() < 0.4), round(rng.random(), 1)) for g in (1, 2, 3) for _ in range(80)]
    out = m.average_precision_by(spark.createDataFrame(rows, "g int, label int, score double"), "g").collect()
    for r in out:
        assert abs(r.average_precision - brute_ap([(y, s) for g, y, s in rows if g == r.g])) < 1e-12


def test_log_loss(spark):
    import math

    df = spark.createDataFrame([(1, 0.8), (0, 0.3), (1, 1.0)], SCHEMA)
    want = -(2 * math.log(0.8) + math.log(0.7) + 2 * math.log(1 - 1e-7)) / 3
    assert abs(m.bce(df, pos_weight=2.0).first().log_loss - want) < 1e-12


def test_compare(spark):
    df = small(spark).withColumn("other", 1 - F.col("score"))
    out = {r.metric: r for r in m.compare(df, "score", "other").collect()}
    assert out["auc"].first == 0.875 and out["auc"].second == 0.125 and out["auc"].difference == -0.75
    assert round(out["auc"].percent, 6) == round((0.125 / 0.875 - 1) * 100, 6)
    assert out["prevalence"].first == 0.5 and round(out["spearman"].first, 6) == -1.0

"""Histogram boosting against a plain tree builder; missing values, weights, stopping, saving."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from fraudlens.operators import boosting as bo
from fraudlens.operators.boosting import BoostedTrees, BoostParams, FeatureBins, train_boosting
from fraudlens.operators.metrics import average_precision
from fraudlens.session import settle, workspace

COLS = ["a", "b", "c", "same", "none"]
WHOLE = {"subsample": 1.0, "colsample": 1.0}


@pytest.fixture(scope="module")
def data():
    rng = random.Random(4)
    rows = []
    for i in range(900):
        a = rng.choice([None, *range(12)])
        b = rng.choice([float("nan"), None]) if rng.random() < 0.2 else round(rng.gauss(0, 2), 3)
        c = rng.randrange(3)
        hidden = (a is None) * 1.5 + (0 if b is None or math.isnan(b) else b) + c - 1 + rng.gauss(0, 0.7)
        rows.append((i, None if a is None else float(a), b, c, 7, None, int(hidden > 1), 1.0 + c / 2))
    return rows


@pytest.fixture(scope="module")
def frame(spark, data):
    return settle(spark.createDataFrame(data, "id long, a double, b double, c int, same int, none double, y int, w double").repartition(3))


def plain_boosting(rows, cuts, params, weighted):
    """Trees as nested tuples, built row by row; rows are (bins, label, weight)."""
    margins, trees = [0.0] * len(rows), []
    scale = 1 << 40
    for _ in range(params.rounds):
        grads = []
        for (_, y, w), m in zip(rows, margins):
            p, w = 1 / (1 + math.exp(-m)), w if weighted else 1.0
            grads.append((math.floor(w * (p - y) * scale + 0.5) / scale, math.floor(w * p * (1 - p) * scale + 0.5) / scale))

        def build(ids, depth):
            g, h = (sum(grads[i][k] for i in ids) for k in (0, 1))
            best = None
            for f in range(len(cuts)) if depth < params.max_depth else ():
                for cut in sorted({rows[i][0][f] for i in ids} - {-1}):
                    for default_left in (True, False):
                        left = [i for i in ids if (default_left if rows[i][0][f] < 0 else rows[i][0][f] <= cut)]
                        gl, hl = (sum(grads[i][k] for i in left) for k in (0, 1))
                        if hl < params.min_child_weight or h - hl < params.min_child_weight:
                            continue
                        gain = gl**2 / (hl + params.reg_lambda) + (g - gl) ** 2 / (h - hl + params.reg_lambda) - g**2 / (h + params.reg_lambda)
                        if gain > params.gamma and (best is None or gain > best[0] + 1e-9):
                            best = (gain, f, cut, default_left, left)
            if best is None:
                return -params.learning_rate * g / (h + params.reg_lambda)
            inside = set(best[4])
            return (*best[:4], build(best[4], depth + 1), build([i for i in ids if i not in inside], depth + 1))

        tree = build(range(len(rows)), 0)
        trees.append(tree)
        for i, (bins, _, _) in enumerate(rows):
            node = tree
            while isinstance(node, tuple):
                b = bins[node[1]]
                node = node[4] if (node[3] if b < 0 else b <= node[2]) else node[5]
            margins[i] += node
    return trees, margins


def same_tree(tree, node, want):
    if not isinstance(want, tuple):
        return node in tree.leaves and tree.leaves[node] == pytest.approx(want, abs=1e-9)
    split = tree.splits.get(node)
    return (
        split is not None and (split.feature, split.bin, split.default_left) == want[1:4] and split.gain == pytest.approx(want[0], abs=1e-6)
        and same_tree(tree, 2 * node + 1, want[4]) and same_tree(tree, 2 * node + 2, want[5])
    )


@pytest.mark.parametrize("gamma, weighted", [(0.0, False), (4.0, True)])
def test_against_plain_trees(frame, data, gamma, weighted):
    params = BoostParams(rounds=3, learning_rate=0.3, max_depth=3, gamma=gamma, max_bins=8, **WHOLE)
    model = train_boosting(frame, COLS, params, "y", "w" if weighted else None, accuracy=100_000)
    cuts = model.bins.cuts
    assert cuts["none"] == [] and cuts["same"] == [7.0]
    place = lambda v, c: -1 if v is None or math.isnan(v) else sum(x <= v for x in cuts[c])
    rows = [(tuple(place(v, c) for v, c in zip(r[1:6], COLS)), r[6], r[7]) for r in data]
    trees, margins = plain_boosting(rows, cuts, params, weighted)
    assert all(same_tree(tree, 0, want) for tree, want in zip(model.trees, trees))
    assert any(not s.default_left for t in model.trees for s in t.splits.values())
    scores = {r["id"]: r["score"] for r in model.score(frame).collect()}
    assert all(scores[r[0]] == pytest.approx(1 / (1 + math.exp(-m)), abs=1e-9) for r, m in zip(data, margins))


def test_partitioning_changes_nothing(frame):
    params = BoostParams(rounds=3, max_depth=3, learning_rate=0.2, max_bins=16, subsample=0.7, colsample=0.5)
    one, other = (train_boosting(frame.repartition(n), COLS, params, "y", key="id", accuracy=100_000) for n in (1, 7))
    assert one.trees == other.trees and len({tuple(sorted(s.feature for s in t.splits.values())) for t in one.trees}) > 1


def test_stop_while_training(spark, frame):
    """No tree beyond the stop; every round's average precision is that of the scores emitted after it."""
    train, valid = frame.filter("id % 3 > 0"), frame.filter("id % 3 = 0")
    noisy = valid.withColumn("y", F.when(F.col("id") % 2 == 0, F.col("y")).otherwise(1 - F.col("y")))
    params = BoostParams(rounds=30, max_depth=2, learning_rate=0.5, max_bins=8, patience=2, **WHOLE)
    model = train_boosting(train, COLS, params, "y", valid=noisy)
    aps = [ap for _, ap in model.history]
    assert [r for r, _ in model.history] == list(range(1, len(model.trees) + 1))
    assert model.best_round == aps.index(max(aps)) + 1 and len(model.trees) == min(30, model.best_round + 2) < 30
    for rounds, ap in model.history:
        scored = settle(model.score(noisy, rounds=rounds).select(F.col("y").alias("label"), "score"))
        assert average_precision(scored).first()[0] == pytest.approx(ap, abs=1e-12)
        rows = scored.toPandas()  # noqa: F841
        again = duckdb.sql("""
            SELECT sum(pos / total * tp / (tp + fp)) FROM (SELECT pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS total FROM (
              SELECT score, sum(label)::DOUBLE AS pos, (count(*) - sum(label))::DOUBLE AS neg FROM rows GROUP BY score) WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))""").fetchall()[0][0]
        assert again == pytest.approx(ap, abs=1e-12)


def test_save_and_load(spark, frame):
    params = BoostParams(rounds=2, max_depth=3, max_bins=8, patience=5, **WHOLE)
    model = train_boosting(frame, COLS, params, "y", valid=frame)
    path = workspace(spark, "boosted")
    model.save(path, spark)
    again = BoostedTrees.load(path, spark)
    assert again.trees == model.trees and again.params == params and again.history == model.history and again.bins == model.bins
    both = again.score(frame, "s").join(model.score(frame).select("id", "score"), "id")
    assert both.filter("s <> score").isEmpty()
    shares = {r["feature"]: r["importance"] for r in model.importances(spark).collect()}
    assert set(shares) == set(COLS) and sum(shares.values()) == pytest.approx(1) and shares["none"] == shares["same"] == 0
    table = model.tree_table(spark)
    assert table.filter("feature IS NOT NULL AND (cut IS NULL OR gain <= 0)").isEmpty() and table.filter("value IS NOT NULL").count() > 2


def test_odd_inputs(spark, frame):
    params = BoostParams(rounds=1, max_depth=2, **WHOLE)
    one_class = train_boosting(frame.withColumn("y", F.lit(0)), COLS, params, "y")
    assert one_class.trees[0].splits == {} and one_class.trees[0].leaves[0] < 0
    none = train_boosting(frame.limit(0), COLS, params, "y")
    assert none.score(frame).agg(F.min("score"), F.max("score")).first() == (0.5, 0.5)
    unlabelled = frame.withColumn("y", F.when(F.col("id") < 5, F.col("y")))
    assert len(train_boosting(unlabelled, COLS, params, "y").trees) == 1
    with pytest.raises(ValueError):
        train_boosting(frame, COLS, BoostParams(num_parallel_tree=2), "y")
    clash = frame.withColumn("bins", F.lit("x")).withColumn("score", F.lit(3))
    assert FeatureBins.fit(clash, ["a"]).transform(clash, "place").columns == [*clash.columns, "place"]


def test_fixed_point_fits():
    for weight in (0, 1, 1e6, 1e12, 1e18):
        assert weight * bo._scale(weight) < 2**62 and bo._scale(weight) <= 1 << 40

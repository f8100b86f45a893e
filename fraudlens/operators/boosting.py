"""Histogram boosting with a branch for missing values, and a stop while it trains.

Values fall into quantile bins once. A level of a tree is one aggregation: gradients and Hessians summed
by node, feature and bin, combined in every task before the shuffle. What is exchanged is bounded by
nodes x features x bins and tasks, never by rows; what reaches the driver is one row per node. Sums are
made of whole numbers (gradients in fixed point), so a tree does not depend on the partitioning.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fraudlens.functions.scalars import sigmoid
from fraudlens.operators.metrics import average_precision
from fraudlens.operators.model import TreeParams
from fraudlens.session import settle

MOST_BITS = 40  # binary places of a gradient at most
MISSING_BIN = -1


@dataclass(frozen=True)
class BoostParams(TreeParams):
    """Parameters of the second-order trees beside those of ``TreeParams``."""

    reg_lambda: float = 1.0
    min_child_weight: float = 1.0


@dataclass
class FeatureBins:
    """Cut points per column. A value's bin is the number of cuts at or below it; missing (null or NaN) is -1."""

    cuts: dict[str, list[float]]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], max_bins: int = 32, accuracy: int = 10_000) -> FeatureBins:
        """Quantiles of all columns in one aggregation of mergeable sketches, each at most 1/``accuracy`` off in rank."""
        shares = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
        known = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in cols}
        row = df.agg(*[F.percentile_approx(known[c], shares, accuracy).alias(c) for c in cols]).first()
        return cls({c: sorted(set(row[c] or [])) for c in cols})

    def transform(self, df: DataFrame, name: str = "bins") -> DataFrame:
        """Add the row's bins as one array, in the order of the columns."""
        cols = list(self.cuts)
        cut = [c for c in cols if self.cuts[c]]
        as_double = {c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols}
        rows = df.select("*", *[as_double[c].alias(f"_in{i}") for i, c in enumerate(cols)])
        if cut:
            places = [cols.index(c) for c in cut]
            splits = [[-math.inf, *self.cuts[c], math.inf] for c in cut]
            rows = Bucketizer(
                splitsArray=splits, inputCols=[f"_in{i}" for i in places], outputCols=[f"_bin{i}" for i in places], handleInvalid="keep"
            ).transform(rows)
        bins = [
            F.when(F.isnan(f"_in{i}"), MISSING_BIN).otherwise(F.col(f"_bin{i}") if self.cuts[c] else F.lit(0)).cast("int")
            for i, c in enumerate(cols)
        ]
        return rows.select(*df.columns, F.array(*bins).alias(name))


@dataclass(frozen=True)
class Split:
    """Rows whose bin is ``bin`` or less go left (node 2n+1), others right (2n+2), missing ones by ``default_left``."""

    feature: int
    bin: int
    default_left: bool
    gain: float


@dataclass
class Tree:
    """Splits and leaf values by node; the root is 0."""

    splits: dict[int, Split] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def _route(self, node: int, end, bins: str) -> str:
        split = self.splits.get(node)
        if split is None:
            return end(node)
        value = f"{bins}[{split.feature}]"
        left = f"{value} <= {split.bin}" + (f"" if split.default_left else f" AND {value} <> {MISSING_BIN}")
        return f"IF({left}, {self._route(2 * node + 1, end, bins)}, {self._route(2 * node + 2, end, bins)})"

    def node(self, bins: str = "bins") -> Column:
        """The node that a row has come down to."""
        return F.expr(self._route(0, str, bins))

    def value(self, bins: str = "bins") -> Column:
        """The value of a row's leaf."""
        return F.expr(self._route(0, lambda n: f"DOUBLE('{self.leaves[n]!r}')", bins))


def gradients(margin: str = "margin", label: str = "label", weight: str = "weight", scale: int = 1 << MOST_BITS) -> tuple[Column, Column]:
    """First and second derivative of the weighted log-loss, in units of 1/``scale``."""
    p = 1 / (1 + F.exp(-F.col(margin)))
    g, h = F.col(weight) * (p - F.col(label)), F.col(weight) * p * (1 - p)
    return tuple(F.floor(x * F.lit(float(scale)) + 0.5).cast("long") for x in (g, h))


def histograms(rows: DataFrame, node: Column, g: Column, h: Column, features: Sequence[int], bins: str = "bins") -> DataFrame:
    """``(node, feature, bin, g, h)``: sums of gradients and Hessians."""
    cells = rows.select(node.alias("node"), g.alias("g"), h.alias("h"), F.posexplode(bins).alias("feature", "bin"))
    return cells.filter(F.col("feature").isin(list(features))).groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(hist: DataFrame, params: BoostParams, scale: int) -> DataFrame:
    """``(node, gain, feature, bin, default_left, g, h, gl, hl)``: the best split of every node that has one.

    Every bin may end the left side, and missing values go where the gain is larger, to the left in ties.
    Of equal gains the first feature and its first bin win.
    """
    cell = Window.partitionBy("node", "feature")
    upto = cell.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    known, unit = F.col("bin") > MISSING_BIN, 1.0 / scale

    def total(name: str, over, only: Column | None = None) -> Column:
        value = F.col(name) if only is None else F.when(only, F.col(name)).otherwise(0)
        return F.sum(value).over(over) * F.lit(unit)

    cells = hist.select(
        "node", "feature", "bin",
        total("g", cell).alias("g"), total("h", cell).alias("h"),
        total("g", upto, known).alias("kg"), total("h", upto, known).alias("kh"),
        total("g", cell, ~known).alias("mg"), total("h", cell, ~known).alias("mh"),
    ).filter(known)
    lam, least = F.lit(params.reg_lambda), F.lit(params.min_child_weight)

    def side(left: bool) -> Column:
        gl = F.col("kg") + F.col("mg") if left else F.col("kg")
        hl = F.col("kh") + F.col("mh") if left else F.col("kh")
        gr, hr = F.col("g") - gl, F.col("h") - hl
        gain = gl * gl / (hl + lam) + gr * gr / (hr + lam) - F.col("g") * F.col("g") / (F.col("h") + lam)
        allowed = (hl >= least) & (hr >= least) & (gain > F.lit(params.gamma))
        return F.when(allowed, F.struct(gain.alias("gain"), F.lit(left).alias("default_left"), gl.alias("gl"), hl.alias("hl")))

    best = F.greatest(side(True), side(False))  # true is greater than false
    order = F.struct(
        F.col("s.gain").alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), F.col("s.default_left").alias("default_left"),
        F.col("s.gl").alias("gl"), F.col("s.hl").alias("hl"), "g", "h",
    )
    top = cells.withColumn("s", best).filter("s IS NOT NULL").groupBy("node").agg(F.max(order).alias("t"))
    return top.select(
        "node", "t.gain", (-F.col("t.f")).alias("feature"), (-F.col("t.b")).alias("bin"), "t.default_left", "t.g", "t.h", "t.gl", "t.hl"
    )


def grow_tree(rows: DataFrame, params: BoostParams, features: Sequence[int], scale: int) -> Tree:
    """One tree on ``rows`` (bins, label, weight, margin), level by level."""
    g, h = gradients(scale=scale)
    total = rows.agg(F.sum(g).alias("g"), F.sum(h).alias("h")).first()
    tree, sums, open_ = Tree(), {0: ((total["g"] or 0) / scale, (total["h"] or 0) / scale)}, {0}
    for _ in range(params.max_depth):
        node = tree.node()
        inside = rows if 0 in open_ else rows.filter(node.isin(sorted(open_)))
        found = best_splits(histograms(inside, node, g, h, features), params, scale).collect()  # one row a node
        open_ = set()
        for r in found:
            n = r["node"]
            tree.splits[n] = Split(r["feature"], r["bin"], r["default_left"], r["gain"])
            sums[2 * n + 1], sums[2 * n + 2] = (r["gl"], r["hl"]), (r["g"] - r["gl"], r["h"] - r["hl"])
            open_ |= {2 * n + 1, 2 * n + 2}
        if not open_:
            break
    tree.leaves = {n: -params.learning_rate * a / (b + params.reg_lambda) for n, (a, b) in sums.items() if n not in tree.splits}
    return tree


@dataclass
class BoostedTrees:
    """Bins, trees in order, and the validation history: one (round, average precision) per tree grown."""

    bins: FeatureBins
    trees: list[Tree]
    params: BoostParams
    history: list[tuple[int, float]] = field(default_factory=list)

    @property
    def best_round(self) -> int:
        """Rounds to score with: those up to the largest average precision, the first one of equals; all without a history."""
        return max(self.history, key=lambda r: (r[1], -r[0]))[0] if self.history else len(self.trees)

    def _arrays(self) -> tuple[np.ndarray, ...]:
        size = 2 ** (self.params.max_depth + 1) - 1
        feature, cut = np.full((len(self.trees), size), -1), np.zeros((len(self.trees), size), np.int64)
        default, value = np.zeros((len(self.trees), size), bool), np.zeros((len(self.trees), size))
        for t, tree in enumerate(self.trees):
            for n, s in tree.splits.items():
                feature[t, n], cut[t, n], default[t, n] = s.feature, s.bin, s.default_left
            for n, v in tree.leaves.items():
                value[t, n] = v
        return feature, cut, default, value

    def margin(self, bins: str = "bins", rounds: int | None = None) -> Column:
        """Sum of a row's leaves over the first ``rounds`` trees (``best_round``, unless given), in Arrow batches."""
        used = self.best_round if rounds is None else rounds
        feature, cut, default, value = (a[:used] for a in self._arrays())
        depth = self.params.max_depth

        def summed(rows: pd.Series) -> pd.Series:
            total = np.zeros(len(rows))
            if len(rows):
                table, at = np.stack(rows.to_numpy()), np.arange(len(rows))
                for f, c, d, v in zip(feature, cut, default, value):
                    node = np.zeros(len(rows), np.int64)
                    for _ in range(depth):
                        b = table[at, np.maximum(f[node], 0)]
                        left = np.where(b == MISSING_BIN, d[node], b <= c[node])
                        node = np.where(f[node] < 0, node, 2 * node + 2 - left)
                    total += v[node]
            return pd.Series(total)

        return F.pandas_udf(summed, "double")(F.col(bins))

    def score(self, df: DataFrame, name: str = "score", rounds: int | None = None) -> DataFrame:
        """``df`` with the probability of class 1."""
        rows = self.bins.transform(df, "_bins").withColumn("_margin", self.margin("_bins", rounds))
        return rows.select(*df.columns, sigmoid(F.col("_margin")).alias(name))

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance): each column's share of all gain up to ``best_round``; 0 where it has none."""
        gain = dict.fromkeys(self.bins.cuts, 0.0)
        names = list(gain)
        for tree in self.trees[:self.best_round]:
            for s in tree.splits.values():
                gain[names[s.feature]] += s.gain
        total = sum(gain.values()) or 1.0
        return spark.createDataFrame([(c, v / total) for c, v in gain.items()], "feature string, importance double")

    def tree_table(self, spark: SparkSession) -> DataFrame:
        """One row per node: (tree, node, feature, bin, cut, default_left, gain, value); a leaf has only a value."""
        names, rows = list(self.bins.cuts), []
        for t, tree in enumerate(self.trees):
            for n, s in tree.splits.items():
                cuts = self.bins.cuts[names[s.feature]]
                cut = cuts[s.bin] if s.bin < len(cuts) else math.inf
                rows.append((t, n, names[s.feature], s.bin, cut, s.default_left, s.gain, None))
            rows += [(t, n, None, None, None, None, None, v) for n, v in tree.leaves.items()]
        kinds = "tree int, node int, feature string, bin int, cut double, default_left boolean, gain double, value double"
        return spark.createDataFrame(rows, kinds)

    def history_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, "round int, average_precision double")

    def save(self, path: str, spark: SparkSession) -> None:
        """Trees as Parquet, bins, parameters and history as one JSON line."""
        self.tree_table(spark).write.mode("overwrite").parquet(f"{path}/trees")
        about = json.dumps({"cuts": self.bins.cuts, "params": asdict(self.params), "history": self.history})
        spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> BoostedTrees:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        names, trees = list(about["cuts"]), {}
        for r in spark.read.parquet(f"{path}/trees").collect():  # bounded by rounds x 2^depth
            tree = trees.setdefault(r["tree"], Tree())
            if r["feature"] is None:
                tree.leaves[r["node"]] = r["value"]
            else:
                tree.splits[r["node"]] = Split(names.index(r["feature"]), r["bin"], r["default_left"], r["gain"])
        history = [(r, ap) for r, ap in about["history"]]
        return cls(FeatureBins(about["cuts"]), [trees[t] for t in sorted(trees)], BoostParams(**about["params"]), history)


def _scale(weight: float) -> int:
    """Binary places of the fixed point such that the sum of all gradients fits in 62 bits."""
    return 1 << max(0, min(MOST_BITS, 61 - math.ceil(math.log2(max(weight, 1.0)))))


def train_boosting(
    train: DataFrame,
    cols: Sequence[str],
    params: BoostParams,
    label: str = "label",
    weight: str | None = None,
    valid: DataFrame | None = None,
    key: str | None = None,
    accuracy: int = 10_000,
) -> BoostedTrees:
    """Trees for a 0/1 label over numeric columns ``cols``, which may be missing.

    The margins of all rows are kept in a written table, to which every round adds one tree. With
    ``valid`` the average precision on it is measured after each round, and training ends once
    ``patience`` rounds have brought nothing better: no tree is grown beyond. ``subsample`` draws rows of a round
    by a hash of ``key`` (of the bins and label, unless given), ``colsample`` columns by the seed.
    """
    if params.num_parallel_tree != 1:
        raise ValueError("num_parallel_tree > 1 is not supported")
    bins = FeatureBins.fit(train, cols, params.max_bins, accuracy)

    def ready(df: DataFrame, learns: bool) -> DataFrame:
        mass = F.col(weight).cast("double") if weight and learns else F.lit(1.0)
        name = F.xxhash64(F.col(key)) if key else F.xxhash64("bins", label)
        rows = bins.transform(df).select(
            "bins", F.col(label).cast("double").alias("label"), mass.alias("weight"), name.alias("draw"), F.lit(learns).alias("learns"), F.lit(0.0).alias("margin")
        )
        return rows.filter("label IS NOT NULL")

    rows = settle(ready(train, True) if valid is None else ready(train, True).unionAll(ready(valid, False)), "margins")
    scale = _scale(rows.filter("learns").agg(F.sum("weight")).first()[0] or 0.0)
    model = BoostedTrees(bins, [], params)
    rng = random.Random(params.seed)
    best = (-1.0, 0)
    for round_ in range(1, params.rounds + 1):
        features = sorted(rng.sample(range(len(cols)), max(1, round(params.colsample * len(cols)))))
        learning = rows.filter("learns")
        if params.subsample < 1:
            share = F.pmod(F.xxhash64("draw", F.lit(params.seed), F.lit(round_)), F.lit(1 << 20)) < int(params.subsample * (1 << 20))
            learning = learning.filter(share)
        tree = grow_tree(learning, params, features, scale)
        model.trees.append(tree)
        last = round_ == params.rounds and valid is None
        if not last:
            moved = F.col("margin") + tree.value()
            rows = settle(rows.withColumn("margin", moved), "margins")
        if valid is not None:
            ap = average_precision(rows.filter("NOT learns"), "label", "margin").first()[0]
            model.history.append((round_, ap))
            if ap > best[0]:
                best = (ap, round_)
            elif round_ - best[1] >= params.patience:
                break
    return model

"""Boosted trees and a linear head on MLlib: assembly, balancing regimes, scoring, staged evaluation."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraudlens.functions.scalars import sigmoid
from fraudlens.operators.encode import LabelEncoder
from fraudlens.operators.metrics import average_precision_by
from fraudlens.operators.ordering import early_stop, stop_summary, top_k
from fraudlens.operators.profile import class_weights, pos_weight
from fraudlens.schema import FeatureSpec
from fraudlens.session import settle, workspace

# The balancing regimes that are compared.
REGIMES = ("none", "sample", "pos", "both")

CELLS = 8_000_000  # feature values of training rows in one partition; a learner keeps and reads whole partitions


@dataclass(frozen=True)
class TreeParams:
    """Parameters of the boosted trees; the defaults are the tuned notebook setting."""

    rounds: int = 1000
    learning_rate: float = 0.03
    max_depth: int = 6
    subsample: float = 0.8
    colsample: float = 0.8
    gamma: float = 0.0
    num_parallel_tree: int = 1
    patience: int = 50
    max_bins: int = 32
    seed: int = 42


def assemble(
    df: DataFrame, spec: FeatureSpec, output: str = "features", flag_missing: bool = False, max_nominal: int = 32, fit_on: DataFrame | None = None
) -> tuple[DataFrame, list[str]]:
    """Feature vector and the names of its slots; codes are fitted on ``fit_on`` (training rows), else on ``df``.

    Categorical columns are label-encoded; those with few classes are marked nominal for the trees.
    Trees here have no branch for missing values: numbers missing become 0, and ``flag_missing`` adds a
    0/1 column per numerical feature that tells.
    """
    encoder = LabelEncoder(spec.categorical, reserve_unseen=fit_on is not None).fit(df if fit_on is None else fit_on)
    out = encoder.transform(df, suffix="_code")
    inputs, made = [], []
    for c in encoder.cols:
        n = encoder.sizes[c]
        meta = {"ml_attr": {"type": "nominal", "vals": [str(i) for i in range(n)]}} if n <= max_nominal else {}
        made.append(F.col(f"{c}_code").cast("double").alias(f"{c}_code", metadata=meta))
        inputs.append(f"{c}_code")
    for c in spec.numerical:
        made.append(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"{c}_num"))
        inputs.append(f"{c}_num")
        if flag_missing:
            made.append(F.col(c).isNull().cast("double").alias(f"{c}_missing"))
            inputs.append(f"{c}_missing")
    kept = [c for c in df.columns if c not in inputs]
    wide = out.select(*kept, *made)
    vector = VectorAssembler(inputCols=inputs, outputCol=output).transform(wide)
    return vector.select(*kept, output), inputs


def regime_weights(df: DataFrame, label: str, regime: str, name: str = "weight") -> DataFrame:
    """Add the sample weight of one balancing regime, fitted on ``df``: 1, balanced class weight,
    negatives per positive for positives, or the product of both."""
    if regime not in REGIMES:
        raise ValueError(f"regime is one of {REGIMES}")
    weight: Column = F.lit(1.0)
    if regime in ("sample", "both"):
        by_class = {r[label]: r["class_weight"] for r in class_weights(df, label).collect()}  # a row per class
        weight = weight * F.coalesce(*[F.when(F.col(label) == c, F.lit(w)) for c, w in by_class.items()])
    if regime in ("pos", "both"):
        ratio = pos_weight(df, label).first()["scale_pos_weight"]
        weight = weight * F.when(F.col(label) == 1, F.lit(ratio)).otherwise(F.lit(1.0))
    return df.withColumn(name, weight)


def spread(rows: DataFrame, features: str = "features") -> DataFrame:
    """The rows in enough partitions to hold ``CELLS`` feature values each, as they come if they are so already.

    Written files pack well, so a few of their splits may hold all rows; a learner keeps the rows unpacked and
    reads them again for every level of every tree.
    """
    some = rows.select(features).first()
    parts = -(-rows.count() * some[0].size // CELLS) if some else 0
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


def train_gbt(
    df: DataFrame, params: TreeParams, label: str = "label", features: str = "features", weight: str | None = None
) -> GBTClassificationModel:
    """Distributed gradient-boosted trees for a 0/1 label; every tree's leaf is reported in ``leaf``."""
    if params.num_parallel_tree != 1:
        raise ValueError("num_parallel_tree > 1 is not supported")
    learner = GBTClassifier(
        labelCol="_label",
        featuresCol=features,
        leafCol="leaf",
        maxIter=params.rounds,
        stepSize=params.learning_rate,
        maxDepth=params.max_depth,
        subsamplingRate=params.subsample,
        featureSubsetStrategy=str(params.colsample),
        minInfoGain=params.gamma,
        maxBins=params.max_bins,
        seed=params.seed,
    )
    rows = df.select(F.col(label).cast("double").alias("_label"), features, *([weight] if weight else []))
    if weight:
        learner = learner.setWeightCol(weight)
    return learner.fit(spread(rows, features))


def score(model: Transformer, df: DataFrame, name: str = "score") -> DataFrame:
    """Add the probability of class 1; the model's own columns are dropped."""
    out = model.transform(df)
    return out.select(*df.columns, F.get(vector_to_array("probability"), F.lit(1)).alias(name))


def importances(model: GBTClassificationModel, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """(feature, importance), one row per vector slot."""
    values = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(names, values)), "feature string, importance double")


def top_importances(model: GBTClassificationModel, names: Sequence[str], spark: SparkSession, k: int = 20) -> DataFrame:
    return top_k(importances(model, names, spark), "importance", k, "feature")


def leaf_values(model: GBTClassificationModel, spark: SparkSession) -> list[list[float]]:
    """Weighted prediction of each leaf, per tree; leaves in node order, as the leaf index counts them."""
    path = workspace(spark, "trees")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").filter("leftChild < 0")
    rows = (
        nodes.groupBy("treeID")
        .agg(F.array_sort(F.collect_list(F.struct("id", "prediction"))).alias("leaves"))  # 2^depth at most
        .orderBy("treeID")
        .collect()
    )
    return [[w * leaf["prediction"] for leaf in r["leaves"]] for w, r in zip(model.treeWeights, rows)]


def staged_scores(model: GBTClassificationModel, df: DataFrame, name: str = "score") -> DataFrame:
    """One row per input row and number of rounds, with the probability after that many trees.

    A single pass of the model yields all leaf indices; their values are summed up along a row's trees in
    Arrow batches.
    """
    values = leaf_values(model, df.sparkSession)
    table = np.zeros((len(values), max(map(len, values), default=1)))
    for tree, leaves in enumerate(values):
        table[tree, :len(leaves)] = leaves

    def margins(leaves: pd.Series) -> pd.Series:
        if leaves.empty:
            return pd.Series([], dtype=object)
        at = np.stack(leaves.to_numpy()).astype(np.int64)
        return pd.Series(list(np.cumsum(table[np.arange(len(table)), at], axis=1)))

    staged = F.pandas_udf(margins, "array<double>")(vector_to_array(F.col("leaf")))
    out = model.transform(df).select(*df.columns, F.posexplode(staged).alias("_k", "_margin"))
    return out.select(*df.columns, (F.col("_k") + 1).alias("rounds"), sigmoid(2 * F.col("_margin")).alias(name))


def staged_ap(model: GBTClassificationModel, valid: DataFrame, label: str = "label") -> DataFrame:
    """(rounds, average_precision) on validation rows for every number of trees."""
    staged = staged_scores(model, valid.select(label, "features"))
    return average_precision_by(staged.select(label, "rounds", "score"), "rounds", label, "score")


def best_rounds(model: GBTClassificationModel, valid: DataFrame, patience: int = 50, label: str = "label") -> DataFrame:
    """Best number of rounds by validation average precision, with early stopping after ``patience`` rounds."""
    history = settle(staged_ap(model, valid, label), "history")
    return stop_summary(early_stop(history, "rounds", "average_precision", patience), "rounds")


def train_head(df: DataFrame, vec: str = "feat", label: str = "label", weight: str | None = None, max_iter: int = 200):
    """Linear logit on node vectors; weights make it the positive-weighted loss. ``head_converged`` tells
    whether the fit ended before ``max_iter``."""
    rows = df.withColumn("features", array_to_vector(vec)).withColumn("_label", F.col(label).cast("double"))
    learner = LogisticRegression(labelCol="_label", featuresCol="features", maxIter=max_iter)
    if weight:
        learner = learner.setWeightCol(weight)
    return learner.fit(rows)


def head_converged(head) -> bool:
    return head.summary.totalIterations < head.getMaxIter()


def save_model(model, path: str, params: TreeParams, metrics: DataFrame) -> None:
    """Model with its parameters and metrics beside it."""
    spark = metrics.sparkSession
    PipelineModel([model]).write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(asdict(params)),)], "params string").write.mode("overwrite").json(f"{path}/params")
    metrics.write.mode("overwrite").json(f"{path}/metrics")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, TreeParams, DataFrame]:
    params = spark.read.schema("params string").json(f"{path}/params").first()["params"]
    return PipelineModel.load(f"{path}/model"), TreeParams(**json.loads(params)), spark.read.json(f"{path}/metrics")

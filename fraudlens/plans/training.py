"""Model jobs: boosted trees on tabular columns, and on columns extended by graph-propagated entity vectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from fraudlens.functions.scalars import UNKNOWN
from fraudlens.operators.clean import fill_categorical
from fraudlens.operators.entity import CARD_STATS, PAIR_STATS, entity_stats
from fraudlens.operators.graph import build_edges_hetero, node_features, node_offsets, propagate_k, txn_features, vocab_sizes
from fraudlens.operators.joins import lookup
from fraudlens.operators.metrics import compare, evaluate
from fraudlens.operators.model import TreeParams, assemble, regime_weights, score, train_gbt
from fraudlens.operators.ordering import first_seen_vocab, global_row_id, stratified_split
from fraudlens.schema import FeatureSpec
from fraudlens.session import settle


@dataclass
class Run:
    """A trained model with its scored validation rows."""

    model: object
    scored: DataFrame
    slots: list[str]


def tabular_run(
    df: DataFrame, spec: FeatureSpec, params: TreeParams, regime: str = "both", test_frac: float = 0.2
) -> Run:
    """Stratified split, assembly, class weights, boosted trees, scored validation rows."""
    split = settle(stratified_split(df, spec.label, spec.key, test_frac, params.seed), "split")
    rows, slots = assemble(split, spec, flag_missing=True, fit_on=split.filter("split = 'train'"))
    ready = settle(rows.select(spec.key, spec.label, "split", "features"), "features")
    train = regime_weights(ready.filter("split = 'train'"), spec.label, regime)
    model = train_gbt(train, params, spec.label, weight="weight")
    scored = score(model, ready.filter("split = 'test'")).select(spec.key, F.col(spec.label).alias("label"), "score")
    return Run(model, scored, slots)


def compare_runs(first: Run, second: Run, key: str) -> DataFrame:
    """Metrics of two models over the same validation rows, side by side."""
    both = first.scored.withColumnRenamed("score", "first").join(
        second.scored.select(key, F.col("score").alias("second")), key
    )
    return compare(settle(both, "scores"), "first", "second")


def evaluate_run(run: Run) -> DataFrame:
    return evaluate(run.scored)


GRAPH_KEYS = {"card": ["card1", "card2", "card3", "card4"], "email": ["P_emaildomain"], "device": ["DeviceType", "DeviceInfo_simple"]}


RISK = ("fraud_rate", "fraud_count")  # profile columns that are made of labels


def hybrid_features(
    df: DataFrame,
    order: Sequence[str],
    hops: int = 3,
    dim: int = 16,
    keys: dict[str, list[str]] | None = None,
    label: str = "isFraud",
    own_label: bool = False,
) -> DataFrame:
    """Rows of both splits with ``features``: raw values, card vector, device vector, fraud rates of the entities.

    Entity profiles and the graph come from training rows only; entity vectors are propagated without
    trained weights, over as many hops as the published model has layers, and handed to the rows of every
    split. A training row's own label is in none of its features: fraud rates stay out of the vectors
    that are propagated, and come beside them, for training rows over the entity's other rows.
    ``own_label`` leaves them in the vectors instead.
    """
    keys = {n: [c for c in cols if c in df.columns] for n, cols in (keys or GRAPH_KEYS).items()}
    named = fill_categorical(df, [c for cols in keys.values() for c in cols], UNKNOWN)
    train = global_row_id(named.filter("split = 'train'"), order, "row_id")
    vocabs = {n: first_seen_vocab(train, cols, order) for n, cols in keys.items()}
    stats = {
        n: entity_stats(train, cols, label=label, stats=CARD_STATS if n == "card" else PAIR_STATS)
        for n, cols in keys.items()
    }
    if not own_label:
        stats = {n: s.withColumns({c: F.lit(0.0) for c in RISK if c in s.columns}) for n, s in stats.items()}
    nodes = node_features(train, vocabs, stats, keys, dim=max(dim, 17)).drop("ntype")
    edges = settle(build_edges_hetero(train, vocabs, keys).select("src", "dst"), "edges")
    wide = propagate_k(nodes, edges, max(dim, 17), hops)
    size = max(dim, 17) * (hops + 1)
    start = node_offsets(vocab_sizes(vocabs))
    emb = {
        n: settle(
            vocabs[n].select(*keys[n], (F.col("idx") + start[n]).alias("node_id"))
            .join(wide, "node_id").select(*keys[n], F.col("feat").alias("emb")),
            "embedding",
        )
        for n in ("card", "device")
    }
    if not own_label:  # before the vectors come, which are a hundred times as wide
        named = settle(_entity_risk(named, keys, label), "risks")
    out = txn_features(named, emb["card"], emb["device"], keys["card"], keys["device"], size)
    if not own_label:
        risks = [f"_risk_{n}" for n in keys]
        out = out.withColumn("features", F.concat("features", F.array(*risks))).drop(*risks)
    return out.withColumn("features", array_to_vector("features"))


def _entity_risk(rows: DataFrame, keys: dict[str, list[str]], label: str) -> DataFrame:
    """Each entity's fraud rate among training rows beside the rows, as ``_risk_`` and its name; a training row leaves itself out."""
    train = rows.filter("split = 'train'")
    for n, cols in keys.items():
        name = f"_risk_{n}"
        totals = settle(train.groupBy(*cols).agg(F.sum(F.col(label).cast("long")).alias("_s"), F.count(label).alias("_n")), "risk")
        rows = lookup(rows, totals, cols, "left", null_safe=True)
        own = (F.col("split") == "train") & F.col(label).isNotNull()
        s = F.col("_s") - F.when(own, F.col(label).cast("long")).otherwise(0)
        rows = rows.withColumn(name, F.coalesce(F.try_divide(s, F.col("_n") - own.cast("long")), F.lit(0.0))).drop("_s", "_n")
    return rows

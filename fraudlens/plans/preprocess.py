"""The preprocessing job: two raw tables in, typed, imputed, encoded and scaled rows with a time split out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from fraudlens.functions.scalars import MISSING
from fraudlens.operators.clean import MedianImputer, fill_categorical, normalize_nan, null_placeholders
from fraudlens.operators.encode import LabelEncoder, Scaler
from fraudlens.operators.graph import build_edges_card_email, build_test_graph, node_offsets, vocab_sizes
from fraudlens.operators.joins import merge_identity
from fraudlens.operators.ordering import first_seen_vocab, global_row_id, time_split
from fraudlens.operators.profile import pos_weight
from fraudlens.schema import FeatureSpec
from fraudlens.session import settle
from fraudlens.sources.sinks import write_manifest, write_table

# Default parameters that the job records for the trainer.
GRAPH_CONFIG = {"hidden_dim": 128, "num_layers": 3, "dropout": 0.2, "learning_rate": 0.001, "epochs": 10}
TREE_CONFIG = {"max_depth": 6, "learning_rate": 0.1, "n_estimators": 100}
MODEL_TYPE = "graphsage_xgboost"


@dataclass
class Prepared:
    """Result of the job: rows, roles and the fitted steps."""

    rows: DataFrame
    spec: FeatureSpec
    imputer: MedianImputer
    encoder: LabelEncoder
    scaler: Scaler
    entity_keys: tuple[str, ...]


def preprocess(
    tx: DataFrame,
    idn: DataFrame | None,
    spec: FeatureSpec | None = None,
    frac: float = 0.7,
    fit_on: str = "train",
    entity_keys: Sequence[str] = ("card1", "P_emaildomain"),
) -> Prepared:
    """Merge, clean, find roles, fill, encode, scale and split.

    Statistics are fitted on training rows (``fit_on="all"`` fits on everything). Label, key and time are
    no features. Entity keys are kept as read, under ``key_*``, with missing ones as an entity of their own.
    The merged rows are written once; every statistics pass then reads only the columns it needs. The
    prepared rows are written once more, a folder per split, for all outputs that are made of them.
    """
    base = spec or FeatureSpec()
    merged = normalize_nan(null_placeholders(merge_identity(tx, idn, base.key)))
    split = time_split(settle(merged, "merged"), frac, base.time, base.key)
    if spec is None:
        spec = FeatureSpec.infer(split.drop("split"), exclude=[base.key, base.time])
    spec = spec.without(spec.label, spec.key, spec.time)
    keyed = split.withColumns(
        {f"key_{k}": F.coalesce(F.col(k).cast("string"), F.lit(MISSING)) for k in entity_keys if k in split.columns}
    )
    fitting = lambda df: df if fit_on == "all" else df.filter("split = 'train'")
    imputer = MedianImputer(spec.numerical, fit_on).fit(keyed)
    filled = imputer.transform(fill_categorical(keyed, spec.categorical, MISSING))
    encoder = LabelEncoder(spec.categorical, missing=MISSING).fit(fitting(filled))
    encoded = encoder.transform(filled)
    scaler = Scaler(spec.numerical, fit_on).fit(encoded)
    rows = settle(scaler.transform(encoded), "prepared", "split")
    return Prepared(rows, spec, imputer, encoder, scaler, tuple(entity_keys))


def write_outputs(prepared: Prepared, base: str, fmt: str = "csv") -> dict[str, str]:
    """Write graph, tabular and side-car outputs of both splits below ``base``.

    Every node and label table carries ``node_id``; the test graph uses training entities and only the
    test transactions whose entities were seen.
    """
    spec, order = prepared.spec, [prepared.spec.time, prepared.spec.key]
    card, email = (f"key_{k}" for k in prepared.entity_keys)
    features, label = spec.features, spec.label
    spark = prepared.rows.sparkSession
    train = global_row_id(prepared.rows.filter("split = 'train'"), order, "row_id")
    test = prepared.rows.filter("split = 'test'")
    cards, emails = first_seen_vocab(train, [card], order), first_seen_vocab(train, [email], order)
    start = node_offsets(vocab_sizes({"card": cards, "email": emails}))["txn"]
    kept, test_edges, _ = build_test_graph(test, cards, emails, order, card, email)
    out = {}
    for name, rows, edges in (
        ("train_gnn", train, build_edges_card_email(train, cards, emails, card, email)),
        ("test", kept, test_edges),
    ):
        nodes = rows.withColumn("node_id", F.col("row_id") + start)
        root = f"{base}/gnn/{name}"
        out[f"gnn/{name}/edges"] = write_table(edges, f"{root}/edges/node_to_node.{fmt}", fmt)
        out[f"gnn/{name}/nodes"] = write_table(nodes.select("node_id", *features), f"{root}/nodes/node.{fmt}", fmt)
        out[f"gnn/{name}/labels"] = write_table(nodes.select("node_id", label), f"{root}/nodes/node_label.{fmt}", fmt)
    end = start + train.count()
    write_manifest(spark, {"start": start, "end": end}, f"{base}/gnn/train_gnn/nodes/offset_range_of_training_node.json")
    for name, split in (("training", "train"), ("test", "test")):
        table = prepared.rows.filter(F.col("split") == split).select(*spec.columns())
        out[f"xgb/{name}"] = write_table(table, f"{base}/xgb/{name}.{fmt}", fmt)
    info = {"categorical_features": list(spec.categorical), "feature_names": features}
    out["xgb/feature_info"] = write_manifest(spark, info, f"{base}/xgb/feature_info.json")
    weight = pos_weight(train, label).first()["scale_pos_weight"]
    out["config"] = write_manifest(spark, training_config(weight, base), f"{base}/config/config.json")
    return out


def training_config(weight: float, data_dir: str, output_dir: str = "model") -> dict:
    return {
        "model_type": MODEL_TYPE,
        "data_dir": data_dir,
        "output_dir": output_dir,
        "gnn_config": GRAPH_CONFIG,
        "xgb_config": {**TREE_CONFIG, "scale_pos_weight": weight},
    }

"""Command line of the training job on prepared tables.

    python -m fraudlens.plans.train_job --train T --validation V --output O [--config JSON] [--rounds N] ...

Trains boosted trees with a stop by validation average precision. Below the output come ``model``,
``history`` (a row per round), ``metrics``, ``importances`` and ``scores`` of the validation rows.
"""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens.operators.boosting import BoostedTrees, BoostParams, train_boosting
from fraudlens.operators.clean import normalize_label
from fraudlens.operators.metrics import evaluate
from fraudlens.operators.model import REGIMES, regime_weights
from fraudlens.operators.profile import class_distribution
from fraudlens.schema import cols_by_dtype
from fraudlens.session import build_session, settle
from fraudlens.sources.manifest import RunLog
from fraudlens.sources.sinks import write_metrics
from fraudlens.sources.tables import read_config, read_dir

LABEL = "is_fraud"
# Names of the published configuration, and the parameters they set.
NAMES = {"n_estimators": "rounds", "num_boost_round": "rounds", "early_stopping_rounds": "patience"}


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Train boosted trees on prepared rows.")
    parser.add_argument("--train", required=True, help="folder of CSV or Parquet files")
    parser.add_argument("--validation", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--config", help="JSON written by the preprocessing job; its tree parameters are the defaults")
    parser.add_argument("--regime", choices=REGIMES, default="sample")
    parser.add_argument("--key", help="id column: no feature, decides which rows a round draws")
    for field in dataclasses.fields(BoostParams):
        parser.add_argument(f"--{field.name.replace('_', '-')}", type=type(field.default))
    return parser.parse_args(argv)


def parameters(spark: SparkSession, args: argparse.Namespace) -> BoostParams:
    """Defaults, then the configuration file, then the command line."""
    known = {f.name: type(f.default) for f in dataclasses.fields(BoostParams)}
    chosen: dict = {}
    if args.config:
        trees = read_config(spark, args.config).first().asDict(recursive=True).get("xgb_config") or {}
        named = {NAMES.get(k, k): v for k, v in trees.items()}
        chosen |= {k: known[k](v) for k, v in named.items() if k in known and v is not None}
    chosen |= {k: getattr(args, k) for k in known if getattr(args, k) is not None}
    return BoostParams(**chosen)


def run(spark: SparkSession, args: argparse.Namespace) -> BoostedTrees:
    """The trained model; its files are below ``args.output``."""
    train = settle(normalize_label(read_dir(spark, args.train)), "train")
    valid = settle(normalize_label(read_dir(spark, args.validation)), "valid")
    texts = set(cols_by_dtype(train, "string"))
    cols = [c for c in train.columns if c not in texts | {LABEL, args.key} and c in valid.columns]
    params = parameters(spark, args)
    with RunLog(spark, f"{args.output}/runs", "train") as record:
        weighted = regime_weights(train, LABEL, args.regime)
        model = train_boosting(weighted, cols, params, LABEL, "weight", valid, args.key)
        record.n_rows = train.count()
        model.save(f"{args.output}/model", spark)
        model.history_table(spark).write.mode("overwrite").json(f"{args.output}/history")
        model.importances(spark).orderBy(F.desc("importance"), "feature").write.mode("overwrite").json(f"{args.output}/importances")
        scored: DataFrame = settle(model.score(valid).select(*([args.key] if args.key else []), F.col(LABEL).alias("label"), "score"), "scores")
        scored.write.mode("overwrite").parquet(f"{args.output}/scores")
        metrics = evaluate(scored).withColumns({"best_round": F.lit(model.best_round), "rounds": F.lit(len(model.trees))})
        write_metrics(metrics, f"{args.output}/metrics")
        class_distribution(train, LABEL).write.mode("overwrite").json(f"{args.output}/classes")
    return model


if __name__ == "__main__":
    parsed = arguments()
    done = run(build_session(app="train"), parsed)
    print(f"{len(done.trees)} trees, best {done.best_round}")

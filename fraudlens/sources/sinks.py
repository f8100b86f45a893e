"""Writing tables, split layouts and JSON side-cars."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

# Directories of the two splits below the graph and the tabular output.
SPLIT_DIRS = {"gnn": {"train": "train_gnn", "test": "test"}, "xgb": {"train": "training", "test": "test"}}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", single_file: bool = False) -> str:
    """Write a table; CSV gets a header. One file only on request, for small exports."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)
    return path


def write_splits(df: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> str:
    """One directory per split, so that readers of one split skip the other."""
    df.write.mode(mode).partitionBy(split).parquet(path)
    return path


def read_split(spark: SparkSession, path: str, value: str, split: str = "split") -> DataFrame:
    return spark.read.parquet(path).filter(F.col(split) == value).drop(split)


def write_named_splits(df: DataFrame, base: str, kind: str, split: str = "split", fmt: str = "parquet") -> dict[str, str]:
    """The layout ``base/kind/<directory of the split>`` that downstream trainers expect."""
    return {
        value: write_table(df.filter(F.col(split) == value).drop(split), f"{base}/{kind}/{name}", fmt)
        for value, name in SPLIT_DIRS[kind].items()
    }


def write_manifest(spark: SparkSession, content: dict, path: str, mode: str = "overwrite") -> str:
    """A small dictionary as one JSON document."""
    spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.mode(mode).text(path)
    return path


def write_metrics(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Metric or history rows as JSON lines."""
    df.write.mode(mode).json(path)
    return path

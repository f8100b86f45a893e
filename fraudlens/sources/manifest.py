"""File catalogues, completeness checks, skip-if-present writes, run records and input snapshots."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import __version__ as spark_version
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraudlens.functions.scalars import megabytes, relative_path
from fraudlens.sources.tables import read_optional

_FILE_SYSTEM = r"(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?"  # scheme and authority of a path

# Outputs a complete preprocessing run leaves behind.
REQUIRED_OUTPUTS = (
    "gnn/train_gnn/edges/node_to_node.csv",
    "gnn/train_gnn/nodes/node.csv",
    "gnn/train_gnn/nodes/node_label.csv",
    "gnn/train_gnn/nodes/offset_range_of_training_node.json",
    "gnn/test/edges/node_to_node.csv",
    "gnn/test/nodes/node.csv",
    "gnn/test/nodes/node_label.csv",
    "xgb/training.csv",
    "xgb/test.csv",
    "xgb/feature_info.json",
)

RUN_SCHEMA = (
    "name string, started timestamp, ended timestamp, duration_s double, success boolean, "
    "n_rows bigint, n_files bigint, engine_version string"
)


def catalog(spark: SparkSession, path: str, exclude: str | None = None) -> DataFrame:
    """(path, size_bytes, size_mb) of every file below ``path``; the contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", F.col("length").alias("size_bytes"))
        .withColumn("size_mb", megabytes(F.col("size_bytes")))
    )
    return files if exclude is None else files.filter(~F.col("path").contains(exclude))


def catalog_totals(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count("*").alias("total_files"), F.coalesce(F.sum("size_mb"), F.lit(0.0)).alias("total_size_mb")
    )


def existing_outputs(files: DataFrame, base: str) -> DataFrame:
    """Names of written outputs relative to ``base``; a directory of part files counts once.

    Listed paths carry their file system's scheme and authority, which ``base`` may leave out, so both
    are compared without.
    """
    below = F.regexp_replace(F.regexp_replace("path", f"^{_FILE_SYSTEM}/+", "/"), r"/(part-[^/]*|_SUCCESS)$", "")
    plain = re.sub(f"^{_FILE_SYSTEM}/+", "/", base).rstrip("/")
    return files.filter(~F.col("path").endswith("_SUCCESS")).select(relative_path(below, plain).alias("path")).distinct()


def missing_outputs(required: DataFrame, existing: DataFrame, key: str = "path") -> DataFrame:
    """Required entries that do not exist; empty means complete."""
    return required.select(key).join(existing.select(key), key, "left_anti")


def is_complete(required: DataFrame, existing: DataFrame, key: str = "path") -> bool:
    return missing_outputs(required, existing, key).isEmpty()


def fingerprint(df: DataFrame) -> str:
    """Order-free digest of a table: row count and sum of row hashes (a sum, since xor loses pairs of equal rows)."""
    names = [f"`{c}`" for c in df.columns]
    total = F.sum(F.xxhash64(*names).cast("decimal(38,0)")).cast("string")
    row = df.agg(F.count("*").alias("n"), F.coalesce(total, F.lit("0")).alias("h")).first()
    return f"{row['n']}:{row['h']}"


def materialize(
    spark: SparkSession, build: Callable[[], DataFrame], path: str, mark: str
) -> tuple[DataFrame, str]:
    """Build and write a table unless one from inputs with the same fingerprint ``mark`` is there.

    The mark is written after the data, so an interrupted run is repeated.
    """
    known = read_optional(spark, f"{path}/mark", "text")
    if known is not None and known.first()["value"] == mark:
        return spark.read.parquet(f"{path}/data"), "skipped"
    build().write.mode("overwrite").parquet(f"{path}/data")
    spark.createDataFrame([(mark,)], "value string").write.mode("overwrite").text(f"{path}/mark")
    return spark.read.parquet(f"{path}/data"), "written"


@dataclass
class RunLog:
    """Collects what one run did and appends a row to the table of runs."""

    spark: SparkSession
    path: str
    name: str
    n_rows: int | None = None
    n_files: int | None = None

    def __enter__(self) -> RunLog:
        self.started = datetime.now(timezone.utc)
        return self

    def __exit__(self, kind, value, trace) -> bool:
        ended = datetime.now(timezone.utc)
        seconds = (ended - self.started).total_seconds()
        row = (self.name, self.started, ended, seconds, kind is None, self.n_rows, self.n_files, spark_version)
        self.spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(self.path)
        return False  # a failure is recorded and still raised


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def snapshot(spark: SparkSession, inputs: dict[str, DataFrame], dest: str) -> DataFrame:
    """Copy every input beside the outputs; (channel, n_rows, n_files, size_mb) per input."""
    out = None
    for name, df in inputs.items():
        df.write.mode("overwrite").parquet(f"{dest}/{name}")
        files = catalog(spark, f"{dest}/{name}").filter(F.col("path").endswith(".parquet"))
        n_rows: Column = spark.read.parquet(f"{dest}/{name}").agg(F.count("*").alias("n")).scalar()
        part = files.agg(F.count("*").alias("n_files"), F.sum("size_mb").alias("size_mb")).select(
            F.lit(name).alias("channel"), n_rows.alias("n_rows"), "n_files", "size_mb"
        )
        out = part if out is None else out.unionByName(part)
    return out

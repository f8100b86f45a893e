"""Scoring of arriving transactions against profiles fitted earlier."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from fraudlens.operators.entity import named_entities
from fraudlens.session import workspace


def file_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.parquet", fmt: str = "parquet") -> DataFrame:
    """Files of a directory as a stream, in the order they appear."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).format(fmt).load(path)


def with_profiles(stream: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stream-static left join; an unseen entity gets zeros, a missing key the profile of the missing one.

    A plain join, since a stream cannot be counted beforehand: Spark broadcasts the written profiles where
    their size allows, else each micro-batch is shuffled, and adaptive execution splits its hot keys.
    """
    keys = list(keys)
    profile = stats.withColumnsRenamed({k: f"_{k}" for k in keys})
    named, same = named_entities(stream, keys), F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    new = [c for c in stats.columns if c not in keys]
    return named.join(profile, same, "left").drop(*[f"_{k}" for k in keys]).na.fill(0.0, subset=new)


def drain(stream: DataFrame, path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Process what has arrived, write it to ``path`` exactly once, and return the written table.

    Progress is kept beside ``path``, so a restarted job that names the same path goes on where it stopped.
    """
    spark = stream.sparkSession
    out = transform(stream) if transform else stream
    job = (
        out.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{path}_progress")
        .trigger(availableNow=True)
        .start(path)
    )
    job.awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


def drain_to_workspace(stream: DataFrame, label: str = "stream") -> DataFrame:
    """Drain into a new path of the shared folder: for one run, since the next call takes another path."""
    return drain(stream, workspace(stream.sparkSession, label))

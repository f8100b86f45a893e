"""Session settings and the shared folder in which lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Spark's setting by which a query's shuffle files go when it has ended; else they stay until the driver collects garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, app: str = "fraudlens", **conf: str) -> SparkSession:
    """Session with adaptive execution, UTC and no web page; ``conf`` adds or overrides settings.

    Shuffle partitions are left to the cluster's own setting: adaptive execution coalesces them.
    """
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fraudlens-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def workspace(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never used before."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/fraudlens/{app}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "table", by: str | None = None) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back; with ``by`` in folders of that column's values.

    This cuts lineage durably: a lost executor costs a re-read, not a recomputation, and every
    later pass prunes columns of the written table. What was shuffled for it is removed then.
    """
    spark = df.sparkSession
    path = workspace(spark, label)
    writer = df.write if by is None else df.write.partitionBy(by)
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)
    read = spark.read.schema(df.schema).parquet(path)
    return read if by is None else read.select(*df.columns)

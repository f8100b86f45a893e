"""Reading tables: CSV with missing-value tokens, Parquet, optional and directory sources, JSON configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from fraudlens.functions.scalars import number

# Texts that a CSV reader takes for a missing value.
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    na_values: Sequence[str] = NA_VALUES,
) -> DataFrame:
    """A table in Parquet, ORC, JSON or CSV.

    CSV is read as text with a header; tokens for missing become null before the values are typed.
    Without a schema the types are found by one aggregation over the file: give one for large inputs.
    """
    if fmt != "csv":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.format(fmt).load(path)
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is not None:
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        raw = reader.schema(texts).csv(path)
    else:
        raw = reader.csv(path)
    cleaned = raw.select(*[F.when(~F.col(c).isin(*na_values), F.col(c)).alias(c) for c in raw.columns])
    types = {f.name: f.dataType.simpleString() for f in schema.fields} if schema is not None else _infer(cleaned)
    return cleaned.select(
        *[F.col(c) if types[c] == "string" else number(F.col(c), types[c]).alias(c) for c in cleaned.columns]
    )


def _infer(texts: DataFrame) -> dict[str, str]:
    """Whole numbers become bigint, or double when some are missing; then double, boolean, else text."""
    probes = []
    for c in texts.columns:
        col = F.col(c)
        probes += [
            F.count("*").alias(f"all_{c}"),
            F.count(col).alias(f"has_{c}"),
            F.count(number(col, "bigint")).alias(f"int_{c}"),
            F.count(number(col, "double")).alias(f"num_{c}"),
            F.count_if(F.lower(col).isin("true", "false")).alias(f"bool_{c}"),
        ]
    seen = texts.agg(*probes).first().asDict()
    out = {}
    for c in texts.columns:
        has = seen[f"has_{c}"]
        if has and seen[f"int_{c}"] == has:
            out[c] = "bigint" if has == seen[f"all_{c}"] else "double"
        elif seen[f"num_{c}"] == has:
            out[c] = "double"
        elif seen[f"bool_{c}"] == has:
            out[c] = "boolean"
        else:
            out[c] = "string"
    return out


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame | None:
    """The table, or None when the path does not exist."""
    try:
        return read_table(spark, path, fmt, **options)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_dir(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every part file of a directory, Parquet or CSV as the file names tell."""
    for fmt in ("parquet", "csv"):
        listed = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", f"*.{fmt}*").load(path).select("path")
        )
        if listed.limit(1).count():
            return read_table(spark, path, fmt, schema)
    raise FileNotFoundError(f"no Parquet or CSV file in {path}")


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """Nested JSON parameters as one row of structs."""
    return spark.read.option("multiLine", True).json(path)

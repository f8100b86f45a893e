"""Cleaning and typing. Each step is one ``select`` over all columns, however wide the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from fraudlens.functions.scalars import MISSING, PLACEHOLDERS, nan_to_null, number, simplify_device, zero_default
from fraudlens.operators.profile import column_medians
from fraudlens.schema import FeatureSpec, cols_by_dtype, existing


def _rewrite(df: DataFrame, changed: dict) -> DataFrame:
    return df.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in df.columns])


def null_placeholders(df: DataFrame, values: Sequence[str] = PLACEHOLDERS) -> DataFrame:
    """Placeholder strings (exact, case-sensitive) become null in every text column."""
    texts = cols_by_dtype(df, "string")
    return _rewrite(df, {c: F.when(~F.col(c).isin(*values), F.col(c)) for c in texts})


def normalize_nan(df: DataFrame) -> DataFrame:
    """NaN becomes null, so that null is the one missing marker."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return _rewrite(df, {c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def zero_defaults(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _rewrite(df, {c: zero_default(F.col(c)) for c in cols})


def _text(df: DataFrame, col: str):
    """Text form of a column; whole doubles print without a fraction."""
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        whole = F.col(col).cast("double") == F.floor(F.col(col).cast("double"))
        return F.when(whole & (F.abs(col) < 1e15), F.col(col).cast("bigint").cast("string")).otherwise(
            F.col(col).cast("string")
        )
    return F.col(col).cast("string")


def fill_categorical(df: DataFrame, cols: Sequence[str], token: str = MISSING) -> DataFrame:
    """Text form of categorical columns, missing values replaced by ``token``."""
    return _rewrite(df, {c: F.coalesce(_text(df, c), F.lit(token)) for c in existing(df, cols)})


class MedianImputer:
    """Fills missing numbers with the exact median, fitted on all rows or on the rows of one split."""

    def __init__(self, cols: Sequence[str], fit_on: str = "train", split: str = "split"):
        if fit_on not in ("all", "train"):
            raise ValueError("fit_on is 'all' or 'train'")
        self.cols, self.fit_on, self.split = list(cols), fit_on, split
        self.medians: dict[str, float] = {}

    def fit(self, df: DataFrame) -> MedianImputer:
        rows = df if self.fit_on == "all" else df.filter(F.col(self.split) == "train")
        self.medians = column_medians(rows, existing(df, self.cols))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        known = {c: m for c, m in self.medians.items() if m is not None and c in df.columns}
        return _rewrite(df, {c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(m)) for c, m in known.items()})


def add_simple_device(df: DataFrame, source: str = "DeviceInfo", name: str = "DeviceInfo_simple", token: str = "unknown") -> DataFrame:
    """Device text of low cardinality; ``token`` when the source column or value is absent."""
    if source not in df.columns:
        return df.withColumn(name, F.lit(token))
    return df.withColumn(name, F.coalesce(simplify_device(F.col(source).cast("string")), F.lit(token)))


def ensure_column(df: DataFrame, name: str, default) -> DataFrame:
    """Add a constant column when it is absent."""
    return df if name in df.columns else df.withColumn(name, F.lit(default))


def normalize_label(df: DataFrame, source: str = "isFraud", name: str = "is_fraud") -> DataFrame:
    """Label under its canonical name; an error when neither name exists."""
    if name in df.columns:
        return df
    if source in df.columns:
        return df.withColumnRenamed(source, name)
    raise ValueError(f"neither {source} nor {name} is a column")


def features_only(df: DataFrame, *drop: str) -> DataFrame:
    """Everything but the label and other named columns."""
    return df.drop(*drop)


def drop_missing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(keys))


def cast_roles(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Categorical columns as text, numerical ones as double; text that is no number becomes null."""
    changed = {c: _text(df, c) for c in existing(df, spec.categorical)}
    text = set(cols_by_dtype(df, "string"))
    changed |= {c: number(F.col(c), "double") if c in text else F.col(c).try_cast("double") for c in existing(df, spec.numerical)}
    return _rewrite(df, changed)


def assemble_columns(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Categorical, numerical, label, in that order; the label occurs once and is no feature."""
    return df.select(*[c for c in spec.columns() if c in df.columns])

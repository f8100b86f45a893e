"""Scalar column expressions. Everything here is a built-in expression, so it stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Placeholder strings that mean "missing", and the two fill tokens.
PLACEHOLDERS = ("unknown", "Unknown", "UNKN")
MISSING = "missing"
UNKNOWN = "unknown"


def zero_default(col: Column) -> Column:
    """Null or NaN becomes 0.0."""
    return F.coalesce(F.nanvl(col.cast("double"), F.lit(0.0)), F.lit(0.0))


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def number(col: Column, kind: str) -> Column:
    """Text as a value of type ``kind``, null where it is none. Spark also reads ``10d`` and ``1f`` as numbers;
    here digits, sign, point and exponent make a number, and infinity written out."""
    if kind not in ("bigint", "int", "double", "float"):
        return col.try_cast(kind)
    written = F.trim(col).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$")
    return F.when(written, col.try_cast(kind))


def simplify_device(col: Column) -> Column:
    """Lower case, text before the first slash."""
    return F.split(F.lower(col), "/", 2)[0]


def entity_key(prefix: str, *cols: Column, missing: str = UNKNOWN) -> Column:
    """Readable composite key ``prefix_a_b``; joins use the columns themselves, not this text."""
    parts = [F.coalesce(c.cast("string"), F.lit(missing)) for c in cols]
    return F.concat_ws("_", F.lit(prefix), *parts)


def ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """num/den, or ``default`` where the denominator is zero."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))


def sigmoid(col: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col))


def relu(col: Column) -> Column:
    return F.greatest(F.lit(0.0), col)


def percent_change(new: Column, old: Column) -> Column:
    """Relative improvement in per cent; null when the old value is zero."""
    return (F.try_divide(new, old) - 1) * 100


def megabytes(size: Column) -> Column:
    return size / F.lit(1e6)


# --- time ---------------------------------------------------------------------------------

def epoch_seconds(col: Column) -> Column:
    """Seconds since 1970 of a zone-free timestamp, whatever the session zone."""
    return (
        F.unix_date(col.cast("date")).cast("long") * 86400
        + F.hour(col).cast("long") * 3600
        + F.minute(col).cast("long") * 60
        + F.second(col).cast("long")
    )


def from_epoch_millis(col: Column) -> Column:
    """Zone-free timestamp of milliseconds since 1970, whatever the session zone."""
    zero = F.lit(0)
    since = F.make_dt_interval(zero, zero, zero, (col / 1000).cast("decimal(18,3)"))
    return F.lit("1970-01-01").cast("timestamp_ntz") + since


def duration_seconds(start: Column, end: Column) -> Column:
    """Seconds between two timestamps of the same kind, exact to the microsecond and free of the session zone."""
    gap = end - start
    part = lambda unit: F.extract(F.lit(unit), gap)
    return (part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")).cast("double")


def iso_time(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")


def job_stamp(col: Column) -> Column:
    """Suffix used in job names, e.g. 20240131-235959."""
    return F.date_format(col, "yyyyMMdd-HHmmss")


def report_stamp(col: Column) -> Column:
    """Human-readable run stamp, e.g. 31-Jan-2024-23-59-59."""
    return F.date_format(col, "dd-MMM-yyyy-HH-mm-ss")


# --- paths --------------------------------------------------------------------------------

def path_segment(col: Column, index: int) -> Column:
    """0-based part of a slash-separated path, null when there are fewer parts."""
    return F.get(F.split(col, "/"), F.lit(index))


def relative_path(col: Column, base: str) -> Column:
    """Path below ``base`` (plain text, no pattern)."""
    prefix = base.rstrip("/") + "/"
    return F.when(col.startswith(prefix), F.substr(col, F.lit(len(prefix) + 1))).otherwise(col)

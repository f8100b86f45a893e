"""Log and job-status analysis over tables of events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fraudlens.functions.scalars import duration_seconds, from_epoch_millis
from fraudlens.operators.joins import lookup
from fraudlens.operators.ordering import latest
from fraudlens.session import settle

# Words searched for in messages, and the patterns of the failure classes.
ERROR_WORDS = (
    "error", "exception", "warn", "warning", "fail", "failed", "timeout", "accessdenied", "validationerror",
    "outofmemory", "notauthorized", "unauthorized", "forbidden", "denied", "exit.code", "AlgorithmError", "no.module",
)
PERMISSION_WORDS = (
    "is not authorized to perform", "not authorized", "unauthorized", "forbidden", "denied", "sagemaker:AddTags", "iam:PassRole",
)
SCRIPT_WORDS = ("AlgorithmError", "exit.code", "no.module", "ImportError", "FileNotFoundError", "KeyError", "ValueError")
STEP_WORDS = ("step failure",)
ROLE_PASS = "iam:PassRole"
ALGORITHM = "AlgorithmError"
EXIT_CODE = "exit.code"
FAILED_STATUSES = ("Failed", "FAILED", "Error", "ERROR")
ERRORS_SHOWN = 20
TAIL_SHOWN = 10
RECENT_JOBS = 10
STEP_SCHEMA = "array<struct<StepName string, StepStatus string, StartTime string, EndTime string, FailureReason string>>"


def matches(col: Column, words: Sequence[str]) -> Column:
    """Any of the patterns occurs, whatever the case."""
    return col.rlike("(?i)" + "|".join(words))


def scan_errors(
    log: DataFrame, order: Sequence[str], message: str = "message", words: Sequence[str] = ERROR_WORDS,
    n: int = ERRORS_SHOWN, tail: int = TAIL_SHOWN,
) -> DataFrame:
    """First ``n`` matching messages in order; without any match the last ``tail`` messages.

    Both are top-n reports, so each task keeps only its best few rows.
    """
    hits = log.filter(matches(F.col(message), words)).orderBy(*order).limit(n)
    recent = log.orderBy(*[F.desc(c) for c in order]).limit(tail)
    any_hit = hits.agg((F.count("*") > 0).alias("any_hit")).scalar()
    return (
        hits.withColumn("kind", F.lit("match"))
        .unionByName(recent.filter(~any_hit).withColumn("kind", F.lit("recent")))
    )


def classify_failure(reason: Column) -> tuple[Column, Column]:
    """(class, sub-class) of a failure text; the first class that matches wins."""
    kind = (
        F.when(matches(reason, PERMISSION_WORDS), "permission")
        .when(matches(reason, SCRIPT_WORDS), "script")
        .when(matches(reason, STEP_WORDS), "step")
        .otherwise("other")
    )
    detail = (
        F.when(kind == "permission", F.when(matches(reason, (ROLE_PASS,)), "role-pass").otherwise("general"))
        .when(
            kind == "script",
            F.when(matches(reason, (ALGORITHM,)), "algorithm").when(matches(reason, (EXIT_CODE,)), "exit-code").otherwise("general"),
        )
        .otherwise("none")
    )
    return kind, detail


def with_failure_class(df: DataFrame, reason: str) -> DataFrame:
    kind, detail = classify_failure(F.coalesce(F.col(reason), F.lit("")))
    return df.withColumns({"failure_class": kind, "failure_detail": detail})


def steps(df: DataFrame, json_col: str) -> DataFrame:
    """One row per step of a job description in JSON; absent values read N/A."""
    parsed = F.explode(F.from_json(json_col, STEP_SCHEMA))
    kept = [c for c in df.columns if c != json_col]
    rows = df.select(*kept, parsed.alias("_s"))
    na = lambda c: F.coalesce(F.col(f"_s.{c}"), F.lit("N/A"))
    return rows.select(
        *kept,
        F.col("_s.StepName").alias("step_name"),
        F.col("_s.StepStatus").alias("step_status"),
        na("StartTime").alias("start_time"),
        na("EndTime").alias("end_time"),
        na("FailureReason").alias("failure_reason"),
    )


def failed_steps(step_rows: DataFrame) -> DataFrame:
    """Steps under any spelling of a failed status."""
    return step_rows.filter(F.col("step_status").isin(*FAILED_STATUSES))


def scan_by_group(log: DataFrame, job_type: Column, message: str = "message") -> DataFrame:
    """Number of messages per job type and failure class, among those that look like errors."""
    found = log.withColumn("job_type", job_type).filter(matches(F.col(message), ERROR_WORDS))
    return with_failure_class(found, message).groupBy("job_type", "failure_class").agg(F.count("*").alias("n"))


def recent_failures(jobs: DataFrame, created: Sequence[str], reason: str, words: Sequence[str] = (ALGORITHM,), n: int = RECENT_JOBS) -> DataFrame:
    """Among the ``n`` most recent jobs, those whose reason matches."""
    return jobs.orderBy(*[F.desc(c) for c in created]).limit(n).filter(matches(F.col(reason), words))


def list_events(log: DataFrame, stream: str, ts: str, tie: str, message: str = "message", millis: bool = False) -> DataFrame:
    """Events of the stream that was active last come first, in time order within a stream; with ``millis``
    their times are epoch milliseconds and are listed as timestamps.

    The last event time per stream is one aggregation, written and looked up, so the log itself is not
    shuffled by stream; the listing is one global sort, which splits a busy stream over many tasks.
    """
    if millis:
        log = log.withColumn(ts, from_epoch_millis(F.col(ts)))
    last = settle(log.groupBy(stream).agg(F.max(ts).alias("last_event")), "streams")
    out = lookup(log, last, stream, "inner").withColumn(message, F.trim(message))
    return out.orderBy(F.desc("last_event"), stream, ts, tie)


def run_summary(polls: DataFrame, run: str, order: Sequence[str], status: str, ts: str) -> DataFrame:
    """Final status, number of polls, and seconds from first to last poll of each run."""
    return polls.groupBy(run).agg(
        F.max_by(status, F.struct(*order)).alias("final_status"),
        F.count("*").alias("polls"),
        duration_seconds(F.min(ts), F.max(ts)).alias("duration_s"),
    )


def latest_job(jobs: DataFrame, created: Sequence[str]) -> DataFrame:
    return latest(jobs, created)

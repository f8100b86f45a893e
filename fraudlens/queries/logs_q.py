"""Logs and job status (L1-L8) and the streaming score."""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens import bindings as b
from fraudlens.functions.scalars import epoch_seconds
from fraudlens.operators import logs as l
from fraudlens.operators.entity import entity_stats
from fraudlens.queries.base import query
from fraudlens.session import settle
from fraudlens.streaming.scoring import drain_to_workspace, file_stream, with_profiles

# The patterns of the error words and of the failure classes, lower-cased.
_ERRORS = "error|exception|warn|warning|fail|failed|timeout|accessdenied|validationerror|outofmemory|notauthorized|unauthorized|forbidden|denied|exit.code|algorithmerror|no.module"
_CLASS = """CASE WHEN regexp_matches(lower(message), 'not authorized|unauthorized|forbidden|denied|sagemaker:addtags|iam:passrole') THEN 'permission'
           WHEN regexp_matches(lower(message), 'algorithmerror|exit.code|no.module|importerror|filenotfounderror|keyerror|valueerror') THEN 'script'
           WHEN contains(lower(message), 'step failure') THEN 'step' ELSE 'other' END"""


@query("l01_scan_errors", f"""
    SELECT event_id, stream, message, 'match' AS kind FROM log WHERE regexp_matches(lower(message), '{_ERRORS}') ORDER BY ts, event_id LIMIT 20""")
def l01(spark, d):
    return l.scan_errors(b.log(spark, d), ["ts", "event_id"]).select("event_id", "stream", "message", "kind")


@query("l02_scan_fallback", """
    SELECT event_id, stream, message, 'recent' AS kind FROM log ORDER BY ts DESC, event_id DESC LIMIT 10""")
def l02(spark, d):
    return l.scan_errors(b.log(spark, d), ["ts", "event_id"], words=("no such word",)).select("event_id", "stream", "message", "kind")


@query("l03_classify_failure", f"""
    SELECT event_id, {_CLASS} AS failure_class,
           CASE {_CLASS} WHEN 'permission' THEN CASE WHEN contains(lower(message), 'iam:passrole') THEN 'role-pass' ELSE 'general' END
             WHEN 'script' THEN CASE WHEN contains(lower(message), 'algorithmerror') THEN 'algorithm'
                                     WHEN regexp_matches(lower(message), 'exit.code') THEN 'exit-code' ELSE 'general' END
             ELSE 'none' END AS failure_detail FROM log""")
def l03(spark, d):
    return l.with_failure_class(b.log(spark, d), "message").select("event_id", "failure_class", "failure_detail")


def _step_json(spark, d):
    """One job description per event, its step written as JSON with absent values."""
    rows = b.log(spark, d)
    failed = F.col("status") == "error"
    step = F.struct(
        F.col("stream").alias("StepName"),
        F.when(failed & (F.col("event_id") % 2 == 0), "Failed").when(failed, "ERROR").otherwise("Succeeded").alias("StepStatus"),
        F.when(failed, F.col("message")).alias("FailureReason"),
    )
    return rows.select("event_id", F.to_json(F.array(step)).alias("steps"))


_STEPS = """
    SELECT event_id, stream AS step_name, CASE WHEN status = 'error' AND event_id % 2 = 0 THEN 'Failed' WHEN status = 'error' THEN 'ERROR'
           ELSE 'Succeeded' END AS step_status, 'N/A' AS start_time, 'N/A' AS end_time,
           CASE WHEN status = 'error' THEN message ELSE 'N/A' END AS failure_reason FROM log"""


@query("l04_steps", _STEPS)
def l04(spark, d):
    return l.steps(_step_json(spark, d), "steps")


@query("l04_failed_steps", f"{_STEPS} WHERE status = 'error'")
def l04_failed(spark, d):
    return l.failed_steps(l.steps(_step_json(spark, d), "steps"))


@query("l05_scan_by_group", f"""
    SELECT CASE WHEN stream IN ('job-0', 'job-1', 'job-2') THEN 'processing' WHEN stream IN ('job-3', 'job-4', 'job-5') THEN 'training'
           ELSE 'function' END AS job_type, {_CLASS} AS failure_class, count(*) AS n
    FROM log WHERE regexp_matches(lower(message), '{_ERRORS}') GROUP BY 1, 2""")
def l05(spark, d):
    kind = (
        F.when(F.col("stream").isin("job-0", "job-1", "job-2"), "processing")
        .when(F.col("stream").isin("job-3", "job-4", "job-5"), "training")
        .otherwise("function")
    )
    return l.scan_by_group(b.log(spark, d), kind)


@query("l06_recent_failures", """
    SELECT event_id, message FROM (SELECT * FROM log WHERE status = 'error' ORDER BY ts DESC, event_id DESC LIMIT 10) WHERE contains(message, 'AlgorithmError')""")
def l06(spark, d):
    return l.recent_failures(b.log(spark, d).filter("status = 'error'"), ["ts", "event_id"], "message").select("event_id", "message")


@query("l07_list_events", """
    SELECT event_id, stream, trim(message) AS message, last_event FROM log JOIN (SELECT stream, max(ts) AS last_event FROM log GROUP BY stream) USING (stream)""")
def l07(spark, d):
    return l.list_events(b.log(spark, d), "stream", "ts", "event_id").select("event_id", "stream", "message", "last_event")


@query("l07_list_events_millis", """
    WITH m AS (SELECT event_id, stream, message, epoch_ms(epoch_us(ts) // 1000) AS ts FROM log)
    SELECT event_id, stream, trim(message) AS message, ts, last_event FROM m JOIN (SELECT stream, max(ts) AS last_event FROM m GROUP BY stream) USING (stream)""")
def l07_millis(spark, d):
    """A log whose times are epoch milliseconds, as log services hand them out."""
    whole = F.col("ts")
    millis = epoch_seconds(whole) * 1000 + F.date_format(whole, "SSS").cast("long")
    log = b.log(spark, d).withColumn("ts", millis)
    return l.list_events(log, "stream", "ts", "event_id", millis=True).select("event_id", "stream", "message", "ts", "last_event")


@query("l08_run_summary", """
    SELECT stream, arg_max(status, (ts, event_id)) AS final_status, count(*) AS polls,
           CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1e6 AS duration_s FROM log GROUP BY stream""")
def l08(spark, d):
    return l.run_summary(b.log(spark, d), "stream", ["ts", "event_id"], "status", "ts")


@query("x01_stream_score", """
    WITH s AS (SELECT card1, avg(isFraud) AS fr, count(TransactionAmt) AS n FROM txn GROUP BY 1)
    SELECT o_orderkey, o_custkey AS card1, round(coalesce(fr, 0), 6) AS fraud_rate, coalesce(n, 0) AS amt_count
    FROM orders LEFT JOIN s ON s.card1 = o_custkey""")
def x01(spark, d):
    """Orders arriving as files, joined to card profiles fitted earlier."""
    stats = settle(entity_stats(b.txn(spark, d), ["card1"], stats=("fraud_rate", "amt_count"), missing=None), "stats")
    schema = b.table(spark, d, "orders").schema
    arriving = file_stream(spark, d, schema, "orders.parquet").select("o_orderkey", F.col("o_custkey").alias("card1"))
    done = drain_to_workspace(with_profiles(arriving, stats, ["card1"]))
    return done.select("o_orderkey", "card1", F.round("fraud_rate", 6).alias("fraud_rate"), "amt_count")

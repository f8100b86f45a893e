import json

import pytest
from pyspark.sql import functions as F

from fraudlens.operators import logs as l
from fraudlens.operators.entity import entity_stats
from fraudlens.session import settle, workspace
from fraudlens.streaming.scoring import drain, file_stream, with_profiles


@pytest.mark.parametrize(
    "text,kind,detail",
    [
        ("User is not authorized to perform iam:PassRole", "permission", "role-pass"),
        ("Access DENIED", "permission", "general"),
        ("AlgorithmError: exit code 2", "script", "algorithm"),
        ("finished with exit code 2", "script", "exit-code"),
        ("KeyError: 'x'", "script", "general"),
        ("Step failure", "step", "none"),
        ("all fine", "other", "none"),
        (None, "other", "none"),
    ],
)
def test_classes(spark, text, kind, detail):
    row = l.with_failure_class(spark.createDataFrame([(text,)], "m string"), "m").first()
    assert (row.failure_class, row.failure_detail) == (kind, detail)


def messages(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "t int, message string")


def test_scan_and_fallback(spark):
    log = messages(spark, ["ok"] * 30 + ["Timeout", "no module named x"] + ["ERROR"] * 30)
    found = l.scan_errors(log, ["t"]).collect()
    assert len(found) == 20 and {r.kind for r in found} == {"match"} and min(r.t for r in found) == 30
    quiet = l.scan_errors(messages(spark, ["ok"] * 30), ["t"]).collect()
    assert sorted(r.t for r in quiet) == list(range(20, 30)) and {r.kind for r in quiet} == {"recent"}


def test_steps(spark):
    doc = json.dumps([{"StepName": "a", "StepStatus": "FAILED", "StartTime": "1"}, {"StepName": "b", "StepStatus": "Succeeded"}])
    rows = l.steps(spark.createDataFrame([(1, doc)], "run int, doc string"), "doc")
    assert [tuple(r) for r in rows.orderBy("step_name").collect()] == [
        (1, "a", "FAILED", "1", "N/A", "N/A"), (1, "b", "Succeeded", "N/A", "N/A", "N/A")
    ]
    assert [r.step_name for r in l.failed_steps(rows).collect()] == ["a"]


def test_recent_failures(spark):
    jobs = messages(spark, ["AlgorithmError"] + ["fine"] * 5 + ["algorithmerror: x"] + ["fine"] * 5)
    assert [r.t for r in l.recent_failures(jobs, ["t"], "message").collect()] == [6]


def test_listing_order(spark):
    rows = [(1, "a", 10, " x "), (2, "b", 30, "y"), (3, "a", 20, "z"), (4, "b", 5, "w")]
    log = spark.createDataFrame(rows, "id int, stream string, ts int, message string")
    out = l.list_events(log, "stream", "ts", "id").collect()
    assert [(r.id, r.message) for r in out] == [(4, "w"), (2, "y"), (1, "x"), (3, "z")]


def test_run_summary(spark):
    polls = spark.createDataFrame([("r", 1, "InProgress"), ("r", 91, "Completed")], "run string, s int, status string")
    out = l.run_summary(polls.withColumn("ts", F.timestamp_seconds("s")), "run", ["ts"], "status", "ts").first()
    assert (out.final_status, out.polls, out.duration_s) == ("Completed", 2, 90.0)


def test_stream_goes_on_where_it_stopped(spark):
    source, sink = workspace(spark, "arriving"), workspace(spark, "scored")
    past = spark.createDataFrame([("a", 2.0, 1), ("a", 4.0, 0)], "card string, TransactionAmt double, isFraud int")
    stats = settle(entity_stats(past, ["card"]))
    new = lambda rows: spark.createDataFrame(rows, "id long, card string")
    new([(1, "a"), (2, "z")]).write.parquet(source)
    stream = lambda: with_profiles(file_stream(spark, source, new([]).schema), stats, ["card"])
    assert {(r.id, r.fraud_rate) for r in drain(stream(), sink).collect()} == {(1, 0.5), (2, 0.0)}
    new([(3, "a")]).write.mode("append").parquet(source)
    assert sorted(r.id for r in drain(stream(), sink).collect()) == [1, 2, 3]

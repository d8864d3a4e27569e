"""Metrics, mapping, SLA misses, attempts, alerts."""

import datetime as dt

import pytest

from lakelayers.operators import metrics as m
from lakelayers.operators import runs as r
from lakelayers.schemas import METRIC_SAMPLES

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
RUN = (
    "run_id int, dag_id string, task_id string, scheduled_at timestamp, started_at timestamp, "
    "finished_at timestamp, state string, log_url string"
)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def samples(spark, *rows):
    return spark.createDataFrame([(at(t), name, float(v), k) for t, name, v, k in rows], METRIC_SAMPLES)


@pytest.mark.parametrize(
    ("metric", "value", "kind", "text"),
    [
        ("data_pipeline.silver.orders.row_count", 15000, "g", "15000"),
        ("data_pipeline.silver.orders.row_count", 12345678901, "g", "12345678901"),
        ("data_pipeline.quality.orders.pass_rate", 100, "g", "100.0"),
        ("data_pipeline.quality.orders.pass_rate", 87.5, "g", "87.5"),
        ("data_pipeline.task.x.duration_seconds", 1e7, "g", "10000000.0"),
        ("data_pipeline.task.x.duration_seconds", 12345678.25, "g", "12345678.25"),
        ("data_pipeline.task.x.duration_seconds", 0.00025, "g", "0.00025"),
        ("data_pipeline.task.x.duration_seconds", -0.5, "g", "-0.5"),
        ("data_pipeline.failure.d.t", 1, "c", "1"),
    ],
)
def test_encode_and_decode(spark, metric, value, kind, text):
    line = m.encode_metric(samples(spark, (0, metric, value, kind))).select("line")
    assert line.collect()[0].line == f"{metric}:{text}|{kind}"
    back = m.decode_metric(line).collect()[0]
    assert (back.metric, back.value, back.kind) == (metric, float(value), kind)


def test_broken_lines(spark):
    lines = spark.createDataFrame([("a:x|g",), ("a",), ("",), (None,)], "line string")
    got = [(row.metric, row.value, row.kind) for row in m.decode_metric(lines).collect()]
    assert got == [("a", None, "g"), ("a", None, None), ("", None, None), (None, None, None)]


@pytest.mark.parametrize(
    ("metric", "name", "labels"),
    [
        ("data_pipeline.silver.orders.row_count", "pipeline_row_count", {"layer": "silver", "dataset": "orders"}),
        ("data_pipeline.quality.orders.pass_rate", "pipeline_quality_pass_rate", {"dataset": "orders"}),
        ("data_pipeline.task.t.duration_seconds", "pipeline_task_duration_seconds", {"task": "t"}),
        ("data_pipeline.failure.d.t", "pipeline_failure_total", {"dag_id": "d", "task_id": "t"}),
        ("data_pipeline.failure.d.quality_bronze.validate_bronze", None, {}),
        ("data_pipeline.silver.row_count", None, {}),
        ("other.silver.orders.row_count", None, {}),
        ("", None, {}),
    ],
)
def test_mapping(spark, metric, name, labels):
    row = m.map_metrics(samples(spark, (0, metric, 1, "g"))).collect()[0]
    assert (row["name"], row["labels"]) == (name or metric, labels)


def test_first_pattern_wins(spark):
    patterns = [m.MetricPattern("a.*", "first", ("x",)), m.MetricPattern("a.b", "second", ())]
    assert m.map_metrics(samples(spark, (0, "a.b", 1, "g")), patterns).collect()[0]["name"] == "first"


def test_series_state(spark):
    rows = samples(
        spark, (0, "g1", 5, "g"), (2, "g1", 1, "g"), (2, "g1", 3, "g"), (1, "g1", 9, "g"), (0, "c1", 1, "c"), (0, "c1", 1, "c")
    )
    assert sorted((x.metric, x.value) for x in m.series_state(rows).collect()) == [("c1", 2.0), ("g1", 3.0)]


def history(spark, *rows):
    return spark.createDataFrame(rows, RUN)


def test_sla(spark):
    rows = history(
        spark,
        (1, "d", "ingest_bronze", at(0), at(5), at(1800), "success", "l"),
        (2, "d", "ingest_bronze", at(0), at(1700), at(1801), "success", "l"),
        (3, "d", "unknown_task", at(0), at(0), at(99999), "success", "l"),
        (4, "d", "build_gold", at(0), at(0), None, "running", "l"),
    )
    assert [(x.run_id, x.late_seconds) for x in r.sla_miss(rows).collect()] == [(2, 1.0)]
    assert sorted(x.run_id for x in r.sla_miss(rows, as_of=at(2000)).collect()) == [2, 4]
    text = r.sla_alerts(r.sla_miss(rows, as_of=at(2000))).collect()[0].message
    assert text == "⚠️ *[DataPipeline]* SLA MISS on DAG `d`: tasks ['build_gold', 'ingest_bronze']"


def test_sla_list_names_each_task_once(spark):
    rows = spark.createDataFrame([("d", "t")] * 50 + [("d", "s")], "dag_id string, task_id string")
    assert r.sla_alerts(rows).collect()[0].message.endswith("tasks ['s', 't']")


def test_attempts(spark):
    rows = history(
        spark,
        (1, "d", "a", at(0), at(0), at(1), "failed", "l"),
        (1, "d", "a", at(0), at(300), at(301), "failed", "l"),
        (1, "d", "a", at(0), at(600), at(600 + 7201), "failed", "l"),
        (2, "d", "a", at(0), at(0), at(1), "failed", "l"),
        (2, "d", "a", at(0), at(300), at(301), "success", "l"),
    )
    got = sorted((x.run_id, x.attempts, x.final_state, x.over_time, x.exhausted) for x in r.attempts(rows, ("run_id", "dag_id", "task_id")).collect())
    assert got == [(1, 3, "failed", 1, True), (2, 2, "success", 0, False)]


def test_failure_alert_and_counter(spark):
    rows = history(
        spark,
        (1, "d", "a", at(0), at(0), at(1), "failed", "/l"),
        (2, "d", "a", at(0), at(0), at(1), "success", "/l"),
    )
    assert [x.message for x in r.failure_alerts(rows).collect()] == [
        "❌ *[DataPipeline]* DAG `d` | Task `a` FAILED\nExecution: 2024-01-01 00:00:00\nLog: /l"
    ]
    assert [tuple(x) for x in m.failure_counter(rows).collect()] == [("d", "a", 1)]
    assert m.failure_samples(rows).count() == 1
    duration = m.task_duration(rows).collect()
    assert [(x.metric, x.value) for x in duration] == [("data_pipeline.task.a.duration_seconds", 1.0)]


@pytest.mark.parametrize(("level", "sign"), [("error", "❌"), ("warning", "⚠️"), ("info", "✅"), ("debug", "ℹ️")])
def test_levels(spark, level, sign):
    rows = spark.createDataFrame([("hello", level)], "text string, level string")
    want = f"{sign} *[DataPipeline]* hello"
    assert r.alert_messages(rows, level).collect()[0].message == want
    assert r.alert_messages(rows, rows.level).collect()[0].message == want

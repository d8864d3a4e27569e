"""Tasks that never ran, episodes of attempts, failing rows, summaries and keys over dates, series that are folded."""

from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakelayers.operators import quality, rollup
from lakelayers.operators.metrics import series_state
from lakelayers.operators.quality import RULES, failing_rows, rule_results, with_failed_rules
from lakelayers.operators.runs import attempt_episodes, expected_runs, sla_absent, sla_status
from lakelayers.operators.summary import daily_order_summary
from lakelayers.plans import daily, series
from lakelayers.plans.keys import read_keys, register_keys, repeated_keys
from lakelayers.plans.lake import Lake
from lakelayers.schemas import PARTITION
from lakelayers.sources.layers import overwrite_layer, read_layer
from lakelayers.suite import views
from lakelayers.suite.queries import QUERIES

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
RUN = "dag_id string, task_id string, scheduled_at timestamp, started_at timestamp, finished_at timestamp, state string"


def at(**delta):
    return T0 + timedelta(**delta)


def runs(spark, rows):
    return spark.createDataFrame([("d", task, at(minutes=s), at(minutes=b), None if e is None else at(minutes=e), state) for task, s, b, e, state in rows], RUN)


def test_status_of_every_expected_task(spark):
    day = 24 * 60
    history = runs(
        spark,
        [
            ("a", 0, 1, 5, "failed"), ("a", 0, 6, 9, "success"), ("b", 0, 1, 40, "success"), ("a", day, day, day + 3, "failed"),
            ("b", day + 1, day + 1, None, "success"), ("z", 0, 0, 1, "success"),
        ],
    )
    spans = spark.createDataFrame([("d", at(minutes=-5), at(days=3)), ("none", at(days=9), at(days=8))], "dag_id string, first timestamp, last timestamp")
    expected = expected_runs(spans, {"a": 600, "b": 1800, "c": 60})
    assert expected.count() == 4 * 3
    found = {(r.task_id, r.scheduled_at.day): (r.attempts, r.status) for r in sla_status(expected, history, at(days=2, minutes=20)).collect()}
    assert found == {
        ("a", 1): (2, "in_time"), ("b", 1): (1, "late"), ("c", 1): (0, "absent"), ("a", 2): (1, "failed"), ("b", 2): (1, "running"),
        ("c", 2): (0, "absent"), ("a", 3): (0, "absent"), ("b", 3): (0, "pending"), ("c", 3): (0, "absent"), ("a", 4): (0, "pending"),
        ("b", 4): (0, "pending"), ("c", 4): (0, "pending"),
    }
    missing = sla_absent(expected, history, at(days=2, minutes=20))
    assert sorted((r.task_id, r.scheduled_at.day) for r in missing.collect()) == [("a", 3), ("c", 1), ("c", 2), ("c", 3)]


def test_absent_tasks_are_joined_by_equality(spark):
    spans = spark.createDataFrame([("d", T0, at(days=3))], "dag_id string, first timestamp, last timestamp")
    plan = sla_status(expected_runs(spans), runs(spark, [("a", 0, 0, 1, "success")]), T0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_the_alert_names_the_task_that_never_ran(spark, tmp_path):
    """The silver gate fails, so the summary is not even tried; its time is over."""
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"))
    path = Path(lake.raw_path("2024-01-01"))
    path.parent.mkdir(parents=True)
    path.write_text("order_id,customer_id,amount,order_date,status\n1,a,1,2024-01-01,\n")
    with pytest.raises(quality.QualityGateError):
        daily.run_day(spark, lake, "2024-01-01")
    (late,) = read_layer(spark, lake.control("alerts")).filter("task_id IS NULL").collect()
    assert "'build_gold', 'ingest_bronze', 'quality_bronze.validate_bronze', 'transform_silver'" in late.message
    shown = read_layer(spark, lake.control("quality_examples")).collect()
    assert [(r.partition_date, r.layer, r.column, r.failed) for r in shown if r.layer == "silver"] == [("2024-01-01", "silver", "status", 1)]
    assert '"order_id":"1"' in shown[-1].row


attempt = st.tuples(st.sampled_from("ab"), st.integers(0, 400), st.one_of(st.none(), st.integers(0, 60)), st.sampled_from(["failed", "success"]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(attempt, max_size=25))
def test_episodes_do_not_depend_on_the_pieces(spark, rows):
    history = runs(spark, [(t, 0, b, None if n is None else b + n, s) for t, b, n, s in rows])
    expected = []
    for task in "ab":
        own = sorted((b, b + (n or 0), s) for t, b, n, s in rows if t == task)
        until = None
        for b, e, s in own:
            if until is None or b - until > 5:
                expected.append([task, b, e, 0, 0, s, 0])
                until = e if until is None else max(until, e)
                over = False
            else:
                over = b < until
                until = max(until, e)
            x = expected[-1]
            x[2], x[3], x[4], x[5], x[6] = max(x[2], e), x[3] + 1, x[4] + (s == "failed"), s, x[6] + over
    for piece in (7 * 60, 24 * 3600):
        found = attempt_episodes(history, piece=piece).collect()
        minutes = lambda t: int((t.replace(tzinfo=timezone.utc) - T0).total_seconds() // 60)
        got = sorted([r.task_id, minutes(r.first_start), minutes(r.last_end), r.attempts, r.failures, r.final_state, r.overlapping] for r in found)
        assert got == sorted(expected)


ORDERS = "order_id string, customer_id string, amount double, order_date date, status string, _partition_dt string"


@pytest.fixture
def dirty(spark):
    day = datetime(2024, 1, 1).date()
    rows = [
        ("1", "a", 1.0, day, "SHIPPED", "d1"), ("1", "b", -1.0, day, "LOST", "d1"), ("1", "a", 1.0, day, "SHIPPED", "d2"), (None, None, None, None, None, "d2"),
        (None, "x", float("nan"), day, "PENDING", "d2"), ("7", "x", 1.0, day, "pending", "d2"),
    ]
    return spark.createDataFrame(rows, ORDERS)


def test_failing_rows_agree_with_the_counts(spark, dirty):
    marked = with_failed_rules(dirty, RULES["orders"], by=PARTITION)
    assert sorted((r[PARTITION], r.order_id or "", r._failed) for r in marked.collect()) == [
        ("d1", "1", 1 << 2), ("d1", "1", 1 << 2 | 1 << 4 | 1 << 6), ("d2", "", 1 << 1 | 1 << 4), ("d2", "", 1 << 1 | 1 << 3 | 1 << 5),
        ("d2", "1", 0), ("d2", "7", 1 << 6),
    ]
    shown = failing_rows(dirty, RULES["orders"], "orders", ("order_id", "status"), by=PARTITION, keep=2).collect()
    counts = {(r.partition_date, r.rule_no): r.unexpected_count for r in rule_results(dirty, RULES["orders"], "orders", by=PARTITION).collect()}
    assert {(r.partition_date, r.rule_no): r.failed for r in shown} == {k: n for k, n in counts.items() if n}
    assert len(shown) <= 2 * len({(r.partition_date, r.rule_no) for r in shown})
    assert failing_rows(dirty.limit(0), RULES["orders"], "orders", ("order_id",), by=PARTITION).collect() == []


def test_failing_rows_come_from_one_scan(spark, sf_dir):
    plan = QUERIES["quality_rejects"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_min" in plan
    many = views.orders_raw(spark, sf_dir).withColumn("status", F.lit("LOST"))
    shown = failing_rows(many, [quality.in_set("status", ["x"])], "orders", ("order_id", "seq"), "d", keep=3).collect()
    assert [(r.slot, r.failed) for r in sorted(shown, key=lambda r: r.slot)] == [(i, many.count()) for i in range(3)]


def test_parts_add_up_to_the_summary(spark, tmp_path):
    day = datetime(2024, 1, 5)
    rows = [("d1", str(i), f"c{i % 3}", i / 4, day, "A") for i in range(7)] + [("d2", "x", None, None, None, None), ("d2", "y", "c1", 3.0, day, "A")]
    silver = spark.createDataFrame(rows, f"{PARTITION} string, order_id string, customer_id string, amount double, order_date timestamp, status string")
    silver = silver.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    path = str(tmp_path / "parts")
    overwrite_layer(rollup.summary_parts(silver), path)
    later = silver.filter(f"{PARTITION} = 'd2'").withColumn("amount", F.lit(10).cast("decimal(18,2)"))
    overwrite_layer(rollup.summary_parts(later), path)
    found = rollup.summary_over_dates(read_layer(spark, path)).withColumnRenamed("approx_customers", "unique_customers")
    exact = daily_order_summary(silver.filter(f"{PARTITION} = 'd1'").unionByName(later))
    assert sorted(map(str, found.select(*exact.columns).collect())) == sorted(map(str, exact.collect()))
    assert found.schema["avg_order_value"].dataType == exact.schema["avg_order_value"].dataType


def test_estimate_of_many_customers(spark):
    rows = spark.range(0, 60_000).selectExpr(
        "concat('d', id % 3) AS _partition_dt", "id AS order_id", "id % 20000 AS customer_id", "CAST(1 AS DECIMAL(18,2)) AS amount",
        "timestamp'2024-01-01 00:00:00' AS order_date", "'A' AS status",
    )
    (found,) = rollup.summary_over_dates(rollup.summary_parts(rows), by=["status"]).collect()
    assert abs(found.approx_customers - 20_000) < 0.03 * 20_000 and found.total_orders == 60_000


SAMPLE = "ts timestamp, metric string, value double, kind string, id long"


def test_fold_equals_the_whole_history(spark, tmp_path):
    samples = [(at(minutes=7 * i % 600), f"m{i % 4}", float(i % 13), "c" if i % 4 == 0 else "g", i) for i in range(300)]
    samples.sort(key=lambda x: (x[0], x[4]))
    path = str(tmp_path / "state")
    for begin, end in ((0, 100), (80, 190), (150, 300), (290, 300)):
        state = series.fold(spark, path, spark.createDataFrame(samples[begin:end], SAMPLE), 6 * 3600, ("id",))
    whole = series_state(spark.createDataFrame(samples, SAMPLE))
    assert sorted(map(tuple, state.values().collect())) == sorted(map(tuple, whole.collect()))
    # Samples whose time is closed come too late; open ones are few.
    late = spark.createDataFrame([(at(minutes=-1), "m0", 1e9, "c", 999)], SAMPLE)
    again = series.fold(spark, path, late, 6 * 3600, ("id",))
    assert sorted(map(tuple, again.values().collect())) == sorted(map(tuple, whole.collect()))
    assert again.open.count() < 300 and again.watermark == state.watermark
    assert len([p for p in (tmp_path / "state").iterdir() if p.is_dir()]) == 2


def test_a_fold_that_dies_is_repeated(spark, tmp_path):
    path = str(tmp_path / "state")
    batch = spark.createDataFrame([(T0, "m", 1.0, "c", 1)], SAMPLE)
    series.fold(spark, path, batch, 60, ("id",))
    # A version without its watermark is not there.
    batch.write.parquet(f"{path}/000000000002/open")
    state = series.fold(spark, path, spark.createDataFrame([(at(hours=1), "m", 1.0, "c", 2)], SAMPLE), 60, ("id",))
    assert [tuple(r) for r in state.values().collect()] == [("m", "c", 2.0)]
    assert series.fold(spark, path, batch.limit(0), 60, ("id",)).values().collect()[0].value == 2.0


def test_keys_of_earlier_dates(spark, tmp_path):
    path = str(tmp_path / "keys")
    rows = spark.createDataFrame([("d1", "a"), ("d1", "a"), ("d1", None), ("d2", "a"), ("d2", "b"), ("d3", "b"), ("d3", "a"), ("d3", None)], f"{PARTITION} string, k string")
    register_keys(rows, path, "k")
    third = rows.filter(f"{PARTITION} = 'd3'")
    found = sorted(map(tuple, repeated_keys(third, read_keys(spark, path), "k").collect()))
    assert found == [("d3", "a", 2, "d1"), ("d3", "b", 1, "d2")]
    register_keys(rows.filter(f"{PARTITION} = 'd2' AND k = 'b'"), path, "k")
    found = sorted(map(tuple, repeated_keys(third, read_keys(spark, path), "k").collect()))
    assert found == [("d3", "a", 1, "d1"), ("d3", "b", 1, "d2")]
    assert repeated_keys(third, read_keys(spark, str(tmp_path / "none")), "k").collect() == []
    plan = repeated_keys(third, read_keys(spark, path), "k")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<digest:binary>" in plan

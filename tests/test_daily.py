"""Layer jobs and the daily run on small raw files."""

import pytest

from lakelayers.operators import metrics
from lakelayers.operators.quality import QualityGateError
from lakelayers.operators.runs import attempts
from lakelayers.plans import bronze as bronze_plan
from lakelayers.plans import daily
from lakelayers.plans.bronze import ingest_to_bronze
from lakelayers.plans.gold import build_daily_order_summary
from lakelayers.plans.lake import Lake
from lakelayers.plans.silver import transform_orders_silver
from lakelayers.schemas import PARTITION
from lakelayers.sources.layers import read_dates, read_layer

HEADER = "order_id,customer_id,amount,order_date,status\n"
D1, D2, D3 = "2024-01-01", "2024-01-02", "2024-01-03"
DAY_1 = HEADER + "001,a,10.005,2024-01-01, pending \n002,b,,2024-01-01,SHIPPED\n002,b,5,2024-01-01,SHIPPED\n"
DAY_2 = HEADER + "001,a,1,2024-01-01,CANCELLED\n003,c,2,2024-01-02,SHIPPED\n"


def put(lake, dt, text):
    from pathlib import Path

    path = Path(lake.raw_path(dt))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"), str(tmp_path / "raw"))


def rows(spark, path, *columns, **options):
    df = read_layer(spark, path, **options)
    return sorted((tuple(map(str, r)) for r in df.select(*columns).collect()))


def silver(spark, lake):
    return rows(spark, lake.silver, PARTITION, "order_id", "amount", "status")


SILVER_1 = [(D1, "001", "10.01", "PENDING"), (D1, "002", "5.00", "SHIPPED")]
SILVER_2 = [(D2, "001", "1.00", "CANCELLED"), (D2, "003", "2.00", "SHIPPED")]


def test_pending_days_go_through_all_layers(spark, lake):
    put(lake, D1, DAY_1)
    put(lake, D2, DAY_2)
    done = daily.run_pending(spark, lake)
    assert done.published == [D1, D2] and done.duplicates == {D1: 1, D2: 0}
    assert silver(spark, lake) == SILVER_1 + SILVER_2
    assert rows(spark, lake.gold, PARTITION, "order_date", "status", "total_orders", "total_revenue") == [
        (D1, "2024-01-01", "PENDING", "1", "10.01"),
        (D1, "2024-01-01", "SHIPPED", "1", "5.00"),
        (D2, "2024-01-01", "CANCELLED", "1", "1.00"),
        (D2, "2024-01-02", "SHIPPED", "1", "2.00"),
    ]
    assert rows(spark, lake.bronze, "order_id", "_source_path")[0] == ("001", lake.raw_path(D1))
    assert daily.find_pending(spark, lake) == []
    put(lake, D3, DAY_2)
    assert daily.find_pending(spark, lake) == [D3]


def test_running_a_day_again_changes_nothing(spark, lake):
    put(lake, D1, DAY_1)
    put(lake, D2, DAY_2)
    daily.run_days(spark, lake, [D1, D2])
    before = silver(spark, lake), rows(spark, lake.gold, PARTITION, "status", "total_orders")
    daily.run_day(spark, lake, D2)
    assert (silver(spark, lake), rows(spark, lake.gold, PARTITION, "status", "total_orders")) == before
    assert len(rows(spark, lake.bronze, "order_id")) == 5


def test_append_keeps_every_delivery_and_the_newest_wins(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), bronze_mode="append")
    put(lake, D2, DAY_2)
    daily.run_day(spark, lake, D2)
    put(lake, D2, DAY_2.replace("003,c,2,", "003,c,1,"))
    done = daily.run_day(spark, lake, D2)
    assert len(rows(spark, lake.bronze, "order_id")) == 4 and done.duplicates == {D2: 2}
    assert silver(spark, lake) == [(D2, "001", "1.00", "CANCELLED"), (D2, "003", "1.00", "SHIPPED")]
    counts = read_layer(spark, lake.control("runs")).filter("task_id = 'ingest_bronze'").collect()
    assert [c.row_count for c in counts] == [2, 2]


def test_table_scope_keeps_the_last_run_only(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), scope="table")
    put(lake, D1, DAY_1)
    put(lake, D2, DAY_2)
    daily.run_day(spark, lake, D1)
    daily.run_day(spark, lake, D2)
    assert silver(spark, lake) == SILVER_2


def test_day_without_source_is_skipped(spark, lake):
    put(lake, D1, DAY_1)
    done = daily.run_days(spark, lake, [D1, D3])
    assert (done.published, done.skipped) == ([D1], [D3])
    states = rows(spark, lake.control("runs"), "partition_date", "task_id", "state")
    assert (D3, daily.SKIP, "success") in states and len(states) == 5
    assert daily.run_day(spark, lake, D3).skipped == [D3]


def test_failing_day_is_kept_back_and_others_are_published(spark, lake):
    put(lake, D1, DAY_1)
    put(lake, D2, HEADER + "1,a,1,2024-01-01,\n")
    with pytest.raises(QualityGateError, match="FAILED for 'orders' on 2024-01-02. Pass rate: 87.5%"):
        daily.run_days(spark, lake, [D1, D2])
    assert silver(spark, lake) == SILVER_1
    states = rows(spark, lake.control("runs"), "partition_date", "task_id", "state")
    assert (D2, daily.TRANSFORM, "failed") in states and (D1, daily.BUILD, "success") in states
    metrics = dict(rows(spark, lake.control("metric_samples"), "metric", "value"))
    assert metrics["data_pipeline.failure.orders_pipeline.transform_silver"] == "1.0"
    assert daily.find_pending(spark, lake) == [D2]


def test_filled_status_can_be_allowed(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), extra_allowed={"status": ["UNKNOWN"]})
    put(lake, D2, HEADER + "1,a,x,2024-01-01,\n")
    daily.run_day(spark, lake, D2)
    assert silver(spark, lake) == [(D2, "1", "0.00", "UNKNOWN")]
    info = read_layer(spark, lake.control("quality_rules")).filter("not scored").collect()
    assert [(i.method, i.unexpected_count) for i in info] == [("parses_as_money", 1)]


def test_strict_bronze_gate_stops_before_silver(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), bronze_gate="raise")
    put(lake, D1, DAY_1)
    with pytest.raises(QualityGateError):
        daily.run_day(spark, lake, D1)
    assert rows(spark, lake.control("runs"), "task_id", "state") == [
        ("ingest_bronze", "success"),
        ("quality_bronze.validate_bronze", "failed"),
    ]


def test_empty_redelivery_empties_the_day(spark, tmp_path):
    """At a threshold that tolerates the row-count rule an empty file replaces the day."""
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), threshold=0.8)
    put(lake, D1, DAY_1)
    put(lake, D2, DAY_2)
    daily.run_days(spark, lake, [D1, D2])
    put(lake, D2, HEADER)
    daily.run_day(spark, lake, D2)
    assert silver(spark, lake) == SILVER_1
    assert {r[0] for r in rows(spark, lake.gold, PARTITION)} == {D1}
    assert {r[0] for r in rows(spark, lake.bronze, PARTITION)} == {D1}


def test_error_is_recorded_and_raised(spark, lake, monkeypatch):
    put(lake, D1, DAY_1)
    monkeypatch.setattr(daily, "build_days", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily.run_day(spark, lake, D1)
    assert (daily.BUILD, "failed") in rows(spark, lake.control("runs"), "task_id", "state")
    assert daily.find_pending(spark, lake) == [D1]


def test_single_jobs(spark, lake, tmp_path):
    put(lake, D1, DAY_1)
    got = ingest_to_bronze(spark, lake.raw_path(D1), "orders", D1, lake.bronze)
    assert got == {"dataset": "orders", "row_count": 3, "path": lake.bronze}
    again = ingest_to_bronze(spark, lake.raw_path(D1), "orders", D1, lake.bronze, mode="append")
    assert again["row_count"] == 3 and read_layer(spark, lake.bronze).count() == 6
    got = transform_orders_silver(spark, lake.bronze, lake.silver, D1)
    assert (got["row_count"], got["duplicates"]) == (2, 4)
    assert build_daily_order_summary(spark, lake.silver, lake.gold, D1)["row_count"] == 2
    with pytest.raises(ValueError):
        ingest_to_bronze(spark, lake.raw_path(D1), "orders", D1, lake.bronze, mode="upsert")
    assert bronze_plan.new_run_id().startswith("airflow_")


def test_days_with_other_columns(spark, lake):
    """One day has its columns in another order and one more; every day is run by its own header."""
    put(lake, D1, DAY_1)
    put(lake, D2, "status,order_id,customer_id,amount,order_date,channel\nSHIPPED,9,z,4,2024-01-02,web\n")
    daily.run_days(spark, lake, [D1, D2])
    assert silver(spark, lake) == [*SILVER_1, (D2, "9", "4.00", "SHIPPED")]
    assert rows(spark, lake.silver, "order_id", "channel", merge=True)[-1] == ("9", "web")
    put(lake, D3, DAY_2)
    daily.run_day(spark, lake, D3)
    assert [r for r in silver(spark, lake) if r[0] == D3] == [(D3, *r[1:]) for r in SILVER_2]


def test_a_day_reads_only_its_own_folders(spark, lake):
    put(lake, D1, DAY_1)
    put(lake, D2, DAY_2)
    daily.run_days(spark, lake, [D1, D2])
    one, both = read_dates(spark, lake.bronze, [D2]), read_dates(spark, lake.bronze, [D1, D2, D3])
    assert all(D2 in file for file in one.inputFiles()) and one.count() == 2
    assert both.count() == 5 and dict(both.dtypes)[PARTITION] == "string"
    assert read_dates(spark, lake.bronze, [D3]).count() == 0


NO_AMOUNT = "order_id,customer_id,order_date,status\n7,z,2024-01-03,SHIPPED\n"
OTHER_ORDER = "status,order_id,customer_id,amount,order_date,channel\nSHIPPED,9,z,4,2024-01-02,web\n"


def tables(spark, lake):
    columns = [PARTITION, "order_id", "customer_id", "amount", "order_date", "status"]
    gold = [PARTITION, "order_date", "status", "total_orders", "total_revenue", "unique_customers"]
    raw = rows(spark, lake.bronze, PARTITION, "order_id", "status", "channel", merge=True)
    return raw, rows(spark, lake.silver, *columns), rows(spark, lake.gold, *gold)


def test_a_day_does_not_depend_on_the_days_it_runs_with(spark, tmp_path):
    """A day without amounts fails by itself, run together with others or alone."""
    lakes = [Lake(str(tmp_path / name), str(tmp_path / "raw")) for name in ("one", "all")]
    for dt, text in ((D1, DAY_1), (D2, OTHER_ORDER), (D3, NO_AMOUNT)):
        put(lakes[0], dt, text)
    for dt in (D1, D2, D3):
        if dt != D3:
            daily.run_day(spark, lakes[0], dt)
            continue
        with pytest.raises(QualityGateError, match="source of 2024-01-03 lacks the columns amount"):
            daily.run_day(spark, lakes[0], dt)
    with pytest.raises(QualityGateError, match="source of 2024-01-03 lacks the columns amount"):
        daily.run_pending(spark, lakes[1])
    assert tables(spark, lakes[0]) == tables(spark, lakes[1])
    for lake in lakes:
        assert {r[0] for r in rows(spark, lake.gold, PARTITION)} == {D1, D2} and daily.find_pending(spark, lake) == [D3]
        states = rows(spark, lake.control("runs"), "partition_date", "task_id", "state")
        assert [x for x in states if x[0] == D3] == [(D3, daily.INGEST, "success"), (D3, daily.VALIDATE, "failed")]


def test_a_day_that_cannot_be_read_leaves_the_others_alone(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), layout="{raw}/{dataset}/{dt}")
    days = {f"2024-02-{i:02d}": DAY_2 for i in range(1, 6)}
    for dt, text in days.items():
        folder = tmp_path / "raw" / "orders" / dt
        folder.mkdir(parents=True)
        (folder / "part-0.csv").write_text(text)
    (folder / "part-1.csv").write_text("status,order_id\nSHIPPED,1\n")
    (tmp_path / "raw" / "orders" / "2024-02-02" / "part-0.csv").write_text("")
    with pytest.raises(Exception, match="CSV"):
        daily.run_pending(spark, lake)
    good = ["2024-02-01", "2024-02-03", "2024-02-04"]
    assert sorted({r[0] for r in rows(spark, lake.gold, PARTITION)}) == good
    assert daily.find_pending(spark, lake) == ["2024-02-02", "2024-02-05"]
    failed = read_layer(spark, lake.control("runs")).filter("state = 'failed'")
    assert rows_of(failed, "partition_date", "task_id") == [("2024-02-02", daily.INGEST), ("2024-02-05", daily.INGEST)]
    alerts = read_layer(spark, lake.control("alerts")).filter("task_id = 'ingest_bronze'")
    assert rows_of(alerts, "partition_date", "task_id") == rows_of(failed, "partition_date", "task_id")


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("folder", [False, True])
@pytest.mark.parametrize("layout", ["{raw}/{dataset}/{dt}.csv", "{raw}/{dataset}/dt={dt}", "{raw}/{dt}", "{raw}/my [or] ders/{dt}/x.csv"])
def test_layouts(spark, tmp_path, layout, folder):
    from pathlib import Path

    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw files"), layout=layout)
    for dt, text in ((D1, DAY_1), (D2, DAY_2)):
        path = Path(lake.raw_path(dt)) / "part-0.csv" if folder else Path(lake.raw_path(dt))
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    assert daily.run_pending(spark, lake).published == [D1, D2]
    assert silver(spark, lake) == SILVER_1 + SILVER_2
    assert {r[0] for r in rows(spark, lake.bronze, "_source_path")} == {lake.raw_path(D1), lake.raw_path(D2)}


def test_dataset_without_rules_is_published_unchecked(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), dataset="returns")
    put(lake, D1, DAY_1)
    assert daily.run_day(spark, lake, D1).published == [D1]
    summary = read_layer(spark, lake.control("quality_summary"))
    assert rows_of(summary, "layer", "dataset", "skipped", "success") == [
        ("bronze", "returns", True, True), ("silver", "returns", True, True)
    ]
    transform_orders_silver(spark, lake.bronze, str(tmp_path / "single"), D1, dataset="returns")


def test_other_columns_fail_early_with_a_plain_text(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), dataset="customers")
    put(lake, D1, "customer_id,email\n1,a@b.c\n")
    with pytest.raises(QualityGateError, match="lacks the columns order_id, amount, order_date, status"):
        daily.run_day(spark, lake, D1)
    with pytest.raises(ValueError, match="the bronze rows lack the columns order_id"):
        transform_orders_silver(spark, lake.bronze, lake.silver, D1)


def test_the_user_names_what_newest_means(spark, tmp_path):
    """The later of two rows has the smaller amount text."""
    text = HEADER.strip() + ",seen\n1,a,9,2024-01-01,SHIPPED,08:00\n1,a,10,2024-01-01,SHIPPED,09:00\n"
    kept = []
    for order_by in ((), ("seen",)):
        lake = Lake(str(tmp_path / f"lake{len(order_by)}"), str(tmp_path / "raw"), order_by=order_by)
        put(lake, D1, text)
        daily.run_day(spark, lake, D1)
        kept += rows(spark, lake.silver, "amount")
    assert kept == [("9.00",), ("10.00",)]


def test_a_broken_step_of_a_whole_table_fails_for_all_days(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), scope="table")
    put(lake, D1, DAY_1)
    put(lake, D2, DAY_2)
    asked = []
    monkeypatch.setattr(daily, "build_days", lambda *args: asked.append(args[3]) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily.run_pending(spark, lake)
    assert asked == [[D1, D2]] * 2 and daily.find_pending(spark, lake) == [D1, D2]


def test_staging_is_removed(spark, lake):
    put(lake, D1, DAY_1)
    run = daily.run_day(spark, lake, D1)
    from pathlib import Path

    assert not Path(lake.staging(run.run_id)).exists() and lake.staging("airflow_a") != lake.staging("airflow_b")


def test_control_tables_tell_what_happened(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"))
    put(lake, D1, DAY_1)
    put(lake, D2, DAY_2)
    put(lake, D3, HEADER + "1,a,1,2024-01-01,\n")
    with pytest.raises(QualityGateError):
        daily.run_pending(spark, lake)
    put(lake, D3, HEADER + "1,a,1,2024-01-01,SHIPPED\n2,a,1,2024-01-01,SHIPPED\n3,a,1,2024-01-01,SHIPPED\n")
    daily.run_pending(spark, lake)
    samples = read_layer(spark, lake.control("metric_samples"))
    state = metrics.series_state(samples, ("layer",), ("ts", "partition_date", "value"))
    found = {(r.metric.removeprefix("data_pipeline."), r.layer): r.value for r in state.collect()}
    assert found["bronze.orders.row_count", "bronze"] == 3 and found["silver.orders.row_count", "silver"] == 3
    assert found["quality.orders.pass_rate", "bronze"] == found["quality.orders.pass_rate", "silver"] == 100
    durations = samples.filter("metric LIKE '%duration%'").groupBy("metric").count()
    assert {r["count"] for r in durations.collect()} <= {1, 2}
    tried = {(r.task_id, r.partition_date): (r.attempts, r.final_state) for r in attempts(read_layer(spark, lake.control("runs"))).collect()}
    assert tried[daily.TRANSFORM, D3] == (2, "success") and tried[daily.TRANSFORM, D1] == (1, "success")
    assert tried[daily.BUILD, D3] == (1, "success")
    alerts = read_layer(spark, lake.control("alerts")).collect()
    assert [(a.task_id, a.partition_date) for a in alerts if a.task_id] == [(daily.TRANSFORM, D3)]
    assert any(a.task_id is None and "SLA MISS" in a.message for a in alerts)

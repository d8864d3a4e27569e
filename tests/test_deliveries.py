"""Publication by moves, files taken in once, rows that do not fit, types that differ, faults that are tried again."""

from decimal import Decimal
from itertools import product
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.plans import bronze as bronze_plan
from lakelayers.plans import daily
from lakelayers.plans.bronze import ingest_days, read_rejects
from lakelayers.plans.errors import names_data
from lakelayers.plans.lake import Lake
from lakelayers.plans.silver import transform_days
from lakelayers.schemas import PARTITION
from lakelayers.sources import publish as moves
from lakelayers.sources.layers import read_dates, read_layer, read_mixed
from lakelayers.sources.ledger import read_ledger
from lakelayers.sources.types import cast_to, join_schemas, join_types

HEADER = "order_id,customer_id,amount,order_date,status\n"
D1, D2, D3 = "2024-01-01", "2024-01-02", "2024-01-03"
DAY = HEADER + "1,a,1,2024-01-01,SHIPPED\n2,b,2,2024-01-01,SHIPPED\n3,c,3,2024-01-01,SHIPPED\n"


def put(lake, dt, text, name=None):
    path = Path(lake.raw_path(dt)) / name if name else Path(lake.raw_path(dt))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def counts(spark, path):
    return {r[0]: r[1] for r in read_layer(spark, path).groupBy(PARTITION).count().collect()}


def ids(spark, path, *dates):
    return sorted((r[0], r[1]) for r in read_layer(spark, path).select(PARTITION, "order_id").collect())


@pytest.fixture
def appending(tmp_path):
    return Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), layout="{raw}/{dataset}/{dt}", bronze_mode="append")


# --- files are taken in once -------------------------------------------------------------------------------


def test_a_repeated_delivery_appends_nothing(spark, appending):
    lake = appending
    for dt in (D1, D2):
        put(lake, dt, DAY, "a.csv")
    first = ingest_days(spark, lake, [D1, D2], "airflow_1")
    again = ingest_days(spark, lake, [D1, D2], "airflow_2")
    assert (first.written.by_date, again.written.by_date) == ({D1: 3, D2: 3}, {D1: 0, D2: 0})
    assert counts(spark, lake.bronze) == {D1: 3, D2: 3}
    put(lake, D2, HEADER + "4,d,4,2024-01-01,SHIPPED\n", "b.csv")
    assert ingest_days(spark, lake, [D1, D2], "airflow_3").written.by_date == {D1: 0, D2: 1}
    put(lake, D2, HEADER + "4,d,44,2024-01-01,SHIPPED\n", "b.csv")
    assert ingest_days(spark, lake, [D1, D2], "airflow_4").written.by_date == {D1: 0, D2: 1}
    assert counts(spark, lake.bronze) == {D1: 3, D2: 5}
    ledger = read_ledger(spark, lake.control("deliveries"))
    assert ledger.count() == 4 and {r.run_id for r in ledger.collect()} == {"airflow_1", "airflow_3", "airflow_4"}
    assert {r.length for r in ledger.filter("path LIKE '%a.csv'").collect()} == {len(DAY)}


@pytest.mark.parametrize("fault", [OSError("Connection reset"), ValueError("lost count")])
def test_an_error_after_the_append_leaves_each_row_once(spark, appending, monkeypatch, fault):
    """The rows are in when the step breaks: as a whole, or in halves if the error names data, it adds nothing more."""
    lake = appending
    for dt in (D1, D2):
        put(lake, dt, DAY, "a.csv")
    count, failed = bronze_plan.rows_by_date, []

    def once(df):
        if not failed:
            failed.append(1)
            raise fault
        return count(df)

    monkeypatch.setattr(bronze_plan, "rows_by_date", once)
    run = daily.run_days(spark, lake, [D1, D2])
    assert run.published == [D1, D2] and run.duplicates == {D1: 0, D2: 0}
    assert counts(spark, lake.bronze) == {D1: 3, D2: 3}
    recorded = read_layer(spark, lake.control("runs")).filter("task_id = 'ingest_bronze' AND state = 'success'")
    assert {r.partition_date: r.row_count for r in recorded.collect()} == {D1: 3, D2: 3}


def test_an_append_that_died_between_two_moves_is_finished(spark, appending, monkeypatch):
    lake = appending
    for dt in (D1, D2):
        put(lake, dt, DAY, "a.csv")
    _die_after(monkeypatch, 1)
    with pytest.raises(KeyboardInterrupt):
        ingest_days(spark, lake, [D1, D2], "airflow_1")
    monkeypatch.undo()
    # The process is gone; what it staged is still there, as its note says.
    assert moves.names_in(spark, f"{lake.bronze}/{moves.NOTES}")
    assert ingest_days(spark, lake, [D1, D2], "airflow_2").written.by_date == {D1: 0, D2: 0}
    assert counts(spark, lake.bronze) == {D1: 3, D2: 3}
    assert read_ledger(spark, lake.control("deliveries")).count() == 2
    assert moves.names_in(spark, f"{lake.bronze}/{moves.NOTES}") == []


def _die_after(monkeypatch, n):
    """The process ends after ``n`` moves, without cleaning up."""
    rename, done = moves.rename, []

    def dying(spark, source, target):
        if len(done) == n:
            raise KeyboardInterrupt
        done.append(target)
        rename(spark, source, target)

    monkeypatch.setattr(moves, "rename", dying)
    monkeypatch.setattr(moves, "each", lambda spark, function, items: [function(item) for item in items])
    monkeypatch.setattr(bronze_plan, "remove", lambda spark, path: None)
    monkeypatch.setattr("lakelayers.plans.silver.remove", lambda spark, path: None)


def _break_at(monkeypatch, n):
    """The ``n``-th rename of a publication fails once, everything else goes on, cleaning up as well."""
    rename, seen = moves.rename, []

    def broken(spark, source, target):
        seen.append(target)
        if len(seen) == n:
            raise OSError("Connection reset")
        rename(spark, source, target)

    monkeypatch.setattr(moves, "rename", broken)
    monkeypatch.setattr(moves, "each", lambda spark, function, items: [function(item) for item in items])
    return seen


@pytest.mark.parametrize("n", [1, 2, 3])
def test_an_append_whose_move_fails_is_finished_by_the_repeat(spark, appending, monkeypatch, n):
    """Rows of two days and the ledger are three moves; whichever fails, all rows are in once and the ledger has both files."""
    lake = appending
    for dt in (D1, D2):
        put(lake, dt, DAY, "a.csv")
    seen = _break_at(monkeypatch, n)
    run = daily.run_days(spark, lake, [D1, D2])
    assert len(seen) > n and run.published == [D1, D2]
    assert counts(spark, lake.bronze) == counts(spark, lake.silver) == {D1: 3, D2: 3}
    assert read_ledger(spark, lake.control("deliveries")).count() == 2
    assert moves.names_in(spark, f"{lake.bronze}/{moves.NOTES}") == []
    assert moves.names_in(spark, f"{lake.root}/staging/{lake.dataset}") == []


# --- publication by moves ----------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_a_publication_whose_move_fails_is_finished_by_the_repeat(spark, tmp_path, monkeypatch, n):
    """Each of two days is two moves, the old folder aside and the new one in; the run tries the step again."""
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"))
    for dt in (D1, D2):
        put(lake, dt, DAY)
    daily.run_days(spark, lake, [D1, D2])
    for dt in (D1, D2):
        put(lake, dt, DAY.replace("3,c", "9,c"))
    seen = _break_at(monkeypatch, n)
    run = daily.run_days(spark, lake, [D1, D2])
    assert len(seen) > n and run.published == [D1, D2]
    assert ids(spark, lake.silver) == [(dt, i) for dt in (D1, D2) for i in ("1", "2", "9")]
    assert moves.names_in(spark, f"{lake.silver}/{moves.NOTES}") == []
    assert moves.names_in(spark, f"{lake.root}/staging/{lake.dataset}") == []


def test_staged_rows_that_are_gone_do_not_take_the_old_ones_with_them(spark, tmp_path):
    table, staged = tmp_path / "t", tmp_path / "s"
    old = Path(moves.date_folder(str(table), D1)) / "part-0"
    old.parent.mkdir(parents=True)
    old.write_text("old")
    (todo,) = moves.replacements(str(staged), str(table), [D1], "x")
    moves.rename(spark, todo.target, todo.aside)
    for _ in range(2):
        moves.publish(spark, str(table), [todo])
        assert old.read_text() == "old"
    with pytest.raises(OSError, match="is gone"):
        moves.publish(spark, str(table), [moves.Move(f"{staged}/a", f"{table}/a")], "y")
    assert moves.names_in(spark, f"{table}/{moves.NOTES}") == ["y.json"]


@pytest.mark.parametrize("n", range(6))
@pytest.mark.parametrize("scope", ["partition", "table"])
def test_publication_stopped_between_moves(spark, tmp_path, monkeypatch, n, scope):
    """Wherever it stops, the next run finds all of the new days, and none of the old rows of these days."""
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), scope=scope)
    for dt in (D1, D2, D3):
        put(lake, dt, DAY)
    ingest_days(spark, lake, [D1, D2, D3], "airflow_1")
    transform_days(spark, lake.bronze, lake.silver, f"{lake.root}/s1", [D1, D2, D3], scope=scope)
    for dt in (D1, D2):
        put(lake, dt, DAY.replace("3,c", "9,c"))
    ingest_days(spark, lake, [D1, D2], "airflow_2")
    _die_after(monkeypatch, n)
    stopped = False
    try:
        transform_days(spark, lake.bronze, lake.silver, f"{lake.root}/s2", [D1, D2], scope=scope)
    except KeyboardInterrupt:
        stopped = True
    monkeypatch.undo()
    assert stopped == (n < (4 if scope == "partition" else 5))
    assert moves.finish(spark, lake.silver) == moves.finish(spark, lake.silver) or stopped
    new = [(dt, i) for dt in (D1, D2) for i in ("1", "2", "9")]
    old = [(D3, i) for i in ("1", "2", "3")] if scope == "partition" else []
    assert ids(spark, lake.silver) == new + old
    assert moves.names_in(spark, f"{lake.silver}/{moves.NOTES}") == []


def test_moves_may_be_made_again(spark, tmp_path):
    table, staged = tmp_path / "t", tmp_path / "s"
    for folder, text in ((table, "old"), (staged, "new")):
        for dt in (D1, D2):
            file = Path(moves.date_folder(str(folder), dt)) / "part-0"
            file.parent.mkdir(parents=True)
            file.write_text(text)
    todo = moves.replacements(str(staged), str(table), [D1], "x", [D2])
    for _ in range(3):
        for move in todo:
            moves._make(spark, move)
    assert moves.stored_dates(spark, str(table)) == [D1]
    assert (Path(moves.date_folder(str(table), D1)) / "part-0").read_text() == "new"


# --- rows that do not fit ----------------------------------------------------------------------------------


def test_rows_that_do_not_fit_are_diverted(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), rejects="divert")
    odd = '4,"d, e",4,2024-01-01,SHIPPED\n5,e,5,2024-01-01,SHIPPED,more,"and, more"\n6,f\n'
    put(lake, D1, DAY + odd)
    put(lake, D2, DAY)
    run = daily.run_days(spark, lake, [D1, D2])
    assert run.rejected == {D1: 2} and counts(spark, lake.silver) == {D1: 4, D2: 3}
    found = sorted((r[PARTITION], r._row_text, r._reason, Path(r._source_file).name) for r in read_rejects(spark, lake).collect())
    assert found == [
        (D1, '5,e,5,2024-01-01,SHIPPED,more,"and, more"', "7 fields in 5 columns", f"{D1}.csv"),
        (D1, "6,f", "2 fields in 5 columns", f"{D1}.csv"),
    ]
    assert not {c for c in read_layer(spark, lake.silver).columns if c.startswith("_row") or c in ("_reason", "_source_file")}
    # The day comes again without odd rows: nothing of it is rejected any more.
    put(lake, D1, DAY)
    assert daily.run_day(spark, lake, D1).rejected == {} and read_rejects(spark, lake).count() == 0
    put(lake, D1, HEADER + "6,f\n")
    with pytest.raises(Exception, match="FAILED"):
        daily.run_day(spark, lake, D1)
    assert counts(spark, lake.bronze) == {D2: 3} and read_rejects(spark, lake).count() == 1


def test_diverting_reads_the_files_once(spark, tmp_path):
    """The rows that fit and those that do not leave one write with one scan."""
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), rejects="divert")
    put(lake, D1, DAY + "6,f\n")
    source = bronze_plan.probe(spark, lake, [D1])
    marked = bronze_plan.bronze_frame(spark, lake, source.alike, "airflow_1")
    assert marked._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted((r._row_text or "", r._reason or "") for r in marked.collect())[-1] == ("6,f", "2 fields in 5 columns")


def test_values_and_json_that_do_not_fit(spark, tmp_path):
    schema = T.StructType([T.StructField(c, T.IntegerType() if c == "amount" else T.StringType()) for c in HEADER.strip().split(",")])
    typed = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"), rejects="divert", raw_schema=schema, bronze_mode="append")
    put(typed, D1, DAY + "7,g,x,2024-01-01,SHIPPED\n")
    assert ingest_days(spark, typed, [D1], "airflow_1").rejected == {D1: 1}
    assert ingest_days(spark, typed, [D1], "airflow_2").rejected == {}
    (row,) = read_rejects(spark, typed).collect()
    assert row._reason == bronze_plan.WRONG_VALUE and read_layer(spark, typed.bronze).schema["amount"].dataType == T.IntegerType()
    lines = Lake(str(tmp_path / "json"), str(tmp_path / "raw"), layout="{raw}/{dt}.json", raw_format="json", rejects="divert")
    put(lines, D1, '{"order_id": "1", "customer_id": "a", "amount": 1, "order_date": "2024-01-01", "status": "SHIPPED"}\n{"order_id": \n')
    assert ingest_days(spark, lines, [D1], "airflow_1").rejected == {D1: 1}
    (row,) = read_rejects(spark, lines).collect()
    assert (row._row_text, row._reason) == ('{"order_id": ', "not readable as json")
    with pytest.raises(ValueError):
        Lake("a", "b", rejects="drop")


# --- types that differ -------------------------------------------------------------------------------------

KINDS = [
    T.NullType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DecimalType(10, 2), T.DecimalType(38, 0), T.FloatType(), T.DoubleType(),
    T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.BooleanType(), T.StringType(), T.ArrayType(T.StringType()),
]


def test_types_form_a_lattice():
    for a, b in product(KINDS, KINDS):
        assert join_types(a, b) == join_types(b, a) and join_types(a, a) == a
        assert join_types(join_types(a, b), b) == join_types(a, b)
        assert join_types(a, T.StringType()) == T.StringType()
    assert join_types(T.IntegerType(), T.DecimalType(10, 2)) == T.DecimalType(12, 2)
    assert join_types(T.LongType(), T.DecimalType(38, 30)) == T.StringType()
    assert join_types(T.DecimalType(10, 2), T.DoubleType()) == T.DoubleType()
    assert join_types(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert join_types(T.DateType(), T.IntegerType()) == T.StringType()


def test_columns_are_joined_and_cast(spark):
    one = spark.createDataFrame([(1, Decimal("1.50"))], "Id int, price decimal(4,2)")
    two = spark.createDataFrame([("x", 2, True)], "id string, price bigint, flag boolean")
    joined = join_schemas([one.schema, two.schema])
    assert [(c.name, c.dataType.simpleString()) for c in joined] == [
        ("Id", "string"), ("price", "decimal(21,2)"), ("flag", "boolean"),
    ]
    rows = cast_to(one, joined).union(cast_to(two, joined)).collect()
    assert [tuple(r) for r in rows] == [("1", Decimal("1.50"), None), ("x", Decimal("2.00"), True)]


def test_days_of_other_types_are_read_together(spark, tmp_path):
    """Days and deliveries whose types were inferred differently; run one by one or together they read the same."""
    texts = {D1: DAY, D2: HEADER + "x1,a,1.5,2024-01-01 10:00:00,SHIPPED\n", D3: HEADER + "5,7,2,2024-01-01,SHIPPED\n"}
    found = []
    for name, batches in (("one", [[D1], [D2], [D3]]), ("all", [[D1, D2, D3]])):
        lake = Lake(str(tmp_path / name), str(tmp_path / "raw"), infer=True)
        for dt, text in texts.items():
            put(lake, dt, text)
        for dates in batches:
            ingest_days(spark, lake, dates, "airflow_1")
        rows = read_mixed(spark, lake.bronze)
        assert dict(rows.dtypes) | {"order_id": "string", "amount": "double", "order_date": "timestamp"} == dict(rows.dtypes)
        found.append(sorted(map(str, rows.select("order_id", "customer_id", "amount", "order_date", PARTITION).collect())))
        assert read_dates(spark, lake.bronze, [D1, D2]).count() == 4
    assert found[0] == found[1] and len(found[0]) == 5
    with pytest.raises(Exception):
        read_layer(spark, str(tmp_path / "one" / "bronze" / "orders")).collect()


def test_deliveries_of_other_types_in_one_day(spark, appending):
    lake = Lake(appending.root, appending.raw, layout=appending.layout, bronze_mode="append", infer=True)
    put(lake, D1, DAY, "a.csv")
    ingest_days(spark, lake, [D1], "airflow_1")
    put(lake, D1, HEADER + "x,a,1,2024-01-01,SHIPPED\n", "b.csv")
    ingest_days(spark, lake, [D1], "airflow_2")
    rows = read_mixed(spark, lake.bronze)
    assert sorted(r.order_id for r in rows.collect()) == ["1", "2", "3", "x"]


# --- faults ------------------------------------------------------------------------------------------------


def test_a_fault_of_the_cluster_is_tried_twice(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"))
    days = [f"2024-02-{i:02d}" for i in range(1, 6)]
    for dt in days:
        put(lake, dt, DAY)
    asked = []

    def full(spark, lake, dates, *rest):
        asked.append(dates)
        raise OSError("No space left on device")

    monkeypatch.setattr(daily, "ingest_days", full)
    with pytest.raises(OSError):
        daily.run_pending(spark, lake)
    assert asked == [days, days]
    states = read_layer(spark, lake.control("runs")).groupBy("state").count().collect()
    assert {r[0]: r[1] for r in states} == {"up_for_retry": 5, "failed": 5}


def test_a_fault_that_passes_does_no_harm(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "raw"))
    put(lake, D1, DAY)
    build, asked = daily.build_days, []
    monkeypatch.setattr(daily, "build_days", lambda *args: asked.append(1) or (1 / 0 if len(asked) == 1 else build(*args)))
    assert daily.run_day(spark, lake, D1).published == [D1] and len(asked) == 2


def test_what_an_error_speaks_of(spark, tmp_path):
    def raised(function):
        with pytest.raises(Exception) as caught:
            function()
        return caught.value

    bad = spark.createDataFrame([("x",)], "a string")
    path = str(tmp_path / "out")
    assert names_data(raised(lambda: bad.selectExpr("CAST(a AS INT)").collect()))
    assert names_data(raised(lambda: bad.selectExpr("CAST(a AS INT) AS b").write.parquet(path)))
    assert names_data(raised(lambda: bad.select("c")))
    assert names_data(raised(lambda: spark.read.parquet(str(tmp_path / "nowhere"))))
    assert names_data(raised(lambda: bad.select(F.raise_error(F.lit("no date of the run"))).collect()))
    assert names_data(ValueError("lacks columns"))
    for fault in (OSError("Connection refused"), ZeroDivisionError(), RuntimeError("ExecutorLostFailure (executor 1 exited)")):
        assert not names_data(fault)
    wrapped = RuntimeError("[FAILED_READ_FILE.NO_HINT] x Caused by: java.net.SocketException: Connection reset")
    assert not names_data(wrapped) and names_data(RuntimeError("[FAILED_READ_FILE.NO_HINT] header does not conform"))

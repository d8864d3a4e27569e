"""Casts, cleaning and duplicates on hand-made rows and against plain Python."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakelayers.functions.scalar import day_of, now_or, parse_ts, standardise, to_money
from lakelayers.operators.clean import add_bronze_metadata, clean_orders, drop_columns, fill_nulls, to_text
from lakelayers.operators.dedup import dedup, duplicate_count
from lakelayers.operators.summary import daily_order_summary

FEW = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
ORDER_ROW = "order_id string, customer_id string, amount string, order_date string, status string"


def values(df, column):
    return [row[column] for row in df.collect()]


def column_of(spark, items, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}").coalesce(1)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("10.005", "10.01"),
        ("-2.675", "-2.68"),
        ("x", None),
        ("", None),
        (None, None),
        ("1e17", None),
        ("1e3", "1000.00"),
        ("-1", "-1.00"),
        (" 7 ", "7.00"),
    ],
)
def test_money(spark, text, expected):
    (got,) = values(column_of(spark, [text]).select(to_money("x").alias("y")), "y")
    assert got == (None if expected is None else Decimal(expected))


def test_money_from_double(spark):
    got = values(column_of(spark, [1e17, 12.5, float("nan")], "double").select(to_money("x").alias("y")), "y")
    assert got == [None, Decimal("12.50"), None]


@FEW
@given(st.lists(st.decimals(-(10**12), 10**12, places=4), min_size=1, max_size=30))
def test_money_rounds_half_up(spark, numbers):
    got = values(column_of(spark, [format(n, "f") for n in numbers]).select(to_money("x").alias("y")), "y")
    assert got == [n.quantize(Decimal("0.01"), ROUND_HALF_UP) for n in numbers]


def test_timestamps(spark):
    texts = ["2024-01-02", "2024-13-01", "2024-01-02 10:00:00", "2024-02-30", None, ""]
    got = values(column_of(spark, texts).select(parse_ts("x").cast("timestamp_ntz").alias("y")), "y")
    assert got == [dt.datetime(2024, 1, 2), None, None, None, None, None]


def test_typed_dates_are_taken_over(spark):
    moment = dt.datetime(2024, 1, 2, 10, 11, 12)
    stamps = column_of(spark, [moment], "timestamp_ntz").selectExpr("cast(x as timestamp) x")
    assert values(stamps.select(parse_ts("x").cast("timestamp_ntz").alias("y")), "y") == [moment]
    assert values(stamps.select(day_of("x").alias("y")), "y") == [moment.date()]
    days = column_of(spark, [moment.date()], "date")
    assert values(days.select(parse_ts("x").cast("timestamp_ntz").alias("y")), "y") == [dt.datetime(2024, 1, 2)]


@FEW
@given(st.lists(st.text(st.sampled_from(" \tabZ9é"), max_size=8), min_size=1, max_size=30))
def test_standardise(spark, texts):
    got = values(column_of(spark, texts).select(standardise("x").alias("y")), "y")
    assert got == [t.strip(" ").upper() for t in texts]


def test_fill_keeps_the_type(spark):
    rows = spark.createDataFrame([(None, None), ("X", Decimal("1.50"))], "status string, amount decimal(18,2)")
    filled = fill_nulls(rows)
    assert filled.schema["amount"].dataType.simpleString() == "decimal(18,2)"
    assert sorted(map(tuple, filled.collect())) == [("UNKNOWN", Decimal("0.00")), ("X", Decimal("1.50"))]


def test_clean_orders(spark):
    rows = spark.createDataFrame(
        [("1", "a", "x", "2024-13-01", " pending "), ("2", "b", None, "2024-01-02", None)], ORDER_ROW
    )
    rows = add_bronze_metadata(rows, "/p", "2024-01-02", "run")
    got = clean_orders(rows).selectExpr("*", "cast(order_date as timestamp_ntz) d").drop("order_date")
    assert got.columns == ["order_id", "customer_id", "amount", "status", "_partition_dt", "d"]
    assert sorted(map(tuple, got.collect())) == [
        ("1", "a", Decimal("0.00"), "PENDING", "2024-01-02", None),
        ("2", "b", Decimal("0.00"), "UNKNOWN", "2024-01-02", dt.datetime(2024, 1, 2)),
    ]


def test_small_helpers(spark):
    rows = spark.createDataFrame([(1,)], "a int")
    assert to_text(rows, ["a"]).collect()[0].a == "1"
    assert drop_columns(rows.selectExpr("a", "a b"), ["b", "nothing"]).columns == ["a"]
    fixed = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    assert rows.select(now_or(fixed).cast("timestamp_ntz")).collect()[0][0] == dt.datetime(2024, 1, 1)
    assert rows.select(now_or()).collect()[0][0] is not None


def test_file_path_per_row(spark, tmp_path):
    spark.range(0, 3, 1, 3).write.parquet(str(tmp_path / "t"))
    rows = add_bronze_metadata(spark.read.parquet(str(tmp_path / "t")), None, "2024-01-01", "run")
    assert rows.select("_source_path").distinct().count() == 3


def latest_in_python(rows):
    """Highest (seq, value) per key; NULL sorts lowest."""
    best = {}
    for key, seq, value in rows:
        rank = (seq, value is not None, value or "")
        if key not in best or rank > best[key][0]:
            best[key] = (rank, (key, seq, value))
    return sorted((row for _, row in best.values()), key=repr)


KEYED = st.tuples(st.sampled_from([None, "a", "b", "c"]), st.integers(0, 3), st.sampled_from([None, "x", "y"]))


@FEW
@given(st.lists(KEYED, min_size=1, max_size=25))
def test_dedup_keeps_the_latest(spark, rows):
    df = spark.createDataFrame(rows, "k string, seq int, v string")
    latest = dedup(df, ["k"], ["seq"])
    assert sorted(map(tuple, latest.collect()), key=repr) == latest_in_python(rows)
    removed = len(rows) - len({r[0] for r in rows})
    assert duplicate_count(df, ["k"]).collect()[0].duplicates == removed
    assert dedup(df, ["k"], keep="any").count() == len(rows) - removed


def test_dedup_defaults_to_ingestion_time(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new")], "k string, _ingested_at int, v string")
    assert dedup(df, ["k"]).collect()[0].v == "new"
    with pytest.raises(ValueError):
        dedup(df, ["k"], keep="first")


def test_duplicate_count_of_nothing(spark):
    assert duplicate_count(spark.createDataFrame([], "k string"), ["k"]).collect()[0].duplicates == 0


def test_summary(spark):
    day = dt.datetime(2024, 1, 1, 12)
    rows = spark.createDataFrame(
        [
            ("1", "a", Decimal("10.00"), day, "X"),
            ("2", "a", Decimal("0.00"), day, "X"),
            (None, "b", Decimal("0.01"), day, "X"),
            ("4", None, Decimal("5.00"), None, "X"),
        ],
        "order_id string, customer_id string, amount decimal(18,2), order_date timestamp_ntz, status string",
    )
    got = {row.order_date: row for row in daily_order_summary(rows).collect()}
    full = got[dt.date(2024, 1, 1)]
    assert (full.total_orders, full.total_revenue, full.unique_customers) == (2, Decimal("10.01"), 2)
    assert full.avg_order_value == Decimal("3.336667")
    assert (got[None].total_orders, got[None].unique_customers) == (1, 0)
    assert daily_order_summary(rows, approx_customers=True).count() == 2

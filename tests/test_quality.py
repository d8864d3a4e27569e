"""Rules, score and gate."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakelayers.operators import quality as q

FEW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
ORDERS = "order_id string, customer_id string, amount double, order_date string, status string"
GOOD = [("1", "a", 10.0, "2024-01-01", "PENDING"), ("2", "b", 0.0, "2024-01-01", "SHIPPED")]


def results(df, rules, **options):
    return q.rule_results(df, rules, "orders", "2024-01-01", **options).orderBy("partition_date", "rule_no").collect()


def test_unknown_dataset_is_skipped(spark):
    row = q.run_quality_check(spark.range(1), "unknown_dataset", "2024-01-01").collect()[0]
    assert row.success and row.skipped and row.total_checks == 0


def test_all_pass(spark):
    row = q.run_quality_check(spark.createDataFrame(GOOD, ORDERS), "orders", "2024-01-01").collect()[0]
    assert (row.success, row.pass_rate, row.passed, row.failed) == (True, 1.0, 8, 0)


def test_below_threshold_raises(spark):
    """Existence, all not-null rules and the set rule fail; unique, range and row count pass."""
    rows = spark.createDataFrame([(None, None, 1.0, None, "nope")], ORDERS)
    rules = [q.exists("missing"), *q.RULES["orders"][1:]]
    with pytest.raises(ValueError, match="FAILED") as caught:
        q.run_quality_check(rows, "orders", "2024-01-01", threshold=0.99, rules=rules)
    assert str(caught.value) == (
        "[QUALITY] FAILED for 'orders' on 2024-01-01. Pass rate: 37.5% < threshold 99.0%"
    )


def test_report_has_the_same_text(spark):
    rows = spark.createDataFrame([(None, None, 1.0, None, "nope")], ORDERS)
    row = q.run_quality_check(rows, "orders", "2024-01-01", on_fail="report").collect()[0]
    assert row.message == q.failure_text("orders", "2024-01-01", row.passed, row.total_checks, 0.95)
    with pytest.raises(ValueError, match="on_fail"):
        q.run_quality_check(rows, "orders", "2024-01-01", on_fail="ignore")


def test_empty_table(spark):
    rows = results(spark.createDataFrame([], ORDERS), q.RULES["orders"])
    assert [r.success for r in rows] == [True] * 7 + [False]
    assert {r.element_count for r in rows[1:]} == {0}


@pytest.mark.parametrize("rate", [(7, 8, 0.875, True), (7, 8, 0.8751, False), (3, 4, 0.75, True)])
def test_threshold_is_inclusive_and_compared_unrounded(spark, rate):
    passed, total, threshold, success = rate
    flags = [(i, "d", "2024-01-01", i < passed, True) for i in range(total)]
    rows = spark.createDataFrame(flags, "i int, dataset string, partition_date string, success boolean, scored boolean")
    assert q.score(rows, threshold).collect()[0].success is success


def test_rate_is_reported_like_python_rounds(spark):
    flags = [("d", "2024-01-01", i < 1, True) for i in range(32)]
    rows = spark.createDataFrame(flags, "dataset string, partition_date string, success boolean, scored boolean")
    assert q.score(rows).collect()[0].pass_rate == round(1 / 32, 4)


def test_missing_column_fails_its_rules(spark):
    rows = results(spark.createDataFrame(GOOD, ORDERS).drop("status", "order_id"), q.RULES["orders"])
    assert [r.rule_no for r in rows if not r.success] == [1, 2, 3, 7]
    assert len(rows) == 8


def test_two_unique_rules_and_none(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), (None, None), (None, 3)], "x string, y int")
    rows = results(df, [q.unique("x"), q.not_null("y"), q.unique("y")])
    assert [(r.rule_no, r.element_count, r.missing_count, r.unexpected_count) for r in rows] == [
        (1, 5, 2, 2),
        (2, 5, 1, 1),
        (3, 5, 1, 2),
    ]
    assert [r.unexpected_count for r in results(df, [q.not_null("y")])] == [1]


def test_unique_rules_with_names_in_other_case(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "x string, y int")
    rows = results(df, [q.unique("X"), q.unique("Y"), q.unique("x"), q.exists("X")])
    assert [(r.rule_no, r.unexpected_count, r.success) for r in rows] == [
        (1, 2, False),
        (2, 0, True),
        (3, 2, False),
        (4, None, False),
    ]


def test_text_amounts_are_compared_as_numbers(spark):
    df = spark.createDataFrame([("9",), ("x",), ("-1",), (None,), ("NaN",), ("10.5",)], "amount string")
    (row,) = results(df, [q.between("amount", 0, 10)])
    assert (row.missing_count, row.unexpected_count) == (1, 4)


def test_nan_is_out_of_range(spark):
    df = spark.createDataFrame([(float("nan"),), (0.0,), (10.0,)], "amount double")
    assert results(df, [q.between("amount", 0, 10)])[0].unexpected_count == 1


def test_informational_rule_is_not_scored(spark):
    df = spark.createDataFrame([("x",), ("1",), (None,)], "amount string")
    checked = q.rule_results(df, [q.parses_as_money("amount"), q.row_count_between(1, 9)], "d", "2024-01-01")
    info = checked.filter("not scored").collect()[0]
    assert (info.unexpected_count, info.success) == (1, False)
    assert q.score(checked).collect()[0].total_checks == 1


def test_own_rule(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "qty int")
    (row,) = results(df, [q.Rule("expect_even", "qty", {}, lambda col, _: col % 2 == 0)])
    assert (row.method, row.missing_count, row.unexpected_count) == ("expect_even", 1, 1)


def test_dates_are_checked_apart(spark):
    df = spark.createDataFrame([("d1", "k"), ("d2", "k"), ("d2", "k")], "dt string, x string")
    rows = results(df, [q.unique("x"), q.row_count_between(1, 9)], by="dt", expected=["d1", "d2", "d3"])
    got = [(r.partition_date, r.rule_no, r.element_count, r.success) for r in rows]
    assert got == [
        ("d1", 1, 1, True),
        ("d1", 2, 1, True),
        ("d2", 1, 2, False),
        ("d2", 2, 2, True),
        ("d3", 1, 0, True),
        ("d3", 2, 0, False),
    ]


def test_allow_and_limit(spark):
    wider = q.allow(q.RULES["orders"], {"status": ["UNKNOWN"]})
    df = spark.createDataFrame([("1", "a", 1.0, "2024-01-01", "UNKNOWN")], ORDERS)
    assert not results(df, q.RULES["orders"])[6].success
    assert results(df, wider)[6].success
    assert q.limit_rows(wider, 5)[7].args["max_value"] == 5
    assert q.RULES["orders"][7].args["max_value"] == 10_000_000


@FEW
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.sampled_from(["1", "2", "3"])),
            st.one_of(st.none(), st.floats(-5, 15)),
            st.one_of(st.none(), st.sampled_from(["PENDING", "pending", "x"])),
            st.one_of(st.none(), st.text(st.sampled_from("a@. "), max_size=8)),
        ),
        max_size=20,
    )
)
def test_counts_equal_python(spark, rows):
    df = spark.createDataFrame(rows, "k string, amount double, status string, email string")
    keys = [r[0] for r in rows if r[0] is not None]
    expected = [
        sum(r[0] is None for r in rows),
        sum(keys.count(k) > 1 for k in keys),
        sum(r[1] is not None and not 0 <= r[1] <= 10 for r in rows),
        sum(r[2] is not None and r[2] not in q.STATUSES for r in rows),
        sum(r[3] is not None and not re.search(q.EMAIL, r[3]) for r in rows),
    ]
    rules = [
        q.not_null("k"),
        q.unique("k"),
        q.between("amount", 0, 10),
        q.in_set("status", q.STATUSES),
        q.matches("email", q.EMAIL),
    ]
    got = results(df, rules)
    assert [r.unexpected_count for r in got] == expected
    assert [r.success for r in got] == [n == 0 for n in expected]


@pytest.mark.parametrize(("email", "ok"), [("x y@z.w k", True), ("a@b", False), ("@a.b", False), (None, True)])
def test_email(spark, email, ok):
    df = spark.createDataFrame([(email,)], "email string")
    assert results(df, [q.matches("email", q.EMAIL)])[0].success is ok


def test_report_and_error_print_the_same(spark):
    rows = [("orders", f"{n}/{i}", n, n // 2, n - n // 2, 0.5, i / 10_000, False, False) for n in (0, 3, 7, 8, 9) for i in range(9000, 10_000, 25)]
    told = q.gate(spark.createDataFrame(rows, q.QUALITY_SUMMARY), on_fail="report").collect()
    for r in told:
        assert r.message == q.failure_text(r.dataset, r.partition_date, r.passed, r.total_checks, r.threshold)
    assert any("< threshold 97.2%" in r.message and r.threshold == 0.9725 for r in told)


def test_nothing_to_score(spark):
    df = spark.createDataFrame(GOOD, ORDERS)
    assert q.rule_results(df, [], "orders", "2024-01-01").collect() == []
    unscored = [q.parses_as_money("amount")]
    row = q.score(q.rule_results(df, unscored, "orders", "2024-01-01")).collect()[0]
    assert (row.total_checks, row.pass_rate, row.success) == (0, 0.0, False)

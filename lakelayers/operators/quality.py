"""Declarative data-quality rules, compiled to aggregates that check all rules of a dataset in one scan."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.schemas import MONEY, QUALITY_RULES, QUALITY_SUMMARY


@dataclass(frozen=True)
class Rule:
    """One check. ``conforms`` maps the column and its type to the condition every non-null row must meet."""

    method: str
    column: str | None = None
    args: Mapping[str, object] = field(default_factory=dict)
    conforms: Callable[[Column, T.DataType], Column] | None = None
    scored: bool = True


# The method names under which results are reported.
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
ROW_COUNT = "expect_table_row_count_to_be_between"
MATCHES = "expect_column_values_to_match_regex"


def exists(column: str) -> Rule:
    return Rule(EXISTS, column)


def not_null(column: str) -> Rule:
    return Rule(NOT_NULL, column)


def unique(column: str) -> Rule:
    """Every row of a value that occurs more than once is unexpected."""
    return Rule(UNIQUE, column)


def between(column: str, min_value: float, max_value: float) -> Rule:
    """Inclusive range. Text is compared as a number; NaN and text that is no number are out of range."""

    def conforms(col: Column, kind: T.DataType) -> Column:
        number = col.try_cast("double") if isinstance(kind, T.StringType) else col
        return number.between(min_value, max_value)

    return Rule(BETWEEN, column, {"min_value": min_value, "max_value": max_value}, conforms)


def in_set(column: str, value_set: Sequence[str]) -> Rule:
    """Membership, case-sensitive."""
    return Rule(
        IN_SET, column, {"value_set": list(value_set)}, lambda col, _: col.cast("string").isin(*value_set)
    )


def matches(column: str, regex: str) -> Rule:
    """The pattern is found anywhere in the text."""
    return Rule(MATCHES, column, {"regex": regex}, lambda col, _: col.cast("string").rlike(regex))


def row_count_between(min_value: int, max_value: int) -> Rule:
    return Rule(ROW_COUNT, None, {"min_value": min_value, "max_value": max_value})


def parses_as_money(column: str) -> Rule:
    """Informational: counts values that the typed layer would turn into a filled zero."""
    return Rule("parses_as_money", column, {}, lambda col, _: col.try_cast(MONEY).isNotNull(), scored=False)


# Statuses, bounds, e-mail pattern, threshold, and the rules of each dataset in their order.
STATUSES = ("PENDING", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED")
MAX_AMOUNT = 10_000_000
MAX_ROWS = 10_000_000
EMAIL = r"[^@]+@[^@]+\.[^@]+"
DEFAULT_THRESHOLD = 0.95

RULES: dict[str, tuple[Rule, ...]] = {
    "orders": (
        exists("order_id"),
        not_null("order_id"),
        unique("order_id"),
        not_null("customer_id"),
        between("amount", 0, MAX_AMOUNT),
        not_null("order_date"),
        in_set("status", STATUSES),
        row_count_between(1, MAX_ROWS),
    ),
    "customers": (
        exists("customer_id"),
        not_null("customer_id"),
        unique("customer_id"),
        matches("email", EMAIL),
    ),
}


def allow(rules: Sequence[Rule], extra: Mapping[str, Sequence[str]]) -> tuple[Rule, ...]:
    """Widen the set rules of the named columns by more allowed values."""
    return tuple(
        in_set(rule.column, [*rule.args["value_set"], *extra[rule.column]])
        if rule.method == IN_SET and rule.column in extra
        else rule
        for rule in rules
    )


def limit_rows(rules: Sequence[Rule], max_value: int) -> tuple[Rule, ...]:
    """Replace the upper bound of the row-count rules, for tables that are meant to be larger."""
    return tuple(
        replace(rule, args={**rule.args, "max_value": max_value}) if rule.method == ROW_COUNT else rule
        for rule in rules
    )


def rule_results(
    df: DataFrame,
    rules: Sequence[Rule],
    dataset: str,
    dt: str | None = None,
    by: str | None = None,
    expected: Sequence[str] = (),
) -> DataFrame:
    """One row per rule with its counts (schema ``QUALITY_RULES``).

    With ``by`` every value of that column (a partition date) is checked as a table of its own in the same job;
    dates in ``expected`` that have no rows are reported as empty tables.

    The first unique rule decides the shape: rows are pre-aggregated per key, which carries the sums of all
    row rules along, and the small per-key result is aggregated once more. One scan, one shuffle of one record
    per key and task. Each further unique rule reads only its own column.
    """
    if not rules:
        return df.sparkSession.createDataFrame([], QUALITY_RULES)
    present = {name.lower(): name for name in df.columns}
    unique_columns = [present.get(r.column.lower()) for r in rules if r.method == UNIQUE]
    keys = list(dict.fromkeys(column for column in unique_columns if column is not None))
    passes = [_one_pass(df, rules, keys[0] if keys else None, by, expected, present)]
    for key in keys[1:]:
        own = [r if r.method == UNIQUE and present.get(r.column.lower()) == key else None for r in rules]
        passes.append(_one_pass(df, own, key, by, expected, present))
    results = passes[0]
    for other in passes[1:]:
        results = results.unionByName(other)
    date = F.lit(dt).cast("string") if by is None else F.col("_group")
    named = results.withColumns({"dataset": F.lit(dataset), "partition_date": date})
    return named.select(*[f.name for f in QUALITY_RULES])


def _one_pass(df, rules, key, by, expected, present) -> DataFrame:
    """Rule rows that one grouping by ``key`` (or no grouping) can answer; ``None`` entries are left out.

    Counts get numbered names: ``n`` rows, ``nulls_i`` per column, ``bad_i`` per rule, ``repeated`` for the key.
    """
    group = [] if by is None else ["_group"]
    kinds = {f.name: f.dataType for f in df.schema}
    nulls: dict[str, str] = {} if key is None else {key: "nulls_0"}
    flags: dict[str, Column] = {}
    outcome = []
    for number, rule in enumerate(rules, start=1):
        if rule is None:
            continue
        column = None if rule.column is None else present.get(rule.column.lower())
        if rule.method == UNIQUE and column is not None and column != key:
            continue  # answered by its own pass
        if column is not None and rule.method != EXISTS:
            if column not in nulls:
                nulls[column] = f"nulls_{number}"
                flags[nulls[column]] = F.col(column).isNull()
            if rule.conforms is not None:
                fits = F.coalesce(rule.conforms(F.col(column), kinds[column]), F.lit(False))
                flags[f"bad_{number}"] = F.col(column).isNotNull() & ~fits
        outcome.append(_rule_values(number, rule, column, nulls.get(column)))

    source = df if by is None else df.withColumn("_group", F.col(by))
    counts = [F.count(F.lit(1)).alias("n"), *[F.count_if(flag).alias(name) for name, flag in flags.items()]]
    if key is None:
        totals = source.groupBy(*group).agg(*counts)
    else:
        sums = {"n": "n", "nulls_0": "CASE WHEN _key IS NULL THEN n END"}
        sums["repeated"] = "CASE WHEN _key IS NOT NULL AND n > 1 THEN n END"
        sums |= {name: name for name in flags}
        totals = (
            source.groupBy(*group, F.col(key).alias("_key"))
            .agg(*counts)
            .groupBy(*group)
            .agg(*[F.expr(f"coalesce(sum({value}), 0L) AS {name}") for name, value in sums.items()])
        )
    if by is not None and expected:
        dates = df.sparkSession.createDataFrame([(d,) for d in expected], "_group string")
        totals = dates.join(totals, "_group", "full_outer").fillna(0)

    columns = "(rule_no, element_count, missing_count, unexpected_count, success)"
    rows = totals.selectExpr(*group, f"stack({len(outcome)}, {', '.join(outcome)}) AS {columns}")
    described = F.element_at(F.from_json(F.lit(_describe(rules)), _DESCRIPTION), F.col("rule_no"))
    return rows.withColumn("_rule", described).select("*", "_rule.*").drop("_rule")


_DESCRIPTION = "array<struct<method string, column string, args string, scored boolean>>"


def _describe(rules: Sequence[Rule | None]) -> str:
    """What is fixed about each rule, by position."""

    def facts(rule: Rule) -> dict[str, object]:
        args = json.dumps(dict(rule.args), sort_keys=True)
        return {"method": rule.method, "column": rule.column, "args": args, "scored": rule.scored}

    return json.dumps([None if rule is None else facts(rule) for rule in rules])


def _rule_values(number: int, rule: Rule, column: str | None, missing: str | None) -> str:
    """Values of one rule row: number, element, missing and unexpected count, success."""
    none = "CAST(NULL AS BIGINT)"
    if rule.method == EXISTS:
        values = (none, none, none, str(column is not None and column == rule.column).lower())
    elif rule.method == ROW_COUNT:
        values = ("n", none, none, f"n BETWEEN {rule.args['min_value']:d} AND {rule.args['max_value']:d}")
    elif column is None:
        values = (none, none, none, "false")
    else:
        unexpected = {NOT_NULL: missing, UNIQUE: "repeated"}.get(rule.method, f"bad_{number}")
        values = ("n", missing, unexpected, f"{unexpected} = 0")
    return ", ".join((str(number), *values))


def with_failed_rules(df: DataFrame, rules: Sequence[Rule], by: str | None = None) -> DataFrame:
    """``df`` with ``_failed``: bit n - 1 is set in rows that fail rule n.

    A rule that judges the table as a whole (existence, row count) or whose column is missing sets no bit. Uniqueness, within
    each value of ``by``, takes a shuffle by its column; the other rules take none. At most 63 rules.
    """
    present = {name.lower(): name for name in df.columns}
    kinds = {f.name: f.dataType for f in df.schema}
    mask = F.lit(0).cast("long")
    for number, rule in enumerate(rules):
        column = None if rule.column is None else present.get(rule.column.lower())
        if column is None or rule.method in (EXISTS, ROW_COUNT):
            continue
        value = F.col(column)
        if rule.method == NOT_NULL:
            fails = value.isNull()
        elif rule.method == UNIQUE:
            same = Window.partitionBy(*([] if by is None else [by]), column)
            fails = value.isNotNull() & (F.count(F.lit(1)).over(same) > 1)
        else:
            fails = value.isNotNull() & ~F.coalesce(rule.conforms(value, kinds[column]), F.lit(False))
        mask = mask.bitwiseOR(F.when(fails, F.lit(1 << number)).otherwise(F.lit(0)).cast("long"))
    return df.withColumn("_failed", mask)


def failing_rows(
    df: DataFrame,
    rules: Sequence[Rule],
    dataset: str,
    show: Sequence[str],
    dt: str | None = None,
    by: str | None = None,
    keep: int = 5,
    rank: Column | None = None,
) -> DataFrame:
    """Which rows fail: ``dataset, partition_date, rule_no, method, column, failed, slot`` and the columns ``show``.

    ``failed`` counts the rows that fail the rule; up to ``keep`` of them are shown, in each of ``keep`` slots the row
    whose ``rank`` is lowest (a long; a hash of the shown columns unless given, the slot is its remainder), so that every run shows the
    same rows. Counts and examples come out of one aggregate over one scan: a task passes on no more than a row per date, rule and
    slot, however many rows fail. A rule that nothing fails has no row.
    """
    ordered = F.xxhash64(*show) if rank is None else rank
    date = F.lit(dt).cast("string") if by is None else F.col(by)
    marked = with_failed_rules(df, rules, by).filter("_failed <> 0")
    numbers = F.filter(
        F.sequence(F.lit(1), F.lit(len(rules))), lambda n: F.col("_failed").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), n - 1)) != 0
    )
    rows = marked.select(
        date.alias("partition_date"), F.explode(numbers).alias("rule_no"), F.struct(ordered.alias("_rank"), *show).alias("_row")
    ).withColumn("slot", F.pmod("_row._rank", F.lit(keep)).cast("int"))
    found = rows.groupBy("partition_date", "rule_no", "slot").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_row"))
    whole = Window.partitionBy("partition_date", "rule_no")
    described = F.element_at(F.from_json(F.lit(_describe(rules)), _DESCRIPTION), F.col("rule_no"))
    found = found.withColumns({"failed": F.sum("_n").over(whole), "_rule": described, "dataset": F.lit(dataset)})
    return found.select(
        "dataset", "partition_date", "rule_no", "_rule.method", "_rule.column", "failed", "slot", *[F.col(f"_row.{c}").alias(c) for c in show]
    )


def score(results: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Share of passed rules per dataset and date; reported to four places, compared unrounded; 0 without scored rules."""
    total, passed = F.col("total_checks"), F.col("passed")
    share = F.coalesce(F.try_divide(passed, total), F.lit(0.0))
    return (
        results.groupBy("dataset", "partition_date")
        .agg(
            F.count_if("scored").cast("int").alias("total_checks"),
            F.count_if(F.col("scored") & F.col("success")).cast("int").alias("passed"),
        )
        .select(
            "dataset",
            "partition_date",
            "total_checks",
            "passed",
            (total - passed).alias("failed"),
            F.bround(share, 4).alias("pass_rate"),
            F.lit(float(threshold)).alias("threshold"),
            (share >= F.lit(float(threshold))).alias("success"),
            F.lit(False).alias("skipped"),
        )
    )


def skipped_summary(
    spark: SparkSession, dataset: str, dt: str | None, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Summary of a dataset without rules: a success that checked nothing."""
    return spark.createDataFrame([(dataset, dt, 0, 0, 0, None, float(threshold), True, True)], QUALITY_SUMMARY)


class QualityGateError(ValueError):
    """Raised when too few rules passed."""


# Fixed value: text of a failed gate, with the rates in percent.
FAILURE_TEXT = "[QUALITY] FAILED for '%s' on %s. Pass rate: %.1f%% < threshold %.1f%%"


def failure_text(dataset: str, dt: str, passed: int, total: int, threshold: float) -> str:
    percent = lambda share: round(Decimal(repr(share * 100)), 1)  # noqa: E731 -- as ``bround`` does
    return FAILURE_TEXT % (dataset, dt, percent(passed / total if total else 0.0), percent(threshold))


def _percent(share: Column) -> Column:
    """In percent with one decimal, halves to even."""
    return F.bround(share * 100, 1)


def gate(summary: DataFrame, on_fail: str = "raise") -> DataFrame:
    """Stop on failed checks, or with ``report`` add their text as ``message``.

    ``raise`` runs the checks (a summary has one row per dataset and date) and returns the computed rows.
    """
    if on_fail == "report":
        text = F.format_string(
            FAILURE_TEXT,
            "dataset",
            "partition_date",
            _percent(F.coalesce(F.try_divide("passed", "total_checks"), F.lit(0.0))),
            _percent(F.col("threshold")),
        )
        return summary.withColumn("message", F.when(~F.col("success"), text))
    if on_fail != "raise":
        raise ValueError(f"on_fail must be 'raise' or 'report', not {on_fail!r}")
    rows = summary.collect()
    failed = [
        failure_text(r.dataset, r.partition_date, r.passed, r.total_checks, r.threshold)
        for r in rows
        if not r.success
    ]
    if failed:
        raise QualityGateError("\n".join(failed))
    return summary.sparkSession.createDataFrame(rows, summary.schema)


def run_quality_check(
    df: DataFrame,
    dataset: str,
    dt: str,
    threshold: float = DEFAULT_THRESHOLD,
    on_fail: str = "raise",
    rules: Sequence[Rule] | None = None,
) -> DataFrame:
    """Check ``df`` against its dataset's rules and pass the gate; without rules nothing is read."""
    rules = RULES.get(dataset, ()) if rules is None else rules
    if not rules:
        return skipped_summary(df.sparkSession, dataset, dt, threshold)
    return gate(score(rule_results(df, rules, dataset, dt), threshold), on_fail)

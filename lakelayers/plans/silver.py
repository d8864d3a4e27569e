"""Bronze rows into the typed, deduplicated silver layer, behind the quality gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.operators.clean import add_silver_metadata, clean_orders
from lakelayers.operators.dedup import dedup
from lakelayers.operators.quality import (
    DEFAULT_THRESHOLD,
    RULES,
    QualityGateError,
    Rule,
    failing_rows,
    failure_text,
    rule_results,
    score,
)
from lakelayers.schemas import ORDER_COLUMNS, PARTITION, QUALITY_EXAMPLES, QUALITY_RULES, QUALITY_SUMMARY
from lakelayers.sources.files import remove
from lakelayers.sources.layers import (
    Written,
    clear_empty,
    for_partition,
    overwrite_layer,
    read_dates,
    read_layer,
    rows_by_date,
    write_counted,
    write_days,
)
from lakelayers.sources.publish import finish, publish_dates


@dataclass(frozen=True)
class Checked:
    """Results of one gate: a row per rule and date, a row per date, the dates on either side, rows of those that failed."""

    results: DataFrame
    summary: DataFrame
    passed: list[str]
    failures: dict[str, str]
    examples: DataFrame | None = None


def check_dates(
    df: DataFrame, rules: Sequence[Rule], dataset: str, dates: Sequence[str], threshold: float, examples: bool = True
) -> Checked:
    """Check every date of ``df`` on its own, in one job. Only rules x dates rows come to the driver.

    Of dates that fail a second scan takes a few ``examples``, unless the gate only reports.

    Without rules nothing is read and every date passes, with a summary that says it was skipped.
    """
    spark = df.sparkSession
    if not rules:
        none = [(dataset, dt, 0, 0, 0, None, float(threshold), True, True) for dt in dates]
        return Checked(spark.createDataFrame([], QUALITY_RULES), spark.createDataFrame(none, QUALITY_SUMMARY), list(dates), {})
    rows = rule_results(df, rules, dataset, by=PARTITION).collect()
    without_rows = sorted(set(dates) - {row.partition_date for row in rows})
    if without_rows:
        rows += rule_results(df.limit(0), rules, dataset, by=PARTITION, expected=without_rows).collect()
    # One partition of a few rows: the score needs no shuffle.
    results = spark.createDataFrame(rows, QUALITY_RULES).coalesce(1)
    verdicts = score(results, threshold).collect()
    failures = {
        v.partition_date: failure_text(dataset, v.partition_date, v.passed, v.total_checks, threshold)
        for v in verdicts
        if not v.success
    }
    passed = [dt for dt in dates if dt not in failures]
    shown = _examples(df, rules, dataset, failures) if failures and examples else None
    return Checked(results, spark.createDataFrame(verdicts, QUALITY_SUMMARY), passed, failures, shown)


def _examples(df: DataFrame, rules: Sequence[Rule], dataset: str, failures: Mapping[str, str]) -> DataFrame:
    """A few rows per failed date and rule, as JSON; read only if a date failed."""
    row = F.to_json(F.struct(*[c for c in df.columns if c != PARTITION])).alias("row")
    found = failing_rows(for_partition(df, *failures).select("*", row), rules, dataset, ("row",), by=PARTITION)
    return df.sparkSession.createDataFrame(found.collect(), QUALITY_EXAMPLES)


def compact(df: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Gather each date's rows before a write of several dates.

    Otherwise every task would write a file per date. Adaptive execution splits a large date over many tasks
    and joins small ones, so a date that holds most rows does not end in one task.
    """
    return df if len(dates) == 1 else df.hint("rebalance", F.col(PARTITION))


def silver_frame(bronze: DataFrame, as_of: datetime | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    """Latest row per order and date, cleaned; the shuffle is on (date, order).

    ``order_by`` says which row is the latest; the ingestion time decides between equal ones and where it is empty.
    """
    lacking = [c for c in (*ORDER_COLUMNS, *order_by) if c not in bronze.columns]
    if lacking:
        raise ValueError(f"the bronze rows lack the columns {', '.join(lacking)}")
    latest = dedup(bronze, [PARTITION, "order_id"], [*order_by, "_ingested_at"] if order_by else None)
    return add_silver_metadata(clean_orders(latest), None, as_of)


@dataclass(frozen=True)
class Silver:
    written: Written
    duplicates: dict[str, int]
    checked: Checked


def transform_days(
    spark: SparkSession,
    bronze: str,
    silver: str,
    staging: str,
    dates: Sequence[str],
    dataset: str = "orders",
    rules: Sequence[Rule] | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    scope: str = "partition",
    fmt: str = "parquet",
    as_of: datetime | None = None,
    order_by: Sequence[str] = (),
    schema: T.StructType | None = None,
    rows_in: Mapping[str, int] | None = None,
) -> Silver:
    """Transform the given dates and publish those that pass the gate.

    The rows are written once to ``staging``; the gate reads that table, and the folders of the dates that pass are
    then moved into the layer (:mod:`lakelayers.sources.publish`). What is served is therefore exactly what was checked, and
    neither the check nor the publication repeats the shuffle of the deduplication. A publication that an earlier run
    left unfinished is finished first. Other formats than Parquet keep a log of files, there the rows are copied. ``staging`` is
    removed at the end, by the publication once that has begun. Who knows the columns of the
    bronze rows (``schema``) and how many each date has (``rows_in``) saves reading file footers for them.
    """
    dates = list(dates)
    if fmt == "parquet":
        finish(spark, silver)
    source = read_dates(spark, bronze, dates, fmt, schema)
    rows = silver_frame(source, as_of, order_by)
    own = True
    try:
        kept = write_days(
            compact(rows, dates),
            lambda df: overwrite_layer(df, staging, "table", "replace", fmt),
            staging,
            dates,
            fmt,
        )
        rows_in = rows_by_date(source) if rows_in is None else rows_in
        duplicates = {dt: rows_in.get(dt, 0) - kept.by_date[dt] for dt in dates}

        # With the schema given nothing is inferred, not even from a table without files.
        staged = read_layer(spark, staging, fmt, schema=rows.schema)
        checked = check_dates(staged, RULES.get(dataset, ()) if rules is None else rules, dataset, dates, threshold)
        if not checked.passed:
            return Silver(Written(0, {}), duplicates, checked)
        by_date = {dt: kept.by_date[dt] for dt in checked.passed}
        if fmt == "parquet":
            clear_empty(staged, staging, by_date)
            own = False
            publish_dates(spark, staging, silver, checked.passed, whole=scope == "table")
        else:
            good = for_partition(staged, *checked.passed)
            write_counted(good, lambda df: overwrite_layer(df, silver, scope, "replace", fmt))
            if scope == "partition":
                clear_empty(good, silver, by_date, fmt)
    finally:
        if own:
            remove(spark, staging)
    return Silver(Written(sum(by_date.values()), by_date), duplicates, checked)


def transform_orders_silver(
    spark: SparkSession, bronze: str, silver: str, dt: str, staging: str | None = None, **options: object
) -> dict[str, object]:
    """One date; raises and publishes nothing if the gate fails."""
    done = transform_days(spark, bronze, silver, staging or f"{silver}_staging", [dt], **options)
    if done.checked.failures:
        raise QualityGateError(done.checked.failures[dt])
    return {"row_count": done.written.rows, "duplicates": done.duplicates[dt], "path": silver}

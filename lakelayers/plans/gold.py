"""Daily order summary from the silver layer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from lakelayers.operators.clean import add_gold_metadata
from lakelayers.operators.summary import daily_order_summary
from lakelayers.plans.silver import compact
from lakelayers.schemas import CLEAN_ORDERS, PARTITION
from lakelayers.sources.layers import (
    Written,
    clear_empty,
    overwrite_layer,
    read_dates,
    write_days,
)


def gold_frame(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Summary per partition date. Dates are not additive: an order day can occur under several dates."""
    return add_gold_metadata(daily_order_summary(silver, by=[PARTITION]), None, as_of)


def build_days(
    spark: SparkSession,
    silver: str,
    gold: str,
    dates: Sequence[str],
    scope: str = "partition",
    fmt: str = "parquet",
    as_of: datetime | None = None,
) -> Written:
    """Summaries of several dates in one job; columns may be added to the table over time.

    Only the clean order columns are read, whose types are fixed, so no file footer is opened to find them.
    """
    dates = list(dates)
    summary = gold_frame(read_dates(spark, silver, dates, fmt, CLEAN_ORDERS), as_of)
    written = write_days(
        compact(summary, dates),
        lambda df: overwrite_layer(df, gold, scope, "merge", fmt),
        gold,
        dates,
        fmt,
    )
    if scope == "partition":
        clear_empty(summary, gold, written.by_date, fmt)
    return written


def build_daily_order_summary(
    spark: SparkSession, silver: str, gold: str, dt: str, **options: object
) -> dict[str, object]:
    """One date."""
    written = build_days(spark, silver, gold, [dt], **options)
    return {"row_count": written.rows, "path": gold}

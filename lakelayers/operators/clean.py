"""Metadata columns and column-wise cleaning."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers.functions.scalar import now_or, parse_ts, standardise, to_money
from lakelayers.schemas import BRONZE_ONLY, PARTITION, REJECT_COLUMNS

# What a missing status or amount is filled with.
FILLS = {"status": "UNKNOWN", "amount": 0.0}


def add_bronze_metadata(
    df: DataFrame,
    source_path: str | Column | None,
    dt: str | Column,
    run_id: str,
    as_of: datetime | None = None,
) -> DataFrame:
    """Four lineage columns; business columns stay as read. Without a source path each row gets its own file's."""
    source = F.col("_metadata.file_path") if source_path is None else source_path
    return df.withColumns(
        {
            "_ingested_at": now_or(as_of),
            "_source_path": source if isinstance(source, Column) else F.lit(source),
            PARTITION: dt if isinstance(dt, Column) else F.lit(dt),
            "_pipeline_run": F.lit(run_id),
        }
    )


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*names)


def _stamp(df: DataFrame, column: str, dt: str | None, as_of: datetime | None) -> DataFrame:
    added = {column: now_or(as_of)}
    if dt is not None:
        added[PARTITION] = F.lit(dt)
    return df.withColumns(added)


def add_silver_metadata(df: DataFrame, dt: str | None, as_of: datetime | None = None) -> DataFrame:
    """Write time and partition date; ``dt=None`` keeps the date each row has (several dates in one job)."""
    return _stamp(df, "_silver_at", dt, as_of)


def add_gold_metadata(df: DataFrame, dt: str | None, as_of: datetime | None = None) -> DataFrame:
    return _stamp(df, "_gold_at", dt, as_of)


def to_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("string") for name in columns})


def fill_nulls(df: DataFrame, values: Mapping[str, object] = FILLS) -> DataFrame:
    return df.fillna(dict(values))


def clean_orders(df: DataFrame) -> DataFrame:
    """Cast and standardise the order columns, then fill; other columns pass through."""
    typed = to_text(df, ("order_id", "customer_id")).withColumns(
        {
            "amount": to_money("amount"),
            "order_date": parse_ts("order_date"),
            "status": standardise("status"),
        }
    )
    return drop_columns(fill_nulls(typed), (*BRONZE_ONLY, *REJECT_COLUMNS))

"""Casts and text functions of the typed layer. Bad input gives NULL, never an error."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_money(column: str, precision: int = 18, scale: int = 2) -> Column:
    """Decimal, rounded half up; NULL if the value does not parse or does not fit."""
    return F.col(column).try_cast(f"decimal({precision},{scale})")


def parse_ts(column: str, fmt: str = "yyyy-MM-dd") -> Column:
    """Timestamp from text in exactly this format; dates and timestamps are taken over with their time."""
    return F.try_to_timestamp(F.col(column), F.lit(fmt))


def day_of(column: str) -> Column:
    return F.to_date(column)


def standardise(column: str) -> Column:
    """Upper case without spaces at the ends; tabs stay."""
    return F.upper(F.trim(column))


def now_or(as_of: datetime | None = None) -> Column:
    """Time of the query, or a fixed time."""
    return F.current_timestamp() if as_of is None else F.lit(as_of)

"""One row per key, and how many rows that removes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    keep: str = "latest",
) -> DataFrame:
    """Keep one row per key; all NULL keys are one group.

    ``latest`` takes the row that is highest in ``order_by`` (default ``_ingested_at`` where present) and then
    in the other business columns by name, so a re-run keeps the same row. Every scan task already reduces its rows to
    one per key before the shuffle (``WindowGroupLimit`` in the plan), so a key that holds a third of the table
    ships one row per task. ``any`` takes whichever row Spark meets first.
    """
    if keep == "any":
        return df.dropDuplicates(list(keys))
    if keep != "latest":
        raise ValueError(f"keep must be 'latest' or 'any', not {keep!r}")
    if order_by is None:
        order_by = [c for c in ("_ingested_at",) if c in df.columns]
    ties = sorted(c for c in df.columns if c not in keys and c not in order_by and not c.startswith("_"))
    ranked = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order_by, *ties]])
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``duplicates``: rows that :func:`dedup` removes, from counts per key (partial counts before the shuffle)."""
    extra: Column = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(extra.cast("bigint").alias("duplicates"))

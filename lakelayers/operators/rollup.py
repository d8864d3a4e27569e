"""Summaries over all dates from parts that are kept per date and replaced with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.functions.scalar import day_of
from lakelayers.schemas import PARTITION

GROUP = ("order_date", "status")
# Type of the mean of money, as the daily summary has it.
MEAN = "decimal(22,6)"
# Registers of a customer sketch as a power of two; the standard error of an estimate is about 1.04 / sqrt(2^14) = 0.8 %.
SKETCH_BITS = 14


def summary_parts(silver: DataFrame, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """Per partition date, order day and status: counts, sum, and a sketch of the customers.

    Unlike a mean or a distinct count these can be added up over dates, and a date's rows can be taken back by
    replacing its partition: write them with ``overwrite_layer``. All are partial aggregates before the shuffle.
    """
    return silver.groupBy(PARTITION, day_of("order_date").alias("order_date"), "status").agg(
        F.count("order_id").alias("orders"),
        F.try_sum("amount").alias("revenue"),
        F.count("amount").alias("amounts"),
        F.hll_sketch_agg("customer_id", F.lit(sketch_bits)).alias("customers"),
    )


def summary_over_dates(parts: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Orders, revenue, mean value and estimated distinct customers over all dates of ``parts``.

    The first three are exact and equal to a summary of the silver rows of these dates; customers who ordered on several
    dates are counted once, by the union of the sketches. It reads the parts, never the rows.
    """
    orders, amounts = F.sum("orders"), F.sum("amounts")
    revenue = F.try_sum("revenue").cast("decimal(28,2)")
    return parts.groupBy(*by).agg(
        orders.alias("total_orders"),
        revenue.alias("total_revenue"),
        F.try_divide(revenue, amounts).cast(MEAN).alias("avg_order_value"),
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("approx_customers"),
    )

"""Daily order summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.functions.scalar import day_of


def daily_order_summary(
    df: DataFrame, by: Sequence[str] = (), approx_customers: bool = False
) -> DataFrame:
    """Orders, revenue, mean value and distinct customers per order day and status.

    ``by`` adds leading group columns, e.g. the partition date when several dates are summarised in one job.
    There is one distinct aggregate, so Spark first reduces to (group, customer) on the map side and needs no
    row expansion; a hot customer or a hot day collapses before each of the two shuffles. The distinct count
    is exact unless ``approx_customers`` asks for the estimate. A sum that does not fit its decimal is NULL.
    """
    # The names of the four results.
    customers = F.approx_count_distinct if approx_customers else F.count_distinct
    return df.groupBy(*by, day_of("order_date").alias("order_date"), "status").agg(
        F.count("order_id").alias("total_orders"),
        F.try_sum("amount").alias("total_revenue"),
        F.try_avg("amount").alias("avg_order_value"),
        customers("customer_id").alias("unique_customers"),
    )

"""Every query against its SQL on tables where one key holds a third of the rows and times are tied."""

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as entry_points

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()
KEYED = [
    "silver_dedup", "duplicate_count", "silver_clean", "gold_daily_summary", "gold_partition", "quality_unique",
    "quality_orders_raw", "quality_orders_silver", "quality_customers", "quality_by_date", "quality_summary",
    "daily_run", "metric_series", "failure_counter", "sla_miss", "alert_sla", "attempts",
]


@pytest.fixture(scope="module")
def hot_dir(spark, sf_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("hot"))

    def table(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    third = F.col("o_orderkey") % 3 == 0
    table("orders").withColumns(
        {
            "o_orderkey": F.when(third, 20).otherwise(F.col("o_orderkey")).cast("bigint"),
            "o_custkey": F.when(third, 3).otherwise(F.col("o_custkey")).cast("bigint"),
        }
    ).write.parquet(f"{base}/orders.parquet")
    table("customer").withColumn(
        "c_custkey", F.when(F.col("c_custkey") % 3 == 0, 50).otherwise(F.col("c_custkey")).cast("bigint")
    ).write.parquet(f"{base}/customer.parquet")
    # Times cut to the hour, so that many samples and runs of a series are at the same instant.
    table("events").withColumns(
        {
            "event_type": F.when(F.col("event_id") % 3 == 0, "click").otherwise(F.col("event_type")),
            "ts": F.date_trunc("hour", "ts").cast("timestamp_ntz"),
        }
    ).write.parquet(f"{base}/events.parquet")
    return base


@pytest.mark.parametrize("name", KEYED)
def test_query_equals_sql_under_skew(spark, hot_dir, name):
    con = connect(hot_dir, "*.parquet/*.parquet")
    assert differences(spark, con, QUERIES[name], SQL[name], hot_dir) == []

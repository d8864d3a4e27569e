"""Order, customer, run and metric tables with realistic dirt, derived from the given tables.

Each view is one scan of one table; nothing is filtered out.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.operators.metrics import DURATION_PATH, FAILURE_PATH, NAMESPACE
from lakelayers.schemas import MONEY, PARTITION

AS_OF = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
DAY_1, DAY_2, DAY_3 = "2024-01-01", "2024-01-02", "2024-01-03"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _copies(again: Column) -> Column:
    """0 for every row, and 1 as well where a later copy of the row exists."""
    return F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as delivered: missing amounts and statuses, untidy statuses, later copies with other values.

    ``seq`` is the delivery an order row came with.
    """
    orders = table(spark, sf_dir, "orders")
    copied = orders.withColumn("seq", _copies(F.col("o_orderkey") % 10 == 0))
    key, price, state = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderstatus")
    late = F.col("seq") == 1
    return copied.select(
        key.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(late, price + 1).when(key % 17 == 0, None).otherwise(price).alias("amount"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
        F.when(late, "CANCELLED")
        .when(key % 23 == 0, None)
        .when(state == "F", " delivered ")
        .when(state == "O", "Pending")
        .otherwise("SHIPPED")
        .alias("status"),
        "seq",
    )


def orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders_raw`` with every column as it stands in a text file."""
    rows = orders_raw(spark, sf_dir)
    return rows.withColumn("amount", F.col("amount").cast(MONEY).cast("string"))


def orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows with the day they were delivered on; a day holds about a third of all rows."""
    day = F.concat(F.lit("2024-01-0"), (F.col("customer_id").cast("bigint") % 3 + 1).cast("string"))
    return orders_text(spark, sf_dir).drop("seq").withColumn("dt", day)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows as layer rows of two dates: first deliveries on day 1, later copies on day 2."""
    day = F.when(F.col("seq") == 0, DAY_1).otherwise(DAY_2)
    return orders_raw(spark, sf_dir).withColumn(PARTITION, day).drop("seq")


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with malformed and missing e-mail addresses and later copies."""
    copied = table(spark, sf_dir, "customer").withColumn("seq", _copies(F.col("c_custkey") % 50 == 0))
    key = F.col("c_custkey")
    address = F.concat(F.lower("c_mktsegment"), key.cast("string"), F.lit("@example.com"))
    return copied.select(
        key.cast("string").alias("customer_id"),
        F.when(F.col("seq") == 1, "x@y.z")
        .when(key % 13 == 0, "bad")
        .when(key % 29 == 0, None)
        .otherwise(address)
        .alias("email"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run history: one run per event."""
    events, key = table(spark, sf_dir, "events"), F.col("event_id")
    started = F.col("ts").cast("timestamp")
    return events.select(
        key.alias("run_id"),
        F.concat(F.lit("dag"), (F.col("user_id") % 3).cast("string")).alias("dag_id"),
        F.col("event_type").alias("task_id"),
        F.concat(F.lit("ds"), (F.col("user_id") % 4).cast("string")).alias("dataset"),
        F.when(key % 3 == 0, "bronze").when(key % 3 == 1, "silver").otherwise("gold").alias("layer"),
        F.timestamp_add("SECOND", (-(key % 50)).cast("int"), started).alias("scheduled_at"),
        started.alias("started_at"),
        F.timestamp_add("SECOND", F.floor("value").cast("int"), started).alias("finished_at"),
        F.when(key % 7 == 0, "failed").otherwise("success").alias("state"),
        (key * 10).alias("row_count"),
        F.concat(F.lit("/logs/"), key.cast("string")).alias("log_url"),
    )


def metric_samples(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """A duration gauge per event, and a failure increment as well for each error event; ``more`` event columns."""
    events = table(spark, sf_dir, "events")
    kinds = F.when(F.col("event_type") == "error", F.array(F.lit("g"), F.lit("c"))).otherwise(F.array(F.lit("g")))
    rows = events.withColumn("kind", F.explode(kinds))
    gauge = F.format_string(f"{NAMESPACE}.{DURATION_PATH}".replace("{task}", "%s"), "event_type")
    failure = f"{NAMESPACE}.{FAILURE_PATH}".replace("{dag}", "dag%d").replace("{task}", "%s")
    counter = F.format_string(failure, F.col("user_id") % 3, "event_type")
    is_counter = F.col("kind") == "c"
    return rows.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(is_counter, counter).otherwise(gauge).alias("metric"),
        F.when(is_counter, F.lit(1.0)).otherwise(F.col("value")).alias("value"),
        "kind",
        *more,
    )


def mixed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of all four metric families, and of names that fit none (a task id with a dot)."""
    key, kind = F.col("event_id"), F.col("event_type")
    event = table(spark, sf_dir, "events")
    metric = (
        F.when(key % 5 == 0, F.format_string("data_pipeline.silver.%s.row_count", kind))
        .when(key % 5 == 1, F.format_string("data_pipeline.quality.%s.pass_rate", kind))
        .when(key % 5 == 2, F.format_string("data_pipeline.task.%s.duration_seconds", kind))
        .when(key % 5 == 3, F.format_string("data_pipeline.failure.dag%d.%s", F.col("user_id") % 3, kind))
        .otherwise(F.format_string("data_pipeline.failure.dag.group.%s", kind))
    )
    return event.select(
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        metric.alias("metric"),
        "value",
        F.lit("g").alias("kind"),
    )

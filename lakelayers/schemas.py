"""Column lists and schemas of the tables this package writes."""

from __future__ import annotations

from pyspark.sql import types as T

# Names of the metadata and order columns, type of money.
PARTITION = "_partition_dt"
BRONZE_ONLY = ("_ingested_at", "_source_path", "_pipeline_run")
# Set in the rows of the reject table; null in the rows written beside them.
REJECT_COLUMNS = ("_row_text", "_reason", "_source_file")

ORDER_COLUMNS = ("order_id", "customer_id", "amount", "order_date", "status")
RAW_ORDERS = T.StructType([T.StructField(name, T.StringType()) for name in ORDER_COLUMNS])
RAW_CUSTOMERS = T.StructType([T.StructField(name, T.StringType()) for name in ("customer_id", "email")])

MONEY = T.DecimalType(18, 2)
CLEAN_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("order_date", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField(PARTITION, T.StringType()),
    ]
)

QUALITY_RULES = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("partition_date", T.StringType()),
        T.StructField("rule_no", T.IntegerType()),
        T.StructField("method", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("args", T.StringType()),
        T.StructField("element_count", T.LongType()),
        T.StructField("missing_count", T.LongType()),
        T.StructField("unexpected_count", T.LongType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("scored", T.BooleanType()),
    ]
)

QUALITY_EXAMPLES = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("partition_date", T.StringType()),
        T.StructField("rule_no", T.IntegerType()),
        T.StructField("method", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("failed", T.LongType()),
        T.StructField("slot", T.IntegerType()),
        T.StructField("row", T.StringType()),
    ]
)

QUALITY_SUMMARY = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("partition_date", T.StringType()),
        T.StructField("total_checks", T.IntegerType()),
        T.StructField("passed", T.IntegerType()),
        T.StructField("failed", T.IntegerType()),
        T.StructField("pass_rate", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("skipped", T.BooleanType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("dag_id", T.StringType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("partition_date", T.StringType()),
        T.StructField("scheduled_at", T.TimestampType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("state", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("log_url", T.StringType()),
    ]
)

METRIC_SAMPLES = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("kind", T.StringType()),
    ]
)

ALERTS = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("run_id", "dag_id", "task_id", "partition_date", "message")]
)

"""One query per operator or job, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.functions.scalar import parse_ts, standardise, to_money
from lakelayers.operators import metrics, quality, rollup
from lakelayers.operators.clean import (
    add_bronze_metadata,
    add_gold_metadata,
    add_silver_metadata,
    clean_orders,
    fill_nulls,
    to_text,
)
from lakelayers.operators.dedup import dedup, duplicate_count
from lakelayers.operators.quality import RULES, rule_results, score
from lakelayers.operators.runs import (
    attempt_episodes,
    attempts,
    expected_runs,
    failure_alerts,
    sla_absent,
    sla_alerts,
    sla_miss,
    sla_status,
)
from lakelayers.operators.summary import daily_order_summary
from lakelayers.plans import series
from lakelayers.plans.bronze import ingest_days, ingest_to_bronze, read_rejects
from lakelayers.plans.daily import run_pending
from lakelayers.plans.gold import build_daily_order_summary
from lakelayers.plans.keys import read_keys, register_keys, repeated_keys
from lakelayers.plans.lake import Lake
from lakelayers.plans.silver import compact, transform_orders_silver
from lakelayers.schemas import ORDER_COLUMNS, PARTITION, RAW_ORDERS
from lakelayers.sources.layers import (
    append_layer,
    for_partition,
    overwrite_layer,
    read_layer,
    read_mixed,
    write_counted,
)
from lakelayers.sources.raw import available_dates, pending_dates, read_raw
from lakelayers.sources.workspace import scratch_path
from lakelayers.suite import views
from lakelayers.suite.views import AS_OF, DAY_1, DAY_2, DAY_3

Query = Callable[[SparkSession, str], DataFrame]

# Allowances of the event-based run history, in seconds.
EVENT_SLA = {"click": 60, "purchase": 120, "signup": 30, "view": 90}
HIVE_LAYOUT = "{raw}/{dataset}/dt={dt}"
UNKNOWN_ALLOWED = {"status": ["UNKNOWN"]}
HOUR = 3600
STATUS_AS_OF = datetime(2024, 1, 20, 12, 0, 30, tzinfo=timezone.utc)


def write_csv(df: DataFrame, path: str, *by: str, mode: str = "error") -> None:
    """CSV with header; padding of values is kept."""
    writer = df.write.mode(mode).option("header", True).option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).partitionBy(*by).csv(path)


def without_zone(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as plain date-times, as the SQL side has them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(views.orders_raw(spark, sf_dir), ["order_id"], ["seq"])


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_orders(latest_orders(spark, sf_dir)).drop("seq")


# --- sources and sinks -------------------------------------------------------------------------------------


def raw_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "raw_csv")
    write_csv(views.orders_text(spark, sf_dir).select(*ORDER_COLUMNS), path)
    return read_raw(spark, path, "csv", RAW_ORDERS)


def raw_csv_text_scan(spark, sf_dir):
    path = scratch_path(spark, "raw_text")
    write_csv(views.orders_text(spark, sf_dir).select(*ORDER_COLUMNS), path)
    return read_raw(spark, path)


def raw_csv_inferred_scan(spark, sf_dir):
    path = scratch_path(spark, "raw_inferred")
    write_csv(views.orders_text(spark, sf_dir).select(*ORDER_COLUMNS), path)
    rows = read_raw(spark, path, infer=True)
    # Inference picks int or bigint by the largest value.
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("order_id", "customer_id")})


def raw_json_scan(spark, sf_dir):
    path = scratch_path(spark, "raw_json")
    views.orders_text(spark, sf_dir).select(*ORDER_COLUMNS).write.json(path)
    return read_raw(spark, path, "json", RAW_ORDERS)


def raw_parquet_scan(spark, sf_dir):
    path = scratch_path(spark, "raw_parquet")
    views.orders_raw(spark, sf_dir).write.parquet(path)
    return read_raw(spark, path, "parquet")


def pending(spark, sf_dir):
    """Months that have a raw folder and are not in the layer yet."""
    raw, layer = scratch_path(spark, "raw"), scratch_path(spark, "layer")
    month = F.date_format("o_orderdate", "yyyy-MM-01")
    months = views.table(spark, sf_dir, "orders").groupBy(month.alias("dt")).agg(F.count(F.lit(1)).alias("rows"))
    write_csv(months, f"{raw}/orders", "dt")
    months.filter(F.col("dt") < "1998-01-01").write.partitionBy("dt").parquet(layer)
    available = available_dates(spark, f"{raw}/orders/dt={{dt}}")
    processed = available_dates(spark, f"{layer}/dt={{dt}}")
    return pending_dates(available, processed)


def append_history(spark, sf_dir):
    """The second date is delivered twice; both deliveries stay."""
    path, rows = scratch_path(spark, "append"), views.deliveries(spark, sf_dir)
    append_layer(rows, path)
    append_layer(for_partition(rows, DAY_2), path)
    return read_layer(spark, path)


def _redelivered(spark, sf_dir, scope):
    path, rows = scratch_path(spark, f"overwrite_{scope}"), views.deliveries(spark, sf_dir)
    overwrite_layer(compact(rows, [DAY_1, DAY_2]), path, scope)
    again = for_partition(rows, DAY_2).withColumn("amount", F.col("amount") + 1)
    overwrite_layer(again, path, scope)
    return read_layer(spark, path)


def partition_overwrite(spark, sf_dir):
    return _redelivered(spark, sf_dir, "partition")


def table_overwrite(spark, sf_dir):
    return _redelivered(spark, sf_dir, "table")


def schema_merge(spark, sf_dir):
    """The summary of day 1 was written before the average existed."""
    path = scratch_path(spark, "merge")
    summary = daily_order_summary(silver_orders(spark, sf_dir))
    old = summary.drop("avg_order_value").withColumn(PARTITION, F.lit(DAY_1))
    overwrite_layer(old, path, schema_mode="merge")
    overwrite_layer(summary.withColumn(PARTITION, F.lit(DAY_2)), path, schema_mode="merge")
    return read_layer(spark, path, merge=True)


def row_counts(spark, sf_dir):
    """Rows per layer, each counted by the write itself."""
    base = scratch_path(spark, "counts")
    raw = views.orders_raw(spark, sf_dir).withColumn(PARTITION, F.lit(DAY_1))
    counted = {}
    counted["bronze"] = write_counted(raw, lambda df: overwrite_layer(df, f"{base}/bronze"))
    bronze = read_layer(spark, f"{base}/bronze")
    silver = clean_orders(dedup(bronze, ["order_id"], ["seq"])).drop("seq")
    counted["silver"] = write_counted(silver, lambda df: overwrite_layer(df, f"{base}/silver"))
    gold = daily_order_summary(read_layer(spark, f"{base}/silver"), by=[PARTITION])
    counted["gold"] = write_counted(gold, lambda df: overwrite_layer(df, f"{base}/gold"))
    return spark.createDataFrame(list(counted.items()), "layer string, row_count bigint")


# --- columns -----------------------------------------------------------------------------------------------


def bronze_metadata(spark, sf_dir):
    rows = views.orders_raw(spark, sf_dir).drop("seq")
    return without_zone(add_bronze_metadata(rows, "/raw/orders.csv", DAY_1, "airflow_1", AS_OF), "_ingested_at")


def silver_metadata(spark, sf_dir):
    rows = add_silver_metadata(views.deliveries(spark, sf_dir), DAY_3, AS_OF)
    return without_zone(rows, "_silver_at")


def gold_metadata(spark, sf_dir):
    rows = add_gold_metadata(daily_order_summary(silver_orders(spark, sf_dir)), DAY_3, AS_OF)
    return without_zone(rows, "_gold_at")


def id_text(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return to_text(orders, ("o_orderkey", "o_custkey"))


def cast_money(spark, sf_dir):
    """Amounts with a third decimal, of either sign, too large, empty or no number."""
    key = F.col("o_orderkey")
    exact = (F.col("o_totalprice").cast("decimal(18,2)") + F.lit("0.005").cast("decimal(4,3)")).cast("string")
    text = (
        F.when(key % 11 == 0, "x")
        .when(key % 13 == 0, "1e17")
        .when(key % 17 == 0, "")
        .when(key % 2 == 0, F.concat(F.lit("-"), exact))
        .otherwise(exact)
    )
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    return orders.withColumn("amount", to_money("text"))


def parse_order_date(spark, sf_dir):
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date").cast("string")
    text = (
        F.when(key % 11 == 0, "2024-13-01")
        .when(key % 13 == 0, F.concat(day, F.lit(" 10:00:00")))
        .when(key % 17 == 0, None)
        .otherwise(day)
    )
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    return without_zone(orders.withColumn("order_date", parse_ts("text")), "order_date")


def standardise_status(spark, sf_dir):
    raw = views.orders_raw(spark, sf_dir).select("order_id", "seq", "status")
    tabbed = F.concat(F.lit("\t"), "status", F.lit("  "))
    untidy = raw.withColumn("status", F.when(F.col("seq") == 1, tabbed).otherwise(F.col("status")))
    return untidy.withColumn("status", standardise("status"))


def fill_missing(spark, sf_dir):
    raw = views.orders_raw(spark, sf_dir).withColumn("amount", to_money("amount"))
    return fill_nulls(raw.select("order_id", "seq", "amount", "status"))


# --- duplicates and summary --------------------------------------------------------------------------------


def count_duplicates(spark, sf_dir):
    return duplicate_count(views.orders_raw(spark, sf_dir), ["order_id"])


def silver_clean(spark, sf_dir):
    return without_zone(silver_orders(spark, sf_dir), "order_date")


def gold_daily_summary(spark, sf_dir):
    return daily_order_summary(silver_orders(spark, sf_dir))


def gold_partition(spark, sf_dir):
    """Summary of one date of a written silver layer."""
    path = scratch_path(spark, "silver")
    rows = clean_orders(dedup(views.deliveries(spark, sf_dir), [PARTITION, "order_id"]))
    overwrite_layer(compact(rows, [DAY_1, DAY_2]), path)
    return daily_order_summary(for_partition(read_layer(spark, path), DAY_2), by=[PARTITION])


# --- quality -----------------------------------------------------------------------------------------------


def _single(rule: quality.Rule, view=views.orders_raw) -> Query:
    return lambda spark, sf_dir: rule_results(view(spark, sf_dir), [rule], "checked", DAY_1)


def quality_exists(spark, sf_dir):
    rules = [quality.exists("order_id"), quality.exists("email"), quality.row_count_between(1, 10**15)]
    return rule_results(views.orders_raw(spark, sf_dir), rules, "checked", DAY_1)


def quality_orders_raw(spark, sf_dir):
    return rule_results(views.orders_raw(spark, sf_dir), RULES["orders"], "orders", DAY_1)


def quality_orders_silver(spark, sf_dir):
    return rule_results(silver_orders(spark, sf_dir), RULES["orders"], "orders", DAY_1)


def quality_customers(spark, sf_dir):
    return rule_results(views.customers_raw(spark, sf_dir), RULES["customers"], "customers", DAY_1)


def quality_by_date(spark, sf_dir):
    """Each delivery date is checked as a table of its own, in one job; a third date had no rows."""
    rows = views.deliveries(spark, sf_dir)
    return rule_results(rows, RULES["orders"], "orders", by=PARTITION, expected=[DAY_1, DAY_2, DAY_3])


def _scores(spark, sf_dir, thresholds):
    raw = quality_orders_raw(spark, sf_dir).withColumn("dataset", F.lit("raw"))
    silver = quality_orders_silver(spark, sf_dir).withColumn("dataset", F.lit("silver"))
    results = raw.unionByName(silver)
    return reduce(DataFrame.unionByName, [score(results, limit) for limit in thresholds])


def quality_summary(spark, sf_dir):
    return _scores(spark, sf_dir, (0.95, 0.875, 0.75))


def quality_gate(spark, sf_dir):
    return quality.gate(_scores(spark, sf_dir, (0.95, 0.875)), on_fail="report")


def quality_skip(spark, sf_dir):
    """A dataset without rules is skipped, next to one that is checked."""
    events = views.table(spark, sf_dir, "events")
    skipped = quality.run_quality_check(events, "events", DAY_1)
    customers = views.customers_raw(spark, sf_dir)
    checked = quality.run_quality_check(customers, "customers", DAY_1, on_fail="report")
    return skipped.unionByName(checked.drop("message"))


def quality_rejects(spark, sf_dir):
    """Which rows fail the order rules: how many, and the lowest by digest in each of five slots per rule."""
    text = F.concat("order_id", F.lit("/"), F.col("seq").cast("string"))
    rank = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    rows = views.orders_raw(spark, sf_dir)
    return quality.failing_rows(rows, RULES["orders"], "orders", ("order_id", "seq"), DAY_1, rank=rank)


# --- summaries over dates and keys across dates --------------------------------------------------------------


def _silver_by_day(spark, sf_dir) -> DataFrame:
    rows = views.orders_by_day(spark, sf_dir).withColumnRenamed("dt", PARTITION)
    return clean_orders(dedup(rows, [PARTITION, "order_id"]))


def gold_rollup(spark, sf_dir):
    """Parts of three dates added up, after one date came again with fewer rows and other amounts."""
    path, silver = scratch_path(spark, "parts"), _silver_by_day(spark, sf_dir)
    overwrite_layer(compact(rollup.summary_parts(silver), [DAY_1, DAY_2]), path)
    again = silver.filter((F.col(PARTITION) == DAY_2) & (F.col("order_id").cast("bigint") % 2 == 0))
    again = again.withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))
    overwrite_layer(rollup.summary_parts(again), path)
    return rollup.summary_over_dates(read_layer(spark, path)).drop("approx_customers")


def customers_rollup(spark, sf_dir):
    """Customers per status over all dates, counted, and whether the sketches of the dates come within 3 percent of that."""
    path, silver = scratch_path(spark, "sketches"), _silver_by_day(spark, sf_dir)
    overwrite_layer(compact(rollup.summary_parts(silver), [DAY_1, DAY_2]), path)
    estimated = rollup.summary_over_dates(read_layer(spark, path), by=["status"])
    counted = silver.groupBy("status").agg(F.count_distinct("customer_id").alias("unique_customers"))
    off = F.abs(F.col("approx_customers") - F.col("unique_customers"))
    joined = counted.join(estimated, "status")
    return joined.select("status", "unique_customers", (off <= F.col("unique_customers") * 0.03).alias("close"))


def unique_across_dates(spark, sf_dir):
    """Orders of the second date whose keys an earlier date has."""
    path, rows = scratch_path(spark, "keys"), views.deliveries(spark, sf_dir)
    register_keys(for_partition(rows, DAY_1), path, "order_id")
    second = for_partition(rows, DAY_2)
    register_keys(second, path, "order_id")
    return repeated_keys(second, read_keys(spark, path), "order_id")


def series_incremental(spark, sf_dir):
    """Samples folded in by three batches that overlap by a day."""
    path = scratch_path(spark, "series")
    samples = views.metric_samples(spark, sf_dir, "event_id")
    for first, end in (("2024-01-01", "2024-01-11"), ("2024-01-10", "2024-01-21"), ("2024-01-20", "2024-03-01")):
        batch = samples.filter((F.col("ts") >= F.lit(first).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp")))
        state = series.fold(spark, path, batch, 2 * 24 * 3600, ("event_id", "kind"))
    return state.values()


# --- layer jobs --------------------------------------------------------------------------------------------


def _ingested(spark, sf_dir) -> str:
    """Bronze layer of the whole raw delivery as one date."""
    base = scratch_path(spark, "layers")
    write_csv(views.orders_text(spark, sf_dir).select(*ORDER_COLUMNS), f"{base}/raw/orders/{DAY_1}.csv")
    source, out = f"{base}/raw/orders/{DAY_1}.csv", f"{base}/bronze/orders"
    ingest_to_bronze(spark, source, "orders", DAY_1, out, run_id="airflow_1", as_of=AS_OF)
    return base


def bronze_ingest(spark, sf_dir):
    rows = read_layer(spark, f"{_ingested(spark, sf_dir)}/bronze/orders").drop("_source_path")
    return without_zone(rows, "_ingested_at")


def _transformed(spark, sf_dir) -> str:
    base = _ingested(spark, sf_dir)
    rules = quality.limit_rows(quality.allow(RULES["orders"], UNKNOWN_ALLOWED), 10**15)
    bronze, silver, staging = (f"{base}/{layer}/orders" for layer in ("bronze", "silver", "staging"))
    transform_orders_silver(spark, bronze, silver, DAY_1, staging, rules=rules, as_of=AS_OF)
    return base


def silver_transform(spark, sf_dir):
    rows = read_layer(spark, f"{_transformed(spark, sf_dir)}/silver/orders")
    return without_zone(rows, "order_date", "_silver_at")


def gold_build(spark, sf_dir):
    base = _transformed(spark, sf_dir)
    build_daily_order_summary(spark, f"{base}/silver/orders", f"{base}/gold", DAY_1, as_of=AS_OF)
    return without_zone(read_layer(spark, f"{base}/gold", merge=True), "_gold_at")


def daily_run(spark, sf_dir):
    """Three pending days from raw files to the summary, all days in one job per layer."""
    base = scratch_path(spark, "lake")
    lake = Lake(base, f"{base}/raw", layout=HIVE_LAYOUT, extra_allowed=UNKNOWN_ALLOWED, max_rows=10**15)
    rows = views.orders_by_day(spark, sf_dir)
    write_csv(rows.hint("rebalance", F.col("dt")), f"{lake.raw}/{lake.dataset}", "dt")
    run_pending(spark, lake, AS_OF)
    return without_zone(read_layer(spark, lake.gold, merge=True), "_gold_at")


def silver_transform_ordered(spark, sf_dir):
    """The row that was delivered last wins, whatever its amount is as text."""
    base = scratch_path(spark, "ordered")
    source, bronze, silver = f"{base}/raw/orders/{DAY_1}.csv", f"{base}/bronze/orders", f"{base}/silver/orders"
    write_csv(views.orders_text(spark, sf_dir).select(*ORDER_COLUMNS, "seq"), source)
    ingest_to_bronze(spark, source, "orders", DAY_1, bronze, run_id="airflow_1", as_of=AS_OF)
    rules = quality.limit_rows(quality.allow(RULES["orders"], UNKNOWN_ALLOWED), 10**15)
    transform_orders_silver(spark, bronze, silver, DAY_1, rules=rules, as_of=AS_OF, order_by=["seq"])
    return without_zone(read_layer(spark, silver), "order_date", "_silver_at")


def daily_run_mixed(spark, sf_dir):
    """Of three days one has other columns in another order, one has no amounts: it fails, the others do not."""
    base = scratch_path(spark, "mixed")
    lake = Lake(base, f"{base}/raw", layout=HIVE_LAYOUT, extra_allowed=UNKNOWN_ALLOWED, max_rows=10**15)
    rows = views.orders_by_day(spark, sf_dir)
    headers = {
        DAY_1: ORDER_COLUMNS,
        DAY_2: ("status", "order_date", F.lit("web").alias("channel"), "amount", "customer_id", "order_id"),
        DAY_3: [c for c in ORDER_COLUMNS if c != "amount"],
    }
    for dt, columns in headers.items():
        write_csv(rows.filter(F.col("dt") == dt).select(*columns), lake.raw_path(dt))
    _run_with_failures(spark, lake)
    return without_zone(read_layer(spark, lake.gold, merge=True), "_gold_at")


def _run_with_failures(spark, lake):
    """The failed dates are what the control tables are then asked about."""
    with suppress(quality.QualityGateError):
        run_pending(spark, lake, AS_OF)


def quality_skip_layer(spark, sf_dir):
    """A dataset without rules goes through the layers unchecked, and the summaries say so."""
    base = scratch_path(spark, "unchecked")
    lake = Lake(base, f"{base}/raw", "returns", layout=HIVE_LAYOUT)
    write_csv(views.orders_by_day(spark, sf_dir).hint("rebalance", F.col("dt")), f"{lake.raw}/{lake.dataset}", "dt")
    run_pending(spark, lake, AS_OF)
    summary = read_layer(spark, lake.control("quality_summary")).drop("run_id")
    return summary.withColumn("published", F.lit(read_layer(spark, lake.gold, merge=True).select(PARTITION).distinct().count()))


def _controlled(spark, sf_dir) -> Lake:
    """Three days, of which the last fails its gate at first and is delivered again."""
    base = scratch_path(spark, "control")
    lake = Lake(base, f"{base}/raw", layout=HIVE_LAYOUT, extra_allowed=UNKNOWN_ALLOWED, max_rows=10**15)
    rows = views.orders_by_day(spark, sf_dir)
    last = F.col("dt") == DAY_3
    spoilt = rows.withColumn("status", F.when(last, "LOST").otherwise(F.col("status")))
    write_csv(spoilt.hint("rebalance", F.col("dt")), f"{lake.raw}/{lake.dataset}", "dt")
    _run_with_failures(spark, lake)
    rows.filter(last).drop("dt").write.mode("overwrite").option("header", True).csv(lake.raw_path(DAY_3))
    run_pending(spark, lake, AS_OF)
    return lake


def control_series(spark, sf_dir):
    """State of the series that a run's samples make: the last day's rows, both gates' rates, failures."""
    samples = read_layer(spark, _controlled(spark, sf_dir).control("metric_samples"))
    lasting = samples.filter(~F.col("metric").endswith("duration_seconds"))
    return metrics.series_state(lasting, ("layer",), ("ts", "partition_date", "value"))


def control_attempts(spark, sf_dir):
    """Attempts per task and day; each day counts its own runs."""
    return attempts(read_layer(spark, _controlled(spark, sf_dir).control("runs")))


def control_alerts(spark, sf_dir):
    """Alerts of the runs: the failed task and the late ones. The run's id in the path of the log is left out."""
    alerts = read_layer(spark, _controlled(spark, sf_dir).control("alerts"))
    return alerts.select("dag_id", "task_id", "partition_date", F.regexp_replace("message", "\nLog: .*", "").alias("message"))


# --- deliveries --------------------------------------------------------------------------------------------


def append_once(spark, sf_dir):
    """Three days are delivered, ingested twice, and again after one more file came for the second day: each file is in once."""
    base = scratch_path(spark, "once")
    lake = Lake(base, f"{base}/raw", layout=HIVE_LAYOUT, bronze_mode="append")
    rows = views.orders_by_day(spark, sf_dir)
    write_csv(rows.hint("rebalance", F.col("dt")), f"{lake.raw}/{lake.dataset}", "dt")
    dates = [DAY_1, DAY_2, DAY_3]
    ingest_days(spark, lake, dates, "airflow_1", AS_OF)
    ingest_days(spark, lake, dates, "airflow_2", AS_OF)
    late = rows.filter((F.col("dt") == DAY_2) & (F.col("order_id").cast("bigint") % 20 == 0)).drop("dt")
    write_csv(late, lake.raw_path(DAY_2), mode="append")
    ingest_days(spark, lake, dates, "airflow_3", AS_OF)
    return read_layer(spark, lake.bronze).select(*ORDER_COLUMNS, PARTITION, "_pipeline_run")


def bronze_mixed_types(spark, sf_dir):
    """Types are inferred day by day: on the second day ids are text, dates have times and amounts are whole."""
    base = scratch_path(spark, "types")
    lake = Lake(base, f"{base}/raw", layout=HIVE_LAYOUT, infer=True)
    rows, second = views.orders_by_day(spark, sf_dir), F.col("dt") == DAY_2
    rows = rows.withColumns(
        {
            "order_id": F.when(second, F.concat(F.lit("A"), "order_id")).otherwise(F.col("order_id")),
            "amount": F.when(second, F.floor(F.col("amount").cast("double")).cast("string")).otherwise(F.col("amount")),
            "order_date": F.when(second, F.concat("order_date", F.lit(" 10:00:00"))).otherwise(F.col("order_date")),
        }
    )
    write_csv(rows.hint("rebalance", F.col("dt")), f"{lake.raw}/{lake.dataset}", "dt")
    ingest_days(spark, lake, [DAY_1], "airflow_1", AS_OF)
    ingest_days(spark, lake, [DAY_2, DAY_3], "airflow_2", AS_OF)
    found = read_mixed(spark, lake.bronze).select(*ORDER_COLUMNS, PARTITION)
    # Inference picks int or bigint by the largest value.
    return without_zone(found.withColumn("customer_id", F.col("customer_id").cast("bigint")), "order_date")


def raw_rejects(spark, sf_dir):
    """Lines with two further fields or without the last three; the other rows of their files go into the layer."""
    base = scratch_path(spark, "rejects")
    lake = Lake(base, f"{base}/raw", layout=HIVE_LAYOUT, rejects="divert")
    key = F.col("order_id").cast("bigint")
    rows = views.orders_by_day(spark, sf_dir)
    fields = [F.coalesce(F.col(c), F.lit("")) for c in ORDER_COLUMNS]
    line = (
        F.when(key % 29 == 0, F.concat_ws(",", *fields, F.lit("more"), F.lit("and more")))
        .when(key % 31 == 0, F.concat_ws(",", *fields[:2]))
        .otherwise(F.concat_ws(",", *fields))
    )
    lines = rows.select("dt", line.alias(",".join(ORDER_COLUMNS)))
    # With another separator the line is one value, and the header is the name of its column.
    writer = lines.hint("rebalance", F.col("dt")).write.option("header", True).option("sep", "\x01").partitionBy("dt")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{lake.raw}/{lake.dataset}")
    done = ingest_days(spark, lake, [DAY_1, DAY_2, DAY_3], "airflow_1", AS_OF)
    file_day = F.regexp_extract("_source_file", "/dt=([^/]*)/", 1).alias("file_day")
    rejects = read_rejects(spark, lake).select("_row_text", "_reason", file_day, PARTITION)
    return rejects.withColumn("kept", F.lit(done.written.rows).cast("long"))


# --- run analytics -----------------------------------------------------------------------------------------


def row_count_gauge(spark, sf_dir):
    return without_zone(metrics.row_count_gauge(views.runs(spark, sf_dir)), "ts")


def pass_rate_gauge(spark, sf_dir):
    summary = _scores(spark, sf_dir, (0.95,))
    return without_zone(metrics.pass_rate_gauge(summary, F.lit(AS_OF)), "ts")


def task_duration(spark, sf_dir):
    return without_zone(metrics.task_duration(views.runs(spark, sf_dir)), "ts")


def failure_samples(spark, sf_dir):
    return without_zone(metrics.failure_samples(views.runs(spark, sf_dir)), "ts")


def failure_counter(spark, sf_dir):
    return metrics.failure_counter(views.runs(spark, sf_dir))


def metric_encode(spark, sf_dir):
    return metrics.encode_metric(views.metric_samples(spark, sf_dir)).select("line")


def metric_decode(spark, sf_dir):
    return metrics.decode_metric(metric_encode(spark, sf_dir))


def metric_mapping(spark, sf_dir):
    mapped = metrics.map_metrics(views.mixed_metrics(spark, sf_dir))
    names = ("layer", "dataset", "task", "dag_id", "task_id")
    labels = [F.col("labels")[name].alias(f"label_{name}") for name in names]
    return mapped.select("event_id", "metric", "value", "name", F.size("labels").alias("n_labels"), *labels)


def metric_series(spark, sf_dir):
    return metrics.series_state(metrics.decode_metric(metric_lines(spark, sf_dir)))


def metric_lines(spark, sf_dir):
    """Encoded samples with their times."""
    return metrics.encode_metric(views.metric_samples(spark, sf_dir)).select("ts", "line")


def sla_misses(spark, sf_dir):
    missed = sla_miss(views.runs(spark, sf_dir), EVENT_SLA)
    columns = ("run_id", "dag_id", "task_id", "scheduled_at", "finished_at", "sla_seconds", "late_seconds")
    return without_zone(missed.select(*columns), "scheduled_at", "finished_at")


def alert_failures(spark, sf_dir):
    return failure_alerts(views.runs(spark, sf_dir))


def alert_sla(spark, sf_dir):
    return sla_alerts(sla_miss(views.runs(spark, sf_dir), EVENT_SLA))


def task_attempts(spark, sf_dir):
    """Attempts per DAG, task and day."""
    history = views.runs(spark, sf_dir).withColumn("day", F.to_date("started_at"))
    return attempts(history, ("dag_id", "task_id", "day"), time_limit=120)


def _hourly(spark, sf_dir):
    """Every task of every DAG is due once an hour."""
    history = views.runs(spark, sf_dir)
    spans = history.groupBy("dag_id").agg(F.min("scheduled_at").alias("first"), F.max("scheduled_at").alias("last"))
    return expected_runs(spans, EVENT_SLA, HOUR), history


def task_status(spark, sf_dir):
    """In time, late, failed, running, absent or not due yet, as of a time within the history."""
    found = sla_status(*_hourly(spark, sf_dir), STATUS_AS_OF, HOUR)
    return without_zone(found, "scheduled_at", "due_at", "finished_at")


def absent_tasks(spark, sf_dir):
    found = sla_absent(*_hourly(spark, sf_dir), STATUS_AS_OF, HOUR)
    return without_zone(found.select("dag_id", "task_id", "scheduled_at", "due_at"), "scheduled_at", "due_at")


def episodes(spark, sf_dir):
    """Attempts of a task that follow each other within half an hour."""
    return without_zone(attempt_episodes(views.runs(spark, sf_dir), gap=HOUR // 2), "first_start", "last_end")


QUERIES: dict[str, Query] = {
    "raw_csv_scan": raw_csv_scan,
    "raw_csv_text_scan": raw_csv_text_scan,
    "raw_csv_inferred_scan": raw_csv_inferred_scan,
    "raw_json_scan": raw_json_scan,
    "raw_parquet_scan": raw_parquet_scan,
    "pending_dates": pending,
    "append_history": append_history,
    "partition_overwrite": partition_overwrite,
    "table_overwrite": table_overwrite,
    "schema_merge": schema_merge,
    "row_counts": row_counts,
    "bronze_metadata": bronze_metadata,
    "silver_metadata": silver_metadata,
    "gold_metadata": gold_metadata,
    "id_text": id_text,
    "cast_money": cast_money,
    "parse_order_date": parse_order_date,
    "standardise_status": standardise_status,
    "fill_nulls": fill_missing,
    "silver_dedup": latest_orders,
    "duplicate_count": count_duplicates,
    "silver_clean": silver_clean,
    "gold_daily_summary": gold_daily_summary,
    "gold_partition": gold_partition,
    "quality_exists": quality_exists,
    "quality_not_null": _single(quality.not_null("status")),
    "quality_unique": _single(quality.unique("order_id")),
    "quality_between": _single(quality.between("amount", 50_000, 400_000)),
    "quality_in_set": _single(quality.in_set("status", quality.STATUSES)),
    "quality_row_count": _single(quality.row_count_between(1, quality.MAX_ROWS)),
    "quality_regex": _single(quality.matches("email", quality.EMAIL), views.customers_raw),
    "quality_orders_raw": quality_orders_raw,
    "quality_orders_silver": quality_orders_silver,
    "quality_customers": quality_customers,
    "quality_by_date": quality_by_date,
    "quality_summary": quality_summary,
    "quality_gate": quality_gate,
    "quality_skip": quality_skip,
    "bronze_ingest": bronze_ingest,
    "silver_transform": silver_transform,
    "gold_build": gold_build,
    "silver_transform_ordered": silver_transform_ordered,
    "daily_run": daily_run,
    "daily_run_mixed": daily_run_mixed,
    "quality_skip_layer": quality_skip_layer,
    "control_series": control_series,
    "control_attempts": control_attempts,
    "control_alerts": control_alerts,
    "append_once": append_once,
    "bronze_mixed_types": bronze_mixed_types,
    "raw_rejects": raw_rejects,
    "row_count_gauge": row_count_gauge,
    "pass_rate_gauge": pass_rate_gauge,
    "task_duration": task_duration,
    "failure_samples": failure_samples,
    "failure_counter": failure_counter,
    "metric_encode": metric_encode,
    "metric_decode": metric_decode,
    "metric_mapping": metric_mapping,
    "metric_series": metric_series,
    "sla_miss": sla_misses,
    "alert_failures": alert_failures,
    "alert_sla": alert_sla,
    "attempts": task_attempts,
    "quality_rejects": quality_rejects,
    "gold_rollup": gold_rollup,
    "customers_rollup": customers_rollup,
    "unique_across_dates": unique_across_dates,
    "series_incremental": series_incremental,
    "sla_status": task_status,
    "sla_absent": absent_tasks,
    "attempt_episodes": episodes,
}

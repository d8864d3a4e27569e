"""What the physical plans of the operators must look like at scale."""

import pytest

from lakelayers.operators import quality as q
from lakelayers.operators.dedup import dedup
from lakelayers.plans.silver import compact
from lakelayers.schemas import PARTITION
from lakelayers.sources.layers import for_partition, overwrite_layer, read_layer
from lakelayers.suite import views
from lakelayers.suite.queries import QUERIES as SUITE

QUERIES = SUITE
WRITING = {
    "raw_csv_scan", "raw_csv_text_scan", "raw_csv_inferred_scan", "raw_json_scan", "raw_parquet_scan", "pending_dates",
    "append_history", "partition_overwrite", "table_overwrite", "schema_merge", "row_counts", "gold_partition",
    "bronze_ingest", "silver_transform", "gold_build", "daily_run", "silver_transform_ordered", "daily_run_mixed",
    "quality_skip_layer", "control_series", "control_attempts", "control_alerts", "append_once", "bronze_mixed_types",
    "raw_rejects", "gold_rollup", "customers_rollup", "unique_across_dates", "series_incremental",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_no_cross_join_no_broadcast(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    # Joins are left to Spark, which sends a side along only if it finds it small.
    joining = {"sla_status", "sla_absent", "attempt_episodes"}
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop", *(["BroadcastExchange"] if name not in joining else [])):
        assert word not in text


def test_dedup_reduces_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["silver_dedup"](spark, sf_dir))
    before_shuffle = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1


def test_all_order_rules_in_one_scan(spark, sf_dir):
    text = plan(QUERIES["quality_orders_raw"](spark, sf_dir))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    before_shuffle = text[text.index("Exchange hashpartitioning") :]
    assert "partial_count" in before_shuffle


def test_checked_silver_rows_are_shuffled_once(spark, sf_dir):
    """The check's grouping by order uses the partitioning that the deduplication left."""
    text = plan(QUERIES["quality_orders_silver"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1


def test_rules_without_a_key_need_no_shuffle_of_rows(spark, sf_dir):
    rows = views.orders_raw(spark, sf_dir)
    text = plan(q.rule_results(rows, [q.not_null("status"), q.row_count_between(1, 9)], "d", "2024-01-01"))
    assert "hashpartitioning" not in text
    assert "o_totalprice" not in text


def test_summary_groups_by_customer_before_the_first_shuffle(spark, sf_dir):
    text = plan(QUERIES["gold_daily_summary"](spark, sf_dir))
    assert "Expand" not in text
    first_read = text[text.index("customer_id#") :]
    assert "partial_count" in first_read


def test_one_date_is_pruned_and_counts_read_no_column(spark, sf_dir, tmp_path):
    path = str(tmp_path / "layer")
    overwrite_layer(views.deliveries(spark, sf_dir), path)
    one = for_partition(read_layer(spark, path), views.DAY_2)
    text = plan(one.select("order_id"))
    assert "PartitionFilters: [isnotnull(_partition_dt" in text and "ReadSchema: struct<order_id:string>" in text
    assert "ReadSchema: struct<>" in plan(one.groupBy(PARTITION).count())


def test_large_date_is_split_when_several_dates_are_written(spark, sf_dir):
    rows = dedup(views.deliveries(spark, sf_dir), [PARTITION, "order_id"])
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(compact(rows, [views.DAY_1, views.DAY_2]))
    assert "REBALANCE" not in plan(compact(rows, [views.DAY_1]))


def test_mapping_uses_no_regular_expression(spark, sf_dir):
    text = plan(QUERIES["metric_mapping"](spark, sf_dir))
    assert "RLIKE" not in text and "regexp" not in text and "Exchange" not in text


def test_sla_needs_no_join(spark, sf_dir):
    text = plan(QUERIES["sla_miss"](spark, sf_dir))
    assert "Join" not in text and "Exchange" not in text


def test_hot_key_keeps_its_latest_row(spark, tmp_path):
    """A third of the rows share one key."""
    path = str(tmp_path / "t")
    rows = spark.range(0, 30000, 1, 4).selectExpr("if(id % 3 = 0, -1, id) AS k", "id AS v")
    rows.write.parquet(path)
    latest = dedup(spark.read.parquet(path), ["k"], ["v"])
    assert latest.count() == 20001
    assert latest.filter("k = -1").collect()[0].v == 29997


def test_metric_is_split_once(spark, sf_dir):
    text = plan(QUERIES["metric_mapping"](spark, sf_dir))
    assert text.count("split(") == 1

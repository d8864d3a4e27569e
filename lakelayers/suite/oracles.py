"""The same results in plain SQL, written against the given tables."""

from __future__ import annotations

ORDERS_RAW = """
orders_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS amount,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
         CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN ' delivered '
              WHEN o_orderstatus = 'O' THEN 'Pending' ELSE 'SHIPPED' END AS status,
         0 AS seq
  FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_totalprice + 1,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 'CANCELLED', 1
  FROM orders WHERE o_orderkey % 10 = 0)"""

ORDERS_TEXT = ORDERS_RAW + """,
orders_text AS (
  SELECT order_id, customer_id, CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS amount, order_date, status
  FROM orders_raw)"""

LATEST = ORDERS_RAW + """,
latest AS (
  SELECT order_id, customer_id, amount, order_date, status, seq
  FROM (SELECT *, row_number() OVER (
          PARTITION BY order_id
          ORDER BY seq DESC NULLS LAST, amount DESC NULLS LAST, customer_id DESC NULLS LAST,
                   order_date DESC NULLS LAST, status DESC NULLS LAST) AS rn
        FROM orders_raw)
  WHERE rn = 1)"""

CLEAN_COLUMNS = """order_id, customer_id,
         coalesce(try_cast(amount AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2))) AS amount,
         try_strptime(order_date, '%Y-%m-%d') AS order_date,
         coalesce(upper(trim(status)), 'UNKNOWN') AS status"""

SILVER = LATEST + f""",
silver AS (SELECT {CLEAN_COLUMNS} FROM latest)"""

# Exact mean to six places, half up, in whole numbers: units of 1e-6 split into whole part and rest.
MEAN_UNITS = "((2 * CAST(sum(amount) * 100 AS HUGEINT) * 10000 + count(amount)) // (2 * count(amount)))"

SUMMARY_COLUMNS = f"""CAST(order_date AS DATE) AS order_date, status, count(order_id) AS total_orders,
       CAST(sum(amount) AS DECIMAL(28,2)) AS total_revenue,
       CAST(CAST({MEAN_UNITS} // 1000000 AS DECIMAL(22,6))
            + CAST({MEAN_UNITS} % 1000000 AS DECIMAL(6,0)) * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(22,6))
         AS avg_order_value,
       count(DISTINCT customer_id) AS unique_customers"""

GOLD = SILVER + f""",
gold AS (SELECT {SUMMARY_COLUMNS} FROM silver GROUP BY CAST(order_date AS DATE), status)"""

DELIVERIES = ORDERS_RAW + """,
deliveries AS (
  SELECT order_id, customer_id, amount, order_date, status,
         CASE WHEN seq = 0 THEN '2024-01-01' ELSE '2024-01-02' END AS _partition_dt
  FROM orders_raw)"""

CUSTOMERS_RAW = """
customers_raw AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         CASE WHEN c_custkey % 13 = 0 THEN 'bad' WHEN c_custkey % 29 = 0 THEN NULL
              ELSE lower(c_mktsegment) || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email
  FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), 'x@y.z' FROM customer WHERE c_custkey % 50 = 0)"""

RUNS = """
runs AS (
  SELECT event_id AS run_id, 'dag' || CAST(user_id % 3 AS VARCHAR) AS dag_id, event_type AS task_id,
         'ds' || CAST(user_id % 4 AS VARCHAR) AS dataset,
         CASE event_id % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END AS layer,
         ts - to_seconds(event_id % 50) AS scheduled_at, ts AS started_at,
         ts + to_seconds(CAST(floor(value) AS BIGINT)) AS finished_at,
         CASE WHEN event_id % 7 = 0 THEN 'failed' ELSE 'success' END AS state,
         event_id * 10 AS row_count, '/logs/' || CAST(event_id AS VARCHAR) AS log_url
  FROM events)"""

METRIC_SAMPLES = """
samples AS (
  SELECT ts, 'data_pipeline.task.' || event_type || '.duration_seconds' AS metric, value, 'g' AS kind FROM events
  UNION ALL
  SELECT ts, 'data_pipeline.failure.dag' || CAST(user_id % 3 AS VARCHAR) || '.' || event_type, 1.0, 'c'
  FROM events WHERE event_type = 'error')"""

# Statuses allowed by the order rules, e-mail pattern.
STATUS_LIST = "'PENDING','CONFIRMED','SHIPPED','DELIVERED','CANCELLED'"
EMAIL = r"[^@]+@[^@]+\.[^@]+"
STATUS_ARGS = '{"value_set": ["PENDING", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED"]}'
EMAIL_ARGS = '{"regex": "[^@]+@[^@]+\\\\.[^@]+"}'


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _rule(number, method, column, args, elements, missing, unexpected, success, relation, dataset, date) -> str:
    def count(value):
        return f"CAST({value} AS BIGINT)" if value != "NULL" else "CAST(NULL AS BIGINT)"

    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return f"""
SELECT '{dataset}' AS dataset, {date} AS partition_date, {number} AS rule_no, '{method}' AS method, {name} AS "column",
       '{args}' AS args, {count(elements)} AS element_count, {count(missing)} AS missing_count,
       {count(unexpected)} AS unexpected_count, {success} AS success, true AS scored
FROM {relation}"""


def _nulls(column: str) -> str:
    return f"count(*) FILTER ({column} IS NULL)"


def _not_null(no, column, relation, dataset, date):
    bad = _nulls(column)
    return _rule(no, "expect_column_values_to_not_be_null", column, "{}", "count(*)", bad, bad, f"{bad} = 0", relation, dataset, date)


def _row_rule(no, method, column, args, bad_condition, relation, dataset, date):
    bad = f"count(*) FILTER ({bad_condition})"
    return _rule(no, method, column, args, "count(*)", _nulls(column), bad, f"{bad} = 0", relation, dataset, date)


def _unique(no, column, relation, dataset, date):
    grouped = f"(SELECT {column} AS k, count(*) AS n FROM {relation} GROUP BY {column})"
    bad = "coalesce(sum(n) FILTER (k IS NOT NULL AND n > 1), 0)"
    return _rule(
        no, "expect_column_values_to_be_unique", column, "{}", "coalesce(sum(n), 0)",
        "coalesce(sum(n) FILTER (k IS NULL), 0)", bad, f"{bad} = 0", grouped, dataset, date,
    )


def _order_rules(relation: str, date: str = "'2024-01-01'", dataset: str = "orders") -> str:
    common = (relation, dataset, date)
    none = "NULL"
    in_range = "amount IS NOT NULL AND NOT (amount BETWEEN 0 AND 10000000)"
    in_set = f"status IS NOT NULL AND status NOT IN ({STATUS_LIST})"
    rows = "count(*) BETWEEN 1 AND 10000000"
    return "\nUNION ALL".join(
        [
            _rule(1, "expect_column_to_exist", "order_id", "{}", none, none, none, "count(*) >= 0", *common),
            _not_null(2, "order_id", *common),
            _unique(3, "order_id", *common),
            _not_null(4, "customer_id", *common),
            _row_rule(5, "expect_column_values_to_be_between", "amount", '{"max_value": 10000000, "min_value": 0}', in_range, *common),
            _not_null(6, "order_date", *common),
            _row_rule(7, "expect_column_values_to_be_in_set", "status", STATUS_ARGS, in_set, *common),
            _rule(8, "expect_table_row_count_to_be_between", None, '{"max_value": 10000000, "min_value": 1}',
                  "count(*)", none, none, rows, *common),
        ]
    )


def _customer_rules() -> str:
    common = ("customers_raw", "customers", "'2024-01-01'")
    return "\nUNION ALL".join(
        [
            _rule(1, "expect_column_to_exist", "customer_id", "{}", "NULL", "NULL", "NULL", "count(*) >= 0", *common),
            _not_null(2, "customer_id", *common),
            _unique(3, "customer_id", *common),
            _row_rule(4, "expect_column_values_to_match_regex", "email", EMAIL_ARGS,
                      f"NOT regexp_matches(email, '{EMAIL}')", *common),
        ]
    )


CHECKED = "'2024-01-01'"


def _score_ctes() -> str:
    return (
        SILVER.strip()
        + f""",
raw_rules AS ({_order_rules('orders_raw')}),
silver_rules AS ({_order_rules('silver')}),
rates AS (
  SELECT 'raw' AS dataset, CAST(count(*) AS INTEGER) AS total_checks, CAST(count(*) FILTER (success) AS INTEGER) AS passed
  FROM raw_rules
  UNION ALL
  SELECT 'silver', CAST(count(*) AS INTEGER), CAST(count(*) FILTER (success) AS INTEGER) FROM silver_rules)"""
    )


def _summary_select(thresholds: str, extra: str = "") -> str:
    return f"""
SELECT dataset, '2024-01-01' AS partition_date, total_checks, passed, total_checks - passed AS failed,
       round(passed / total_checks::DOUBLE, 4) AS pass_rate, threshold,
       passed / total_checks::DOUBLE >= threshold AS success, false AS skipped{extra}
FROM rates, (SELECT CAST(unnest([{thresholds}]) AS DOUBLE) AS threshold)"""


GATE_TEXT = """,
       CASE WHEN passed / total_checks::DOUBLE < threshold THEN
         printf('[QUALITY] FAILED for ''%s'' on 2024-01-01. Pass rate: %.1f%% < threshold %.1f%%',
                dataset, passed * 100 / total_checks::DOUBLE, threshold * 100) END AS message"""

# Text rows of the three delivery days, the newest row of each order and day, cleaned.
DAYS = ORDERS_TEXT + f""",
by_day AS (SELECT *, '2024-01-0' || CAST(CAST(customer_id AS BIGINT) % 3 + 1 AS VARCHAR) AS dt FROM orders_text),
kept AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY dt, order_id
      ORDER BY amount DESC NULLS LAST, customer_id DESC NULLS LAST, order_date DESC NULLS LAST,
               status DESC NULLS LAST) AS rn
    FROM by_day) WHERE rn = 1),
silver AS (SELECT {CLEAN_COLUMNS}, dt AS _partition_dt FROM kept)"""

ONE_DAY = ORDERS_TEXT + f""",
kept AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_id
      ORDER BY amount DESC NULLS LAST, customer_id DESC NULLS LAST, order_date DESC NULLS LAST,
               status DESC NULLS LAST) AS rn
    FROM orders_text) WHERE rn = 1),
silver AS (SELECT {CLEAN_COLUMNS}, '2024-01-01' AS _partition_dt FROM kept)"""

LAST_DAY = "dt = '2024-01-03'"

ORDERED = """
orders_text AS (
  SELECT order_id, customer_id, CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS amount, order_date, status,
         CAST(seq AS VARCHAR) AS seq
  FROM orders_raw),
kept AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) AS rn FROM orders_text) WHERE rn = 1)"""
ORDERED = f"{ORDERS_RAW},{ORDERED}"

AS_OF = "TIMESTAMP '2024-01-02 03:04:05'"
LATE = "epoch_us(finished_at) / 1e6 - epoch_us(scheduled_at) / 1e6 - sla_seconds"
MISSES = RUNS + """,
missed AS (
  SELECT * FROM (
    SELECT *, CASE task_id WHEN 'click' THEN 60 WHEN 'purchase' THEN 120 WHEN 'signup' THEN 30 WHEN 'view' THEN 90 END
                AS sla_seconds,
           (epoch_us(finished_at) - epoch_us(scheduled_at)) / 1e6 AS taken
    FROM runs)
  WHERE taken > sla_seconds)"""

MONEY_TEXT = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 11 = 0 THEN 'x' WHEN o_orderkey % 13 = 0 THEN '1e17' WHEN o_orderkey % 17 = 0 THEN ''
            WHEN o_orderkey % 2 = 0 THEN '-' || exact ELSE exact END AS text
FROM (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CAST('0.005' AS DECIMAL(4,3)) AS VARCHAR) AS exact
      FROM orders)"""

DATE_TEXT = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 11 = 0 THEN '2024-13-01'
            WHEN o_orderkey % 13 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 10:00:00'
            WHEN o_orderkey % 17 = 0 THEN NULL
            ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS text
FROM orders"""

LINES = METRIC_SAMPLES + """,
lines AS (
  SELECT ts, metric, value, kind,
         metric || ':' || CASE WHEN kind = 'c' THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE CAST(value AS VARCHAR) END
           || '|' || kind AS line
  FROM samples)"""

MIXED = """
mixed AS (
  SELECT event_id, value,
         CASE event_id % 5
           WHEN 0 THEN 'data_pipeline.silver.' || event_type || '.row_count'
           WHEN 1 THEN 'data_pipeline.quality.' || event_type || '.pass_rate'
           WHEN 2 THEN 'data_pipeline.task.' || event_type || '.duration_seconds'
           WHEN 3 THEN 'data_pipeline.failure.dag' || CAST(user_id % 3 AS VARCHAR) || '.' || event_type
           ELSE 'data_pipeline.failure.dag.group.' || event_type END AS metric
  FROM events)"""


def _matched(pattern: str, group: int) -> str:
    return f"CASE WHEN regexp_matches(metric, '{pattern}') THEN regexp_extract(metric, '{pattern}', {group}) END"


ROWS = r"^data_pipeline\.([^.]*)\.([^.]*)\.row_count$"
RATE = r"^data_pipeline\.quality\.([^.]*)\.pass_rate$"
SECONDS = r"^data_pipeline\.task\.([^.]*)\.duration_seconds$"
FAILED = r"^data_pipeline\.failure\.([^.]*)\.([^.]*)$"

SLOTS = RUNS + """,
sla(task_id, sla_seconds) AS (VALUES ('click', 60), ('purchase', 120), ('signup', 30), ('view', 90)),
spans AS (SELECT dag_id, min(scheduled_at) AS lo, max(scheduled_at) AS hi FROM runs GROUP BY dag_id),
slots AS (
  SELECT dag_id, unnest(generate_series(
           date_trunc('hour', lo) + CASE WHEN lo = date_trunc('hour', lo) THEN INTERVAL 0 HOUR ELSE INTERVAL 1 HOUR END,
           hi, INTERVAL 1 HOUR)) AS scheduled_at
  FROM spans),
known AS (
  SELECT dag_id, task_id, date_trunc('hour', scheduled_at) AS scheduled_at, count(*) AS attempts,
         min(finished_at) FILTER (state = 'success' AND finished_at <= TIMESTAMP '2024-01-20 12:00:30') AS finished_at,
         count(*) FILTER (finished_at > TIMESTAMP '2024-01-20 12:00:30') AS still
  FROM runs WHERE started_at <= TIMESTAMP '2024-01-20 12:00:30' GROUP BY 1, 2, 3),
due AS (
  SELECT dag_id, task_id, scheduled_at, scheduled_at + to_seconds(sla_seconds) AS due_at FROM slots, sla),
status AS (
  SELECT d.dag_id, d.task_id, d.scheduled_at, d.due_at, coalesce(k.attempts, 0) AS attempts, k.finished_at,
         CASE WHEN k.finished_at <= d.due_at THEN 'in_time' WHEN k.finished_at IS NOT NULL THEN 'late'
              WHEN d.due_at > TIMESTAMP '2024-01-20 12:00:30' THEN 'pending'
              WHEN k.attempts IS NULL THEN 'absent' WHEN k.still > 0 THEN 'running' ELSE 'failed' END AS status
  FROM due d LEFT JOIN known k ON d.dag_id = k.dag_id AND d.task_id = k.task_id AND d.scheduled_at = k.scheduled_at)"""

RANKED = ORDERS_RAW + f""",
failed AS (
  SELECT *, CAST('0x' || substr(md5(order_id || '/' || seq), 1, 15) AS BIGINT) AS rank, unnest([
      CASE WHEN count(*) OVER (PARTITION BY order_id) > 1 THEN 3 END,
      CASE WHEN NOT (amount BETWEEN 0 AND 10000000) THEN 5 END,
      CASE WHEN status NOT IN ({STATUS_LIST}) THEN 7 END]) AS rule_no
  FROM orders_raw)"""

ORACLES: dict[str, str] = {
    "raw_csv_scan": _with(ORDERS_TEXT, "SELECT * FROM orders_text"),
    "raw_csv_text_scan": _with(ORDERS_TEXT, "SELECT * FROM orders_text"),
    "raw_csv_inferred_scan": _with(
        ORDERS_TEXT,
        """SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id,
                  CAST(amount AS DOUBLE) AS amount, CAST(order_date AS DATE) AS order_date, status FROM orders_text""",
    ),
    "raw_json_scan": _with(ORDERS_TEXT, "SELECT * FROM orders_text"),
    "raw_parquet_scan": _with(ORDERS_RAW, "SELECT * FROM orders_raw"),
    "pending_dates": """
SELECT DISTINCT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS dt
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
    "append_history": _with(
        DELIVERIES, "SELECT * FROM deliveries UNION ALL SELECT * FROM deliveries WHERE _partition_dt = '2024-01-02'"
    ),
    "partition_overwrite": _with(
        DELIVERIES,
        """SELECT order_id, customer_id, CASE WHEN _partition_dt = '2024-01-02' THEN amount + 1 ELSE amount END AS amount,
                  order_date, status, _partition_dt FROM deliveries""",
    ),
    "table_overwrite": _with(
        DELIVERIES,
        """SELECT order_id, customer_id, amount + 1 AS amount, order_date, status, _partition_dt
           FROM deliveries WHERE _partition_dt = '2024-01-02'""",
    ),
    "schema_merge": _with(
        GOLD,
        """SELECT * REPLACE (CAST(NULL AS DECIMAL(22,6)) AS avg_order_value), '2024-01-01' AS _partition_dt FROM gold
           UNION ALL SELECT *, '2024-01-02' FROM gold""",
    ),
    "row_counts": _with(
        GOLD,
        """SELECT 'bronze' AS layer, count(*) AS row_count FROM orders_raw
           UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'gold', count(*) FROM gold""",
    ),
    "bronze_metadata": _with(
        ORDERS_RAW,
        f"""SELECT order_id, customer_id, amount, order_date, status, {AS_OF} AS _ingested_at,
                   '/raw/orders.csv' AS _source_path, '2024-01-01' AS _partition_dt, 'airflow_1' AS _pipeline_run
            FROM orders_raw""",
    ),
    "silver_metadata": _with(
        DELIVERIES, f"SELECT * REPLACE ('2024-01-03' AS _partition_dt), {AS_OF} AS _silver_at FROM deliveries"
    ),
    "gold_metadata": _with(GOLD, f"SELECT *, {AS_OF} AS _gold_at, '2024-01-03' AS _partition_dt FROM gold"),
    "id_text": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders""",
    "cast_money": f"SELECT o_orderkey, text, try_cast(text AS DECIMAL(18,2)) AS amount FROM ({MONEY_TEXT})",
    "parse_order_date": f"SELECT o_orderkey, text, try_strptime(text, '%Y-%m-%d') AS order_date FROM ({DATE_TEXT})",
    "standardise_status": _with(
        ORDERS_RAW,
        """SELECT order_id, seq, upper(trim(CASE WHEN seq = 1 THEN chr(9) || status || '  ' ELSE status END)) AS status
           FROM orders_raw""",
    ),
    "fill_nulls": _with(
        ORDERS_RAW,
        """SELECT order_id, seq, coalesce(try_cast(amount AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2))) AS amount,
                  coalesce(status, 'UNKNOWN') AS status FROM orders_raw""",
    ),
    "silver_dedup": _with(LATEST, "SELECT * FROM latest"),
    "duplicate_count": _with(ORDERS_RAW, "SELECT count(*) - count(DISTINCT order_id) AS duplicates FROM orders_raw"),
    "silver_clean": _with(SILVER, "SELECT * FROM silver"),
    "gold_daily_summary": _with(GOLD, "SELECT * FROM gold"),
    "gold_partition": _with(
        DELIVERIES
        + f""",
silver AS (
  SELECT {CLEAN_COLUMNS}
  FROM (SELECT *, row_number() OVER (
          PARTITION BY order_id ORDER BY amount DESC NULLS LAST, customer_id DESC NULLS LAST,
                                         order_date DESC NULLS LAST, status DESC NULLS LAST) AS rn
        FROM deliveries WHERE _partition_dt = '2024-01-02')
  WHERE rn = 1)""",
        f"SELECT '2024-01-02' AS _partition_dt, {SUMMARY_COLUMNS} FROM silver GROUP BY CAST(order_date AS DATE), status",
    ),
    "quality_exists": _with(
        ORDERS_RAW,
        "\nUNION ALL".join(
            [
                _rule(1, "expect_column_to_exist", "order_id", "{}", "NULL", "NULL", "NULL", "count(*) >= 0",
                      "orders_raw", "checked", CHECKED),
                _rule(2, "expect_column_to_exist", "email", "{}", "NULL", "NULL", "NULL", "count(*) < 0",
                      "orders_raw", "checked", CHECKED),
                _rule(3, "expect_table_row_count_to_be_between", None,
                      '{"max_value": 1000000000000000, "min_value": 1}', "count(*)", "NULL", "NULL",
                      "count(*) BETWEEN 1 AND 1000000000000000", "orders_raw", "checked", CHECKED),
            ]
        ),
    ),
    "quality_not_null": _with(ORDERS_RAW, _not_null(1, "status", "orders_raw", "checked", CHECKED)),
    "quality_unique": _with(ORDERS_RAW, _unique(1, "order_id", "orders_raw", "checked", CHECKED)),
    "quality_between": _with(
        ORDERS_RAW,
        _row_rule(1, "expect_column_values_to_be_between", "amount", '{"max_value": 400000, "min_value": 50000}',
                  "amount IS NOT NULL AND NOT (amount BETWEEN 50000 AND 400000)", "orders_raw", "checked", CHECKED),
    ),
    "quality_in_set": _with(
        ORDERS_RAW,
        _row_rule(1, "expect_column_values_to_be_in_set", "status", STATUS_ARGS,
                  f"status IS NOT NULL AND status NOT IN ({STATUS_LIST})", "orders_raw", "checked", CHECKED),
    ),
    "quality_row_count": _with(
        ORDERS_RAW,
        _rule(1, "expect_table_row_count_to_be_between", None, '{"max_value": 10000000, "min_value": 1}', "count(*)",
              "NULL", "NULL", "count(*) BETWEEN 1 AND 10000000", "orders_raw", "checked", CHECKED),
    ),
    "quality_regex": _with(
        CUSTOMERS_RAW,
        _row_rule(1, "expect_column_values_to_match_regex", "email", EMAIL_ARGS,
                  f"NOT regexp_matches(email, '{EMAIL}')", "customers_raw", "checked", CHECKED),
    ),
    "quality_orders_raw": _with(ORDERS_RAW, _order_rules("orders_raw")),
    "quality_orders_silver": _with(SILVER, _order_rules("silver")),
    "quality_customers": _with(CUSTOMERS_RAW, _customer_rules()),
    "quality_by_date": _with(
        DELIVERIES
        + """,
day_1 AS (SELECT * FROM deliveries WHERE _partition_dt = '2024-01-01'),
day_2 AS (SELECT * FROM deliveries WHERE _partition_dt = '2024-01-02'),
day_3 AS (SELECT * FROM deliveries WHERE _partition_dt = '2024-01-03')""",
        "\nUNION ALL".join(_order_rules(f"day_{n}", f"'2024-01-0{n}'") for n in (1, 2, 3)),
    ),
    "quality_summary": _with(_score_ctes(), _summary_select("0.95, 0.875, 0.75")),
    "quality_gate": _with(_score_ctes(), _summary_select("0.95, 0.875", GATE_TEXT)),
    "quality_skip": _with(
        CUSTOMERS_RAW.strip() + f",\nrules AS ({_customer_rules()})",
        """
SELECT 'events' AS dataset, '2024-01-01' AS partition_date, 0 AS total_checks, 0 AS passed, 0 AS failed,
       CAST(NULL AS DOUBLE) AS pass_rate, CAST(0.95 AS DOUBLE) AS threshold, true AS success, true AS skipped
UNION ALL
SELECT 'customers', '2024-01-01', CAST(count(*) AS INTEGER), CAST(count(*) FILTER (success) AS INTEGER),
       CAST(count(*) FILTER (NOT success) AS INTEGER), round(count(*) FILTER (success) / count(*)::DOUBLE, 4),
       0.95, count(*) FILTER (success) / count(*)::DOUBLE >= 0.95, false
FROM rules""",
    ),
    "bronze_ingest": _with(
        ORDERS_TEXT,
        f"""SELECT *, {AS_OF} AS _ingested_at, '2024-01-01' AS _partition_dt, 'airflow_1' AS _pipeline_run
            FROM orders_text""",
    ),
    "silver_transform": _with(ONE_DAY, f"SELECT *, {AS_OF} AS _silver_at FROM silver"),
    "gold_build": _with(
        ONE_DAY,
        f"""SELECT {SUMMARY_COLUMNS}, '2024-01-01' AS _partition_dt, {AS_OF} AS _gold_at
            FROM silver GROUP BY CAST(order_date AS DATE), status""",
    ),
    "daily_run": _with(
        DAYS,
        f"""SELECT {SUMMARY_COLUMNS}, _partition_dt, {AS_OF} AS _gold_at
            FROM silver GROUP BY _partition_dt, CAST(order_date AS DATE), status""",
    ),
    "silver_transform_ordered": _with(
        ORDERED, f"SELECT {CLEAN_COLUMNS}, seq, '2024-01-01' AS _partition_dt, {AS_OF} AS _silver_at FROM kept"
    ),
    "daily_run_mixed": _with(
        DAYS,
        f"""SELECT {SUMMARY_COLUMNS}, _partition_dt, {AS_OF} AS _gold_at
            FROM silver WHERE _partition_dt < '2024-01-03' GROUP BY _partition_dt, CAST(order_date AS DATE), status""",
    ),
    "quality_rejects": _with(
        RANKED,
        """SELECT 'orders' AS dataset, '2024-01-01' AS partition_date, rule_no,
                  CASE rule_no WHEN 3 THEN 'expect_column_values_to_be_unique' WHEN 5 THEN 'expect_column_values_to_be_between'
                       ELSE 'expect_column_values_to_be_in_set' END AS method,
                  CASE rule_no WHEN 3 THEN 'order_id' WHEN 5 THEN 'amount' ELSE 'status' END AS "column",
                  CAST(sum(count(*)) OVER (PARTITION BY rule_no) AS BIGINT) AS failed,
                  CAST(rank % 5 AS INTEGER) AS slot, arg_min(order_id, rank) AS order_id, arg_min(seq, rank) AS seq
           FROM failed WHERE rule_no IS NOT NULL GROUP BY rule_no, rank % 5""",
    ),
    "gold_rollup": _with(
        DAYS
        + """,
again AS (
  SELECT * FROM silver WHERE _partition_dt <> '2024-01-02'
  UNION ALL
  SELECT * REPLACE (CAST(amount + 1 AS DECIMAL(18,2)) AS amount) FROM silver
  WHERE _partition_dt = '2024-01-02' AND CAST(order_id AS BIGINT) % 2 = 0)""",
        f"SELECT {SUMMARY_COLUMNS.rpartition(',')[0]} FROM again GROUP BY CAST(order_date AS DATE), status",
    ),
    "customers_rollup": _with(
        DAYS, "SELECT status, count(DISTINCT customer_id) AS unique_customers, true AS close FROM silver GROUP BY status"
    ),
    "unique_across_dates": _with(
        DELIVERIES,
        """SELECT d._partition_dt, d.order_id AS key, count(DISTINCT e._partition_dt) AS other_dates,
                  min(e._partition_dt) AS first_date
           FROM (SELECT DISTINCT _partition_dt, order_id FROM deliveries WHERE _partition_dt = '2024-01-02') d
           JOIN deliveries e ON d.order_id = e.order_id AND e._partition_dt < d._partition_dt
           GROUP BY d._partition_dt, d.order_id""",
    ),
    "series_incremental": _with(
        METRIC_SAMPLES,
        """SELECT metric, kind, CASE kind WHEN 'c' THEN sum(value) ELSE arg_max(value, {ts: ts, value: value}) END AS value
           FROM samples GROUP BY metric, kind""",
    ),
    "sla_status": _with(SLOTS, "SELECT * FROM status"),
    "sla_absent": _with(SLOTS, "SELECT dag_id, task_id, scheduled_at, due_at FROM status WHERE status = 'absent'"),
    "attempt_episodes": _with(
        RUNS
        + """,
ended AS (SELECT *, greatest(started_at, coalesce(finished_at, started_at)) AS ended_at FROM runs),
before AS (
  SELECT *, max(ended_at) OVER (PARTITION BY dag_id, task_id ORDER BY started_at, ended_at, state
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM ended),
numbered AS (
  SELECT *, count(*) FILTER (until IS NULL OR started_at > until + INTERVAL 30 MINUTE) OVER (
              PARTITION BY dag_id, task_id ORDER BY started_at, ended_at, state ROWS UNBOUNDED PRECEDING) AS episode
  FROM before)""",
        """SELECT dag_id, task_id, min(started_at) AS first_start, max(ended_at) AS last_end, count(*) AS attempts,
                  count(*) FILTER (state = 'failed') AS failures,
                  arg_max(state, {s: started_at, e: ended_at, state: state}) AS final_state,
                  count(*) FILTER (started_at < until) AS overlapping
           FROM numbered GROUP BY dag_id, task_id, episode""",
    ),
    "append_once": _with(
        DAYS,
        """SELECT order_id, customer_id, amount, order_date, status, dt AS _partition_dt, 'airflow_1' AS _pipeline_run FROM by_day
           UNION ALL
           SELECT order_id, customer_id, amount, order_date, status, dt, 'airflow_3'
           FROM by_day WHERE dt = '2024-01-02' AND CAST(order_id AS BIGINT) % 20 = 0""",
    ),
    "bronze_mixed_types": _with(
        DAYS,
        """SELECT CASE WHEN dt = '2024-01-02' THEN 'A' ELSE '' END || order_id AS order_id,
                  CAST(customer_id AS BIGINT) AS customer_id,
                  CASE WHEN dt = '2024-01-02' THEN floor(CAST(amount AS DOUBLE)) ELSE CAST(amount AS DOUBLE) END AS amount,
                  CAST(order_date AS TIMESTAMP)
                  + CASE WHEN dt = '2024-01-02' THEN INTERVAL 10 HOUR ELSE INTERVAL 0 HOUR END AS order_date,
                  status, dt AS _partition_dt
           FROM by_day""",
    ),
    "raw_rejects": _with(
        DAYS,
        """SELECT CASE WHEN CAST(order_id AS BIGINT) % 29 = 0
                       THEN order_id || ',' || customer_id || ',' || coalesce(amount, '') || ',' || order_date || ','
                            || coalesce(status, '') || ',more,and more'
                       ELSE order_id || ',' || customer_id END AS _row_text,
                  CASE WHEN CAST(order_id AS BIGINT) % 29 = 0 THEN '7' ELSE '2' END || ' fields in 5 columns' AS _reason,
                  dt AS file_day, dt AS _partition_dt,
                  (SELECT count(*) FROM by_day WHERE CAST(order_id AS BIGINT) % 29 <> 0 AND CAST(order_id AS BIGINT) % 31 <> 0)
                    AS kept
           FROM by_day WHERE CAST(order_id AS BIGINT) % 29 = 0 OR CAST(order_id AS BIGINT) % 31 = 0""",
    ),
    "quality_skip_layer": _with(
        DAYS,
        """SELECT 'returns' AS dataset, dt AS partition_date, 0 AS total_checks, 0 AS passed, 0 AS failed,
                  CAST(NULL AS DOUBLE) AS pass_rate, CAST(0.95 AS DOUBLE) AS threshold, true AS success, true AS skipped, layer,
                  CAST(count(*) OVER () // 2 AS INTEGER) AS published
           FROM (SELECT DISTINCT dt FROM by_day), (VALUES ('bronze'), ('silver')) l(layer)""",
    ),
    "control_series": _with(
        DAYS,
        f"""
SELECT 'data_pipeline.bronze.orders.row_count' AS metric, 'g' AS kind, 'bronze' AS layer, CAST(count(*) AS DOUBLE) AS value
FROM by_day WHERE {LAST_DAY}
UNION ALL
SELECT 'data_pipeline.silver.orders.row_count', 'g', 'silver', count(*) FROM kept WHERE {LAST_DAY}
UNION ALL
SELECT 'data_pipeline.gold.orders.row_count', 'g', 'gold', count(*)
FROM (SELECT DISTINCT order_date, status FROM silver WHERE _partition_dt = '2024-01-03')
UNION ALL
SELECT 'data_pipeline.quality.orders.pass_rate', 'g', 'bronze',
       (6 + CAST(count(*) = count(DISTINCT order_id) AS INT)
          + CAST(count(*) FILTER (status NOT IN ('PENDING', 'CONFIRMED', 'SHIPPED', 'DELIVERED', 'CANCELLED')) = 0 AS INT))
       / 8.0 * 100 FROM by_day WHERE {LAST_DAY}
UNION ALL
SELECT 'data_pipeline.quality.orders.pass_rate', 'g', 'silver', 100 FROM by_day WHERE {LAST_DAY} HAVING count(*) > 0
UNION ALL
SELECT 'data_pipeline.failure.orders_pipeline.transform_silver', 'c', 'silver', 1 FROM by_day WHERE {LAST_DAY} HAVING count(*) > 0""",
    ),
    "control_attempts": _with(
        DAYS,
        """SELECT 'orders_pipeline' AS dag_id, task_id, dt AS partition_date,
                  CASE WHEN dt = '2024-01-03' AND task_id <> 'build_gold' THEN 2 ELSE 1 END::BIGINT AS attempts,
                  'success' AS final_state, 0::BIGINT AS over_time, false AS exhausted
           FROM (SELECT DISTINCT dt FROM by_day), (VALUES ('ingest_bronze'), ('quality_bronze.validate_bronze'),
                ('transform_silver'), ('build_gold')) t(task_id)""",
    ),
    "control_alerts": _with(
        DAYS,
        """SELECT 'orders_pipeline' AS dag_id, 'transform_silver' AS task_id, dt AS partition_date,
                  '❌ *[DataPipeline]* DAG `orders_pipeline` | Task `transform_silver` FAILED' || chr(10)
                  || 'Execution: ' || strftime(CAST(dt AS DATE) + 1, '%Y-%m-%d %H:%M:%S') AS message
           FROM (SELECT DISTINCT dt FROM by_day) WHERE dt = '2024-01-03'
           UNION ALL
           SELECT 'orders_pipeline', NULL, NULL, '⚠️ *[DataPipeline]* SLA MISS on DAG `orders_pipeline`: tasks '
                  || '[''build_gold'', ''ingest_bronze'', ''quality_bronze.validate_bronze'', ''transform_silver'']'
           FROM (VALUES (1), (2))""",
    ),
    "row_count_gauge": _with(
        RUNS,
        """SELECT finished_at AS ts, 'data_pipeline.' || layer || '.' || dataset || '.row_count' AS metric,
                  CAST(row_count AS DOUBLE) AS value, 'g' AS kind FROM runs WHERE state = 'success'""",
    ),
    "pass_rate_gauge": _with(
        _score_ctes(),
        f"""SELECT {AS_OF} AS ts, 'data_pipeline.quality.' || dataset || '.pass_rate' AS metric,
                   round(passed / total_checks::DOUBLE, 4) * 100 AS value, 'g' AS kind FROM rates""",
    ),
    "task_duration": _with(
        RUNS,
        """SELECT finished_at AS ts, 'data_pipeline.task.' || task_id || '.duration_seconds' AS metric,
                  (epoch_us(finished_at) - epoch_us(started_at)) / 1e6 AS value, 'g' AS kind
           FROM runs WHERE state = 'success'""",
    ),
    "failure_samples": _with(
        RUNS,
        """SELECT finished_at AS ts, 'data_pipeline.failure.' || dag_id || '.' || task_id AS metric,
                  CAST(1 AS DOUBLE) AS value, 'c' AS kind FROM runs WHERE state = 'failed'""",
    ),
    "failure_counter": _with(
        RUNS,
        "SELECT dag_id, task_id, count(*) AS failures FROM runs WHERE state = 'failed' GROUP BY dag_id, task_id",
    ),
    "metric_encode": _with(LINES, "SELECT line FROM lines"),
    "metric_decode": _with(LINES, "SELECT line, metric, CAST(value AS DOUBLE) AS value, kind FROM lines"),
    "metric_mapping": _with(
        MIXED,
        f"""
SELECT event_id, metric, value,
       CASE WHEN regexp_matches(metric, '{ROWS}') THEN 'pipeline_row_count'
            WHEN regexp_matches(metric, '{RATE}') THEN 'pipeline_quality_pass_rate'
            WHEN regexp_matches(metric, '{SECONDS}') THEN 'pipeline_task_duration_seconds'
            WHEN regexp_matches(metric, '{FAILED}') THEN 'pipeline_failure_total' ELSE metric END AS name,
       CASE WHEN regexp_matches(metric, '{ROWS}') THEN 2 WHEN regexp_matches(metric, '{RATE}') THEN 1
            WHEN regexp_matches(metric, '{SECONDS}') THEN 1 WHEN regexp_matches(metric, '{FAILED}') THEN 2
            ELSE 0 END AS n_labels,
       {_matched(ROWS, 1)} AS label_layer,
       coalesce({_matched(ROWS, 2)}, {_matched(RATE, 1)}) AS label_dataset,
       {_matched(SECONDS, 1)} AS label_task,
       {_matched(FAILED, 1)} AS label_dag_id, {_matched(FAILED, 2)} AS label_task_id
FROM mixed""",
    ),
    "metric_series": _with(
        METRIC_SAMPLES,
        """
SELECT metric, kind, CAST(sum(value) AS DOUBLE) AS value FROM samples WHERE kind = 'c' GROUP BY metric, kind
UNION ALL
SELECT metric, kind, value FROM (
  SELECT *, row_number() OVER (PARTITION BY metric ORDER BY ts DESC, value DESC) AS rn FROM samples WHERE kind = 'g')
WHERE rn = 1""",
    ),
    "sla_miss": _with(
        MISSES,
        """SELECT run_id, dag_id, task_id, scheduled_at, finished_at, sla_seconds, taken - sla_seconds AS late_seconds
           FROM missed""",
    ),
    "alert_failures": _with(
        RUNS,
        """SELECT run_id, dag_id, task_id,
                  '❌ *[DataPipeline]* DAG `' || dag_id || '` | Task `' || task_id || '` FAILED' || chr(10)
                  || 'Execution: ' || strftime(scheduled_at, '%Y-%m-%d %H:%M:%S') || chr(10) || 'Log: ' || log_url AS message
           FROM runs WHERE state = 'failed'""",
    ),
    "alert_sla": _with(
        MISSES,
        """SELECT dag_id, '⚠️ *[DataPipeline]* SLA MISS on DAG `' || dag_id || '`: tasks ['
                  || string_agg('''' || task_id || '''', ', ' ORDER BY task_id) || ']' AS message
           FROM (SELECT DISTINCT dag_id, task_id FROM missed) GROUP BY dag_id""",
    ),
    "attempts": _with(
        RUNS,
        """
SELECT dag_id, task_id, CAST(started_at AS DATE) AS day, count(*) AS attempts,
       max(state) FILTER (rn = 1) AS final_state,
       count(*) FILTER (epoch_us(finished_at) - epoch_us(started_at) > 120000000) AS over_time,
       max(state) FILTER (rn = 1) = 'failed' AND count(*) > 2 AS exhausted
FROM (SELECT *, row_number() OVER (PARTITION BY dag_id, task_id, CAST(started_at AS DATE)
                                   ORDER BY started_at DESC, finished_at DESC, state DESC) AS rn FROM runs)
GROUP BY dag_id, task_id, CAST(started_at AS DATE)""",
    ),
}

"""The queries once more as SQL for an independent engine, over the same whole tables.

Money is added up as whole cents and averages are rounded on whole numbers, so no result hangs
on the order of floating-point additions.
"""

from __future__ import annotations

from tidelake.plans.queries import AS_OF, TABLES

USAGE = """
usage AS (
  SELECT CAST(l_shipdate AS DATE) AS usage_date, c_nationkey AS workspace_id,
    l_shipdate + to_hours(l_linenumber) AS usage_start_time,
    l_shipdate + to_hours(l_linenumber + 1) AS usage_end_time,
    l_returnflag AS sku_name, l_linestatus AS cloud,
    CASE WHEN l_returnflag = 'N' THEN 'GB' ELSE 'DBU' END AS usage_unit,
    CAST(l_quantity AS BIGINT) AS units,
    CASE WHEN l_linestatus = 'F' THEN 'JOBS' ELSE 'ALL_PURPOSE' END AS billing_origin_product,
    CASE WHEN l_returnflag <> 'A' THEN CAST(o_custkey AS VARCHAR) END AS cluster_id,
    'node-' || l_linenumber AS billed_node_type,
    CASE WHEN l_returnflag <> 'R' THEN CAST(o_custkey AS VARCHAR) END AS job_id,
    CAST(l_orderkey AS VARCHAR) AS job_run_id,
    CASE WHEN l_returnflag = 'A' THEN [['team', l_returnflag], ['env', l_linestatus]]
         WHEN l_returnflag = 'R' THEN [['team', l_returnflag]] END AS tags
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
),
quarters AS (
  SELECT l_returnflag AS sku_name, l_linestatus AS cloud,
    CASE WHEN l_returnflag = 'N' THEN 'GB' ELSE 'DBU' END AS usage_unit,
    CAST(date_trunc('quarter', l_shipdate) AS TIMESTAMP) AS price_start_time,
    sum(CAST(round(l_extendedprice * 100) AS BIGINT)) // sum(CAST(l_quantity AS BIGINT)) AS price_cents
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' GROUP BY 1, 2, 3, 4
),
prices AS (
  SELECT *, lead(price_start_time) OVER (PARTITION BY sku_name, cloud, usage_unit ORDER BY price_start_time)
    AS price_end_time FROM quarters
),
priced AS (
  SELECT u.*, units * price_cents AS cents
  FROM usage u JOIN prices p ON u.sku_name = p.sku_name AND u.cloud = p.cloud AND u.usage_unit = p.usage_unit
    AND u.usage_end_time >= p.price_start_time
    AND (p.price_end_time IS NULL OR u.usage_end_time < p.price_end_time)
)
"""

SUMS = "CAST(sum(units) AS DOUBLE) AS total_usage_quantity, sum(cents) / 100.0 AS list_cost_usd"

CLUSTERS = """
clusters AS (
  SELECT c_nationkey AS workspace_id, CAST(o_custkey AS VARCHAR) AS cluster_id, o_orderdate AS change_time,
    o_orderkey AS change_id, 'cluster-' || o_custkey AS cluster_name, c_name AS owned_by,
    o_orderstatus AS cluster_source, o_orderpriority AS driver_node_type, c_mktsegment AS worker_node_type,
    CAST(floor(o_totalprice / 1000) AS INTEGER) AS worker_count,
    CASE WHEN o_orderstatus = 'O' THEN 1 END AS min_autoscale_workers,
    CASE WHEN o_orderstatus = 'O' THEN 8 END AS max_autoscale_workers,
    'v' || year(o_orderdate) AS dbr_version,
    CASE WHEN o_orderstatus = 'F' THEN 'SINGLE' ELSE 'SHARED' END AS data_security_mode,
    CASE WHEN o_orderpriority < '3' THEN o_orderpriority END AS policy_id
  FROM orders JOIN customer ON o_custkey = c_custkey
)
"""

JOBS = """
job_versions AS (
  SELECT c_nationkey AS workspace_id, CAST(o_custkey AS VARCHAR) AS job_id,
    'job-' || o_orderpriority AS job_name, c_name AS creator_user_name, c_mktsegment AS run_as_user_name,
    o_orderpriority AS trigger_type, o_orderstatus = 'O' AS paused, o_orderstatus = 'P' AS deleted,
    row_number() OVER (PARTITION BY c_nationkey, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders JOIN customer ON o_custkey = c_custkey
),
latest_jobs AS (SELECT * FROM job_versions WHERE rn = 1)
"""

PERIODS = """
periods AS (
  SELECT c_nationkey AS workspace_id, CAST(o_custkey AS VARCHAR) AS job_id, l_orderkey, l_linenumber,
    l_suppkey, l_partkey, l_returnflag, l_linestatus, o_orderpriority,
    l_shipdate + to_hours(l_linenumber) AS period_start,
    l_shipdate + to_hours(l_linenumber) + to_minutes(CAST(l_quantity AS BIGINT))
      + to_seconds(l_linenumber) AS period_end,
    CAST(l_quantity AS BIGINT) * 60 + l_linenumber AS seconds,
    CAST(l_quantity AS INTEGER) AS execution,
    CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS result_state,
    CASE WHEN l_returnflag = 'R' THEN 'CODE-' || l_linenumber END AS termination_code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
)
"""

BRONZE = """
bronze AS (
  SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F'
      THEN 'ORD-' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O'
      THEN 'n/a ' || year(o_orderdate) ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    CASE o_orderstatus WHEN 'F' THEN '  PAID ' WHEN 'O' THEN 'Created'
      ELSE CASE WHEN o_orderpriority <> '5-LOW' THEN 'pending' END END AS status,
    strftime(o_orderdate, '%Y-%m-%d') AS ingestion_date,
    CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'
      THEN '{"priority":"' || o_orderpriority || '"}' END AS _rescued_data,
    o_orderdate AS _ingestion_timestamp, 'landing/' || o_orderpriority AS _source_file
  FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), 'Shipped',
    strftime(o_orderdate, '%Y-%m-%d'), NULL, o_orderdate + INTERVAL 30 DAY, 'landing/redelivery'
  FROM orders WHERE o_orderstatus = 'P'
),
normal AS (
  SELECT TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(customer_id AS BIGINT) AS customer_id,
    TRY_CAST(order_date AS DATE) AS order_date, lower(trim(status)) AS status,
    TRY_CAST(ingestion_date AS DATE) AS ingestion_date, _rescued_data, _ingestion_timestamp, _source_file
  FROM bronze
),
judged AS (
  SELECT *, order_id IS NOT NULL AND customer_id IS NOT NULL AND order_date IS NOT NULL
      AND status IN ('created', 'paid', 'shipped', 'cancelled') AND _rescued_data IS NULL AS ok
  FROM normal
),
silver AS (
  SELECT * EXCLUDE (ok, rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_id ORDER BY _ingestion_timestamp DESC, _source_file DESC) AS rn
    FROM judged WHERE ok) WHERE rn = 1
)
"""

CDC = """
target AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS payment_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
    CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 AS BIGINT) AS sequence_num,
    TIMESTAMP '2026-01-01 08:00:00' AS applied
  FROM orders WHERE o_orderstatus <> 'P'
),
events_in AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id, l_orderkey AS transaction_id,
    CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS payment_id,
    CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS amount,
    CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) + 1 AS BIGINT) AS sequence_num,
    CASE l_returnflag WHEN 'A' THEN 'INSERT' WHEN 'N' THEN 'UPDATE' ELSE 'DELETE' END AS operation,
    l_linenumber, l_partkey, l_suppkey
  FROM lineitem
)
"""


def _latest(operation: str | None = None) -> str:
    where = f"WHERE operation = '{operation}'" if operation else ""
    return f"""
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id
      ORDER BY sequence_num DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
    FROM events_in {where}) WHERE rn = 1
)"""


MIXED = f"""WITH {CDC}, {_latest()},
merged AS (
  SELECT coalesce(t.transaction_id, s.transaction_id) AS transaction_id,
    CASE WHEN t.transaction_id IS NULL THEN s.payment_id
         WHEN s.sequence_num > t.sequence_num AND s.operation <> 'DELETE' THEN s.payment_id
         ELSE t.payment_id END AS payment_id,
    CASE WHEN t.transaction_id IS NULL THEN s.amount
         WHEN s.sequence_num > t.sequence_num AND s.operation <> 'DELETE' THEN s.amount
         ELSE t.amount END AS amount_dec,
    CASE WHEN t.transaction_id IS NULL OR s.sequence_num > t.sequence_num
         THEN s.sequence_num ELSE t.sequence_num END AS sequence_num,
    CASE WHEN t.transaction_id IS NULL OR s.sequence_num > t.sequence_num
         THEN s.operation = 'DELETE' ELSE false END AS _is_deleted,
    CASE WHEN t.transaction_id IS NULL OR s.sequence_num > t.sequence_num
         THEN TIMESTAMP '2026-02-01 08:00:00' ELSE t.applied END AS _applied_at,
    CASE WHEN t.transaction_id IS NULL THEN 'inserted'
         WHEN s.sequence_num > t.sequence_num THEN 'updated' ELSE 'unchanged' END AS _action,
    t.transaction_id IS NOT NULL AS known
  FROM target t FULL OUTER JOIN latest s ON t.transaction_id = s.transaction_id
)
"""
MIXED_ROWS = "transaction_id, payment_id, CAST(amount_dec AS DOUBLE) AS amount, sequence_num"


BUSINESS_CHANGES = f"""{MIXED} SELECT count(*) FILTER (WHERE NOT known AND NOT _is_deleted) AS inserted,
  count(*) FILTER (WHERE known AND _action = 'updated' AND NOT _is_deleted) AS updated,
  count(*) FILTER (WHERE known AND _is_deleted) AS deleted_logically FROM merged"""


def half_up(num: str, den: str) -> str:
    """Whole-number quotient rounded half away from zero, for a positive denominator."""
    return f"(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def _avg2(value: str, condition: str | None = None) -> str:
    """Average of whole (or half) numbers rounded to two places; doubled first so halves are whole."""
    kept = f" FILTER (WHERE {condition})" if condition else ""
    total = f"CAST(sum(2 * ({value})){kept} AS HUGEINT) * 100"
    count = f"(2 * nullif(count(*){kept}, 0))"
    return f"{half_up(total, count)} / 100.0"


def _period(value: str, condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN {value} ELSE 0 END)"


def _kpis() -> str:
    d = f"DATE '{AS_OF}'"
    month = f"CAST(date_trunc('month', {d}) AS DATE)"
    before = f"CAST({month} - INTERVAL 1 MONTH AS DATE)"
    days = f"day(last_day({d}))"
    mtd = f"usage_date >= {month} AND usage_date <= {d}"
    cost7, prev7 = "cost7", "prev7"
    # The daily mean carries six decimals before it is multiplied by the days of the month.
    micro = half_up("mtd * 10000", "observed")
    return f"""WITH {USAGE}, sums AS (
  SELECT workspace_id, max(usage_date) AS latest,
    {_period("cents", f"usage_date = {d}")} AS today,
    {_period("units", f"usage_date = {d} AND usage_unit = 'DBU'")} AS dbu_day,
    {_period("cents", mtd)} AS mtd,
    {_period("units", f"{mtd} AND usage_unit = 'DBU'")} AS dbu_month,
    {_period("cents", f"usage_date BETWEEN {d} - 6 AND {d}")} AS cost7,
    {_period("cents", f"usage_date BETWEEN {d} - 13 AND {d} - 7")} AS prev7,
    {_period("cents", f"usage_date >= {before} AND usage_date < {month}")} AS prev_month
  FROM priced GROUP BY workspace_id
), observed AS (
  SELECT *, nullif(CASE WHEN latest >= {month}
    THEN date_diff('day', {month}, least(latest, {d})) + 1 ELSE 0 END, 0) AS observed FROM sums
)
SELECT workspace_id, {d} AS dashboard_date, latest AS latest_usage_date,
  today / 100.0 AS cost_today_usd, CAST(dbu_day AS DOUBLE) AS dbu_today,
  mtd / 100.0 AS cost_mtd_usd, CAST(dbu_month AS DOUBLE) AS dbu_mtd,
  cost7 / 100.0 AS cost_last_7_days_usd, prev7 / 100.0 AS cost_previous_7_days_usd,
  {half_up(f"10000 * ({cost7} - {prev7})", f"nullif({prev7}, 0)")} / 100.0 AS cost_7d_change_pct,
  {half_up("mtd", "observed")} / 100.0 AS avg_daily_cost_mtd_usd,
  {half_up(f"{micro} * {days}", "10000")} / 100.0 AS forecast_month_end_usd,
  prev_month / 100.0 AS previous_month_cost_usd
FROM observed"""


WINDOW_COUNT = """SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS count
FROM events GROUP BY 1, 2"""

CLOSED_WINDOWS = f"""SELECT * FROM ({WINDOW_COUNT}) WHERE window_start + INTERVAL 1 HOUR <=
  (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 SECOND FROM events)"""

PAIRS = """SELECT c.user_id, c.event_id AS click_id, c.ts AS click_ts, p.event_id AS purchase_id, p.ts AS purchase_ts
FROM events c JOIN events p ON c.user_id = p.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 1 HOUR
WHERE c.event_type = 'click' AND p.event_type = 'purchase'"""

SKU_KEYS = "usage_date, workspace_id, billing_origin_product, sku_name, usage_unit"
COST_BY_SKU = f"WITH {USAGE} SELECT {SKU_KEYS}, {SUMS} FROM priced GROUP BY ALL"

CONFIG = (
    "cluster_name, owned_by, cluster_source, driver_node_type, worker_node_type, worker_count,"
    " min_autoscale_workers, max_autoscale_workers, dbr_version, data_security_mode, policy_id"
)

HISTORY_COUNTS = ["read_partitions", "pruned_files", "read_files", "read_rows", "read_bytes", "produced_rows"]
HISTORY_VOLUMES = ["shuffle_read_bytes", "spilled_local_bytes", "written_bytes", "written_rows", "written_files"]


def _lineage_side(name: str, schema: str) -> str:
    return f"""'TABLE' AS {name}_type, 'lab' AS {name}_table_catalog, '{schema}' AS {name}_table_schema,
  o_orderpriority AS {name}_table_name, 'lab.{schema}.' || o_orderpriority AS {name}_table_full_name,
  CAST(NULL AS VARCHAR) AS {name}_path"""


_TABLE_NAMES = " UNION ALL ".join(f"SELECT '{name}' AS table_name" for name in TABLES)
_TABLE_COUNTS = " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}" for name in TABLES)
_SPARK_TYPE = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
    WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DATE' THEN 'date'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'DOUBLE[]' THEN 'array<double>'
    ELSE column_type END"""

ORACLES: dict[str, str] = {
    "orders_valid": f"WITH {BRONZE} SELECT * EXCLUDE (ok) FROM judged WHERE ok",
    "orders_quarantine": f"WITH {BRONZE} SELECT * EXCLUDE (ok) FROM judged WHERE NOT coalesce(ok, false)",
    "orders_invalid_strict": f"WITH {BRONZE} SELECT * EXCLUDE (ok) FROM judged WHERE NOT ok",
    "orders_silver": f"WITH {BRONZE} SELECT * FROM silver",
    "orders_daily": f"WITH {BRONZE} SELECT order_date, status, count(*) AS order_count FROM silver GROUP BY 1, 2",
    "orders_rescued": f"""WITH {BRONZE}
SELECT TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(customer_id AS BIGINT) AS customer_id,
  TRY_CAST(order_date AS DATE) AS order_date, status, _source_file,
  CASE WHEN TRY_CAST(order_id AS BIGINT) IS NULL THEN '{{"order_id":"' || order_id || '"}}'
       WHEN TRY_CAST(order_date AS DATE) IS NULL THEN '{{"order_date":"' || order_date || '"}}' END AS _rescued_data
FROM bronze""",
    "contract_valid": r"SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https?://[^/]+/[a-z]{2}/\d+$')",
    "contract_quarantine": r"""SELECT page_id, url, 'INVALID_SOURCE_PATH' AS _quarantine_reason FROM pages
WHERE NOT regexp_matches(url, '^https?://[^/]+/[a-z]{2}/\d+$')""",
    "lineitem_latest": """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
    "lineitem_key_stats": """SELECT count(*) AS total_rows, count(DISTINCT l_orderkey) AS distinct_keys,
  count(*) - count(DISTINCT l_orderkey) AS duplicate_rows,
  count(l_orderkey) - count(DISTINCT l_orderkey) AS surplus_rows,
  count(*) - count(l_orderkey) AS null_keys, count(DISTINCT l_suppkey) AS source_files, max(l_shipdate) AS latest
FROM lineitem""",
    "lineitem_duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""",
    "silver_idempotence_check": f"""WITH {BRONZE} SELECT CASE WHEN count(*) = count(DISTINCT order_id)
  AND count(*) = count(order_id) THEN 'PASS' ELSE 'FAIL' END AS idempotence_check FROM silver""",
    "lineitem_distinct_copies": "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem",
    "anti_missing": "SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "latest_customer_order": """WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
)
SELECT c_custkey, c_name, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM customer LEFT JOIN ranked ON c_custkey = o_custkey AND rn = 1 AND o_orderstatus <> 'P'""",
    "newest_events": """SELECT event_id, ts, user_id, event_type, value FROM events
ORDER BY ts DESC, event_id DESC LIMIT 20""",
    "anomaly_profile": """SELECT 'hottest_key_rows' AS metric, max(n) AS rows, CAST(NULL AS TIMESTAMP) AS oldest
FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)
UNION ALL SELECT 'null_amounts', count(*), NULL FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'invalid_statuses', count(*), NULL FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'duplicate_ids', count(event_id) - count(DISTINCT event_id), min(ts) FROM events""",
    "processed_values": """SELECT count(*) AS output_rows, CAST(0 AS BIGINT) AS invalid_rows, 'PASS' AS result
FROM lineitem""",
    "price_daily": f"""WITH {USAGE} SELECT usage_date, workspace_id, CAST(sum(units) AS DOUBLE) AS total_dbu,
  sum(cents) / 100.0 AS list_cost_usd FROM priced GROUP BY 1, 2""",
    "cost_by_sku": COST_BY_SKU,
    "cost_by_sku_sliced": COST_BY_SKU,
    "cost_by_compute": f"""WITH {USAGE}, {CLUSTERS}, named AS (
  SELECT *, row_number() OVER () AS record FROM priced WHERE cluster_id IS NOT NULL
), configured AS (
  SELECT u.*, c.* EXCLUDE (workspace_id, cluster_id, change_time, change_id),
    row_number() OVER (PARTITION BY record ORDER BY change_time DESC, change_id DESC) AS rn
  FROM named u LEFT JOIN clusters c ON u.workspace_id = c.workspace_id AND u.cluster_id = c.cluster_id
    AND c.change_time <= u.usage_start_time
)
SELECT usage_date, workspace_id, cluster_id, {CONFIG}, sku_name, billed_node_type, usage_unit, {SUMS}
FROM configured WHERE rn = 1 GROUP BY ALL""",
    "cost_by_job": f"""WITH {USAGE}, {JOBS}
SELECT usage_date, p.workspace_id, p.job_id, job_name, creator_user_name, run_as_user_name, trigger_type, paused,
  sku_name, usage_unit, count(DISTINCT job_run_id) AS run_count, {SUMS}
FROM priced p LEFT JOIN latest_jobs j
  ON p.workspace_id = j.workspace_id AND p.job_id = j.job_id AND NOT j.deleted
WHERE billing_origin_product = 'JOBS' AND p.job_id IS NOT NULL GROUP BY ALL""",
    "cost_by_tag": f"""WITH {USAGE}, tagged AS (SELECT *, unnest(tags) AS tag FROM priced)
SELECT usage_date, workspace_id, tag[1] AS tag_key, tag[2] AS tag_value, billing_origin_product, sku_name, usage_unit,
  {SUMS} FROM tagged GROUP BY ALL""",
    "cost_kpis": _kpis(),
    "event_kpis": """WITH days AS (
  SELECT event_type, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(12,2)) AS amount FROM events
)
SELECT event_type, max(day) AS latest_usage_date,
  CAST(sum(CASE WHEN day = DATE '2024-01-20' THEN amount ELSE 0 END) AS DOUBLE) AS value_today,
  CAST(sum(CASE WHEN day BETWEEN DATE '2024-01-01' AND DATE '2024-01-20' THEN amount ELSE 0 END) AS DOUBLE) AS value_mtd,
  CAST(sum(CASE WHEN day BETWEEN DATE '2024-01-14' AND DATE '2024-01-20' THEN amount ELSE 0 END) AS DOUBLE)
    AS value_last_7_days,
  CAST(sum(CASE WHEN day BETWEEN DATE '2024-01-07' AND DATE '2024-01-13' THEN amount ELSE 0 END) AS DOUBLE)
    AS value_previous_7_days,
  CAST(sum(CASE WHEN day BETWEEN DATE '2023-12-01' AND DATE '2023-12-31' THEN amount ELSE 0 END) AS DOUBLE)
    AS value_previous_month
FROM days GROUP BY event_type""",
    "job_runs": f"""WITH {PERIODS}, {JOBS}, collapsed AS (
  SELECT workspace_id, job_id, l_orderkey AS run_id, min(period_start) AS run_start_time,
    max(period_end) AS run_end_time, max(o_orderpriority) AS trigger_type, max(l_returnflag) AS run_type,
    'run-' || l_orderkey AS run_name, max(result_state) AS result_state, max(termination_code) AS termination_code,
    max(l_linestatus) AS termination_type, max(l_linenumber) AS setup_duration_seconds,
    max(CASE WHEN l_linestatus = 'O' THEN 0 END) AS queue_duration_seconds,
    max(execution) AS execution_duration_seconds,
    max(CASE WHEN l_linestatus = 'F' THEN l_linenumber END) AS cleanup_duration_seconds,
    CAST(sum(seconds) AS BIGINT) AS run_duration_seconds,
    greatest(count(result_state) - 1, 0) AS repair_count
  FROM periods GROUP BY workspace_id, job_id, l_orderkey
)
SELECT r.workspace_id, r.job_id, job_name, r.* EXCLUDE (workspace_id, job_id),
  CAST(run_start_time AS DATE) AS run_date, creator_user_name, run_as_user_name, paused
FROM collapsed r LEFT JOIN (SELECT * EXCLUDE (trigger_type) FROM latest_jobs) j
  ON r.workspace_id = j.workspace_id AND r.job_id = j.job_id""",
    "job_tasks": f"""WITH {PERIODS}, {JOBS}, collapsed AS (
  SELECT workspace_id, job_id, l_orderkey AS job_run_id, l_orderkey * 10 + l_linenumber AS task_run_id,
    'task_' || l_linenumber AS task_key, min(period_start) AS task_start_time, max(period_end) AS task_end_time,
    max(l_linenumber) AS setup_duration_seconds, max(execution) AS execution_duration_seconds,
    max(CASE WHEN l_linestatus = 'F' THEN l_linenumber END) AS cleanup_duration_seconds,
    max(result_state) AS result_state, max(termination_code) AS termination_code,
    max(l_linestatus) AS termination_type,
    (array_agg(l_suppkey || ',' || l_partkey ORDER BY period_start, period_end,
      CAST(l_suppkey AS VARCHAR), CAST(l_partkey AS VARCHAR)) FILTER (WHERE l_returnflag <> 'A'))[1] AS compute_ids
  FROM periods GROUP BY workspace_id, job_id, l_orderkey, l_linenumber
)
SELECT t.workspace_id, t.job_id, job_name, t.* EXCLUDE (workspace_id, job_id),
  CAST(task_start_time AS DATE) AS task_date,
  CAST(date_diff('second', task_start_time, task_end_time) AS BIGINT) AS task_duration_seconds
FROM collapsed t LEFT JOIN latest_jobs j ON t.workspace_id = j.workspace_id AND t.job_id = j.job_id""",
    "compute_utilization": f"""WITH {CLUSTERS}, current AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY workspace_id, cluster_id
    ORDER BY change_time DESC, change_id DESC) AS rn FROM clusters) WHERE rn = 1
), nodes AS (
  SELECT c_nationkey AS workspace_id, CAST(o_custkey AS VARCHAR) AS cluster_id, l_suppkey, l_orderkey, l_partkey,
    CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS metric_time, l_linenumber = 1 AS driver,
    l_quantity + l_linenumber AS cpu, l_quantity, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS sent
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
), load AS (
  SELECT workspace_id, cluster_id, metric_time, count(DISTINCT l_suppkey) AS node_count,
    {_avg2("cpu")} AS avg_cpu_percent, max(cpu) AS max_cpu_percent,
    {_avg2("l_quantity / 2")} AS avg_cpu_wait_percent, {_avg2("l_partkey")} AS avg_memory_percent,
    CAST(max(l_partkey) AS DOUBLE) AS max_memory_percent, CAST(max(l_linenumber) AS DOUBLE) AS max_swap_percent,
    {_avg2("cpu", "driver")} AS avg_driver_cpu_percent, {_avg2("cpu", "NOT driver")} AS avg_worker_cpu_percent,
    CAST(sum(sent) AS BIGINT) AS network_sent_bytes, CAST(sum(l_orderkey) AS BIGINT) AS network_received_bytes
  FROM nodes GROUP BY 1, 2, 3
)
SELECT l.*, CAST(metric_time AS DATE) AS metric_date, cluster_name, owned_by, cluster_source
FROM load l LEFT JOIN current c ON l.workspace_id = c.workspace_id AND l.cluster_id = c.cluster_id""",
    "query_performance": f"""SELECT conv_id AS workspace_id, conv_id || '-' || turn AS statement_id,
  CAST(TIMESTAMP '2024-01-01' + to_minutes(conv_id) + to_seconds(turn) AS DATE) AS query_date,
  TIMESTAMP '2024-01-01' + to_minutes(conv_id) + to_seconds(turn) AS start_time,
  TIMESTAMP '2024-01-01' + to_minutes(conv_id) + to_seconds(turn + 5) AS end_time,
  role AS execution_status, upper(role) AS statement_type, role AS executed_by, 'as-' || role AS executed_as,
  'chat' AS client_application, left(text, 500) AS statement_preview, role AS compute_type,
  CASE WHEN role <> 'user' THEN CAST(conv_id AS VARCHAR) END AS warehouse_id,
  CASE WHEN role = 'user' THEN CAST(conv_id AS VARCHAR) END AS cluster_id,
  CAST(length(text) AS INTEGER) AS total_duration_ms,
  CASE WHEN role = 'user' THEN turn END AS waiting_for_compute_duration_ms,
  CASE WHEN role <> 'system' THEN turn * 2 END AS waiting_at_capacity_duration_ms,
  turn AS compilation_duration_ms, CAST(length(text) AS INTEGER) AS execution_duration_ms,
  CAST(length(text) * 2 AS INTEGER) AS total_task_duration_ms,
  CASE WHEN role = 'user' THEN turn ELSE 0 END + CASE WHEN role <> 'system' THEN turn * 2 ELSE 0 END
    AS total_waiting_duration_ms,
  {", ".join(f"CAST(length(text) + {i} AS INTEGER) AS {c}" for i, c in enumerate(HISTORY_COUNTS))},
  turn AS read_io_cache_percent, role = 'assistant' AS from_result_cache,
  {", ".join(f"turn + {i} AS {c}" for i, c in enumerate(HISTORY_VOLUMES))},
  CASE WHEN role = 'system' THEN 'none' END AS error_message, conv_id AS source_job_id, turn AS source_job_run_id,
  conv_id + turn AS source_job_task_run_id, role AS source_notebook_id, CAST(NULL AS VARCHAR) AS source_dashboard_id
FROM conversations""",
    "security_events": """WITH audit AS (
  SELECT *, CASE event_type WHEN 'signup' THEN 'grantAccess' WHEN 'purchase' THEN 'createToken'
      WHEN 'error' THEN 'DeleteTable' WHEN 'view' THEN 'getTable' ELSE 'listTables' END AS action_name,
    CASE WHEN event_type <> 'view' THEN CAST(floor(value * 5) AS INTEGER) END AS code
  FROM events
)
SELECT 'account' AS account_id, user_id AS workspace_id, CAST(ts AS DATE) AS event_date, ts AS event_time,
  'service' AS service_name, action_name, 'user' || user_id || '@example.com' AS actor, event_type AS run_by,
  CAST(user_id AS VARCHAR) AS run_as, '10.0.0.1' AS source_ip_address, event_type AS user_agent,
  'WORKSPACE_LEVEL' AS audit_level, 'req-' || event_id AS request_id, event_id,
  json_extract_string(props, '$.k') AS request_params, CAST(code AS VARCHAR) AS response_status_code,
  CASE WHEN event_type = 'error' THEN 'failed' END AS response_error_message,
  CASE WHEN code >= 400 THEN 'ERROR'
       WHEN regexp_matches(lower(action_name), 'grant|revoke|permission|privilege|delete|remove|token|secret')
       THEN 'SENSITIVE' ELSE 'STANDARD' END AS event_category
FROM audit""",
    "data_lineage": f"""SELECT o_custkey AS workspace_id, CAST(o_orderdate AS DATE) AS event_date,
  o_orderdate AS event_time, o_orderstatus AS entity_type, CAST(o_custkey AS VARCHAR) AS entity_id,
  CAST(o_orderkey AS VARCHAR) AS entity_run_id, {_lineage_side("source", "bronze")},
  {_lineage_side("target", "silver")}, 'user' || o_custkey AS created_by, 'st-' || o_orderkey AS statement_id,
  o_orderstatus = 'O' AS direct_access, o_orderkey AS event_id, o_orderkey AS record_id FROM orders""",
    "asof_signup": """WITH ranked AS (
  SELECT b.event_id, b.user_id, b.ts, s.ts AS signup_ts, s.event_id AS signup_id, s.value AS signup_value,
    row_number() OVER (PARTITION BY b.event_id ORDER BY s.ts DESC, s.event_id DESC) AS rn
  FROM events b LEFT JOIN events s ON s.event_type = 'signup' AND b.user_id = s.user_id AND s.ts <= b.ts
  WHERE b.event_type = 'purchase'
)
SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1""",
    "cdc_insert_new": f"""WITH {CDC}
SELECT transaction_id, payment_id, CAST(amount AS DOUBLE) AS amount, sequence_num, false AS _is_deleted,
  'unchanged' AS _action FROM target
UNION ALL SELECT transaction_id, payment_id, CAST(amount AS DOUBLE), NULL, NULL, 'inserted' FROM events_in
WHERE operation = 'INSERT' AND transaction_id NOT IN (SELECT transaction_id FROM target)""",
    "cdc_upsert_newer": f"""WITH {CDC}, {_latest()}
SELECT coalesce(t.transaction_id, s.transaction_id) AS transaction_id,
  CASE WHEN t.transaction_id IS NULL OR s.sequence_num > t.sequence_num THEN s.payment_id ELSE t.payment_id END
    AS payment_id,
  CAST(CASE WHEN t.transaction_id IS NULL OR s.sequence_num > t.sequence_num THEN s.amount ELSE t.amount END AS DOUBLE)
    AS amount,
  CASE WHEN t.transaction_id IS NULL OR s.sequence_num > t.sequence_num THEN s.sequence_num ELSE t.sequence_num END
    AS sequence_num,
  CASE WHEN t.transaction_id IS NULL THEN 'inserted' WHEN s.sequence_num > t.sequence_num THEN 'updated'
    ELSE 'unchanged' END AS _action
FROM target t FULL OUTER JOIN latest s ON t.transaction_id = s.transaction_id""",
    "cdc_versioned_update": f"""WITH {CDC}, {_latest("UPDATE")}
SELECT t.transaction_id, CASE WHEN newer THEN s_payment ELSE t.payment_id END AS payment_id,
  CAST(CASE WHEN newer THEN s_amount ELSE t.amount END AS DOUBLE) AS amount,
  CASE WHEN newer THEN s_seq ELSE t.sequence_num END AS sequence_num, false AS _is_deleted,
  CASE WHEN newer THEN TIMESTAMP '2026-02-01 08:00:00' ELSE applied END AS _applied_at,
  CASE WHEN newer THEN 'updated' ELSE 'unchanged' END AS _action
FROM (SELECT t.*, s.payment_id AS s_payment, s.amount AS s_amount, s.sequence_num AS s_seq,
        coalesce(s.sequence_num > t.sequence_num, false) AS newer
      FROM target t LEFT JOIN latest s ON t.transaction_id = s.transaction_id) t""",
    "cdc_versioned_delete": f"""WITH {CDC}, {_latest("DELETE")}
SELECT t.transaction_id, t.payment_id, CAST(t.amount AS DOUBLE) AS amount, t.sequence_num, false AS _is_deleted,
  applied AS _applied_at
FROM target t LEFT JOIN latest s ON t.transaction_id = s.transaction_id AND s.sequence_num > t.sequence_num
WHERE s.transaction_id IS NULL""",
    "cdc_apply_ops": f"""WITH {CDC}, {_latest()}
SELECT coalesce(t.transaction_id, s.transaction_id) AS transaction_id,
  CASE WHEN t.transaction_id IS NULL OR s.operation = 'UPDATE' THEN s.payment_id ELSE t.payment_id END AS payment_id,
  CAST(CASE WHEN t.transaction_id IS NULL OR s.operation = 'UPDATE' THEN s.amount ELSE t.amount END AS DOUBLE) AS amount
FROM target t FULL OUTER JOIN latest s ON t.transaction_id = s.transaction_id
WHERE CASE WHEN t.transaction_id IS NULL THEN s.operation = 'INSERT'
           ELSE coalesce(s.operation, '') <> 'DELETE' END""",
    "cdc_mixed_state": f"{MIXED} SELECT {MIXED_ROWS}, _is_deleted, _applied_at, _action FROM merged",
    "cdc_mixed_broadcast": f"{MIXED} SELECT {MIXED_ROWS}, _is_deleted, _applied_at, _action FROM merged",
    "cdc_merge_metrics": f"""{MIXED} SELECT count(*) FILTER (WHERE _action = 'inserted') AS inserted_rows,
  count(*) FILTER (WHERE _action = 'updated') AS updated_rows, CAST(0 AS BIGINT) AS deleted_rows FROM merged""",
    "cdc_active": f"{MIXED} SELECT {MIXED_ROWS}, _applied_at FROM merged WHERE NOT _is_deleted",
    "cdc_gold": f"""{MIXED} SELECT count(*) AS transaction_count, CAST(sum(amount_dec) AS DOUBLE) AS total_amount
FROM merged WHERE NOT _is_deleted""",
    "cdc_payments_daily": f"""WITH {CDC}, {_latest("DELETE")}
SELECT DATE '1995-01-01' + CAST(t.sequence_num - 1 AS INTEGER) AS payment_date, 'accepted' AS status,
  count(*) AS payment_count, CAST(sum(t.amount) AS DOUBLE) AS payment_total
FROM target t LEFT JOIN latest s ON t.transaction_id = s.transaction_id AND s.sequence_num > t.sequence_num
WHERE s.transaction_id IS NULL GROUP BY 1, 2""",
    "cdc_business_changes": BUSINESS_CHANGES,
    "cdc_merge_changes": BUSINESS_CHANGES,
    "cdc_delete_audit": f"""WITH {CDC}, {_latest("DELETE")}
SELECT event_id, s.transaction_id, s.sequence_num, 'first_run' AS pass_name,
  CASE WHEN t.transaction_id IS NULL THEN 'ALREADY_ABSENT' WHEN s.sequence_num > t.sequence_num THEN 'DELETED'
       ELSE 'IGNORED_VERSION' END AS outcome
FROM latest s LEFT JOIN target t ON t.transaction_id = s.transaction_id""",
    "cdc_conflicts": f"""WITH {CDC}, distinct_states AS (
  SELECT DISTINCT transaction_id, sequence_num, operation, payment_id, amount FROM events_in)
SELECT transaction_id, sequence_num, count(*) AS states FROM distinct_states GROUP BY 1, 2 HAVING count(*) > 1""",
    "cdc_invalid_events": f"""WITH {CDC} SELECT operation, count(*) AS invalid_rows FROM events_in
WHERE operation = 'DELETE' GROUP BY 1""",
    "window_count_batch": WINDOW_COUNT,
    "stream_window_count": CLOSED_WINDOWS,
    "stream_user_count": "SELECT user_id, count(*) AS count FROM events GROUP BY 1",
    "interval_join_batch": PAIRS,
    "stream_interval_join": PAIRS,
    "interval_delay_check": f"""SELECT count(*) AS matched_rows, CAST(0 AS BIGINT) AS invalid_matches,
  CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM ({PAIRS})""",
    "stream_landing_route": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status,
  CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS channel,
  CASE WHEN o_orderstatus <> 'P' THEN make_date(CAST(year(o_orderdate) AS BIGINT), 1, 1) END AS ingestion_date,
  CASE WHEN o_orderstatus = 'P' THEN 'INVALID_SOURCE_PATH' END AS _quarantine_reason
FROM orders""",
    "progress_status": """SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(hour(ts) AS INTEGER) AS hour,
  count(*) * 600 AS batch_duration_ms,
  CASE WHEN count(*) * 600 > 5000 THEN 'FALLING_BEHIND' ELSE 'KEEPING_UP' END AS status
FROM events GROUP BY 1, 2""",
    "table_history": """SELECT * EXCLUDE (rn) FROM (
  SELECT table_name, timestamp, written_rows, version,
    row_number() OVER (PARTITION BY table_name ORDER BY version DESC) AS rn
  FROM (SELECT o_orderstatus AS table_name, o_orderdate AS timestamp, count(*) AS written_rows,
          CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS version
        FROM orders GROUP BY 1, 2)) WHERE rn <= 20""",
    "file_layout": """SELECT 'per_supplier' AS layout, CAST(sum(n) AS BIGINT) AS rows, count(*) AS source_files,
  max(n) AS largest_file_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey)
UNION ALL SELECT 'per_order', CAST(sum(n) AS BIGINT), count(*), max(n)
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)""",
    "landing_paths": """SELECT o_orderkey AS order_id, 's3://lake/orders/' ||
    CASE WHEN o_orderstatus = 'P' THEN 'ingestion_dt=' ELSE 'ingestion_date=' END ||
    strftime(o_orderdate, '%Y-%m-%d') || '/batch_' || o_custkey || '/orders.csv' AS _source_file,
  CASE WHEN o_orderstatus = 'P' THEN 'INVALID_SOURCE_PATH' END AS _quarantine_reason,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS ingestion_date
FROM orders""",
    "orders_evolved": """SELECT o_orderkey, o_orderstatus,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS channel FROM orders""",
    "pipeline_orders_daily": f"""WITH {BRONZE}
SELECT order_date, status, count(*) AS order_count FROM silver GROUP BY 1, 2""",
    "pipeline_transactions": f"{MIXED} SELECT {MIXED_ROWS}, _is_deleted, _applied_at FROM merged",
    "pipeline_transactions_bucketed": f"{MIXED} SELECT {MIXED_ROWS}, _is_deleted, _applied_at FROM merged",
    "stream_key_join": """SELECT o_orderkey AS order_id, o_orderdate AS order_time, l_linenumber AS line,
  l_shipdate AS ship_time FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "stream_late_rows": f"""SELECT *, (SELECT count(DISTINCT (date_trunc('hour', ts - INTERVAL 14 DAYS), event_type))
  FROM events) AS late_groups FROM ({CLOSED_WINDOWS})""",
    "stream_checkpoint_loss": """SELECT 'bronze' AS layer, 2 * count(*) AS total_rows,
  count(DISTINCT event_id) AS distinct_keys, 2 * count(*) - count(DISTINCT event_id) AS duplicate_rows,
  2 * count(event_id) - count(DISTINCT event_id) AS surplus_rows, 2 * (count(*) - count(event_id)) AS null_keys
FROM events
UNION ALL SELECT 'silver', count(DISTINCT event_id), count(DISTINCT event_id), 0, 0, 0 FROM events""",
    "stream_processed_values": """SELECT count(*) AS output_rows, CAST(0 AS BIGINT) AS invalid_rows, 'PASS' AS result
FROM events""",
    "stream_landing_late_files": "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status FROM orders",
    "stream_landing_headers": """SELECT l_orderkey AS order_id, CAST(l_linenumber AS INTEGER) AS line,
  CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) END AS quantity,
  CASE WHEN l_returnflag = 'A' THEN
    '{"Quantity":"' || CAST(l_quantity AS BIGINT) || '","extra":"' || l_linestatus || '"}' END AS _rescued_data
FROM lineitem""",
    "effective_far_end": """SELECT 'term ' || o_orderstatus AS term, count(*) AS orders, min(o_orderdate) AS since
FROM orders GROUP BY o_orderstatus""",
    "asof_map": """WITH ranked AS (
  SELECT b.event_id, b.event_type AS kind, s.event_id AS signup_id,
    row_number() OVER (PARTITION BY b.event_id ORDER BY s.ts DESC, s.event_id DESC) AS rn
  FROM events b LEFT JOIN events s ON s.event_type = 'signup' AND b.user_id = s.user_id AND s.ts <= b.ts
  WHERE b.event_type = 'purchase'
)
SELECT event_id, kind, signup_id FROM ranked WHERE rn = 1""",
    "compacted_orders": """SELECT o_orderkey, o_orderstatus,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS channel FROM orders""",
    "page_paths": "SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https://[^/]+/en/')",
    "late_shipments": """SELECT o_orderkey AS order_id, o_orderdate, l_linenumber, l_shipdate
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE l_shipdate < o_orderdate OR l_shipdate > o_orderdate + INTERVAL 30 DAYS""",
    "nation_snapshot": "SELECT n_nationkey, n_name FROM nation",
    "source_files": """SELECT 'orders' AS source, count(*) AS rows, count(*) AS stamped FROM orders
UNION ALL SELECT 'lineitem', count(*), count(*) FROM lineitem""",
    "lineitem_distinct_orders": "SELECT DISTINCT l_orderkey FROM lineitem",
    "written_table_detail": """SELECT 'lake' AS catalog_name, 'sales' AS schema_name, 'lake.sales.orders' AS table_name,
  'parquet' AS format, count(DISTINCT o_orderstatus) AS num_files, 'o_orderstatus' AS partition_columns, true AS has_bytes
FROM orders""",
    "written_table_history": """SELECT 'orders' AS table_name, version, 'WRITE ' || o_orderstatus AS operation FROM (
  SELECT o_orderstatus, row_number() OVER (ORDER BY o_orderstatus) - 1 AS version FROM (SELECT DISTINCT o_orderstatus FROM orders))
ORDER BY version DESC LIMIT 2""",
    "written_file_layout": """SELECT 'per_status' AS layout, CAST(sum(n) AS BIGINT) AS rows, count(*) AS source_files,
  max(n) AS largest_file_rows FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus)""",
    "stream_progress_log": """SELECT count(*) AS input_rows, 'KEEPING_UP' AS status, true AS few_files
FROM events GROUP BY user_id % 40""",
    "stream_memory_count": "SELECT event_type, count(*) AS count FROM events GROUP BY event_type",
    "concurrent_updates": """SELECT c_custkey AS customer_id,
  CAST(round(c_acctbal * 100) AS BIGINT) + 1 + c_nationkey % 2 AS cents, CAST(2 AS BIGINT) AS sequence_num FROM customer""",
    "concurrent_bucket_updates": "SELECT CAST(2 AS BIGINT) AS sequence_num, count(*) AS orders FROM orders",
    "ledger_landings": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
  CAST(2 AS BIGINT) AS deliveries, CAST(9 AS BIGINT) AS files FROM orders""",
    "catalog_tables": f"SELECT true AS in_schema, table_name FROM ({_TABLE_NAMES} UNION ALL SELECT 'orders_by_status')",
    "catalog_detail": f"""SELECT table_name, true AS in_schema, 'parquet' AS format, '' AS partition_columns,
  CAST(NULL AS BIGINT) AS num_files, n > 0 AS has_bytes FROM ({_TABLE_COUNTS})
UNION ALL SELECT 'orders_by_status', true, 'parquet', 'o_orderstatus', count(DISTINCT o_orderstatus), true FROM orders""",
    "table_detail": f"""SELECT table_name, 'parquet' AS format, CAST(NULL AS VARCHAR) AS schema_name, 0 AS partitions,
  n > 0 AS has_files, true AS in_order FROM ({_TABLE_COUNTS})""",
    "compacted_in_place": """SELECT o_orderstatus, o_orderkey % 10 > 0 AS was_there, count(*) AS rows,
  CAST(1 AS BIGINT) AS files, CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders GROUP BY 1, 2""",
    "duplicate_keys_in_order": """SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, l_suppkey) AS INTEGER) AS place,
  l_suppkey, count(*) AS row_count FROM lineitem GROUP BY l_suppkey HAVING count(*) > 1
ORDER BY row_count DESC, l_suppkey LIMIT 50""",
    "table_schemas": "\nUNION ALL ".join(
        f"""SELECT '{name}' AS table_name, CAST(row_number() OVER () - 1 AS INTEGER) AS place, column_name, {_SPARK_TYPE} AS type
FROM (DESCRIBE {name})"""
        for name in TABLES
    ),
    "cdc_unconditional_delete": f"""WITH {CDC}, {_latest("DELETE")}
SELECT t.transaction_id, t.payment_id, CAST(t.amount AS DOUBLE) AS amount, t.sequence_num, false AS _is_deleted,
  applied AS _applied_at
FROM target t LEFT JOIN latest s ON t.transaction_id = s.transaction_id WHERE s.transaction_id IS NULL""",
    "cdc_resurrected": f"""WITH {CDC},
deletes AS (SELECT transaction_id, max(sequence_num) AS n FROM events_in WHERE operation = 'DELETE' GROUP BY 1),
inserts AS (SELECT transaction_id, max(sequence_num) AS n FROM events_in WHERE operation = 'INSERT' GROUP BY 1)
SELECT t.transaction_id, i.n AS sequence_num, d.n AS deleted_at FROM target t
JOIN deletes d ON d.transaction_id = t.transaction_id AND d.n > t.sequence_num
JOIN inserts i ON i.transaction_id = t.transaction_id AND i.n < d.n""",
}
for _view, _same in (
    ("view_cost_daily", "price_daily"),
    ("view_cost_by_compute", "cost_by_compute"),
    ("view_job_runs", "job_runs"),
    ("view_compute_utilization", "compute_utilization"),
):
    ORACLES[_view] = ORACLES[_same]
ORACLES["audit_log"] = ORACLES["cdc_delete_audit"]


"""The monitoring views as SQL text, for views that a catalog keeps and computes when they are read.

A view that outlives its session is stored as text, so each view of :mod:`tidelake.plans.monitoring`
has its equal here; the tests hold both against each other. Texts name their sources by ``{table}``.
The DataFrame forms cut long histories into slots and slices of time; for a table in which one key
has very many rows they are the better choice.
"""

from __future__ import annotations

from tidelake.functions.rules import SENSITIVE_ACTIONS
from tidelake.operators.costs import CLUSTER_CONFIG

PRICED = """priced AS (
  SELECT u.*, u.usage_quantity * p.pricing.effective_list.`default` AS list_cost
  FROM {facts} u JOIN {{list_prices}} p
    ON u.sku_name = p.sku_name AND u.cloud = p.cloud AND u.usage_unit = p.usage_unit
    AND u.usage_end_time >= p.price_start_time
    AND (p.price_end_time IS NULL OR u.usage_end_time < p.price_end_time)
)"""
TOTALS = "round(sum(usage_quantity), 3) AS {quantity}, round(sum(list_cost), 2) AS list_cost_usd"


def _priced(facts: str = "{usage}") -> str:
    return PRICED.format(facts=facts)


def _totals(quantity: str = "total_usage_quantity") -> str:
    return TOTALS.format(quantity=quantity)


def _grouped(keys: str, quantity: str = "total_usage_quantity", source: str = "priced") -> str:
    return f"SELECT {keys}, {_totals(quantity)} FROM {source} GROUP BY {keys}"


def _latest(table: str, keys: str, where: str = "") -> str:
    """The row of each key that changed last, by the table's tie columns if it has any; ``where`` sees only these rows."""
    return f"""SELECT * EXCEPT (_rank) FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY change_time DESC{{{table}_tie}}) AS _rank FROM {{{table}}}
  ) WHERE _rank = 1{where}"""


CONFIG = ", ".join(CLUSTER_CONFIG)

# Usage and versions of a cluster are put in time order and each record takes the last version before it:
# one exchange, and no record is compared with all versions of its cluster.
_BILLED = "usage_date, usage_start_time, usage_end_time, sku_name, cloud, usage_unit, usage_quantity"

COST_BY_COMPUTE = f"""WITH named AS (
  SELECT {_BILLED}, usage_metadata.node_type AS billed_node_type, workspace_id, usage_metadata.cluster_id AS cluster_id,
    usage_start_time AS _time, 1 AS _fact, NULL AS _version{{clusters_no_ties}}
  FROM {{usage}} WHERE usage_metadata.cluster_id IS NOT NULL
),
versions AS (
  SELECT {", ".join(f"NULL AS {c}" for c in _BILLED.split(", "))}, NULL AS billed_node_type, workspace_id, cluster_id,
    change_time AS _time, 0 AS _fact, struct({CONFIG}) AS _version{{clusters_ties}}
  FROM {{clusters}} WHERE workspace_id IS NOT NULL AND cluster_id IS NOT NULL AND change_time IS NOT NULL
),
configured AS (
  SELECT {_BILLED}, billed_node_type, workspace_id, cluster_id, {", ".join(f"_known.{c}" for c in CLUSTER_CONFIG)}
  FROM (
    SELECT *, last_value(_version, true) OVER (PARTITION BY workspace_id, cluster_id
      ORDER BY _time, _fact{{clusters_tie_order}} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _known
    FROM (SELECT * FROM named UNION ALL SELECT * FROM versions)
  ) WHERE _fact = 1
),
{_priced("configured")}
{_grouped(f"usage_date, workspace_id, cluster_id, {CONFIG}, sku_name, billed_node_type, usage_unit")}"""

COST_BY_JOB = f"""WITH of_jobs AS (
  SELECT *, usage_metadata.job_id AS job_id, usage_metadata.job_run_id AS job_run_id FROM {{usage}}
  WHERE billing_origin_product = 'JOBS' AND usage_metadata.job_id IS NOT NULL
),
{_priced("of_jobs")},
per_job AS (
  SELECT usage_date, workspace_id, job_id, sku_name, usage_unit, count(DISTINCT job_run_id) AS run_count, {_totals()}
  FROM priced GROUP BY usage_date, workspace_id, job_id, sku_name, usage_unit
),
known AS ({_latest("jobs", "workspace_id, job_id", " AND delete_time IS NULL")})
SELECT usage_date, p.workspace_id, p.job_id, k.name AS job_name, creator_user_name, run_as_user_name, trigger_type,
  paused, sku_name, usage_unit, run_count, total_usage_quantity, list_cost_usd
FROM per_job p LEFT JOIN known k ON p.workspace_id = k.workspace_id AND p.job_id = k.job_id"""

COST_BY_TAG = f"""WITH {_priced()},
tagged AS (SELECT * FROM priced LATERAL VIEW explode(custom_tags) AS tag_key, tag_value)
{_grouped("usage_date, workspace_id, tag_key, tag_value, billing_origin_product, sku_name, usage_unit", source="tagged")}"""

_MONTH = "trunc(current_date(), 'MM')"
_PERIODS = {
    "today": "usage_date = current_date()",
    "mtd": f"usage_date BETWEEN {_MONTH} AND current_date()",
    "last_7_days": "usage_date BETWEEN date_sub(current_date(), 6) AND current_date()",
    "previous_7_days": "usage_date BETWEEN date_sub(current_date(), 13) AND date_sub(current_date(), 7)",
    "previous_month": f"usage_date >= add_months({_MONTH}, -1) AND usage_date < {_MONTH}",
}
_MEASURES = {"cost": "list_cost", "dbu": "CASE WHEN usage_unit = 'DBU' THEN usage_quantity ELSE 0 END"}
_SUMS = ",\n    ".join(
    f"sum(CASE WHEN {during} THEN {value} ELSE 0 END) AS {name}_{period}"
    for name, value in _MEASURES.items()
    for period, during in _PERIODS.items()
)

COST_KPIS = f"""WITH {_priced()},
sums AS (
  SELECT workspace_id, max(usage_date) AS latest_usage_date,
    {_SUMS}
  FROM priced GROUP BY workspace_id
),
observed AS (
  SELECT *, cost_mtd / nullif(CASE WHEN latest_usage_date >= {_MONTH}
    THEN datediff(least(latest_usage_date, current_date()), {_MONTH}) + 1 ELSE 0 END, 0) AS daily FROM sums
)
SELECT workspace_id, current_date() AS dashboard_date, latest_usage_date,
  round(cost_today, 2) AS cost_today_usd, round(dbu_today, 3) AS dbu_today,
  round(cost_mtd, 2) AS cost_mtd_usd, round(dbu_mtd, 3) AS dbu_mtd,
  round(cost_last_7_days, 2) AS cost_last_7_days_usd, round(cost_previous_7_days, 2) AS cost_previous_7_days_usd,
  round(100 * (cost_last_7_days - cost_previous_7_days) / nullif(cost_previous_7_days, 0), 2) AS cost_7d_change_pct,
  round(daily, 2) AS avg_daily_cost_mtd_usd,
  round(daily * day(last_day(current_date())), 2) AS forecast_month_end_usd,
  round(cost_previous_month, 2) AS previous_month_cost_usd
FROM observed"""


def _greatest(*columns: str) -> str:
    return ", ".join(f"max({c}) AS {c}" for c in columns)


JOB_RUNS = f"""WITH collapsed AS (
  SELECT workspace_id, job_id, run_id, min(period_start_time) AS run_start_time, max(period_end_time) AS run_end_time,
    {_greatest("trigger_type", "run_type", "run_name", "result_state", "termination_code", "termination_type")},
    CAST(sum(period_end_time - period_start_time) AS BIGINT) AS run_duration_seconds,
    {_greatest(*[f"{p}_duration_seconds" for p in ("setup", "queue", "execution", "cleanup")])},
    greatest(count_if(result_state IS NOT NULL) - 1, 0) AS repair_count
  FROM {{job_run_timeline}} GROUP BY workspace_id, job_id, run_id
),
known AS ({_latest("jobs", "workspace_id, job_id")})
SELECT r.workspace_id, r.job_id, k.name AS job_name, run_id, CAST(run_start_time AS DATE) AS run_date, run_start_time,
  run_end_time, r.trigger_type, run_type, run_name, result_state, termination_code, termination_type,
  setup_duration_seconds, queue_duration_seconds, execution_duration_seconds, cleanup_duration_seconds,
  run_duration_seconds, repair_count, creator_user_name, run_as_user_name, paused
FROM collapsed r LEFT JOIN known k ON r.workspace_id = k.workspace_id AND r.job_id = k.job_id"""

JOB_TASKS = f"""WITH collapsed AS (
  SELECT workspace_id, job_id, job_run_id, run_id AS task_run_id, task_key,
    min(period_start_time) AS task_start_time, max(period_end_time) AS task_end_time,
    {_greatest("result_state", "termination_code", "termination_type")},
    {_greatest(*[f"{p}_duration_seconds" for p in ("setup", "execution", "cleanup")])},
    min(CASE WHEN compute_ids IS NOT NULL THEN struct(period_start_time, period_end_time, compute_ids) END) AS first_known
  FROM {{job_task_run_timeline}} GROUP BY workspace_id, job_id, job_run_id, run_id, task_key
),
known AS ({_latest("jobs", "workspace_id, job_id")})
SELECT t.workspace_id, t.job_id, k.name AS job_name, job_run_id, task_run_id, task_key,
  CAST(task_start_time AS DATE) AS task_date, task_start_time, task_end_time,
  unix_timestamp(task_end_time) - unix_timestamp(task_start_time) AS task_duration_seconds,
  setup_duration_seconds, execution_duration_seconds, cleanup_duration_seconds,
  result_state, termination_code, termination_type, first_known.compute_ids AS compute_ids
FROM collapsed t LEFT JOIN known k ON t.workspace_id = k.workspace_id AND t.job_id = k.job_id"""

_CPU = "cpu_user_percent + cpu_system_percent"

# Counting nodes apart takes two rounds of grouping, and rows are narrower than sums: the rows move, once.

COMPUTE_UTILIZATION = f"""WITH load AS (
  SELECT workspace_id, cluster_id, start_time AS metric_time, count(DISTINCT instance_id) AS node_count,
    round(avg({_CPU}), 2) AS avg_cpu_percent, round(max({_CPU}), 2) AS max_cpu_percent,
    round(avg(cpu_wait_percent), 2) AS avg_cpu_wait_percent,
    round(avg(mem_used_percent), 2) AS avg_memory_percent, round(max(mem_used_percent), 2) AS max_memory_percent,
    round(max(mem_swap_percent), 2) AS max_swap_percent,
    round(avg(CASE WHEN driver THEN {_CPU} END), 2) AS avg_driver_cpu_percent,
    round(avg(CASE WHEN NOT driver THEN {_CPU} END), 2) AS avg_worker_cpu_percent,
    sum(network_sent_bytes) AS network_sent_bytes, sum(network_received_bytes) AS network_received_bytes
  FROM (SELECT /*+ REPARTITION(workspace_id, cluster_id, start_time) */ * FROM {{node_timeline}})
  GROUP BY workspace_id, cluster_id, start_time
),
known AS ({_latest("clusters", "workspace_id, cluster_id")})
SELECT l.*, k.cluster_name, k.owned_by, k.cluster_source, CAST(metric_time AS DATE) AS metric_date
FROM load l LEFT JOIN known k ON l.workspace_id = k.workspace_id AND l.cluster_id = k.cluster_id"""

QUERY_PERFORMANCE = """SELECT workspace_id, statement_id, CAST(start_time AS DATE) AS query_date, start_time, end_time,
  execution_status, statement_type, executed_by, executed_as, client_application,
  left(statement_text, 500) AS statement_preview,
  compute.type AS compute_type, compute.warehouse_id AS warehouse_id, compute.cluster_id AS cluster_id,
  total_duration_ms, waiting_for_compute_duration_ms, waiting_at_capacity_duration_ms, compilation_duration_ms,
  execution_duration_ms, total_task_duration_ms,
  coalesce(waiting_for_compute_duration_ms, 0) + coalesce(waiting_at_capacity_duration_ms, 0) AS total_waiting_duration_ms,
  read_partitions, pruned_files, read_files, read_rows, read_bytes, produced_rows, read_io_cache_percent,
  from_result_cache, shuffle_read_bytes, spilled_local_bytes, written_bytes, written_rows, written_files, error_message,
  query_source.job_info.job_id AS source_job_id, query_source.job_info.job_run_id AS source_job_run_id,
  query_source.job_info.job_task_run_id AS source_job_task_run_id,
  query_source.notebook_id AS source_notebook_id, query_source.dashboard_id AS source_dashboard_id
FROM {query_history}"""

SECURITY_EVENTS = f"""SELECT account_id, workspace_id, event_date, event_time, service_name, action_name,
  user_identity.email AS actor, identity_metadata.run_by AS run_by, identity_metadata.run_as AS run_as,
  source_ip_address, user_agent, audit_level, request_id, event_id, request_params,
  response.status_code AS response_status_code, response.error_message AS response_error_message,
  CASE WHEN try_cast(response.status_code AS INT) >= 400 THEN 'ERROR'
    WHEN lower(action_name) RLIKE '{SENSITIVE_ACTIONS}' THEN 'SENSITIVE' ELSE 'STANDARD' END AS event_category
FROM {{audit}}"""

_SIDES = ", ".join(
    f"{side}_{part}"
    for side in ("source", "target")
    for part in ("type", "table_catalog", "table_schema", "table_name", "table_full_name", "path")
)

DATA_LINEAGE = f"""SELECT workspace_id, event_date, event_time, entity_type, entity_id, entity_run_id, {_SIDES},
  created_by, statement_id, direct_access, event_id, record_id
FROM {{table_lineage}}"""

#: View name -> its text.
VIEW_SQL: dict[str, str] = {
    "finops_cost_daily": f"WITH {_priced()} {_grouped('usage_date, workspace_id', 'total_dbu')}",
    "finops_cost_by_sku": f"WITH {_priced()} "
    + _grouped("usage_date, workspace_id, billing_origin_product, sku_name, usage_unit"),
    "finops_cost_by_compute": COST_BY_COMPUTE,
    "finops_cost_by_job": COST_BY_JOB,
    "finops_cost_by_tag": COST_BY_TAG,
    "finops_cost_kpis": COST_KPIS,
    "job_runs": JOB_RUNS,
    "job_tasks": JOB_TASKS,
    "compute_utilization": COMPUTE_UTILIZATION,
    "query_performance": QUERY_PERFORMANCE,
    "security_events": SECURITY_EVENTS,
    "data_lineage": DATA_LINEAGE,
}

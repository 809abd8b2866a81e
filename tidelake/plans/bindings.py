"""Operational tables in the library's shapes, derived by Spark from the star-schema tables.

The test tables have no billing, job, audit or change tables, so each is read out of whole
tables that behave alike: line items are usage records and run periods, orders are the
histories of clusters and jobs, events are audit records, conversations are statements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EPOCH = "DATE'1995-01-01'"
APPLIED = "TIMESTAMP_NTZ'2026-01-01 08:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw text with the usual faults, and a later delivery of the pending ones."""
    orders = table(spark, sf_dir, "orders")
    day = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
    first = orders.selectExpr(
        "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F'"
        " THEN concat('ORD-', o_orderkey) ELSE CAST(o_orderkey AS STRING) END AS order_id",
        "CAST(o_custkey AS STRING) AS customer_id",
        "CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O'"
        f" THEN concat('n/a ', year(o_orderdate)) ELSE {day} END AS order_date",
        "CASE o_orderstatus WHEN 'F' THEN '  PAID ' WHEN 'O' THEN 'Created'"
        " ELSE CASE WHEN o_orderpriority <> '5-LOW' THEN 'pending' END END AS status",
        f"{day} AS ingestion_date",
        "CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'"
        " THEN concat('{\"priority\":\"', o_orderpriority, '\"}') END AS _rescued_data",
        "o_orderdate AS _ingestion_timestamp",
        "concat('landing/', o_orderpriority) AS _source_file",
    )
    again = orders.filter("o_orderstatus = 'P'").selectExpr(
        "CAST(o_orderkey AS STRING) AS order_id",
        "CAST(o_custkey AS STRING) AS customer_id",
        f"{day} AS order_date",
        "'Shipped' AS status",
        f"{day} AS ingestion_date",
        "CAST(NULL AS STRING) AS _rescued_data",
        "o_orderdate + INTERVAL 30 DAYS AS _ingestion_timestamp",
        "'landing/redelivery' AS _source_file",
    )
    return first.unionByName(again)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order's customer and that customer's nation."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One billing record per line item."""
    return _lines(spark, sf_dir).selectExpr(
        "CAST(l_shipdate AS DATE) AS usage_date",
        "c_nationkey AS workspace_id",
        "l_shipdate + make_dt_interval(0, l_linenumber, 0, 0) AS usage_start_time",
        "l_shipdate + make_dt_interval(0, l_linenumber + 1, 0, 0) AS usage_end_time",
        "l_returnflag AS sku_name",
        "l_linestatus AS cloud",
        "CASE WHEN l_returnflag = 'N' THEN 'GB' ELSE 'DBU' END AS usage_unit",
        "CAST(l_quantity AS DECIMAL(18,3)) AS usage_quantity",
        "CASE WHEN l_linestatus = 'F' THEN 'JOBS' ELSE 'ALL_PURPOSE' END AS billing_origin_product",
        "named_struct('cluster_id', CASE WHEN l_returnflag <> 'A' THEN CAST(o_custkey AS STRING) END,"
        " 'node_type', concat('node-', l_linenumber),"
        " 'job_id', CASE WHEN l_returnflag <> 'R' THEN CAST(o_custkey AS STRING) END,"
        " 'job_run_id', CAST(l_orderkey AS STRING)) AS usage_metadata",
        "CASE WHEN l_returnflag = 'A' THEN map('team', l_returnflag, 'env', l_linestatus)"
        " WHEN l_returnflag = 'R' THEN map('team', l_returnflag)"
        " WHEN l_linestatus = 'O' THEN map_from_arrays(CAST(array() AS ARRAY<STRING>), CAST(array() AS ARRAY<STRING>))"
        " END AS custom_tags",
    )


def list_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean unit price per SKU and quarter from 1996 on; the last quarter's price is still open."""
    quarter = table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag AS sku_name",
        "l_linestatus AS cloud",
        "CASE WHEN l_returnflag = 'N' THEN 'GB' ELSE 'DBU' END AS usage_unit",
        "CAST(trunc(CAST(l_shipdate AS DATE), 'QUARTER') AS TIMESTAMP_NTZ) AS price_start_time",
        "CAST(round(l_extendedprice * 100) AS BIGINT) AS cents",
        "CAST(l_quantity AS BIGINT) AS units",
    )
    keys = ["sku_name", "cloud", "usage_unit"]
    history = Window.partitionBy(*keys).orderBy("price_start_time")
    return (
        quarter.filter("price_start_time >= TIMESTAMP_NTZ'1996-01-01 00:00:00'")
        .groupBy(*keys, "price_start_time")
        .agg(F.expr("CAST(sum(cents) div sum(units) AS DECIMAL(12,0))").alias("cents"))
        .withColumn("price_end_time", F.lead("price_start_time").over(history))
        .select(
            *keys,
            "price_start_time",
            "price_end_time",
            F.expr(
                "named_struct('effective_list', named_struct('default', CAST(cents / 100 AS DECIMAL(12,2))))"
            ).alias("pricing"),
        )
    )


def _orders_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    return orders.join(customers, orders.o_custkey == customers.c_custkey)


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration change per order; ``change_id`` orders changes of one instant."""
    return _orders_of_customers(spark, sf_dir).selectExpr(
        "c_nationkey AS workspace_id",
        "CAST(o_custkey AS STRING) AS cluster_id",
        "o_orderdate AS change_time",
        "o_orderkey AS change_id",
        "concat('cluster-', o_custkey) AS cluster_name",
        "c_name AS owned_by",
        "o_orderstatus AS cluster_source",
        "o_orderpriority AS driver_node_type",
        "c_mktsegment AS worker_node_type",
        "CAST(floor(o_totalprice / 1000) AS INT) AS worker_count",
        "CASE WHEN o_orderstatus = 'O' THEN 1 END AS min_autoscale_workers",
        "CASE WHEN o_orderstatus = 'O' THEN 8 END AS max_autoscale_workers",
        "concat('v', year(o_orderdate)) AS dbr_version",
        "CASE WHEN o_orderstatus = 'F' THEN 'SINGLE' ELSE 'SHARED' END AS data_security_mode",
        "CASE WHEN o_orderpriority < '3' THEN o_orderpriority END AS policy_id",
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job version per order; a pending order is a deletion."""
    return _orders_of_customers(spark, sf_dir).selectExpr(
        "c_nationkey AS workspace_id",
        "CAST(o_custkey AS STRING) AS job_id",
        "o_orderdate AS change_time",
        "o_orderkey AS change_id",
        "concat('job-', o_orderpriority) AS name",
        "c_name AS creator_user_name",
        "c_mktsegment AS run_as_user_name",
        "o_orderpriority AS trigger_type",
        "o_orderstatus = 'O' AS paused",
        "CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS delete_time",
    )


def _period(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    start = "l_shipdate + make_dt_interval(0, l_linenumber, 0, 0)"
    return _lines(spark, sf_dir).selectExpr(
        "c_nationkey AS workspace_id",
        "CAST(o_custkey AS STRING) AS job_id",
        f"{start} AS period_start_time",
        f"{start} + make_dt_interval(0, 0, CAST(l_quantity AS INT), l_linenumber) AS period_end_time",
        "CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS result_state",
        "CASE WHEN l_returnflag = 'R' THEN concat('CODE-', l_linenumber) END AS termination_code",
        "l_linestatus AS termination_type",
        "l_linenumber AS setup_duration_seconds",
        "CAST(l_quantity AS INT) AS execution_duration_seconds",
        "CASE WHEN l_linestatus = 'F' THEN l_linenumber END AS cleanup_duration_seconds",
        *columns,
    )


def run_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a run, its line items the periods."""
    return _period(
        spark,
        sf_dir,
        "l_orderkey AS run_id",
        "o_orderpriority AS trigger_type",
        "l_returnflag AS run_type",
        "concat('run-', l_orderkey) AS run_name",
        "CASE WHEN l_linestatus = 'O' THEN 0 END AS queue_duration_seconds",
    )


def task_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers are the tasks of a run."""
    return _period(
        spark,
        sf_dir,
        "l_orderkey AS job_run_id",
        "l_orderkey * 10 + l_linenumber AS run_id",
        "concat('task_', l_linenumber) AS task_key",
        "CASE WHEN l_returnflag <> 'A' THEN array(CAST(l_suppkey AS STRING), CAST(l_partkey AS STRING)) END AS compute_ids",
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One node sample per line item, on the first of its month."""
    return _lines(spark, sf_dir).selectExpr(
        "c_nationkey AS workspace_id",
        "CAST(o_custkey AS STRING) AS cluster_id",
        "CAST(l_suppkey AS STRING) AS instance_id",
        "CAST(trunc(CAST(l_shipdate AS DATE), 'MM') AS TIMESTAMP_NTZ) AS start_time",
        "l_linenumber = 1 AS driver",
        "l_quantity AS cpu_user_percent",
        "CAST(l_linenumber AS DOUBLE) AS cpu_system_percent",
        "l_quantity / 2 AS cpu_wait_percent",
        "CAST(l_partkey AS DOUBLE) AS mem_used_percent",
        "CAST(l_linenumber AS DOUBLE) AS mem_swap_percent",
        "CAST(round(l_extendedprice * 100) AS BIGINT) AS network_sent_bytes",
        "l_orderkey AS network_received_bytes",
    )


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn is a statement."""
    at = "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(conv_id AS INT), CAST(turn AS INT))"
    asked = "CASE WHEN role = 'user' THEN turn END"
    counts = ["read_partitions", "pruned_files", "read_files", "read_rows", "read_bytes", "produced_rows"]
    volumes = ["shuffle_read_bytes", "spilled_local_bytes", "written_bytes", "written_rows", "written_files"]
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id AS workspace_id",
        "concat(conv_id, '-', turn) AS statement_id",
        f"{at} AS start_time",
        f"{at} + INTERVAL 5 SECONDS AS end_time",
        "role AS execution_status",
        "upper(role) AS statement_type",
        "role AS executed_by",
        "concat('as-', role) AS executed_as",
        "'chat' AS client_application",
        "text AS statement_text",
        "named_struct('type', role, 'warehouse_id', CASE WHEN role <> 'user' THEN CAST(conv_id AS STRING) END,"
        " 'cluster_id', CASE WHEN role = 'user' THEN CAST(conv_id AS STRING) END) AS compute",
        "length(text) AS total_duration_ms",
        f"{asked} AS waiting_for_compute_duration_ms",
        "CASE WHEN role <> 'system' THEN turn * 2 END AS waiting_at_capacity_duration_ms",
        "turn AS compilation_duration_ms",
        "length(text) AS execution_duration_ms",
        "length(text) * 2 AS total_task_duration_ms",
        *[f"length(text) + {i} AS {name}" for i, name in enumerate(counts)],
        "turn AS read_io_cache_percent",
        "role = 'assistant' AS from_result_cache",
        *[f"turn + {i} AS {name}" for i, name in enumerate(volumes)],
        "CASE WHEN role = 'system' THEN 'none' END AS error_message",
        "named_struct('job_info', named_struct('job_id', conv_id, 'job_run_id', turn, 'job_task_run_id', conv_id + turn),"
        " 'notebook_id', role, 'dashboard_id', CAST(NULL AS STRING)) AS query_source",
    )


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is an audit record; its value is the response code."""
    return table(spark, sf_dir, "events").selectExpr(
        "'account' AS account_id",
        "user_id AS workspace_id",
        "CAST(ts AS DATE) AS event_date",
        "ts AS event_time",
        "'service' AS service_name",
        "CASE event_type WHEN 'signup' THEN 'grantAccess' WHEN 'purchase' THEN 'createToken'"
        " WHEN 'error' THEN 'DeleteTable' WHEN 'view' THEN 'getTable' ELSE 'listTables' END AS action_name",
        "named_struct('email', concat('user', user_id, '@example.com')) AS user_identity",
        "named_struct('run_by', event_type, 'run_as', CAST(user_id AS STRING)) AS identity_metadata",
        "'10.0.0.1' AS source_ip_address",
        "event_type AS user_agent",
        "'WORKSPACE_LEVEL' AS audit_level",
        "concat('req-', event_id) AS request_id",
        "event_id",
        "from_json(props, 'map<string,string>') AS request_params",
        "named_struct('status_code', CASE WHEN event_type <> 'view' THEN CAST(CAST(floor(value * 5) AS INT) AS STRING) END,"
        " 'error_message', CASE WHEN event_type = 'error' THEN 'failed' END) AS response",
    )


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is an edge from a raw to a clean table."""
    side = []
    for name, schema in (("source", "bronze"), ("target", "silver")):
        side += [
            f"'TABLE' AS {name}_type",
            f"'lab' AS {name}_table_catalog",
            f"'{schema}' AS {name}_table_schema",
            f"o_orderpriority AS {name}_table_name",
            f"concat('lab.{schema}.', o_orderpriority) AS {name}_table_full_name",
            f"CAST(NULL AS STRING) AS {name}_path",
        ]
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS workspace_id",
        "CAST(o_orderdate AS DATE) AS event_date",
        "o_orderdate AS event_time",
        "o_orderstatus AS entity_type",
        "CAST(o_custkey AS STRING) AS entity_id",
        "CAST(o_orderkey AS STRING) AS entity_run_id",
        *side,
        "concat('user', o_custkey) AS created_by",
        "concat('st-', o_orderkey) AS statement_id",
        "o_orderstatus = 'O' AS direct_access",
        "o_orderkey AS event_id",
        "o_orderkey AS record_id",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State before the batch: settled orders, versioned by their day."""
    return table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").selectExpr(
        "o_orderkey AS transaction_id",
        "o_custkey AS payment_id",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS amount",
        f"CAST(datediff(CAST(o_orderdate AS DATE), {EPOCH}) + 1 AS BIGINT) AS sequence_num",
        "false AS _is_deleted",
        f"{APPLIED} AS _applied_at",
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events: every line item changes its order, versioned by its day."""
    deletes = "l_returnflag = 'R'"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id",
        "l_orderkey AS transaction_id",
        f"CASE WHEN NOT {deletes} THEN l_suppkey END AS payment_id",
        f"CASE WHEN NOT {deletes} THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS amount",
        f"CAST(datediff(CAST(l_shipdate AS DATE), {EPOCH}) + 1 AS BIGINT) AS sequence_num",
        "CASE l_returnflag WHEN 'A' THEN 'INSERT' WHEN 'N' THEN 'UPDATE' ELSE 'DELETE' END AS operation",
        "l_linenumber AS line_no",
        "l_partkey AS part_no",
        "l_suppkey AS supp_no",
    )


# Order of events that share a key and a version, so that one of them is always the last.
CHANGE_TIE = ("line_no", "part_no", "supp_no")

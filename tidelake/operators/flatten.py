"""Flat projections of nested query, audit and lineage records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions.rules import event_category


def query_performance(history: DataFrame) -> DataFrame:
    """One row per statement with waiting time, volumes and the workload that issued it."""
    waiting = F.coalesce("waiting_for_compute_duration_ms", F.lit(0)) + F.coalesce(
        "waiting_at_capacity_duration_ms", F.lit(0)
    )
    job = "query_source.job_info"
    return history.select(
        "workspace_id", "statement_id", F.col("start_time").cast("date").alias("query_date"),
        "start_time", "end_time", "execution_status", "statement_type", "executed_by", "executed_as",
        "client_application", F.left("statement_text", F.lit(500)).alias("statement_preview"),
        F.col("compute.type").alias("compute_type"),
        F.col("compute.warehouse_id").alias("warehouse_id"),
        F.col("compute.cluster_id").alias("cluster_id"),
        "total_duration_ms", "waiting_for_compute_duration_ms", "waiting_at_capacity_duration_ms",
        "compilation_duration_ms", "execution_duration_ms", "total_task_duration_ms",
        waiting.alias("total_waiting_duration_ms"),
        "read_partitions", "pruned_files", "read_files", "read_rows", "read_bytes", "produced_rows",
        "read_io_cache_percent", "from_result_cache", "shuffle_read_bytes", "spilled_local_bytes",
        "written_bytes", "written_rows", "written_files", "error_message",
        F.col(f"{job}.job_id").alias("source_job_id"),
        F.col(f"{job}.job_run_id").alias("source_job_run_id"),
        F.col(f"{job}.job_task_run_id").alias("source_job_task_run_id"),
        F.col("query_source.notebook_id").alias("source_notebook_id"),
        F.col("query_source.dashboard_id").alias("source_dashboard_id"),
    )


def security_events(audit: DataFrame) -> DataFrame:
    """Audit records with actor, response and our own category."""
    code = F.col("response.status_code")
    return audit.select(
        "account_id", "workspace_id", "event_date", "event_time", "service_name", "action_name",
        F.col("user_identity.email").alias("actor"),
        F.col("identity_metadata.run_by").alias("run_by"),
        F.col("identity_metadata.run_as").alias("run_as"),
        "source_ip_address", "user_agent", "audit_level", "request_id", "event_id", "request_params",
        code.alias("response_status_code"),
        F.col("response.error_message").alias("response_error_message"),
        event_category(code, F.col("action_name")).alias("event_category"),
    )


def data_lineage(lineage: DataFrame) -> DataFrame:
    """Source-to-target table edges with the entity that caused them."""
    def side(name: str) -> list[str]:
        table = [f"{name}_table_{part}" for part in ("catalog", "schema", "name", "full_name")]
        return [f"{name}_type", *table, f"{name}_path"]

    return lineage.select(
        "workspace_id", "event_date", "event_time", "entity_type", "entity_id", "entity_run_id",
        *side("source"), *side("target"),
        "created_by", "statement_id", "direct_access", "event_id", "record_id",
    )

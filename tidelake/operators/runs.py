"""Run, task and utilisation views over the timeline tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.operators.costs import latest_jobs
from tidelake.operators.versions import latest_per_key, left_latest

JOB = ["workspace_id", "job_id"]


def collapse_runs(timeline: DataFrame) -> DataFrame:
    """One row per run. The duration adds up the periods, so gaps between them do not count.

    States are the greatest text, not the last one; every result beyond the first is a repair.
    """
    length = F.sum(F.col("period_end_time") - F.col("period_start_time")).cast("long")
    texts = ["trigger_type", "run_type", "run_name", "result_state", "termination_code", "termination_type"]
    phases = ["setup", "queue", "execution", "cleanup"]
    return timeline.groupBy(*JOB, "run_id").agg(
        F.min("period_start_time").alias("run_start_time"),
        F.max("period_end_time").alias("run_end_time"),
        *[F.max(c).alias(c) for c in texts],
        length.alias("run_duration_seconds"),
        *[F.max(f"{p}_duration_seconds").alias(f"{p}_duration_seconds") for p in phases],
        F.greatest(F.count_if(F.col("result_state").isNotNull()) - 1, F.lit(0)).alias("repair_count"),
    )


def job_runs(timeline: DataFrame, jobs: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Collapsed runs with the current job definition, deleted jobs included."""
    current = latest_jobs(jobs, tie=tie).select(
        *JOB, "job_name", "creator_user_name", "run_as_user_name", "paused"
    )
    return left_latest(collapse_runs(timeline), current, JOB).select(
        *JOB, "job_name", "run_id", F.col("run_start_time").cast("date").alias("run_date"),
        "run_start_time", "run_end_time", "trigger_type", "run_type", "run_name",
        "result_state", "termination_code", "termination_type",
        "setup_duration_seconds", "queue_duration_seconds", "execution_duration_seconds",
        "cleanup_duration_seconds", "run_duration_seconds", "repair_count",
        "creator_user_name", "run_as_user_name", "paused",
    )


def collapse_tasks(timeline: DataFrame) -> DataFrame:
    """One row per task run. The duration is end minus start, gaps included.

    ``compute_ids`` is the first known one by period, which does not depend on row order.
    """
    texts = ["result_state", "termination_code", "termination_type"]
    phases = ["setup", "execution", "cleanup"]
    ids = F.col("compute_ids")
    first_seen = F.when(ids.isNotNull(), F.struct("period_start_time", "period_end_time", "compute_ids"))
    tasks = timeline.groupBy(*JOB, "job_run_id", F.col("run_id").alias("task_run_id"), "task_key").agg(
        F.min("period_start_time").alias("task_start_time"),
        F.max("period_end_time").alias("task_end_time"),
        *[F.max(c).alias(c) for c in texts],
        *[F.max(f"{p}_duration_seconds").alias(f"{p}_duration_seconds") for p in phases],
        F.min(first_seen).alias("_first"),
    )
    span = F.unix_timestamp("task_end_time") - F.unix_timestamp("task_start_time")
    return tasks.withColumns({"compute_ids": F.col("_first.compute_ids"), "task_duration_seconds": span}).drop("_first")


def job_tasks(timeline: DataFrame, jobs: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Collapsed task runs with the current job name."""
    names = latest_jobs(jobs, tie=tie).select(*JOB, "job_name")
    return left_latest(collapse_tasks(timeline), names, JOB).select(
        *JOB, "job_name", "job_run_id", "task_run_id", "task_key",
        F.col("task_start_time").cast("date").alias("task_date"), "task_start_time", "task_end_time",
        "task_duration_seconds", "setup_duration_seconds", "execution_duration_seconds",
        "cleanup_duration_seconds", "result_state", "termination_code", "termination_type", "compute_ids",
    )


def utilization(nodes: DataFrame) -> DataFrame:
    """Load per cluster and minute; driver and workers are averaged apart (NULL when there are none).

    Counting nodes apart takes two rounds of grouping, and rows are narrower than sums: the rows move, once.
    """
    cpu = F.col("cpu_user_percent") + F.col("cpu_system_percent")
    nodes = nodes.repartition("workspace_id", "cluster_id", "start_time")
    return nodes.groupBy("workspace_id", "cluster_id", F.col("start_time").alias("metric_time")).agg(
        F.countDistinct("instance_id").alias("node_count"),
        F.round(F.avg(cpu), 2).alias("avg_cpu_percent"),
        F.round(F.max(cpu), 2).alias("max_cpu_percent"),
        F.round(F.avg("cpu_wait_percent"), 2).alias("avg_cpu_wait_percent"),
        F.round(F.avg("mem_used_percent"), 2).alias("avg_memory_percent"),
        F.round(F.max("mem_used_percent"), 2).alias("max_memory_percent"),
        F.round(F.max("mem_swap_percent"), 2).alias("max_swap_percent"),
        F.round(F.avg(F.when(F.col("driver"), cpu)), 2).alias("avg_driver_cpu_percent"),
        F.round(F.avg(F.when(~F.col("driver"), cpu)), 2).alias("avg_worker_cpu_percent"),
        F.sum("network_sent_bytes").alias("network_sent_bytes"),
        F.sum("network_received_bytes").alias("network_received_bytes"),
    )


def compute_utilization(nodes: DataFrame, clusters: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Utilisation with the cluster's current name and owner, joined after the aggregation."""
    keys = ["workspace_id", "cluster_id"]
    current = latest_per_key(clusters, keys, ["change_time", *tie]).select(
        *keys, "cluster_name", "owned_by", "cluster_source"
    )
    return left_latest(utilization(nodes), current, keys).withColumn(
        "metric_date", F.col("metric_time").cast("date")
    )

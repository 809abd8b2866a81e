"""Billing views: list cost per day, SKU, compute configuration, job, tag, and the period KPIs.

Inputs follow the shapes of the operational tables: ``usage`` and ``list_prices`` (billing),
``clusters`` and ``jobs`` (histories). Costs stay decimal until the final rounding.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.operators.temporal import asof_join, price_join
from tidelake.operators.versions import latest_per_key, left_latest

CLUSTER_CONFIG = (
    "cluster_name",
    "owned_by",
    "cluster_source",
    "driver_node_type",
    "worker_node_type",
    "worker_count",
    "min_autoscale_workers",
    "max_autoscale_workers",
    "dbr_version",
    "data_security_mode",
    "policy_id",
)


def _priced(usage: DataFrame, prices: DataFrame) -> DataFrame:
    cost = F.col("usage_quantity") * F.col("pricing.effective_list.default")
    return price_join(usage, prices).withColumn("list_cost", cost)


def _totals(quantity: str = "total_usage_quantity") -> list[Column]:
    return [
        F.round(F.sum("usage_quantity"), 3).alias(quantity),
        F.round(F.sum("list_cost"), 2).alias("list_cost_usd"),
    ]


def cost_daily(usage: DataFrame, prices: DataFrame) -> DataFrame:
    return _priced(usage, prices).groupBy("usage_date", "workspace_id").agg(*_totals("total_dbu"))


def cost_by_sku(usage: DataFrame, prices: DataFrame) -> DataFrame:
    keys = ["usage_date", "workspace_id", "billing_origin_product", "sku_name", "usage_unit"]
    return _priced(usage, prices).groupBy(*keys).agg(*_totals())


def asof_config(usage: DataFrame, clusters: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Usage with the cluster configuration in force when it started; NULLs before the first one.

    The cluster is the column ``cluster_id`` or, in usage records as they come, the one of their metadata.
    """
    named = usage if "cluster_id" in usage.columns else usage.withColumn("cluster_id", F.col("usage_metadata.cluster_id"))
    return asof_join(
        named,
        clusters,
        ["workspace_id", "cluster_id"],
        "usage_start_time",
        "change_time",
        [*CLUSTER_CONFIG, "change_time"],
        tie,
    )


def cost_by_compute(
    usage: DataFrame, prices: DataFrame, clusters: DataFrame, tie: Sequence[str] = ()
) -> DataFrame:
    """Cost per configuration the cluster had at the time; only usage that names a cluster.

    The configuration is looked up before the price: that step writes its facts, and bare usage is
    narrower than priced usage.
    """
    named = (
        usage.withColumns(
            {
                "cluster_id": F.col("usage_metadata.cluster_id"),
                "billed_node_type": F.col("usage_metadata.node_type"),
            }
        )
        .filter(F.col("cluster_id").isNotNull())
        .select(
            "usage_date", "workspace_id", "cluster_id", "usage_start_time", "usage_end_time",
            "sku_name", "cloud", "usage_unit", "billed_node_type", "usage_quantity",
        )
    )
    keys = [
        "usage_date",
        "workspace_id",
        "cluster_id",
        *CLUSTER_CONFIG,
        "sku_name",
        "billed_node_type",
        "usage_unit",
    ]
    return _priced(asof_config(named, clusters, tie), prices).groupBy(*keys).agg(*_totals())


def latest_jobs(jobs: DataFrame, drop_deleted: bool = False, tie: Sequence[str] = ()) -> DataFrame:
    """Current definition per job; deleted jobs go only when asked for, after the pick."""
    latest = latest_per_key(
        jobs,
        ["workspace_id", "job_id"],
        ["change_time", *tie],
        post_filter=F.col("delete_time").isNull() if drop_deleted else None,
    )
    return latest.withColumnRenamed("name", "job_name")


def cost_by_job(usage: DataFrame, prices: DataFrame, jobs: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Cost and distinct runs per job and day; a deleted job keeps its cost under NULL attributes.

    A job has one current definition, so usage is aggregated per job first and only those
    totals meet the job table.
    """
    of_jobs = usage.withColumns(
        {"job_id": F.col("usage_metadata.job_id"), "job_run_id": F.col("usage_metadata.job_run_id")}
    ).filter((F.col("billing_origin_product") == "JOBS") & F.col("job_id").isNotNull())
    per_job = (
        _priced(of_jobs, prices)
        .groupBy("usage_date", "workspace_id", "job_id", "sku_name", "usage_unit")
        .agg(F.countDistinct("job_run_id").alias("run_count"), *_totals())
    )
    attributes = ["job_name", "creator_user_name", "run_as_user_name", "trigger_type", "paused"]
    current = latest_jobs(jobs, drop_deleted=True, tie=tie).select("workspace_id", "job_id", *attributes)
    return left_latest(per_job, current, ["workspace_id", "job_id"]).select(
        "usage_date", "workspace_id", "job_id", *attributes, "sku_name", "usage_unit",
        "run_count", "total_usage_quantity", "list_cost_usd",
    )


def cost_by_tag(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost per tag: a record with k tags counts k times, an untagged one not at all."""
    tagged = _priced(usage, prices).withColumn("tag", F.explode(F.map_entries("custom_tags")))
    return (
        tagged.withColumns({"tag_key": F.col("tag.key"), "tag_value": F.col("tag.value")})
        .groupBy(
            "usage_date", "workspace_id", "tag_key", "tag_value",
            "billing_origin_product", "sku_name", "usage_unit",
        )
        .agg(*_totals())
    )


def period_sums(df: DataFrame, keys: Sequence[str], day: str, measures: dict[str, Column], as_of: Column) -> DataFrame:
    """Conditional sums of each measure over the standard periods relative to ``as_of``."""
    date, month = F.col(day), F.trunc(as_of, "MM")
    periods = {
        "today": date == as_of,
        "mtd": (date >= month) & (date <= as_of),
        "last_7_days": date.between(F.date_sub(as_of, 6), as_of),
        "previous_7_days": date.between(F.date_sub(as_of, 13), F.date_sub(as_of, 7)),
        "previous_month": (date >= F.add_months(month, -1)) & (date < month),
    }
    sums = [
        F.sum(F.when(during, value).otherwise(0)).alias(f"{name}_{period}")
        for name, value in measures.items()
        for period, during in periods.items()
    ]
    return df.groupBy(*keys).agg(F.max(date).alias("latest_usage_date"), *sums)


def cost_kpis(usage: DataFrame, prices: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Headline numbers per workspace as of a day (today by default)."""
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    dbu = F.when(F.col("usage_unit") == "DBU", F.col("usage_quantity")).otherwise(0)
    sums = period_sums(
        _priced(usage, prices), ["workspace_id"], "usage_date", {"cost": F.col("list_cost"), "dbu": dbu}, today
    )
    month = F.trunc(today, "MM")
    latest = F.col("latest_usage_date")
    observed = F.when(latest >= month, F.datediff(F.least(latest, today), month) + 1).otherwise(0)
    daily = F.col("cost_mtd") / F.nullif(observed, F.lit(0))
    change = 100 * (F.col("cost_last_7_days") - F.col("cost_previous_7_days"))
    return sums.select(
        "workspace_id",
        today.alias("dashboard_date"),
        "latest_usage_date",
        F.round("cost_today", 2).alias("cost_today_usd"),
        F.round("dbu_today", 3).alias("dbu_today"),
        F.round("cost_mtd", 2).alias("cost_mtd_usd"),
        F.round("dbu_mtd", 3).alias("dbu_mtd"),
        F.round("cost_last_7_days", 2).alias("cost_last_7_days_usd"),
        F.round("cost_previous_7_days", 2).alias("cost_previous_7_days_usd"),
        F.round(change / F.nullif(F.col("cost_previous_7_days"), F.lit(0)), 2).alias("cost_7d_change_pct"),
        F.round(daily, 2).alias("avg_daily_cost_mtd_usd"),
        F.round(daily * F.day(F.last_day(today)), 2).alias("forecast_month_end_usd"),
        F.round("cost_previous_month", 2).alias("previous_month_cost_usd"),
    )

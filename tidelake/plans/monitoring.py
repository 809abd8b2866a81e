"""The monitoring views by name, and the table health collection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators import costs, flatten, health, runs
from tidelake.plans.view_sql import VIEW_SQL
from tidelake.sources.tables import history, list_tables, publish

Tables = Mapping[str, DataFrame]

# View name -> the operational tables it reads and how.
VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "finops_cost_daily": lambda t: costs.cost_daily(t["usage"], t["list_prices"]),
    "finops_cost_by_sku": lambda t: costs.cost_by_sku(t["usage"], t["list_prices"]),
    "finops_cost_by_compute": lambda t: costs.cost_by_compute(t["usage"], t["list_prices"], t["clusters"]),
    "finops_cost_by_job": lambda t: costs.cost_by_job(t["usage"], t["list_prices"], t["jobs"]),
    "finops_cost_by_tag": lambda t: costs.cost_by_tag(t["usage"], t["list_prices"]),
    "finops_cost_kpis": lambda t: costs.cost_kpis(t["usage"], t["list_prices"]),
    "job_runs": lambda t: runs.job_runs(t["job_run_timeline"], t["jobs"]),
    "job_tasks": lambda t: runs.job_tasks(t["job_task_run_timeline"], t["jobs"]),
    "compute_utilization": lambda t: runs.compute_utilization(t["node_timeline"], t["clusters"]),
    "query_performance": lambda t: flatten.query_performance(t["query_history"]),
    "security_events": lambda t: flatten.security_events(t["audit"]),
    "data_lineage": lambda t: flatten.data_lineage(t["table_lineage"]),
}


def create_views(
    spark: SparkSession,
    sources: Mapping[str, str],
    schema: str,
    names: Sequence[str] | None = None,
    ties: Mapping[str, Sequence[str]] | None = None,
) -> list[str]:
    """Create or replace the views in ``schema`` over the catalog tables ``sources``.

    The catalog keeps their text: they stay when the session ends, and show what their sources hold
    when they are read. Of ``jobs`` and ``clusters`` rows that changed at one time, the greatest in the
    columns ``ties`` counts.
    """
    known = {name: ".".join(f"`{part}`" for part in source.split(".")) for name, source in sources.items()}
    for name in ("jobs", "clusters"):
        columns = (ties or {}).get(name, ())
        known[f"{name}_tie"] = "".join(f", `{column}` DESC" for column in columns)
        # The same order where versions stand among other rows, which have no ties.
        known[f"{name}_ties"] = "".join(f", `{column}` AS _tie{i}" for i, column in enumerate(columns))
        known[f"{name}_no_ties"] = "".join(f", NULL AS _tie{i}" for i in range(len(columns)))
        known[f"{name}_tie_order"] = "".join(f", _tie{i}" for i in range(len(columns)))
    made = []
    for name in names or VIEW_SQL:
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS {VIEW_SQL[name].format(**known)}")
        made.append(f"{schema}.{name}")
    return made


def register_views(tables: Tables, names: Sequence[str] | None = None) -> list[str]:
    """Create or replace the views as temporary views for SQL users."""
    names = list(names or VIEWS)
    for name in names:
        VIEWS[name](tables).createOrReplaceTempView(name)
    return names


def kpis_as_of(tables: Tables, day: dt.date | str) -> DataFrame:
    """The KPI view as it stood on a given day, which makes it repeatable."""
    return costs.cost_kpis(tables["usage"], tables["list_prices"], day)


def collect_table_health(
    spark: SparkSession,
    root: str,
    schemas: Sequence[str] = (),
    published: Mapping[str, str] | None = None,
    exclude: Sequence[str] = ("table_health_detail", "table_health_history"),
) -> dict[str, DataFrame]:
    """Publish the detail of catalog and published tables, and the last 20 versions of the latter."""
    published = dict(published or {})
    locations = dict(published)
    if schemas:
        locations |= health.catalog_locations(spark, list_tables(spark, schemas, exclude))
    out = {"detail": publish(health.table_detail(spark, locations), f"{root}/table_health_detail", "OVERWRITE")}
    if published:
        logs = [
            history(spark, path).withColumn("table_name", F.lit(name)).drop("location")
            for name, path in published.items()
        ]
        log = logs[0]
        for other in logs[1:]:
            log = log.unionByName(other)
        out["history"] = publish(health.table_history(log), f"{root}/table_health_history", "OVERWRITE")
    return out

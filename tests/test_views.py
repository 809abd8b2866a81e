"""Billing and operations views on the golden cases of the operational tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidelake.operators import costs, flatten, runs
from tidelake.plans import bindings as b
from tidelake.plans import monitoring

D = Decimal


def ts(day, hour=0, minute=0, second=0):
    return dt.datetime(2026, 3, day, hour, minute, second)


@pytest.fixture(scope="module")
def prices(spark):
    rows = [
        ("JOBS_SKU", "GCP", "DBU", ts(1), ts(10), ((D("0.50"),),)),
        ("JOBS_SKU", "GCP", "DBU", ts(10), None, ((D("2.00"),),)),
        ("NET", "GCP", "GB", ts(1), None, ((D("0.10"),),)),
    ]
    return spark.createDataFrame(
        rows,
        "sku_name string, cloud string, usage_unit string, price_start_time timestamp, price_end_time timestamp,"
        " pricing struct<effective_list:struct<default:decimal(12,2)>>",
    )


@pytest.fixture(scope="module")
def usage(spark):
    def row(day, qty, sku="JOBS_SKU", unit="DBU", cluster=None, job=None, run=None, tags=None, end=None, product="JOBS"):
        return (
            dt.date(2026, 3, day), 1, ts(day, 1), end or ts(day, 2), sku, "GCP", unit, D(qty), product,
            (cluster, "n2", job, run), tags,
        )

    rows = [
        row(2, "3.000", cluster="c1", job="j1", run="r1", tags={"team": "a", "env": "dev"}),
        row(2, "1.000", cluster="c1", job="j1", run="r2", tags={"team": "a"}),
        row(2, "1.500", cluster="c1", job="j1", run="r2", tags={}),
        row(10, "1.000", cluster="c1", job="j2", run="r3", end=ts(10)),
        row(12, "4.000", cluster="c2"),
        row(12, "100.000", sku="NET", unit="GB", product="NETWORKING"),
        row(12, "9.000", sku="UNKNOWN"),
    ]
    return spark.createDataFrame(
        rows,
        "usage_date date, workspace_id long, usage_start_time timestamp, usage_end_time timestamp, sku_name string,"
        " cloud string, usage_unit string, usage_quantity decimal(18,3), billing_origin_product string,"
        " usage_metadata struct<cluster_id:string,node_type:string,job_id:string,job_run_id:string>,"
        " custom_tags map<string,string>",
    )


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_cost_daily_and_sku(usage, prices):
    got = table(costs.cost_daily(usage, prices), "usage_date", "total_dbu", "list_cost_usd")
    assert got == [
        (dt.date(2026, 3, 10), D("1.000"), D("2.00")),
        (dt.date(2026, 3, 12), D("104.000"), D("18.00")),
        (dt.date(2026, 3, 2), D("5.500"), D("2.75")),
    ]
    by_sku = table(costs.cost_by_sku(usage, prices).filter("usage_unit = 'GB'"), "billing_origin_product", "list_cost_usd")
    assert by_sku == [("NETWORKING", D("10.00"))]


def test_cost_by_compute_uses_the_config_of_the_time(spark, usage, prices):
    config = {c: None for c in costs.CLUSTER_CONFIG}
    rows = [
        {**config, "workspace_id": 1, "cluster_id": "c1", "change_time": t, "cluster_name": n}
        for t, n in [(ts(1), "old"), (ts(3), "later"), (ts(11), "last")]
    ]
    texts = ", ".join(
        f"{c} {'int' if 'worker' in c and 'type' not in c else 'string'}" for c in costs.CLUSTER_CONFIG
    )
    clusters = spark.createDataFrame(rows, f"workspace_id long, cluster_id string, change_time timestamp, {texts}")
    got = table(
        costs.cost_by_compute(usage, prices, clusters), "cluster_id", "cluster_name", "usage_date", "total_usage_quantity"
    )
    assert got == [
        ("c1", "later", dt.date(2026, 3, 10), D("1.000")),
        ("c1", "old", dt.date(2026, 3, 2), D("5.500")),
        ("c2", None, dt.date(2026, 3, 12), D("4.000")),
    ]


@pytest.fixture(scope="module")
def jobs(spark):
    return spark.createDataFrame(
        [
            (1, "j1", "first", "ann", "svc", "CRON", False, ts(1), None),
            (1, "j1", "renamed", "ann", "svc", "CRON", True, ts(2), None),
            (1, "j2", "gone", "bob", "svc", "MANUAL", False, ts(1), None),
            (1, "j2", "gone", "bob", "svc", "MANUAL", False, ts(5), ts(5)),
        ],
        "workspace_id long, job_id string, name string, creator_user_name string, run_as_user_name string,"
        " trigger_type string, paused boolean, change_time timestamp, delete_time timestamp",
    )


def test_cost_by_job(usage, prices, jobs):
    got = table(costs.cost_by_job(usage, prices, jobs), "job_id", "job_name", "run_count", "list_cost_usd")
    assert got == [("j1", "renamed", 2, D("2.75")), ("j2", None, 1, D("2.00"))]


def test_cost_by_tag(usage, prices):
    got = table(costs.cost_by_tag(usage, prices), "tag_key", "tag_value", "total_usage_quantity")
    assert got == [("env", "dev", D("3.000")), ("team", "a", D("4.000"))]


def test_cost_kpis(usage, prices):
    row = costs.cost_kpis(usage, prices, dt.date(2026, 3, 12)).first()
    assert row.dashboard_date == row.latest_usage_date == dt.date(2026, 3, 12)
    assert (row.cost_today_usd, row.dbu_today) == (D("18.00"), D("4.000"))
    assert (row.cost_mtd_usd, row.dbu_mtd) == (D("22.75"), D("10.500"))
    assert (row.cost_last_7_days_usd, row.cost_previous_7_days_usd) == (D("20.00"), D("2.75"))
    assert row.cost_7d_change_pct == D("627.27")
    assert row.avg_daily_cost_mtd_usd == D("1.90")
    assert row.forecast_month_end_usd == D("58.77")
    assert row.previous_month_cost_usd == D("0.00")
    april = costs.cost_kpis(usage, prices, "2026-04-20").first()
    assert april.previous_month_cost_usd == D("22.75")
    assert april.cost_7d_change_pct is None and april.avg_daily_cost_mtd_usd is None
    assert april.forecast_month_end_usd is None


def test_runs_and_tasks(spark, jobs):
    periods = spark.createDataFrame(
        [
            (1, "j1", 7, "CRON", "JOB", "n", None, None, None, ts(2, 0, 0, 0), ts(2, 0, 1, 30), 0, 0, 0, 0),
            (1, "j1", 7, "CRON", "JOB", "n", "SUCCEEDED", "OK", "t", ts(2, 0, 5), ts(2, 0, 6), 1, 2, 3, 4),
            (1, "j1", 7, "CRON", "JOB", "n", "FAILED", "ERR", "t", ts(2, 0, 8), ts(2, 0, 9), 1, 2, 3, 4),
            (1, "j2", 8, "CRON", "JOB", "n", None, None, None, ts(2), ts(2, 1), 0, 0, 0, 0),
        ],
        "workspace_id long, job_id string, run_id long, trigger_type string, run_type string, run_name string,"
        " result_state string, termination_code string, termination_type string,"
        " period_start_time timestamp, period_end_time timestamp, setup_duration_seconds long,"
        " queue_duration_seconds long, execution_duration_seconds long, cleanup_duration_seconds long",
    )
    got = table(
        runs.job_runs(periods, jobs), "run_id", "job_name", "result_state", "run_duration_seconds", "repair_count"
    )
    # Gaps do not count in runs; the state is the greatest text; deleted jobs keep their name here.
    assert got == [(7, "renamed", "SUCCEEDED", 210, 1), (8, "gone", None, 3600, 0)]

    tasks = periods.selectExpr(
        "workspace_id", "job_id", "run_id AS job_run_id", "run_id * 10 AS run_id", "'t1' AS task_key",
        "period_start_time", "period_end_time", "result_state", "termination_code", "termination_type",
        "setup_duration_seconds", "execution_duration_seconds", "cleanup_duration_seconds",
        "CASE WHEN result_state IS NOT NULL THEN array(result_state) END AS compute_ids",
    )
    got = table(runs.job_tasks(tasks, jobs), "task_run_id", "task_duration_seconds", "compute_ids", "task_date")
    assert got == [
        (70, 540, ["SUCCEEDED"], dt.date(2026, 3, 2)),
        (80, 3600, None, dt.date(2026, 3, 2)),
    ]


def test_utilization(spark):
    nodes = spark.createDataFrame(
        [
            (1, "c", "i1", ts(1), True, 10.0, 5.0, 1.0, 50.0, 0.0, 100, 10),
            (1, "c", "i2", ts(1), False, 30.0, 5.0, 2.0, 70.0, 1.0, 200, 20),
            (1, "c", "i2", ts(1), False, 20.0, 5.0, None, 60.0, 0.0, 300, 30),
            (1, "solo", "i9", ts(1), True, 1.0, 1.0, 1.0, 1.0, 1.0, 1, 1),
        ],
        "workspace_id long, cluster_id string, instance_id string, start_time timestamp, driver boolean,"
        " cpu_user_percent double, cpu_system_percent double, cpu_wait_percent double, mem_used_percent double,"
        " mem_swap_percent double, network_sent_bytes long, network_received_bytes long",
    )
    clusters = spark.createDataFrame(
        [(1, "c", ts(1), "a", "x", "UI"), (1, "c", ts(2), "b", "y", "UI")],
        "workspace_id long, cluster_id string, change_time timestamp, cluster_name string, owned_by string,"
        " cluster_source string",
    )
    rows = {r.cluster_id: r for r in runs.compute_utilization(nodes, clusters).collect()}
    c = rows["c"]
    assert (c.cluster_name, c.owned_by, c.node_count) == ("b", "y", 2)
    assert (c.avg_cpu_percent, c.max_cpu_percent, c.avg_cpu_wait_percent) == (25.0, 35.0, 1.5)
    assert (c.avg_driver_cpu_percent, c.avg_worker_cpu_percent) == (15.0, 30.0)
    assert (c.network_sent_bytes, c.network_received_bytes) == (600, 60)
    assert rows["solo"].avg_worker_cpu_percent is None and rows["solo"].cluster_name is None


def test_statement_preview_and_waiting(spark):
    from tidelake.plans import bindings

    history = bindings.query_history(spark, "/root/testdata/sf0.001")
    flat = flatten.query_performance(history)
    assert flat.filter("length(statement_preview) > 500").count() == 0
    assert flat.filter("total_waiting_duration_ms IS NULL").count() == 0
    assert flat.count() == history.count()


# Views kept by the catalog


def _half(df):
    return F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]), F.lit(2)) == 0


@pytest.fixture(scope="module")
def sources(spark, sf_dir, tmp_path_factory):
    """All sources as catalog tables that hold half of their rows, and how to put in the rest."""
    out = tmp_path_factory.mktemp("views")
    made = {
        "usage": b.usage, "list_prices": b.list_prices, "clusters": b.clusters, "jobs": b.jobs,
        "job_run_timeline": b.run_timeline, "job_task_run_timeline": b.task_timeline, "node_timeline": b.nodes,
        "query_history": b.query_history, "audit": b.audit, "table_lineage": b.lineage,
    }
    frames = {name: make(spark, sf_dir) for name, make in made.items()}
    # The period sums are of today, so usage ends today.
    shift = F.datediff(F.current_date(), F.lit("1998-12-01").cast("date"))
    frames["usage"] = frames["usage"].withColumn("usage_date", F.date_add("usage_date", shift))
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS kept LOCATION '{out}/kept'")
    for name, df in frames.items():
        df.filter(_half(df)).write.option("path", f"{out}/{name}").saveAsTable(f"kept.{name}")

    def complete():
        for name, df in frames.items():
            df.filter(~_half(df)).write.mode("append").option("path", f"{out}/{name}").saveAsTable(f"kept.{name}")

    yield complete
    spark.sql("DROP SCHEMA kept CASCADE")


TIES = {"jobs": ["change_id"], "clusters": ["change_id"]}
TIED = {
    "finops_cost_by_compute": lambda t: costs.cost_by_compute(t["usage"], t["list_prices"], t["clusters"], ["change_id"]),
    "finops_cost_by_job": lambda t: costs.cost_by_job(t["usage"], t["list_prices"], t["jobs"], ["change_id"]),
    "job_runs": lambda t: runs.job_runs(t["job_run_timeline"], t["jobs"], ["change_id"]),
    "job_tasks": lambda t: runs.job_tasks(t["job_task_run_timeline"], t["jobs"], ["change_id"]),
    "compute_utilization": lambda t: runs.compute_utilization(t["node_timeline"], t["clusters"], ["change_id"]),
}


def _rows(df):
    maps = [c for c, t in df.dtypes if t.startswith("map")]
    return sorted(map(repr, df.withColumns({c: F.to_json(c) for c in maps}).collect()))


def test_kept_views_show_what_their_sources_hold(spark, sources):
    names = {name: f"kept.{name}" for name in (
        "usage", "list_prices", "clusters", "jobs", "job_run_timeline", "job_task_run_timeline", "node_timeline",
        "query_history", "audit", "table_lineage",
    )}
    made = monitoring.create_views(spark, names, "kept", ties=TIES)
    assert len(made) == len(monitoring.VIEWS) == 12
    before = {name: spark.table(name).count() for name in made}
    sources()
    # Another session of the catalog reads the text anew.
    other = spark.newSession()
    for name in monitoring.VIEWS:
        tables_now = {s: spark.table(t) for s, t in names.items()}
        want = TIED.get(name, monitoring.VIEWS[name])(tables_now)
        got = other.table(f"kept.{name}")
        assert got.columns == want.columns and [t for _, t in got.dtypes] == [t for _, t in want.dtypes], name
        assert _rows(got) == _rows(want), name
    after = {name: spark.table(name).count() for name in made}
    assert all(after[n] >= before[n] for n in made) and sum(after.values()) > sum(before.values())

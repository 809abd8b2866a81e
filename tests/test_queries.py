"""Every registered query against its SQL, and the shape of the plans at scale."""

import pathlib
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
import oracle  # noqa: E402
from tidelake.plans import bindings as b  # noqa: E402
from tidelake.plans.oracles import ORACLES  # noqa: E402
from tidelake.plans.queries import HALVES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert oracle.compare(con, entry.queries()[name](spark, sf_dir), entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_the_as_of_join_reads_its_facts_once(spark, sf_dir):
    text = plan(entry.queries()["cost_by_compute"](spark, sf_dir))
    # Usage is made of line items with their numbers; what is left reads what was written of them.
    assert "l_shipdate" in text and "l_linenumber" not in text


def test_the_kept_view_of_costs_meets_no_record_with_all_versions_of_its_cluster(spark, sf_dir):
    lines = plan(entry.queries()["view_cost_by_compute"](spark, sf_dir)).splitlines()
    joins = [line for line in lines if "Join" in line]
    assert joins and not any("cluster_id" in line for line in joins)


@pytest.mark.parametrize("name", ["compute_utilization", "view_compute_utilization"])
def test_utilization_moves_rows_once_before_grouping(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    moved = [line for line in text.splitlines() if "Exchange" in line]
    assert not any("instance_id" in line for line in moved)
    assert sum("metric_time" in line or "start_time" in line for line in moved) == 1


@pytest.mark.parametrize("source, made", [("usage", b.usage), ("job_run_timeline", b.run_timeline), ("node_timeline", b.nodes)])
def test_halves_of_a_source_are_picked_below_its_joins(spark, sf_dir, source, made):
    half = made(spark, sf_dir).filter(F.pmod(F.xxhash64(*HALVES[source]), F.lit(2)) == 0)
    lines = half._jdf.queryExecution().optimizedPlan().toString().splitlines()
    picked = [i for i, line in enumerate(lines) if "xxhash64" in line]
    assert picked and min(picked) > max(i for i, line in enumerate(lines) if "Join" in line)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["usage_date", "workspace_id", "total_dbu", "list_cost_usd"] and df.count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_pair_of_everything(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


@pytest.mark.parametrize(
    "name, limit", [("lineitem_latest", 1), ("orders_silver", 1), ("latest_customer_order", 1), ("table_history", 20)]
)
def test_ranking_is_limited_before_the_exchange(spark, sf_dir, name, limit):
    assert f"row_number(), {limit}, Partial" in plan(entry.queries()[name](spark, sf_dir))


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        text = plan(entry.queries()["orders_daily"](spark, sf_dir))
        prices = plan(entry.queries()["price_daily"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(o_orderstatus,P)" in text and "o_totalprice" not in text
    assert "l_tax" not in prices and "o_totalprice" not in prices

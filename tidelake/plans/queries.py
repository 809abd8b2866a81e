"""One query per operator over the driver tables; keys match :mod:`tidelake.plans.oracles`.

Results are made comparable at the edge only: decimals become doubles, arrays become text, and
nothing that differs between runs (times of writing, paths, batch ids) is returned.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions import rules
from tidelake.operators import cdc, costs, flatten, gold, health, quality, runs, temporal, versions
from tidelake.plans import bindings as b
from tidelake.plans import medallion, monitoring
from tidelake.plans.medallion import silver_orders
from tidelake.session import scratch_dir, written_once
from tidelake.sources import buckets, ledger, tables
from tidelake.sources.landing import land_files
from tidelake.streaming import ingest, progress, state

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2000-06-15"
URL_CONTRACT = r"^https?://[^/]+/[a-z]{2}/\d+$"
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
PAYLOAD = ["payment_id", "amount"]
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    wide = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in wide}) if wide else df


# Bronze, silver, gold


def _normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.normalize_orders(b.bronze_orders(spark, sf_dir))


@query
def orders_valid(spark, sf_dir):
    return quality.valid_orders(_normal(spark, sf_dir))


@query
def orders_quarantine(spark, sf_dir):
    return quality.invalid_orders(_normal(spark, sf_dir))


@query
def orders_invalid_strict(spark, sf_dir):
    return quality.invalid_orders_strict(_normal(spark, sf_dir))


@query
def orders_silver(spark, sf_dir):
    return silver_orders(b.bronze_orders(spark, sf_dir))[0]


@query
def orders_daily(spark, sf_dir):
    return gold.orders_daily(silver_orders(b.bronze_orders(spark, sf_dir))[0])


@query
def orders_rescued(spark, sf_dir):
    raw = b.bronze_orders(spark, sf_dir).drop("_rescued_data")
    types = {"order_id": "bigint", "customer_id": "bigint", "order_date": "date", "status": "string"}
    return rules.with_rescued(raw, types).select(*types, "_rescued_data", "_source_file")


@query
def contract_valid(spark, sf_dir):
    pages = b.table(spark, sf_dir, "pages").select("page_id", "url")
    return rules.split_by_contract(pages, URL_CONTRACT, "url")[0]


@query
def contract_quarantine(spark, sf_dir):
    pages = b.table(spark, sf_dir, "pages").select("page_id", "url")
    return rules.split_by_contract(pages, URL_CONTRACT, "url")[1]


@query
def landing_paths(spark, sf_dir):
    """Every order's landing path under the default contract; pending ones use the wrong folder name."""
    paths = b.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "concat('s3://lake/orders/', CASE WHEN o_orderstatus = 'P' THEN 'ingestion_dt=' ELSE 'ingestion_date=' END,"
        " CAST(CAST(o_orderdate AS DATE) AS STRING), '/batch_', o_custkey, '/orders.csv') AS _source_file",
    )
    valid, broken = rules.split_by_contract(paths)
    routed = valid.unionByName(broken, allowMissingColumns=True)
    return rules.with_ingestion_date(routed)


@query
def orders_evolved(spark, sf_dir):
    """Settled orders appended first, then open ones with one column more."""
    out = scratch_dir(spark, "evolved")
    orders = b.table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "channel")
    tables.append_evolving(orders.filter("o_orderstatus = 'F'").drop("channel"), out)
    tables.append_evolving(orders.filter("o_orderstatus <> 'F'"), out)
    return tables.read_evolving(spark, out).select("o_orderkey", "o_orderstatus", "channel")


@query
def pipeline_orders_daily(spark, sf_dir):
    """The whole order pipeline over published tables, run twice: the replay must change nothing."""
    root = scratch_dir(spark, "pipeline")
    bronze = b.bronze_orders(spark, sf_dir)
    for _ in range(2):
        medallion.refresh_orders(spark, bronze, root)
    return tables.current(spark, f"{root}/gold/orders_daily")


@query
def pipeline_transactions(spark, sf_dir):
    """A landed batch merged into a published state, then sent again."""
    root = scratch_dir(spark, "transactions")
    tables.publish(b.transactions(spark, sf_dir), f"{root}/state", "CREATE")
    applied = F.expr("TIMESTAMP_NTZ'2026-02-01 08:00:00'")
    batch = tables.publish(_latest_changes(spark, sf_dir), f"{root}/events", "APPEND")
    for _ in range(2):
        medallion.run_mixed_batch(
            spark, batch, f"{root}/state", f"{root}/gold", "transaction_id", PAYLOAD, applied
        )
    return plain(tables.current(spark, f"{root}/state"))


@query
def pipeline_transactions_bucketed(spark, sf_dir):
    """The same batch merged into a state that rewrites only the buckets of the batch's keys."""
    root = scratch_dir(spark, "buckets")
    applied = F.expr("TIMESTAMP_NTZ'2026-02-01 08:00:00'")
    buckets.create_buckets(b.transactions(spark, sf_dir), f"{root}/state", "transaction_id", 64)
    batch = tables.publish(_latest_changes(spark, sf_dir), f"{root}/events", "APPEND")

    def apply(target: DataFrame, source: DataFrame) -> DataFrame:
        return cdc.apply_mixed(target, source, "transaction_id", PAYLOAD, applied_at=applied)

    buckets.merge_into_buckets(spark, f"{root}/state", "transaction_id", batch, apply, 64)
    return plain(buckets.read_buckets(spark, f"{root}/state"))


@query
def concurrent_updates(spark, sf_dir):
    """Two writers of one state of customers: one reads, the other publishes first, the first starts again."""
    path = scratch_dir(spark, "writers")
    customers = b.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id", "CAST(round(c_acctbal * 100) AS BIGINT) AS cents", "c_nationkey % 2 AS side"
    )
    first = customers.selectExpr("*", "1L AS sequence_num", "CAST(NULL AS TIMESTAMP) AS _applied_at")
    tables.publish(first, path, "CREATE")

    def events(side: int) -> DataFrame:
        return customers.filter(F.col("side") == side).selectExpr(
            "customer_id", f"cents + {side + 1} AS cents", "2L AS sequence_num", "'UPDATE' AS operation"
        )

    overtaken = []

    def late(target: DataFrame) -> DataFrame:
        if not overtaken:
            overtaken.append(medallion.run_updates_batch(spark, events(1), path, "customer_id", ["cents"]))
        return cdc.apply_updates(target, events(0), "customer_id", ["cents"])

    medallion.run_merge(spark, path, late)
    return tables.current(spark, path).select("customer_id", "cents", "sequence_num")


@query
def concurrent_bucket_updates(spark, sf_dir):
    """The same in buckets: a writer of other buckets is taken along, without merging again."""
    path = scratch_dir(spark, "bucket-writers")
    orders = b.table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", "o_orderstatus AS v", "1L AS sequence_num")
    state = orders.withColumn("_applied_at", F.lit(None).cast("timestamp"))
    buckets.create_buckets(state, path, "k", 8)
    number = buckets.bucket_number("k", 8) % 2
    overtaken = []

    def run(side: int) -> dict[str, int]:
        batch = orders.filter(number == side).selectExpr("k", f"'side {side}' AS v", "2L AS sequence_num")

        def apply(target: DataFrame, source: DataFrame) -> DataFrame:
            if side == 0 and not overtaken:
                overtaken.append(run(1))
            return cdc.apply_updates(target, source, "k", ["v"])

        return buckets.merge_into_buckets(spark, path, "k", batch, apply, 8)

    run(0)
    return buckets.read_buckets(spark, path).groupBy("sequence_num").agg(F.count(F.lit(1)).alias("orders"))


# Versions, keys, checks


@query
def lineitem_latest(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    return versions.latest_per_key(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER, drop_null_keys=True)


@query
def lineitem_key_stats(spark, sf_dir):
    return quality.key_stats(b.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", "l_shipdate")


@query
def lineitem_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(b.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def silver_idempotence_check(spark, sf_dir):
    return quality.idempotence_check(silver_orders(b.bronze_orders(spark, sf_dir))[0], "order_id")


@query
def lineitem_distinct_copies(spark, sf_dir):
    keys = ["l_orderkey", "l_returnflag", "l_linestatus"]
    return versions.drop_exact(b.table(spark, sf_dir, "lineitem").select(*keys), keys)


@query
def anti_missing(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    lines = b.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return versions.missing_keys(orders, lines, "o_orderkey")


@query
def latest_customer_order(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    latest = versions.latest_per_key(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], post_filter=F.col("o_orderstatus") != "P"
    ).withColumnRenamed("o_custkey", "c_custkey")
    customers = b.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return versions.left_latest(customers, latest, ["c_custkey"])


@query
def newest_events(spark, sf_dir):
    return versions.newest(b.table(spark, sf_dir, "events").drop("props"), "ts", 20, ["event_id"])


@query
def anomaly_profile(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    payments = b.changes(spark, sf_dir).select("amount", F.col("operation").alias("status"))
    return quality.anomaly_profile(
        orders,
        payments,
        b.table(spark, sf_dir, "events"),
        customer="o_custkey",
        known_statuses=("INSERT", "UPDATE"),
        event_time="ts",
    )


@query
def processed_values(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("transaction_id"))
    doubled = quality.double_native(lines)
    return quality.mismatch(doubled, F.col("transaction_id") * 2, "processed_value")


# Billing and operations views


@query
def price_daily(spark, sf_dir):
    return plain(costs.cost_daily(b.usage(spark, sf_dir), b.list_prices(spark, sf_dir)))


@query
def cost_by_sku(spark, sf_dir):
    return plain(costs.cost_by_sku(b.usage(spark, sf_dir), b.list_prices(spark, sf_dir)))


@query
def cost_by_sku_sliced(spark, sf_dir):
    """The same totals, summed straight from the priced usage."""
    priced = temporal.price_join(b.usage(spark, sf_dir), b.list_prices(spark, sf_dir))
    cost = F.col("usage_quantity") * F.col("pricing.effective_list.default")
    keys = ["usage_date", "workspace_id", "billing_origin_product", "sku_name", "usage_unit"]
    totals = priced.groupBy(*keys).agg(
        F.round(F.sum("usage_quantity"), 3).alias("total_usage_quantity"),
        F.round(F.sum(cost), 2).alias("list_cost_usd"),
    )
    return plain(totals)


@query
def cost_by_compute(spark, sf_dir):
    args = b.usage(spark, sf_dir), b.list_prices(spark, sf_dir), b.clusters(spark, sf_dir)
    return plain(costs.cost_by_compute(*args, tie=["change_id"]))


@query
def cost_by_job(spark, sf_dir):
    args = b.usage(spark, sf_dir), b.list_prices(spark, sf_dir), b.jobs(spark, sf_dir)
    return plain(costs.cost_by_job(*args, tie=["change_id"]))


@query
def cost_by_tag(spark, sf_dir):
    return plain(costs.cost_by_tag(b.usage(spark, sf_dir), b.list_prices(spark, sf_dir)))


@query
def cost_kpis(spark, sf_dir):
    return plain(costs.cost_kpis(b.usage(spark, sf_dir), b.list_prices(spark, sf_dir), AS_OF))


@query
def event_kpis(spark, sf_dir):
    """Period sums of another fact: event values per type."""
    events = b.table(spark, sf_dir, "events").selectExpr(
        "event_type", "CAST(ts AS DATE) AS day", "CAST(value AS DECIMAL(12,2)) AS amount"
    )
    as_of = F.lit("2024-01-20").cast("date")
    return plain(costs.period_sums(events, ["event_type"], "day", {"value": F.col("amount")}, as_of))


@query
def job_runs(spark, sf_dir):
    return runs.job_runs(b.run_timeline(spark, sf_dir), b.jobs(spark, sf_dir), tie=["change_id"])


@query
def job_tasks(spark, sf_dir):
    tasks = runs.job_tasks(b.task_timeline(spark, sf_dir), b.jobs(spark, sf_dir), tie=["change_id"])
    return tasks.withColumn("compute_ids", F.array_join("compute_ids", ","))


@query
def compute_utilization(spark, sf_dir):
    return runs.compute_utilization(b.nodes(spark, sf_dir), b.clusters(spark, sf_dir), tie=["change_id"])


@query
def query_performance(spark, sf_dir):
    return flatten.query_performance(b.query_history(spark, sf_dir))


@query
def security_events(spark, sf_dir):
    flat = flatten.security_events(b.audit(spark, sf_dir))
    return flat.withColumn("request_params", F.element_at("request_params", F.lit("k")))


@query
def data_lineage(spark, sf_dir):
    return flatten.data_lineage(b.lineage(spark, sf_dir))


# Source of a view -> the columns that deal its rows into halves. They come from one table each, so that
# Spark picks a half where it reads that table, and the joins behind the source are not done twice.
HALVES = {
    "usage": ["usage_start_time", "usage_metadata.job_run_id"],
    "list_prices": ["sku_name", "cloud", "price_start_time"],
    "clusters": ["change_id"],
    "jobs": ["change_id"],
    "job_run_timeline": ["run_id", "period_start_time"],
    "node_timeline": ["network_received_bytes", "network_sent_bytes"],
}


def _live_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A catalog view made while its sources hold half of their rows; the other half comes later."""
    schema, out = f"views_{uuid.uuid4().hex[:12]}", scratch_dir(spark, "views")
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{out}/schema'")
    made = {
        "usage": b.usage, "list_prices": b.list_prices, "clusters": b.clusters, "jobs": b.jobs,
        "job_run_timeline": b.run_timeline, "node_timeline": b.nodes,
    }
    needed = {s: made[s](spark, sf_dir) for s in made if f"{{{s}}}" in monitoring.VIEW_SQL[name]}
    if "list_prices" in needed:  # means of all lines
        needed["list_prices"] = written_once(needed["list_prices"], "prices")
    half = {source: F.pmod(F.xxhash64(*HALVES[source]), F.lit(2)) for source in needed}
    for source, df in needed.items():
        df.filter(half[source] == 0).write.option("path", f"{out}/{source}").saveAsTable(f"{schema}.{source}")
    sources = {source: f"{schema}.{source}" for source in needed}
    ties = {"jobs": ["change_id"], "clusters": ["change_id"]}
    (view,) = monitoring.create_views(spark, sources, schema, [name], ties)
    for source, df in needed.items():
        df.filter(half[source] == 1).write.mode("append").option("path", f"{out}/{source}").saveAsTable(f"{schema}.{source}")
    return spark.table(view)


@query
def view_cost_daily(spark, sf_dir):
    return plain(_live_view(spark, sf_dir, "finops_cost_daily"))


@query
def view_cost_by_compute(spark, sf_dir):
    return plain(_live_view(spark, sf_dir, "finops_cost_by_compute"))


@query
def view_job_runs(spark, sf_dir):
    return _live_view(spark, sf_dir, "job_runs")


@query
def view_compute_utilization(spark, sf_dir):
    return _live_view(spark, sf_dir, "compute_utilization")


@query
def asof_signup(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    bought = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    signups = events.filter("event_type = 'signup'").select(
        "user_id",
        F.col("ts").alias("signup_ts"),
        F.col("event_id").alias("signup_id"),
        F.col("value").alias("signup_value"),
    )
    return temporal.asof_join(
        bought, signups, ["user_id"], "ts", "signup_ts", ["signup_ts", "signup_id", "signup_value"], ["signup_id"]
    )


# Change data capture


def _latest_changes(spark: SparkSession, sf_dir: str, operation: str | None = None) -> DataFrame:
    events = b.changes(spark, sf_dir)
    if operation:
        events = events.filter(F.col("operation") == operation)
    return versions.latest_version(events, "transaction_id", "sequence_num", b.CHANGE_TIE)


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    applied = F.expr("TIMESTAMP_NTZ'2026-02-01 08:00:00'")
    return cdc.apply_mixed(
        b.transactions(spark, sf_dir),
        _latest_changes(spark, sf_dir),
        "transaction_id",
        PAYLOAD,
        applied_at=applied,
    )


@query
def cdc_insert_new(spark, sf_dir):
    target = b.transactions(spark, sf_dir)
    merged = cdc.insert_new(target, b.changes(spark, sf_dir), "transaction_id", ["transaction_id", *PAYLOAD])
    return plain(merged.drop("_applied_at"))


@query
def cdc_upsert_newer(spark, sf_dir):
    columns = ["transaction_id", *PAYLOAD, "sequence_num"]
    target = b.transactions(spark, sf_dir).select(*columns)
    source = _latest_changes(spark, sf_dir).select(*columns)
    return plain(cdc.upsert_newer(target, source, "transaction_id", "sequence_num"))


@query
def cdc_versioned_update(spark, sf_dir):
    applied = F.expr("TIMESTAMP_NTZ'2026-02-01 08:00:00'")
    target = b.transactions(spark, sf_dir)
    source = _latest_changes(spark, sf_dir, "UPDATE")
    return plain(cdc.apply_updates(target, source, "transaction_id", PAYLOAD, applied_at=applied))


@query
def cdc_versioned_delete(spark, sf_dir):
    target = b.transactions(spark, sf_dir)
    source = _latest_changes(spark, sf_dir, "DELETE")
    return plain(cdc.state_of(cdc.apply_deletes(target, source, "transaction_id")))


@query
def cdc_apply_ops(spark, sf_dir):
    columns = ["transaction_id", *PAYLOAD]
    target = b.transactions(spark, sf_dir).select(*columns)
    return plain(cdc.state_of(cdc.apply_ops(target, _latest_changes(spark, sf_dir), "transaction_id")))


@query
def cdc_mixed_state(spark, sf_dir):
    return plain(_mixed(spark, sf_dir).drop("_before"))


@query
def cdc_mixed_broadcast(spark, sf_dir):
    """The mixed merge of a batch that comes in many small partitions."""
    applied = F.expr("TIMESTAMP_NTZ'2026-02-01 08:00:00'")
    return plain(
        cdc.apply_mixed(
            b.transactions(spark, sf_dir),
            _latest_changes(spark, sf_dir).repartition(16),
            "transaction_id",
            PAYLOAD,
            applied_at=applied,
        ).drop("_before")
    )


@query
def cdc_unconditional_delete(spark, sf_dir):
    """The mistake versions guard against: deletes that remove newer rows too."""
    target = b.transactions(spark, sf_dir)
    merged = cdc.merge(target, _latest_changes(spark, sf_dir, "DELETE"), ["transaction_id"], [cdc.Delete()])
    return plain(cdc.state_of(merged))


@query
def cdc_resurrected(spark, sf_dir):
    """The mistake tombstones guard against: after a physical delete an older insert brings the key back."""
    deletes, inserts = (_latest_changes(spark, sf_dir, kind) for kind in ("DELETE", "INSERT"))
    gone = cdc.state_of(cdc.apply_deletes(b.transactions(spark, sf_dir), deletes, "transaction_id"))
    again = cdc.merge(gone, inserts, ["transaction_id"], not_matched=[cdc.Insert()]).filter("_action = 'inserted'")
    known = b.transactions(spark, sf_dir).select("transaction_id")
    removed = deletes.join(known, "transaction_id").select("transaction_id", F.col("sequence_num").alias("deleted_at"))
    back = again.join(removed, "transaction_id").filter("sequence_num < deleted_at")
    return back.select("transaction_id", "sequence_num", "deleted_at")


@query
def cdc_merge_metrics(spark, sf_dir):
    return cdc.merge_metrics(_mixed(spark, sf_dir))


@query
def cdc_active(spark, sf_dir):
    return plain(cdc.active_rows(cdc.state_of(_mixed(spark, sf_dir))))


@query
def cdc_gold(spark, sf_dir):
    return plain(gold.transactions_summary(cdc.active_rows(cdc.state_of(_mixed(spark, sf_dir)))))


@query
def cdc_payments_daily(spark, sf_dir):
    kept = cdc.state_of(
        cdc.apply_deletes(
            b.transactions(spark, sf_dir), _latest_changes(spark, sf_dir, "DELETE"), "transaction_id"
        )
    )
    dated = kept.select(
        F.expr(f"date_add({b.EPOCH}, CAST(sequence_num - 1 AS INT))").alias("payment_date"),
        F.lit("accepted").alias("status"),
        "amount",
    )
    return plain(gold.payments_daily(dated))


@query
def cdc_business_changes(spark, sf_dir):
    before = b.transactions(spark, sf_dir)
    return cdc.business_changes(before, cdc.state_of(_mixed(spark, sf_dir)), "transaction_id")


@query
def cdc_merge_changes(spark, sf_dir):
    """The same counters without joining the two states again."""
    return cdc.merge_changes(_mixed(spark, sf_dir))


@query
def cdc_delete_audit(spark, sf_dir):
    events = _latest_changes(spark, sf_dir, "DELETE")
    audit = cdc.delete_audit(b.transactions(spark, sf_dir), events, "transaction_id", "first_run")
    return audit.drop("_audited_at")


@query
def cdc_conflicts(spark, sf_dir):
    events = b.changes(spark, sf_dir)
    return quality.conflicts(events, ["transaction_id", "sequence_num"], ["operation", *PAYLOAD])


@query
def cdc_invalid_events(spark, sf_dir):
    """Deletes carry no image; asked for as updates they are invalid."""
    events = b.changes(spark, sf_dir)
    wrong = cdc.invalid_events(events, "transaction_id", PAYLOAD, operations=("INSERT", "UPDATE"))
    return wrong.groupBy("operation").agg(F.count(F.lit(1)).alias("invalid_rows"))


# Windows, intervals, streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream; a watermark needs a zoned time."""
    path = f"{sf_dir}/events.parquet"
    return tables.replay_stream(spark, path, spark.read.parquet(path).schema).withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


@query
def window_count_batch(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    counted = state.windowed_count(events, "ts", ["event_type"], "1 hour")
    return counted.select(F.col("window.start").alias("window_start"), "event_type", "count")


@query
def stream_window_count(spark, sf_dir):
    """Windows the watermark has closed; the last ones stay open in append mode."""
    out = scratch_dir(spark, "window-count")
    counted = state.windowed_count(_event_stream(spark, sf_dir), "ts", ["event_type"], "1 hour", "10 seconds")
    ingest.run_available_now(counted, f"{out}/rows", f"{out}/checkpoint")
    closed = spark.read.parquet(f"{out}/rows")
    return closed.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"), "event_type", "count"
    )


@query
def stream_user_count(spark, sf_dir):
    """Count per user without a window: the newest update of every key."""
    out = scratch_dir(spark, "user-count")
    counted = state.stream_count(_event_stream(spark, sf_dir), "user_id")
    ingest.run_updates(counted, f"{out}/rows", f"{out}/checkpoint")
    updates = tables.read_evolving(spark, f"{out}/rows")
    return versions.latest_per_key(updates, ["user_id"], ["_batch_id"]).select("user_id", "count")


def _clicks_and_purchases(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    clicks = events.filter("event_type = 'click'").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts")
    )
    bought = events.filter("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")
    )
    return clicks, bought


@query
def interval_join_batch(spark, sf_dir):
    clicks, bought = _clicks_and_purchases(b.table(spark, sf_dir, "events"))
    return temporal.interval_join(clicks, bought, "user_id", "click_ts", "purchase_ts", 3600)


@query
def stream_interval_join(spark, sf_dir):
    clicks, bought = _clicks_and_purchases(_event_stream(spark, sf_dir))
    out = scratch_dir(spark, "interval-join")
    pairs = state.bounded_join(clicks, bought, "user_id", "click_ts", "purchase_ts", 3600, "10 seconds")
    ingest.run_available_now(pairs, f"{out}/rows", f"{out}/checkpoint")
    found = spark.read.parquet(f"{out}/rows")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("click_ts", "purchase_ts")})


@query
def stream_key_join(spark, sf_dir):
    """Orders and their line items joined as streams on the key alone; both sides stay in state."""

    def stream(name: str) -> DataFrame:
        path = f"{sf_dir}/{name}.parquet"
        return tables.replay_stream(spark, path, spark.read.parquet(path).schema)

    orders = stream("orders").selectExpr("o_orderkey AS order_id", "o_orderdate AS order_time")
    lines = stream("lineitem").selectExpr("l_orderkey AS order_id", "l_linenumber AS line", "l_shipdate AS ship_time")
    out = scratch_dir(spark, "key-join")
    ingest.run_available_now(temporal.key_join(orders, lines, "order_id"), f"{out}/rows", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/rows")


@query
def stream_late_rows(spark, sf_dir):
    """Events, then the same events fourteen days earlier: the second delivery changes no closed window.

    Beside each window stands how many groups the state operators dropped as late, from the progress
    log: Spark counts them after it has put the rows of a window and type together.
    """
    out = scratch_dir(spark, "late")
    events = b.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    reports = []
    with progress.ProgressLog(spark, f"{out}/log") as log:
        for shift in (0, 14):
            shifted = events.withColumn("ts", F.col("ts") - F.expr(f"INTERVAL {shift} DAYS"))
            shifted.write.mode("append").parquet(f"{out}/events")
            arriving = tables.replay_stream(spark, f"{out}/events", events.schema)
            counted = state.windowed_count(arriving, "ts", ["event_type"], "1 hour", "10 seconds")
            reports.append(log.rows(ingest.run_available_now(counted, f"{out}/rows", f"{out}/checkpoint")))
    dropped = reports[0].unionByName(reports[1]).agg(F.sum("rows_dropped_by_watermark")).first()[0]
    windows = spark.read.parquet(f"{out}/rows").select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"), "event_type", "count"
    )
    return windows.withColumn("late_groups", F.lit(dropped).cast("long"))


@query
def stream_checkpoint_loss(spark, sf_dir):
    """Events landed twice because the checkpoint was lost: bronze doubles, silver does not."""
    out = scratch_dir(spark, "replay")

    def land(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch_once(batch, f"{out}/bronze", ingest.streaming_query_id(batch), batch_id)

    for checkpoint in ("first", "second"):
        started = (
            _event_stream(spark, sf_dir)
            .writeStream.foreachBatch(land)
            .option("checkpointLocation", f"{out}/{checkpoint}")
            .trigger(availableNow=True)
            .start()
        )
        started.awaitTermination()
    bronze = tables.read_evolving(spark, f"{out}/bronze")
    silver = versions.latest_per_key(bronze, ["event_id"], ["ts", "_run_id"], drop_null_keys=True)
    return (
        quality.key_stats(bronze, "event_id")
        .withColumn("layer", F.lit("bronze"))
        .unionByName(quality.key_stats(silver, "event_id").withColumn("layer", F.lit("silver")))
    )


@query
def stream_processed_values(spark, sf_dir):
    """The native expression in a micro-batch, checked against its rule."""
    out = scratch_dir(spark, "processed")
    doubled = quality.double_native(_event_stream(spark, sf_dir).select(F.col("event_id").alias("transaction_id")))
    ingest.run_available_now(doubled, f"{out}/rows", f"{out}/checkpoint")
    return quality.mismatch(spark.read.parquet(f"{out}/rows"), F.col("transaction_id") * 2, "processed_value")


@query
def interval_delay_check(spark, sf_dir):
    return quality.delay_check(interval_join_batch(spark, sf_dir), "click_ts", "purchase_ts", 3600)


@query
def stream_landing_route(spark, sf_dir):
    """Orders landed as CSV folders; pending ones have one column more and break the path contract."""
    out = scratch_dir(spark, "landing")
    orders = b.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS DATE) AS order_date",
        "o_orderstatus AS status",
        "o_orderpriority AS channel",
        "concat(year(o_orderdate), '-01-01') AS folder",
        "quarter(o_orderdate) AS batch",
    )
    settled = orders.filter("status <> 'P'").drop("channel").withColumnRenamed("folder", "ingestion_date")
    pending = orders.filter("status = 'P'").withColumnRenamed("folder", "ingestion_dt")
    for part, folder in ((settled, "ingestion_date"), (pending, "ingestion_dt")):
        part.write.partitionBy(folder, "batch").option("header", True).mode("append").csv(f"{out}/raw")
    land_files(
        spark,
        f"{out}/raw",
        f"{out}/checkpoint",
        ingest.route_batch(
            f"{out}/valid", f"{out}/quarantine", r".*/ingestion_date=\d{4}-\d{2}-\d{2}/batch=\d+/[^/]+\.csv$"
        ),
        schema_location=f"{out}/schema",
        hints={"order_id": "bigint", "customer_id": "bigint"},
    )
    routed = tables.read_evolving(spark, f"{out}/valid").unionByName(
        tables.read_evolving(spark, f"{out}/quarantine"), allowMissingColumns=True
    )
    return routed.select(
        "order_id", "customer_id", "order_date", "status", "channel", "ingestion_date", "_quarantine_reason"
    )


@query
def progress_status(spark, sf_dir):
    """Hours of events as micro-batches, each event taken as 600 ms of work, trigger 5 seconds."""
    hours = b.table(spark, sf_dir, "events").groupBy(
        F.expr("CAST(CAST(ts AS DATE) AS STRING)").alias("day"), F.hour("ts").alias("hour")
    )
    batches = hours.agg((F.count(F.lit(1)) * 600).alias("batch_duration_ms"))
    return progress.classify_progress(batches, 5)


# Table health


def _locations(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    return {name: f"{sf_dir}/{name}.parquet" for name in TABLES}


@query
def table_detail(spark, sf_dir):
    """Detail of the given tables; sizes and times differ between machines, so only their order is shown."""
    detail = health.table_detail(spark, _locations(spark, sf_dir))
    return detail.select(
        "table_name", "format", "schema_name", F.size("partition_columns").alias("partitions"),
        ((F.col("num_files") > 0) & (F.col("size_in_bytes") > 0)).alias("has_files"),
        (F.col("created_at") <= F.col("last_modified")).alias("in_order"),
    )


@query
def table_history(spark, sf_dir):
    """A write log in which every day of orders per status is one version of that status's table."""
    log = (
        b.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("table_name"), F.col("o_orderdate").alias("timestamp"))
        .agg(F.count(F.lit(1)).alias("written_rows"))
        .withColumn("version", F.expr(f"datediff(CAST(timestamp AS DATE), {b.EPOCH})"))
    )
    return health.table_history(log)


@query
def file_layout(spark, sf_dir):
    """Line items per supplier as if each supplier had delivered one file, and as if every order were a file."""
    lines = b.table(spark, sf_dir, "lineitem")
    few = health.file_layout(lines, "per_supplier", "l_suppkey")
    return few.unionByName(health.file_layout(lines, "per_order", "l_orderkey"))


# What the queries above leave out


def _aged(spark: SparkSession, folder: str, days: int) -> None:
    """Date the files of a folder back."""
    found = tables._hadoop_path(spark, folder)
    system = found.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = system.listFiles(found, True)
    while listed.hasNext():
        file = listed.next()
        system.setTimes(file.getPath(), file.getModificationTime() - days * 86_400_000, -1)


@query
def stream_landing_late_files(spark, sf_dir):
    """Orders in three deliveries, the later ones with files dated weeks before the first: all are landed."""
    out = scratch_dir(spark, "late-files")
    orders = b.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id", "o_custkey AS customer_id", "o_orderstatus AS status"
    )
    for number, (status, days) in enumerate((("F", 0), ("O", 30), ("P", 400)), 1):
        folder = f"{out}/raw/ingestion_date=2026-01-01/batch={number}"
        orders.filter(F.col("status") == status).write.option("header", True).csv(folder)
        _aged(spark, folder, days)
        route = ingest.route_batch(f"{out}/valid", f"{out}/quarantine", r".*/batch=\d+/[^/]+\.csv$")
        types = {"order_id": "bigint", "customer_id": "bigint", "status": "string"}
        land_files(spark, f"{out}/raw", f"{out}/checkpoint", route, schema=types)
    return tables.read_evolving(spark, f"{out}/valid").select("order_id", "customer_id", "status")


@query
def stream_landing_headers(spark, sf_dir):
    """Long files, many short ones whose header has another case and a column more, and some with a column less."""
    out = scratch_dir(spark, "headers")
    lines = b.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id", "l_linenumber AS line", "CAST(l_quantity AS BIGINT) AS quantity",
        "l_linestatus AS extra", "l_returnflag AS flag",
    )
    long = lines.filter("flag = 'N'").select("order_id", "line", "quantity")
    long.write.option("header", True).csv(f"{out}/raw/long")
    short = lines.filter("flag = 'A'").withColumnRenamed("quantity", "Quantity").drop("flag").repartition(12)
    short.write.option("header", True).csv(f"{out}/raw/short")
    less = lines.filter("flag = 'R'").select("line", "order_id").repartition(5)
    less.write.option("header", True).csv(f"{out}/raw/less")
    route = ingest.route_batch(f"{out}/valid", f"{out}/quarantine", r".*/(long|short|less)/[^/]+\.csv$")
    types = {"order_id": "bigint", "line": "int", "quantity": "bigint"}
    land_files(spark, f"{out}/raw", f"{out}/checkpoint", route, schema=types)
    return tables.read_evolving(spark, f"{out}/valid").select(*types, "_rescued_data")


@query
def ledger_landings(spark, sf_dir):
    """Orders landed by a ledger: three deliveries, a run that dies before its last mark, a ledger that is lost.

    ``deliveries`` counts how often a row is in bronze: once by the ledger however often it ran, and once
    more for the ledger that had to start anew; ``files`` are those in the first ledger.
    """
    out = scratch_dir(spark, "ledger")
    orders = b.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id", "o_custkey AS customer_id", "o_orderstatus AS status"
    )
    types = {"order_id": "bigint", "customer_id": "bigint", "status": "string"}

    def land(name: str, stop_before_mark: bool = False) -> None:
        route = ingest.route_batch(f"{out}/valid", f"{out}/quarantine", r".*/batch=\w/[^/]+\.csv$")
        if not stop_before_mark:
            ledger.land_with_ledger(spark, f"{out}/raw", f"{out}/{name}", route, schema=types, max_files=2)
            return

        def dies(batch: DataFrame, batch_id: int) -> None:
            route(batch, batch_id)
            raise InterruptedError

        try:
            ledger.land_with_ledger(spark, f"{out}/raw", f"{out}/{name}", dies, schema=types, max_files=2)
        except InterruptedError:
            pass

    for number, status in enumerate(("F", "O", "P")):
        # The last delivery adds to the first one's folder, and the first run after it stops half-way.
        folder = f"{out}/raw/ingestion_date=2026-01-0{1 + number % 2}/batch={status}"
        orders.filter(F.col("status") == status).repartition(3).write.option("header", True).csv(folder)
        land("ledger", stop_before_mark=number == 2)
        land("ledger")
    land("started_anew")
    bronze = tables.read_evolving(spark, f"{out}/valid")
    files = ledger.landed_files(spark, f"{out}/ledger").select("path").distinct().count()
    return bronze.groupBy("order_id", "customer_id", "status").agg(
        F.count(F.lit(1)).alias("deliveries"), F.lit(files).cast("long").alias("files")
    )


@query
def effective_far_end(spark, sf_dir):
    """Orders under a term of their status that begins with its first order and ends in 9999."""
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    terms = orders.groupBy("o_orderstatus").agg(F.min("o_orderdate").alias("since"))
    terms = terms.withColumns(
        {"until": F.expr("TIMESTAMP_NTZ'9999-12-31 00:00:00'"), "term": F.concat(F.lit("term "), "o_orderstatus")}
    )
    joined = temporal.effective_join(orders, terms, ["o_orderstatus"], "o_orderdate", "since", "until")
    return joined.groupBy("term").agg(F.count("*").alias("orders"), F.min("since").alias("since"))


@query
def asof_map(spark, sf_dir):
    """Purchases that carry a map, with the latest signup of their user before them."""
    events = b.table(spark, sf_dir, "events")
    bought = events.filter("event_type = 'purchase'").select(
        "event_id", "user_id", "ts", F.create_map(F.lit("kind"), "event_type").alias("tags")
    )
    signups = events.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("since"), F.col("event_id").alias("signup_id"))
    found = temporal.asof_join(bought, signups, ["user_id"], "ts", "since", ["signup_id"], ["signup_id"])
    return found.select("event_id", F.element_at("tags", F.lit("kind")).alias("kind"), "signup_id")


@query
def compacted_orders(spark, sf_dir):
    """Files with different columns, compacted: rows, columns and partition folders stay."""
    out = scratch_dir(spark, "compacted")
    orders = b.table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "channel")
    few = orders.select("o_orderkey", "o_orderstatus", "channel")
    few.filter("o_orderstatus = 'F'").drop("channel").write.partitionBy("o_orderstatus").parquet(f"{out}/small")
    few.filter("o_orderstatus <> 'F'").write.mode("append").partitionBy("o_orderstatus").parquet(f"{out}/small")
    return health.compact(spark, f"{out}/small", f"{out}/large").select("o_orderkey", "o_orderstatus", "channel")


@query
def audit_log(spark, sf_dir):
    """The delete audit written twice by one pass, as after a failure: it is there once."""
    out = scratch_dir(spark, "audit")
    for _ in range(2):
        tables.append_audit(cdc_delete_audit(spark, sf_dir), out, "first_run-0")
    return spark.read.parquet(out).drop("_pass_id")


@query
def page_paths(spark, sf_dir):
    pages = b.table(spark, sf_dir, "pages").select("page_id", "url")
    return rules.only_paths(pages, r"^https://[^/]+/en/", "url")


@query
def late_shipments(spark, sf_dir):
    """Lines shipped before their order or over 30 days after it."""
    orders = b.table(spark, sf_dir, "orders").selectExpr("o_orderkey AS order_id", "o_orderdate")
    lines = b.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS order_id", "l_linenumber", "l_shipdate")
    pairs = temporal.key_join(orders, lines, "order_id")
    return temporal.out_of_range_matches(pairs, "o_orderdate", "l_shipdate", 30 * temporal.DAY)


@query
def nation_snapshot(spark, sf_dir):
    nations = b.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return spark.createDataFrame(versions.snapshot(nations, "n_nationkey", 25), nations.schema)


@query
def source_files(spark, sf_dir):
    """Rows by the table their lineage names, read from two tables at once."""
    read = [
        rules.with_lineage(spark.read.parquet(f"{sf_dir}/{name}.parquet")).select("_source_file", "_ingestion_timestamp")
        for name in ("orders", "lineitem")
    ]
    name = F.regexp_extract("_source_file", r"/(\w+)\.parquet", 1)
    landed = read[0].unionByName(read[1]).groupBy(name.alias("source"))
    return landed.agg(F.count("*").alias("rows"), F.count("_ingestion_timestamp").alias("stamped"))


@query
def lineitem_distinct_orders(spark, sf_dir):
    """Copies judged by the order alone; which line of it stays is open, so only the order is shown."""
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return versions.drop_exact(lines, ["l_orderkey"]).select("l_orderkey")


@query
def written_table_detail(spark, sf_dir):
    """Detail of a table written with a folder a status, one file in each."""
    out = scratch_dir(spark, "detail")
    b.table(spark, sf_dir, "orders").repartition("o_orderstatus").write.partitionBy("o_orderstatus").parquet(out)
    detail = health.table_detail(spark, {"lake.sales.orders": out})
    return detail.select(
        "catalog_name", "schema_name", "table_name", "format", "num_files",
        F.array_join("partition_columns", ",").alias("partition_columns"),
        (F.col("size_in_bytes") > 0).alias("has_bytes"),
    )


@query
def written_table_history(spark, sf_dir):
    """The history of a table published once per order status."""
    out = scratch_dir(spark, "history")
    statuses = sorted(r[0] for r in b.table(spark, sf_dir, "orders").select("o_orderstatus").distinct().collect())
    for status in statuses:
        tables.publish(b.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == status), out, f"WRITE {status}")
    log = tables.history(spark, out).withColumn("table_name", F.lit("orders"))
    return health.table_history(log, 2).select("table_name", "version", "operation")


@query
def written_file_layout(spark, sf_dir):
    """Rows and files of orders as they were really written: one file a status."""
    out = scratch_dir(spark, "layout")
    b.table(spark, sf_dir, "orders").repartition("o_orderstatus").write.partitionBy("o_orderstatus").parquet(out)
    read = spark.read.parquet(out).withColumn("_source_file", F.col("_metadata.file_path"))
    return health.file_layout(read, "per_status")


@query
def stream_progress_log(spark, sf_dir):
    """Every batch of a stream as its listener wrote it, with the backlog verdict; one file is one batch.

    Each of 40 files has the events of a share of the users, so batches are told apart by their rows.
    """
    out = scratch_dir(spark, "progress")
    share = F.col("user_id") % 40
    events = b.table(spark, sf_dir, "events").select("event_id", "user_id")
    dealt = events.withColumn("share", share).repartition("share")
    dealt.write.partitionBy("share").parquet(f"{out}/events")
    arriving = tables.replay_stream(spark, f"{out}/events/*/part-*.parquet", events.schema, files_per_batch=1)
    with progress.ProgressLog(spark, f"{out}/log") as log:
        query = ingest.run_available_now(arriving.select("event_id"), f"{out}/rows", f"{out}/checkpoint")
        rows = log.rows(query)
    # An hour a batch: nothing falls behind, whatever the machine.
    verdicts = progress.classify_progress(rows, 3600)
    few = len(rows.inputFiles()) < 20
    return verdicts.select("input_rows", "status", F.lit(few).alias("few_files"))


@query
def stream_memory_count(spark, sf_dir):
    """Events per type, counted by a stream on a processing-time trigger into an in-memory table, read by name."""
    out, name = scratch_dir(spark, "memory"), f"counted_{uuid.uuid4().hex[:12]}"
    counted = _event_stream(spark, sf_dir).groupBy("event_type").count()
    running = ingest.start_memory(counted, name, f"{out}/checkpoint", "complete", "1 second")
    running.processAllAvailable()
    running.stop()
    return spark.table(name)


# Catalog health


def _registered(spark: SparkSession, sf_dir: str) -> str:
    """A schema of its own with all given tables, partitioned orders, a view, and the health tables to leave out."""
    schema, out = f"lake_{uuid.uuid4().hex[:12]}", scratch_dir(spark, "catalog")
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{out}/schema'")
    for name in TABLES:
        spark.sql(f"CREATE TABLE {schema}.{name} USING parquet LOCATION '{sf_dir}/{name}.parquet'")
    orders = b.table(spark, sf_dir, "orders").repartition("o_orderstatus")
    orders.write.partitionBy("o_orderstatus").option("path", f"{out}/by_status").saveAsTable(f"{schema}.orders_by_status")
    spark.sql(f"CREATE VIEW {schema}.orders_open AS SELECT * FROM {schema}.orders WHERE o_orderstatus = 'O'")
    spark.sql(f"CREATE TABLE {schema}.table_health_detail (n INT) USING parquet LOCATION '{out}/detail'")
    return schema


@query
def catalog_tables(spark, sf_dir):
    """The tables of a schema in name order, without views and without health's own."""
    schema = _registered(spark, sf_dir)
    listed = tables.list_tables(spark, [schema], ["table_health_detail", "table_health_history"])
    return listed.select((F.col("schema_name") == schema).alias("in_schema"), "table_name")


@query
def catalog_detail(spark, sf_dir):
    """Detail of every listed table: format, partition columns, and whether it has files and bytes."""
    schema = _registered(spark, sf_dir)
    listed = tables.list_tables(spark, [schema], ["table_health_detail", "table_health_history"])
    detail = health.table_detail(spark, health.catalog_locations(spark, listed))
    return detail.select(
        F.element_at(F.split("table_name", r"\."), -1).alias("table_name"),
        (F.col("schema_name") == schema).alias("in_schema"),
        "format",
        F.array_join("partition_columns", ",").alias("partition_columns"),
        F.when(F.size("partition_columns") > 0, F.col("num_files")).alias("num_files"),
        ((F.col("size_in_bytes") > 0) & (F.col("created_at") <= F.col("last_modified"))).alias("has_bytes"),
    )


@query
def compacted_in_place(spark, sf_dir):
    """A folder with one large file and many small ones a status: the small ones are put together, the large stay."""
    out = scratch_dir(spark, "in-place")
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    large = orders.filter("o_orderkey % 10 > 0").repartition("o_orderstatus")
    large.write.partitionBy("o_orderstatus").parquet(out)
    name, size = F.col("_metadata.file_path"), F.col("_metadata.file_size")
    limit = spark.read.parquet(out).select(size.alias("size")).agg(F.min("size")).first()[0]
    # One file a status, so the driver sees as many names.
    before = spark.createDataFrame(
        spark.read.parquet(out).select(name.alias("file")).distinct().collect(), "file string"
    )
    small = orders.filter("o_orderkey % 10 = 0").repartition(16, "o_orderkey")
    small.write.mode("append").partitionBy("o_orderstatus").parquet(out)
    health.compact_small_files(spark, out, limit)
    now = spark.read.parquet(out).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", name.alias("file"))
    kept = now.join(F.broadcast(before.withColumn("was_there", F.lit(True))), "file", "left")
    files = kept.groupBy("o_orderstatus", "was_there").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("file").alias("files"), F.sum("o_custkey").alias("customers")
    )
    return files.withColumn("was_there", F.coalesce("was_there", F.lit(False)))


@query
def duplicate_keys_in_order(spark, sf_dir):
    """The 50 suppliers with the most line items, and their places: the report is read in its order."""
    lines = b.table(spark, sf_dir, "lineitem")
    report = quality.duplicate_keys(lines, ["l_suppkey"], ordered=True).limit(50)
    placed = [(place, *row) for place, row in enumerate(report.collect(), 1)]
    return spark.createDataFrame(placed, "place int, l_suppkey long, row_count long")


@query
def table_schemas(spark, sf_dir):
    """Columns and types of the tables as they are read, by which a schema that has changed is found."""
    rows = [
        (name, place, field.name, field.dataType.simpleString())
        for name in TABLES
        for place, field in enumerate(b.table(spark, sf_dir, name).schema)
    ]
    return spark.createDataFrame(rows, "table_name string, place int, column_name string, type string")

"""Stateful streams from files: state bounds, late rows, agreement with the batch result, progress."""

import datetime as dt

from pyspark.sql import functions as F

from tidelake.operators import temporal
from tidelake.sources import tables
from tidelake.streaming import ingest, progress, state

T0 = dt.datetime(2026, 1, 1)
SCHEMA = "event_time timestamp, customer_id int"


def write_batches(spark, root, batches):
    """One file per batch; the stream takes them in order of modification."""
    for batch in batches:
        rows = [(T0 + dt.timedelta(seconds=s), c) for s, c in batch]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(root)
    return spark.read.parquet(root)


def replay(spark, root, schema=SCHEMA):
    return tables.replay_stream(spark, root, spark.createDataFrame([], schema).schema, 1)


def test_windowed_count_evicts_and_drops_late_rows(spark, tmp_path):
    root = f"{tmp_path}/events"
    late = 14 * 86400
    batches = [[(i, i % 5) for i in range(20)], [(40 + i, i % 5) for i in range(20)], [(100, 1), (-late, 1), (-late, 2)], [(200, 9)]]
    write_batches(spark, root, batches)
    counted = state.windowed_count(replay(spark, root), "event_time", ["customer_id"])
    query = ingest.run_available_now(counted, f"{tmp_path}/out", f"{tmp_path}/cp")
    got = {
        ((r.window.start - T0).total_seconds(), r.customer_id): r["count"]
        for r in spark.read.parquet(f"{tmp_path}/out").collect()
    }
    want = {(float(w), c): 2 for w in (0, 10, 40, 50) for c in range(5)} | {(100.0, 1): 1}
    assert got == want
    shown = progress.progress_df(spark, query)
    assert shown.agg(F.sum("rows_dropped_by_watermark")).first()[0] == 2
    assert shown.agg(F.sum("state_removed_rows")).first()[0] == 21
    assert shown.orderBy(F.desc("batch_id")).first().state_rows == 1
    assert shown.agg(F.sum("input_rows")).first()[0] == 44


def test_count_without_window_keeps_every_key(spark, tmp_path):
    root = f"{tmp_path}/events"
    write_batches(spark, root, [[(i, i) for i in range(30)], [(i, i + 15) for i in range(30)]])
    query = ingest.run_updates(state.stream_count(replay(spark, root), "customer_id"), f"{tmp_path}/out", f"{tmp_path}/cp")
    shown = [r.state_rows for r in progress.progress_df(spark, query).orderBy("batch_id").collect()]
    assert shown[0] == 30 and max(shown) == 45
    final = spark.read.parquet(f"{tmp_path}/out").groupBy("customer_id").agg(F.max("count").alias("n"))
    assert final.agg(F.sum("n")).first()[0] == 60


def test_bounded_join_matches_batch_and_evicts(spark, tmp_path):
    orders = [[(i, i) for i in range(b * 60, b * 60 + 40)] for b in range(5)]
    paid = [[(i + (i % 13), i) for i in range(b * 60, b * 60 + 28)] for b in range(5)]
    left_root, right_root = f"{tmp_path}/orders", f"{tmp_path}/payments"
    left_rows = write_batches(spark, left_root, orders)
    right_rows = write_batches(spark, right_root, paid)

    def sides(left, right):
        return (
            left.select(F.col("event_time").alias("order_time"), F.col("customer_id").alias("order_id")),
            right.select(F.col("event_time").alias("payment_time"), F.col("customer_id").alias("order_id")),
        )

    args = ("order_id", "order_time", "payment_time", 10)
    want = sorted(map(tuple, temporal.interval_join(*sides(left_rows, right_rows), *args).collect()))
    joined = state.bounded_join(*sides(replay(spark, left_root), replay(spark, right_root)), *args)
    query = ingest.run_available_now(joined, f"{tmp_path}/out", f"{tmp_path}/cp")
    got = spark.read.parquet(f"{tmp_path}/out").select("order_time", "order_id", "payment_time")
    assert sorted(map(tuple, got.collect())) == want
    assert 0 < len(want) < 28 * 5
    shown = progress.progress_df(spark, query).orderBy("batch_id").collect()
    assert sum(r.state_removed_rows for r in shown) > 0
    last_batch = max(r.state_rows for r in shown)
    assert last_batch < 5 * (40 + 2 * 28)

    unbounded = temporal.key_join(*sides(replay(spark, left_root), replay(spark, right_root)), "order_id")
    query = ingest.run_available_now(unbounded, f"{tmp_path}/all", f"{tmp_path}/cp_all")
    grown = [r.state_rows for r in progress.progress_df(spark, query).orderBy("batch_id").collect()]
    assert grown[-1] == 5 * (40 + 28)
    assert spark.read.parquet(f"{tmp_path}/all").count() == 28 * 5


def test_restart_takes_only_new_files(spark, tmp_path):
    root = f"{tmp_path}/events"
    write_batches(spark, root, [[(1, 1)], [(2, 2)]])
    run = lambda cp: ingest.run_available_now(replay(spark, root), f"{tmp_path}/out", f"{tmp_path}/{cp}")
    run("cp")
    write_batches(spark, root, [[(3, 3)]])
    run("cp")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_stream_into_a_catalog_table(spark, tmp_path):
    root = f"{tmp_path}/events"
    write_batches(spark, root, [[(1, 4), (2, 5)]])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS landed LOCATION '{tmp_path}/landed'")
    for _ in range(2):
        ingest.run_to_table(replay(spark, root), "landed.events", f"{tmp_path}/cp")
    assert tables.read_table(spark, "landed.events").count() == 2
    spark.sql("DROP DATABASE landed CASCADE")


def test_memory_table_by_name(spark, tmp_path):
    root = f"{tmp_path}/events"
    write_batches(spark, root, [[(1, 4), (2, 5)]])
    query = ingest.start_memory(replay(spark, root), "tidelake_probe", f"{tmp_path}/cp", every="1 second")
    query.processAllAvailable()
    assert spark.table("tidelake_probe").count() == 2
    query.stop()


def test_backlog_verdict(spark):
    df = spark.createDataFrame([(1, 5000), (2, 5001)], "batch_id long, batch_duration_ms long")
    got = {r.batch_id: r.status for r in progress.classify_progress(df, 5).collect()}
    assert got == {1: "KEEPING_UP", 2: "FALLING_BEHIND"}


def test_progress_is_written_in_few_files(spark, tmp_path):
    import json
    from types import SimpleNamespace

    log = progress.ProgressLog(spark, f"{tmp_path}/log", rows_per_file=25)
    query = SimpleNamespace(runId="run-1")
    log.onQueryStarted(query)
    for batch in range(210):
        report = {"batchId": batch, "numInputRows": 3, "stateOperators": [{"numRowsTotal": batch, "numRowsDroppedByWatermark": 1}]}
        log.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(runId="run-1", json=json.dumps(report))))
    log.onQueryTerminated(query)
    rows = log.rows(query)
    assert rows.count() == 210 and len(rows.inputFiles()) == 9
    assert rows.agg({"rows_dropped_by_watermark": "sum", "batch_id": "max"}).first() in ((210, 209), (209, 210))
    assert progress.ProgressLog(spark, f"{tmp_path}/none")._waiting == []

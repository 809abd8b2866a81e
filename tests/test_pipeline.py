"""Bronze to gold over published tables, table health, and the catalog helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelake.operators import health
from tidelake.plans import bindings, medallion
from tidelake.sources import tables


def test_order_pipeline_and_replay(spark, sf_dir, tmp_path):
    bronze = bindings.bronze_orders(spark, sf_dir)
    first = medallion.refresh_orders(spark, bronze, str(tmp_path))
    assert first["clean"] == first["current"] == first["inserted_rows"] > 0
    assert first["quarantined"] > 0
    again = medallion.refresh_orders(spark, bronze, str(tmp_path))
    assert (again["inserted_rows"], again["updated_rows"], again["deleted_rows"]) == (0, 0, 0)
    assert again["current"] == first["current"]
    daily = tables.current(spark, f"{tmp_path}/gold/orders_daily")
    assert daily.agg(F.sum("order_count")).first()[0] == first["current"]

    newer = bronze.withColumn("_ingestion_timestamp", F.expr("_ingestion_timestamp + INTERVAL 90 DAYS"))
    moved = medallion.refresh_orders(spark, newer, str(tmp_path))
    assert moved["updated_rows"] == first["current"] and moved["inserted_rows"] == 0
    log = tables.history(spark, f"{tmp_path}/silver/orders_current")
    assert [r.operation for r in log.orderBy("version").collect()] == ["CREATE TABLE", "MERGE", "MERGE", "MERGE"]


def test_a_table_can_be_rebuilt_from_itself(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert not tables.table_exists(spark, path)
    with pytest.raises(ValueError, match="TABLE_NOT_FOUND"):
        tables.current(spark, path)
    tables.publish(spark.range(3), path, "CREATE")
    tables.publish(tables.current(spark, path).withColumn("v", F.lit(1)), path, "OVERWRITE")
    assert tables.current(spark, path).columns == ["id", "v"]
    assert tables.ensure_like(spark.range(1), path).count() == 3
    # Data written without its history row stays invisible.
    spark.range(9).write.parquet(f"{path}/v00000002-lost")
    assert tables.current(spark, path).count() == 3


def test_appends_with_new_columns(spark, tmp_path):
    path = f"{tmp_path}/evolving"
    tables.append_evolving(spark.range(2), path)
    tables.append_evolving(spark.range(2, 4).withColumn("channel", F.lit("web")), path)
    rows = tables.read_evolving(spark, path)
    assert rows.count() == 4 and rows.filter("channel IS NULL").count() == 2


def test_detail_history_layout(spark, tmp_path):
    small, compact = f"{tmp_path}/small", f"{tmp_path}/compact"
    rows = spark.range(200).withColumn("p", F.col("id") % 2)
    rows.repartition(8).write.partitionBy("p").parquet(small)
    rows.coalesce(1).write.parquet(compact)
    detail = health.table_detail(spark, {"small": small, "compact": compact, "missing": f"{tmp_path}/none"})
    got = {r.table_name: r for r in detail.collect()}
    assert set(got) == {"small", "compact"}
    assert got["small"].partition_columns == ["p"] and got["compact"].partition_columns == []
    assert got["small"].num_files > got["compact"].num_files
    assert got["small"].size_in_bytes > 0 and got["small"].created_at <= got["small"].last_modified

    layout = {}
    for name, path in (("small", small), ("compact", compact)):
        read = spark.read.parquet(path).withColumn("_source_file", F.col("_metadata.file_path"))
        layout[name] = health.file_layout(read, name).first()
    assert layout["small"].rows == layout["compact"].rows == 200
    assert (layout["small"].source_files, layout["compact"].source_files) == (16, 1)

    merged = health.compact(spark, small, f"{tmp_path}/merged")
    assert merged.count() == 200 and len(merged.inputFiles()) == 2
    assert sorted(merged.columns) == ["id", "p"]
    spark.range(5).withColumn("late", F.lit("x")).withColumn("p", F.lit(1)).write.mode("append").partitionBy("p").parquet(small)
    again = health.compact(spark, small, f"{tmp_path}/again")
    assert again.count() == 205 and again.filter("late = 'x'").count() == 5

    log = spark.range(30).select(
        F.when(F.col("id") < 25, "a").otherwise("b").alias("table_name"), F.col("id").alias("version")
    )
    kept = health.table_history(log)
    assert kept.filter("table_name = 'a'").agg(F.min("version"), F.count("*")).first()[:] == (5, 20)
    assert kept.filter("table_name = 'b'").count() == 5


def test_catalog_listing(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lab LOCATION '{tmp_path}/lab'")
    for name in ("orders", "health_detail"):
        spark.range(3).write.mode("overwrite").format("parquet").saveAsTable(f"lab.{name}")
    spark.sql("CREATE OR REPLACE VIEW lab.orders_view AS SELECT * FROM lab.orders")
    listed = tables.list_tables(spark, ["lab"], ["health_detail"])
    assert [r.table_name for r in listed.collect()] == ["orders"]
    places = health.catalog_locations(spark, listed)
    assert health.table_detail(spark, places).first().table_name == "lab.orders"
    assert tables.read_table(spark, "lab.orders").count() == 3
    spark.sql("DROP DATABASE lab CASCADE")


def test_local_times_do_not_move_buckets(spark):
    """Zone-less hours around a clock change stay in order under a zone that skips one."""
    from tidelake.functions.times import bucket_of, seconds_of

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        hours = [dt.datetime(2026, 3, 29, h, m) for h in range(0, 6) for m in (0, 30)]
        df = spark.createDataFrame([(h,) for h in hours], "t timestamp_ntz").coalesce(1)
        got = [r[0] for r in df.select(seconds_of(df, "t")).collect()]
        assert [b - a for a, b in zip(got, got[1:])] == [1800] * (len(hours) - 1)
        assert df.select(bucket_of(df, "t", 86400)).distinct().count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_monitoring_views_and_health_collection(spark, sf_dir, tmp_path):
    from tidelake.plans import monitoring

    source = {
        "usage": bindings.usage,
        "list_prices": bindings.list_prices,
        "clusters": bindings.clusters,
        "jobs": bindings.jobs,
        "job_run_timeline": bindings.run_timeline,
        "job_task_run_timeline": bindings.task_timeline,
        "node_timeline": bindings.nodes,
        "query_history": bindings.query_history,
        "audit": bindings.audit,
        "table_lineage": bindings.lineage,
    }
    given = {name: make(spark, sf_dir) for name, make in source.items()}
    assert len(monitoring.register_views(given)) == 12
    total = spark.sql("SELECT sum(list_cost_usd) AS c FROM finops_cost_daily").first().c
    by_sku = spark.sql("SELECT sum(list_cost_usd) AS c FROM finops_cost_by_sku").first().c
    assert total == by_sku > 0
    assert spark.sql("SELECT count(*) FROM finops_cost_kpis").first()[0] == 25
    assert monitoring.kpis_as_of(given, "2000-06-15").filter("cost_mtd_usd > 0").count() > 0
    for name in monitoring.VIEWS:
        assert spark.table(name).limit(1).count() == 1

    path = f"{tmp_path}/t"
    for n in range(22):
        tables.publish(spark.range(1).withColumn("n", F.lit(n)), path, "OVERWRITE")
    out = monitoring.collect_table_health(spark, f"{tmp_path}/health", published={"t": path})
    assert out["history"].count() == 20 and out["history"].agg(F.max("version")).first()[0] == 21
    assert out["detail"].first().num_files >= 22


def _files(folder):
    return {f.relative_to(folder).as_posix(): f.stat().st_size for f in folder.rglob("*.parquet")}


@pytest.fixture
def mixed_sizes(spark, tmp_path):
    """Two partition folders with a large file and several small ones, one with a single small file."""
    path = tmp_path / "orders x"
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), (F.col("id") % 2).alias("p"))
    rows.repartition(1).write.partitionBy("p").parquet(str(path))
    large = _files(path)
    few = spark.range(60_000, 60_100).select("id", F.lit("s").alias("v"), (F.col("id") % 2).alias("p"))
    few.repartition(6, "id").write.mode("append").partitionBy("p").parquet(str(path))
    new = few.limit(3).select((F.col("id") + 1000).alias("id"), "v", F.lit(7).alias("p"), F.lit("n").alias("channel"))
    new.coalesce(1).write.mode("append").partitionBy("p").parquet(str(path))
    return path, large, min(large.values())


def test_small_files_are_put_together_and_large_ones_stay(spark, mixed_sizes):
    path, large, limit = mixed_sizes
    before, rows = _files(path), sorted(map(repr, tables.read_evolving(spark, str(path)).collect()))
    replaced = health.compact_small_files(spark, str(path), limit)
    after = _files(path)
    assert replaced == len(before) - len(large) - 1
    assert all(after[name] == size for name, size in large.items())
    assert sorted(name.split("/")[0] for name in after) == ["p=0", "p=0", "p=1", "p=1", "p=7"]
    assert sorted(map(repr, tables.read_evolving(spark, str(path)).collect())) == rows
    assert not (path / "_compaction").exists()


@pytest.mark.parametrize("stop", ["staged", "half moved", "not staged"])
def test_a_compaction_that_stops_is_finished_or_undone(spark, mixed_sizes, monkeypatch, stop):
    path, large, limit = mixed_sizes
    rows = sorted(map(repr, tables.read_evolving(spark, str(path)).collect()))
    finish, calls = health._finish_compaction, []

    def stops(*args):
        calls.append(args)
        if len(calls) == 2:
            raise InterruptedError
        return finish(*args)

    with monkeypatch.context() as broken:
        broken.setattr(health, "_finish_compaction", stops)
        with pytest.raises(InterruptedError):
            health.compact_small_files(spark, str(path), limit)
    work = path / "_compaction"
    assert sorted(map(repr, tables.read_evolving(spark, str(path)).collect())) == rows
    if stop == "not staged":
        (work / health.READY).unlink()
    if stop == "half moved":
        file = next((work / health.STAGED).rglob("part-*.parquet"))
        file.rename(path / file.relative_to(work / health.STAGED))
    health.compact_small_files(spark, str(path), limit)
    assert sorted(map(repr, tables.read_evolving(spark, str(path)).collect())) == rows
    assert len(_files(path)) == 5 and set(large) < set(_files(path))

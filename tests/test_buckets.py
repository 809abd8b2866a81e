"""State in buckets: only touched partitions change, results equal the whole-table merge."""

import pytest
from pyspark.sql import functions as F

from tidelake.operators import cdc
from tidelake.sources import buckets, tables

N = 16


def test_merge_touches_only_its_buckets(spark, tmp_path):
    path = f"{tmp_path}/state"
    state = spark.range(500).select(
        F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(1).cast("long").alias("sequence_num"),
        F.lit(False).alias("_is_deleted"), F.lit(None).cast("timestamp").alias("_applied_at"),
    )
    buckets.create_buckets(state, path, "k", N)
    before = buckets._folders(spark, path)
    batch = spark.createDataFrame(
        [(3, "new", 2, "UPDATE"), (4, None, 2, "DELETE"), (5, "stale", 1, "UPDATE"), (9001, "n", 1, "INSERT")],
        "k long, v string, sequence_num long, operation string",
    )

    def apply(target, source):
        return cdc.apply_mixed(target, source, "k", ["v"])

    want = cdc.state_of(apply(state, batch)).select("k", "v", "sequence_num", "_is_deleted")
    run = lambda: buckets.merge_into_buckets(spark, path, "k", batch, apply, N)
    assert run() == {"inserted_rows": 1, "updated_rows": 2, "deleted_rows": 0}
    got = buckets.read_buckets(spark, path).select("k", "v", "sequence_num", "_is_deleted")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

    touched = {r[0] for r in batch.select(buckets.bucket_number("k", N)).collect()}
    after = buckets._folders(spark, path)
    assert {n for n in before if before[n] != after[n]} == touched and len(touched) < N
    assert run() == {"inserted_rows": 0, "updated_rows": 0, "deleted_rows": 0}
    assert buckets.merge_into_buckets(spark, path, "k", batch.limit(0), apply, N)["updated_rows"] == 0


def test_a_merge_that_stops_half_way_loses_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/state"
    state = spark.range(100).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("sequence_num"))
    buckets.create_buckets(state, path, "k", N)
    batch = spark.range(0, 100, 3).selectExpr("id AS k", "2L AS sequence_num", "'DELETE' AS operation")

    def merge():
        return buckets.merge_into_buckets(spark, path, "k", batch, lambda t, s: cdc.apply_deletes(t, s, "k"), N)

    def stops(*args):
        raise RuntimeError("lost before the version was published")

    with monkeypatch.context() as broken:
        broken.setattr(tables, "record_version", stops)
        with pytest.raises(RuntimeError):
            merge()
    assert buckets.read_buckets(spark, path).count() == 100
    assert merge()["deleted_rows"] == 34 and buckets.read_buckets(spark, path).count() == 66


def test_of_two_writers_of_a_version_one_fails(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.publish(spark.range(1), path, "CREATE")
    tables.claim(spark, path, 1)
    with pytest.raises(RuntimeError, match="VERSION_TAKEN"):
        tables.publish(spark.range(2), path, "OVERWRITE")
    assert tables.current(spark, path).count() == 1
    tables.release_claim(spark, path, 1)
    assert tables.publish(spark.range(2), path, "OVERWRITE").count() == 2


def test_a_bucket_can_become_empty(spark, tmp_path):
    path = f"{tmp_path}/state"
    state = spark.createDataFrame([(1, 1)], "k long, sequence_num long")
    buckets.create_buckets(state, path, "k", N)
    batch = spark.createDataFrame([(1, 2, "DELETE")], "k long, sequence_num long, operation string")
    done = buckets.merge_into_buckets(
        spark, path, "k", batch, lambda t, s: cdc.apply_deletes(t, s, "k"), N
    )
    assert done["deleted_rows"] == 1 and buckets.read_buckets(spark, path).count() == 0
    back = spark.createDataFrame([(1, 3, "INSERT")], batch.schema)
    done = buckets.merge_into_buckets(spark, path, "k", back, lambda t, s: cdc.insert_new(t, s, "k"), N)
    assert done["inserted_rows"] == 1 and buckets.read_buckets(spark, path).count() == 1

"""Two writers of one table: no update is lost, neither in whole versions nor in buckets."""

import threading

import pytest
from pyspark.sql import functions as F

from tidelake.operators import cdc
from tidelake.plans import medallion
from tidelake.sources import buckets, tables

EVENTS = "k long, v string, sequence_num long, operation string"


def state(spark, keys):
    return spark.createDataFrame([(k, "old", 1, None) for k in keys], "k long, v string, sequence_num long, _applied_at timestamp")


def values(df):
    return {r.k: r.v for r in df.collect()}


def test_a_version_that_moved_is_not_overwritten(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.publish(state(spark, [1, 2]), path, "CREATE")
    version, mine = tables.read_version(spark, path)
    theirs = tables.current(spark, path).withColumn("v", F.when(F.col("k") == 2, "B").otherwise(F.col("v")))
    tables.publish(theirs, path, "MERGE", read=version)
    changed = mine.withColumn("v", F.when(F.col("k") == 1, "A").otherwise(F.col("v")))
    with pytest.raises(tables.VersionConflict, match="VERSION_MOVED"):
        tables.publish(changed, path, "MERGE", read=version)
    assert values(tables.current(spark, path)) == {1: "old", 2: "B"}
    # A writer that replaces the table whatever it holds names no version.
    tables.publish(changed, path, "OVERWRITE")
    assert values(tables.current(spark, path)) == {1: "A", 2: "old"}


def test_a_merge_that_is_overtaken_starts_again(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.publish(state(spark, [1, 2, 3]), path, "CREATE")
    mine = spark.createDataFrame([(1, "A", 2, "UPDATE")], EVENTS)
    theirs = spark.createDataFrame([(2, "B", 2, "UPDATE")], EVENTS)
    seen = []

    def apply(target):
        seen.append(values(target))
        if len(seen) == 1:
            medallion.run_updates_batch(spark, theirs, path, "k", ["v"])
        return cdc.apply_updates(target, mine, "k", ["v"])

    _, metrics = medallion.run_merge(spark, path, apply)
    assert metrics["updated_rows"] == 1 and len(seen) == 2 and seen[1][2] == "B"
    assert values(tables.current(spark, path)) == {1: "A", 2: "B", 3: "old"}


def test_writers_at_the_same_time_all_get_through(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.publish(state(spark, range(4)), path, "CREATE")
    errors = []

    def write(k):
        try:
            medallion.run_updates_batch(spark, spark.createDataFrame([(k, f"w{k}", 2, "UPDATE")], EVENTS), path, "k", ["v"])
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    done = values(tables.current(spark, path))
    # Whoever gave up said so; nobody's change is gone without an error.
    assert sum(v.startswith("w") for v in done.values()) + len(errors) == 4
    assert all(isinstance(e, tables.VersionConflict) for e in errors)


def test_attempts_end(spark, tmp_path):
    calls = []

    def never():
        calls.append(1)
        raise tables.VersionConflict("taken")

    with pytest.raises(tables.VersionConflict):
        tables.retried(never, attempts=3, wait_seconds=0)
    assert len(calls) == 3


@pytest.mark.parametrize("same_bucket", [False, True])
def test_writers_of_buckets(spark, tmp_path, same_bucket):
    path = f"{tmp_path}/b"
    buckets.create_buckets(state(spark, range(40)), path, "k", 8)
    numbers = {r.k: r.n for r in state(spark, range(40)).select("k", buckets.bucket_number("k", 8).alias("n")).collect()}
    other = next(k for k in range(1, 40) if (numbers[k] == numbers[0]) == same_bucket)
    overtaken = []

    def run(k):
        def apply(target, source):
            if k == 0 and not overtaken:
                overtaken.append(run(other))
            return cdc.apply_updates(target, source, "k", ["v"])

        return buckets.merge_into_buckets(spark, path, "k", spark.createDataFrame([(k, "new", 2, "UPDATE")], EVENTS), apply, 8)

    if same_bucket:
        with pytest.raises(tables.VersionConflict):
            run(0)
        run(0)
    else:
        assert run(0)["updated_rows"] == 1
    got = values(buckets.read_buckets(spark, path))
    assert len(got) == 40 and {k for k, v in got.items() if v == "new"} == {0, other}

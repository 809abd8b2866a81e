"""Time joins against brute force on small random rows, busy keys and ties included."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidelake.operators import temporal

T0 = dt.datetime(2024, 3, 30, 23, 50)


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def facts_and_versions():
    rng = random.Random(7)
    # Key 1 holds a third of the facts and half of the versions.
    key = lambda share: 1 if rng.random() < share else rng.choice([2, 3, None])
    facts = [(i, key(0.34), rng.choice([None, *range(0, 4000, 7)])) for i in range(600)]
    versions = [(key(0.5), rng.randrange(0, 4000, 7), i) for i in range(150)]
    return facts, versions


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("width", [60, 600, 86400])
def test_asof(spark, facts_and_versions, kind, width):
    facts, versions = facts_and_versions
    want = []
    for i, k, t in facts:
        seen = [(vt, v) for vk, vt, v in versions if k is not None and t is not None and vk == k and vt <= t]
        want.append((i, *(max(seen) if seen else (None, None))))
    f = spark.createDataFrame([(i, k, at(t)) for i, k, t in facts], f"id int, k int, t {kind}")
    v = spark.createDataFrame([(k, at(t), n) for k, t, n in versions], f"k int, since {kind}, n int")
    got = temporal.asof_join(f, v, ["k"], "t", "since", ["since", "n"], ["n"], width)
    assert got.columns == ["id", "k", "t", "since", "n"]
    assert sorted((r.id, r.since, r.n) for r in got.collect()) == sorted(
        ((i, at(vt), n) for i, vt, n in want), key=lambda r: r[0]
    )


@pytest.mark.parametrize("width", [60, 86400])
def test_effective_dated(spark, width):
    rng = random.Random(11)
    facts = [(i, rng.choice([1, 1, 2, None]), rng.choice([None, *range(0, 9000, 13)])) for i in range(300)]
    terms = []
    for n in range(40):
        start = rng.randrange(0, 6000, 13)
        end = rng.choice([None, start, start + 13, start + rng.randrange(1, 2000)])
        terms.append((rng.choice([1, 2, 3]), start, end, n))
    want = sorted(
        (i, n)
        for i, k, t in facts
        for tk, start, end, n in terms
        if k == tk and t is not None and t >= start and (end is None or t < end)
    )
    f = spark.createDataFrame([(i, k, at(t)) for i, k, t in facts], "id int, k int, t timestamp_ntz")
    p = spark.createDataFrame(
        [(k, at(s), at(e), n) for k, s, e, n in terms], "k int, s timestamp_ntz, e timestamp_ntz, n int"
    )
    got = temporal.effective_join(f, p, ["k"], "t", "s", "e", width)
    assert got.columns == ["id", "k", "t", "s", "e", "n"]
    assert sorted((r.id, r.n) for r in got.collect()) == want
    joins = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in joins and "Cartesian" not in joins


def test_a_far_off_end_is_cut_no_finer_than_an_open_one(spark):
    facts = spark.createDataFrame([(1, 1, at(50)), (2, 1, at(10**8))], "id int, k int, t timestamp_ntz")
    terms = spark.createDataFrame(
        [(1, at(0), dt.datetime(9999, 12, 31), 7)], "k int, s timestamp_ntz, e timestamp_ntz, n int"
    )
    # In slots of a second the term would be cut into 250 thousand million pieces.
    got = temporal.effective_join(facts, terms, ["k"], "t", "s", "e", 1)
    assert sorted((r.id, r.n) for r in got.collect()) == [(1, 7), (2, 7)]


def test_facts_with_maps_can_be_joined_as_of(spark):
    facts = spark.sql("SELECT 1 AS id, 'a' AS k, TIMESTAMP_NTZ'2024-01-02' AS t, map('x', 'y') AS tags UNION ALL SELECT 2, NULL, NULL, map()")
    versions = spark.sql("SELECT 'a' AS k, TIMESTAMP_NTZ'2024-01-01' AS since, 5 AS v")
    got = temporal.asof_join(facts, versions, ["k"], "t", "since", ["v"])
    assert {r.id: (r.v, dict(r.tags)) for r in got.collect()} == {1: (5, {"x": "y"}), 2: (None, {})}


def test_price_boundaries(spark):
    """Before the first price: dropped; at a change: the new price; open end: still in force."""
    usage = spark.createDataFrame(
        [(n, "sku", "c", "DBU", at(t)) for n, t in [("before", -1), ("first", 0), ("change", 100), ("open", 10**7)]],
        "n string, sku_name string, cloud string, usage_unit string, usage_end_time timestamp",
    )
    prices = spark.createDataFrame(
        [("sku", "c", "DBU", at(0), at(100), 1), ("sku", "c", "DBU", at(100), None, 2)],
        "sku_name string, cloud string, usage_unit string, price_start_time timestamp, price_end_time timestamp, p int",
    )
    got = {r.n: r.p for r in temporal.price_join(usage, prices).collect()}
    assert got == {"first": 1, "change": 2, "open": 2}
    assert temporal.price_join(usage, prices.limit(0)).count() == 0


@pytest.mark.parametrize("within", [1, 10, 600])
def test_interval(spark, within):
    rng = random.Random(3)
    left = [(rng.choice([1, 1, 2]), rng.randrange(0, 3000) / 2, i) for i in range(150)]
    right = [(rng.choice([1, 1, 2]), rng.randrange(0, 3000) / 2, i) for i in range(150)]
    want = sorted((i, j) for k, t, i in left for q, u, j in right if k == q and t <= u <= t + within)
    lhs = spark.createDataFrame([(k, at(t), i) for k, t, i in left], "k int, lt timestamp, i int")
    rhs = spark.createDataFrame([(k, at(t), i) for k, t, i in right], "k int, rt timestamp, j int")
    got = temporal.interval_join(lhs, rhs, "k", "lt", "rt", within)
    assert sorted((r.i, r.j) for r in got.collect()) == want
    assert temporal.out_of_range_matches(got, "lt", "rt", within).count() == 0
    everything = temporal.key_join(lhs, rhs, "k")
    assert everything.count() - temporal.out_of_range_matches(everything, "lt", "rt", within).count() == len(want)


def test_only_busy_keys_are_cut_into_slices(spark, facts_and_versions):
    """Keys of few rows meet their versions whole; no version is carried from slice to slice for them."""
    facts, versions = facts_and_versions
    f = spark.createDataFrame([(i, k, at(t)) for i, k, t in facts], "id int, k int, t timestamp")
    v = spark.createDataFrame([(k, at(t), n) for k, t, n in versions], "k int, since timestamp, n int")
    results = []
    for busy_rows, carries in ((1000, False), (150, True), (1, True)):  # none, the busiest key, all keys
        got = temporal.asof_join(f, v, ["k"], "t", "since", ["n"], ["n"], 60, busy_rows=busy_rows)
        assert ("_visited" in got._jdf.queryExecution().toString()) is carries
        results.append(sorted(map(repr, got.collect())))
    assert results[0] == results[1] == results[2] and len(results[0]) == len(facts)


def test_busy_key_is_spread(spark):
    """A key with most of the rows is worked on in many tasks, not one."""
    f = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id")).cast("long").alias("k"),
        F.timestamp_seconds(F.col("id") * 60).alias("t"),
    )
    v = f.select("k", F.col("t").alias("since"), F.lit(1).alias("n")).filter("second(since) = 0")
    got = temporal.asof_join(f, v, ["k"], "t", "since", ["n"])
    per_task = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 20_000 * 0.6

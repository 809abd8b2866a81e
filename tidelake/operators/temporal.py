"""Joins on time: effective-dated, as-of, and interval joins.

All three add a time bucket to the equality keys. A join on the business key alone compares
every row of a key with every row of the other side of that key, in one task; with the bucket
a busy key is spread over its buckets, only neighbouring times are compared, and what is still
uneven is left to the adaptive skew join, which may split the fact side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.times import bucket_of
from tidelake.session import written_once

DAY = 86400
BUSY_ROWS = 10_000

PRICE_KEYS = ("sku_name", "cloud", "usage_unit")


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"{left}.{key}") == F.col(f"{right}.{key}"))
    return condition


def effective_join(
    facts: DataFrame,
    terms: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    width_seconds: int = 30 * DAY,
) -> DataFrame:
    """Inner join on ``keys`` and ``start <= at < end``; a NULL end is still open.

    Facts without a term in force are dropped; overlapping terms each give a row. Terms are cut
    into the slots of time they touch and facts meet those of their own slot, not the whole
    history of their key. No term begins after the latest start, so later facts share that slot, in
    which a term of far-off end has its last piece; the exact condition decides there as elsewhere.
    Whether the pieces are broadcast is left to Spark, which measures them.
    """
    terms = terms.withColumns(
        {"_first": bucket_of(terms, start, width_seconds), "_last": bucket_of(terms, end, width_seconds)}
    )
    horizon = terms.agg(F.max("_first")).first()[0] or 0

    last = F.least(F.coalesce("_last", F.lit(horizon)), F.lit(horizon))
    pieces = terms.filter(F.col("_first") <= last).withColumn("_slot", F.explode(F.sequence("_first", last)))
    slotted = facts.withColumn("_slot", F.least(bucket_of(facts, at, width_seconds), F.lit(horizon)))
    in_force = (F.col(f"f.{at}") >= F.col(f"p.{start}")) & (
        F.col(f"p.{end}").isNull() | (F.col(f"f.{at}") < F.col(f"p.{end}"))
    )
    joined = slotted.alias("f").join(pieces.alias("p"), _same("f", "p", [*keys, "_slot"]) & in_force, "inner")
    helpers = {*keys, "_first", "_last", "_slot"}
    return joined.select(
        *[F.col(f"f.{c}") for c in facts.columns], *[F.col(f"p.{c}") for c in pieces.columns if c not in helpers]
    )


def price_join(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Usage with the list price in force when it ended; unpriced usage is dropped."""
    return effective_join(usage, prices, PRICE_KEYS, "usage_end_time", "price_start_time", "price_end_time")


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    since: str,
    bring: Sequence[str],
    tie: Sequence[str] = (),
    width_seconds: int = 600,
    busy_rows: int = BUSY_ROWS,
) -> DataFrame:
    """Every fact once, with the columns ``bring`` of its key's latest version at or before ``at``.

    Facts with no earlier version keep NULLs. Among versions with one time the greatest ``tie``
    wins. Facts are never multiplied by the versions of their key, and a busy key, one of more than
    ``busy_rows`` facts and versions, is worked on in slices of ``width_seconds``:

    1. the facts are computed once, and written with their slices to the shared folder; the rows of
       each key are counted, and the busy keys written, which are at most a ``busy_rows``-th of all rows;
    2. of a busy key, the closing version of each slice is carried forward to the slices facts fall in,
       one ordered pass over the slices of a key, whose number is bounded by the time span; the slices
       come from two narrow columns of the written facts;
    3. facts, versions and carried versions of one key, or one slice of a busy key, are put in time
       order, and every fact takes the last version before it.

    Facts without key or time match nothing; they are spread over tasks instead of meeting in one.
    """
    order = [since, *tie]
    known = versions.select(*keys, *dict.fromkeys([*order, *bring])).dropna(subset=[*keys, since])
    own = known.select(
        *keys,
        bucket_of(known, since, width_seconds).alias("_slice"),
        F.col(since).alias("_time"),
        F.struct(*tie).alias("_tie") if tie else F.struct(F.lit(0)).alias("_tie"),
        F.struct(*bring).alias("_version"),
    )

    unmatched = F.col(at).isNull()
    for key in keys:
        unmatched = unmatched | F.col(key).isNull()
    sliced = facts.withColumns(
        {
            "_slice": bucket_of(facts, at, width_seconds),
            "_time": F.col(at),
            "_void": F.when(unmatched, F.pmod(F.monotonically_increasing_id(), F.lit(4096))),
        }
    )
    sliced = written_once(sliced, "asof-facts")
    of_key = sliced.filter("_void IS NULL").select(*keys).unionByName(own.select(*keys)).groupBy(*keys).count()
    busy = written_once(of_key.filter(F.col("count") > busy_rows).select(*keys), "asof-busy")
    if busy.isEmpty():
        whole = F.lit(None).cast("long")
        return _in_time_order(sliced.withColumn("_slice", whole), own.withColumn("_slice", whole), facts, keys, bring)

    busy = busy.withColumn("_busy", F.lit(True))
    slice_of_busy = F.when(F.col("_busy"), F.col("_slice"))
    sliced, own = (df.join(busy, list(keys), "left").withColumn("_slice", slice_of_busy).drop("_busy") for df in (sliced, own))
    cut = F.col("_void").isNull() & F.col("_slice").isNotNull()
    visited = sliced.filter(cut).select(*keys, "_slice").distinct().withColumn("_visited", F.lit(True))

    closing = own.filter("_slice IS NOT NULL").groupBy(*keys, "_slice").agg(F.max_by("_version", F.struct("_time", "_tie")).alias("_version"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        visited.unionByName(closing, allowMissingColumns=True)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(earlier))
        .filter(F.col("_visited") & F.col("_version").isNotNull())
        .drop("_visited")
    )
    return _in_time_order(sliced, own.unionByName(carried, allowMissingColumns=True), facts, keys, bring)


def _in_time_order(
    sliced: DataFrame, versions: DataFrame, facts: DataFrame, keys: Sequence[str], bring: Sequence[str]
) -> DataFrame:
    """Every fact of ``sliced`` with the last of ``versions`` before it, within its key and slice."""
    so_far = (
        Window.partitionBy(*keys, "_slice", "_void")
        .orderBy(F.col("_time").asc_nulls_first(), F.col("_fact").asc_nulls_first(), "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sliced.withColumn("_fact", F.lit(1))
        .unionByName(versions, allowMissingColumns=True)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
        .filter(F.col("_fact").isNotNull())
        .select(*facts.columns, *[F.col(f"_version.{c}").alias(c) for c in bring])
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    within_seconds: int,
) -> DataFrame:
    """All pairs of one key with ``left_time <= right_time <= left_time + within``, both ends included.

    Works on batch frames and, when both sides carry a watermark, on streams, where the range
    condition bounds the state. The right row is offered to its own time bucket and the one
    before, so each pair meets exactly once, in the left row's bucket. The key comes from the
    left side, all other columns from both.
    """
    width = max(int(within_seconds), 1)
    lhs = left.withColumn("_bucket", bucket_of(left, left_time, width)).alias("l")
    here = bucket_of(right, right_time, width)
    rhs = right.withColumn("_bucket", F.explode(F.array(here, here - 1))).alias("r")
    in_range = (F.col(f"r.{right_time}") >= F.col(f"l.{left_time}")) & (
        F.col(f"r.{right_time}") <= F.col(f"l.{left_time}") + F.expr(f"INTERVAL {int(within_seconds)} SECONDS")
    )
    joined = lhs.join(rhs, _same("l", "r", [key, "_bucket"]) & in_range, "inner")
    return joined.select(
        *[F.col(f"l.{c}") for c in left.columns], *[F.col(f"r.{c}") for c in right.columns if c != key]
    )


def key_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Stream-stream join on the key alone: every row stays in state for good.

    Kept as the counter-example the interval join replaces.
    """
    return left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"), "inner").select(
        *[F.col(f"l.{c}") for c in left.columns], *[F.col(f"r.{c}") for c in right.columns if c != key]
    )


def out_of_range_matches(pairs: DataFrame, left_time: str, right_time: str, within_seconds: int) -> DataFrame:
    """Pairs outside the allowed delay, tested on the full times rather than on whole seconds."""
    late = F.col(right_time) > F.col(left_time) + F.expr(f"INTERVAL {int(within_seconds)} SECONDS")
    return pairs.filter((F.col(right_time) < F.col(left_time)) | late)

"""Validation, idempotence counters, conflict checks and the anomaly profile."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.rules import ALLOWED_STATUSES, holds, order_is_valid, order_rules


def valid_orders(df: DataFrame, allowed: Iterable[str] = ALLOWED_STATUSES) -> DataFrame:
    """Normalised orders that keep every rule."""
    return df.filter(order_is_valid(allowed))


def invalid_orders(df: DataFrame, allowed: Iterable[str] = ALLOWED_STATUSES) -> DataFrame:
    """The exact complement of :func:`valid_orders`, a NULL status included."""
    return df.filter(~holds(order_is_valid(allowed)))


def invalid_orders_strict(df: DataFrame, allowed: Iterable[str] = ALLOWED_STATUSES) -> DataFrame:
    """The rules negated one by one: a row whose only fault is a NULL status is in neither branch."""
    broken = F.lit(False)
    for rule in order_rules(allowed):
        broken = broken | ~rule
    return df.filter(broken)


def key_stats(df: DataFrame, key: str, file_column: str | None = None, time_column: str | None = None) -> DataFrame:
    """One row of idempotence counters.

    ``duplicate_rows`` is rows minus distinct keys, so it counts NULL keys too; ``surplus_rows``
    leaves them out.
    """
    rows, known, distinct = F.count(F.lit(1)), F.count(F.col(key)), F.countDistinct(F.col(key))
    measures = [
        rows.alias("total_rows"),
        distinct.alias("distinct_keys"),
        (rows - distinct).alias("duplicate_rows"),
        (known - distinct).alias("surplus_rows"),
        (rows - known).alias("null_keys"),
    ]
    if file_column:
        measures.append(F.countDistinct(F.col(file_column)).alias("source_files"))
    if time_column:
        measures.append(F.max(F.col(time_column)).alias("latest"))
    return df.agg(*measures)


def duplicate_keys(df: DataFrame, keys: Sequence[str], ordered: bool = False) -> DataFrame:
    """Keys held by more than one row, with the row count; most frequent first when ordered."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)
    return found.orderBy(F.desc("row_count"), *keys) if ordered else found


def conflicts(df: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Keys under which more than one distinct payload was sent; NULL fields count as values."""
    states = F.countDistinct(F.struct(*payload)).alias("states")
    return df.groupBy(*keys).agg(states).filter(F.col("states") > 1)


def check(df: DataFrame, condition: Column, name: str) -> DataFrame:
    """PASS when the aggregate condition holds over the whole frame, else FAIL."""
    return df.agg(F.when(condition, F.lit("PASS")).otherwise(F.lit("FAIL")).alias(name))


def idempotence_check(df: DataFrame, key: str, name: str = "idempotence_check") -> DataFrame:
    """PASS when every row has its own non-NULL key."""
    rows, known, distinct = F.count(F.lit(1)), F.count(F.col(key)), F.countDistinct(F.col(key))
    return check(df, (rows == distinct) & (rows == known), name)


def mismatch(df: DataFrame, expected: Column, actual: str) -> DataFrame:
    """Rows whose computed column differs from the rule it must follow."""
    wrong = F.count_if(F.col(actual) != expected)
    return df.agg(
        F.count(F.lit(1)).alias("output_rows"),
        wrong.alias("invalid_rows"),
        F.when((F.count(F.lit(1)) > 0) & (wrong == 0), "PASS").otherwise("FAIL").alias("result"),
    )


def delay_check(pairs: DataFrame, left_time: str, right_time: str, within_seconds: int) -> DataFrame:
    """Match count and PASS/FAIL: at least one match and every delay inside the range."""
    late = F.col(right_time) > F.col(left_time) + F.expr(f"INTERVAL {int(within_seconds)} SECONDS")
    bad = F.count_if((F.col(right_time) < F.col(left_time)) | late)
    return pairs.agg(
        F.count(F.lit(1)).alias("matched_rows"),
        bad.alias("invalid_matches"),
        F.when((F.count(F.lit(1)) > 0) & (bad == 0), "PASS").otherwise("FAIL").alias("result"),
    )


def double_native(df: DataFrame, source: str = "transaction_id", target: str = "processed_value") -> DataFrame:
    """The business rule as a native expression, in place of a row-wise Python function."""
    return df.withColumn(target, F.col(source) * 2)


def anomaly_profile(
    orders: DataFrame,
    payments: DataFrame,
    events: DataFrame,
    customer: str = "customer_id",
    amount: str = "amount",
    status: str = "status",
    known_statuses: Sequence[str] = ("accepted", "refused", "refunded"),
    event_id: str = "event_id",
    event_time: str = "event_time",
) -> DataFrame:
    """One row per injected anomaly kind: metric, rows, oldest (the event row only).

    The hottest customer is measured after a per-customer count, so no customer's orders are
    brought together.
    """
    hottest = orders.groupBy(customer).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("hottest_key_rows"))
    paid = payments.agg(
        F.count_if(F.col(amount).isNull()).alias("null_amounts"),
        F.count_if(~F.col(status).isin(*known_statuses)).alias("invalid_statuses"),
    )
    seen = events.agg(
        (F.count(F.col(event_id)) - F.countDistinct(F.col(event_id))).alias("duplicate_ids"),
        F.min(F.col(event_time)).alias("oldest"),
    )
    none = F.lit(None).cast(events.schema[event_time].dataType).alias("oldest")

    def row(df: DataFrame, metric: str, oldest: Column = none) -> DataFrame:
        return df.select(F.lit(metric).alias("metric"), F.col(metric).cast("long").alias("rows"), oldest)

    both = paid.select(
        F.explode(
            F.array(
                F.struct(F.lit("null_amounts").alias("metric"), F.col("null_amounts").alias("rows")),
                F.struct(F.lit("invalid_statuses").alias("metric"), F.col("invalid_statuses").alias("rows")),
            )
        ).alias("x")
    ).select("x.metric", "x.rows", none)
    return (
        row(hottest, "hottest_key_rows")
        .unionByName(both)
        .unionByName(row(seen, "duplicate_ids", F.col("oldest")))
    )

"""One row out of many per key, and joins against such latest rows.

``row_number() = 1`` is planned by Spark with a group limit before the exchange: every task
sends at most one row per key, so a key that holds a third of the table does not pile up in
one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    post_filter: str | Column | None = None,
    drop_null_keys: bool = False,
) -> DataFrame:
    """The row with the greatest ``order`` per key; ``post_filter`` sees only those rows.

    Names in ``order`` sort descending, NULLs last; pass a Column for any other direction.
    NULL keys form a group of their own unless ``drop_null_keys`` is set.
    """
    if drop_null_keys:
        for key in keys:
            df = df.filter(F.col(key).isNotNull())
    by = [F.col(c).desc() if isinstance(c, str) else c for c in order]
    window = Window.partitionBy(*keys).orderBy(*by)
    latest = df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
    return latest.filter(post_filter) if post_filter is not None else latest


def drop_exact(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Remove copies that agree on ``columns``."""
    return df.dropDuplicates(list(columns))


def latest_version(df: DataFrame, key: str | Sequence[str], seq: str, tie: Sequence[str] = ()) -> DataFrame:
    """Highest sequence number per key.

    Exact copies need no pass of their own: the ranking keeps one of them either way, and
    that saves a shuffle of the whole batch.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return latest_per_key(df, keys, [seq, *tie])


def missing_keys(source: DataFrame, target: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not have."""
    keys = [key] if isinstance(key, str) else list(key)
    return source.join(target.select(*keys), keys, "left_anti")


def left_latest(fact: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep every fact row; add the dimension row of its key (one per key) or NULLs."""
    return fact.join(dim, list(keys), "left")


def newest(df: DataFrame, column: str, n: int = 20, tie: Sequence[str] = ()) -> DataFrame:
    """The n newest rows (a top-k report)."""
    return df.orderBy(F.desc(column), *[F.desc(c) for c in tie]).limit(n)


def snapshot(df: DataFrame, key: str, n: int) -> list:
    """At most n rows in key order for a report; more than n is an error, never a silent cut."""
    rows = df.orderBy(key).limit(n + 1).collect()
    if len(rows) > n:
        raise ValueError(f"SNAPSHOT_TOO_LARGE: more than {n} rows")
    return rows

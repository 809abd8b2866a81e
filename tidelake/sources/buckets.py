"""State tables cut into key buckets, so that a batch rewrites only the buckets it touches.

A published table (:mod:`tidelake.sources.tables`) is written whole at every merge, which suits
batches that touch most of it. Here a version is a list of folders, one per bucket of the key's
hash: a merge writes the batch's buckets to new folders, then publishes a list in which they replace
the old ones. Nothing is overwritten, so a merge that fails half-way leaves the version before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.cdc import INSERTED, merge_metrics, state_of
from tidelake.sources.tables import (
    ATTEMPTS,
    SCHEMA_FOLDER,
    VersionConflict,
    publish,
    read_evolving,
    read_version,
)

Apply = Callable[[DataFrame, DataFrame], DataFrame]


def bucket_number(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, key: str, buckets: int) -> str:
    """Rows in new folders, one a bucket; adaptive execution splits a large bucket into several files."""
    folder = f"{path}/d-{uuid.uuid4().hex}"
    placed = rows.withColumn("_bucket", bucket_number(key, buckets))
    placed.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(folder)
    placed.limit(0).write.parquet(f"{folder}/{SCHEMA_FOLDER}")
    return folder


def _listed(spark: SparkSession, path: str) -> tuple[int, dict[int, str]]:
    """The current version, and where each bucket lies in it; at most as many as there are buckets."""
    version, rows = read_version(spark, path)
    return version, {row.bucket: row.folder for row in rows.collect()}


def _folders(spark: SparkSession, path: str) -> dict[int, str]:
    return _listed(spark, path)[1]


def _publish(spark: SparkSession, path: str, folders: dict[int, str], operation: str, read: int | None = None) -> None:
    listed = spark.createDataFrame(sorted(folders.items()), "bucket int, folder string")
    publish(listed.coalesce(1), path, operation, read=read)


def create_buckets(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """First version of the table."""
    written = _write(rows.withColumn("_action", F.lit(INSERTED)), path, key, buckets)
    _publish(rows.sparkSession, path, {n: written for n in range(buckets)}, "CREATE TABLE")


def _read(spark: SparkSession, folders: dict[int, str]) -> DataFrame:
    """Rows of the given buckets, each from its folder; other partitions are not read."""
    by_folder: dict[str, list[int]] = {}
    for number, folder in folders.items():
        by_folder.setdefault(folder, []).append(number)
    parts = [read_evolving(spark, folder).filter(F.col("_bucket").isin(own)) for folder, own in by_folder.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.drop("_bucket")


def read_buckets(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """The current rows, of some buckets if given."""
    folders = _folders(spark, path)
    return state_of(_read(spark, {n: f for n, f in folders.items() if only is None or n in only}))


def merge_into_buckets(
    spark: SparkSession, path: str, key: str, batch: DataFrame, apply: Apply, buckets: int
) -> dict[str, int]:
    """Apply a batch with ``apply(target, batch) -> merged`` to the buckets of its keys; returns the counters.

    Only bucket numbers and folders, at most ``buckets``, reach the driver. Deleted rows stay in the
    files with their action until the next merge of their bucket. Writers of different buckets both
    succeed; of two writers of one bucket the second raises ``VersionConflict``.
    """
    numbered = batch.select(bucket_number(key, buckets).alias("n")).distinct()
    touched = sorted(row.n for row in numbered.collect())
    if not touched:
        return {"inserted_rows": 0, "updated_rows": 0, "deleted_rows": 0}
    version, folders = _listed(spark, path)
    target = state_of(_read(spark, {n: folders[n] for n in touched}))
    written = _write(apply(target, batch), path, key, buckets)
    for left in reversed(range(ATTEMPTS)):
        try:
            _publish(spark, path, folders | {n: written for n in touched}, "MERGE", version)
            break
        except VersionConflict:
            version, now = _listed(spark, path)
            # A writer of other buckets does not matter: its folders are taken over. One of these does.
            if not left or any(now[n] != folders[n] for n in touched):
                raise
            folders = now
    return merge_metrics(read_evolving(spark, written)).first().asDict()

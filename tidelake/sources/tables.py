"""Reading and publishing tables on plain files.

A published table is a folder with one sub-folder per version and an append-only ``_history``.
Readers follow the last history row, which is written after the data, so a table is never
overwritten while it is read and a failed publication stays invisible.

Writers are optimistic. One that changes what it has read (a merge) names the version it read, and
publishes only while that one is current; otherwise it raises :class:`VersionConflict`, and
:func:`retried` reads and merges again. A writer that replaces the table whatever is in it names none.
Two writers of one version are told apart by creating the same marker file, which needs a file system
where "create, unless it exists" is one step: HDFS, local disks and the like, and object stores only
where their Hadoop connector creates conditionally. On others, run one writer at a time.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple, TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.operators.cdc import state_of

HISTORY = "version long, timestamp timestamp, operation string, userName string, location string"

#: Longer than any file is old: the file source forgets, and then passes over, files beyond its
#: maximum age. Remembering all of them costs the driver about 200 bytes a file.
NO_FILE_TOO_OLD = "36500d"
SCHEMA_FOLDER = "_columns"
#: How often a writer starts again that finds its version is no longer current.
ATTEMPTS = 5

Result = TypeVar("Result")


class VersionConflict(RuntimeError):
    """Another writer published, or is publishing, since the version was read."""


class Version(NamedTuple):
    """A published version and its rows; of a merge result, those that remain."""

    number: int
    rows: DataFrame


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a parquet folder by path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """An appended folder whose files may have different columns; without files yet, empty."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.parquet(f"{path}/{SCHEMA_FOLDER}").limit(0)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A parquet folder of a known schema; without the folder, no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def history(spark: SparkSession, path: str) -> DataFrame:
    """Publications of a table, oldest first; empty when there are none."""
    try:
        return spark.read.schema(HISTORY).json(f"{path}/_history")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], HISTORY)


def _last(spark: SparkSession, path: str):
    rows = history(spark, path).orderBy(F.desc("version")).limit(1).collect()
    return rows[0] if rows else None


def table_exists(spark: SparkSession, path: str) -> bool:
    return _last(spark, path) is not None


def current_version(spark: SparkSession, path: str) -> int:
    """Number of the last published version, -1 before the first."""
    last = _last(spark, path)
    return -1 if last is None else last.version


def claim(spark: SparkSession, path: str, version: int) -> None:
    """Take a version for this writer; the file system lets only one create the marker.

    A writer that died leaves its marker behind; :func:`release_claim` lets the version be written
    again once it is known to be dead.
    """
    marker = _hadoop_path(spark, f"{path}/_claims/v{version:08d}")
    if not marker.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(marker):
        raise VersionConflict(f"VERSION_TAKEN: {path} version {version} is being written, or was left unfinished")


def release_claim(spark: SparkSession, path: str, version: int) -> None:
    marker = _hadoop_path(spark, f"{path}/_claims/v{version:08d}")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).delete(marker, False)


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def read_version(spark: SparkSession, path: str) -> Version:
    """The last published version, with its number for :func:`publish`."""
    last = _last(spark, path)
    if last is None:
        raise ValueError(f"TABLE_NOT_FOUND: {path}")
    rows = spark.read.parquet(last.location)
    return Version(last.version, state_of(rows) if "_action" in rows.columns else rows)


def current(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last published version; of a merge result, those that remain."""
    return read_version(spark, path).rows


def publish(
    df: DataFrame,
    path: str,
    operation: str,
    partition_by: Sequence[str] = (),
    name: str | None = None,
    read: int | None = None,
) -> DataFrame:
    """Write ``df`` as the next version and make it current; returns the written table.

    ``df`` may be computed from the current version; ``read`` is then that version's number, and the
    publication fails before it writes if the table has moved on. The returned frame reads the files, so
    counts on it do not repeat the work. With ``name`` the catalog view of that name shows the
    current rows from then on, in every session that shares the catalog.
    """
    spark = df.sparkSession
    last = current_version(spark, path)
    if read is not None and last != read:
        raise VersionConflict(f"VERSION_MOVED: {path} is at version {last}, not {read}")
    version = last + 1
    location = f"{path}/v{version:08d}-{uuid.uuid4().hex[:8]}"
    with _claimed(spark, path, version):
        df.write.partitionBy(*partition_by).parquet(location)
        record_version(spark, path, version, operation, location)
    if name is not None:
        gone = " WHERE _action <> 'deleted'" if "_action" in df.columns else ""
        shown = ", ".join(f"`{c}`" for c in df.columns if c not in ("_action", "_before"))
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {shown} FROM parquet.`{location}`{gone}")
    return spark.read.parquet(location)


def retried(change: Callable[[], Result], attempts: int = ATTEMPTS, wait_seconds: float = 1) -> Result:
    """``change()``, done again from its reading on while other writers come first, with growing waits."""
    for attempt in range(attempts - 1):
        try:
            return change()
        except VersionConflict:
            time.sleep(wait_seconds * 2**attempt)
    return change()


@contextmanager
def _claimed(spark: SparkSession, path: str, version: int) -> Iterator[None]:
    """Hold the claim on a version; given back when writing it fails."""
    claim(spark, path, version)
    try:
        yield
    except BaseException:
        release_claim(spark, path, version)
        raise


def record_version(spark: SparkSession, path: str, version: int, operation: str, location: str) -> None:
    """The history row that makes a written version current."""
    row = spark.range(1).select(
        F.lit(version).cast("long").alias("version"),
        F.current_timestamp().alias("timestamp"),
        F.lit(operation).alias("operation"),
        F.current_user().alias("userName"),
        F.lit(location).alias("location"),
    )
    row.coalesce(1).write.mode("append").json(f"{path}/_history")


def ensure_like(df: DataFrame, path: str) -> DataFrame:
    """The current table, created empty with the columns of ``df`` when there is none yet."""
    return ensure_version(df, path).rows


def ensure_version(df: DataFrame, path: str) -> Version:
    """The same, with the version's number for :func:`publish`."""
    spark = df.sparkSession
    if not table_exists(spark, path):
        publish(spark.createDataFrame([], df.schema), path, "CREATE TABLE", read=-1)
    return read_version(spark, path)


def append_audit(df: DataFrame, path: str, pass_id: str) -> None:
    """Add the rows of one pass to a log; the same pass written again replaces its rows."""
    passes = df.withColumn("_pass_id", F.lit(pass_id)).write.mode("overwrite").partitionBy("_pass_id")
    passes.option("partitionOverwriteMode", "dynamic").parquet(path)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows that may bring new columns; read back with :func:`read_evolving`."""
    df.write.mode("append").parquet(path)


def write_batch_once(df: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    """Write a micro-batch so that a retry replaces it instead of adding to it.

    The batch owns the partition (run id, batch id) and overwrites that partition alone. The
    run id is the id of the streaming query, which a restart keeps and a new checkpoint changes.
    The columns are kept beside the rows, for as long as there are none.
    """
    df.limit(0).write.mode("ignore").parquet(f"{path}/{SCHEMA_FOLDER}")
    (
        df.withColumns({"_run_id": F.lit(run_id), "_batch_id": F.lit(batch_id).cast("long")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_run_id", "_batch_id")
        .parquet(path)
    )


def list_tables(spark: SparkSession, schemas: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Catalog tables of the schemas, views and ``exclude`` left out, in name order."""
    found = [
        (table.catalog, table.namespace[-1] if table.namespace else None, table.name)
        for schema in schemas
        for table in spark.catalog.listTables(schema)
        if table.tableType not in ("VIEW", "TEMPORARY")
    ]
    listed = spark.createDataFrame(found, "catalog_name string, schema_name string, table_name string")
    return listed.filter(~F.col("table_name").isin(*exclude)).orderBy("schema_name", "table_name")


def replay_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A parquet table as a stream, in file order; ``path`` may be a folder or one file."""
    reader = spark.readStream.schema(schema).option("maxFileAge", NO_FILE_TOO_OLD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A pattern, since a stream over a literal path accepts folders only.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")

"""Session construction and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_dirs: dict[str, str] = {}


def get_spark(app_name: str = "tidelake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on: UTC, ANSI, adaptive execution.

    Stream state lives in RocksDB, off the executors' heap, so it may outgrow memory.
    Shuffle partitions and memory are left to the cluster; pass them through ``conf``
    with underscores in place of dots where a test needs other values.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may do without it: there driver and executors share one disk. The folder is
    then a temporary one, removed when the program ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        application = spark.sparkContext.applicationId
        if application not in _local_dirs:
            _local_dirs[application] = tempfile.mkdtemp(prefix="tidelake-")
            atexit.register(shutil.rmtree, _local_dirs[application], ignore_errors=True)
        return _local_dirs[application]
    raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed now, written to the shared folder and read back: later readers do not repeat its work."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

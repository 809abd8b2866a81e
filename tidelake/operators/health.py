"""Table health: size and layout per table, version history, small files."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.sources.landing import unescaped
from tidelake.sources.tables import read_evolving

log = logging.getLogger(__name__)


def catalog_locations(spark: SparkSession, listed: DataFrame) -> dict[str, str]:
    """Folder of every listed catalog table; table names are metadata and few."""
    locations = {}
    for row in listed.collect():
        name = f"{row.schema_name}.{row.table_name}"
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
        if described is not None:
            locations[name] = described.data_type
    return locations


def table_detail(
    spark: SparkSession, locations: Mapping[str, str], formats: Mapping[str, str] | None = None
) -> DataFrame:
    """Per table: catalog, schema, format, location, first and last file time, bytes, files, partition columns.

    Names may be ``table``, ``schema.table`` or ``catalog.schema.table``; what they leave out is NULL.

    The files are listed by Spark and grouped in one job; their contents are not read. A table
    that cannot be listed is logged and left out. Plain files have no clustering columns.
    """
    listings = []
    for name, location in locations.items():
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location)
        except PySparkException as error:
            log.warning("table %s skipped: %s", name, error)
            continue
        kind = (formats or {}).get(name, "parquet")
        listings.append(
            files.select(
                F.lit(name).alias("table_name"),
                F.lit(kind).alias("format"),
                F.lit(location).alias("location"),
                "path",
                "length",
                "modificationTime",
            )
        )
    if not listings:
        raise ValueError("NO_TABLE_LISTED")
    folders = F.regexp_extract_all(F.col("path"), F.lit(r"/([^/=]+)=[^/]*(?=/)"), F.lit(1))
    return (
        reduce(DataFrame.unionByName, listings)
        .groupBy("table_name", "format", "location")
        .agg(
            F.min("modificationTime").alias("created_at"),
            F.max("modificationTime").alias("last_modified"),
            F.sum("length").alias("size_in_bytes"),
            F.count(F.lit(1)).alias("num_files"),
            F.max(folders).alias("partition_columns"),
        )
        .withColumns(
            {
                "clustering_columns": F.array().cast("array<string>"),
                "schema_name": F.get(F.reverse(F.split("table_name", r"\.")), 1),
                "catalog_name": F.get(F.reverse(F.split("table_name", r"\.")), 2),
            }
        )
    )


def table_history(history: DataFrame, n: int = 20) -> DataFrame:
    """The last n versions of every table, from an append-only write log."""
    newest = Window.partitionBy("table_name").orderBy(F.desc("version"))
    return history.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")


def file_layout(df: DataFrame, layout: str, file_column: str = "_source_file") -> DataFrame:
    """Rows and source files of a layout, to set many small files against few large ones.

    Rows are counted per file first, so the distinct count runs over files, not rows.
    """
    per_file = df.groupBy(file_column).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.lit(layout).alias("layout"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("source_files"),
        F.max("n").alias("largest_file_rows"),
    )


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = 512 << 20) -> DataFrame:
    """Rewrite a parquet folder of small files as files of about ``file_bytes``; returns the new table.

    All columns of all files are kept, and the partition folders too.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    folders = F.regexp_extract_all(F.col("path"), F.lit(r"/([^/=]+)=[^/]*(?=/)"), F.lit(1))
    found = listed.agg(F.sum("length").alias("size"), F.max(folders).alias("folders")).first()
    rows = read_evolving(spark, source)
    partitions = [c for c in rows.columns if c in (found.folders or [])]
    parts = max(1, -(-(found.size or 0) // file_bytes))
    # With folders, adaptive execution splits large ones and puts small ones together.
    rows = rows.hint("rebalance", *partitions) if partitions else rows.repartition(parts)
    rows.write.partitionBy(*partitions).parquet(target)
    return read_evolving(spark, target)


STAGED, REPLACED, READY = "rows", "replaced", "_READY"


def compact_small_files(spark: SparkSession, path: str, small_bytes: int = 128 << 20, file_bytes: int = 512 << 20) -> int:
    """Put the small files of a parquet folder together, where they are; returns how many were replaced.

    Files of ``small_bytes`` or more are neither read nor moved. Spark prunes by file size, reads the
    small ones, and adaptive execution packs their rows into files of about ``file_bytes`` a partition
    folder. The new files are staged in a hidden folder beside a list of those they replace; then the
    new ones are moved in and the old ones deleted. A run that stops in between is finished, or
    undone, by the next one. Readers should pause: while files are moved they may see rows twice.
    """
    work = f"{path}/_compaction"
    replaced = _finish_compaction(spark, path, work)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listed = listed.select(F.col("_metadata.file_path").alias("path"), "length")
    folder = F.regexp_extract("path", "^(.*)/", 1)
    small = listed.filter(F.col("length") < small_bytes)
    # A single small file has nothing to be put together with.
    groups = small.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files")).filter("files > 1")
    if groups.isEmpty():
        return replaced
    rows = read_evolving(spark, path).filter(F.col("_metadata.file_size") < small_bytes)
    names = F.regexp_extract_all(F.col("path"), F.lit(r"/([^/=]+)=[^/]*(?=/)"), F.lit(1))
    partitions = [c for c in rows.columns if c in (listed.agg(F.max(names)).first()[0] or [])]
    small.join(groups, folder == F.col("folder"), "left_semi").select("path").write.parquet(f"{work}/{REPLACED}")
    old = spark.read.parquet(f"{work}/{REPLACED}")
    rows = rows.withColumn("_file", F.col("_metadata.file_path")).join(old, F.col("_file") == F.col("path"), "left_semi")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    own = spark.newSession()
    own.conf.set(size, str(file_bytes))
    view = f"compaction_{uuid.uuid4().hex}"
    rows.drop("_file").createGlobalTempView(view)
    try:
        packed = own.table(f"global_temp.{view}").hint("rebalance", *partitions)
        packed.write.partitionBy(*partitions).parquet(f"{work}/{STAGED}")
    finally:
        spark.catalog.dropGlobalTempView(view)
    hadoop, system = _file_system(spark, work)
    system.create(hadoop(f"{work}/{READY}")).close()
    return replaced + _finish_compaction(spark, path, work)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop, hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _finish_compaction(spark: SparkSession, path: str, work: str) -> int:
    """Move staged files in and delete those they replace, if staging was complete; then clear it away."""
    hadoop, system = _file_system(spark, path)
    count = 0
    if system.exists(hadoop(f"{work}/{READY}")):
        staged = f"{work}/{STAGED}"
        base = system.makeQualified(hadoop(staged)).toString()
        if system.exists(hadoop(staged)):
            files = system.listFiles(hadoop(staged), True)
            while files.hasNext():
                file = files.next().getPath()
                if file.getName()[0] not in "_.":
                    target = hadoop(f"{path}{file.toString()[len(base):]}")
                    system.mkdirs(target.getParent())
                    if not system.rename(file, target):
                        raise RuntimeError(f"NOT_MOVED: {file.toString()}")
        for row in spark.read.parquet(f"{work}/{REPLACED}").select(unescaped("path").alias("path")).toLocalIterator():
            system.delete(hadoop(row.path), False)
            count += 1
    system.delete(hadoop(work), True)
    return count

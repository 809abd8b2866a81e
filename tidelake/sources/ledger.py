"""A ledger of landed files: which files were taken, in which batch, kept as a table.

A stream's checkpoint remembers files too, but the driver holds them all. Here files are listed one
folder of the landing root at a time (a delivery date), and joined with the ledger's rows of that
folder; what the ledger does not have is dealt into batches, written down, and then handed over.
Driver memory is bounded by the folders' names and by one folder's listing, not by all files ever landed.

A batch is written down before its rows are, with a number that it keeps. A run that finds a batch
without its mark of completion repeats it with the same files and number, and handlers overwrite
what belongs to their number (:func:`tidelake.sources.tables.write_batch_once`), so each file counts once.
One landing at a time may use a ledger.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.sources.landing import FILE_SCHEMA, Handler, read_landed
from tidelake.sources.tables import _hadoop_path, read_or_empty
from tidelake.streaming.ingest import RUN_ID

FILES = "path string, length long, batch_id long, folder string"
DONE = "batch_id long, rows_handed_over boolean"
RUN = "run_id string"
#: The name under which files that are in no folder of the root are kept.
LOOSE = "."


def folders_of(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly under ``root``, in order; ``LOOSE`` stands for files directly in it."""
    place = _hadoop_path(spark, root)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found, loose = [], False
    statuses = system.listStatusIterator(place)
    while statuses.hasNext():
        status = statuses.next()
        name = status.getPath().getName()
        if name[0] in "._" and "=" not in name:
            continue
        if status.isDirectory():
            found.append(name)
        else:
            loose = True
    return ([LOOSE] if loose else []) + sorted(found)


def files_of(spark: SparkSession, root: str, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(path, length) of the files in one folder, at any depth; of ``LOOSE``, those directly under ``root``."""
    files = spark.read.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", pattern)
    if folder != LOOSE:
        return files.option("recursiveFileLookup", True).load(f"{root}/{folder}").select("path", "length")
    place = _hadoop_path(spark, root)
    place = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    # The pattern opens the folders too, whose files are listed under their own names.
    own = F.regexp_extract("path", "^(.*)/[^/]*$", 1) == place.rstrip("/")
    return files.load(f"{root}/*").select("path", "length").filter(own)


class Ledger:
    """The landed files under ``path``: a table of files by folder, and one of completed batches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def files(self) -> DataFrame:
        """(path, length, batch_id, folder) of every file taken."""
        return read_or_empty(self.spark, f"{self.path}/files", FILES)

    def done(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/done", DONE)

    def run_id(self) -> str:
        """An id as old as the ledger: a lost ledger starts with a new one, and so with partitions of its own."""
        known = read_or_empty(self.spark, f"{self.path}/run", RUN).first()
        if known is None:
            row = self.spark.createDataFrame([(str(uuid.uuid4()),)], RUN)
            row.coalesce(1).write.parquet(f"{self.path}/run")
            return self.run_id()
        return known.run_id

    def take(self, listed: DataFrame, folder: str, max_files: int) -> None:
        """Write down the files of a folder that the ledger does not have, dealt into batches of about ``max_files``."""
        known = self.files().filter(F.col("folder") == folder).select("path")
        new = listed.join(known, "path", "left_anti").persist()
        try:
            count = new.count()
            if not count:
                return
            first = (self.files().agg(F.max("batch_id")).first()[0] or 0) + 1
            batch = first + F.pmod(F.xxhash64("path"), F.lit(-(-count // max_files)))
            rows = new.withColumns({"batch_id": batch, "folder": F.lit(folder)})
            rows.write.mode("append").partitionBy("folder").parquet(f"{self.path}/files")
        finally:
            new.unpersist()

    def open_batches(self, folder: str) -> list[int]:
        """Numbers of the folder's batches that are written down and not completed."""
        own = self.files().filter(F.col("folder") == folder).select("batch_id").distinct()
        return sorted(row.batch_id for row in own.join(self.done(), "batch_id", "left_anti").collect())

    def complete(self, batch_id: int, handed_over: bool) -> None:
        row = self.spark.createDataFrame([(batch_id, handed_over)], DONE)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/done")


def pending(ledger: Ledger, root: str, pattern: str, max_files: int) -> Iterator[tuple[int, DataFrame]]:
    """(batch number, its files) of every batch to hand over, folder by folder."""
    for folder in folders_of(ledger.spark, root):
        ledger.take(files_of(ledger.spark, root, folder, pattern), folder, max_files)
        for number in ledger.open_batches(folder):
            own = (F.col("folder") == folder) & (F.col("batch_id") == number)
            yield number, ledger.files().filter(own).select("path", "length")


def land_with_ledger(
    spark: SparkSession,
    root: str,
    path: str,
    handler: Handler,
    schema: Mapping[str, str] | None = None,
    schema_location: str | None = None,
    hints: Mapping[str, str] | None = None,
    pattern: str = "*.csv",
    max_files: int = 1000,
) -> int:
    """Hand the rows of all files that the ledger at ``path`` does not have to ``handler``; returns the batches.

    Schemas are as in :func:`tidelake.sources.landing.land_files`.
    """
    ledger, context, handed_over = Ledger(spark, path), spark.sparkContext, 0
    before = context.getLocalProperty(RUN_ID)
    context.setLocalProperty(RUN_ID, ledger.run_id())
    try:
        for number, files in pending(ledger, root, pattern, max_files):
            rows = read_landed(files, schema, schema_location, hints)
            if rows is not None:
                handler(rows, number)
            ledger.complete(number, rows is not None)
            handed_over += 1
    finally:
        context.setLocalProperty(RUN_ID, before)
    return handed_over


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(folder, batch_id, path) of the files in completed batches."""
    ledger = Ledger(spark, path)
    taken = ledger.files().join(ledger.done(), "batch_id", "left_semi")
    return taken.select("folder", "batch_id", "path")

"""Incremental landing of CSV files, with columns matched by name across headers.

The stream carries the file *list*; the checkpoint remembers which files were taken. In each
micro-batch only paths and headers reach the driver, at most ``max_files`` of them; rows are
read by Spark, one native CSV read per distinct header. A header is read one way, whatever the
size of its file (:func:`header_names`).
"""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelake.functions.rules import with_ingestion_date, with_lineage, with_rescued
from tidelake.sources.schemas import resolve_schema
from tidelake.sources.tables import NO_FILE_TOO_OLD

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
MALFORMED = "_malformed"
OTHERS = "_others"
#: One file a partition for the reading of headers: no file is this long.
WHOLE_FILE = str(1 << 50)

Handler = Callable[[DataFrame, int], None]


def file_stream(
    spark: SparkSession, root: str, pattern: str = "*.csv", max_files: int = 1000
) -> DataFrame:
    """Stream of the files under ``root``, each once per checkpoint however old it is; contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", NO_FILE_TOO_OLD)
        .load(root)
        .select("path", "length")
    )


def header_names(line: str) -> tuple[str, ...]:
    """Column names of a header line, as Spark's reader would name them, with spaces around them taken off.

    Quotes are undone; an empty name becomes ``_c`` and its place; names that repeat within the line,
    letter for letter, get their place behind them.
    """
    names = [name.strip() for name in next(csv.reader([line.removeprefix("\ufeff").rstrip("\r")]))]
    count = Counter(names)
    return tuple(f"_c{i}" if not n else f"{n}{i}" if count[n] > 1 else n for i, n in enumerate(names))


def unescaped(path: str | Column) -> Column:
    """A file path as it is written; Spark's own column of paths escapes characters."""
    return F.try_url_decode(F.replace(F.col(path) if isinstance(path, str) else path, F.lit("+"), F.lit("%2B")))


def group_by_header(listed: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """Paths of the files per header, in path order; files without any text are left out.

    One job reads a line of every file, one file a task, and stops there.
    """

    def first_line(rows: Iterator) -> Iterator[tuple[str, str]]:
        for path, line in rows:
            if line.strip("\ufeff \t\r"):
                yield path, line
                return

    spark = listed.sparkSession
    paths = sorted(row.path for row in listed.filter("length > 0").select("path").collect())
    if not paths:
        return {}
    # Planned in a session of its own, so that no other query meets these sizes.
    own = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(key, WHOLE_FILE)
    lines = own.read.text(paths).select("_metadata.file_path", "value").rdd.mapPartitions(first_line).collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line in sorted(lines):
        groups.setdefault(header_names(line), []).append(unquote(path))
    return groups


def read_group(spark: SparkSession, paths: Sequence[str], header: Sequence[str], known: Sequence[str]) -> DataFrame:
    """Files of one header as text: the ``known`` columns, all others in a map, with lineage.

    Names are known letter for letter; one that differs in case only is another. Lines of another
    width are kept in ``_rescued_data``.
    """
    places = {name: f"_p{i}" for i, name in enumerate(header)}
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*places.values(), MALFORMED]])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(list(paths))
    )
    line = F.when(F.col(MALFORMED).isNotNull(), F.to_json(F.struct(F.col(MALFORMED).alias("_line"))))
    extra = [part for name, place in places.items() if name not in known for part in (F.lit(name), F.col(place))]
    others = F.create_map(*extra) if extra else F.lit(None)
    return with_lineage(rows).select(
        *[F.col(places[name]).alias(name) if name in places else F.lit(None).cast("string").alias(name) for name in known],
        line.alias("_rescued_data"),
        "_ingestion_timestamp",
        "_source_file",
        others.cast("map<string,string>").alias(OTHERS),
    )


def read_landed(
    listed: DataFrame,
    schema: Mapping[str, str] | None = None,
    schema_location: str | None = None,
    hints: Mapping[str, str] | None = None,
) -> DataFrame | None:
    """Rows of the files, typed, with rescued data, lineage and landing date; None without any row source.

    With ``schema`` the types are given, and columns it does not name are kept in ``_rescued_data``.
    Otherwise they come from the stored schema, hints and, for columns never seen before, inference;
    new columns are recorded before rows are read. A column that differs from a known one in case
    only is rescued in either case.
    """
    groups = group_by_header(listed)
    if not groups:
        return None
    spark = listed.sparkSession
    if schema is None:
        schema = resolve_schema(spark, groups, schema_location, hints or {})
    frames = [read_group(spark, paths, header, list(schema)) for header, paths in groups.items()]
    rows = with_rescued(reduce(DataFrame.unionByName, frames), schema, OTHERS).drop(OTHERS)
    return rows if "ingestion_date" in schema else with_ingestion_date(rows)


def land_files(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    handler: Handler,
    schema: Mapping[str, str] | None = None,
    schema_location: str | None = None,
    hints: Mapping[str, str] | None = None,
    pattern: str = "*.csv",
    max_files: int = 1000,
) -> StreamingQuery:
    """Take every file not yet seen by this checkpoint, hand its rows to ``handler``, then stop."""

    def on_batch(listed: DataFrame, batch_id: int) -> None:
        rows = read_landed(listed, schema, schema_location, hints)
        if rows is not None:
            handler(rows, batch_id)

    query = (
        file_stream(spark, root, pattern, max_files)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def csv_stream(spark: SparkSession, root: str, schema: str | T.StructType, max_files: int = 1000) -> DataFrame:
    """Fixed-schema CSV stream with lineage, for landing folders whose files share one header."""
    rows = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", NO_FILE_TOO_OLD)
        .csv(root)
    )
    return with_lineage(rows)

"""Schema history of a landing folder: columns are only ever added."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

HISTORY = "version int, position int, column string, type string"


def stored_schema(spark: SparkSession, location: str | None) -> tuple[dict[str, str], int]:
    """Columns in order of appearance with their types, and the latest version number (0: none yet)."""
    if location is None:
        return {}, 0
    try:
        rows = spark.read.schema(HISTORY).json(location).orderBy("version", "position").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}, 0
    known: dict[str, str] = {}
    for row in rows:
        known.setdefault(row.column, row.type)
    return known, max((row.version for row in rows), default=0)


def resolve_schema(
    spark: SparkSession,
    groups: Mapping[tuple[str, ...], Sequence[str]],
    location: str | None,
    hints: Mapping[str, str],
) -> dict[str, str]:
    """Stored schema widened by the columns of these headers; the widening is stored first.

    A hint decides the type of a new column, else Spark infers it from the files that have it.
    Types of known columns never change: values that do not fit are rescued. Of names that differ in
    case only, the one known first is the column; tables could not hold both.
    """
    known, version = stored_schema(spark, location)
    added: dict[str, str] = {}
    for header, paths in groups.items():
        taken, fresh = {c.lower() for c in [*known, *added]}, []
        for column in header:
            if column.lower() not in taken:
                taken.add(column.lower())
                fresh.append(column)
        if not fresh:
            continue
        inferred: dict[str, str] = {}
        if any(c not in hints for c in fresh):
            kinds = spark.read.option("header", True).option("inferSchema", True).csv(list(paths)).dtypes
            # By place: the header may name columns in ways the reader does not.
            inferred = {name: kind for name, (_, kind) in zip(header, kinds)}
        for column in fresh:
            added[column] = hints.get(column) or inferred.get(column, "string")
    if added and location is not None:
        rows = [(version + 1, i, column, kind) for i, (column, kind) in enumerate(added.items())]
        spark.createDataFrame(rows, HISTORY).coalesce(1).write.mode("append").json(location)
    return {**known, **added}

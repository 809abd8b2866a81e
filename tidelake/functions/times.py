"""Time columns as whole seconds and fixed-width buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def seconds_of(df: DataFrame, name: str) -> Column:
    """Whole seconds since the epoch, floored, and monotone in the column.

    A zone-less timestamp is taken apart into date and clock fields, so the session time
    zone and its daylight-saving jumps have no part in the result.
    """
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("long") * F.lit(86400)
    if isinstance(kind, T.TimestampNTZType):
        clock = F.hour(col) * 3600 + F.minute(col) * 60 + F.floor(F.second(col)).cast("int")
        return F.unix_date(col.cast("date")).cast("long") * F.lit(86400) + clock.cast("long")
    return F.unix_seconds(col)


def bucket_of(df: DataFrame, name: str, width_seconds: int) -> Column:
    """Number of the fixed-width bucket that holds the time; NULL times have no bucket."""
    return F.floor(seconds_of(df, name) / F.lit(width_seconds)).cast("long")

"""Row rules: normalising, contract patterns, classification, tolerant casts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
ALLOWED_STATUSES = ("created", "paid", "shipped", "cancelled")
LANDING_CONTRACT = r".*/ingestion_date=\d{4}-\d{2}-\d{2}/batch_\d+/orders\.csv$"
INVALID_SOURCE_PATH = "INVALID_SOURCE_PATH"
SENSITIVE_ACTIONS = "grant|revoke|permission|privilege|delete|remove|token|secret"


def holds(condition: Column) -> Column:
    """Two-valued form of a predicate: NULL counts as not holding."""
    return F.coalesce(condition, F.lit(False))


def normalize_orders(df: DataFrame) -> DataFrame:
    """Type the business columns of raw orders; what does not convert becomes NULL."""
    return df.withColumns(
        {
            "order_id": F.col("order_id").try_cast("long"),
            "customer_id": F.col("customer_id").try_cast("long"),
            "order_date": F.col("order_date").try_cast("date"),
            "status": F.lower(F.trim(F.col("status"))),
            "ingestion_date": F.col("ingestion_date").try_cast("date"),
        }
    )


def order_rules(allowed: Iterable[str] = ALLOWED_STATUSES) -> list[Column]:
    """What a valid order keeps: its three required values, a known status, nothing rescued."""
    required = [F.col(name).isNotNull() for name in ("order_id", "customer_id", "order_date")]
    return [*required, F.col("status").isin(*allowed), F.col("_rescued_data").isNull()]


def order_is_valid(allowed: Iterable[str] = ALLOWED_STATUSES) -> Column:
    """All order rules as one predicate (three-valued: NULL status gives NULL)."""
    return reduce(lambda a, b: a & b, order_rules(allowed))


def event_category(status_code: Column, action: Column, sensitive: str = SENSITIVE_ACTIONS) -> Column:
    """ERROR from code 400 up, else SENSITIVE by action name, else STANDARD; NULL codes fall through."""
    return (
        F.when(status_code.try_cast("int") >= 400, F.lit("ERROR"))
        .when(F.lower(action).rlike(sensitive), F.lit("SENSITIVE"))
        .otherwise(F.lit("STANDARD"))
    )


def with_rescued(df: DataFrame, types: Mapping[str, str], others: str | None = None) -> DataFrame:
    """Cast all-string columns and keep what did not fit, as JSON, in ``_rescued_data``.

    ``others`` names a map column of values the schema has no column for; they are kept as well.
    NULL means that nothing was rescued. An existing ``_rescued_data`` (a malformed line the
    reader kept) wins over the per-column values. Rows with nothing to keep build no map.
    """
    lost = {
        name: F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
        for name, kind in types.items()
        if kind.lower() != "string"
    }
    rescued = F.lit(None).cast("string")
    any_lost = F.lit(False)
    for flag in lost.values():
        any_lost = any_lost | flag
    if others:
        pairs = [F.create_map(F.lit(name), F.when(flag, F.col(name))) for name, flag in lost.items()]
        kept = F.map_filter(
            F.map_concat(*pairs, F.coalesce(F.col(others), F.create_map().cast("map<string,string>"))),
            lambda _, value: value.isNotNull(),
        )
        some = any_lost | (F.col(others).isNotNull() & (F.size(others) > 0))
        rescued = F.when(some, F.when(F.size(kept) > 0, F.to_json(kept)))
    elif lost:
        kept = F.struct(*[F.when(flag, F.col(name)).alias(name) for name, flag in lost.items()])
        rescued = F.when(any_lost, F.to_json(kept))
    if "_rescued_data" in df.columns:
        rescued = F.coalesce(F.col("_rescued_data"), rescued)
    typed = {name: F.col(name).try_cast(kind) for name, kind in types.items()}
    return df.withColumns({**typed, "_rescued_data": rescued})


def with_ingestion_date(df: DataFrame, file_column: str = "_source_file") -> DataFrame:
    """Landing date from the folder name; NULL when the path does not carry one."""
    found = F.regexp_extract(F.col(file_column), r"ingestion_date=(\d{4}-\d{2}-\d{2})", 1)
    return df.withColumn("ingestion_date", F.nullif(found, F.lit("")).try_cast("date"))


def with_lineage(df: DataFrame) -> DataFrame:
    """Reception time and source file of every row read from files."""
    return df.withColumns(
        {"_ingestion_timestamp": F.current_timestamp(), "_source_file": F.col("_metadata.file_path")}
    )


def split_by_contract(df: DataFrame, pattern: str = LANDING_CONTRACT, file_column: str = "_source_file") -> tuple[DataFrame, DataFrame]:
    """Rows whose path keeps the contract, and all others with their quarantine reason."""
    keeps = holds(F.col(file_column).rlike(pattern))
    broken = df.filter(~keeps).withColumn("_quarantine_reason", F.lit(INVALID_SOURCE_PATH))
    return df.filter(keeps), broken


def only_paths(df: DataFrame, pattern: str, file_column: str = "_source_file") -> DataFrame:
    """Keep the rows of a sub-set of files."""
    return df.filter(F.col(file_column).rlike(pattern))

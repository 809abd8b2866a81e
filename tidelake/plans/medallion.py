"""Bronze to silver to gold over published tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from tidelake.functions.rules import ALLOWED_STATUSES, normalize_orders
from tidelake.operators import cdc, gold
from tidelake.operators.quality import invalid_orders, valid_orders
from tidelake.operators.versions import latest_per_key
from tidelake.sources.tables import append_audit, ensure_version, publish, read_version, retried

ORDER_VERSION = ("_ingestion_timestamp", "_source_file")


def silver_orders(bronze: DataFrame, allowed: Iterable[str] = ALLOWED_STATUSES) -> tuple[DataFrame, DataFrame]:
    """Clean rows, one per order, and the quarantined rest of the normalised input."""
    normal = normalize_orders(bronze)
    clean = latest_per_key(valid_orders(normal, allowed), ["order_id"], list(ORDER_VERSION))
    return clean, invalid_orders(normal, allowed)


def refresh_orders(spark: SparkSession, bronze: DataFrame, root: str) -> dict[str, int]:
    """One run of the order pipeline; every count is taken from what was written."""
    clean, rejected = silver_orders(bronze)
    written = publish(clean, f"{root}/silver/orders_clean", "OVERWRITE")
    quarantine = publish(rejected, f"{root}/silver/orders_quarantine", "OVERWRITE")

    target_path = f"{root}/silver/orders_current"

    def upsert() -> tuple[DataFrame, dict[str, int]]:
        version, target = ensure_version(written, target_path)
        return _publish_merge(cdc.upsert_newer(target, written, "order_id"), target_path, version)

    written_merge, metrics = retried(upsert)
    state = cdc.state_of(written_merge)
    daily = publish(gold.orders_daily(state), f"{root}/gold/orders_daily", "OVERWRITE")
    return {
        "clean": written.count(),
        "quarantined": quarantine.count(),
        "current": state.count(),
        **metrics,
        "daily_groups": daily.count(),
    }


def _publish_merge(merged: DataFrame, path: str, version: int) -> tuple[DataFrame, dict[str, int]]:
    """Write the merge result of a version once, partitioned by action; returns it as written, and its counters.

    The counters then come from file footers, and readers skip the deleted rows' partition.
    """
    written = publish(merged, path, "MERGE", partition_by=["_action"], read=version)
    return written, cdc.merge_metrics(written).first().asDict()


def run_merge(
    spark: SparkSession, path: str, apply: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, dict[str, int]]:
    """Publish ``apply(current rows)``; when another writer comes first, apply it to what that one left."""

    def change() -> tuple[DataFrame, dict[str, int]]:
        version, target = read_version(spark, path)
        return _publish_merge(apply(target), path, version)

    return retried(change)


def run_inserts_batch(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    key: str,
    columns: Sequence[str] | None = None,
) -> dict[str, int]:
    """Insert the events of keys the table does not have; everything else in the batch is ignored."""
    return run_merge(spark, path, lambda target: cdc.insert_new(target, batch, key, columns))[1]


def run_ops_batch(spark: SparkSession, batch: DataFrame, path: str, key: str) -> dict[str, int]:
    """Operation-driven batch, one event per key; two events of one key are an error."""
    cdc.reject_duplicate_keys(batch, [key])
    return run_merge(spark, path, lambda target: cdc.apply_ops(target, batch, key))[1]


def run_updates_batch(
    spark: SparkSession, batch: DataFrame, path: str, key: str, payload: Sequence[str]
) -> dict[str, int]:
    """Validated, versioned updates of known keys; nothing is written for a batch that fails."""
    latest, _ = cdc.normalize_batch(batch, key, payload, operations=("UPDATE",))

    def apply(target: DataFrame) -> DataFrame:
        cdc.reject_unknown_keys(latest, target, key)
        return cdc.apply_updates(target, latest, key, payload)

    return run_merge(spark, path, apply)[1]


def run_deletes_batch(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    audit_path: str,
    gold_path: str,
    key: str,
    pass_name: str,
) -> dict[str, int]:
    """Versioned deletes, an audit row per event judged on the state before, and the gold rebuild.

    The audit is written before the state, under the pass and the version it judged: a pass repeated
    after a failure replaces its own rows, and one that only has to publish finds its audit there. A
    pass that another writer overtakes leaves the audit of the version it had read, and writes a new one.
    """
    _, counts = cdc.normalize_batch(batch, key, (), operations=("DELETE",))
    if counts["keys_after_selection"] != counts["source_rows"]:
        raise ValueError("DUPLICATE_SOURCE_KEY")

    def delete() -> tuple[DataFrame, dict[str, int]]:
        version, target = read_version(spark, path)
        append_audit(cdc.delete_audit(target, batch, key, pass_name), audit_path, f"{pass_name}-{version}")
        return _publish_merge(cdc.apply_deletes(target, batch, key), path, version)

    merged, metrics = retried(delete)
    publish(gold.payments_daily(cdc.state_of(merged)), gold_path, "OVERWRITE")
    return metrics


def run_mixed_batch(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    gold_path: str,
    key: str,
    payload: Sequence[str],
    applied_at: Column | None = None,
) -> dict[str, dict[str, int]]:
    """Mixed batch with tombstones: merge counters, changes for readers, gold rebuild."""
    latest, preparation = cdc.normalize_batch(batch, key, payload)
    written, metrics = run_merge(
        spark, path, lambda target: cdc.apply_mixed(target, latest, key, payload, applied_at=applied_at)
    )
    changes = cdc.merge_changes(written).first().asDict()
    publish(gold.transactions_summary(cdc.active_rows(cdc.state_of(written))), gold_path, "OVERWRITE")
    return {"preparation": preparation, "merge": metrics, "business_changes": changes}

"""Change-data-capture apply: a merge over plain DataFrames and the modes built on it.

``merge`` computes the next state of a table; publishing it is a separate step
(:mod:`tidelake.sources.tables`). The result carries ``_action`` for every target row and
every inserted row, so metrics come from one count and need no second comparison.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.operators.versions import latest_version

OPERATIONS = ("INSERT", "UPDATE", "DELETE")
INSERTED, UPDATED, DELETED, UNCHANGED = "inserted", "updated", "deleted", "unchanged"


@dataclass(frozen=True)
class Update:
    """Matched rows: set columns from expressions over ``t.`` and ``s.``; no set means all columns of s."""

    set: Mapping[str, str | Column] | None = None
    condition: str | None = None


@dataclass(frozen=True)
class Delete:
    """Matched rows: drop the target row."""

    condition: str | None = None


@dataclass(frozen=True)
class Insert:
    """Unmatched source rows: values from expressions over ``s.``; no values means all columns of s."""

    values: Mapping[str, str | Column] | None = None
    condition: str | None = None


def _column(value: str | Column) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched: Sequence[Update | Delete] = (),
    not_matched: Sequence[Insert] = (),
    before: Sequence[str] = (),
) -> DataFrame:
    """Next state of ``target`` after applying ``source``, plus ``_action``; deleted rows are still in it.

    With ``before`` the struct ``_before`` keeps these columns as they were (NULL for inserted rows).

    The first clause whose condition holds wins; without one a target row is unchanged and a
    source row is ignored. Source keys must be unique (see :func:`reject_duplicate_keys`).

    Both sides are joined once, on the key; how is left to Spark, which knows the sizes. NULL keys
    match nothing; a running number beside the key keeps them from meeting in one task.
    """
    t = target.withColumns({"_in_target": F.lit(True), "_void": _void(on)}).alias("t")
    s = source.withColumns({"_in_source": F.lit(True), "_void": _void(on)}).alias("s")
    same_key = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in [*on, "_void"]])
    # Without a clause for unknown keys only the target's rows can come out.
    joined = t.join(s, same_key, "full_outer" if not_matched else "left_outer")
    return _resolve(joined, target.columns, source.columns, matched, not_matched, before)


def _void(keys: Sequence[str]) -> Column:
    """0 for rows with all keys, else one of many numbers."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.when(missing, 1 + F.pmod(F.monotonically_increasing_id(), F.lit(4096))).otherwise(F.lit(0).cast("long"))


def _resolve(
    joined: DataFrame,
    target_columns: Sequence[str],
    source_columns: Sequence[str],
    matched: Sequence[Update | Delete],
    not_matched: Sequence[Insert],
    before: Sequence[str],
) -> DataFrame:
    """Pick the clause of every joined row, then the value of every target column."""
    both = F.col("t._in_target") & F.col("s._in_source")
    source_only = F.col("t._in_target").isNull()
    steps = [(clause, both) for clause in matched] + [(clause, source_only) for clause in not_matched]

    choice = F.lit(None).cast("int")
    for number, (clause, side) in reversed(list(enumerate(steps))):
        applies = side if clause.condition is None else side & F.expr(clause.condition)
        choice = F.when(applies, F.lit(number)).otherwise(choice)
    joined = joined.withColumn("_clause", choice)

    action = F.when(F.col("_clause").isNull(), F.lit(UNCHANGED))
    names = {Update: UPDATED, Delete: DELETED, Insert: INSERTED}
    for number, (clause, _) in enumerate(steps):
        action = action.when(F.col("_clause") == number, F.lit(names[type(clause)]))

    columns = []
    for name in target_columns:
        value = F.col(f"t.{name}")
        for number, (clause, _) in enumerate(steps):
            if isinstance(clause, Delete):
                continue
            given = clause.set if isinstance(clause, Update) else clause.values
            if given is None:
                given = {c: f"s.`{c}`" for c in source_columns}
            if name in given:
                value = F.when(F.col("_clause") == number, _column(given[name])).otherwise(value)
        columns.append(value.alias(name))
    if before:
        old = F.struct(*[F.col(f"t.{name}").alias(name) for name in before])
        columns.append(F.when(F.col("t._in_target"), old).alias("_before"))
    resolved = joined.filter(F.col("t._in_target") | F.col("_clause").isNotNull())
    return resolved.select(*columns, action.alias("_action"))


def state_of(merged: DataFrame) -> DataFrame:
    """The rows that remain, without the bookkeeping columns."""
    return merged.filter(F.col("_action") != DELETED).drop("_action", "_before")


def merge_metrics(merged: DataFrame) -> DataFrame:
    """Rows inserted, updated and deleted, in one pass; a logical delete is an update here."""
    return merged.agg(
        F.count_if(F.col("_action") == INSERTED).alias("inserted_rows"),
        F.count_if(F.col("_action") == UPDATED).alias("updated_rows"),
        F.count_if(F.col("_action") == DELETED).alias("deleted_rows"),
    )


def reject_duplicate_keys(source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Raise when two source rows share a key: a merge could not tell which one to apply."""
    keyed = source.dropna(subset=list(on))
    twice = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).limit(1).count()
    if twice:
        raise ValueError("DUPLICATE_SOURCE_KEY")
    return source


def upsert_newer(
    target: DataFrame,
    source: DataFrame,
    key: str,
    ts: str = "_ingestion_timestamp",
    null_is_oldest: bool = False,
) -> DataFrame:
    """Replace rows by a strictly newer source row and insert unknown keys.

    A target row without a timestamp is never replaced, unless ``null_is_oldest`` is set.
    """
    newer = f"s.`{ts}` > t.`{ts}`"
    if null_is_oldest:
        newer = f"({newer}) OR (t.`{ts}` IS NULL AND s.`{ts}` IS NOT NULL)"
    return merge(target, source, [key], [Update(condition=newer)], [Insert()])


def apply_ops(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Operation-driven merge without version guard: UPDATE and DELETE on known keys, INSERT on new ones."""
    image = {c: f"s.`{c}`" for c in target.columns if c in source.columns}
    changed = {c: v for c, v in image.items() if c != key}
    return merge(
        target,
        source,
        [key],
        [Delete("s.operation = 'DELETE'"), Update(changed, "s.operation = 'UPDATE'")],
        [Insert(image, "s.operation = 'INSERT'")],
    )


def insert_new(
    target: DataFrame,
    source: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Target plus the INSERT events of unknown keys; only ``columns`` are filled. Replay adds nothing.

    Every event of an unknown key is inserted, two of one batch as well.
    """
    columns = list(columns) if columns else [c for c in target.columns if c in source.columns]
    inserts = source.filter(F.col("operation") == "INSERT").select(*columns)
    fresh = inserts.join(target.select(key), [key], "left_anti")
    return target.withColumn("_action", F.lit(UNCHANGED)).unionByName(
        fresh.withColumn("_action", F.lit(INSERTED)), allowMissingColumns=True
    )


def apply_updates(
    target: DataFrame,
    source: DataFrame,
    key: str,
    payload: Sequence[str],
    seq: str = "sequence_num",
    applied_at: Column | None = None,
) -> DataFrame:
    """Versioned update: only a higher sequence number changes a row and its ``_applied_at``."""
    image = {c: f"s.`{c}`" for c in [*payload, seq]}
    image["_applied_at"] = F.current_timestamp() if applied_at is None else applied_at
    return merge(target, source, [key], [Update(image, f"s.`{seq}` > t.`{seq}`")])


def apply_deletes(target: DataFrame, source: DataFrame, key: str, seq: str = "sequence_num") -> DataFrame:
    """Versioned physical delete: a delete older than the row is ignored."""
    newer = f"s.operation = 'DELETE' AND s.`{seq}` > t.`{seq}`"
    return merge(target, source, [key], [Delete(newer)])


def delete_audit(
    target_before: DataFrame,
    events: DataFrame,
    key: str,
    pass_name: str,
    seq: str = "sequence_num",
    audited_at: Column | None = None,
) -> DataFrame:
    """Decision per delete event, judged against the state before the merge."""
    current = target_before.select(F.col(key), F.col(seq).alias("_current"), F.lit(True).alias("_known"))
    outcome = (
        F.when(F.col("_known").isNull(), F.lit("ALREADY_ABSENT"))
        .when(F.col(seq) > F.col("_current"), F.lit("DELETED"))
        .otherwise(F.lit("IGNORED_VERSION"))
    )
    return events.join(current, [key], "left").select(
        "event_id",
        key,
        seq,
        F.lit(pass_name).alias("pass_name"),
        outcome.alias("outcome"),
        (F.current_timestamp() if audited_at is None else audited_at).alias("_audited_at"),
    )


def apply_mixed(
    target: DataFrame,
    source: DataFrame,
    key: str,
    payload: Sequence[str],
    seq: str = "sequence_num",
    applied_at: Column | None = None,
) -> DataFrame:
    """Versioned merge that turns deletes into tombstones.

    A DELETE keeps the stored payload, takes the new sequence number and sets ``_is_deleted``;
    a DELETE of an unknown key leaves a tombstone too, so older images arriving later lose.
    """
    now = F.current_timestamp() if applied_at is None else applied_at
    stamp = {seq: f"s.`{seq}`", "_is_deleted": "s.operation = 'DELETE'", "_applied_at": now}
    change = {c: f"CASE WHEN s.operation = 'DELETE' THEN t.`{c}` ELSE s.`{c}` END" for c in payload}
    arrive = {c: f"s.`{c}`" for c in [key, *payload]}
    return merge(
        target,
        source,
        [key],
        [Update({**change, **stamp}, f"s.`{seq}` > t.`{seq}`")],
        [Insert({**arrive, **stamp})],
        before=["_is_deleted"],
    )


def active_rows(state: DataFrame) -> DataFrame:
    """Business view of a state with tombstones."""
    return state.filter(~F.col("_is_deleted")).drop("_is_deleted")


def _is_invalid(columns: Sequence[str], key: str, payload: Sequence[str], seq: str, operations: Sequence[str]) -> Column:
    required = F.lit(False)
    for name in [c for c in ["event_id", key, seq, "operation"] if c in columns]:
        required = required | F.col(name).isNull()
    image = F.lit(False)
    for name in payload:
        image = image | F.col(name).isNull()
    known = F.col("operation").isin(*operations)
    return required | (F.col(seq) < 1) | ~known | ((F.col("operation") != "DELETE") & image)


def invalid_events(
    df: DataFrame,
    key: str,
    payload: Sequence[str],
    seq: str = "sequence_num",
    operations: Sequence[str] = OPERATIONS,
) -> DataFrame:
    """Events without id, key, version (from 1) or expected operation, and images with a missing field."""
    return df.filter(_is_invalid(df.columns, key, payload, seq, operations))


def normalize_batch(
    df: DataFrame,
    key: str,
    payload: Sequence[str],
    seq: str = "sequence_num",
    operations: Sequence[str] = OPERATIONS,
) -> tuple[DataFrame, dict[str, int]]:
    """Validate a batch, then keep the last image per key; raises before anything is written.

    Errors: INVALID_EVENT, AMBIGUOUS_KEY_VERSION (one key and version, two contents),
    EVENT_ID_CONFLICT (one event id, two contents). Contents under one key differ when their
    least and greatest do, so all rules and counts but the last take a single aggregation.
    """
    content = ["operation", *payload]

    def contents(*fields: str) -> list[Column]:
        whole = F.struct(*fields)
        return [F.min(whole).alias("_least"), F.max(whole).alias("_greatest")]

    differ = ~F.col("_least").eqNullSafe(F.col("_greatest"))
    wrong = _is_invalid(df.columns, key, payload, seq, operations)
    by_version = df.groupBy(key, seq).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(wrong).alias("_wrong"), *contents(*content)
    )
    found = by_version.agg(
        F.coalesce(F.sum("_wrong"), F.lit(0)).alias("wrong"),
        F.count_if(differ).alias("ambiguous"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("source_rows"),
        F.count(F.lit(1)).alias("distinct_versions"),
        F.countDistinct(key).alias("keys_after_selection"),
    ).first()
    if found["wrong"]:
        raise ValueError("INVALID_EVENT")
    if found["ambiguous"]:
        raise ValueError("AMBIGUOUS_KEY_VERSION")
    if "event_id" in df.columns:
        by_id = df.groupBy("event_id").agg(*contents(key, seq, *content))
        if by_id.filter(differ).limit(1).count():
            raise ValueError("EVENT_ID_CONFLICT")
    counts = {name: found[name] for name in ("source_rows", "distinct_versions", "keys_after_selection")}
    return latest_version(df, key, seq), counts


def reject_unknown_keys(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Raise when an update-only batch names a key the target does not have."""
    if not source.select(key).join(target.select(key), [key], "left_anti").isEmpty():
        raise ValueError("UNKNOWN_KEY")
    return source


def business_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """What changed for readers of the active rows: inserted, updated, deleted_logically.

    A tombstone for a key never seen changes nothing for them and is not counted.
    """
    others = [c for c in after.columns if c != key]
    old = before.select(F.col(key), F.struct(*others).alias("_old"))
    new = after.select(F.col(key), F.struct(*others).alias("_new"))
    both = new.join(old, [key], "left")
    live = ~F.col("_new._is_deleted")
    was_live = F.col("_old").isNotNull() & ~F.col("_old._is_deleted")
    return both.agg(
        F.count_if(live & ~was_live).alias("inserted"),
        F.count_if(live & was_live & ~F.col("_new").eqNullSafe(F.col("_old"))).alias("updated"),
        F.count_if(~live & was_live).alias("deleted_logically"),
    )


def merge_changes(merged: DataFrame) -> DataFrame:
    """The counters of :func:`business_changes`, taken from an :func:`apply_mixed` result.

    The merge already met every row with its earlier form, so the two states need not be
    joined again.
    """
    live = ~F.col("_is_deleted")
    was_live = F.coalesce(~F.col("_before._is_deleted"), F.lit(False))
    touched = F.col("_action") != UNCHANGED
    return merged.agg(
        F.count_if(touched & live & ~was_live).alias("inserted"),
        F.count_if(touched & live & was_live).alias("updated"),
        F.count_if(touched & ~live & was_live).alias("deleted_logically"),
    )

"""The merge modes against a plain Python model on random batches, on both physical paths."""

import random

import pytest
from pyspark.sql import functions as F

from tidelake.operators import cdc
from tidelake.operators.versions import latest_version

STATE = "k long, v string, sequence_num long, _is_deleted boolean, _applied_at string"
EVENT = "k long, v string, sequence_num long, operation string"


def batch_of(rng, size):
    """Unique versions per key; key 1 takes a third of the events."""
    seen, events = set(), []
    while len(events) < size:
        key = 1 if rng.random() < 0.34 else rng.randrange(40)
        seq = rng.randrange(1, 200)
        if (key, seq) in seen:
            continue
        seen.add((key, seq))
        op = rng.choice(["INSERT", "UPDATE", "DELETE"])
        events.append((key, None if op == "DELETE" else f"v{seq}", seq, op))
    return events


def model_mixed(state, events):
    after, last = dict(state), {}
    for key, value, seq, op in events:
        if key not in last or seq > last[key][1]:
            last[key] = (value, seq, op)
    for key, (value, seq, op) in last.items():
        old = after.get(key)
        if old is None:
            after[key] = (value, seq, op == "DELETE")
        elif seq > old[1]:
            after[key] = (old[0] if op == "DELETE" else value, seq, op == "DELETE")
    return after


def test_mixed_batches_in_any_order(spark):
    rng = random.Random(5)
    state = {k: (f"s{k}", rng.randrange(1, 150), rng.random() < 0.2) for k in range(0, 40, 2)}
    frame = spark.createDataFrame([(k, *row, "start") for k, row in state.items()], STATE)
    batches = [batch_of(rng, 150) for _ in range(2)]
    batches.append(batches[0])
    for events in batches:
        source = latest_version(spark.createDataFrame(events, EVENT), "k", "sequence_num")
        merged = cdc.apply_mixed(frame, source, "k", ["v"], applied_at=F.lit("now"))
        wanted = model_mixed(state, events)
        rows = merged.collect()
        assert {r.k: (r.v, r.sequence_num, r._is_deleted) for r in rows} == wanted and len(rows) == len(wanted)
        changed = {k for k in wanted if state.get(k) != wanted[k]}
        assert {r.k for r in rows if r._action != "unchanged"} == changed
        assert {r.k for r in rows if r._action == "inserted"} == set(wanted) - set(state)
        after = cdc.state_of(merged)
        snapshots = cdc.business_changes(frame, after, "k").first()
        assert snapshots == cdc.merge_changes(merged).first()
        state = wanted
        frame = spark.createDataFrame(after.collect(), STATE)
    assert not changed


def test_operations_without_versions(spark):
    rng = random.Random(9)
    state = {k: f"s{k}" for k in range(0, 60, 2)}
    events = [(k, f"e{k}", 1, rng.choice(["INSERT", "UPDATE", "DELETE"])) for k in rng.sample(range(80), 50)]
    wanted = dict(state)
    for key, value, _, op in events:
        if op == "DELETE":
            wanted.pop(key, None)
        elif op == "UPDATE" and key in wanted or op == "INSERT" and key not in wanted:
            wanted[key] = value
    target = spark.createDataFrame(list(state.items()), "k long, v string")
    merged = cdc.apply_ops(target, spark.createDataFrame(events, EVENT), "k")
    assert {r.k: r.v for r in cdc.state_of(merged).collect()} == wanted
    counted = cdc.merge_metrics(merged).first()
    assert counted.deleted_rows == len(set(state) - set(wanted))
    assert counted.inserted_rows == len(set(wanted) - set(state))

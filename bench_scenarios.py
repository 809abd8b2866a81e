"""The published scenario measurements, repeated at their own sizes.

from other hardware, so the ratio between variants says more than the single number.
"""

from __future__ import annotations

import datetime as dt
import time
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators import quality, temporal, versions
from tidelake.plans import medallion
from tidelake.session import scratch_dir
from tidelake.sources import landing, tables
from tidelake.streaming import ingest, progress, state

ORDERS = {"order_id": "bigint", "customer_id": "bigint", "order_date": "date", "status": "string", "channel": "string"}
HEADER = ",".join(ORDERS)
T0 = dt.datetime(2026, 1, 1, 8)


def _drop(root: Path, batch: str, rows: list[str]) -> None:
    folder = root / "ingestion_date=2026-08-25" / batch
    folder.mkdir(parents=True)
    (folder / "orders.csv").write_text("\n".join([HEADER, *rows]) + "\n")


def _order(i: int) -> str:
    return f"{i},{1000 + i % 100},2026-08-25,paid,web"


class Timer:
    def __init__(self) -> None:
        self.results: dict[str, dict] = {}

    def __call__(self, name: str, baseline: float | None, run, **expected) -> None:
        """Time a scenario; one that fails, or gives other counts, is an entry that says so."""
        start = time.perf_counter()
        entry = self.results[name] = {"sec": None, "baseline_sec": baseline}
        try:
            outcome = run()
            entry["sec"] = round(time.perf_counter() - start, 3)
            wrong = {k: outcome[k] for k, v in expected.items() if outcome[k] != v}
            if wrong:
                entry["failed"] = f"{wrong} instead of {expected}"
        except Exception as error:
            entry["failed"] = f"{type(error).__name__}: {str(error)[:300]}"


def run(spark: SparkSession) -> dict[str, dict]:
    out = scratch_dir(spark, "scenarios")
    raw = Path(f"{out}/landing".removeprefix("file:").replace("//", "/"))
    timed = Timer()

    def land(root: Path, name: str, checkpoint: str = "checkpoint") -> dict:
        route = ingest.route_batch(f"{out}/{name}", f"{out}/{name}_quarantine")
        landing.land_files(spark, str(root), f"{out}/{name}_{checkpoint}", route, schema=ORDERS)
        stats = quality.key_stats(tables.read_evolving(spark, f"{out}/{name}"), "order_id", "_source_file")
        return stats.first().asDict()

    small, compact, orders = raw / "small", raw / "compact", raw / "orders"
    for i in range(200):
        _drop(small, f"batch_{800001 + i}", [_order(i)])
    _drop(compact, "batch_899999", [_order(i) for i in range(200)])
    for i, size in enumerate((50_000, 2, 2, 2, 1, 1)):
        _drop(orders, f"batch_{i + 1:03d}", [_order(100_000 * i + j) for j in range(size)])

    timed("ingest_200_files_of_1_row", 27.18, lambda: land(small, "small"), total_rows=200, source_files=200)
    timed("ingest_1_file_of_200_rows", 8.24, lambda: land(compact, "compact"), total_rows=200, source_files=1)
    timed("ingest_6_files", 14.65, lambda: land(orders, "orders"), total_rows=50_008, source_files=6)
    timed("replay_after_lost_checkpoint", 8.57, lambda: land(orders, "orders", "second"), total_rows=100_016)

    bronze = tables.read_evolving(spark, f"{out}/orders")
    newest = versions.latest_per_key(
        bronze, ["order_id"], ["_ingestion_timestamp", "_source_file"], drop_null_keys=True
    )
    timed(
        "silver_rebuilt_after_replay",
        None,
        lambda: {"rows": tables.publish(newest, f"{out}/silver", "OVERWRITE").count()},
        rows=50_008,
    )

    inserts = spark.createDataFrame(
        [(71_000_000 + 7 * i, 40 + i, dt.date(2026, 9, 3 + i), "shipped", 1, "INSERT") for i in range(3)],
        "order_id long, customer_id long, order_date date, status string, sequence_num long, operation string",
    )
    insert = lambda: medallion.run_inserts_batch(spark, inserts, f"{out}/silver", "order_id")
    timed("insert_only_merge", 12.82, insert, inserted_rows=3)
    timed("insert_only_merge_replay", 2.41, insert, inserted_rows=0)

    tables.publish(
        spark.createDataFrame(
            [(21, "north", 4, T0), (22, "south", 4, T0), (23, "west", 4, T0)],
            "customer_id long, region string, sequence_num long, _applied_at timestamp",
        ),
        f"{out}/customers",
        "CREATE",
    )
    updates = spark.createDataFrame(
        [(22, "east", 6, "UPDATE"), (23, "centre", 5, "UPDATE"), (22, "coast", 5, "UPDATE"), (21, "north", 4, "UPDATE")],
        "customer_id long, region string, sequence_num long, operation string",
    )
    update = lambda: medallion.run_updates_batch(spark, updates, f"{out}/customers", "customer_id", ["region"])
    timed("update_merge", 9.206, update, updated_rows=2)
    timed("update_merge_replay", 4.804, update, updated_rows=0)

    day = dt.date(2026, 10, 6)
    tables.publish(
        spark.createDataFrame(
            [(610 + i, day, Decimal(a), "accepted", v, T0) for i, a, v in ((1, "64.10", 1), (2, "22.40", 3), (3, "9.90", 1))],
            "payment_id long, payment_date date, amount decimal(12,2), status string, sequence_num long, _applied_at timestamp",
        ),
        f"{out}/payments",
        "CREATE",
    )
    deletes = spark.createDataFrame(
        [("delete_001", 611, 2, "DELETE"), ("delete_002", 612, 2, "DELETE")],
        "event_id string, payment_id long, sequence_num long, operation string",
    )
    paths = [f"{out}/{name}" for name in ("payments", "audit", "payments_gold")]
    delete = lambda: medallion.run_deletes_batch(spark, deletes, *paths, "payment_id", "run")
    timed("delete_merge", 4.684, delete, deleted_rows=1)
    timed("delete_merge_replay", 3.965, delete, deleted_rows=0)

    tables.publish(
        spark.createDataFrame(
            [(310 + i, 76 + i, Decimal(a), 1, False, T0) for i, a in ((1, "64.10"), (2, "22.40"), (3, "9.90"))],
            "transaction_id long, payment_id long, amount decimal(12,2), sequence_num long, _is_deleted boolean,"
            " _applied_at timestamp",
        ),
        f"{out}/transactions",
        "CREATE",
    )
    mixed = spark.createDataFrame(
        [
            ("north-raise", 311, 77, Decimal("70.20"), 2, "UPDATE"),
            ("north-raise-again", 311, 77, Decimal("81.30"), 3, "UPDATE"),
            ("south-close", 312, None, None, 2, "DELETE"),
            ("south-open-late", 312, 78, Decimal("22.40"), 1, "INSERT"),
            ("west-open", 314, 80, Decimal("15.60"), 1, "INSERT"),
            ("west-open", 314, 80, Decimal("15.60"), 1, "INSERT"),
            ("east-resent", 313, 79, Decimal("9.90"), 1, "UPDATE"),
        ],
        "event_id string, transaction_id long, payment_id long, amount decimal(12,2), sequence_num long, operation string",
    )

    def merge(batch):
        done = medallion.run_mixed_batch(
            spark, batch, f"{out}/transactions", f"{out}/transactions_gold", "transaction_id", ["payment_id", "amount"]
        )
        return done["merge"]

    stale = mixed.filter("event_id = 'south-open-late'")
    timed("mixed_merge", 5.891, lambda: merge(mixed), inserted_rows=1, updated_rows=2)
    timed("mixed_merge_replay", 4.964, lambda: merge(mixed), inserted_rows=0, updated_rows=0)
    timed("mixed_merge_stale_insert", 5.234, lambda: merge(stale), inserted_rows=0, updated_rows=0)

    _streams(spark, out, timed)
    return timed.results


def _generated(rows_a_batch: int, batches: int, spark: SparkSession, source: str) -> DataFrame:
    """A stream over ``batches`` files of timed rows, one file a micro-batch."""
    for batch in range(batches):
        rows = spark.range(batch * rows_a_batch, (batch + 1) * rows_a_batch, 1, 1).select(
            F.timestamp_micros(F.lit(1_767_225_600_000_000) + F.col("id") * 5000).alias("event_time"),
            F.col("id").alias("transaction_id"),
            (F.col("id") % 1000).cast("string").alias("customer_id"),
        )
        rows.write.mode("append").parquet(source)
    return tables.replay_stream(spark, source, spark.read.parquet(source).schema, 1)


def _sides(stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders and, three seconds later, their payments."""
    orders = stream.select("transaction_id", F.col("event_time").alias("order_time"))
    paid = F.col("event_time") + F.expr("INTERVAL 3 SECONDS")
    return orders, stream.select("transaction_id", paid.alias("payment_time"))


#: Rows a batch, published steady seconds a batch, and the stream.
STREAMS = {
    "bounded_state_batch": (1000, 1.3, lambda s: state.windowed_count(s, "event_time", ["customer_id"])),
    "unbounded_state_batch": (2500, None, lambda s: state.stream_count(s, "transaction_id")),
    "native_microbatch": (2500, 0.92, quality.double_native),
    "interval_join_batch": (
        1000, None, lambda s: state.bounded_join(*_sides(s), "transaction_id", "order_time", "payment_time", 10)
    ),
    "key_join_batch": (1000, None, lambda s: temporal.key_join(*_sides(s), "transaction_id")),
}


def _streams(spark: SparkSession, out: str, timed: Timer) -> None:
    """Steady seconds a batch, rows a second and rows of state of each stream."""
    for name, (size, baseline, shape) in STREAMS.items():

        def steady(name=name, size=size, shape=shape) -> dict:
            shaped = shape(_generated(size, 8, spark, f"{out}/{name}_source"))
            if name == "unbounded_state_batch":
                query = ingest.run_updates(shaped, f"{out}/{name}", f"{out}/{name}_checkpoint")
            else:
                query = ingest.run_available_now(shaped, f"{out}/{name}", f"{out}/{name}_checkpoint")
            rows = progress.progress_df(spark, query).filter("batch_id >= 2 AND input_rows > 0")
            measured = rows.agg(
                F.round(F.avg("batch_duration_ms") / 1000, 3).alias("sec"),
                F.round(F.avg("processed_rows_per_second")).alias("rows_per_sec"),
                F.max("state_rows").alias("state_rows"),
            ).first()
            measures[name] = measured.asDict()
            return measures[name]

        measures: dict[str, dict] = {}
        timed(name, baseline, steady)
        timed.results[name] |= measures.get(name, {})

"""Routing of landed micro-batches and the stream runners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidelake.functions.rules import LANDING_CONTRACT, split_by_contract
from tidelake.sources.landing import Handler
from tidelake.sources.tables import write_batch_once


#: Where a landing without a stream leaves the id its batches belong to.
RUN_ID = "tidelake.runId"


def streaming_query_id(df: DataFrame) -> str:
    """Id of the running query, stored in its checkpoint, or of the ledger: the same after a restart."""
    context = df.sparkSession.sparkContext
    return context.getLocalProperty("sql.streaming.queryId") or context.getLocalProperty(RUN_ID)


def route_batch(valid_path: str, quarantine_path: str, pattern: str = LANDING_CONTRACT) -> Handler:
    """Handler that sends rows of conforming files to one table and all others to quarantine.

    The two writes are separate; each is idempotent per batch, so a failure between them is
    repaired by the retry. The rule looks at the path alone, so Spark leaves the other side's
    files out of each read: every file is parsed once and the batch needs no caching.
    """

    def handler(batch: DataFrame, batch_id: int) -> None:
        run_id = streaming_query_id(batch)
        valid, broken = split_by_contract(batch, pattern)
        write_batch_once(valid, valid_path, run_id, batch_id)
        write_batch_once(broken, quarantine_path, run_id, batch_id)

    return handler


def run_available_now(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Stream into a parquet folder until the input is used up."""
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_to_table(df: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """Stream into a catalog table until the input is used up."""
    query = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(name)
    )
    query.awaitTermination()
    return query


def run_updates(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run an update-mode aggregation until the input is used up, one idempotent partition per batch.

    The current value of a key is its row with the highest ``_batch_id``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch_once(batch, path, streaming_query_id(batch), batch_id)

    query = (
        df.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def start_memory(df: DataFrame, name: str, checkpoint: str, mode: str = "append", every: str = "5 seconds") -> StreamingQuery:
    """Start a query into an in-memory table for inspection; its rows live on the driver."""
    return (
        df.writeStream.format("memory")
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )

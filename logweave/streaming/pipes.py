"""Streaming pipes from a log to tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from logweave.operators.commit import commit_positions
from logweave.operators.sequence import chunk
from logweave.schemas import PARTITION_KEYS
from logweave.sinks.batches import commit_batch, read_batches, stage_batch, write_batch
from logweave.streaming.commits import POSITION_SCHEMA
from logweave.streaming.run import AVAILABLE_NOW, every, for_each_batch

# Rows per chunk and seconds between micro-batches of the chunked sink.
CHUNK_ROWS = 10
CHUNK_EVERY_S = 0.5


def transactional_pipe(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Transform messages so that output rows and input positions become visible together.

    Readers use ``read_batches``, or ``read_committed`` with ``batch_id`` as the transaction.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        stage_batch(transform(batch), root, batch_id)
        stage_batch(commit_positions(batch, "max").coalesce(1), root, batch_id, "positions")
        commit_batch(batch.sparkSession, root, batch_id)

    return for_each_batch(stream, step, root, checkpoint, trigger)


def consumed_positions(spark: SparkSession, root: str) -> DataFrame:
    """Next offset to read per partition, by committed transactions only."""
    rows = read_batches(spark, root, POSITION_SCHEMA, part="positions")
    return rows.groupBy(*PARTITION_KEYS).agg(F.max("position").alias("position"))


def micro_batch_sink(
    stream: DataFrame,
    order: list[str],
    root: str,
    checkpoint: str,
    size: int = CHUNK_ROWS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write each micro-batch in chunks of up to ``size`` rows, numbered in ``chunk``; none are lost."""

    def step(batch: DataFrame, batch_id: int) -> None:
        write_batch(chunk(batch, order, size), root, batch_id)

    return for_each_batch(stream, step, root, checkpoint, trigger or every(CHUNK_EVERY_S))


def continuous_view(
    name: str,
    stream: DataFrame,
    select: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append ``select(stream)`` to a parquet table as data arrives.

    ``stop()`` on the query detaches the view; calling again with the same checkpoint attaches it
    where it stopped, with a changed ``select`` if need be. Read ``target`` with ``spark.read``.
    """
    return (
        select(stream)
        .writeStream.queryName(name)
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def retry_sink(
    stream: DataFrame,
    retried: Callable[[DataFrame], DataFrame],
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run a retry operator on every micro-batch and keep all outcomes; dead letters have ``_error``."""

    def step(batch: DataFrame, batch_id: int) -> None:
        write_batch(retried(batch), root, batch_id)

    return for_each_batch(stream, step, root, checkpoint, trigger)


def read_pipe(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Committed rows of a pipe, without their batch id."""
    return read_batches(spark, root, schema).drop("batch_id")

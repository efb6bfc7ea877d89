"""Pauses of partitions that last over micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from logweave.operators.retry import hold_paused, pause_intervals
from logweave.session import small_side
from logweave.sinks.batches import (
    batch_before,
    commit_state,
    last_batch,
    read_batches,
    read_one_batch,
    stage_batch,
)
from logweave.streaming.run import for_each_batch

_HELD = T.StructField("held_until", T.TimestampType())


def pause_stream(
    stream: DataFrame,
    by: list[str],
    at: str,
    order: list[str],
    root: str,
    checkpoint: str,
    delay_s: str = "delay_s",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hold rows back that arrive while their partition is paused, and let them go when it resumes.

    A row with ``delay_s`` above 0 pauses its partition from ``at`` on; pauses that overlap are one, also if a
    later micro-batch brings the second. The newest ``at`` of a partition is its clock. A row leaves, with
    ``held_until`` (null if it was not held), once the clock has passed that time, and rows of a partition leave in ``order``
    as long as they come in the order of ``at``. A pause that arrives late holds what has not left yet.

    State are the pauses that have not ended by their partition's clock, the rows that wait, and the clocks; a
    micro-batch joins itself with these, so a partition with much of the stream uses all tasks.
    Read with ``read_released`` and ``read_waiting``.
    """
    keys = [stream.schema[c] for c in by]
    pause_schema = T.StructType(
        [*keys, T.StructField("paused_at", T.TimestampType()), T.StructField("resumed_at", T.TimestampType())]
    )
    clock_schema = T.StructType([*keys, T.StructField("clock", T.TimestampType())])
    held_schema = T.StructType([*stream.schema.fields, _HELD])
    columns = stream.columns

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        previous = batch_before(spark, root, batch_id)
        clocks = read_one_batch(spark, root, clock_schema, previous, "clocks")
        seen = clocks.unionByName(batch.select(*by, F.col(at).cast("timestamp").alias("clock")))
        stage_batch(seen.groupBy(*by).agg(F.max("clock").alias("clock")).coalesce(1), root, batch_id, "clocks")
        clock = small_side(read_one_batch(spark, root, clock_schema, batch_id, "clocks"))

        known = read_one_batch(spark, root, pause_schema, previous, "pauses")
        pauses = pause_intervals(batch, by, at, delay_s, known).persist()
        waited = read_one_batch(spark, root, held_schema, previous, "waiting").select(*columns)
        rows = _with_clock(hold_paused(batch.select(*columns).unionByName(waited), pauses, by, at), clock, by).persist()
        try:
            # a pause may still begin at the clock itself and prolong one that ends there
            waits = F.coalesce(F.col("held_until") >= F.col("_clock"), F.lit(False))
            left = rows.filter(~waits).drop("_clock")
            stage_batch(left.sortWithinPartitions(*by, *order), root, batch_id)
            stage_batch(rows.filter(waits).drop("_clock"), root, batch_id, "waiting")
            lasting = _with_clock(pauses, clock, by).filter(F.col("resumed_at") >= F.col("_clock"))
            stage_batch(lasting.drop("_clock"), root, batch_id, "pauses")
        finally:
            rows.unpersist()
            pauses.unpersist()
        commit_state(spark, root, batch_id, ["clocks", "pauses", "waiting"])

    return for_each_batch(stream, step, root, checkpoint, trigger)


def _with_clock(df: DataFrame, clocks: DataFrame, by: list[str]) -> DataFrame:
    """Rows with their partition's clock as ``_clock``; a partition may be null."""
    same = [df[c].eqNullSafe(clocks[c]) for c in by]
    return df.join(clocks, same, "left").select(*[df[c] for c in df.columns], clocks["clock"].alias("_clock"))


def read_released(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows that have left, with ``held_until`` and ``batch_id``; ``schema`` is that of the stream."""
    return read_batches(spark, root, T.StructType([*schema.fields, _HELD]))


def read_waiting(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows that wait after the newest batch, with ``held_until`` as known so far."""
    return read_one_batch(spark, root, T.StructType([*schema.fields, _HELD]), last_batch(spark, root), "waiting")

"""Commit positions of a stream.

State lives in small tables written per micro-batch (see ``sinks.batches``) rather than in one task
per partition: a micro-batch is joined with the state left by the batch before it and evaluated with
the batch operators, so even a stream with a single partition uses the whole cluster.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from logweave.operators.commit import beyond_committed, commit_positions, finished_runs
from logweave.schemas import MARK_SCHEMA, PARTITION_KEYS
from logweave.session import path_exists, small_side
from logweave.sinks.batches import (
    batch_before,
    commit_state,
    last_batch,
    read_batches,
    read_one_batch,
    stage_batch,
)
from logweave.streaming.run import every, for_each_batch

# Marks waiting behind a gap from which on it is reported, and how often gaps and commits
# are looked at.
PENDING_LIMIT = 10_000
GAP_CHECK_S = 10
COMMIT_S = 5

POSITION_SCHEMA = T.StructType([*MARK_SCHEMA.fields[:2], T.StructField("position", T.LongType())])
COMMITTED_SCHEMA = T.StructType(
    [
        *MARK_SCHEMA.fields[:2],
        T.StructField("committed_seq", T.LongType()),
        T.StructField("committed_offset", T.LongType()),
    ]
)
GAP_SCHEMA = T.StructType(
    [
        *MARK_SCHEMA.fields[:2],
        T.StructField("gap_start", T.LongType()),
        T.StructField("gap_end", T.LongType()),
    ]
)
RUN_SCHEMA = T.StructType(
    [
        *MARK_SCHEMA.fields[:2],
        T.StructField("first_seq", T.LongType()),
        T.StructField("last_seq", T.LongType()),
        T.StructField("top_offset", T.LongType()),
        T.StructField("oldest_at", T.TimestampType()),
    ]
)
OVERFLOW_SCHEMA = T.StructType([*MARK_SCHEMA.fields[:2], T.StructField("pending", T.LongType())])
_CLOCK_SCHEMA = T.StructType([T.StructField("as_of", T.TimestampType())])


def commit_batches(
    stream: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Commit the highest finished offset + 1 per partition, by default every five seconds."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = read_one_batch(spark, root, POSITION_SCHEMA, batch_before(spark, root, batch_id), "positions")
        merged = (
            known.unionByName(commit_positions(batch, "max"))
            .groupBy(*PARTITION_KEYS)
            .agg(F.max("position").alias("position"))
        )
        stage_batch(merged.coalesce(1), root, batch_id, "positions")
        commit_state(spark, root, batch_id, ["positions"])

    return for_each_batch(stream, step, root, checkpoint, trigger or every(COMMIT_S))


def read_positions(spark: SparkSession, root: str) -> DataFrame:
    """Positions after the newest batch of ``commit_batches``."""
    return read_one_batch(spark, root, POSITION_SCHEMA, last_batch(spark, root), "positions")


def track_commits(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    gap_timeout: timedelta | None = None,
    pending_limit: int = PENDING_LIMIT,
    trigger: dict | None = None,
    wall_clock: bool = False,
    as_of: datetime | None = None,
    stop_on_overflow: bool = False,
) -> StreamingQuery:
    """Follow marks that arrive out of order, and commit as far as they allow.

    Marks at or below the committed state and repeated ones are dropped; marks beyond a gap wait.
    With ``gap_timeout`` a gap is given up once a mark beyond it is that old, by the newest
    ``processed_at`` seen, by the clock, or at ``as_of``, after which no mark counts. All marks beyond a gap wait,
    since a lost one would stop the position for good; a partition where more than ``pending_limit`` + 1 wait
    has a row in ``overflow``. With ``stop_on_overflow`` the stream stops instead, before such a batch is committed; started again
    with a higher limit, or a gap timeout, it goes on with that batch. Offsets have to rise with sequence numbers; ``operators.non_monotonic`` lists marks
    where they do not.

    What waits is kept as unbroken runs of numbers, with the highest offset and the earliest time of each:
    whether a gap is given up depends on the earliest time of the runs beyond it, and a position always
    lies at the end of a run. So a batch rewrites a row for each open gap and not for each waiting mark.
    Tables below ``root``: ``committed``, ``runs``, ``skipped``, ``overflow``.
    """

    def cutoff_of(spark: SparkSession, batch_id: int, previous: int | None, arrived: DataFrame) -> Column | None:
        if gap_timeout is None:
            return None
        # a batch from before the timeout was set has no clock
        timed = previous is not None and path_exists(spark, f"{root}/clock/batch_id={previous}")
        clock = read_one_batch(spark, root, _CLOCK_SCHEMA, previous if timed else None, "clock")
        seen = F.current_timestamp() if wall_clock else F.max("as_of") if as_of is None else F.lit(as_of)
        times = clock.unionByName(arrived.select(F.col("processed_at").alias("as_of")))
        stage_batch(times.agg(seen.alias("as_of")), root, batch_id, "clock")
        now_us = read_one_batch(spark, root, _CLOCK_SCHEMA, batch_id, "clock").select(F.unix_micros("as_of")).first()[0]
        # an empty first batch has no time to judge by
        return None if now_us is None else F.timestamp_micros(F.lit(now_us - gap_timeout // timedelta(microseconds=1)))

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        previous = batch_before(spark, root, batch_id)
        committed = small_side(read_one_batch(spark, root, COMMITTED_SCHEMA, previous, "committed"))
        arrived = batch.select(*MARK_SCHEMA.fieldNames())
        if as_of is not None:
            arrived = arrived.filter(F.col("processed_at") <= F.lit(as_of))
        cutoff = cutoff_of(spark, batch_id, previous, arrived)
        waiting = read_one_batch(spark, root, RUN_SCHEMA, previous, "runs")
        runs = finished_runs(beyond_committed(arrived, committed), waiting).persist()
        try:
            placed = runs.join(committed, PARTITION_KEYS, "left").withColumn(
                "floor", F.coalesce("committed_seq", F.lit(-1).cast("bigint"))
            )
            # a run that continues what is committed, and all up to one that has waited long enough
            done = F.col("first_seq") == F.col("floor") + 1
            if cutoff is not None:
                done = done | (F.col("oldest_at") <= cutoff)
            end = F.coalesce(F.max(F.when(done, F.col("last_seq"))), F.max("floor"))
            ends = small_side(
                placed.groupBy(*PARTITION_KEYS).agg(F.max("floor").alias("floor"), end.alias("end"))
            )
            judged = runs.join(ends, PARTITION_KEYS).withColumn("passed", F.col("last_seq") <= F.col("end"))
            length = F.col("last_seq") - F.col("first_seq") + 1
            moved = judged.groupBy(*PARTITION_KEYS).agg(
                F.max("end").alias("end"),
                # the highest offset passed, so that a position never moves back
                F.max(F.when(F.col("passed"), F.col("top_offset"))).alias("offset"),
                F.sum(F.when(F.col("passed"), 0).otherwise(length)).alias("pending"),
            ).persist()
            after = committed.alias("c").join(moved.alias("m"), PARTITION_KEYS, "full").select(
                *PARTITION_KEYS,
                F.coalesce("m.end", "c.committed_seq").alias("committed_seq"),
                F.greatest("m.offset", "c.committed_offset").alias("committed_offset"),
            )
            stage_batch(after.coalesce(1), root, batch_id, "committed")
            stage_batch(judged.filter("not passed").select(*RUN_SCHEMA.fieldNames()), root, batch_id, "runs")
            crowded = moved.filter(F.col("pending") > pending_limit + 1)
            over = crowded.select(*PARTITION_KEYS, "pending")
            if stop_on_overflow and (full := over.take(1)):
                raise RuntimeError(
                    f"{full[0]['topic']}-{full[0]['partition']}: {full[0]['pending']} marks wait, "
                    f"{pending_limit + 1} are allowed"
                )
            stage_batch(over, root, batch_id, "overflow")
            if cutoff is not None:
                before = F.greatest(F.coalesce("before_seq", "floor"), F.col("floor"))
                given_up = judged.filter(F.col("passed") & (F.col("first_seq") > before + 1)).select(
                    *PARTITION_KEYS, (before + 1).alias("gap_start"), (F.col("first_seq") - 1).alias("gap_end")
                )
                stage_batch(given_up, root, batch_id, "skipped")
            moved.unpersist()
            commit_state(spark, root, batch_id, ["committed", "runs", "clock"])
        finally:
            runs.unpersist()

    return for_each_batch(stream, step, root, checkpoint, trigger or every(GAP_CHECK_S))


def with_ticks(marks: DataFrame) -> DataFrame:
    """A stream of marks in which micro-batches go on while no marks arrive.

    Needed with ``wall_clock``: without new input there is no micro-batch, and a gap at the end of
    the stream would not be looked at again.
    """
    ticks = marks.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in MARK_SCHEMA.fields]
    return marks.select(*MARK_SCHEMA.fieldNames()).unionByName(
        ticks.filter(F.col("value") < 0).select(*nothing)
    )


def read_committed_positions(spark: SparkSession, root: str) -> DataFrame:
    """Position (offset + 1, null if nothing is committed) and ``committed_seq`` after the newest batch."""
    last = read_one_batch(spark, root, COMMITTED_SCHEMA, last_batch(spark, root), "committed")
    return last.select(
        *PARTITION_KEYS, (F.col("committed_offset") + 1).alias("position"), "committed_seq"
    )


def read_pending(spark: SparkSession, root: str) -> DataFrame:
    """Marks waiting after the newest batch, as unbroken runs of numbers: ``first_seq, last_seq, top_offset,
    oldest_at``."""
    return read_one_batch(spark, root, RUN_SCHEMA, last_batch(spark, root), "runs")


def read_skipped(spark: SparkSession, root: str) -> DataFrame:
    """Gaps given up so far, over all batches."""
    return read_batches(spark, root, GAP_SCHEMA, part="skipped").drop("batch_id")


def read_overflow(spark: SparkSession, root: str) -> DataFrame:
    """Partitions where more marks waited than the limit, with their number, by ``batch_id``."""
    return read_batches(spark, root, OVERFLOW_SCHEMA, part="overflow")

"""Idempotent processing of a stream."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from logweave.operators.dedup import dedup_first, new_only, null_keys
from logweave.session import small_side
from logweave.sinks.batches import (
    batch_before,
    commit_batch,
    commit_state,
    read_batches,
    read_one_batch,
    stage_batch,
)
from logweave.sinks.key_store import add_ids, known_ids, read_runs
from logweave.streaming.run import for_each_batch


def dedup_stream(
    stream: DataFrame,
    key: list[str],
    horizon: str | None = None,
    event_time: str = "timestamp",
    slices: int | None = 16,
) -> DataFrame:
    """One message of every key; remembers keys for ever, or for ``horizon`` of event time.

    A message of an earlier micro-batch comes first; within one micro-batch any copy may be the one
    kept. Use ``first_arrivals`` where the order inside a batch matters as well.

    Copies of one key are first removed within ``slices`` slices of the input tasks and then over
    all, so that a key holding much of the stream does not travel to a single task. The first step
    keeps a key state of its own, which nearly doubles the cost; ``None`` leaves it out where no key
    is that frequent. Rows without a key are left out.
    """
    keyed = stream.dropna(subset=key)
    if horizon is not None:
        keyed = keyed.withWatermark(event_time, horizon)

    def drop(df: DataFrame, columns: list[str]) -> DataFrame:
        return df.dropDuplicates(columns) if horizon is None else df.dropDuplicatesWithinWatermark(columns)

    if slices is not None:
        sliced = keyed.withColumn("_slice", F.spark_partition_id() % slices)
        keyed = drop(sliced, [*key, "_slice"]).drop("_slice")
    return drop(keyed, key)


_CLOCK_SCHEMA = T.StructType([T.StructField("newest", T.TimestampType())])


def key_id(key: list[str]) -> Column:
    """A key as one text; different keys have different texts."""
    return F.col(key[0]).cast("string") if len(key) == 1 else F.to_json(F.struct(*key))


def first_arrivals(
    stream: DataFrame,
    key: list[str],
    order: list[str],
    root: str,
    checkpoint: str,
    horizon: timedelta | None = None,
    event_time: str = "timestamp",
    trigger: dict | None = None,
) -> StreamingQuery:
    """The first message of every key, by micro-batch and inside one by ``order``; see ``read_arrivals``.

    Inside a micro-batch the first copy is an aggregate, so a key with much of the stream sends one row
    from each task. Keys of earlier micro-batches are kept in a key store, and a batch looks up its own. Rows
    without a key are left out.

    With ``horizon`` a kept message counts for so long: one is new again when the one kept before is more than
    ``horizon`` older than the newest ``event_time`` of all earlier micro-batches. Keys beyond that leave the store. A kept
    message without a time is not remembered then.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        previous = batch_before(spark, root, batch_id)
        runs = read_runs(spark, root, previous)
        newest_us = since_us = since = None
        if horizon is not None:
            clock = read_one_batch(spark, root, _CLOCK_SCHEMA, previous, "clock")
            before_us = clock.agg(F.max(F.unix_micros("newest"))).first()[0]
            times = clock.unionByName(batch.select(F.col(event_time).cast("timestamp").alias("newest")))
            stage_batch(times.agg(F.max("newest").alias("newest")), root, batch_id, "clock")
            newest_us = read_one_batch(spark, root, _CLOCK_SCHEMA, batch_id, "clock").select(F.unix_micros("newest")).first()[0]
            if before_us is not None:
                since_us = before_us - horizon // timedelta(microseconds=1)
                since = F.timestamp_micros(F.lit(since_us))
        first = dedup_first(batch, key, order).withColumn("_id", key_id(key)).persist()
        try:
            known = known_ids(spark, root, runs, first.select(F.col("_id").alias("id")), since)
            new = new_only(first, known.withColumnRenamed("id", "_id"), ["_id"])
            stage_batch(new.drop("_id"), root, batch_id)
        finally:
            first.unpersist()
        stored = spark.read.schema(batch.schema).parquet(f"{root}/data/batch_id={batch_id}")
        ids = stored.select(key_id(key).alias("id"))
        if horizon is not None:
            ids = stored.select(key_id(key).alias("id"), F.col(event_time).cast("timestamp").alias("seen_at"))
        add_ids(spark, root, batch_id, runs, ids, newest_us, since_us)
        commit_state(spark, root, batch_id, ["clock"])

    return for_each_batch(stream, step, root, checkpoint, trigger)


def read_arrivals(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Messages kept by ``first_arrivals``; ``schema`` is that of the stream."""
    return read_batches(spark, root, schema).drop("batch_id")


def idempotent_consume(
    stream: DataFrame,
    key: str,
    order: list[str],
    process: Callable[[DataFrame], DataFrame],
    root: str,
    checkpoint: str,
    mark_failed: bool = False,
    earlier: DataFrame | None = None,
    check_ledger: bool = True,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Process every message key once, with a durable ledger.

    Per micro-batch: first arrival per key, minus keys in the ledger, through ``process``, which
    keeps the key column and may set ``_error``. Results and ledger entries are staged under the
    batch id and become visible together, so a batch that is run again replaces its own output and
    repeats nothing. Failed rows are kept with their error and stay out of the ledger unless
    ``mark_failed``; so do rows without a key. See ``read_results`` and ``read_failures``.

    ``earlier`` holds ids (``message_id``) that were processed elsewhere or before, for instance the
    ledger of a former root after it was compacted.

    The ledger is a key store (see ``sinks.key_store``), so a batch of few messages opens few of its files.
    With ``dedup_stream`` before this, ``check_ledger=False`` leaves the lookup out: the state store then
    finds repeated keys, and the ledger is only written. Copies of a failed message are then dropped as well.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        arrived = dedup_first(batch, [key], order).withColumn("_id", F.col(key).cast("string")).persist()
        try:
            consume(batch, batch_id, arrived)
        finally:
            arrived.unpersist()

    def consume(batch: DataFrame, batch_id: int, first: DataFrame) -> None:
        spark = batch.sparkSession
        runs = read_runs(spark, root, batch_before(spark, root, batch_id))
        if check_ledger:
            known = known_ids(spark, root, runs, first.select(F.col("_id").alias("id")))
            first = new_only(first, known.withColumnRenamed("id", "_id"), ["_id"])
        if earlier is not None:
            # with few ids the earlier ones are filtered where they are read, instead of shuffled
            ids = small_side(first.select("_id"))
            passed = earlier.select(F.col("message_id").alias("_id")).join(ids, "_id", "left_semi")
            first = new_only(first, passed, ["_id"])
        result = process(first.drop("_id"))
        if "_error" not in result.columns:
            result = result.withColumn("_error", F.lit(None).cast("string"))
        stage_batch(result, root, batch_id, "results")
        stage_batch(null_keys(batch, [key]), root, batch_id, "null_keys")
        stored = spark.read.schema(result.schema).parquet(f"{root}/results/batch_id={batch_id}")
        done = stored if mark_failed else stored.filter(F.col("_error").isNull())
        add_ids(spark, root, batch_id, runs, done.select(F.col(key).cast("string").alias("id")))
        commit_batch(spark, root, batch_id)

    return for_each_batch(stream, step, root, checkpoint, trigger)


def read_results(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows that were processed; ``schema`` is that of the ``process`` output, without ``_error``."""
    full = T.StructType([*schema.fields, T.StructField("_error", T.StringType())])
    rows = read_batches(spark, root, full, part="results")
    return rows.filter(F.col("_error").isNull()).select(*schema.fieldNames())


def read_failures(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows whose processing failed, with ``_error``."""
    full = T.StructType([*schema.fields, T.StructField("_error", T.StringType())])
    rows = read_batches(spark, root, full, part="results")
    return rows.filter(F.col("_error").isNotNull()).select(*full.fieldNames())

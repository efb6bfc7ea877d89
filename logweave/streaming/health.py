"""Partition health and delivery metrics of a stream of attempts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from logweave.operators import health as op
from logweave.operators.health import COOLDOWN_MS, block_summaries, fold_blocks, health_from_summary
from logweave.operators.latest import latest_by_key
from logweave.operators.metrics import delivery_metrics
from logweave.session import small_side
from logweave.sinks.batches import (
    batch_before,
    commit_state,
    last_batch,
    read_batches,
    read_one_batch,
    stage_batch,
    write_batch,
)
from logweave.streaming.run import for_each_batch

PARTITION = (T.StructField("partition", T.IntegerType()),)
_BLOCK = T.StructField("block", T.LongType())
BLOCK_FIELDS = [
    _BLOCK,
    T.StructField("n", T.LongType()),
    T.StructField("v", T.DoubleType()),
    T.StructField("total", T.LongType()),
    T.StructField("low", T.LongType()),
    T.StructField("closed", T.LongType()),
    T.StructField("err", T.LongType()),
    T.StructField("cool", T.LongType()),
]
OUTCOME_FIELDS = [
    _BLOCK,
    T.StructField("attempt_no", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("error_code", T.StringType()),
    T.StructField("at_ms", T.LongType()),
]
OPENED = T.StructField("opened", T.LongType())
METRIC_SCHEMA = T.StructType(
    [
        T.StructField("window_start_ms", T.LongType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("produce_latency_ms", T.DoubleType()),
        T.StructField("produce_latency_p95_ms", T.DoubleType()),
        T.StructField("retry_count", T.LongType()),
        T.StructField("partition_load", T.LongType()),
        T.StructField("delivery_errors", T.LongType()),
        T.StructField("serialization_errors", T.LongType()),
        T.StructField("queue_full", T.LongType()),
    ]
)


def health_stream(
    attempts: DataFrame, root: str, checkpoint: str, by: list[str] | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the health of every group (by default of a partition), whatever the order in which attempts arrive.

    State is one summary for each block of attempt numbers, and counts of opened attempts. The error
    count and the average depend on the order inside a block, so outcomes are kept as well, sorted by block:
    a micro-batch reads those of its blocks that earlier ones left and makes these blocks anew. The others
    stay, and ``read_health`` folds all in order. As long as attempts come about in order, that is the last block.
    """
    by = by or [f.name for f in PARTITION]
    keys = [attempts.schema[c] for c in by]
    block_schema, outcome_schema, opened_schema = (
        T.StructType([*keys, *fields]) for fields in (BLOCK_FIELDS, OUTCOME_FIELDS, [OPENED])
    )

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        previous = batch_before(spark, root, batch_id)
        known = read_one_batch(spark, root, opened_schema, previous, "opened")
        opened = batch.filter(F.col("kind") == "produce").groupBy(*by).agg(F.count("*").alias("opened"))
        opened = known.unionByName(opened).groupBy(*by).agg(F.sum("opened").alias("opened"))
        stage_batch(opened.coalesce(1), root, batch_id, "opened")

        settled = batch.filter(F.col("kind").isin("delivery", "error"))
        narrow = settled.withColumn("block", op.block_of("attempt_no", op.BLOCK_BITS)).select(*outcome_schema.fieldNames())
        stage_batch(narrow.sortWithinPartitions("block"), root, batch_id, "outcomes")
        arrived = spark.read.schema(outcome_schema).parquet(f"{root}/outcomes/batch_id={batch_id}")
        touched = small_side(arrived.select(*by, "block").distinct())
        blocks = read_one_batch(spark, root, block_schema, previous)
        low, high = touched.agg(F.min("block"), F.max("block")).first()
        if low is not None:
            # files are sorted by block, so those of other blocks are passed over
            earlier = read_batches(spark, root, outcome_schema, batch_id, "outcomes").drop("batch_id")
            earlier = _in(earlier.filter(F.col("block").between(low, high)), touched, by, "left_semi")
            anew = block_summaries(arrived.unionByName(earlier), by, bits=op.BLOCK_BITS)
            blocks = _in(blocks, touched, by, "left_anti").unionByName(anew.select(*block_schema.fieldNames()))
        stage_batch(blocks.coalesce(1), root, batch_id)
        commit_state(spark, root, batch_id, ["data", "opened"])

    return for_each_batch(attempts, step, root, checkpoint, trigger)


def _in(df: DataFrame, touched: DataFrame, by: list[str], how: str) -> DataFrame:
    """Rows of blocks that are in ``touched``, or are not; groups may be null."""
    return df.join(touched, [df[c].eqNullSafe(touched[c]) for c in [*by, "block"]], how)


def read_health(
    spark: SparkSession,
    root: str,
    as_of_ms: Column | int,
    cooldown_ms: int = COOLDOWN_MS,
    by: Sequence[T.StructField] = PARTITION,
) -> DataFrame:
    """Health after the newest batch, as ``partition_health`` gives it; ``by`` are the fields of the groups."""
    last, names = last_batch(spark, root), [f.name for f in by]
    blocks = read_one_batch(spark, root, T.StructType([*by, *BLOCK_FIELDS]), last)
    opened = read_one_batch(spark, root, T.StructType([*by, OPENED]), last, "opened")
    return health_from_summary(fold_blocks(opened, blocks, names), names, as_of_ms, cooldown_ms)


def metrics_stream(
    attempts: DataFrame,
    root: str,
    checkpoint: str,
    every: str = "1 minute",
    watermark: str = "10 minutes",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep delivery metrics current: each micro-batch writes the windows it changed."""
    metrics = delivery_metrics(attempts, every, watermark)
    return for_each_batch(
        metrics, lambda batch, batch_id: write_batch(batch, root, batch_id), root, checkpoint, trigger, "update"
    )


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Newest state of every window and partition."""
    rows = read_batches(spark, root, METRIC_SCHEMA)
    return latest_by_key(rows, ["window_start_ms", "partition"], ["batch_id"]).drop("batch_id")

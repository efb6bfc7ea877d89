"""Streaming queries: each loads a log in two parts and runs its query after either, on one checkpoint.

The second run resumes where the first one ended, so every result also covers a restart.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from logweave import operators as op, sinks, sources
from logweave.plans import batch, fixtures as fx
from logweave.plans.oracles import ORACLES
from logweave.schemas import ATTEMPT_SCHEMA, LOG_SCHEMA, MARK_SCHEMA, PARTITION_KEYS
from logweave.session import scratch, work_dir
from logweave.streaming import cells, commits, dedup, health, mirror, pauses, pipes, routing, run

AVAILABLE_NOW = run.AVAILABLE_NOW
DELIVERY_SCHEMA = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("arrival", T.LongType()),
    ]
)
OUTCOME_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("failures", T.IntegerType()),
    ]
)


def _middle(spark: SparkSession, d: str) -> int:
    """Event id at which the table is cut in two."""
    return fx.table(spark, d, "events").agg(F.max("event_id")).first()[0] // 2 + 1


def _in_two_runs(
    spark: SparkSession,
    parts: list[DataFrame],
    schema: T.StructType,
    start: Callable[[DataFrame, str], StreamingQuery],
) -> None:
    """Append each part to an input folder and let ``start(stream, checkpoint)`` catch up."""
    with scratch(spark, "input", "checkpoint") as (source, checkpoint):
        for part in parts:
            part.write.mode("append").parquet(source)
            run.finish(start(spark.readStream.schema(schema).parquet(source), checkpoint))


def _halves(df: DataFrame, column: str, at: int) -> list[DataFrame]:
    return [df.filter(F.col(column) < at), df.filter(F.col(column) >= at)]


def _marks(spark: SparkSession, d: str) -> list[DataFrame]:
    return _halves(fx.marks(spark, d), "seq", _middle(spark, d) // fx.PARTITIONS)


def log_stream(spark: SparkSession, d: str) -> DataFrame:
    """Log copied by a stream: written, read as it grows, written again."""
    target = work_dir(spark, "copy")
    with scratch(spark, "log", "checkpoint") as (source, checkpoint):
        for part in _halves(fx.event_log(spark, d), "offset", _middle(spark, d) // fx.PARTITIONS):
            sinks.write_log(part, source)
            stream = sources.read_log(spark, source, streaming=True, topic="events")
            run.finish(sinks.write_log(stream, target, "idempotent", checkpoint=checkpoint))
    return batch._log_text(sources.read_log(spark, target))


def discovered_partitions_stream(spark: SparkSession, d: str) -> DataFrame:
    """A partition that appears between two runs is picked up; nothing is read twice."""
    root = work_dir(spark, "pipe")
    with scratch(spark, "log", "checkpoint") as (source, checkpoint):
        for part in _halves(fx.event_log(spark, d), "partition", 2):
            sinks.write_log(part, source)
            stream = sources.read_log(spark, source, streaming=True)
            keys_only = lambda rows: rows.select(*PARTITION_KEYS)
            run.finish(pipes.transactional_pipe(stream, keys_only, root, checkpoint))
    keys = LOG_SCHEMA[PARTITION_KEYS[0]], LOG_SCHEMA[PARTITION_KEYS[1]]
    rows = pipes.read_pipe(spark, root, T.StructType(list(keys)))
    return batch._short(rows.groupBy(*PARTITION_KEYS).agg(F.count("*").alias("n")))


def intake_bound_stream(spark: SparkSession, d: str) -> DataFrame:
    """Intake of one file per micro-batch: rows of every batch add up to the log."""
    root = work_dir(spark, "pipe")
    with scratch(spark, "log", "checkpoint") as (source, checkpoint):
        for part in _halves(fx.event_log(spark, d), "offset", _middle(spark, d) // fx.PARTITIONS):
            sinks.write_log(part, source)
        stream = sources.read_log(spark, source, streaming=True, max_files=1)
        run.finish(pipes.transactional_pipe(stream, lambda rows: rows.select("partition"), root, checkpoint))
    batches = sinks.read_batches(spark, root, T.StructType([LOG_SCHEMA["partition"]]))
    return batches.groupBy(F.col("partition").alias("p")).agg(
        F.count("*").alias("n"), (F.count_distinct("batch_id") > 1).alias("several_batches")
    )


def commit_max_stream(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "commits")
    _in_two_runs(
        spark, _marks(spark, d), MARK_SCHEMA,
        lambda s, checkpoint: commits.commit_batches(s, root, checkpoint, AVAILABLE_NOW),
    )
    return batch._short(commits.read_positions(spark, root))


def track_commits_stream(spark: SparkSession, d: str) -> DataFrame:
    """Contiguous positions, the later half of the sequence numbers arriving first."""
    root = work_dir(spark, "commits")
    _in_two_runs(
        spark, _marks(spark, d)[::-1], MARK_SCHEMA,
        lambda s, checkpoint: commits.track_commits(s, root, checkpoint, trigger=AVAILABLE_NOW),
    )
    length = F.col("last_seq") - F.col("first_seq") + 1
    waiting = commits.read_pending(spark, root).groupBy(*PARTITION_KEYS).agg(F.sum(length).alias("pending"))
    found = commits.read_committed_positions(spark, root).join(waiting, PARTITION_KEYS, "left")
    return batch._short(found.withColumn("pending", F.coalesce("pending", F.lit(0))))


def track_commits_gap_stream(spark: SparkSession, d: str) -> DataFrame:
    """Gaps given up after an hour, judged after either half of the numbers at one moment."""
    root = work_dir(spark, "commits")
    moment = datetime.fromtimestamp(fx.AS_OF_US / 1_000_000, timezone.utc)
    _in_two_runs(
        spark, _marks(spark, d), MARK_SCHEMA,
        lambda s, checkpoint: commits.track_commits(
            s, root, checkpoint, batch.GAP_TIMEOUT, trigger=AVAILABLE_NOW, as_of=moment
        ),
    )
    gaps = commits.read_skipped(spark, root)
    return batch._short(gaps.withColumn("missing", F.col("gap_end") - F.col("gap_start") + 1))


def dedup_stream(spark: SparkSession, d: str) -> DataFrame:
    target = work_dir(spark, "deduped")
    with run.rocksdb_state(spark):
        _in_two_runs(
            spark, list(fx.redelivered(spark, d)), DELIVERY_SCHEMA,
            lambda s, checkpoint: pipes.continuous_view(
                "dedup", s, lambda rows: dedup.dedup_stream(rows, ["k"]), target, checkpoint
            ),
        )
    return spark.read.schema(DELIVERY_SCHEMA).parquet(target)


def first_arrival_stream(spark: SparkSession, d: str) -> DataFrame:
    """First copies, where a micro-batch holds both copies of an event and later ones come in the next."""
    root = work_dir(spark, "arrivals")
    first, again = fx.redelivered(spark, d)
    third = again.withColumn("arrival", F.col("arrival") + 1_000_000_000)
    number, middle = F.col("k").cast("long"), _middle(spark, d)
    both = again.unionByName(first)
    parts = [both.filter(number < middle), third.unionByName(both.filter(number >= middle))]
    _in_two_runs(
        spark, parts, DELIVERY_SCHEMA,
        lambda s, checkpoint: dedup.first_arrivals(s, ["k"], ["arrival"], root, checkpoint),
    )
    return dedup.read_arrivals(spark, root, DELIVERY_SCHEMA)


def first_arrival_horizon_stream(spark: SparkSession, d: str) -> DataFrame:
    """First event of every user and kind, which counts for a day after the newest event seen."""
    root = work_dir(spark, "arrivals")
    rows = fx.events(spark, d).select("user_id", "event_type", "event_id", "timestamp")
    _in_two_runs(
        spark, _halves(rows, "event_id", _middle(spark, d)), rows.schema,
        lambda s, checkpoint: dedup.first_arrivals(
            s, ["user_id", "event_type"], ["event_id"], root, checkpoint, timedelta(days=1)
        ),
    )
    return dedup.read_arrivals(spark, root, rows.schema).select("user_id", "event_type", "event_id")


def idempotent_consume_stream(spark: SparkSession, d: str) -> DataFrame:
    """Redelivered events through a step that fails for some; failures stay out of the ledger."""
    root = work_dir(spark, "consumed")

    def process(rows: DataFrame) -> DataFrame:
        # an event whose number ends in 35 fails on its first delivery and works on the second
        first = F.col("arrival") < 1_000_000_000
        return rows.withColumn("_error", F.when(first & F.col("k").endswith("35"), "processing_failed"))

    _in_two_runs(
        spark, list(fx.redelivered(spark, d)), DELIVERY_SCHEMA,
        lambda s, checkpoint: dedup.idempotent_consume(s, "k", ["arrival"], process, root, checkpoint),
    )
    return dedup.read_results(spark, root, DELIVERY_SCHEMA)


def retry_stream(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "retried")
    rows = fx.outcomes(spark, d)
    _in_two_runs(
        spark, _halves(rows, "event_id", _middle(spark, d)), OUTCOME_SCHEMA,
        lambda s, checkpoint: pipes.retry_sink(s, batch.retried, root, checkpoint),
    )
    done = pipes.read_pipe(spark, root, T.StructType([
        *OUTCOME_SCHEMA.fields,
        T.StructField("attempts", T.IntegerType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("delay_s", T.IntegerType()),
    ]))
    return done.select("event_id", F.col("partition").alias("p"), "attempts", "delay_s", "outcome")


def pause_holds_stream(spark: SparkSession, d: str) -> DataFrame:
    """Rows held by pauses that begin in either of two micro-batches: those that left and those that wait."""
    root = work_dir(spark, "paused")
    rows = batch.retried(fx.outcomes(spark, d)).select("event_id", "partition", "timestamp", "delay_s")
    bounds = rows.agg(F.min(F.unix_micros("timestamp")).alias("a"), F.max(F.unix_micros("timestamp")).alias("b")).first()
    middle = F.timestamp_micros(F.lit((bounds["a"] + bounds["b"]) // 2))
    early = F.col("timestamp") < middle
    _in_two_runs(
        spark, [rows.filter(early), rows.filter(~early)], rows.schema,
        lambda s, checkpoint: pauses.pause_stream(s, ["partition"], "timestamp", ["event_id"], root, checkpoint),
    )
    left = pauses.read_released(spark, root, rows.schema).drop("batch_id")
    all_rows = left.unionByName(pauses.read_waiting(spark, root, rows.schema))
    return all_rows.select("event_id", F.col("partition").alias("p"), F.unix_micros("held_until").alias("held_us"))


def route_stream(spark: SparkSession, d: str) -> DataFrame:
    """Events routed by the health that a stream of attempts has left, in one micro-batch."""
    health_root, root = work_dir(spark, "health"), work_dir(spark, "routed")
    now = batch._now(spark, d)
    _in_two_runs(
        spark, _halves(fx.attempts(spark, d), "attempt_no", _middle(spark, d)), ATTEMPT_SCHEMA,
        lambda s, checkpoint: health.health_stream(s, health_root, checkpoint),
    )
    rows = fx.table(spark, d, "events").select("event_id", "event_type")
    _in_two_runs(
        spark, [rows], rows.schema,
        lambda s, checkpoint: routing.route_stream(
            s, lambda: health.read_health(spark, health_root, now), batch._scripted_error, lambda: now,
            fx.PARTITIONS, root, checkpoint,
        ),
    )
    schema = T.StructType([
        *rows.schema.fields,
        T.StructField("partition", T.IntegerType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("error_code", T.StringType()),
    ])
    return batch._short(pipes.read_pipe(spark, root, schema).drop("event_type"))


def transactional_pipe_stream(spark: SparkSession, d: str) -> DataFrame:
    """Transformed messages of committed transactions, with a transaction that never committed."""
    root = work_dir(spark, "pipe")

    def transform(rows: DataFrame) -> DataFrame:
        return rows.select(F.lit("test-key").alias("k"), op.prefix_value("test-value with value:").alias("v"))

    parts = _halves(fx.event_log(spark, d), "offset", _middle(spark, d) // fx.PARTITIONS)
    _in_two_runs(spark, parts, LOG_SCHEMA, lambda s, checkpoint: pipes.transactional_pipe(s, transform, root, checkpoint))
    sinks.stage_batch(transform(fx.event_log(spark, d)), root, 1_000_000)
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])
    return pipes.read_pipe(spark, root, schema)


def micro_batch_stream(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of ten per micro-batch: full but for the last one, and no row lost."""
    root = work_dir(spark, "chunks")
    parts = _halves(fx.event_log(spark, d), "offset", _middle(spark, d) // fx.PARTITIONS)
    _in_two_runs(
        spark, parts, LOG_SCHEMA,
        lambda s, checkpoint: pipes.micro_batch_sink(
            s.select(*PARTITION_KEYS, "offset"), ["offset", "partition"], root, checkpoint, trigger=AVAILABLE_NOW
        ),
    )
    schema = T.StructType([LOG_SCHEMA["partition"], LOG_SCHEMA["offset"], T.StructField("chunk", T.LongType())])
    rows = sinks.read_batches(spark, root, schema)
    sizes = rows.groupBy("batch_id", "chunk").agg(F.count("*").alias("n"))
    return sizes.groupBy(F.col("n").alias("chunk_rows")).agg(F.count("*").alias("chunks"))


def cdc_mirror_stream(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "mirror")
    _in_two_runs(
        spark, _halves(fx.change_log(spark, d), "offset", 20_000_000), LOG_SCHEMA,
        lambda s, checkpoint: mirror.cdc_mirror(s, batch.ROW_SCHEMA, ["id"], root, checkpoint),
    )
    return batch._customer(mirror.read_mirror(spark, root, batch.ROW_SCHEMA, ["id"]))


def cdc_mirror_compacted_stream(spark: SparkSession, d: str) -> DataFrame:
    """The mirror, merged after each of three runs while the stream holds its place."""
    root, changes = work_dir(spark, "mirror"), fx.change_log(spark, d)
    at = F.col("offset")
    parts = [changes.filter(at < 10_000_000), *_halves(changes.filter(at >= 10_000_000), "offset", 20_000_000)]
    with scratch(spark, "input", "checkpoint") as (source, checkpoint):
        for part in parts:
            part.write.mode("append").parquet(source)
            stream = spark.readStream.schema(LOG_SCHEMA).parquet(source)
            run.finish(mirror.cdc_mirror(stream, batch.ROW_SCHEMA, ["id"], root, checkpoint))
            mirror.compact_mirror(spark, root, batch.ROW_SCHEMA, ["id"])
    return batch._customer(mirror.read_mirror(spark, root, batch.ROW_SCHEMA, ["id"]))


def cdc_mirror_rewritten_stream(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "mirror")
    _in_two_runs(
        spark, _halves(fx.rewritten_change_log(spark, d), "offset", 20_000_000), LOG_SCHEMA,
        lambda s, checkpoint: mirror.cdc_mirror(
            s, batch.ROW_SCHEMA, ["id"], root, checkpoint, unwrap=op.rewritten_changes
        ),
    )
    return batch._customer(mirror.read_mirror(spark, root, batch.ROW_SCHEMA, ["id"]))


def continuous_view_stream(spark: SparkSession, d: str) -> DataFrame:
    """Queue of JSON events as a table: detached after the first part, then attached again."""
    target = work_dir(spark, "view")
    parts = _halves(fx.faulty_log(spark, d), "offset", _middle(spark, d) // fx.PARTITIONS)
    _in_two_runs(
        spark, parts, LOG_SCHEMA,
        lambda s, checkpoint: pipes.continuous_view(
            "queue", s, lambda log: sources.json_queue(log, batch.QUEUE_SCHEMA), target, checkpoint
        ),
    )
    rows = spark.read.schema("EntityType string, Payload string, _topic string, _partition int").parquet(target)
    return rows.groupBy(F.col("EntityType").alias("entity_type"), "_topic", "_partition").agg(
        F.count("*").alias("n"), F.count_distinct("Payload").alias("payloads")
    )


def partition_health_stream(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "health")
    attempts = fx.attempts(spark, d, batch.CLIMBING)
    _in_two_runs(
        spark, _halves(attempts, "attempt_no", _middle(spark, d)), ATTEMPT_SCHEMA,
        lambda s, checkpoint: health.health_stream(s, root, checkpoint),
    )
    state = health.read_health(spark, root, batch._now(spark, d))
    return batch._short(state.withColumn("avg_latency_ms", F.round("avg_latency_ms", 6)))


def partition_health_reversed_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same where the later half of the attempts arrives first, and both halves share blocks."""
    root = work_dir(spark, "health")
    parts = _halves(fx.attempts(spark, d, batch.CLIMBING), "attempt_no", _middle(spark, d))
    _in_two_runs(
        spark, parts[::-1], ATTEMPT_SCHEMA, lambda s, checkpoint: health.health_stream(s, root, checkpoint)
    )
    state = health.read_health(spark, root, batch._now(spark, d))
    return batch._short(state.withColumn("avg_latency_ms", F.round("avg_latency_ms", 6)))


def delivery_metrics_stream(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "metrics")
    attempts = fx.attempts(spark, d)
    _in_two_runs(
        spark, _halves(attempts, "attempt_no", _middle(spark, d)), ATTEMPT_SCHEMA,
        lambda s, checkpoint: health.metrics_stream(s, root, checkpoint),
    )
    return batch.rounded_metrics(health.read_metrics(spark, root))


def metrics_rollup_stream(spark: SparkSession, d: str) -> DataFrame:
    """The later half of the attempts arrives first."""
    root = work_dir(spark, "cells")
    attempts = fx.attempts(spark, d)
    _in_two_runs(
        spark, _halves(attempts, "attempt_no", _middle(spark, d))[::-1], ATTEMPT_SCHEMA,
        lambda s, checkpoint: cells.cells_stream(s, root, checkpoint),
    )
    return batch.six_hours(cells.read_cells(spark, root))


STREAM_QUERIES = {
    f.__name__: f
    for f in [
        log_stream, discovered_partitions_stream, intake_bound_stream, commit_max_stream,
        track_commits_stream, track_commits_gap_stream, dedup_stream, first_arrival_stream,
        first_arrival_horizon_stream, idempotent_consume_stream,
        retry_stream, pause_holds_stream, route_stream, transactional_pipe_stream, micro_batch_stream, cdc_mirror_stream,
        cdc_mirror_compacted_stream, cdc_mirror_rewritten_stream,
        continuous_view_stream, partition_health_stream,
        partition_health_reversed_stream, delivery_metrics_stream, metrics_rollup_stream,
    ]
}

STREAM_ORACLES = {
    "log_stream": ORACLES["read_log"],
    "discovered_partitions_stream": "SELECT CAST(event_id % 3 AS INT) AS p, count(*) AS n FROM events GROUP BY 1",
    "intake_bound_stream": """SELECT CAST(event_id % 3 AS INT) AS p, count(*) AS n, true AS several_batches
      FROM events GROUP BY 1""",
    "commit_max_stream": ORACLES["commit_max"],
    "track_commits_stream": ORACLES["commit_contiguous"],
    "track_commits_gap_stream": ORACLES["skipped_gaps"],
    "dedup_stream": ORACLES["dedup_first"],
    "first_arrival_stream": ORACLES["dedup_first"],
    "first_arrival_horizon_stream": """WITH cut AS (SELECT max(event_id) // 2 + 1 AS middle FROM events),
      firsts AS (
        SELECT event_id >= middle AS later, user_id, event_type, min(event_id) AS event_id FROM events, cut GROUP BY ALL),
      kept AS (SELECT f.*, e.ts FROM firsts f JOIN events e USING (event_id)),
      clock AS (SELECT max(ts) AS newest FROM events, cut WHERE event_id < middle)
      SELECT user_id, event_type, event_id FROM kept k WHERE NOT later OR NOT EXISTS (
        SELECT 1 FROM kept b, clock WHERE NOT b.later AND b.user_id = k.user_id AND b.event_type = k.event_type
          AND b.ts >= newest - INTERVAL 1 DAY)""",
    "idempotent_consume_stream": """SELECT CAST(event_id AS VARCHAR) AS k, event_type,
      CASE WHEN event_id % 100 = 35 THEN value + 1 ELSE value END AS value,
      CASE WHEN event_id % 100 = 35 THEN event_id + 1000000000 ELSE event_id END AS arrival FROM events""",
    "retry_stream": ORACLES["retry_outcomes"],
    "pause_holds_stream": ORACLES["pause_holds"],
    "route_stream": ORACLES["route_batch"],
    "transactional_pipe_stream": ORACLES["message_transform"],
    "micro_batch_stream": """WITH cut AS (SELECT (max(event_id) // 2 + 1) // 3 AS middle FROM events),
      sizes AS (SELECT count(*) AS n FROM events, cut GROUP BY event_id // 3 < middle),
      chunks AS (SELECT least(10, n - 10 * c) AS chunk_rows FROM sizes, range(0, (SELECT max(n) FROM sizes)) AS r(c) WHERE 10 * c < n)
      SELECT chunk_rows, count(*) AS chunks FROM chunks GROUP BY 1""",
    "cdc_mirror_stream": ORACLES["cdc_latest"],
    "cdc_mirror_compacted_stream": ORACLES["cdc_latest"],
    "cdc_mirror_rewritten_stream": f"{ORACLES['cdc_latest']} WHERE id % 13 NOT IN (5, 6, 7)",
    "continuous_view_stream": ORACLES["json_queue_view"],
    "partition_health_stream": ORACLES["partition_health"],
    "partition_health_reversed_stream": ORACLES["partition_health"],
    "delivery_metrics_stream": ORACLES["delivery_metrics"],
    "metrics_rollup_stream": ORACLES["metrics_rollup"],
}

"""Batch queries over the given tables, one per operator."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from logweave import functions as fn, operators as op, sinks, sources
from logweave.functions.headers import header_array
from logweave.plans import fixtures as fx
from logweave.schemas import EVENT_SCHEMA, PARTITION_KEYS
from logweave.session import scratch, work_dir

GAP_TIMEOUT = timedelta(seconds=3600)
ROW_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
QUEUE_SCHEMA = T.StructType(
    [T.StructField("EntityType", T.StringType()), T.StructField("Payload", T.StringType())]
)


def _short(df: DataFrame) -> DataFrame:
    """Partition and offset under names that are no reserved words."""
    names = {"partition": "p", "offset": "off"}
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns}).drop("topic")


# --- commit positions -------------------------------------------------------------------------


def commit_max(spark: SparkSession, d: str) -> DataFrame:
    return _short(op.commit_positions(fx.marks(spark, d), "max"))


def commit_contiguous(spark: SparkSession, d: str) -> DataFrame:
    return _short(op.commit_positions(fx.marks(spark, d), "contiguous")).drop("skipped")


def commit_gap_timeout(spark: SparkSession, d: str) -> DataFrame:
    return _short(op.commit_positions(fx.marks(spark, d), "gap_timeout", fx.as_of(), GAP_TIMEOUT))


def skipped_gaps(spark: SparkSession, d: str) -> DataFrame:
    return _short(op.skipped_gaps(fx.marks(spark, d), fx.as_of(), GAP_TIMEOUT))


def seq_gaps(spark: SparkSession, d: str) -> DataFrame:
    return _short(op.gaps(fx.marks(spark, d)))


def oldest_pending(spark: SparkSession, d: str) -> DataFrame:
    found = op.oldest_pending(fx.marks(spark, d))
    return _short(found.withColumn("processed_us", F.unix_micros("processed_at")).drop("processed_at"))


def clean_marks(spark: SparkSession, d: str) -> DataFrame:
    """Marks reported twice, cleaned of repeats and of what an earlier commit covers."""
    marks = fx.marks(spark, d)
    again = marks.filter(F.col("seq") % 5 == 0).withColumn(
        "processed_at", F.col("processed_at") + F.expr("INTERVAL '1' HOUR")
    )
    committed = op.commit_positions(marks, "contiguous").select(
        *PARTITION_KEYS, "committed_seq", (F.col("position") - 1).alias("committed_offset")
    )
    clean = op.clean_marks(marks.unionByName(again), committed)
    return _short(clean.withColumn("processed_us", F.unix_micros("processed_at")).drop("processed_at"))


def non_monotonic_marks(spark: SparkSession, d: str) -> DataFrame:
    """Marks of which some carry an offset that was already passed."""
    shaken = fx.marks(spark, d).withColumn(
        "offset", F.when(F.col("seq") % 1000 == 7, F.col("offset") - 5).otherwise(F.col("offset"))
    )
    return _short(op.non_monotonic(shaken).drop("processed_at", "_error"))


# --- reading and writing logs -----------------------------------------------------------------


def _written_log(spark: SparkSession, d: str, profile: str = "reliable") -> str:
    path = work_dir(spark, "log")
    sinks.write_log(fx.event_log(spark, d), path, profile)
    return path


def _log_text(log: DataFrame) -> DataFrame:
    return log.select(
        F.col("partition").alias("p"), F.col("offset").alias("off"),
        F.col("key").cast("string").alias("k"), F.col("value").cast("string").alias("v"),
        F.unix_micros("timestamp").alias("ts_us"), F.size("headers").alias("n_headers"),
    )


def read_log(spark: SparkSession, d: str) -> DataFrame:
    return _log_text(sources.read_log(spark, _written_log(spark, d), topic="events"))


def bounded_read(spark: SparkSession, d: str) -> DataFrame:
    log = sources.read_log(spark, _written_log(spark, d, "fire_forget"))
    return _short(
        log.groupBy(*PARTITION_KEYS).agg(
            F.count("*").alias("n"), F.min("offset").alias("first_off"), F.max("offset").alias("last_off")
        )
    )


def selected_partitions(spark: SparkSession, d: str) -> DataFrame:
    log = sources.read_log(spark, _written_log(spark, d), partitions=[0, 2])
    return log.select(
        F.col("partition").alias("p"), F.col("offset").alias("off"), F.col("key").cast("string").alias("k")
    )


def custom_partitioner(spark: SparkSession, d: str) -> DataFrame:
    """Log written with a caller's partitioner: the event type's length decides."""
    path = work_dir(spark, "log")
    by_length = (F.octet_length("value") % 4).cast("int")
    sinks.write_log(fx.event_log(spark, d), path, "leader", partitioner=by_length)
    return _short(sources.read_log(spark, path).groupBy("partition").agg(F.count("*").alias("n")))


def envelope(spark: SparkSession, d: str) -> DataFrame:
    rows = op.envelope(fx.events(spark, d), F.col("event_id").cast("string"), F.col("props"), {"kind": F.col("event_type")})
    return rows.select(
        F.col("key").cast("string").alias("k"), F.col("value").cast("string").alias("v"),
        F.size("headers").alias("n_headers"),
        fn.header_last("headers", "Producer").cast("string").alias("producer"),
        fn.header_last("headers", "kind").cast("string").alias("kind"),
        fn.header_last("headers", "none").cast("string").alias("missing"),
    )


def keyed_event_log(spark: SparkSession, d: str) -> DataFrame:
    shaped = fx.table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("Id"), F.col("event_type").alias("EntityType"),
        F.col("props").alias("Payload"),
    )
    rows = op.to_keyed_log(shaped, "Id", ["Id", "EntityType", "Payload"])
    return rows.select(F.col("key").cast("string").alias("k"), F.col("value").cast("string").alias("v"))


def log_metadata(spark: SparkSession, d: str) -> DataFrame:
    return (
        op.with_log_metadata(fx.event_log(spark, d))
        .groupBy("_topic", "_partition")
        .agg(F.count("*").alias("n"), F.max("offset").alias("last_off"))
    )


def message_transform(spark: SparkSession, d: str) -> DataFrame:
    text = op.prefix_value("test-value with value:")
    return fx.event_log(spark, d).select(F.lit("test-key").alias("k"), text.alias("v"))


def user_hook(spark: SparkSession, d: str) -> DataFrame:
    """A caller's DataFrame function between decode and count."""
    def busiest(log: DataFrame) -> DataFrame:
        return log.groupBy(F.col("data.Payload").alias("payload")).agg(F.count("*").alias("n"))

    return fn.decode_json(fx.event_log(spark, d), EVENT_SCHEMA).transform(busiest)


# --- codecs -----------------------------------------------------------------------------------


def decode_json(spark: SparkSession, d: str) -> DataFrame:
    rows = fn.decode_json(fx.faulty_log(spark, d), EVENT_SCHEMA)
    return rows.select(
        F.col("partition").alias("p"), F.col("offset").alias("off"), F.col("data.Id").alias("id"),
        F.col("data.EntityType").alias("entity_type"), F.col("data.Payload").alias("payload"),
        F.col("_error").alias("error"),
    )


def decode_json_twice(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents, encoded twice and decoded again."""
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())])
    codec = fn.twice_encoded_json_codec(schema)
    documents = fx.table(spark, d, "documents")
    wire = documents.select("doc_id", codec.encode(F.struct("text", "lang")).alias("value"))
    return fn.decode_json(wire, schema, unwrap=True).select(
        "doc_id", F.col("data.lang").alias("lang"), F.md5(F.col("data.text").cast("binary")).alias("text_md5"),
        F.length("data.text").alias("n"), F.col("_error").alias("error"),
    )


def codecs(spark: SparkSession, d: str) -> DataFrame:
    """Round trip of every document through the registered codecs."""
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def round_trip(name: str, value: Column) -> Column:
        codec = fn.codec(name, kind)
        return codec.decode(codec.encode(value))

    return fx.table(spark, d, "documents").select(
        "doc_id",
        F.md5(round_trip("string", F.col("text")).cast("binary")).alias("string_md5"),
        F.md5(round_trip("json", F.struct("text", "n_chars"))["text"].cast("binary")).alias("json_md5"),
        round_trip("int64", F.col("n_chars")).alias("n_chars"),
    )


def header_sequence(spark: SparkSession, d: str) -> DataFrame:
    """Sequence header of every message: some absent, some beyond 32 bits, some no number."""
    place = F.col("offset") % 25
    odd = F.when(place == 4, "3000000000").when(place == 9, "x1").otherwise(F.col("offset").cast("string"))
    headers = F.when(place == 14, header_array({"Producer": "fixture"})).otherwise(
        F.concat(F.col("headers"), header_array({"sequenceId": odd}))
    )
    log = fx.event_log(spark, d).withColumn("headers", headers)
    return log.select(
        F.col("partition").alias("p"), F.col("offset").alias("off"),
        fn.sequence_id().alias("seq"), fn.sequence_error().alias("error"),
    )


def suffix_partition(spark: SparkSession, d: str) -> DataFrame:
    place = F.col("event_id") % 40
    user = F.col("user_id").cast("string")
    key = (
        F.when(place == 1, F.lit(None).cast("string"))
        .when(place == 2, F.lit("user"))
        .when(place == 3, F.concat(F.lit("user -"), user))
        .otherwise(F.concat(F.lit("some user "), user))
    )
    keyed = fx.table(spark, d, "events").withColumn("k", key.cast("binary"))
    return keyed.select(
        "event_id", fn.partition_by_suffix("k", fx.PARTITIONS).alias("p"), fn.partition_error("k").alias("error")
    )


def int64_key(spark: SparkSession, d: str) -> DataFrame:
    signed = F.when(F.col("o_orderkey") % 2 == 0, -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    key = fn.encode_int64(signed)
    return fx.table(spark, d, "orders").select(
        "o_orderkey", F.lower(F.hex(key)).alias("key_hex"), fn.decode_int64(key).alias("decoded")
    )


def enum_names(spark: SparkSession, d: str) -> DataFrame:
    """State numbers to names and back; number 7 has no name."""
    events = fx.order_events(spark, d)
    number = F.when(F.col("order_id") % 10 == 0, 7).otherwise(fn.state_number(F.col("order_state")))
    return (
        events.select(number.alias("state"))
        .groupBy("state", fn.state_name(F.col("state")).alias("name"))
        .agg(F.count("*").alias("n"))
    )


def order_event_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    decoded = fn.decode_order_events(fn.encode_order_events(fx.order_events(spark, d)))
    return decoded.select(
        F.col("data.order_id").alias("order_id"), F.col("data.client_id").alias("client_id"),
        F.col("data.order_state").alias("order_state"),
        F.unix_micros("data.timestamp").alias("ts_us"), F.octet_length("value").alias("n_bytes"),
    )


# --- sequences, schema, sorted and replace-by-key tables --------------------------------------


def stamp_sequence(spark: SparkSession, d: str) -> DataFrame:
    """Order events numbered by date within their status."""
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return op.stamp_sequence(orders, ["o_orderdate", "o_orderkey"], ["o_orderstatus"]).drop("o_orderdate")


def numbered_messages(spark: SparkSession, d: str) -> DataFrame:
    rows = op.numbered_messages(
        fx.events(spark, d).select("event_id", "partition", "timestamp"),
        ["event_id"], F.col("timestamp"), ["partition"],
    )
    return rows.select(
        "event_id", F.col("partition").alias("p"), fn.sequence_id().alias("seq"),
        F.col("value").cast("string").alias("v"),
    )


def chunked(spark: SparkSession, d: str) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = fx.table(spark, d, "lineitem").select(*order, "l_quantity")
    chunks = op.chunk(lines, order, 10)
    return chunks.groupBy("chunk").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


def evolve_schema(spark: SparkSession, d: str) -> DataFrame:
    """Rows written before the columns existed, then rows that have them."""
    log = fx.event_log(spark, d).withColumn("_k", F.col("key").cast("string"))
    newer = op.with_log_metadata(log).filter(F.col("offset") % 2 == 1)
    old = log.filter(F.col("offset") % 2 == 0).select("_k", "offset")
    rows = op.evolve(old, newer.select("_k", "offset", "_topic", "_partition"), {"_topic": "before"})
    return rows.withColumnsRenamed({"_k": "k", "offset": "off"})


def count_view(spark: SparkSession, d: str) -> DataFrame:
    return sources.json_queue(fx.event_log(spark, d), QUEUE_SCHEMA).agg(F.count("*").alias("n"))


def json_queue_view(spark: SparkSession, d: str) -> DataFrame:
    rows = sources.json_queue(fx.faulty_log(spark, d), QUEUE_SCHEMA)
    return rows.groupBy(F.col("EntityType").alias("entity_type"), "_topic", "_partition").agg(
        F.count("*").alias("n"), F.count_distinct("Payload").alias("payloads")
    )


def sorted_target(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.events(spark, d).select(
        "event_type", F.concat(F.lit("repo_"), F.col("user_id").cast("string")).alias("repo_name"),
        F.unix_micros("timestamp").alias("created_us"), F.col("partition").alias("p"),
    )
    path = work_dir(spark, "sorted")
    sinks.write_sorted(rows, ["event_type", "repo_name", "created_us"], path)
    return spark.read.schema(rows.schema).parquet(path)


def read_committed(spark: SparkSession, d: str) -> DataFrame:
    """Messages in one transaction per 100 offsets; every seventh transaction never committed."""
    log = fx.event_log(spark, d).withColumn("txn_id", F.expr("offset div 100"))
    commits = log.filter(F.col("txn_id") % 7 != 3).select("txn_id").distinct()
    rows = sources.read_committed(log, commits)
    return _short(
        rows.groupBy(*PARTITION_KEYS).agg(F.count("*").alias("n"), F.max("offset").alias("last_off"))
    )


# --- deduplication, positions -----------------------------------------------------------------


def _deliveries(spark: SparkSession, d: str) -> DataFrame:
    first, again = fx.redelivered(spark, d)
    return first.unionByName(again)


def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    return op.dedup_first(_deliveries(spark, d), ["k"], ["arrival"])


def duplicates(spark: SparkSession, d: str) -> DataFrame:
    return op.duplicates(_deliveries(spark, d), ["k"], ["arrival"])


def ledger_new_only(spark: SparkSession, d: str) -> DataFrame:
    return op.new_only(dedup_first(spark, d), fx.ledger(spark, d), ["k"])


def null_keys(spark: SparkSession, d: str) -> DataFrame:
    """Messages whose key went missing."""
    keyed = _deliveries(spark, d).withColumn("k", F.when(F.col("arrival") % 9 != 4, F.col("k")))
    return op.null_keys(keyed, ["k"]).select("event_type", "arrival", F.col("_error").alias("error"))


def carry_positions(spark: SparkSession, d: str) -> DataFrame:
    """Customers present now, with the last order seen for each, else the start."""
    known = (
        fx.table(spark, d, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_orderkey").alias("position"))
    )
    return op.carry_positions(fx.table(spark, d, "customer"), known, ["c_custkey"])


def set_changes(spark: SparkSession, d: str) -> DataFrame:
    """Customers who ordered before 1997 against those who ordered since."""
    orders = fx.table(spark, d, "orders")
    since = F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")
    return op.set_changes(orders.filter(~since), orders.filter(since), ["o_custkey"])


# --- retries ----------------------------------------------------------------------------------


def retried(rows: DataFrame) -> DataFrame:
    return op.with_retries(rows, lambda n: F.when(F.col("failures") >= n, "processing_failed"))


def retry_outcomes(spark: SparkSession, d: str) -> DataFrame:
    rows = retried(fx.outcomes(spark, d))
    return rows.select("event_id", F.col("partition").alias("p"), "attempts", "delay_s", "outcome")


def retry_frame(spark: SparkSession, d: str) -> DataFrame:
    """The same outcomes with processing as a DataFrame step, failed rows going round again."""
    def process(rows: DataFrame, attempt: int) -> DataFrame:
        return rows.withColumn("_error", F.when(F.col("failures") >= attempt, "processing_failed"))

    rows = op.with_retries_frame(fx.outcomes(spark, d), process)
    return rows.select("event_id", F.col("partition").alias("p"), "attempts", "delay_s", "outcome")


def dlq_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = retried(fx.outcomes(spark, d))
    dead = sinks.dead_letters(rows, attempts=F.col("attempts"), failed_at=F.col("timestamp"))
    return dead.select("event_id", "error", "attempts", F.unix_micros("failed_at").alias("failed_us"))


def dlq_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Undecodable messages by reason, read back from the outcome table."""
    path = work_dir(spark, "outcomes")
    rows = fn.decode_json(fx.faulty_log(spark, d), EVENT_SCHEMA)
    sinks.write_outcomes(rows.select("partition", "offset", "value", "_error"), path)
    stored = spark.read.schema("_error string, outcome string").parquet(path)
    return stored.groupBy("outcome", F.col("_error").alias("error")).agg(F.count("*").alias("n"))


def pause_intervals(spark: SparkSession, d: str) -> DataFrame:
    pauses = op.pause_intervals(retried(fx.outcomes(spark, d)), ["partition"], "timestamp")
    return pauses.select(
        F.col("partition").alias("p"), F.unix_micros("paused_at").alias("paused_us"),
        F.unix_micros("resumed_at").alias("resumed_us"),
    )


def pause_holds(spark: SparkSession, d: str) -> DataFrame:
    rows = retried(fx.outcomes(spark, d))
    pauses = op.pause_intervals(rows, ["partition"], "timestamp")
    held = op.hold_paused(rows, pauses, ["partition"], "timestamp")
    return held.select(
        "event_id", F.col("partition").alias("p"), F.unix_micros("held_until").alias("held_us")
    )


# --- partition health -------------------------------------------------------------------------

CLIMBING = ("error", "signup", "purchase")


def classify_errors(spark: SparkSession, d: str) -> DataFrame:
    rows = fn.classify_errors(fx.attempts(spark, d))
    return rows.groupBy("error_code", "error_class", "retryable", "cooldown").agg(F.count("*").alias("n"))


def ewma_latency(spark: SparkSession, d: str) -> DataFrame:
    delivered = fx.attempts(spark, d).filter(F.col("kind") == "delivery")
    means = op.ewma(delivered, ["partition"], "attempt_no", "latency_ms")
    return _short(means.withColumn("ewma", F.round("ewma", 6)))


def inflight(spark: SparkSession, d: str) -> DataFrame:
    """Open attempts, and the count that leaks when errors do not close one."""
    attempts = fx.attempts(spark, d)
    leaked = op.inflight(attempts, leak=True).withColumnRenamed("inflight", "leaked")
    return _short(op.inflight(attempts).join(leaked, "partition"))


def recent_errors(spark: SparkSession, d: str) -> DataFrame:
    return _short(op.recent_errors(fx.attempts(spark, d, CLIMBING)))


def partition_health(spark: SparkSession, d: str) -> DataFrame:
    health = op.partition_health(fx.attempts(spark, d, CLIMBING), _now(spark, d))
    return _short(health.withColumn("avg_latency_ms", F.round("avg_latency_ms", 6)))


def partition_score(spark: SparkSession, d: str) -> DataFrame:
    now = _now(spark, d)
    health = op.partition_health(fx.attempts(spark, d), now)
    return _short(health.select("partition", F.round(fn.partition_score(now), 6).alias("score")))


def _now(spark: SparkSession, d: str) -> int:
    """Two seconds after the newest attempt."""
    return fx.events(spark, d).agg(F.max(F.unix_millis("timestamp"))).first()[0] + 2_000


def choose_partition(spark: SparkSession, d: str) -> DataFrame:
    """Best partition per hour, by the attempts of that hour as seen 4 s after its last error."""
    hour = F.expr("at_ms div 3600000")
    attempts = fx.attempts(spark, d).withColumn("hour", hour)
    health = op.partition_health(attempts, 0, ["hour", "partition"])
    now = F.coalesce(F.col("last_error_ms") + 4_000, F.lit(1))
    seen = health.withColumn("available", now > F.col("unavailable_until_ms"))
    chosen = op.choose_partition(seen, ["hour"], fx.PARTITIONS, now)
    return chosen.withColumn("score", F.round("score", 6))


def partition_quota(spark: SparkSession, d: str) -> DataFrame:
    """Rows that each partition of two topics takes, by the attempts of that topic."""
    topic = lambda number: F.concat(F.lit("t"), F.col(number) % 2)
    attempts = fx.attempts(spark, d).withColumn("topic", topic("attempt_no"))
    now = _now(spark, d)
    health = op.partition_health(attempts, now, PARTITION_KEYS)
    rows = fx.table(spark, d, "events").select("event_id", topic("event_id").alias("topic"))
    assigned = op.assign_by_quota(rows, health, ["topic"], "event_id", fx.PARTITIONS, now)
    return assigned.groupBy("topic", F.col("partition").alias("p")).agg(F.count("*").alias("quota"))


ROUTE_CODES = ["LeaderNotAvailable", "RequestTimedOut", "NotEnoughReplicas", "UnknownTopicOrPart", "MsgSizeTooLarge"]


def _scripted_error(attempt: int, partition: Column) -> Column:
    """Errors of an event's first attempts, up to twelve of them."""
    failing = F.when(F.col("event_type") == "error", F.col("event_id") % 13).otherwise(0)
    pick = (F.col("event_id") + 3 * attempt) % 31
    code = F.when(pick == 30, ROUTE_CODES[4])
    for i, name in enumerate(ROUTE_CODES[:4]):
        code = code.when(pick % 4 == i, name)
    return F.when(failing >= attempt, code)


def route_batch(spark: SparkSession, d: str) -> DataFrame:
    now = _now(spark, d)
    health = op.partition_health(fx.attempts(spark, d), now)
    rows = fx.table(spark, d, "events").select("event_id", "event_type")
    routed = op.route_batch(rows, health, _scripted_error, now, fx.PARTITIONS)
    return _short(routed.drop("event_type"))


def delivery_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded_metrics(op.delivery_metrics(fx.attempts(spark, d)))


def metrics_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of six hours with quantiles, from cells of one minute."""
    return six_hours(op.metric_cells(fx.attempts(spark, d)))


def six_hours(cells: DataFrame) -> DataFrame:
    metrics = op.metrics_from_cells(op.merge_cells(cells, "6 hours"))
    # averages of values with two digits often end in a 5 at the seventh, but not at the eleventh
    return _short(metrics.withColumns({c: F.round(c, 10) for c in metrics.columns if c.startswith("produce_latency")}))


def rounded_metrics(metrics: DataFrame) -> DataFrame:
    return _short(metrics.withColumn("produce_latency_ms", F.round("produce_latency_ms", 6)))


# --- change data capture ----------------------------------------------------------------------


def cdc_source(spark: SparkSession, d: str) -> DataFrame:
    customer = fx.table(spark, d, "customer")
    snapshot = customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    changes = fx.customer_changes(spark, d).filter(F.col("op") != "r")
    feed = sources.cdc_source(snapshot, changes)
    return feed.groupBy("op").agg(
        F.count("*").alias("n"), F.min("offset").alias("first_off"), F.max("name").alias("last_name")
    )


def _snapshot_feed(spark: SparkSession, d: str) -> DataFrame:
    rows, changes, windows = fx.chunked_table(spark, d)
    key = ["user_id", "event_type"]
    return sources.incremental_snapshot(rows, changes, windows, key, F.col("user_id") % fx.CHUNKS)


def incremental_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Feed of a table read in chunks while it changes."""
    return _snapshot_feed(spark, d).withColumnRenamed("offset", "off")


def incremental_snapshot_rows(spark: SparkSession, d: str) -> DataFrame:
    """The table after that feed: what it would be had all changes been seen."""
    feed = _snapshot_feed(spark, d)
    newest = op.latest_by_key(feed, ["user_id", "event_type"], ["offset"])
    return newest.filter("op <> 'd'").select("user_id", "event_type", "value")


def cdc_unwrap(spark: SparkSession, d: str) -> DataFrame:
    return _change_rows(op.unwrap_changes(fx.change_log(spark, d), ROW_SCHEMA))


def cdc_unwrap_rewritten(spark: SparkSession, d: str) -> DataFrame:
    return _change_rows(op.rewritten_changes(fx.rewritten_change_log(spark, d), ROW_SCHEMA))


def _change_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("key").cast("string").alias("k"), F.col("offset").alias("off"), "id", "name",
        F.col("__deleted").alias("deleted"), "is_tombstone", F.col("_error").alias("error"),
    )


def _unwrapped(spark: SparkSession, d: str) -> DataFrame:
    rows = op.unwrap_changes(fx.change_log(spark, d), ROW_SCHEMA, keep_tombstones=False)
    return rows.select("id", "name", "__deleted", "offset")


def _customer(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({"__deleted": "deleted", "offset": "off"})


def cdc_latest(spark: SparkSession, d: str) -> DataFrame:
    return _customer(op.latest_by_key(_unwrapped(spark, d), ["id"], ["offset"]))


def cdc_latest_live(spark: SparkSession, d: str) -> DataFrame:
    return _customer(op.latest_by_key(_unwrapped(spark, d), ["id"], ["offset"], drop_deleted=True))


def upsert_table(spark: SparkSession, d: str) -> DataFrame:
    """Snapshot, then changes, written as two batches and compacted."""
    rows = _unwrapped(spark, d)
    compacted = work_dir(spark, "compacted")
    with scratch(spark, "upsert") as (root,):
        upsert = sinks.upsert_sink(root, ["id"], ["offset"])
        upsert(rows.filter(F.col("offset") < 10_000_000), 0)
        upsert(rows.filter(F.col("offset") >= 10_000_000), 1)
        sinks.compact_upsert(spark, root, compacted, rows.schema, ["id"], ["offset"])
    return _customer(sinks.read_upsert(spark, compacted, rows.schema, ["id"], ["offset"]))


def mark_processed(spark: SparkSession, d: str) -> DataFrame:
    """Ids recorded by the second of two overlapping batches, the second one written twice."""
    root = work_dir(spark, "ledger")
    first, again = fx.redelivered(spark, d)
    ids = F.col("k").alias("message_id")
    sinks.mark_processed(again.select(ids), root, 0)
    second = first.unionByName(again).select(ids)
    sinks.mark_processed(second, root, 1)
    return sinks.mark_processed(second, root, 1)


BATCH_QUERIES = {
    f.__name__: f
    for f in [
        commit_max, commit_contiguous, commit_gap_timeout, skipped_gaps, seq_gaps, oldest_pending,
        clean_marks, non_monotonic_marks, read_log, bounded_read, selected_partitions,
        custom_partitioner, envelope, keyed_event_log, log_metadata, message_transform, user_hook,
        decode_json, decode_json_twice, codecs, header_sequence, suffix_partition, int64_key,
        enum_names, order_event_roundtrip, stamp_sequence, numbered_messages, chunked,
        evolve_schema, count_view, json_queue_view, sorted_target, read_committed, dedup_first,
        duplicates, ledger_new_only, null_keys, carry_positions, set_changes, retry_outcomes,
        retry_frame, dlq_rows, dlq_reasons, pause_intervals, pause_holds, classify_errors,
        ewma_latency, inflight, recent_errors, partition_health, partition_score,
        choose_partition, partition_quota, route_batch, delivery_metrics, metrics_rollup, cdc_source,
        incremental_snapshot, incremental_snapshot_rows, cdc_unwrap, cdc_unwrap_rewritten, cdc_latest,
        cdc_latest_live, upsert_table, mark_processed,
    ]
}

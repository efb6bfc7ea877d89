"""Logs, marks, attempts and changes derived from the given tables.

``event_id`` is dense from 0, so an event's place in partition ``event_id % 3`` is ``event_id div 3``
and needs no ranking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logweave.functions import header_array
from logweave.schemas import LOG_SCHEMA

PARTITIONS = 3
# Moment at which gaps and health are judged.
AS_OF_US = 1_704_844_800_000_000  # 2024-01-10T00:00:00Z
AS_OF_MS = AS_OF_US // 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instant(column: str) -> Column:
    """A zone-less timestamp read as UTC, whatever the session's zone."""
    return F.expr(
        f"timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column}))"
    )


def as_of() -> Column:
    return F.timestamp_micros(F.lit(AS_OF_US))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their place in the log."""
    return table(spark, sf_dir, "events").withColumns(
        {
            "timestamp": instant("ts"),
            "topic": F.lit("events"),
            "partition": (F.col("event_id") % PARTITIONS).cast("int"),
            "offset": F.expr(f"event_id div {PARTITIONS}"),
        }
    )


def event_json() -> Column:
    return F.concat(
        F.lit('{"Id":"'), F.col("event_id").cast("string"), F.lit('","EntityType":"'), F.col("event_type"),
        F.lit('","Payload":"user '), F.col("user_id").cast("string"), F.lit('"}'),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log; a stale sequence header precedes the right one."""
    sequence = {"sequenceId": F.col("offset")}
    headers = F.concat(
        header_array({"Producer": "fixture", "Machine": "localhost", "sequenceId": "-1"}),
        header_array(sequence),
    )
    return (
        events(spark, sf_dir)
        .withColumns(
            {
                "key": F.col("event_id").cast("string").cast("binary"),
                "value": event_json().cast("binary"),
                "headers": headers,
            }
        )
        .select(*LOG_SCHEMA.fieldNames())
    )


def faulty_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log with some values missing, broken, null or not objects, by place."""
    place = F.col("offset") % 20
    text = F.col("value").cast("string")
    value = (
        F.when(place == 3, F.lit(None).cast("string"))
        .when(place == 7, F.concat(F.lit("{"), text))
        .when(place == 11, F.lit("null"))
        .when(place == 13, F.concat(F.lit("["), text, F.lit("]")))
        .when(place == 17, F.concat(F.rtrim(text, F.lit("}")), F.lit(',"extra":{"a":[1]}}')))
        .otherwise(text)
    )
    return event_log(spark, sf_dir).withColumn("value", value.cast("binary"))


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event in 97 never finishes; the others finish up to a day later, out of order."""
    delay = F.make_dt_interval(secs=(F.col("event_id") * 7919 % 86400).cast("decimal(18,6)"))
    return (
        events(spark, sf_dir)
        .filter(F.col("event_id") % 97 != 53)
        .select(
            "topic", "partition", F.col("offset").alias("seq"), "offset",
            (F.col("timestamp") + delay).alias("processed_at"),
        )
    )


def redelivered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(first deliveries, later second deliveries of every fifth event)."""
    source = table(spark, sf_dir, "events")
    first = source.select(
        F.col("event_id").cast("string").alias("k"), "event_type", "value", F.col("event_id").alias("arrival")
    )
    again = source.filter(F.col("event_id") % 5 == 0).select(
        F.col("event_id").cast("string").alias("k"), "event_type", (F.col("value") + 1).alias("value"),
        (F.col("event_id") + 1_000_000_000).alias("arrival"),
    )
    return first, again


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_id") % 4 == 0)
        .select(F.col("event_id").cast("string").alias("k"))
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often processing an event fails before it works, 0 to 7 times."""
    failures = F.when(F.col("event_id") % 11 == 0, F.col("event_id") % 8).otherwise(0)
    return events(spark, sf_dir).select(
        "event_id", "partition", "timestamp", failures.cast("int").alias("failures")
    )


def attempts(spark: SparkSession, sf_dir: str, failing: tuple[str, ...] = ("error",)) -> DataFrame:
    """Per event a ``produce`` row and, unless still open, a ``delivery`` or ``error`` row."""
    failed = F.col("event_type").isin(*failing)
    names = ["LeaderNotAvailable", "RequestTimedOut", "MsgSizeTooLarge", "NotEnoughReplicas", "ProducerFenced"]
    code = F.when(failed, F.element_at(F.array(*map(F.lit, names)), (F.col("event_id") % 5 + 1).cast("int")))
    settled = F.when(F.col("event_id") % 50 == 0, F.array(F.lit("produce"))).otherwise(
        F.array(F.lit("produce"), F.when(failed, "error").otherwise("delivery"))
    )
    return (
        events(spark, sf_dir)
        .select(
            (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
            F.col("event_id").alias("attempt_no"),
            F.unix_millis("timestamp").alias("at_ms"),
            F.explode(settled).alias("kind"),
            "value",
            code.alias("code"),
        )
        .select(
            "partition", "attempt_no", "at_ms", "kind",
            F.when(F.col("kind") == "delivery", F.col("value")).alias("latency_ms"),
            F.when(F.col("kind") == "error", F.col("code")).alias("error_code"),
            F.when(F.col("kind") == "error", F.col("code") == "ProducerFenced").alias("is_fatal"),
        )
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("client_id"),
        F.when(status == "O", "ORDER_STATE_CREATED")
        .when(status == "P", "ORDER_STATE_CHANGED")
        .when(status == "F", "ORDER_STATE_COMPLETED")
        .otherwise("ORDER_STATE_UNSPECIFIED")
        .alias("order_state"),
        instant("o_orderdate").alias("timestamp"),
    )


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot reads, updates, deletes and re-inserts; ``offset`` is the change order."""
    customer = table(spark, sf_dir, "customer")
    key, name = F.col("c_custkey"), F.col("c_name")

    def part(rows: DataFrame, text: Column, op: str, base: int) -> DataFrame:
        return rows.select(
            key.alias("id"), text.alias("name"), F.lit(op).alias("op"), (key + base).alias("offset")
        )

    return (
        part(customer, name, "r", 0)
        .unionByName(part(customer.filter(key % 7 == 0), F.concat(name, F.lit(" v2")), "u", 10_000_000))
        .unionByName(part(customer.filter(key % 11 == 0), name, "d", 20_000_000))
        .unionByName(part(customer.filter(key % 77 == 0), F.concat(name, F.lit(" v3")), "c", 30_000_000))
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes as messages, inside a schema envelope; a tombstone follows every delete."""
    row = F.struct("id", "name")
    nothing = F.lit(None).cast("struct<id:bigint,name:string>")
    record = F.struct(
        F.when(F.col("op") == "d", row).otherwise(nothing).alias("before"),
        F.when(F.col("op") != "d", row).otherwise(nothing).alias("after"),
        "op",
    )
    text = F.to_json(F.struct(F.struct(F.lit("struct").alias("type")).alias("schema"), record.alias("payload")))
    return _change_messages(customer_changes(spark, sf_dir).withColumn("value", text))


def rewritten_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes as rows with a ``__deleted`` field, in an envelope for even ids; three ids of 13 are broken."""
    deleted = F.when(F.col("op") == "d", "true").otherwise("false").alias("__deleted")
    broken = F.col("id") % 13
    number = F.when(broken == 6, F.to_json(F.struct("id", F.col("id").alias("name"), deleted)))
    text = F.when(broken == 7, F.to_json(F.struct(F.lit("x").alias("id"), "name", deleted)))
    row = F.coalesce(number, text, F.to_json(F.struct("id", "name", deleted)))
    enveloped = F.concat(F.lit('{"schema":{"type":"struct"},"payload":'), row, F.lit("}"))
    value = F.when(F.col("id") % 2 == 0, enveloped).otherwise(row)
    value = F.concat(value, F.when(broken == 5, ' junk').otherwise(""))
    return _change_messages(customer_changes(spark, sf_dir).withColumn("value", value))


def _change_messages(changes: DataFrame) -> DataFrame:
    messages = changes.withColumn("partition", (F.col("id") % PARTITIONS).cast("int"))
    tombstones = messages.filter(F.col("op") == "d").withColumns(
        {"value": F.lit(None).cast("string"), "offset": F.col("offset") + 5_000_000}
    )
    return messages.unionByName(tombstones).select(
        F.col("id").cast("string").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("customers").alias("topic"),
        "partition",
        "offset",
        F.timestamp_micros(F.lit(0)).alias("timestamp"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
    )


CHUNKS = 8


def chunked_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, changes, windows) of a table read in chunks while it changes.

    An event sets the row of its user and type, every seventh deletes it. Chunk ``c`` is read while a twentieth of all
    changes happen; windows overlap, and rows of a chunk are seen at different moments. The changes are those
    since the first chunk was begun.
    """
    source = table(spark, sf_dir, "events")
    number = source.agg(F.max("event_id")).first()[0] + 1
    windows = spark.range(CHUNKS).select(
        F.col("id").alias("chunk"),
        F.expr(f"(id + 1) * {number}L div {3 * CHUNKS}").alias("low"),
        F.expr(f"(id + 1) * {number}L div {3 * CHUNKS} + {number}L div 20").alias("high"),
    )
    rows = source.select(
        "user_id", "event_type", "value", F.when(F.col("event_id") % 7 == 0, "d").otherwise("u").alias("op"),
        F.col("event_id").alias("offset"),
    )
    seen_at = F.col("low") + F.col("user_id") * 7919 % (F.col("high") - F.col("low") + 1)
    seen = (
        rows.join(windows, F.col("user_id") % CHUNKS == F.col("chunk"))
        .filter(F.col("offset") <= seen_at)
        .groupBy("user_id", "event_type")
        .agg(F.max_by(F.struct("value", "op"), "offset").alias("row"))
        .filter("row.op <> 'd'")
        .select("user_id", "event_type", "row.value")
    )
    return seen, rows.filter(F.col("offset") > number // (3 * CHUNKS)), windows

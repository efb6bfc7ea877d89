"""Row layouts shared by the operators.

A *log* is any DataFrame with ``LOG_SCHEMA``: the columns Spark's own log
connectors produce, so a file-backed log and a broker-backed one are
interchangeable downstream.
"""

from pyspark.sql import types as T

HEADERS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("headers", HEADERS),
    ]
)

MARK_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("seq", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)

ATTEMPT_SCHEMA = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("attempt_no", T.LongType()),
        T.StructField("at_ms", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("error_code", T.StringType()),
        T.StructField("is_fatal", T.BooleanType()),
    ]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("Id", T.StringType()),
        T.StructField("EntityType", T.StringType()),
        T.StructField("Payload", T.StringType()),
    ]
)

ORDER_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("client_id", T.LongType()),
        T.StructField("order_state", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# One topic-partition; most operators are keyed on it.
PARTITION_KEYS = ["topic", "partition"]

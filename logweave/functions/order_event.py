"""Order events: protobuf bytes and enum names.

The bytes go through ``google.protobuf`` in Arrow batches; its message class is built
from a descriptor, so no generated code is needed. Where Spark's protobuf package is on
the classpath, ``in_jvm=True`` uses its functions instead, without a Python worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Message layout (field number, type) and enum numbers.
MESSAGE_NAME = "OrderEvent"
ORDER_STATES = {
    0: "ORDER_STATE_UNSPECIFIED",
    1: "ORDER_STATE_CREATED",
    2: "ORDER_STATE_CHANGED",
    3: "ORDER_STATE_COMPLETED",
}


def state_name(number: Column) -> Column:
    """Enum name of a state number; null for an unknown number."""
    pairs = [F.lit(x) for item in ORDER_STATES.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), number)


def state_number(name: Column) -> Column:
    """State number of an enum name; null for an unknown name."""
    pairs = [F.lit(x) for number, text in ORDER_STATES.items() for x in (text, number)]
    return F.try_element_at(F.create_map(*pairs), name)


def descriptor_set() -> bytes:
    """Serialised descriptor of the message, as Spark's protobuf functions take it."""
    from google.protobuf import descriptor_pb2, timestamp_pb2

    file = descriptor_pb2.FileDescriptorProto(
        name="order_event.proto", package="orders", syntax="proto3",
        dependency=["google/protobuf/timestamp.proto"],
    )
    enum = file.enum_type.add(name="OrderState")
    for number, text in ORDER_STATES.items():
        enum.value.add(name=text, number=number)
    kinds = descriptor_pb2.FieldDescriptorProto
    message = file.message_type.add(name=MESSAGE_NAME)
    layout = [
        ("order_id", kinds.TYPE_INT64, None),
        ("client_id", kinds.TYPE_INT64, None),
        ("order_state", kinds.TYPE_ENUM, ".orders.OrderState"),
        ("timestamp", kinds.TYPE_MESSAGE, ".google.protobuf.Timestamp"),
    ]
    for number, (name, kind, type_name) in enumerate(layout, start=1):
        message.field.add(
            name=name, number=number, type=kind, type_name=type_name, label=kinds.LABEL_OPTIONAL
        )
    stamp = descriptor_pb2.FileDescriptorProto()
    timestamp_pb2.DESCRIPTOR.CopyToProto(stamp)
    return descriptor_pb2.FileDescriptorSet(file=[stamp, file]).SerializeToString()


def _message_class():
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    pool = descriptor_pool.DescriptorPool()
    for file in descriptor_pb2.FileDescriptorSet.FromString(descriptor_set()).file:
        pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"orders.{MESSAGE_NAME}"))


_FIELDS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("client_id", T.LongType()),
        T.StructField("state", T.IntegerType()),
        T.StructField("micros", T.LongType()),
    ]
)


@F.pandas_udf(T.BinaryType())
def _encode(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    cls = _message_class()
    for order_id, client_id, state, has_time, micros in batches:
        out = []
        for o, c, s, timed, t in zip(order_id, client_id, state, has_time, micros):
            message = cls(order_id=o, client_id=c, order_state=s)
            if timed:
                message.timestamp.seconds, micro = divmod(t, 1_000_000)
                message.timestamp.nanos = micro * 1_000
            out.append(message.SerializeToString())
        yield pd.Series(out, dtype="object")


@F.pandas_udf(_FIELDS)
def _decode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    from google.protobuf.message import DecodeError

    message = _message_class()()
    for values in batches:
        rows = []
        for value in values:
            row = (None, None, None, None)
            if value is not None:
                try:
                    message.ParseFromString(bytes(value))
                    stamp = message.timestamp
                    micros = (
                        stamp.seconds * 1_000_000 + stamp.nanos // 1_000
                        if message.HasField("timestamp")
                        else None
                    )
                    # a time that 64-bit microseconds cannot hold is a broken message
                    if micros is None or -(1 << 63) <= micros < 1 << 63:
                        row = (message.order_id, message.client_id, message.order_state, micros)
                except DecodeError:
                    pass
            rows.append(row)
        frame = pd.DataFrame(rows, columns=["order_id", "client_id", "state", "micros"], dtype="object")
        yield frame.astype({"order_id": "Int64", "client_id": "Int64", "state": "Int32", "micros": "Int64"})


# Filters on decoded fields would otherwise run the function a second time.
_encode_once, _decode_once = _encode.asNondeterministic(), _decode.asNondeterministic()


def encode_order_event(event: Column) -> Column:
    """Message bytes of an event struct; absent numbers are 0, an absent time is left out.

    Null for a state name that does not exist.
    """
    micros, state = F.unix_micros(event["timestamp"]), state_number(event["order_state"])
    # a column with nulls would reach Python as floats, and lose digits of long ids
    message = _encode_once(
        F.coalesce(event["order_id"], F.lit(0)), F.coalesce(event["client_id"], F.lit(0)),
        F.coalesce(state, F.lit(0)), micros.isNotNull(), F.coalesce(micros, F.lit(0)),
    )
    return F.when(event["order_state"].isNull() | state.isNotNull(), message)


def _event(raw: Column) -> Column:
    return F.struct(
        raw["order_id"].alias("order_id"),
        raw["client_id"].alias("client_id"),
        state_name(raw["state"]).alias("order_state"),
        F.timestamp_micros(raw["micros"]).alias("timestamp"),
    )


def _is_known(raw: Column) -> Column:
    return raw["order_id"].isNotNull() & state_name(raw["state"]).isNotNull()


def decode_order_event(value: Column) -> Column:
    """Event struct of message bytes; null if they are none, or the state is unknown."""
    events = F.transform(F.array(_decode_once(value)), lambda raw: F.when(_is_known(raw), _event(raw)))
    return F.element_at(events, 1)


def encode_order_events(df: DataFrame, into: str = "value", in_jvm: bool = False) -> DataFrame:
    """Add the message bytes of ``order_id, client_id, order_state, timestamp``."""
    event = F.struct("order_id", "client_id", "order_state", "timestamp")
    if in_jvm:
        from pyspark.sql.protobuf.functions import to_protobuf

        return df.withColumn(
            into, to_protobuf(event, MESSAGE_NAME, binaryDescriptorSet=descriptor_set())
        )
    return df.withColumn(into, encode_order_event(event))


def decode_order_events(
    df: DataFrame, value: str = "value", into: str = "data", in_jvm: bool = False
) -> DataFrame:
    """Add ``into`` (the event struct) and ``_error`` (null for a good row).

    Absent numbers read as 0 and an absent state as the unspecified one; an absent timestamp is
    null. A missing value, bytes that are no message and an unknown state number are errors.
    """
    if in_jvm:
        from pyspark.sql.protobuf.functions import from_protobuf

        parsed = from_protobuf(
            F.col(value),
            MESSAGE_NAME,
            binaryDescriptorSet=descriptor_set(),
            options={"mode": "PERMISSIVE", "enums.as.ints": "true", "emit.default.values": "true"},
        )
        raw = df.withColumn("_raw", parsed).withColumn(
            "_raw",
            F.struct(
                F.col("_raw.order_id").alias("order_id"),
                F.col("_raw.client_id").alias("client_id"),
                F.col("_raw.order_state").alias("state"),
                F.unix_micros("_raw.timestamp").alias("micros"),
            ),
        )
    else:
        raw = df.withColumn("_raw", _decode_once(F.col(value)))
    return (
        raw.withColumn(
            "_error",
            F.when(F.col(value).isNull(), "null_value")
            .when(F.col("_raw.order_id").isNull(), "malformed_message")
            .when(state_name(F.col("_raw.state")).isNull(), "unknown_enum"),
        )
        .withColumn(into, F.when(F.col("_error").isNull(), _event(F.col("_raw"))))
        .drop("_raw")
    )

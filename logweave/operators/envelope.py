"""Wrapping payloads as log rows, and exposing log metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logweave.functions.headers import header_array
from logweave.functions.json_codec import encode_json


def envelope(
    df: DataFrame,
    key: Column | None,
    value: Column,
    headers: dict[str, Column | str],
    producer: str = "logweave",
    machine: Column | str = "localhost",
) -> DataFrame:
    """Add ``key``, ``value`` and ``headers``: producer and machine first, then the given ones."""
    listed = header_array({"Producer": producer, "Machine": machine})
    return df.withColumns(
        {
            "headers": F.concat(listed, header_array(headers)) if headers else listed,
            "key": F.lit(None).cast("binary") if key is None else key.cast("binary"),
            "value": value.cast("binary"),
        }
    )


def to_keyed_log(df: DataFrame, key: str, columns: list[str], **headers: str) -> DataFrame:
    """Events as messages: the key column as key, JSON of ``columns`` as value."""
    return envelope(df, F.col(key).cast("string"), encode_json(*columns), headers)


def with_log_metadata(log: DataFrame) -> DataFrame:
    """Add ``_topic`` and ``_partition`` next to the log's own columns."""
    return log.select("*", F.col("topic").alias("_topic"), F.col("partition").alias("_partition"))


def prefix_value(prefix: str, value: Column | str = "value") -> Column:
    """Message transform: ``prefix`` followed by the text of the value."""
    column = F.col(value) if isinstance(value, str) else value
    return F.concat(F.lit(prefix), column.cast("string"))

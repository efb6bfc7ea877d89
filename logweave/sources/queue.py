"""A log of JSON objects, one per message, read as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from logweave.functions.json_codec import decode_json
from logweave.operators.envelope import with_log_metadata


def json_queue(log: DataFrame, schema: T.StructType, keep_bad: bool = False) -> DataFrame:
    """Fields of ``schema`` plus ``_topic`` and ``_partition``; works on batch and streaming logs.

    ``keep_bad`` also returns messages that do not decode, with their ``_error``.
    """
    rows = decode_json(with_log_metadata(log), schema)
    fields = [F.col(f"data.`{f.name}`").alias(f.name) for f in schema.fields]
    if keep_bad:
        return rows.select(*fields, "_topic", "_partition", "_error")
    return rows.filter(F.col("_error").isNull()).select(*fields, "_topic", "_partition")

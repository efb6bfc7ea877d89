"""Change records to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from logweave.functions.json_codec import parse_json
from logweave.operators.latest import DELETED


def unwrap_changes(log: DataFrame, row_schema: T.StructType, keep_tombstones: bool = True) -> DataFrame:
    """Row after each change, with ``__deleted`` 'true' / 'false', ``op`` and ``is_tombstone``.

    Values are change records ``{before, after, op}``, alone or as the ``payload`` of a schema
    envelope. A delete yields the row as it was before. A null value is a tombstone: its row fields
    are null, and its key says whose. Values that are not one JSON text, or whose fields are not of the
    schema's types, have ``_error`` set.
    """
    record = T.StructType(
        [
            T.StructField("before", row_schema),
            T.StructField("after", row_schema),
            T.StructField("op", T.StringType()),
        ]
    )
    parsed = _parse(log, record)
    row = F.coalesce("_change.after", "_change.before")
    deleted = F.when(F.col("_change.op") == "d", "true").otherwise("false")
    return _rows(parsed, log, row_schema, row, deleted, F.col("_change.op"), keep_tombstones)


def rewritten_changes(log: DataFrame, row_schema: T.StructType, keep_tombstones: bool = True) -> DataFrame:
    """The same from values that were unwrapped upstream: the row itself with a ``__deleted`` field,
    alone or as the ``payload`` of a schema envelope. ``op`` is 'd' for a delete, else null."""
    record = T.StructType([*row_schema.fields, T.StructField(DELETED, T.StringType())])
    parsed = _parse(log, record)
    change = F.col("_change")
    present = F.greatest(*[change[f.name].isNotNull() for f in record.fields])
    deleted = F.coalesce(change[DELETED], F.lit("false"))
    operation = F.when(change[DELETED] == "true", "d")
    return _rows(parsed, log, row_schema, F.when(present, change), deleted, operation, keep_tombstones)


def _parse(log: DataFrame, record: T.StructType) -> DataFrame:
    """Log with ``_change``, taken from the payload of an envelope or from the value itself; null if it is neither."""
    text = F.col("value").cast("string")
    envelope = T.StructType([T.StructField("payload", record)])
    # two layouts, as the row may have a column called payload; the second is tried where the first finds nothing
    found = F.coalesce(parse_json(text, envelope)["payload"], parse_json(text, record))
    # as the output of a generator the record is parsed once, whatever is filtered on later
    return log.select("*", F.explode(F.array(found)).alias("_change"))


def _rows(
    parsed: DataFrame,
    log: DataFrame,
    row_schema: T.StructType,
    row: Column,
    deleted: Column,
    operation: Column,
    keep_tombstones: bool,
) -> DataFrame:
    tombstone = F.col("value").isNull()
    out = parsed.select(
        *[c for c in log.columns if c != "value"],
        *[row[f.name].alias(f.name) for f in row_schema.fields],
        F.when(row.isNotNull(), deleted).alias(DELETED),
        operation.alias("op"),
        tombstone.alias("is_tombstone"),
        F.when(~tombstone & row.isNull(), "malformed_change").alias("_error"),
    )
    return out if keep_tombstones else out.filter(~F.col("is_tombstone"))

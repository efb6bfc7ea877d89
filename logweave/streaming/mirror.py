"""Mirror of a table, fed by its change log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from logweave.operators.changes import unwrap_changes
from logweave.operators.latest import DELETED
from logweave.sinks.batches import stage_batch
from logweave.sinks.upsert import compact_in_place, read_upsert, upsert_sink
from logweave.streaming.run import for_each_batch


def mirror_schema(row_schema: T.StructType) -> T.StructType:
    """Stored columns: the row, its deletion mark, and the offset of its change."""
    return T.StructType(
        [
            *row_schema.fields,
            T.StructField(DELETED, T.StringType()),
            T.StructField("offset", T.LongType()),
        ]
    )


def cdc_mirror(
    log: DataFrame,
    row_schema: T.StructType,
    key: list[str],
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    unwrap: Callable[..., DataFrame] = unwrap_changes,
) -> StreamingQuery:
    """Apply a change log to a replace-by-key table at ``root``.

    ``unwrap`` is ``rewritten_changes`` where the log holds rows that were unwrapped before.

    A key's changes are in one partition, so their offsets order them. Tombstones change nothing, as
    the delete before them has marked the row. Undecodable changes are kept under ``rejected``.
    """
    columns = mirror_schema(row_schema).fieldNames()
    upsert = upsert_sink(root, key, ["offset"])

    def step(batch: DataFrame, batch_id: int) -> None:
        changes = unwrap(batch, row_schema, keep_tombstones=False)
        stage_batch(changes.filter(F.col("_error").isNotNull()), root, batch_id, "rejected")
        upsert(changes.filter(F.col("_error").isNull()).select(*columns), batch_id)

    return for_each_batch(log, step, root, checkpoint, trigger)


def read_mirror(
    spark: SparkSession, root: str, row_schema: T.StructType, key: list[str], drop_deleted: bool = False
) -> DataFrame:
    """The mirrored table now."""
    return read_upsert(spark, root, mirror_schema(row_schema), key, ["offset"], drop_deleted)


def compact_mirror(
    spark: SparkSession, root: str, row_schema: T.StructType, key: list[str], drop_deleted: bool = False
) -> int | None:
    """Merge the parts of a mirror while its stream goes on; see ``compact_in_place``."""
    return compact_in_place(spark, root, mirror_schema(row_schema), key, ["offset"], drop_deleted)

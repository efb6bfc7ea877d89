"""Replace-by-key tables: append parts, merge on read, compact now and then."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from logweave.operators.latest import latest_by_key
from logweave.session import child_names, drop_table, temporary_tables
from logweave.sinks.batches import last_batch, read_batches, read_one_batch, write_batch

# id of a compacted table in its root: before the first batch of a stream that goes on there
SNAPSHOT = -1
# folder of merged parts below a root; the batch id of a merged part is that of the last batch in it
MERGED = "merged"


def upsert_sink(root: str, key: list[str], order: list[str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps a replace-by-key table at ``root``.

    A batch appends its newest row per key; nothing already stored is rewritten, so the cost of a
    batch follows the batch and not the table. ``read_upsert`` merges the parts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(latest_by_key(batch, key, order), root, batch_id)

    return write


def read_upsert(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    key: list[str],
    order: list[str],
    drop_deleted: bool = False,
) -> DataFrame:
    """Newest row per key over the newest merged part and the parts committed since."""
    merged = last_batch(spark, f"{root}/{MERGED}")
    parts = read_batches(spark, root, schema, after=merged).drop("batch_id")
    if merged is not None:
        parts = parts.union(read_one_batch(spark, f"{root}/{MERGED}", schema, merged))
    return latest_by_key(parts, key, order, drop_deleted)


def compact_upsert(
    spark: SparkSession,
    root: str,
    target: str,
    schema: T.StructType,
    key: list[str],
    order: list[str],
    drop_deleted: bool = False,
) -> None:
    """Write the merged table into a new root; readers move over when it is committed.

    A stream, with its old checkpoint or a new one, may go on at the new root: its batches come on top. Parts
    committed to the old root meanwhile are not in it, so stop the stream first.
    """
    write_batch(read_upsert(spark, root, schema, key, order, drop_deleted), target, SNAPSHOT)


def compact_in_place(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    key: list[str],
    order: list[str],
    drop_deleted: bool = False,
) -> int | None:
    """Merge what is committed into one part of the same root, while its stream and its readers go on.

    The merged part says up to which batch it reaches; readers take the newest one and the parts committed after that
    batch, so a batch that is committed meanwhile is in the table all the same. The parts it replaces stay for
    readers that have started, until the next call: a reader may go on through one compaction. Commit rows stay, as a
    stream that restarts looks for them.

    With ``drop_deleted`` marked rows leave the table for good; do that only if no change from before the
    deletion can still arrive. Returns the last batch merged, None if there is none. A call that died is made good by the
    next one. Only one call may run at a time.
    """
    merged = f"{root}/{MERGED}"
    previous, through = last_batch(spark, merged), last_batch(spark, root)
    if through is None or through == previous:
        return through
    with temporary_tables(spark):
        parts = read_batches(spark, root, schema, before=through + 1, after=previous).drop("batch_id")
        if previous is not None:
            parts = parts.union(read_one_batch(spark, merged, schema, previous))
        write_batch(latest_by_key(parts, key, order, drop_deleted), merged, through)
    if previous is not None:
        _drop_parts(spark, f"{root}/data", previous + 1)
        _drop_parts(spark, f"{merged}/data", previous)
    return through


def _drop_parts(spark: SparkSession, folder: str, before: int) -> None:
    for name in child_names(spark, folder):
        field, _, number = name.partition("=")
        if field == "batch_id" and int(number) < before:
            drop_table(spark, f"{folder}/{name}")

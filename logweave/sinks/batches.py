"""Tables written in numbered batches, each visible once its commit row is there.

Layout below a root: ``data/batch_id=N/`` holds the rows of a batch, ``commits/batch_id=N/`` its
commit row. The commit row is written last, and both directories are replaced when a batch is
written again. A run that dies half way thus leaves rows no reader sees, and its rerun leaves
exactly one copy.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logweave.session import drop_table, path_exists, small_side

# States of a stream that stay readable after newer ones were written.
KEPT_STATES = 10

_COMMIT_SCHEMA = T.StructType([T.StructField("batch_id", T.LongType())])
_COMMITTED_AT = T.StructField("committed_at", T.TimestampType())
_OWNER = T.StructField("owner", T.StringType())

_owner: ContextVar[str | None] = ContextVar("_owner", default=None)


@contextmanager
def owned_by(owner: str | None) -> Iterator[None]:
    """Commit rows written inside the block carry ``owner``, the id of a streaming query."""
    token = _owner.set(owner)
    try:
        yield
    finally:
        _owner.reset(token)


def stage_batch(df: DataFrame, root: str, batch_id: int, part: str = "data") -> None:
    """Write the rows of a batch without making them visible."""
    df.write.mode("overwrite").parquet(f"{root}/{part}/batch_id={batch_id}")


def commit_batch(spark: SparkSession, root: str, batch_id: int) -> None:
    """Make everything staged under ``batch_id`` visible at once."""
    owner = F.lit(_owner.get()).cast("string").alias("owner")
    row = spark.range(1).select(F.current_timestamp().alias("committed_at"), owner).coalesce(1)
    row.write.mode("overwrite").parquet(f"{root}/commits/batch_id={batch_id}")


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    stage_batch(df, root, batch_id)
    commit_batch(df.sparkSession, root, batch_id)


def commit_state(spark: SparkSession, root: str, batch_id: int, parts: list[str]) -> None:
    """Commit a batch whose ``parts`` hold the full state, and drop states no reader is on any more."""
    commit_batch(spark, root, batch_id)
    for part in parts:
        drop_table(spark, f"{root}/{part}/batch_id={batch_id - KEPT_STATES}")


def committed_batches(spark: SparkSession, root: str) -> DataFrame:
    """Ids of committed batches."""
    if not path_exists(spark, f"{root}/commits"):
        return spark.createDataFrame([], _COMMIT_SCHEMA)
    schema = T.StructType([_COMMITTED_AT, *_COMMIT_SCHEMA.fields])
    return spark.read.schema(schema).parquet(f"{root}/commits").select("batch_id")


def is_committed(spark: SparkSession, root: str, batch_id: int) -> bool:
    """Whether one batch is committed; looks at that batch only."""
    return bool(_commit_rows(spark, root, batch_id))


def is_committed_by(spark: SparkSession, root: str, batch_id: int, owner: str) -> bool:
    """Whether the streaming query ``owner`` committed a batch; raises if anything else did.

    Batch ids of a new checkpoint start at 0, so on a root that was used before they would name other rows.
    """
    rows = _commit_rows(spark, root, batch_id)
    if rows and rows[0]["owner"] != owner:
        raise RuntimeError(
            f"batch {batch_id} of {root} was not written by this checkpoint: resume its own checkpoint, or take a new root"
        )
    return bool(rows)


def _commit_rows(spark: SparkSession, root: str, batch_id: int) -> list:
    path = f"{root}/commits/batch_id={batch_id}"
    if not path_exists(spark, path):
        return []
    return spark.read.schema(T.StructType([_COMMITTED_AT, _OWNER])).parquet(path).take(1)


def last_batch(spark: SparkSession, root: str) -> int | None:
    """Newest committed batch id."""
    return committed_batches(spark, root).agg(F.max("batch_id")).first()[0]


def batch_before(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """The batch whose state a batch continues; ids of a checkpoint follow one another."""
    if batch_id == 0:
        return None
    if not is_committed(spark, root, batch_id - 1):
        raise RuntimeError(f"{root} lacks batch {batch_id - 1}: it belongs to another checkpoint")
    return batch_id - 1


def read_batches(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    before: int | None = None,
    part: str = "data",
    after: int | None = None,
) -> DataFrame:
    """Rows of all committed batches, with ``batch_id``; only those between ``after`` and ``before``, both excluded."""
    full = T.StructType([*schema.fields, *_COMMIT_SCHEMA.fields])
    if not path_exists(spark, f"{root}/{part}"):
        return spark.createDataFrame([], full)
    rows = spark.read.schema(full).parquet(f"{root}/{part}")
    commits = committed_batches(spark, root)
    # filters on the directory column prune the listing
    if before is not None:
        rows, commits = (table.filter(F.col("batch_id") < before) for table in (rows, commits))
    if after is not None:
        rows, commits = (table.filter(F.col("batch_id") > after) for table in (rows, commits))
    # a compacted table is one batch, so this join must not move the rows by batch id; batches committed
    # after this call are not read, whatever the number of batches
    return rows.join(small_side(commits), "batch_id", "left_semi")


def read_one_batch(
    spark: SparkSession, root: str, schema: T.StructType, batch_id: int | None, part: str = "data"
) -> DataFrame:
    """Rows of one batch; an empty table for ``None``. A part that is gone raises, as its rows would be missed."""
    if batch_id is None:
        return spark.createDataFrame([], schema)
    path = f"{root}/{part}/batch_id={batch_id}"
    if not path_exists(spark, path):
        raise RuntimeError(f"{path} is gone")
    return spark.read.schema(schema).parquet(path)

"""Ledger of processed message ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from logweave.operators.dedup import dedup_first, new_only
from logweave.session import drop_table
from logweave.sinks import batches
from logweave.sinks.batches import commit_batch, committed_batches, stage_batch
from logweave.sinks.key_store import add_ids, all_ids, known_ids, read_runs

LEDGER_SCHEMA = T.StructType([T.StructField("message_id", T.StringType())])


def read_ledger(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """Ids recorded so far; with ``before``, only by earlier batches, as far back as states are kept."""
    runs = read_runs(spark, root, _last_before(spark, root, before))
    return all_ids(spark, root, runs).select(F.col("id").alias("message_id"))


def _last_before(spark: SparkSession, root: str, batch_id: int | None) -> int | None:
    commits = committed_batches(spark, root)
    if batch_id is not None:
        commits = commits.filter(F.col("batch_id") < batch_id)
    return commits.agg(F.max("batch_id")).first()[0]


def ledger_rows(df: DataFrame, key: str | Column) -> DataFrame:
    """The ledger entry of each row."""
    column = F.col(key) if isinstance(key, str) else key
    return df.select(column.cast("string").alias("message_id"))


def mark_processed(ids: DataFrame, root: str, batch_id: int) -> DataFrame:
    """Record ids that are not in the ledger yet; returns those that were new.

    Written again, a batch compares itself with earlier batches only and so records the same ids. The
    new ids of the last batches can be read below ``root``/data; the ledger itself is a key store.
    """
    spark = ids.sparkSession
    runs = read_runs(spark, root, _last_before(spark, root, batch_id))
    first = dedup_first(ids, ["message_id"], ["message_id"]).persist()
    try:
        known = known_ids(spark, root, runs, first.select(F.col("message_id").alias("id")))
        new = new_only(first, known.withColumnRenamed("id", "message_id"), ["message_id"])
        stage_batch(new, root, batch_id)
    finally:
        first.unpersist()
    stored = spark.read.schema(LEDGER_SCHEMA).parquet(f"{root}/data/batch_id={batch_id}")
    add_ids(spark, root, batch_id, runs, stored.select(F.col("message_id").alias("id")))
    commit_batch(spark, root, batch_id)
    drop_table(spark, f"{root}/data/batch_id={batch_id - batches.KEPT_STATES}")
    return stored

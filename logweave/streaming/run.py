"""Starting micro-batch queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from logweave.session import temporary_tables
from logweave.sinks.batches import is_committed_by, owned_by

AVAILABLE_NOW = {"availableNow": True}


def for_each_batch(
    stream: DataFrame,
    step: Callable[[DataFrame, int], None],
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Run ``step(batch, batch_id)`` on every micro-batch; the checkpoint says where to resume.

    The step commits its batch below ``root``. A batch that was committed there before the
    checkpoint heard of it comes again after a restart and is passed over. A batch that another
    checkpoint committed there stops the query, since its rows are not those of this batch.
    """
    owner: list[str] = []

    def once(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not owner:
            owner.append(query_id(spark, checkpoint))
        if not is_committed_by(spark, root, batch_id, owner[0]):
            with temporary_tables(spark), owned_by(owner[0]):
                step(batch, batch_id)

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(once)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that a checkpoint belongs to; it stays the same over restarts."""
    row = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").select(F.get_json_object("value", "$.id")).first()
    return row[0]


def every(seconds: float) -> dict:
    """Trigger that starts a micro-batch each ``seconds``."""
    return {"processingTime": f"{int(seconds * 1000)} milliseconds"}


def finish(query: StreamingQuery) -> None:
    """Wait for a bounded query, raising its error if it failed."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside the block keep their state on local disk with checkpoints, not in memory.

    For state that grows with the stream, such as the keys of ``dedup_stream``. A query has to be
    started this way every time, because a checkpoint is bound to one kind of state store.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)

"""Session-level helpers: shared scratch space and size-checked join sides."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# A join side at most this long is turned into a local relation (see ``small_side``).
SMALL_SIDE_ROWS = 50_000

_local_base: dict[str, str] = {}
_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Intermediate tables go there, so they survive the loss of an executor. Only
    a local master may do without the setting; it then gets a temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if context.applicationId not in _local_base:
            _local_base[context.applicationId] = tempfile.mkdtemp(prefix="logweave-")
        base = _local_base[context.applicationId]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a shared table and read it back, cutting its lineage."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    if _written.get() is not None:
        _written.get().append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables ``materialize`` writes inside the block when it ends.

    For work whose results are written before the block ends, such as one micro-batch.
    """
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        for path in paths:
            drop_table(spark, path)


def kept_table(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, as a table; all tables that ``materialize`` wrote on the way are deleted."""
    path = work_dir(spark, name)
    with temporary_tables(spark):
        df = make()
        df.write.parquet(path)
    if _written.get() is not None:
        _written.get().append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, *names: str) -> Iterator[list[str]]:
    """Fresh paths for the block, deleted when it ends."""
    paths = [work_dir(spark, name) for name in names]
    try:
        yield paths
    finally:
        for path in paths:
            drop_table(spark, path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete the files of a table; nothing happens if there are none."""
    file_system, hadoop_path = _resolve(spark, path)
    file_system.delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whichever file system it names."""
    file_system, hadoop_path = _resolve(spark, path)
    return file_system.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below a path; none if there is no such path."""
    file_system, hadoop_path = _resolve(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(hadoop_path)]


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def small_side(df: DataFrame, max_rows: int = SMALL_SIDE_ROWS) -> DataFrame:
    """Evaluate a table that is expected to be small, and check that it is.

    Up to ``max_rows`` rows become a local relation: Spark then knows its true
    size and broadcasts it by its own threshold. A longer table is written, and
    the join shuffles both sides. Either way the rows are those of this moment,
    and what was evaluated for the check is not evaluated again.
    """
    level = df.storageLevel
    own = not (level.useMemory or level.useDisk)
    if own:
        df.persist()
    try:
        rows = df.limit(max_rows + 1).toArrow()
        if rows.num_rows > max_rows:
            return materialize(df, "side")
        return df.sparkSession.createDataFrame(rows, df.schema)
    finally:
        if own:
            df.unpersist()

"""Snapshot plus change feed of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logweave.session import small_side


def snapshot_options(
    url: str, table: str, key: str, bounds: tuple[int, int], readers: int, **options: str
) -> dict[str, str]:
    """Connector options that read a table over ``readers`` connections, split on a numeric key."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(readers),
        **options,
    }


def jdbc_snapshot(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The rows of a database table now; see ``snapshot_options``."""
    return spark.read.format("jdbc").options(**options).load()


def cdc_source(snapshot: DataFrame, changes: DataFrame, order: str = "offset") -> DataFrame:
    """One feed: snapshot rows as ``op = 'r'``, ordered before every change, then the changes.

    ``changes`` has the snapshot's columns, ``op`` and the order column.
    """
    read = snapshot.withColumn("op", F.lit("r"))
    if order not in snapshot.columns:
        read = read.withColumn(order, F.lit(-1).cast("bigint"))
    return read.unionByName(changes)


def incremental_snapshot(
    snapshot: DataFrame,
    changes: DataFrame,
    windows: DataFrame,
    key: list[str],
    chunk: Column,
    order: str = "offset",
) -> DataFrame:
    """One feed of a table that was read chunk by chunk while it changed.

    ``chunk`` gives a row's chunk from its key columns, alike in ``snapshot`` and ``changes``. ``windows`` has
    ``chunk, low, high``: the positions of the change log just before and just after the chunk was read; windows
    may overlap. ``changes`` has the snapshot's columns, ``op`` and the order column, and reaches back to the lowest
    ``low`` at least.

    A row of the snapshot may be from before or after a change within its chunk's window, so such a
    change wins and the row is left out. All other rows stand for every change up to ``high``: they come as ``op = 'r'`` at
    that position, and later changes come on top. A chunk without a window has not been read to its
    end: its rows are left out until it is read again. Windows of one chunk read several times count as one from the lowest ``low`` to the
    highest ``high``. Keys are not null, as in a database.

    Changes are reduced to the keys changed within their window before they are shuffled, so a key that changes
    all the time costs one row per task.
    """
    ends = small_side(
        windows.groupBy(F.col("chunk").alias("_chunk")).agg(F.min("low").alias("_low"), F.max("high").alias("_high"))
    )
    inside = (F.col(order) > F.col("_low")) & (F.col(order) <= F.col("_high"))
    changed = changes.select(*key, order, chunk.alias("_chunk")).join(ends, "_chunk").filter(inside).select(*key).distinct()
    read = snapshot.withColumn("_chunk", chunk).join(ends, "_chunk").join(changed, key, "left_anti")
    rows = read.withColumns({"op": F.lit("r"), order: F.col("_high")}).drop("_chunk", "_low", "_high")
    return rows.unionByName(changes)

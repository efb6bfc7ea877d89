"""Comparing two states of a keyed table, such as partitions and their read positions."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, functions as F


def carry_positions(
    actual: DataFrame, positions: DataFrame, keys: list[str], earliest: Any = 0, position: str = "position"
) -> DataFrame:
    """Known position of every current key, ``earliest`` for a new one; vanished keys drop out."""
    known = positions.select(*keys, position)
    return actual.select(*keys).join(known, keys, "left").withColumn(
        position, F.coalesce(F.col(position), F.lit(earliest))
    )


def set_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Every key of either side, with ``change``: added, removed or kept."""
    before = old.select(*keys).distinct().withColumn("_old", F.lit(True))
    after = new.select(*keys).distinct().withColumn("_new", F.lit(True))
    change = (
        F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("kept")
    )
    return before.join(after, keys, "full").select(*keys, change.alias("change"))

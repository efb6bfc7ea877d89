"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DELETED = "__deleted"


def latest_by_key(
    df: DataFrame, key: list[str], order: list[str], drop_deleted: bool = False
) -> DataFrame:
    """The row with the greatest ``order`` per key.

    An aggregate, not a window: every task first reduces its own rows to one per key, so a key that
    holds much of the data costs one row per task in the shuffle. Deleted rows stay, marked in
    ``__deleted``, unless they are dropped; deletion is judged after the newest row is known.
    """
    rest = [c for c in df.columns if c not in key]
    newest = (
        df.groupBy(*key)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*[F.col(c) if c in key else F.col(f"_row.`{c}`").alias(c) for c in df.columns])
    )
    return newest.filter(F.col(DELETED) != "true") if drop_deleted else newest

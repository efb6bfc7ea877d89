"""Ordered scans that do not put a whole group into one task.

A log has few partitions, so a window over a partition would run on few tasks. These helpers cut a
group into blocks of consecutive order values, scan every block on its own, and carry a summary of
one row per block across blocks. Only the summary, shorter than the data by the block width, is
ordered per group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

# A block spans 2 ** BLOCK_BITS order values. With one row per value it holds no more rows than that.
BLOCK_BITS = 16


def block_of(order: Column | str, bits: int = BLOCK_BITS) -> Column:
    """Number of the block of ``2 ** bits`` consecutive values that an integer falls in."""
    column = F.col(order) if isinstance(order, str) else order
    return F.shiftright(column.cast("bigint"), bits)


def block_bits(df: DataFrame, order: str) -> int:
    """Bits for order values that are not dense, such as times: blocks of some 2 ** BLOCK_BITS rows.

    One aggregate over the order column. Without it, sparse values would leave a row per block.
    """
    low, high, count = df.agg(F.min(order), F.max(order), F.count(order)).first()
    if not count:
        return BLOCK_BITS
    return BLOCK_BITS + max(0, round(math.log2((high - low + 1) / count)))


def running_max(
    df: DataFrame,
    by: list[str],
    order: str,
    value: Column,
    into: str,
    bits: int = BLOCK_BITS,
    inclusive: bool = True,
) -> DataFrame:
    """Add the largest ``value`` among rows up to this one (or before it) within ``by``."""
    blocked = df.withColumns({"_block": block_of(order, bits), "_value": value})
    last = Window.currentRow if inclusive else -1
    inside = Window.partitionBy(*by, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, last)
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        blocked.groupBy(*by, "_block")
        .agg(F.max("_value").alias("_top"))
        .withColumn("_carry", F.max("_top").over(earlier))
        .select(*by, "_block", "_carry")
    )
    return (
        blocked.withColumn("_here", F.max("_value").over(inside))
        .join(carry, [*by, "_block"], "left")
        .withColumn(into, F.greatest("_here", "_carry"))
        .select(*df.columns, into)
    )

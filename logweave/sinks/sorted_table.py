"""Columnar table kept in sort order."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_sorted(df: DataFrame, columns: list[str], path: str, mode: str = "append") -> None:
    """Write parquet files that are sorted inside and do not overlap in range.

    Range partitioning samples the data, so a frequent leading value is split on the columns after
    it; row-group statistics then let readers skip by the sort columns.
    """
    (
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .write.mode(mode)
        .parquet(path)
    )

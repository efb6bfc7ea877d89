"""Rows of committed transactions only."""

from __future__ import annotations

from pyspark.sql import DataFrame


def read_committed(log: DataFrame, commits: DataFrame, on: str = "txn_id") -> DataFrame:
    """Rows whose transaction is listed in ``commits``; an unlisted transaction stays invisible.

    ``commits`` needs no deduplication, the join only tests for presence.
    """
    return log.join(commits.select(on), on, "left_semi")

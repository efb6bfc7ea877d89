"""Load score of a partition; lower is better."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weights and the penalty steps by age of the last error.
INFLIGHT_WEIGHT = 1.0
LATENCY_WEIGHT = 0.05
ERROR_WEIGHT = 5.0
FRESH_ERROR_MS, FRESH_ERROR_PENALTY = 3_000, 8.0
RECENT_ERROR_MS, RECENT_ERROR_PENALTY = 10_000, 4.0


def partition_score(now_ms: Column | int) -> Column:
    """Score from the columns of ``partition_health``; a partition that never failed has no penalty."""
    age = (F.lit(now_ms) if isinstance(now_ms, int) else now_ms) - F.col("last_error_ms")
    penalty = (
        F.when(age < FRESH_ERROR_MS, FRESH_ERROR_PENALTY)
        .when(age < RECENT_ERROR_MS, RECENT_ERROR_PENALTY)
        .otherwise(0.0)
    )
    return (
        F.col("inflight") * INFLIGHT_WEIGHT
        + F.col("avg_latency_ms") * LATENCY_WEIGHT
        + F.col("recent_errors") * ERROR_WEIGHT
        + penalty
    )

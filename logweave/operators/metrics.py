"""Delivery metrics per time window and partition."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from logweave.functions.errors import is_retryable

# Codes counted as serialization trouble and as a full queue.
SERIALIZATION_CODES = ["Local_KeySerialization", "Local_ValueSerialization"]
QUEUE_FULL_CODE = "Local_QueueFull"


def delivery_metrics(
    attempts: DataFrame, every: str = "1 minute", watermark: str | None = None
) -> DataFrame:
    """Latency, load, errors and retries per window of ``every``; batch and streaming.

    A streaming input with ``watermark`` drops attempts later than that and lets old windows go.
    """
    timed = attempts.withColumn("at", F.timestamp_millis("at_ms"))
    if watermark is not None:
        timed = timed.withWatermark("at", watermark)
    failed = F.col("kind") == "error"
    latency = F.when(F.col("kind") == "delivery", F.col("latency_ms"))
    retry = failed & is_retryable(F.col("error_code"), F.col("is_fatal"))
    return (
        timed.groupBy(F.window("at", every).alias("_window"), "partition")
        .agg(
            F.avg(latency).alias("produce_latency_ms"),
            F.percentile_approx(latency, 0.95).alias("produce_latency_p95_ms"),
            F.count_if(retry).alias("retry_count"),
            F.count_if(F.col("kind") == "produce").alias("partition_load"),
            F.count_if(failed).alias("delivery_errors"),
            F.count_if(F.col("error_code").isin(SERIALIZATION_CODES)).alias("serialization_errors"),
            F.count_if(F.col("error_code") == QUEUE_FULL_CODE).alias("queue_full"),
        )
        .select(
            F.unix_millis("_window.start").alias("window_start_ms"), "partition",
            "produce_latency_ms", "produce_latency_p95_ms", "retry_count", "partition_load",
            "delivery_errors", "serialization_errors", "queue_full",
        )
    )


# Relative error of quantiles that are read from cells.
ACCURACY = 0.01
# Above every exponent of a cell, so that cells are ordered as the values in them.
_CELL_OFFSET = 1 << 20
CELL_COUNTS = [
    "latency_count", "latency_sum", "retry_count", "partition_load", "delivery_errors", "serialization_errors",
    "queue_full",
]


def latency_cell(value: Column, accuracy: float = ACCURACY) -> Column:
    """The cell of a value, a whole number: any two values of a cell are within ``accuracy`` of its middle.

    Borders of cells grow by one factor, so there are about 1,400 cells between a microsecond and a day at
    the default accuracy. Zero has a cell, negative values mirror positive ones; null and values that
    are not finite have none.
    """
    if not 0.0005 <= accuracy < 1:
        raise ValueError("accuracy must be at least 0.0005 and below 1")
    exponent = F.ceil(F.log(F.abs(value)) / math.log((1 + accuracy) / (1 - accuracy)))
    cell = F.signum(value).cast("long") * (F.lit(_CELL_OFFSET) + exponent)
    finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(finite, F.when(value == 0, F.lit(0).cast("long")).otherwise(cell))


def cell_value(cell: Column, accuracy: float = ACCURACY) -> Column:
    """The value that stands for all of a cell."""
    growth = (1 + accuracy) / (1 - accuracy)
    size = F.pow(F.lit(growth), F.abs(cell) - _CELL_OFFSET) * (2 / (growth + 1))
    return F.when(cell == 0, F.lit(0.0)).otherwise(F.signum(cell) * size)


def metric_cells(
    attempts: DataFrame, every: str = "1 minute", by: Sequence[str] = ("partition",), accuracy: float = ACCURACY
) -> DataFrame:
    """Delivery metrics in a form that adds up: ``window_start_ms``, ``by``, ``cell`` and counts.

    One row for each window, group and cell of latencies; attempts without a latency have the null cell. Counts of rows
    that agree in the first columns may be added in any order, also over windows (``merge_cells``), and
    ``metrics_from_cells`` reads averages and quantiles from them. Attempts without a time are left out.
    """
    failed = F.col("kind") == "error"
    latency = F.when(F.col("kind") == "delivery", F.col("latency_ms"))
    retry = failed & is_retryable(F.col("error_code"), F.col("is_fatal"))
    cells = attempts.withColumns({"_cell": latency_cell(latency, accuracy), "_at": F.timestamp_millis("at_ms")})
    return (
        cells.groupBy(F.window("_at", every).alias("_window"), *by, "_cell")
        .agg(
            F.count("_cell").alias("latency_count"),
            F.sum(F.when(F.col("_cell").isNotNull(), latency)).alias("latency_sum"),
            F.count_if(retry).alias("retry_count"),
            F.count_if(F.col("kind") == "produce").alias("partition_load"),
            F.count_if(failed).alias("delivery_errors"),
            F.count_if(F.col("error_code").isin(SERIALIZATION_CODES)).alias("serialization_errors"),
            F.count_if(F.col("error_code") == QUEUE_FULL_CODE).alias("queue_full"),
        )
        .select(F.unix_millis("_window.start").alias("window_start_ms"), *by, F.col("_cell").alias("cell"), *CELL_COUNTS)
    )


def merge_cells(cells: DataFrame, every: str | None = None, by: Sequence[str] = ("partition",)) -> DataFrame:
    """Add cells that agree; with ``every`` windows become that long, and columns outside ``by`` go."""
    if every is not None:
        start = F.window(F.timestamp_millis("window_start_ms"), every)["start"]
        cells = cells.withColumn("window_start_ms", F.unix_millis(start))
    return cells.groupBy("window_start_ms", *by, "cell").agg(*[F.sum(c).alias(c) for c in CELL_COUNTS])


def metrics_from_cells(
    cells: DataFrame,
    by: Sequence[str] = ("partition",),
    quantiles: Sequence[float] = (0.5, 0.95, 0.99),
    accuracy: float = ACCURACY,
) -> DataFrame:
    """One row per window and group of ``merge_cells`` output, with a column such as ``produce_latency_p95_ms`` per quantile.

    A quantile is within ``accuracy`` of the exact one, whatever was merged on the way. It is null, as is the average,
    where there are no latencies. ``accuracy`` is that of the cells.
    """
    keys = ["window_start_ms", *by]
    # a group has one row per cell, so a window holds few rows however many attempts there were
    group = Window.partitionBy(*keys)
    ranked = cells.withColumns(
        {
            "_reached": F.sum("latency_count").over(group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)),
            "_all": F.sum("latency_count").over(group),
        }
    )
    found = []
    for q in quantiles:
        # the rank that a discrete quantile has among all values, from 1
        rank = F.greatest(F.col("_all") - F.floor(F.col("_all") - F.col("_all") * F.lit(float(q))), F.lit(1))
        least = F.min(F.when(F.col("_reached") >= rank, F.col("cell")))
        found.append(cell_value(least, accuracy).alias(f"produce_latency_p{100 * q:g}_ms".replace(".", "_")))
    average = F.try_divide(F.sum("latency_sum"), F.sum("latency_count"))
    counts = [F.sum(c).alias(c) for c in CELL_COUNTS if not c.startswith("latency")]
    return ranked.groupBy(*keys).agg(average.alias("produce_latency_ms"), *found, *counts)

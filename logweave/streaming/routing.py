"""Health-routed delivery of a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from logweave.operators.routing import ErrorAt, route_batch
from logweave.sinks.batches import write_batch
from logweave.streaming.run import for_each_batch


def route_stream(
    stream: DataFrame,
    health: Callable[[], DataFrame],
    error_at: ErrorAt,
    now_ms: Callable[[], int],
    partitions: int,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Route every micro-batch by the health known when it starts, and keep all outcomes.

    ``health`` is asked once per micro-batch, for example for ``read_health`` of a health stream that
    runs beside this one. Rows whose outcome is not ``delivered`` are dead letters. ``options`` go to
    ``route_batch``.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        routed = route_batch(batch, health(), error_at, now_ms(), partitions, **options)
        write_batch(routed, root, batch_id)

    return for_each_batch(stream, step, root, checkpoint, trigger)

"""Streaming forms of the operators."""

from logweave.streaming.cells import cells_stream, read_cells
from logweave.streaming.commits import commit_batches, track_commits
from logweave.streaming.dedup import dedup_stream, first_arrivals, idempotent_consume
from logweave.streaming.health import health_stream, metrics_stream
from logweave.streaming.mirror import cdc_mirror
from logweave.streaming.pauses import pause_stream
from logweave.streaming.pipes import continuous_view, micro_batch_sink, retry_sink, transactional_pipe
from logweave.streaming.routing import route_stream
from logweave.streaming.run import every, finish, rocksdb_state

__all__ = [
    "cdc_mirror", "cells_stream", "commit_batches", "continuous_view", "dedup_stream", "every", "finish", "first_arrivals",
    "health_stream", "idempotent_consume", "metrics_stream", "micro_batch_sink", "pause_stream", "read_cells", "retry_sink",
    "rocksdb_state", "route_stream", "track_commits", "transactional_pipe",
]

"""Inputs: logs, JSON queues, committed batches, change feeds."""

from logweave.sources.changes import cdc_source, incremental_snapshot, jdbc_snapshot, snapshot_options
from logweave.sources.committed import read_committed
from logweave.sources.log import broker_options, read_log
from logweave.sources.queue import json_queue

__all__ = [
    "broker_options", "cdc_source", "incremental_snapshot", "jdbc_snapshot", "json_queue", "read_committed", "read_log",
    "snapshot_options",
]

"""Outputs: logs, dead letters, numbered batches, replace-by-key and sorted tables, the id ledger."""

from logweave.sinks.batches import commit_batch, read_batches, stage_batch, write_batch
from logweave.sinks.dead_letter import dead_letters, split_dlq, write_outcomes
from logweave.sinks.ledger import mark_processed, read_ledger
from logweave.sinks.log import PROFILES, sink_options, write_log
from logweave.sinks.sorted_table import write_sorted
from logweave.sinks.upsert import compact_in_place, compact_upsert, read_upsert, upsert_sink

__all__ = [
    "PROFILES", "commit_batch", "compact_in_place", "compact_upsert", "dead_letters", "mark_processed",
    "read_batches", "read_ledger", "read_upsert", "sink_options", "split_dlq", "stage_batch",
    "upsert_sink", "write_batch", "write_log", "write_outcomes", "write_sorted",
]

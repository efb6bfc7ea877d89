"""DataFrame operators over logs, marks, attempts and changes."""

from logweave.operators.changes import rewritten_changes, unwrap_changes
from logweave.operators.commit import (
    clean_marks,
    commit_positions,
    finished_runs,
    gaps,
    non_monotonic,
    oldest_pending,
    skipped_gaps,
)
from logweave.operators.dedup import dedup_first, duplicates, new_only, null_keys
from logweave.operators.envelope import envelope, prefix_value, to_keyed_log, with_log_metadata
from logweave.operators.evolve import evolve
from logweave.operators.health import (
    assign_by_quota,
    choose_partition,
    ewma,
    inflight,
    partition_health,
    partition_quotas,
    recent_errors,
)
from logweave.operators.latest import latest_by_key
from logweave.operators.metrics import delivery_metrics, merge_cells, metric_cells, metrics_from_cells
from logweave.operators.positions import carry_positions, set_changes
from logweave.operators.retry import hold_paused, pause_intervals, with_retries, with_retries_frame
from logweave.operators.routing import route_batch
from logweave.operators.sequence import chunk, numbered_messages, stamp_sequence

__all__ = [
    "assign_by_quota", "carry_positions", "choose_partition", "chunk", "clean_marks", "commit_positions",
    "dedup_first", "delivery_metrics", "duplicates", "envelope", "evolve", "ewma",
    "finished_runs", "gaps",
    "hold_paused", "inflight", "latest_by_key", "merge_cells", "metric_cells", "metrics_from_cells", "new_only", "non_monotonic", "null_keys",
    "numbered_messages", "oldest_pending", "partition_health", "partition_quotas", "pause_intervals", "prefix_value",
    "recent_errors", "rewritten_changes", "route_batch", "set_changes", "skipped_gaps", "stamp_sequence",
    "to_keyed_log", "unwrap_changes", "with_log_metadata", "with_retries", "with_retries_frame",
]

"""Step-by-step models, one message at a time, to compare the operators with."""

from __future__ import annotations


class Tracker:
    """Commit state of one partition, following marks in order of arrival."""

    def __init__(self, limit: int | None = None):
        self.seq, self.offset, self.pending, self.limit = -1, -1, {}, limit
        self.skipped: list[tuple[int, int]] = []
        self.overflow: list[int] = []

    def mark(self, seq: int, offset: int, at: int) -> None:
        if seq <= self.seq or offset <= self.offset or seq in self.pending:
            return
        self.pending[seq] = (offset, at)
        self.advance()

    def advance(self) -> None:
        while self.seq + 1 in self.pending:
            self.seq += 1
            self.offset = self.pending.pop(self.seq)[0]

    def tick(self, now: int, timeout: int) -> None:
        """Give up gaps while the oldest waiting mark is at least ``timeout`` old."""
        while self.pending and now - min(at for _, at in self.pending.values()) >= timeout:
            following = min(self.pending)
            self.skipped.append((self.seq + 1, following - 1))
            self.seq = following - 1
            self.advance()


def clamped(steps: list[int]) -> int:
    """Counter that errors raise and deliveries lower, not below 0."""
    count = 0
    for step in steps:
        count = max(0, count + step)
    return count


def moving_average(values: list[float], alpha: float = 0.2) -> float:
    mean = 0.0
    for value in values:
        mean = mean * (1 - alpha) + value * alpha
    return mean


def retry(failures: int, max_retries: int = 5) -> tuple[int, int, str]:
    """(attempts, seconds waited, outcome) of a message that fails so many times."""
    if failures == 0:
        return 1, 0, "ok"
    waited, delay, attempts = 0, 1, 1
    for _ in range(max_retries):
        attempts += 1
        if attempts > failures:
            return attempts, waited, "ok"
        waited += delay
        delay *= 2
    return attempts, waited, "dlq"


def merge(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for start, end in sorted(intervals):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [tuple(m) for m in merged]

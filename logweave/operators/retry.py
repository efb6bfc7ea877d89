"""Retries with back-off, and the partition pauses they cause."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from logweave.operators.scan import block_of, running_max
from logweave.session import materialize, small_side

MAX_RETRIES = 5
FIRST_DELAY_S = 1


def backoff_total(attempts: Column, outcome: Column, max_retries: int = MAX_RETRIES) -> Column:
    """Seconds waited in all. The first retry is immediate; each failed retry is followed by a wait
    that doubles, the last one included."""
    failed_retries = F.when(outcome == "ok", F.greatest(attempts - 2, F.lit(0))).otherwise(
        F.lit(max_retries)
    )
    return (F.pow(F.lit(2.0), failed_retries) - 1).cast("int") * FIRST_DELAY_S


def _outcome_columns(attempts: Column, error: Column, max_retries: int) -> dict[str, Column]:
    outcome = F.when(error.isNull(), "ok").otherwise("dlq")
    return {
        "attempts": attempts.cast("int"),
        "outcome": outcome,
        "delay_s": backoff_total(attempts, outcome, max_retries),
        "_error": error,
    }


def with_retries(
    df: DataFrame, error_at: Callable[[int], Column], max_retries: int = MAX_RETRIES
) -> DataFrame:
    """Outcome of processing each row with retries, when an attempt is a Column expression.

    ``error_at(n)`` is the error of attempt ``n`` (from 1), null on success; it is only evaluated
    while earlier attempts fail. Adds ``attempts``, ``outcome`` ('ok' or 'dlq'), ``delay_s`` and
    ``_error``. One pass, no shuffle; waits are recorded, never slept.
    """
    tries = max_retries + 1
    succeeded = F.coalesce(*[F.when(error_at(n).isNull(), F.lit(n)) for n in range(1, tries + 1)])
    found = df.withColumn("_ok_at", succeeded)
    attempts = F.coalesce("_ok_at", F.lit(tries))
    error = F.when(F.col("_ok_at").isNull(), error_at(tries))
    return found.withColumns(_outcome_columns(attempts, error, max_retries)).drop("_ok_at")


def with_retries_frame(
    df: DataFrame, process: Callable[[DataFrame, int], DataFrame], max_retries: int = MAX_RETRIES
) -> DataFrame:
    """The same for a processing step on DataFrames, for example one built on ``mapInPandas``.

    ``process(rows, attempt)`` keeps the input columns, may add results, and sets ``_error``. Only
    failed rows are tried again. Every pass is written before the next one, so an attempt is not
    repeated by later reads.
    """
    parts = []
    rows = df
    for attempt in range(1, max_retries + 2):
        result = materialize(process(rows, attempt), f"attempt-{attempt}")
        failed = result.filter(F.col("_error").isNotNull())
        last = attempt > max_retries or failed.isEmpty()
        part = result if last else result.filter(F.col("_error").isNull())
        parts.append(part.withColumns(_outcome_columns(F.lit(attempt), F.col("_error"), max_retries)))
        if last:
            break
        rows = failed.select(*df.columns)
    return reduce(DataFrame.unionByName, parts)


# Blocks and join buckets of 2 ** 26 microseconds, about 67 s. One row per start time is left before
# the scan, so with millisecond times a block holds at most as many thousand rows.
_PAUSE_BITS = 26


def pause_intervals(
    outcomes: DataFrame, by: list[str], at: str, delay_s: str = "delay_s", known: DataFrame | None = None
) -> DataFrame:
    """Times during which a partition takes no input: from a first failure until its retries end.

    Overlapping pauses of a partition are merged, also with ``known`` ones, which were found earlier.
    Columns ``by``, ``paused_at`` and ``resumed_at``.
    """
    start = F.unix_micros(F.col(at))
    end = start + F.col(delay_s).cast("bigint") * 1_000_000
    pauses = outcomes.filter(F.col(delay_s) > 0).select(*by, start.alias("_s"), end.alias("_e"))
    if known is not None:
        pauses = pauses.unionByName(
            known.select(*by, F.unix_micros("paused_at").alias("_s"), F.unix_micros("resumed_at").alias("_e"))
        )
    pauses = pauses.groupBy(*by, "_s").agg(F.max("_e").alias("_e"))
    reach = running_max(pauses, by, "_s", F.col("_e"), "_reach", _PAUSE_BITS, inclusive=False)
    opens = F.when(F.col("_reach").isNull() | (F.col("_s") > F.col("_reach")), F.col("_s"))
    merged = running_max(reach, by, "_s", opens, "_open", _PAUSE_BITS)
    return (
        merged.groupBy(*by, "_open")
        .agg(F.max("_e").alias("_e"))
        .select(
            *by, F.timestamp_micros("_open").alias("paused_at"), F.timestamp_micros("_e").alias("resumed_at")
        )
    )


def hold_paused(rows: DataFrame, intervals: DataFrame, by: list[str], at: str) -> DataFrame:
    """Add ``held_until`` to rows that arrive while their partition is paused (null for the others).

    The message that starts a pause is not held by it. Time is cut into buckets and the join is on
    partition and bucket, so a busy partition spreads over its buckets.
    """
    s, e = F.unix_micros("paused_at"), F.unix_micros("resumed_at")
    pauses = intervals.select(
        *by, s.alias("_s"), e.alias("_e"),
        F.explode(F.sequence(block_of(s, _PAUSE_BITS), block_of(e - 1, _PAUSE_BITS))).alias("_bucket"),
    )
    arrival = F.unix_micros(F.col(at))
    timed = rows.withColumns({"_t": arrival, "_bucket": block_of(arrival, _PAUSE_BITS)})
    pauses = small_side(pauses)
    same = (timed["_bucket"] == pauses["_bucket"]) & (timed["_t"] > pauses["_s"]) & (timed["_t"] < pauses["_e"])
    for c in by:
        same = same & (timed[c] == pauses[c])
    return timed.join(pauses, same, "left").select(
        *[timed[c] for c in rows.columns], F.timestamp_micros(pauses["_e"]).alias("held_until")
    )

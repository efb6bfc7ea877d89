"""Sending a batch to healthy partitions, with further attempts for what fails."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from logweave.functions.errors import is_retryable, needs_cooldown
from logweave.operators.health import COOLDOWN_MS, with_choice
from logweave.session import materialize, small_side

MAX_ATTEMPTS = 10
# The topic is missing; it is created and the message sent again.
MISSING_TOPIC_CODES = ["Local_UnknownTopic", "UnknownTopicOrPart"]

ErrorAt = Callable[[int, Column], Column]


def goes_on(code: Column, fatal: Column) -> Column:
    """Whether an attempt with this error leads to another one."""
    missing_topic = F.coalesce(code.isin(MISSING_TOPIC_CODES), F.lit(False))
    return missing_topic | is_retryable(code, fatal)


def route_batch(
    df: DataFrame,
    health: DataFrame,
    error_at: ErrorAt,
    now_ms: int,
    partitions: int,
    by: list[str] | None = None,
    max_attempts: int = MAX_ATTEMPTS,
    cooldown_ms: int = COOLDOWN_MS,
    fatal: Callable[[Column], Column] = lambda code: F.lit(False),
) -> DataFrame:
    """Partition, attempts and outcome of every row of a batch.

    ``health`` comes from ``partition_health``, one row per partition (and per ``by`` group, such as
    a topic); partitions and groups without a row have nothing against them. ``error_at(attempt, partition)`` is the error code of an attempt, null when it is
    delivered. All rows of an attempt go to the best partition of their group. The errors of the
    attempt then count against it, and a partition-level error takes it out of the choice, except
    after the last attempt. Rows end ``delivered``, ``exhausted`` or ``rejected`` (an error not
    worth retrying); the last two are dead letters.

    An attempt is written once, and the next one reads only the rows that failed in it. Between
    attempts only counts per partition leave the executors.
    """
    by = by or []
    kept = [c for c in df.columns if c != "partition"]
    state = small_side(with_choice(health, by, partitions, now_ms, "_chosen"))
    rows, parts = df, []
    for attempt in range(1, max_attempts + 1):
        tried = _send_to(rows, state, by).withColumn("_code", error_at(attempt, F.col("_chosen")))
        tried = materialize(tried, f"attempt-{attempt}")
        again = goes_on(F.col("_code"), fatal(F.col("_code")))
        failing = tried.filter(again)
        counts = None
        if attempt < max_attempts:
            counts = small_side(
                failing.groupBy(*by, F.col("_chosen").alias("partition")).agg(
                    F.count_if(~F.col("_code").isin(MISSING_TOPIC_CODES)).alias("_errors"),
                    F.max(needs_cooldown(F.col("_code"))).alias("_cool"),
                )
            )
        last = counts is None or counts.isEmpty()
        outcome = (
            F.when(F.col("_code").isNull(), "delivered").when(again, "exhausted").otherwise("rejected")
        )
        parts.append(
            (tried if last else tried.filter(~again)).select(
                *kept, F.col("_chosen").alias("partition"), F.lit(attempt).alias("attempts"),
                outcome.alias("outcome"), F.col("_code").alias("error_code"),
            )
        )
        if last:
            break
        after = _after_errors(state, counts, by, now_ms, cooldown_ms)
        state = small_side(with_choice(after, by, partitions, now_ms, "_chosen"))
        rows = failing.select(*df.columns)
    return reduce(DataFrame.unionByName, parts)


def _send_to(rows: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """Rows with the partition chosen for their group; without groups there is one choice.

    A group that nothing is known of starts with partition 0.
    """
    if not by:
        first = state.first()
        return rows.withColumn("_chosen", F.lit(first["_chosen"] if first else 0))
    choice = state.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_chosen").alias("_best")).distinct()
    joined = rows.join(choice, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by], "left")
    return joined.select(*rows.columns, F.coalesce("_best", F.lit(0)).alias("_chosen"))


def _after_errors(
    state: DataFrame, counts: DataFrame, by: list[str], now_ms: int, cooldown_ms: int
) -> DataFrame:
    hit, cool = F.coalesce("_errors", F.lit(0)) > 0, F.coalesce("_cool", F.lit(False))
    until = F.when(cool, F.lit(now_ms + cooldown_ms)).otherwise(F.coalesce("unavailable_until_ms", F.lit(0)))
    keys = [*by, "partition"]
    found = state.alias("s").join(counts.alias("c"), [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys], "full")
    return found.select(
        *[F.coalesce(f"s.{k}", f"c.{k}").alias(k) for k in keys],
        F.coalesce("inflight", F.lit(0)).alias("inflight"),
        (F.coalesce("recent_errors", F.lit(0)) + F.coalesce("_errors", F.lit(0))).alias("recent_errors"),
        F.coalesce("avg_latency_ms", F.lit(0.0)).alias("avg_latency_ms"),
        F.when(hit, F.lit(now_ms)).otherwise(F.col("last_error_ms")).alias("last_error_ms"),
        until.alias("unavailable_until_ms"),
        (F.lit(now_ms) > until).alias("available"),
    )

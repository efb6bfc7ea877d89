"""Health of partitions, from a log of delivery attempts.

An attempt row says ``produce``, ``delivery`` (with a latency) or ``error`` (with a code). Averages
and the error counter depend on the order of attempts. Both are summarised per block of attempts in
a form that can be joined to the summary before it, so a busy partition is scanned by many tasks,
and a stream keeps the blocks and makes those anew that a batch adds to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logweave.functions.errors import needs_cooldown
from logweave.functions.score import partition_score
from logweave.operators.scan import BLOCK_BITS, block_of
from logweave.session import small_side

# Weight of the newest latency, cooldown length.
ALPHA = 0.2
COOLDOWN_MS = 5_000


def health_summary(
    attempts: DataFrame,
    by: list[str] | None = None,
    alpha: float = ALPHA,
    leak: bool = False,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Mergeable summary per group. Attempt numbers count up; a block spans ``2 ** bits`` of them.

    ``deliveries`` and ``latency``: count, and moving average as if it had started at 0.
    ``step_total`` and ``step_low``: sum of +1 per error and -1 per delivery, and its lowest running
    value. ``inflight``: change in open attempts; with ``leak`` errors do not close one. Times of the
    last error and of the last error that calls for a cooldown.
    """
    by = by or ["partition"]
    opened = attempts.filter(F.col("kind") == "produce").groupBy(*by).agg(F.count("*").alias("opened"))
    return _settled(opened, block_summaries(attempts, by, alpha, leak, bits), by, alpha)


def block_summaries(
    attempts: DataFrame, by: list[str], alpha: float = ALPHA, leak: bool = False, bits: int = BLOCK_BITS
) -> DataFrame:
    """One row per group and block of attempts with outcomes (``block``), each whatever the other blocks hold.

    ``fold_blocks`` joins them in the order of blocks, however they came about.
    """
    delivered, failed = F.col("kind") == "delivery", F.col("kind") == "error"
    closes = delivered if leak else delivered | failed
    # only outcomes have an order to keep; they go through the shuffle as small numbers, without texts
    rows = attempts.filter(delivered | failed).select(
        *by, "attempt_no", block_of("attempt_no", bits).alias("block"),
        F.when(failed, 1).otherwise(-1).alias("_step"),
        F.when(closes, 1).otherwise(0).alias("_closed"),
        F.when(delivered, 1).otherwise(0).alias("_one"),
        F.when(delivered, F.col("latency_ms")).alias("_latency"),
        F.when(failed, F.col("at_ms")).alias("_error"),
        F.when(failed & needs_cooldown(F.col("error_code")), F.col("at_ms")).alias("_cool"),
    )
    whole = Window.partitionBy(*by, "block")
    so_far = whole.orderBy("attempt_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    walked = rows.withColumns(
        {
            "_walk": F.sum("_step").over(so_far),
            "_nth": F.sum("_one").over(so_far),
            "_count": F.sum("_one").over(whole),
        }
    )
    weight = alpha * F.pow(F.lit(1.0 - alpha), F.col("_count") - F.col("_nth"))
    return walked.groupBy(*by, "block").agg(
        F.sum("_one").alias("n"),
        F.sum(F.col("_latency") * weight).alias("v"),
        F.sum("_step").alias("total"),
        F.min("_walk").alias("low"),
        F.sum("_closed").alias("closed"),
        F.max("_error").alias("err"),
        F.max("_cool").alias("cool"),
    )


def fold_blocks(opened: DataFrame, blocks: DataFrame, by: list[str], alpha: float = ALPHA) -> DataFrame:
    """Summary as ``health_summary`` gives it, from counts of opened attempts (``opened``, added up here) and
    ``block_summaries``."""
    return _settled(opened.groupBy(*by).agg(F.sum("opened").alias("opened")), blocks, by, alpha)


def _settled(opened: DataFrame, blocks: DataFrame, by: list[str], alpha: float) -> DataFrame:
    ordered = Window.partitionBy(*by).orderBy("block")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    after = ordered.rowsBetween(1, Window.unboundedFollowing)
    placed = blocks.withColumns(
        {
            "_base": F.coalesce(F.sum("total").over(before), F.lit(0)),
            "_later": F.coalesce(F.sum("n").over(after), F.lit(0)),
        }
    )
    settled = placed.groupBy(*by).agg(
        F.sum("n").alias("deliveries"),
        F.sum(F.col("v") * F.pow(F.lit(1.0 - alpha), F.col("_later"))).alias("latency"),
        F.sum("total").alias("step_total"),
        F.least(F.min(F.col("_base") + F.col("low")), F.lit(0)).alias("step_low"),
        F.sum("closed").alias("closed"),
        F.max("err").alias("last_error_ms"),
        F.max("cool").alias("cooldown_error_ms"),
    )
    zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("deliveries", "step_total", "step_low")}
    return _both(opened, settled, by).select(
        *by,
        zero["deliveries"],
        F.coalesce("latency", F.lit(0.0)).alias("latency"),
        zero["step_total"],
        zero["step_low"],
        (F.coalesce("opened", F.lit(0)) - F.coalesce("closed", F.lit(0))).alias("inflight"),
        "last_error_ms",
        "cooldown_error_ms",
    )


def _both(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """Rows of either side, matched on groups that may be null."""
    joined = a.alias("a").join(b.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by], "full")
    return joined.select(
        *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in by],
        *[F.col(f"a.{c}") for c in a.columns if c not in by],
        *[F.col(f"b.{c}") for c in b.columns if c not in by],
    )


def health_from_summary(
    summary: DataFrame, by: list[str], as_of_ms: Column | int, cooldown_ms: int = COOLDOWN_MS
) -> DataFrame:
    """Health columns of a summary as seen at ``as_of_ms``."""
    now = F.lit(as_of_ms) if isinstance(as_of_ms, int) else as_of_ms
    until = F.coalesce(F.col("cooldown_error_ms") + cooldown_ms, F.lit(0).cast("bigint"))
    return summary.select(
        *by,
        "inflight",
        # a counter that never goes below 0: the walk, lifted by its lowest point
        (F.col("step_total") - F.col("step_low")).alias("recent_errors"),
        F.col("latency").alias("avg_latency_ms"),
        "last_error_ms",
        until.alias("unavailable_until_ms"),
        (now > until).alias("available"),
    )


def partition_health(
    attempts: DataFrame,
    as_of_ms: Column | int,
    by: list[str] | None = None,
    cooldown_ms: int = COOLDOWN_MS,
    leak: bool = False,
) -> DataFrame:
    """In-flight count, clamped error count, average latency, last error and availability per group."""
    by = by or ["partition"]
    return health_from_summary(health_summary(attempts, by, leak=leak), by, as_of_ms, cooldown_ms)


def ewma(
    df: DataFrame, by: list[str], order: str, value: str, alpha: float = ALPHA, bits: int = BLOCK_BITS
) -> DataFrame:
    """Final ``avg = avg * (1 - alpha) + value * alpha`` in ``order`` from 0, per group, as ``ewma``.

    ``order`` is a whole number, unique within a group; where it is not dense, ``scan.block_bits``
    says how wide blocks should be. No value is left out.
    """
    shaped = df.select(
        *by,
        F.lit("delivery").alias("kind"),
        F.col(order).alias("attempt_no"),
        F.col(value).alias("latency_ms"),
        F.lit(None).cast("string").alias("error_code"),
        F.lit(None).cast("bigint").alias("at_ms"),
    )
    return health_summary(shaped, by, alpha, bits=bits).select(*by, F.col("latency").alias("ewma"))


def inflight(attempts: DataFrame, by: list[str] | None = None, leak: bool = False) -> DataFrame:
    """Open attempts per group; order does not matter, so this is one partial aggregate."""
    closing = ["delivery"] if leak else ["delivery", "error"]
    change = F.when(F.col("kind") == "produce", 1).when(F.col("kind").isin(closing), -1).otherwise(0)
    return attempts.groupBy(*(by or ["partition"])).agg(F.sum(change).alias("inflight"))


def recent_errors(attempts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Errors not yet worked off by deliveries, per group."""
    by = by or ["partition"]
    counted = health_summary(attempts.filter(F.col("kind") != "produce"), by)
    return counted.select(*by, (F.col("step_total") - F.col("step_low")).alias("recent_errors"))


def fallback_partition(key: Column, partitions: int) -> Column:
    """Partition for a key when none is available: a hash, so that a rerun agrees."""
    number = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10)
    return (number.cast("bigint") % F.lit(partitions)).cast("int")


def _best(partition_options: Column, key: Column, partitions: int) -> Column:
    """Partition of the best option, else the fallback."""
    return F.coalesce(partition_options["partition"], fallback_partition(key, partitions))


def _option(now_ms: Column | int) -> Column:
    """Score and id of an available partition; the least option is the best choice."""
    option = F.struct(partition_score(now_ms).cast("double").alias("score"), F.col("partition").cast("int").alias("partition"))
    return F.when(F.col("available"), option)


def _untried(seen: Column, partitions: int) -> Column:
    """Option of the first partition that has no health row: nothing speaks against it."""
    first = F.array_min(F.array_except(F.sequence(F.lit(0), F.lit(partitions - 1)), seen.cast("array<int>")))
    return F.when(first.isNotNull(), F.struct(F.lit(0.0).alias("score"), first.alias("partition")))


def _group_key(by: list[str]) -> Column:
    return F.concat_ws("/", *by) if by else F.lit("")


def choose_partition(
    health: DataFrame, by: list[str], partitions: int, now_ms: Column | int, key: Column | None = None
) -> DataFrame:
    """Available partition with the lowest score per group, the lowest id on a tie.

    The partitions from 0 to ``partitions`` - 1 that have no health row are available, with score 0.
    Adds ``chosen`` and ``score``; without an available partition, a hash of ``key`` (by default of
    the group) chooses and the score is null.
    """
    tried = health.groupBy(*by).agg(F.min(_option(now_ms)).alias("_tried"), F.collect_set("partition").alias("_seen"))
    best = tried.withColumn("_best", F.least("_tried", _untried(F.col("_seen"), partitions)))
    key = _group_key(by) if key is None else key
    return best.select(
        *by, _best(F.col("_best"), key, partitions).alias("chosen"), F.col("_best.score").alias("score")
    )


def with_choice(health: DataFrame, by: list[str], partitions: int, now_ms: int, into: str) -> DataFrame:
    """Health rows, each with the partition chosen for its group as by ``choose_partition``; a group
    is a handful of rows."""
    group = Window.partitionBy(*by)
    untried = _untried(F.collect_set("partition").over(group), partitions)
    best = F.least(F.min(_option(now_ms)).over(group), untried)
    return health.withColumn(into, _best(best, _group_key(by), partitions))


# Scores are compared in millionths, so that quotas are exact whole-number arithmetic.
_UNIT = 1_000_000
# Rows of one group that one task numbers.
QUOTA_ROWS = 1 << 16


def partition_quotas(
    health: DataFrame, counts: DataFrame, by: list[str], partitions: int, now_ms: Column | int
) -> DataFrame:
    """How many of a group's ``n`` rows (in ``counts``) each available partition takes, as ``quota``.

    The same as if every row went to the partition with the lowest score, the lowest id on a tie, and
    raised that score by one. That takes the ``n`` smallest of all numbers score, score + 1, score + 2 and so on; up to one less
    than the level to which ``n`` fills the partitions in order of score they are counted by a division, and
    the rest, at most one for each partition, goes by rank. A group's partitions are ordered, not its rows.

    The partitions from 0 to ``partitions`` - 1 that have no health row are available, with score 0. A
    group without an available partition has no quotas.
    """
    every = counts.withColumn("partition", F.explode(F.sequence(F.lit(0), F.lit(partitions - 1))))
    seen = health.select(
        *by, F.col("partition").cast("int").alias("partition"), "available",
        F.round(partition_score(now_ms).cast("double") * _UNIT).cast("bigint").alias("score"),
    )
    same = [every[c].eqNullSafe(seen[c]) for c in [*by, "partition"]]
    tried = every.join(seen, same, "left").select(
        *[every[c] for c in [*by, "partition", "n"]],
        F.coalesce(seen["available"], F.lit(True)).alias("available"),
        F.coalesce(seen["score"], F.lit(0)).alias("s"),
    ).filter("available")
    group = Window.partitionBy(*by)
    by_score = group.orderBy("s", "partition").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    water = F.col("n") * _UNIT
    # the partitions that the water reaches, and the level it has there
    placed = tried.withColumns({"k": F.count(F.lit(1)).over(by_score), "below": F.sum("s").over(by_score)})
    reached = F.when(F.col("k") * F.col("s") - F.col("below") <= water, F.struct("k", "below"))
    placed = placed.withColumn("last", F.max(reached).over(group))
    level = F.expr(f"(n * {_UNIT} + last.below) div last.k - {_UNIT}")
    sure = F.greatest(F.expr(f"(level - s + {_UNIT} - 1) div {_UNIT}"), F.lit(0))
    counted = placed.withColumn("level", level).withColumn(
        "sure", F.when(F.col("level") > F.col("s"), sure).otherwise(F.lit(0)).cast("bigint")
    )
    by_next = group.orderBy(F.col("s") + F.col("sure") * _UNIT, "partition")
    rest = F.col("n") - F.sum("sure").over(group)
    quota = F.col("sure") + (F.row_number().over(by_next) <= rest).cast("bigint")
    return counted.select(*by, "partition", quota.alias("quota"))


def assign_by_quota(
    rows: DataFrame, health: DataFrame, by: list[str], key: str, partitions: int, now_ms: Column | int
) -> DataFrame:
    """Rows with a ``partition`` each, as many for every partition of a group as ``partition_quotas`` says.

    Rows of a group are numbered in slices by a hash of ``key``, with the counts of earlier slices added, so a group with
    most rows is spread; equal input has equal results if ``key`` is unique within a group. Without an available partition a hash of
    the key decides. A column ``partition`` of ``rows`` is replaced.
    """
    rest = [c for c in rows.columns if c != "partition"]
    most = rows.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    sliced = rows.select(*rest).withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(max(1, -(-most // QUOTA_ROWS)))))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = small_side(
        sliced.groupBy(*by, "_slice").agg(F.count(F.lit(1)).alias("m"))
        .withColumn("_start", F.coalesce(F.sum("m").over(before), F.lit(0)))
    )
    counts = sizes.groupBy(*by).agg(F.sum("m").alias("n"))
    quotas = partition_quotas(health, counts, by, partitions, now_ms)
    through = Window.partitionBy(*by).orderBy("partition").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = quotas.withColumn("end", F.sum("quota").over(through)).groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("end", "partition"))).alias("_ends")
    )
    starts = sizes.alias("s").join(
        ends.alias("e"), [F.col(f"s.{c}").eqNullSafe(F.col(f"e.{c}")) for c in by], "left"
    ).select(*[F.col(f"s.{c}").alias(c) for c in by], "_slice", "_start", "_ends")
    in_slice = F.row_number().over(Window.partitionBy(*by, "_slice").orderBy(key))
    numbered = sliced.withColumn("_nth", in_slice)
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in [*by, "_slice"]]
    placed = numbered.alias("r").join(starts.alias("t"), same, "left")
    at = F.col("_start") + F.col("_nth")
    own = F.element_at(F.filter("_ends", lambda x: x["end"] >= at), 1)["partition"]
    return placed.select(
        *[F.col(f"r.{c}") for c in rest], F.coalesce(own, fallback_partition(F.col(f"r.{key}"), partitions)).alias("partition")
    )

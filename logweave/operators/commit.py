"""Safe commit positions when messages finish out of order.

A *mark* says that the message with sequence number ``seq`` (dense from 0 within a topic-partition)
at log position ``offset`` finished at ``processed_at``. A commit position is the next offset to
read. Everything here derives from the list of gaps between finished sequence numbers.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from logweave.operators.scan import BLOCK_BITS, block_of, running_max
from logweave.schemas import PARTITION_KEYS
from logweave.session import small_side

# Sequence numbers travel as words, one bit for each of 64 consecutive numbers. Words are linked to their
# neighbours in groups of 2 ** SEQ_BITS words, which bounds what one task orders.
WORD_BITS = 6
SEQ_BITS = 14


def _instant(at: Column | datetime) -> Column:
    return at if isinstance(at, Column) else F.lit(at)


def clean_marks(marks: DataFrame, committed: DataFrame | None = None) -> DataFrame:
    """One mark per sequence number, the earliest; marks at or below the committed state are dropped.

    ``committed`` has one row per topic-partition: ``committed_seq`` and ``committed_offset``.
    """
    fresh = beyond_committed(marks, committed)
    rest = [c for c in marks.columns if c not in (*PARTITION_KEYS, "seq")]
    return (
        fresh.groupBy(*PARTITION_KEYS, "seq")
        .agg(F.min_by(F.struct(*rest), F.struct("processed_at", "offset")).alias("_mark"))
        .select(*[F.col(c) if c not in rest else F.col(f"_mark.`{c}`").alias(c) for c in marks.columns])
    )


def beyond_committed(marks: DataFrame, committed: DataFrame | None = None) -> DataFrame:
    """Marks whose number and offset are above the committed ones, if any; numbers below 0 are none."""
    fresh = marks.filter(F.col("seq") >= 0)
    if committed is None:
        return fresh
    done = small_side(committed.select(*PARTITION_KEYS, "committed_seq", "committed_offset"))
    return (
        fresh.join(done, PARTITION_KEYS, "left")
        .filter(F.col("seq") > F.coalesce("committed_seq", F.lit(-1)))
        .filter(F.col("offset") > F.coalesce("committed_offset", F.lit(-1)))
        .select(*marks.columns)
    )


RUN_COLUMNS = ["first_seq", "last_seq", "top_offset", "oldest_at"]


def finished_runs(marks: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Unbroken runs of finished numbers, each as long as possible, per topic-partition.

    Columns ``first_seq, last_seq``, the highest offset in a run (``top_offset``), its earliest time
    (``oldest_at``), and where the run before it ends (``before_seq``, null for the first). ``known`` are runs found
    earlier; marks may repeat their numbers, extend them or close the gaps between them.

    Marks are reduced to one per number and then, in blocks of numbers, to runs; only runs, which may be few, are
    ordered within a partition, and that in blocks as well.
    """
    each = marks.filter(F.col("seq") >= 0).groupBy(*PARTITION_KEYS, "seq").agg(
        F.max("offset").alias("offset"), F.min("processed_at").alias("at")
    )
    blocked = each.withColumn("_block", block_of("seq", BLOCK_BITS))
    nth = F.row_number().over(Window.partitionBy(*PARTITION_KEYS, "_block").orderBy("seq"))
    pieces = (
        blocked.withColumn("_run", F.col("seq") - nth)
        .groupBy(*PARTITION_KEYS, "_block", "_run")
        .agg(
            F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
            F.max("offset").alias("top_offset"), F.min("at").alias("oldest_at"),
        )
        .select(*PARTITION_KEYS, *RUN_COLUMNS)
    )
    if known is not None:
        pieces = pieces.unionByName(known.select(*PARTITION_KEYS, *RUN_COLUMNS))
    joined = [F.max("last_seq").alias("last_seq"), F.max("top_offset").alias("top_offset"), F.min("oldest_at").alias("oldest_at")]
    starts = pieces.groupBy(*PARTITION_KEYS, "first_seq").agg(*joined)
    reach = running_max(starts, PARTITION_KEYS, "first_seq", F.col("last_seq"), "before_seq", BLOCK_BITS, inclusive=False)
    opens = F.when(F.col("before_seq").isNull() | (F.col("first_seq") > F.col("before_seq") + 1), F.col("first_seq"))
    opened = running_max(reach, PARTITION_KEYS, "first_seq", opens, "_open", BLOCK_BITS)
    return (
        opened.groupBy(*PARTITION_KEYS, "_open")
        .agg(*joined, F.min_by("before_seq", "first_seq").alias("before_seq"))
        .select(*PARTITION_KEYS, F.col("_open").alias("first_seq"), *RUN_COLUMNS[1:], "before_seq")
    )


def non_monotonic(marks: DataFrame) -> DataFrame:
    """Marks whose offset does not exceed that of every smaller sequence number; no valid order exists."""
    before = running_max(
        clean_marks(marks), PARTITION_KEYS, "seq", F.col("offset"), "_before", inclusive=False
    )
    return (
        before.filter(F.col("offset") <= F.col("_before"))
        .drop("_before")
        .withColumn("_error", F.lit("non_monotonic"))
    )


def gaps(marks: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """Runs of sequence numbers that never finished, below the highest finished one.

    Columns ``topic, partition, gap_start, gap_end``. ``start`` gives ``committed_seq`` per
    topic-partition; counting begins after it, at 0 where it is absent. Repeated marks do no harm:
    every task reduces its rows to words of bits before the shuffle, by a hash aggregate.

    Gaps are found inside words, then between the words of a group, then between groups; only the
    last step, on one row per 2 ** 20 numbers, orders a whole partition.
    """
    first = F.shiftleft("block", WORD_BITS)
    places = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("bits", i) == 1)
    full, seqs = F.col("bits") == -1, F.col("seqs")
    size = F.size(seqs)
    inside = F.zip_with(
        F.slice(seqs, 1, size - 1), F.slice(seqs, 2, size - 1), lambda a, b: _between(a, b)
    )
    words = (
        marks.filter(F.col("seq") >= 0)
        .groupBy(*PARTITION_KEYS, block_of("seq", WORD_BITS).alias("block"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(seq & 63 AS INT)))").alias("bits"))
    )
    # only words that lack a number are taken apart
    blocks = words.withColumn(
        "seqs", F.when(~full, F.transform(places, lambda i: F.shiftleft("block", WORD_BITS) + i))
    ).select(
        *PARTITION_KEYS, "block", block_of("block", SEQ_BITS).alias("group"),
        F.coalesce(F.element_at("seqs", 1), first).alias("low"),
        F.coalesce(F.element_at("seqs", -1), first + 63).alias("high"),
        F.coalesce(F.filter(inside, lambda gap: gap["gap_start"] <= gap["gap_end"]), F.array()).alias("inside"),
    )
    in_group = Window.partitionBy(*PARTITION_KEYS, "group").orderBy("block")
    in_partition = Window.partitionBy(*PARTITION_KEYS).orderBy("group")
    linked = blocks.withColumn("before", F.lag("high").over(in_group))
    edge = F.when(F.col("before").isNotNull(), F.array(_between(F.col("before"), F.col("low"))))
    within = linked.select(
        *PARTITION_KEYS, F.explode(F.concat(F.coalesce(edge, F.array()), "inside")).alias("gap")
    ).select(*PARTITION_KEYS, "gap.gap_start", "gap.gap_end")
    groups = (
        blocks.groupBy(*PARTITION_KEYS, "group")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .withColumn("before", F.lag("high").over(in_partition))
    )
    floor = F.lit(-1).cast("bigint")
    if start is not None:
        groups = groups.join(
            small_side(start.select(*PARTITION_KEYS, "committed_seq")), PARTITION_KEYS, "left"
        )
        floor = F.coalesce("committed_seq", floor)
    gap = _between(F.coalesce("before", floor), F.col("low"))
    between = groups.select(*PARTITION_KEYS, gap.alias("gap")).select(
        *PARTITION_KEYS, "gap.gap_start", "gap.gap_end"
    )
    return within.unionByName(between).filter(F.col("gap_start") <= F.col("gap_end"))


def _between(before: Column, after: Column) -> Column:
    """Numbers strictly between two; the start exceeds the end when there are none."""
    return F.struct((before + 1).alias("gap_start"), (after - 1).alias("gap_end"))


def _facts(marks: DataFrame, start: DataFrame | None, cutoff: Column | datetime | None) -> DataFrame:
    """One row per topic-partition: the highest number (``high``), and the number up to which gaps are
    given up (``anchor``)."""
    facts = [F.max("seq").alias("high")]
    if cutoff is not None:
        old = F.col("processed_at") <= _instant(cutoff)
        facts.append(F.max(F.when(old, F.col("seq"))).alias("highest_old"))
    rows = marks.filter(F.col("seq") >= 0).groupBy(*PARTITION_KEYS).agg(*facts)
    floor = F.lit(-1).cast("bigint")
    if start is not None:
        rows = rows.join(start.select(*PARTITION_KEYS, "committed_seq"), PARTITION_KEYS, "left")
        floor = F.coalesce("committed_seq", floor)
    anchor = floor if cutoff is None else F.greatest(F.col("highest_old"), floor)
    return rows.select(*PARTITION_KEYS, "high", anchor.alias("anchor"))


def commit_ends(
    marks: DataFrame,
    start: DataFrame | None = None,
    cutoff: Column | datetime | None = None,
    found: DataFrame | None = None,
) -> DataFrame:
    """Last sequence number that may be committed per topic-partition.

    Without ``cutoff`` it is the end of the unbroken run. With it, a gap is given up as soon as some
    finished mark beyond the gap is as old as the cutoff. Since that holds for every gap below the
    highest such mark and for none above, the end is the last number before the first gap beyond it.

    Columns ``committed_seq`` (the start's, or -1, when nothing can be committed), ``anchor`` (the
    number up to which gaps are given up), ``skipped`` and ``pending`` as counts of numbers.
    ``found`` are the gaps, where the caller has them already.
    """
    facts = _facts(marks, start, cutoff)
    found, beyond = gaps(marks, start) if found is None else found, F.lit(True)
    if cutoff is not None:
        found, beyond = found.join(facts, PARTITION_KEYS), F.col("gap_start") > F.col("anchor")
    length = F.col("gap_end") - F.col("gap_start") + 1
    counts = found.groupBy(*PARTITION_KEYS).agg(
        F.min(F.when(beyond, F.col("gap_start"))).alias("first_gap"),
        F.sum(F.when(~beyond, length)).alias("skipped"),
        F.sum(F.when(beyond, length)).alias("open"),
    )
    end = F.coalesce(F.col("first_gap") - 1, F.col("high"))
    return facts.join(counts, PARTITION_KEYS, "left").select(
        *PARTITION_KEYS,
        end.alias("committed_seq"),
        "anchor",
        F.coalesce("skipped", F.lit(0)).alias("skipped"),
        (F.col("high") - end - F.coalesce("open", F.lit(0))).alias("pending"),
    )


def commit_positions(
    marks: DataFrame,
    mode: str = "max",
    as_of: Column | datetime | None = None,
    timeout: timedelta = timedelta(seconds=30),
) -> DataFrame:
    """Commit position per topic-partition.

    * ``max``: highest finished offset + 1, gaps or not.
    * ``contiguous``: past the unbroken run of sequence numbers from 0.
    * ``gap_timeout``: as seen at ``as_of``, gaps are given up once a mark beyond them is ``timeout`` old.

    The last two also give ``committed_seq``, ``skipped`` and ``pending``; their position is null
    where nothing may be committed. They rely on offsets that rise with sequence numbers;
    ``non_monotonic`` lists marks where they do not.
    """
    if mode == "max":
        return marks.groupBy(*PARTITION_KEYS).agg((F.max("offset") + 1).alias("position"))
    if mode not in ("contiguous", "gap_timeout"):
        raise ValueError(f"unknown mode {mode}")
    cutoff = None
    if mode == "gap_timeout":
        marks = marks.filter(F.col("processed_at") <= _instant(as_of))
        cutoff = _instant(as_of) - F.lit(timeout)
    ends = small_side(commit_ends(marks, cutoff=cutoff).drop("anchor"))
    return ends.join(end_offsets(marks, ends), PARTITION_KEYS, "left").select(
        *PARTITION_KEYS, (F.col("committed_offset") + 1).alias("position"),
        "committed_seq", "skipped", "pending",
    )


def end_offsets(marks: DataFrame, ends: DataFrame) -> DataFrame:
    """Offset of the mark at ``committed_seq`` of each topic-partition, the earliest if repeated."""
    at_end = ends.select(*PARTITION_KEYS, F.col("committed_seq").alias("seq"))
    return (
        marks.join(at_end, [*PARTITION_KEYS, "seq"])
        .groupBy(*PARTITION_KEYS)
        .agg(F.min_by("offset", F.struct("processed_at", "offset")).alias("committed_offset"))
    )


def skipped_gaps(
    marks: DataFrame, as_of: Column | datetime, timeout: timedelta = timedelta(seconds=30)
) -> DataFrame:
    """Gaps given up by ``gap_timeout`` at ``as_of``, with ``missing``, the count of their numbers."""
    seen = marks.filter(F.col("processed_at") <= _instant(as_of))
    facts = _facts(seen, None, _instant(as_of) - F.lit(timeout))
    return (
        gaps(seen)
        .join(facts.select(*PARTITION_KEYS, "anchor"), PARTITION_KEYS)
        .filter(F.col("gap_start") <= F.col("anchor"))
        .select(
            *PARTITION_KEYS, "gap_start", "gap_end",
            (F.col("gap_end") - F.col("gap_start") + 1).alias("missing"),
        )
    )


def oldest_pending(marks: DataFrame) -> DataFrame:
    """Finished mark that has waited longest behind a gap, per topic-partition."""
    ends = small_side(commit_ends(marks).select(*PARTITION_KEYS, "committed_seq"))
    return (
        marks.join(ends, PARTITION_KEYS)
        .filter(F.col("seq") > F.col("committed_seq"))
        .groupBy(*PARTITION_KEYS)
        .agg(F.min(F.struct("processed_at", "seq", "offset")).alias("_mark"))
        .select(*PARTITION_KEYS, "_mark.seq", "_mark.offset", "_mark.processed_at")
    )

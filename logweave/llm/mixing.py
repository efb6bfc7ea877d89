"""Mixing sources to target weights by weighted fair queueing; DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.blocks import word_count
from logweave.session import kept_table, materialize

# rows of one source, or of one stretch of virtual time, that are put in order by one task
BLOCK_ROWS = 20_000


def source_targets(units: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """One row per source: ``source, source_size, weight, target``.

    Weights repeat over the sources in code point order, null last. A target is the source's share of
    all words by weight, but ``repeats`` times its own words at most; what that leaves is shared again
    by weight. With all sources in order of the level at which they are used up, the level that
    fills the budget follows from running sums. One row per source passes through one task.
    """
    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*map(F.lit, weights))[(F.row_number().over(by_name) - 1) % len(weights)].cast("long")
    cap = F.col("source_size") * repeats
    by_level = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    used = F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = (F.sum("source_size").over(everything) - used).cast("double") / F.sum("weight").over(after)
    ranked = sums.withColumn("weight", weight).withColumn("cap", cap).withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    target = F.least(F.col("weight") * F.max(fits).over(everything), F.col("cap").cast("double"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def shuffle_key(doc_id: Column, seed: str) -> Column:
    """Digest by which a source's documents are shuffled."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def mixing_units(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3, seed: str = "mix"
) -> DataFrame:
    """How often the mix takes each document.

    Rows with the same ``doc_id``, ``source`` and number of words are one unit of ``n`` rows, so repeated
    rows are taken equally often. Returns ``doc_id, source, size, n, key, source_size, target, takes``:
    whether each pass takes it.

    Each source's units are shuffled by a digest of seed and id. A pass over a source takes all its
    units in that order, and there are ``repeats`` passes. The virtual finish time of a unit in a pass
    is the number of its source's words up to its end, divided by the weight. Everything that finishes by the
    last time at which no more words than the corpus has are finished is taken. Running sums are
    taken in blocks, of a source's shuffled order and then of virtual time, so no task orders a whole source.

    Null texts, texts without words and null ids count as units without words, a null source is a source; without
    any words nothing is taken. Other columns are ignored.
    """
    spark = docs.sparkSession
    size = word_count(F.col("text"))
    key = shuffle_key(F.col("doc_id"), seed)
    units = materialize(
        docs.select("doc_id", "source", size.alias("size"))
        .groupBy("doc_id", "source", "size")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("key", key),
        "mixing-units",
    )
    sources = materialize(source_targets(units, weights, repeats), "mixing-sources")
    facts = sources.agg(F.sum("source_size").alias("budget"), F.max("source_size").alias("most")).first()
    budget, most, rows = facts["budget"] or 0, facts["most"] or 0, units.count()

    # where a unit ends in its source's shuffled order
    blocks = max(1, rows // BLOCK_ROWS)
    block = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * blocks / F.lit(1 << 32)
    placed = units.withColumn("block", F.floor(block))
    words = F.col("size") * F.col("n")
    in_source = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("source", "block").agg(F.sum(words).alias("words"))
        .select(F.col("source").alias("s"), F.col("block").alias("b"),
                F.coalesce(F.sum("words").over(in_source), F.lit(0)).alias("start"))
    )
    in_block = (
        Window.partitionBy("source", "block").orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ends = (
        placed.withColumn("within", F.sum(words).over(in_block))
        .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
        .withColumn("end", F.col("within") + F.col("start"))
        .drop("s", "b", "block", "within", "start")
    )
    named = sources.withColumnRenamed("source", "s")
    scale = math.lcm(*weights)
    queued = materialize(
        ends.join(named, F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("pace", F.floor(F.lit(scale) / F.col("weight"))),
        "mixing-queue",
    )

    # all passes in order of virtual time; the last time by which the budget isn't exceeded
    passes = queued.select(
        (F.col("size") * F.col("n")).alias("words"),
        F.explode(
            F.array(*[(F.col("source_size") * k + F.col("end")) * F.col("pace") for k in range(repeats)])
        ).alias("finish"),
    ).filter("words > 0")
    stretches = max(1, rows * repeats // BLOCK_ROWS)
    width = max(1, -(-most * repeats * scale // (min(weights) * stretches)))
    in_stretch = passes.withColumn("stretch", F.floor(F.col("finish") / width))
    along = Window.partitionBy(F.lit(0)).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        in_stretch.groupBy("stretch").agg(F.sum("words").alias("words"))
        .withColumn("before", F.coalesce(F.sum("words").over(along), F.lit(0)))
    )
    edge = sums.filter((F.col("before") <= budget) & (F.col("before") + F.col("words") > budget)).first()
    if edge is None:
        cut = None  # everything fits
    else:
        to_here = Window.partitionBy("stretch").orderBy("finish")
        at = (
            in_stretch.filter(F.col("stretch") == edge["stretch"])
            .withColumn("sum", F.sum("words").over(to_here) + edge["before"])
            .filter(F.col("sum") <= budget)
            .agg(F.max("finish"))
            .first()[0]
        )
        cut = edge["stretch"] * width - 1 if at is None else at
    last = F.lit(cut if cut is not None else (1 << 62))
    takes = F.array(*[(F.col("source_size") * k + F.col("end")) * F.col("pace") <= last for k in range(repeats)])
    return queued.select(
        "doc_id", "source", "size", "n", "key", "source_size", "target",
        F.transform(takes, lambda x: x & (F.col("size") > 0)).alias("takes"),
    )


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``; see ``mixing_units``."""
    units = mixing_units(docs.select("doc_id", "source", "text"), **options)
    rows = units.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n"))))
    copies = F.size(F.filter("takes", lambda x: x))
    return rows.select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), "source"
    )


def mix_documents(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3, seed: str = "mix", most_sources: int = 100_000
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, none or up to ``repeats`` times each.

    A pass takes the units of a source up to a place in its shuffled order, so a row is decided by its own place and
    its source's ``repeats`` last places. These are broadcast for up to ``most_sources`` sources; texts stay where
    they are. More sources are joined by a shuffle.
    """

    def last_places() -> DataFrame:
        units = mixing_units(docs.select("doc_id", "source", "text"), weights, repeats, seed)
        place = F.struct("key", "doc_id", "size")
        # a flag for the null source, which equals no other in a join
        return units.groupBy(F.coalesce("source", F.lit("")).alias("source"), F.col("source").isNull().alias("none")).agg(
            F.array(*[F.max(F.when(F.col("takes")[k], place)) for k in range(repeats)]).alias("last")
        )

    lasts = kept_table(docs.sparkSession, "mixing-places", last_places)
    if lasts.limit(most_sources + 1).count() <= most_sources:
        lasts = F.broadcast(lasts)
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.col("source").isNull().alias("none"),
        F.struct(
            shuffle_key(F.col("doc_id"), seed).alias("key"), F.col("doc_id"), word_count(F.col("text")).alias("size")
        ).alias("place"),
    )
    taken = F.filter("last", lambda x: x.isNotNull() & (F.col("place") <= x))
    copies = F.when(F.col("place.size") > 0, F.size(taken)).otherwise(0)
    repeated = rows.join(lasts, ["source", "none"]).select("row", copies.alias("copies")).filter("copies > 0")
    return repeated.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


# The same mix over the whole table, ordered at once.
MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), units AS (
    SELECT doc_id, source, size, count(*) AS n, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
    FROM sized GROUP BY ALL
), sums AS (
    SELECT source, CAST(sum(size * n) AS BIGINT) AS source_size FROM units GROUP BY source
), ranked AS (
    SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM sums
), levels AS (
    SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
               ORDER BY 3 * source_size / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
           / sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ranked
), sources AS (
    SELECT source, source_size, weight, least(
        weight * max(CASE WHEN level <= 3 * source_size / weight THEN level END) OVER (),
        CAST(3 * source_size AS DOUBLE)) AS target
    FROM levels
), queued AS (
    SELECT u.*, s.source_size, s.weight, s.target, sum(u.size * u.n) OVER (
        PARTITION BY u.source ORDER BY u.key, u.doc_id, u.size
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop
    FROM units u JOIN sources s ON u.source IS NOT DISTINCT FROM s.source
), passes AS (
    SELECT size * n AS words, (source_size * k + stop) * (6 // weight) AS finish
    FROM queued, range(3) AS r(k) WHERE size > 0
), reached AS (
    SELECT finish, sum(words) OVER (ORDER BY finish) AS total FROM passes
), cut AS (
    SELECT max(finish) AS last FROM reached WHERE total <= (SELECT sum(source_size) FROM sources)
)
SELECT doc_id, size, source_size, target, source, CAST(size * (
    SELECT count(*) FROM range(3) AS r(k) WHERE (q.source_size * k + q.stop) * (6 // q.weight) <= (SELECT last FROM cut)
) AS BIGINT) AS taken
FROM queued q, range(q.n) AS t(i)
"""

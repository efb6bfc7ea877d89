"""Exact top-k search by inner product, term at a time over blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# rows of one block of candidates, and of one block of queries; candidates below which a block is not divided further
CANDIDATES, QUERIES, FEWEST = 32_768, 2_048, 4_096
LONG = np.iinfo(np.int64)


def integer_terms(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component as a long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    """Whether a vector is there and has only finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def block_top(queries: list[np.ndarray], ids: np.ndarray, found: list[np.ndarray], own: np.ndarray, k: int):
    """The ``k`` best ids of a block for each query: arrays of query index, id, score.

    ``found`` are the rows of the block, in order of their ids ``own``; of rows that share an id the best counts. Postings
    are built per term; a query's terms scatter ``weight * posting`` into one dense array of scores. Scores are ordered
    together with the id's place, so that ties go to the smaller id. Where sums may leave 64 bits they are
    Python's integers, and the scores that come out are the nearest 64-bit numbers.
    """
    width = max([len(v) for v in found] + [len(v) for v in queries], default=0)
    table = np.zeros((len(found), width), np.int64)
    for row, v in enumerate(found):
        table[row, : len(v)] = v
    largest = np.abs(table.astype(float)).max(initial=0) * max((np.abs(v.astype(float)).sum() for v in queries), default=0)
    kind = np.int64 if largest * (len(found) + 1) < 2.0**62 else object
    table, queries = table.astype(kind, copy=False), [v.astype(kind, copy=False) for v in queries]
    own, first = np.unique(own, return_index=True)
    postings = []
    for term in range(width):
        rows = np.flatnonzero(table[:, term])
        postings.append((slice(None) if len(rows) == len(found) else rows, table[rows, term].copy()))
    back = np.arange(len(own) - 1, -1, -1).astype(kind)
    out = []
    for q, vector in enumerate(queries):
        scores = np.zeros(len(found), kind)
        for term in np.flatnonzero(vector):
            rows, weights = postings[term]
            scores[rows] += vector[term] * weights
        if len(own) < len(found):
            scores = np.maximum.reduceat(scores, first)
        ordered = scores * len(own) + back
        keep = np.flatnonzero(own != ids[q])
        if not len(keep):
            continue
        values = ordered[keep]
        best = np.argpartition(values, len(values) - k)[-k:] if len(values) > k else np.arange(len(values))
        rows = keep[best]
        out.append((np.full(len(rows), q), own[rows], np.clip(scores[rows], LONG.min, LONG.max).astype(np.int64)))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else None


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    candidates_per_block: int = CANDIDATES,
    queries_per_block: int = QUERIES,
) -> DataFrame:
    """The ``k`` rows with the largest integer inner product for every query row.

    Returns ``query_id, rank, vec_id, score``; ties go to the smaller id, a query is not its own
    candidate, and with fewer candidates all are returned. Rows with a null id, or a vector that is
    null or has null or non-finite components, take no part. Vectors of different lengths meet in the terms
    they share; an empty vector scores 0. An id is one query and one candidate: rows that repeat it with the
    same vector change nothing, and of different vectors the pair with the best score counts. Terms and scores beyond
    64 bits are the nearest 64-bit numbers, and scores that are equal then are ties.

    Candidates and queries are dealt into blocks of bounded size by a hash of the id, so rows of one id meet.
    Every pair of a query block and a candidate block is one group, whose best ``k`` per query meet in a second
    selection. Blocks of small tables are divided, down to ``FEWEST`` rows, until there is a group for every core.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"),
        integer_terms(F.col(vector_col)).alias("terms"),
        is_query.alias("q"),
    )
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("q"), 1)).alias("q")).first()
    query_blocks = max(1, -(-counts["q"] // queries_per_block))
    cores = spark.sparkContext.defaultParallelism
    blocks = max(1, -(-counts["n"] // candidates_per_block), min(counts["n"] // FEWEST, -(-cores // query_blocks)))
    # a stated number of partitions, as groups that are small to shuffle are still long to score
    tasks = min(blocks * query_blocks, max(4 * cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    own_query = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(query_blocks)).cast("int")
    sides = rows.withColumn("c", own).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    )
    asked = (
        rows.filter("q")
        .withColumn("b", own_query)
        .withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("id", kind="stable")
        found = [np.asarray(v, np.int64) for v in right["terms"]]
        wanted = [np.asarray(v, np.int64) for v in left["terms"]]
        ids, own_ids = left["id"].to_numpy(), right["id"].to_numpy()
        top = block_top(wanted, ids, found, own_ids, k) if len(left) and len(right) else None
        if top is None:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        out = pd.DataFrame({"query_id": ids[top[0]], "vec_id": top[1], "score": top[2]})
        if left["id"].is_unique:
            return out
        return out.groupby(["query_id", "vec_id"], as_index=False)["score"].max()

    each = (
        asked.repartition(tasks, "b", "c")
        .groupBy("b", "c")
        .cogroup(sides.repartition(tasks, "b", "c").groupBy("b", "c"))
        .applyInPandas(best, "query_id long, vec_id long, score long")
    )
    return top_ranks(each, k)


def top_ranks(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query's rows, largest score first, ties to the smaller id, with ranks from 1."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH rows AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS terms
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(
        CAST(q.terms AS DOUBLE[]), CAST(c.terms AS DOUBLE[])) AS BIGINT) AS score
    FROM rows q JOIN rows c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

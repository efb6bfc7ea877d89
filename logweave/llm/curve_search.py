"""Approximate nearest neighbours by several Hilbert orderings of projected vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.exact_topk import top_ranks, usable
from logweave.llm.hilbert import hilbert_index
from logweave.session import materialize

CURVES, DIMS, BITS = 16, 6, 4
# vectors that the grid of a curve is fitted on
SAMPLE = 10_000
# reach of a window to either side, as a share of all vectors; rows of a stretch at most; stretches whose queries go together
REACH, STRETCH, TOGETHER = 0.0375, 8_192, 8


def curves_of(sample: np.ndarray, dims: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Projection and grid lines of every curve. A curve has directions of its own and shifts its grid."""
    out = []
    for number in range(CURVES):
        random = np.random.default_rng(number)
        axes = np.linalg.qr(random.standard_normal((max(dims, DIMS), DIMS)))[0][:dims]
        shares = (np.arange(1, 1 << BITS) - random.random() / 2) / (1 << BITS)
        out.append((axes, np.quantile(sample @ axes, shares, axis=0)))
    return out


def window(total: int) -> tuple[int, int]:
    """Rows of a stretch, and how many stretches to either side of its own a query is compared with.

    At every size these ``2 * around + 1`` stretches hold ``REACH`` of the table to either side, and a bit more in small tables.
    """
    around = max(1, math.ceil(REACH * total / STRETCH - 0.5))
    return max(math.ceil(2 * REACH * total / (2 * around + 1)), min(STRETCH, 64)), around


def _matrix(values: list, dims: int) -> np.ndarray:
    out = np.zeros((len(values), dims))
    for row, value in enumerate(values):
        out[row, : len(value)] = value
    return out


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product found for every query row.

    Scores are sums of products in double precision, in order of the components; ties go to the smaller id, and a
    query is not its own candidate. Rows with a null id, or with a vector that is null, zero or has null or
    non-finite components, take no part; a shorter vector counts as ending in zeros. Rows that repeat an id and its
    vector count once; an id with different vectors is returned once, by the best of those found. With no more than
    ``k`` candidates all that the windows reach are returned, and in small tables they reach all.

    Equal vectors are one entry, which knows its ``k + 1`` smallest ids. Every curve projects the entries to a
    few dimensions of its own and numbers them along a Hilbert curve; a range sort gives their places. A query
    is compared with the stretches of places around its own, and what all curves find is merged and
    ranked. On vectors without structure a fixed recall needs windows that grow with the table, so
    ``REACH`` is a share of it.
    """
    spark = vectors.sparkSession
    kept = vectors.filter(
        F.col(id_col).isNotNull()
        & usable(F.col(vector_col))
        & F.exists(vector_col, lambda x: x != 0)
    ).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("q"))
    kept = kept.groupBy("id", F.xxhash64("vector").alias("code"), "vector").agg(F.max("q").alias("q"))
    copies = Window.partitionBy("code", "vector").orderBy("id")
    first_ids = kept.withColumn("n", F.row_number().over(copies)).filter(F.col("n") <= k + 1)
    classes = first_ids.groupBy("code", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = kept.filter("q").groupBy("code", "vector").agg(F.lit(True).alias("asked"))
    entries = materialize(
        classes.join(asked, ["code", "vector"], "left").select(
            F.col("ids")[0].alias("entry"), "ids", "vector", "code", F.coalesce("asked", F.lit(False)).alias("asked")
        ),
        "entries",
    )
    facts = entries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dims")).first()
    total, dims = facts["n"], facts["dims"] or 1
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = entries.orderBy(F.xxhash64("entry")).limit(SAMPLE).select("vector").toArrow()
    curves = curves_of(_matrix(sample.column("vector").to_pylist(), dims), dims)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column("vector").to_pylist(), dims)
            for number, (axes, lines) in enumerate(curves):
                projected = values @ axes
                grid = np.stack([np.searchsorted(lines[:, d], projected[:, d]) for d in range(DIMS)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(values), number, np.int32)),
                        pa.array(hilbert_index(grid, BITS)),
                        batch.column("entry"),
                    ],
                    ["curve", "key", "entry"],
                )

    # place of every entry on every curve: sorted by ranges, then numbered across them
    keyed = entries.select("entry", "vector").mapInArrow(place, "curve int, key long, entry long")
    tasks = max(1, total * CURVES // 50_000)
    ordered = keyed.repartitionByRange(tasks, "curve", "key", "entry").sortWithinPartitions("curve", "key", "entry")
    ordered = materialize(ordered.withColumn("mark", F.monotonically_increasing_id()), "curve-order")
    part = F.shiftright("mark", 33)
    sums = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    stretch, around = window(total)
    last = (total - 1) // stretch
    rank = F.col("start") + F.col("mark").bitwiseAND((1 << 33) - 1) - F.col("curve") * F.lit(total)
    numbered = (
        ordered.join(starts, part == F.col("part"))
        .select("curve", "entry", F.floor(rank / stretch).alias("own"))
        .join(entries.select("entry", "vector", "asked"), "entry")
    )
    low, high = F.greatest(F.col("own") - around, F.lit(0)), F.least(F.col("own") + around, F.lit(last))
    queries = numbered.filter("asked").select(
        "curve", F.explode(F.sequence(low, high)).alias("stretch"), F.floor(F.col("own") / TOGETHER).alias("part"), "entry", "vector"
    )
    candidates = numbered.select(
        "curve",
        F.col("own").alias("stretch"),
        F.explode(F.sequence(F.floor(low / TOGETHER), F.floor(high / TOGETHER))).alias("part"),
        "entry",
        "vector",
    )

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"asked": [], "entry": [], "score": []}).astype({"asked": "int64", "entry": "int64"})
        a, b = _matrix(list(left["vector"]), dims), _matrix(list(right["vector"]), dims)
        rows, columns, number = [], [], min(len(b), k + 9)
        for start in range(0, len(a), 512):  # a few more than asked for, as matrix products round differently
            rough = a[start : start + 512] @ b.T
            top = np.argpartition(-rough, number - 1, axis=1)[:, :number]
            rows.append(np.repeat(np.arange(start, start + len(rough)), number))
            columns.append(top.ravel())
        rows, columns = np.concatenate(rows), np.concatenate(columns)
        score = np.zeros(len(rows))
        for d in range(dims):
            score += a[rows, d] * b[columns, d]
        return pd.DataFrame(
            {"asked": left["entry"].to_numpy()[rows], "entry": right["entry"].to_numpy()[columns], "score": score}
        )

    keys = ["curve", "stretch", "part"]
    # names of their own for the second use of the same columns
    candidates = candidates.toDF(*candidates.columns).select(*[F.col(c).alias(c) for c in candidates.columns])
    found = queries.groupBy(keys).cogroup(candidates.groupBy(keys)).applyInPandas(best, "asked long, entry long, score double")
    merged = found.groupBy(F.col("asked").alias("query_id"), F.col("entry").alias("vec_id")).agg(F.max("score").alias("score"))
    near = top_ranks(merged, k + 1).select("query_id", F.col("vec_id").alias("entry"), "score")
    ids = near.join(entries.select("entry", F.explode("ids").alias("vec_id")), "entry")
    ids = ids.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    near_ids = top_ranks(ids, k + 1).withColumnRenamed("query_id", "asked").drop("rank")
    rows = (
        kept.filter("q")
        .join(entries.select("code", "vector", F.col("entry").alias("asked")), ["code", "vector"])
        .select(F.col("id").alias("query_id"), "asked")
    )
    pairs = rows.join(near_ids, "asked").filter("query_id <> vec_id").groupBy("query_id", "vec_id")
    return top_ranks(pairs.agg(F.max("score").alias("score")), k)

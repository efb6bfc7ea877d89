"""What every filter removes in every order: contingency tensors of the filters, contracted step by step."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.blocks import text_blocks

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3  # number, percent, percent
CAPITALS, MARKS = bytes(range(65, 91)), b"#$%&*|"

# along an axis of a tensor: documents that pass the filter, that fail, or both
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def text_code(text: str) -> int:
    """Failures of the filters that see one text, as bits: A 8, B 4, C 2, D 1."""
    data = text.encode()
    words = data.split()  # of bytes, that is at blank and \t \n \v \f \r
    short = len(words) < LEAST_WORDS
    repeated = 100 * len(set(words)) < LEAST_DISTINCT * len(words)
    capitals = len(data) - len(data.translate(None, CAPITALS))
    loud = 100 * capitals > MOST_CAPITALS * len(text)
    marked = len(data.translate(None, MARKS)) < len(data)
    return short << 3 | repeated << 2 | loud << 1 | marked


def coded_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest, code``: the text is replaced by its failures and a digest of 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            texts = [text or "" for text in block.column("text").to_pylist()]
            digests = [hashlib.blake2b(text.encode(), digest_size=16).digest() for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    block.column("part"),
                    pa.array(digests, pa.binary()),
                    pa.array(map(text_code, texts), pa.int32()),
                ],
                ["doc_id", "part", "digest", "code"],
            )

    part = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
    rows = docs.select(F.col("doc_id").cast("long"), part, "text")
    return rows.mapInArrow(run, "doc_id long, part string, digest binary, code int")


def contingency(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, cell, n, good, toxic``: documents by the filters they fail, A the highest of five bits.

    Filter E fails documents whose text a smaller ``doc_id`` of the whole table has too. Copies of a text
    are reduced to one row per part and label before they meet, so that no group of copies is gathered.
    Repeated rows count each; a document is good or toxic if any of its rows in ``labels`` says so.
    A null text is an empty one, a null ``lang`` the empty part. A row without id has no label and neither
    is a copy nor makes one. Other columns are ignored.
    """
    is_one = {name: F.max(F.coalesce(F.col(column) == 1, F.lit(False))) for name, column in LABELS.items()}
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[value.cast("int").alias(name) for name, value in is_one.items()], F.lit(0).cast("long").alias("salt")
    )
    # rows without id match no label; the salt keeps them from meeting in one task
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0))
    rows = (
        coded_documents(docs)
        .groupBy("doc_id", "part", "digest", "code")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("salt", salt)
        .join(known, ["doc_id", "salt"], "left")
        .fillna(0, list(LABELS))
    )
    identified = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    copies = rows.groupBy("digest", "part", "code", *LABELS).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(identified).alias("first"),
    )
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    at_least = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = copies.withColumn("least", least).withColumn("originals", F.col("nameless") + at_least)
    halves = F.array(
        F.struct((F.col("code") * 2).alias("cell"), F.col("originals").alias("n")),
        F.struct((F.col("code") * 2 + 1).alias("cell"), (F.col("n") - F.col("originals")).alias("n")),
    )
    cells = split.select("part", *LABELS, F.explode(halves).alias("half")).filter("half.n > 0")
    return cells.groupBy("part", F.col("half.cell").alias("cell")).agg(
        F.sum("half.n").alias("n"), *[F.sum(F.col("half.n") * F.col(name)).alias(name) for name in LABELS]
    )


LABELS = {"good": "quality", "toxic": "toxic"}


class Contractions:
    """Counts of one part's documents, selected along every filter's axis."""

    def __init__(self, tensors: np.ndarray):
        """``tensors``: kinds of counts x 2 for every filter."""
        self.tensors = tensors
        axes = "abcdefghijklmnopqrstuvwxy"[: tensors.ndim - 1]
        self.rule = f"z{axes},{','.join(axes)}->z"
        self.known: dict[tuple, np.ndarray] = {}

    def count(self, choice: tuple[tuple[int, int], ...]) -> np.ndarray:
        """Every kind's documents that are as chosen: each axis ``PASS``, ``FAIL`` or ``ALL``."""
        if choice not in self.known:
            self.known[choice] = np.einsum(self.rule, self.tensors, *map(np.array, choice))
        return self.known[choice]

    def at(self, filters: str, earlier: str, own: str, fate: tuple[int, int]) -> np.ndarray:
        """Documents that passed the ``earlier`` filters and have this ``fate`` at their ``own``."""
        return self.count(tuple(PASS if f in earlier else fate if f == own else ALL for f in filters))


AUDIT_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def audit_orders(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What every step of every order of ``filters`` keeps and removes, by part.

    ``cells`` are those of ``contingency``: at most two to the power of the number of filters for a part, reshaped to a
    tensor with an axis for each filter. ``kept`` are left after the step and ``removed`` go in it; ``redundant`` fail its filter
    but went before; ``unique_fails`` fail only this filter; ``good_lost`` and ``toxic_lost`` are those
    removed with that label; ``shapley`` sums what the filter removes over all orders, at any step. A part has all its rows,
    also where all counts are 0; without documents there is no part.
    """
    kinds = ["n", *LABELS]

    def contract(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        flat = np.zeros((len(kinds), 1 << len(filters)), np.int64)
        flat[:, group["cell"].to_numpy()] = group[kinds].to_numpy(np.int64).T
        counts = Contractions(flat.reshape(len(kinds), *[2] * len(filters)))
        rows, shapley = [], dict.fromkeys(filters, 0)
        for order in permutations(filters):
            for step, own in enumerate(order, 1):
                earlier = "".join(order[: step - 1])
                removed = counts.at(filters, earlier, own, FAIL)
                shapley[own] += int(removed[0])
                rows.append((
                    key[0], "".join(order), step,
                    counts.at(filters, earlier, own, PASS)[0], removed[0],
                    counts.at(filters, "", own, FAIL)[0] - removed[0],
                    counts.at(filters, filters.replace(own, ""), own, FAIL)[0],
                    removed[1], removed[2], own,
                ))
        out = pd.DataFrame(rows, columns=[field.split()[0] for field in AUDIT_SCHEMA.split(", ")])
        return out.assign(shapley=out["shapley"].map(shapley))

    return cells.groupBy("part").applyInPandas(contract, AUDIT_SCHEMA)


# The same counts, every order and step against every combination of failures.
AUDIT_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), firsts AS (
    SELECT text, min(doc_id) AS least FROM docs GROUP BY text
), known AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), marked AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
    FROM docs JOIN firsts USING (text) LEFT JOIN known USING (doc_id)
), cells AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM marked GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), met AS (
    SELECT part, filter_order, step, own, fails, n, good, toxic, contains(fails, own) AS fails_own,
        translate(earlier, fails, '') = earlier AS there
    FROM cells, steps
), summed AS (
    SELECT part, filter_order, step, own,
        coalesce(sum(n) FILTER (there AND NOT fails_own), 0) AS kept,
        coalesce(sum(n) FILTER (there AND fails_own), 0) AS removed,
        coalesce(sum(n) FILTER (NOT there AND fails_own), 0) AS redundant,
        coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
        coalesce(sum(good) FILTER (there AND fails_own), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (there AND fails_own), 0) AS toxic_lost
    FROM met GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
    CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
    CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
    CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed
"""

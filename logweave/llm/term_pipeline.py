"""Ranked lexical search: bundles of items pass the owners of their terms, adding integer contributions."""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.session import materialize

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# documents of one block of the index, and items of one bundle
BLOCK_DOCS, BUNDLE_ITEMS = 8_192, 256
# Terms are owned by how frequent they are, the rarest first: owner i has those in at most a share of
# 1 / OWNERS[i] of the documents.
OWNERS = (64, 8, 1)
# terms that tasks look up while they read texts; for more, all terms are indexed and joined afterwards
MOST_TERMS = 500_000

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _KEPT else 32 for b in range(256)
)


def text_terms(text: str) -> list[bytes]:
    """Terms of a text in order: in UTF-8 all bytes of a separator are ASCII, so bytes are folded and split."""
    return text.encode().translate(_FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``: the distinct terms of every item; null ids and texts have none."""
    folded = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    terms = F.explode(F.array_distinct(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0)))).alias("term")
    return items.filter("item_id is not null").select(F.col("item_id").cast("long"), terms).distinct()


INDEX_SCHEMA = (
    "docs array<long>, lengths array<long>, "
    "postings array<struct<term:string,places:array<int>,counts:array<int>>>"
)


def index_blocks(docs: DataFrame, wanted: frozenset[bytes] | None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Blocks of documents that have terms: their ids and lengths, and for every wanted term its places in
    the block and its counts there. All terms are indexed for ``None``."""

    def rows(ids: list, lengths: list[int], found: dict[bytes, tuple[list[int], list[int]]]) -> pa.RecordBatch:
        each = [{"term": t.decode(), "places": p, "counts": c} for t, (p, c) in found.items()]
        arrays = [pa.array([x], kind) for x, kind in zip((ids, lengths, each), KINDS, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["docs", "lengths", "postings"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, found = [], [], {}
        for batch in batches:
            texts = batch.column("text")
            for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                terms = text_terms(texts[row].as_py() or "")
                if not terms:
                    continue
                counts = Counter(terms)
                for term in counts if wanted is None else wanted & counts.keys():
                    places, times = found.setdefault(term, ([], []))
                    places.append(len(ids))
                    times.append(counts[term])
                ids.append(doc_id)
                lengths.append(len(terms))
                if len(ids) == block_docs:
                    yield rows(ids, lengths, found)
                    ids, lengths, found = [], [], {}
        if ids:
            yield rows(ids, lengths, found)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, INDEX_SCHEMA)


KINDS = (
    pa.list_(pa.int64()),
    pa.list_(pa.int64()),
    pa.list_(pa.struct([("term", pa.string()), ("places", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])),
)


def term_weights(postings: DataFrame, documents: int) -> DataFrame:
    """``term, weight, owner, most``: ``most`` is more than any document can get for the term, or as much."""
    weight = F.floor(1000 * F.log(F.lit(2 * documents + 2).cast("double") / (2 * F.col("df") + 1))).cast("long")
    owner = sum((F.col("df") * share > documents).cast("int") for share in OWNERS[:-1])
    tf = F.col("tf").cast("long")
    # no document's m is below 50
    most = F.col("weight") * F.expr("(1000000000 * tf) div (1000 * tf + 1000)")
    return (
        postings.groupBy("term")
        .agg(F.sum(F.size("places")).alias("df"), F.max(F.array_max("counts")).alias("tf"))
        .withColumns({"weight": weight, "owner": owner, "tf": tf})
        .withColumn("most", most)
        .select("term", "weight", "owner", "most")
    )


STATE_SCHEMA = (
    "block long, bundle int, docs array<long>, lengths array<long>, "
    "items array<struct<item_id:long,rest:array<long>,terms:array<struct<term:string,weight:long>>>>, "
    "sums array<struct<places:binary,scores:binary,closed:boolean>>"
)
STATE = pa.schema(
    [
        ("block", pa.int64()),
        ("bundle", pa.int32()),
        ("docs", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("items", pa.list_(pa.struct([
            ("item_id", pa.int64()), ("rest", pa.list_(pa.int64())),
            ("terms", pa.list_(pa.struct([("term", pa.string()), ("weight", pa.int64())]))),
        ]))),
        ("sums", pa.list_(pa.struct([("places", pa.binary()), ("scores", pa.binary()), ("closed", pa.bool_())]))),
    ]
)


def keep_possible(scores: np.ndarray, places: np.ndarray, rest: int, k: int) -> tuple[np.ndarray, bool]:
    """Which of an item's documents of a block can still be among its ``k`` best, and whether no others can.

    ``rest`` bounds what later owners add. The k-th score so far is one that the final k-th reaches at
    least; a document that cannot reach it with the rest is out, and so is any that has no score yet.
    """
    if len(scores) < k:
        return places, False
    bar = np.partition(scores, len(scores) - k)[len(scores) - k]
    return places[scores + rest >= bar], bool(rest < bar)


def own_stage(owner: int, documents: int, words: int, k: int):
    """The function of one owner: state and postings of a bundle and block in, state out."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return STATE.empty_table()
        state = left.to_pylist()[0]
        lengths = np.array(state["lengths"], np.int64)
        norm = 20 * (50 + (50 * lengths * documents) // words)
        found = {}
        for term, places, counts in zip(*(right.column(c) for c in ("term", "places", "counts")), strict=True):
            at = np.asarray(places.values, np.int64)
            tf = np.asarray(counts.values, np.int64)
            found[term.as_py()] = at, (1_000_000_000 * tf) // (1000 * tf + norm[at])
        for item, sums in zip(state["items"], state["sums"], strict=True):
            terms = [t for t in item["terms"] if t["term"] in found]
            places = np.frombuffer(sums["places"], np.int32)
            scores = np.zeros(len(lengths), np.int64)
            scores[places] = np.frombuffer(sums["scores"], np.int64)
            for t in terms:
                at, gain = found[t["term"]]
                scores[at] += t["weight"] * gain
            if not sums["closed"]:
                places = np.flatnonzero(scores).astype(np.int32)
            places, closed = keep_possible(scores[places], places, item["rest"][owner], k)
            sums |= {
                "places": places.tobytes(), "scores": scores[places].tobytes(), "closed": closed or sums["closed"],
            }
        return pa.Table.from_pylist([state], STATE)

    return run


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    block_docs: int = BLOCK_DOCS,
    bundle_items: int = BUNDLE_ITEMS,
    most_terms: int = MOST_TERMS,
) -> DataFrame:
    """The ``k`` documents with the highest score above 0 for each item: ``item_id, rank, doc_id, score``.

    Terms are runs of digits, letters and everything beyond ASCII; only A-Z is lower-cased. A document with ``tf``
    occurrences of a term gets ``weight * ((10^9 tf) div (1000 tf + 20 m))`` for it, with ``m`` = 50 + (50 n N) div L
    from its length ``n``, the number ``N`` of documents with terms and all their terms ``L``, and ``weight`` =
    floor(1000 ln((2 N + 2) / (2 df + 1))). Ties go to the smaller ``doc_id``. Null and empty texts and those without terms
    are no documents; a row without id counts in the statistics but is not returned. Rows that repeat a ``doc_id`` are
    documents of their own; rows that repeat an ``item_id`` are one item with all their terms. Items
    without id, text or known term have no rows. Other columns are ignored.

    The index has blocks of ``block_docs`` documents, so a term in a third of all documents is many short lists. An owner has
    the lists of the terms of one class of frequency. Bundles of items, one per block, start with empty sums and go from owner
    to owner, the rarest terms first; each adds what its terms contribute. Sums that cannot reach the k best any more, by
    a bound on what later owners add, are left behind, which changes no result.
    """
    terms = materialize(item_terms(items), "item-terms")
    asked = terms.select("term").distinct()
    known = asked.limit(most_terms + 1).collect()
    few = len(known) <= most_terms
    wanted = frozenset(row["term"].encode() for row in known) if few else None
    blocks = index_blocks(docs, wanted, block_docs).withColumn("block", F.monotonically_increasing_id())
    index = materialize(blocks, "term-index")
    postings = index.select(F.col("block").alias("at"), F.explode("postings").alias("p")).select("at", "p.*")
    if not few:
        postings = postings.join(asked, "term", "left_semi")
    sums = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)
    totals = index.agg(F.sum(F.size("docs")).alias("documents"), F.sum(sums).alias("words")).first()
    documents, words = totals["documents"] or 0, totals["words"] or 0

    weights = materialize(term_weights(postings, documents), "term-weights")
    number = F.dense_rank().over(Window.orderBy("item_id")) - 1  # over the stated items only
    bundled = item_bundles(terms.join(weights, "term"), bundle_items, number)
    bundled = materialize(bundled, "item-bundles")
    bundles = (bundled.agg(F.max("bundle")).first()[0] or 0) + 1
    every = F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle")
    state = (
        index.select("block", every, "docs", "lengths")
        .join(bundled, "bundle")
        .select("block", "bundle", "docs", "lengths", "items", "sums")
    )
    owned = postings.join(weights.select("term", "owner"), "term").select("at", every, "owner", "term", "places", "counts")
    for owner in range(len(OWNERS)):
        lists = owned.filter(F.col("owner") == owner).drop("owner")
        state = (
            state.groupBy("block", "bundle")
            .cogroup(lists.groupBy("at", "bundle"))
            .applyInArrow(own_stage(owner, documents, words, k), STATE_SCHEMA)
        )
    found = state.mapInArrow(best_of_block(k), "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def item_bundles(terms: DataFrame, bundle_items: int, number: Column) -> DataFrame:
    """``bundle, items, sums``: items with their terms, for every owner a bound on what the later ones add, and
    empty sums."""
    later = [F.sum(F.when(F.col("owner") > i, F.col("most")).otherwise(0)) for i in range(len(OWNERS))]
    each = terms.groupBy("item_id").agg(
        F.array(*later).alias("rest"), F.collect_list(F.struct("term", "weight")).alias("terms")
    )
    empty = F.struct(
        F.lit(b"").alias("places"), F.lit(b"").alias("scores"), F.lit(False).alias("closed")
    )
    return (
        each.withColumn("bundle", F.floor(number / bundle_items).cast("int"))
        .groupBy("bundle")
        .agg(F.collect_list(F.struct("item_id", "rest", "terms")).alias("items"))
        .withColumn("sums", F.transform("items", lambda _: empty))
    )


def best_of_block(k: int):
    """The rows ``item_id, doc_id, score`` of every item's best documents of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for state in batch.to_pylist():
                ids = np.array([-1 if x is None else x for x in state["docs"]], np.int64)
                named = np.array([x is not None for x in state["docs"]], bool)
                for item, sums in zip(state["items"], state["sums"], strict=True):
                    places = np.frombuffer(sums["places"], np.int32)
                    scores = np.frombuffer(sums["scores"], np.int64)
                    places, scores = places[named[places]], scores[named[places]]
                    best = np.lexsort((ids[places], -scores))[:k]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(best), item["item_id"])),
                            pa.array(ids[places[best]]),
                            pa.array(scores[best]),
                        ],
                        ["item_id", "doc_id", "score"],
                    )

    return run


# The same scores of all documents that share a term with an item.
RANK_SQL = r"""
WITH folded AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL
), docs AS (
    SELECT row_number() OVER () AS row, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM folded WHERE len(terms) > 0
), totals AS (
    SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS words FROM docs
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL
), counted AS (
    SELECT row, doc_id, n, term, count(*) AS tf
    FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY row, doc_id, n, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * (SELECT documents FROM totals) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counted GROUP BY term
), scored AS (
    SELECT item_id, row, doc_id, CAST(sum(
        w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * t.documents) // t.words)))) AS BIGINT) AS score
    FROM asked JOIN counted USING (term) JOIN weights USING (term), totals t
    GROUP BY item_id, row, doc_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scored WHERE score > 0 AND doc_id IS NOT NULL
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

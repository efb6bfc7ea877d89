"""Near-duplicate documents by HyperMinHash registers, confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.blocks import WORD, groups, mixed, text_blocks, text_digest, with_ids, worker_state
from logweave.llm.components import connected_components
from logweave.session import kept_table, materialize

REGISTERS, MANTISSA = 384, 10  # buckets of a sketch, and bits kept behind the leading one
MISSED = 5e-6  # chance at most that a pair of just the asked similarity shares no band
REMEMBERED = 150_000
# members of one bucket that are compared with each other in one group
TOGETHER = 512
# chance that two different minima share a register: both have the same leading zeros and mantissa
COLLISION = 2.0**-MANTISSA / 2


class Shingler:
    """Distinct shingles of texts as sorted 64-bit hashes."""

    def __init__(self, size: int):
        self.size = size
        self.find = re.compile(WORD.encode()).findall
        self.known: dict[bytes, int] = {}

    def _fold(self, words: np.ndarray, size: int) -> np.ndarray:
        """Hash of every run of ``size`` words."""
        count = len(words) - size + 1
        folded = np.full(max(count, 0), size, np.uint64)
        for place in range(size):
            folded = mixed(folded + words[place : place + count])
        return folded

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The set of each text; a text with fewer words than a shingle gives one of all its words."""
        words = [self.find(text.encode().lower()) if text else [] for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = set(chain.from_iterable(words)) - self.known.keys()
        self.known.update((word, xxhash.xxh3_64_intdigest(word)) for word in new)
        out = []
        for found in words:
            hashes = np.fromiter(map(self.known.__getitem__, found), np.uint64, len(found))
            out.append(np.unique(self._fold(hashes, min(self.size, len(found)) or 1)))
        return out


# order in which each register looks for a filled one
_look = mixed(np.arange(REGISTERS * REGISTERS)).reshape(REGISTERS, REGISTERS)


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash of a set that isn't empty: per bucket the minimum's leading zeros and mantissa.

    ``shingles`` are sorted, so the first with a remainder is a bucket's minimum. An empty bucket takes the register of the
    filled one that comes first in an order of its own. So every register agrees with the chance of the
    similarity, also those of small sets.
    """
    bucket, first = np.unique(shingles % np.uint64(REGISTERS), return_index=True)
    values = (shingles[first] >> np.uint64(12)).astype(np.float64)
    fraction, exponent = np.frexp(values)
    mantissa = np.clip((2 * fraction - 1) * (1 << MANTISSA), 0, None).astype(np.uint16)
    filled = ((53 - exponent).astype(np.uint16) << MANTISSA) | mantissa
    out, bucket = np.zeros(REGISTERS, np.uint16), bucket.astype(np.int64)
    out[bucket] = filled
    empty = np.setdiff1d(np.arange(REGISTERS), bucket, assume_unique=True)
    if len(empty):
        out[empty] = filled[_look[np.ix_(empty, bucket)].argmin(axis=1)]
    return out


def band_shape(similarity: float) -> tuple[int, int]:
    """Number of bands and their length: the longest bands with which pairs of this similarity are still found."""
    best = (1, 1)
    for rows in range(1, 33):
        bands = math.ceil(math.log(MISSED) / math.log1p(-(similarity**rows)))
        if bands * rows > REGISTERS:
            break
        best = (bands, rows)
    return best


def cut_bands(sketches: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Sketches as sketch x band x row."""
    return sketches[:, : shape[0] * shape[1]].reshape(len(sketches), *shape)


def band_keys(sketches: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Key of every band of every sketch."""
    bands = cut_bands(sketches, shape)
    keys = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), bands.shape[:2])
    for place in range(shape[1]):
        keys = mixed(keys + bands[:, :, place])
    return keys.view(np.int64)


def estimates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jaccard similarity of sketches along the last axis, corrected for registers that agree by chance."""
    share = (left == right).mean(axis=-1)
    return (share - COLLISION) / (1 - COLLISION)


def least_estimate(similarity: float) -> float:
    """An estimate that a pair of at least this similarity misses about once in 3,000 times."""
    return similarity - 3.4 * math.sqrt(similarity * (1 - similarity) / REGISTERS)


def _sketch(array: pa.Array) -> np.ndarray:
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return np.frombuffer(b"".join(array.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def sketch_documents(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, digest, n_shingles, set_key, sketch, row``; key and sketch are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = worker_state(Shingler, size)
        for block in text_blocks(batches):
            texts = block.column("text").to_pylist()
            sets = shingler.sets(texts)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            sketches = [registers(s).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array([hashlib.md5((text or "").encode()).digest() for text in texts], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "digest", "n_shingles", "set_key", "sketch"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    sketched = rows.mapInArrow(run, "doc_id long, digest binary, n_shingles long, set_key binary, sketch binary")
    return sketched.withColumn("row", F.monotonically_increasing_id())


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """``id, shingles``: the whole shingle set of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = worker_state(Shingler, size)
        for block in text_blocks(batches):
            sets = shingler.sets(block.column("text").to_pylist())
            offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            values = np.concatenate(sets).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([block.column("id"), lists], ["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles array<long>")


def ends(pairs: DataFrame) -> DataFrame:
    """``id``: the distinct ids of pairs ``a, b``."""
    return materialize(pairs.select("a").union(pairs.select("b")).distinct().toDF("id"), "pair-ids")


def confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs ``a, b`` of classes whose full sets are similar enough.

    A class is read from the rows of its ``doc_id`` and text ``digest``; ``n`` is their number.
    """
    wanted = materialize(classes.join(ends(pairs), "id", "left_semi").select("id", "doc_id", "digest", "n"), "wanted-classes")
    rows = docs.select(F.col("doc_id").cast("long"), text_digest(F.col("text")).alias("digest"), "text")
    sets = full_sets(with_ids(rows, wanted.drop("n"), ["doc_id", "digest"], "inner").select("id", "text"), size)
    if not wanted.filter("n > 1").isEmpty():
        sets = sets.dropDuplicates(["id"])
    percent = round(similarity * 100)
    common = F.size(F.array_intersect("x", "y"))
    together = F.size("x") + F.size("y") - common
    return (
        pairs.join(sets.toDF("a", "x"), "a")
        .join(sets.toDF("b", "y"), "b")
        .filter(100 * common >= percent * together)
        .select("a", "b")
    )


def likely(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """The pairs ``a, b`` whose sketches make the similarity likely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = estimates(_sketch(batch.column("x")), _sketch(batch.column("y"))) >= least
                yield batch.filter(pa.array(near)).select(["a", "b"])

    asked = with_ids(sketches, ends(pairs), "id")
    both = pairs.join(asked.toDF("a", "x"), "a").join(asked.toDF("b", "y"), "b")
    return both.mapInArrow(run, "a long, b long")


def pairs_within(members: DataFrame, sketches: DataFrame, least: float, shape: tuple[int, int]) -> DataFrame:
    """Likely pairs of members of a bucket that are in different components, each pair once.

    ``members``: ``key, band, id, component``; ``sketches``: ``id, sketch``. In every bucket the members of its most frequent component are
    dealt into blocks, the others too; a group is a block of the others with any block. A pair that
    shares several bands is taken from the first.
    """
    sizes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    shares = sizes.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts")
    )
    shares = shares.filter("parts > 1").select(
        "key",
        F.col("main.component").alias("main"),
        F.ceil(F.col("main.n") / TOGETHER).cast("int").alias("mains"),
        F.ceil((F.col("all") - F.col("main.n")) / TOGETHER).cast("int").alias("others"),
    )
    dealt = members.join(shares, "key").withColumn("in_main", F.col("component") == F.col("main"))
    mains = (
        dealt.filter("in_main")
        .withColumn("j", F.pmod(F.xxhash64("id"), F.col("mains")).cast("int"))
        .withColumn("i", F.explode(F.expr("sequence(0, others - 1)")))
        .select("key", "i", "j", "band", "id", "component", F.lit(1).alias("side"))
    )
    own = F.pmod(F.xxhash64("id"), F.col("others")).cast("int")
    asked = (  # a block of others as the one side
        dealt.filter("not in_main")
        .withColumn("i", own)
        .withColumn("j", F.explode(F.expr("sequence(0, mains + others - 1)")))
        .filter("j < mains or j - mains >= i")
        .select("key", "i", "j", "band", "id", "component", F.lit(0).alias("side"))
    )
    among = (  # and as the other side, once for each pair of blocks
        dealt.filter("not in_main")
        .withColumn("j", F.col("mains") + own)
        .withColumn("i", F.explode(F.expr("sequence(0, j - mains)")))
        .select("key", "i", "j", "band", "id", "component", F.lit(1).alias("side"))
    )
    rows = mains.union(asked).union(among).withColumn("group", F.xxhash64("key", "i", "j"))
    rows = rows.drop("key", "i", "j").join(sketches, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "group"):
            side = group.column("side").to_numpy()
            ids, parts = group.column("id").to_numpy(), group.column("component").to_numpy()
            sketches, band = _sketch(group.column("sketch")), group.column("band")[0].as_py()
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            bands = cut_bands(sketches, shape)
            found: list[tuple[int, int]] = []
            for x in left:
                y = right[parts[right] != parts[x]]
                y = y[estimates(sketches[x], sketches[y]) >= least]
                if not len(y):
                    continue
                shared = (bands[y] == bands[x]).all(axis=2)
                y = y[shared.argmax(axis=1) == band]
                found.extend((min(ids[x], ids[z]), max(ids[x], ids[z])) for z in y)
            if found:
                a, b = np.unique(np.array(found, np.int64), axis=0).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    dealt_out = rows.repartition("group").sortWithinPartitions("group")
    return dealt_out.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document.

    A document's set has its distinct runs of ``size`` words, A-Z in lower case; a text with fewer words is
    one shingle. Documents whose sets have at least this Jaccard similarity are linked, and a component's id is the
    smallest id in it; ``kept`` marks that document. A null or empty text, or one without words, is linked with
    nothing and kept. A null id counts like that too, its component is null. Rows that repeat an id are linked each by its
    own text; ``digest`` (128 bits) tells such texts apart, and ``first`` marks the rows of one text in each component,
    the smallest by id and digest. Other columns are ignored.

    Equal sets are one representative from the start, a class. Buckets of equal bands first link every member to the
    bucket's smallest class; after that only members of different components can add anything, and only those that are
    likely by their sketches are confirmed. All links are confirmed on full sets. What is written on the way is
    deleted, but for the result.
    """
    return kept_table(docs.sparkSession, "near-duplicates", lambda: _near_duplicates(docs, size, similarity))


def _near_duplicates(docs: DataFrame, size: int, similarity: float) -> DataFrame:
    least, shape = least_estimate(similarity), band_shape(similarity)
    sketched = materialize(sketch_documents(docs.select("doc_id", "text"), size), "sketches")
    filled = sketched.filter("set_key is not null and doc_id is not null")
    texts = filled.groupBy("set_key", "doc_id", "digest").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct("doc_id", "digest", "row", "n")).alias("first")
    classes = materialize(
        texts.groupBy("set_key").agg(first).select(
            "set_key", F.col("first.row").alias("id"), "first.doc_id", "first.digest", "first.n"
        ),
        "set-classes",
    )
    sketches = materialize(
        with_ids(filled, classes.select(F.col("id").alias("row")), "row").select(F.col("row").alias("id"), "sketch"),
        "set-sketches",
    )

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_sketch(batch.column("sketch")), shape)
                row, band = np.indices(keys.shape).reshape(2, -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.ravel()),
                        pa.array(band.astype(np.int32)),
                        batch.column("id").take(pa.array(row)),
                    ],
                    ["key", "band", "id"],
                )

    buckets = sketches.mapInArrow(bands, "key long, band int, id long")
    firsts = buckets.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    members = materialize(
        buckets.join(firsts.filter("first < last"), "key").filter("id > first").select("key", "band", "id", "first"),
        "bucket-members",
    )
    stars = materialize(members.select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(), "stars")
    links = materialize(
        confirmed(docs, classes, materialize(likely(stars, sketches, least), "likely-pairs"), size, similarity),
        "star-links",
    )
    parts = connected_components(links)
    placed = members.join(parts, "id", "left").select(
        "key", "band", "id", F.coalesce("component", "id").alias("component")
    )
    mixed_buckets = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    open_members = materialize(placed.join(mixed_buckets.filter("x < y").select("key"), "key"), "open-members")
    rest = materialize(pairs_within(open_members, sketches, least, shape), "rest-pairs")
    final = connected_components(links.union(confirmed(docs, classes, rest, size, similarity)))
    leads = (
        final.join(classes, "id").groupBy("component").agg(F.min(F.struct("doc_id", "digest")).alias("lead"))
    )
    own = F.struct("doc_id", "digest")
    of_class = classes.join(final.join(leads, "component").select("id", "lead"), "id", "left").select(
        "set_key", F.coalesce("lead", own).alias("lead")
    )
    linked = filled.join(of_class, "set_key").select("doc_id", "n_shingles", "digest", "lead")
    alone = sketched.filter("set_key is null or doc_id is null").select("doc_id", "n_shingles", "digest", own.alias("lead"))
    kept = F.coalesce(F.col("doc_id") == F.col("lead.doc_id"), F.lit(True))
    return linked.union(alone).select(
        "doc_id", "n_shingles", F.col("lead.doc_id").alias("component_id"), kept.alias("kept"), "digest",
        (kept & (F.col("digest") == F.col("lead.digest"))).alias("first"),
    )

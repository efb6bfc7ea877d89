"""Removal of long byte strings that repeat, by sorting the suffixes where copies are possible."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.blocks import groups, mixed, text_blocks
from logweave.llm.suffix_sort import PrefixHashes, merge_sort
from logweave.session import materialize, small_side

# contexts of one anchor that are sorted together; more are compared window by window
TOGETHER = 2_000
# bytes of contexts that are sorted at once
SORT_BYTES = 2 << 20


def anchors(text: PrefixHashes, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of ``length`` bytes with the same anchor: first window, number of windows, anchor, its hash.

    A window's anchor is the half-window string of minimum hash in it, the leftmost of equals. So
    equal windows have equal anchors at the same place.
    """
    size = len(text.data) - length + 1
    if size <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    half = length // 2
    hashes = mixed(text.every(half))
    span = length - half + 1
    keyed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    padded = np.full(-(-len(keyed) // span) * span, np.uint64(2**64 - 1))
    padded[: len(keyed)] = keyed
    table = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:size], ahead[span - 1 : span - 1 + size])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.r_[0, np.flatnonzero(at[1:] != at[:-1]) + 1]
    count = np.diff(np.r_[first, size])
    return first, count, at[first], hashes[at[first]].view(np.int64)


def _context_keys(text: PrefixHashes, first: np.ndarray, count: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    whole = text.at(first, count + length - 1)
    return mixed(whole + mixed((count << 32) + (at - first))).view(np.int64)


def anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """One row per anchor: ``anchor, context, digest, check, place``; ``place`` packs window, count and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            parts = []
            for row, value in enumerate(block.column("text").to_pylist()):
                data = np.frombuffer((value or "").encode(), np.uint8)
                if len(data) < length:
                    continue
                text = PrefixHashes(data)
                first, count, at, found = anchors(text, length)
                keys = _context_keys(text, first, count, at, length)
                place = (first << 24) | (count << 12) | (at - first)
                parts.append((found, keys, np.full(len(first), row), place))
            if parts:
                found, keys, rows, place = map(np.concatenate, zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found),
                        pa.array(keys),
                        block.column("digest").take(pa.array(rows)),
                        block.column("check").take(pa.array(rows)),
                        pa.array(place),
                    ],
                    ["anchor", "context", "digest", "check", "place"],
                )

    return docs.mapInArrow(run, "anchor long, context long, digest long, check long, place long")


def repeated_windows(
    contexts: list[bytes], offset: np.ndarray, count: np.ndarray, group: np.ndarray, length: int
) -> list[tuple[int, int, int]]:
    """Windows that occur in more than one context of a group: context, first window, last window.

    The suffixes at the anchors and the reversed prefixes before them are sorted; the neighbours in these
    orders give the longest extension to either side, which bounds the windows that can repeat. The
    suffixes at those windows are sorted within group and offset; neighbours that share a
    whole window repeat, which is verified on the bytes.
    """
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    data = np.frombuffer(b"".join(contexts), np.uint8)
    forward = PrefixHashes(data)
    backward = PrefixHashes(data[::-1].copy())
    total = len(data)
    reach = []
    for text, start, ends in (
        (forward, begin + offset, begin + sizes),
        (backward, total - begin - offset, total - begin),
    ):
        order = merge_sort(text, start, ends, group)
        x, y = order[:-1], order[1:]
        most = np.where(group[x] == group[y], np.minimum(ends[x] - start[x], ends[y] - start[y]), 0)
        shared = text.common(start[x], start[y], most)
        longest = np.zeros(len(contexts), np.int64)
        np.maximum.at(longest, x, shared)
        np.maximum.at(longest, y, shared)
        reach.append(longest)
    right, left = reach
    # window w starts offset - w bytes before the anchor
    low = np.maximum(0, offset - left)
    high = np.minimum(count - 1, offset - length + right)
    number = np.maximum(0, high - low + 1)
    owner = np.repeat(np.arange(len(contexts)), number)
    window = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number) + low[owner]
    if not len(owner):
        return []
    before = offset[owner] - window
    _, same = np.unique(group[owner] * (2 * length) + before, return_inverse=True)
    start = begin[owner] + window
    order = merge_sort(forward, start, start + length, same)
    x, y = order[:-1], order[1:]
    close = same[x] == same[y]
    x, y = x[close], y[close]
    equal = forward.common(start[x], start[y], np.full(len(x), length)) == length
    x, y = x[equal], y[equal]
    span = np.arange(length)
    repeats = np.zeros(len(owner), bool)
    for part in range(0, len(x), 10_000):
        a, b = x[part : part + 10_000], y[part : part + 10_000]
        sure = (data[start[a][:, None] + span] == data[start[b][:, None] + span]).all(axis=1)
        repeats[a[sure]] = repeats[b[sure]] = True
    owner, window = owner[repeats], window[repeats]
    if not len(owner):
        return []
    cut = np.flatnonzero((owner[1:] != owner[:-1]) | (window[1:] != window[:-1] + 1)) + 1
    firsts, lasts = np.r_[0, cut], np.r_[cut, len(owner)] - 1
    return list(zip(owner[firsts].tolist(), window[firsts].tolist(), window[lasts].tolist(), strict=True))


def _sorted_groups(length: int):
    """Task function: contexts of anchors, sorted by anchor, to ``anchor, context, low, high``."""

    def solve(tables: list[pa.Table]) -> pa.RecordBatch | None:
        table = pa.concat_tables(tables)
        group = np.repeat(np.arange(len(tables)), [t.num_rows for t in tables])
        found = repeated_windows(
            table.column("bytes").to_pylist(), table.column("offset").to_numpy(), table.column("count").to_numpy(),
            group, length,
        )
        if not found:
            return None
        row, low, high = map(pa.array, zip(*found, strict=True))
        return pa.RecordBatch.from_arrays(
            [
                table.column("anchor").take(row).combine_chunks(),
                table.column("context").take(row).combine_chunks(),
                low,
                high,
            ],
            ["anchor", "context", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for group in groups(batches, "anchor"):
            waiting.append(group)
            held += group.nbytes
            if held > SORT_BYTES:
                if (out := solve(waiting)) is not None:
                    yield out
                waiting, held = [], 0
        if waiting and (out := solve(waiting)) is not None:
            yield out

    return run


def repeated_spans(docs: DataFrame, length: int = 200) -> DataFrame:
    """``digest, check, start, stop``: byte ranges of documents ``digest, check, text`` that repeat; they may overlap.

    Two 64-bit hashes, ``digest`` and ``check``, name a document.
    """
    rows = anchor_rows(docs, length)
    often = rows.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("context").alias("x"), F.max("context").alias("y")
    )
    # written, so that a hot anchor's rows meet a plain shuffle side and can be split among tasks
    often = materialize(
        often.filter("n > 1").select("anchor", (F.col("x") != F.col("y")).alias("mixed")), "repeated-anchors"
    )
    placed = rows.drop("context").join(often, "anchor")
    hits = materialize(placed, "anchors").withColumns(
        {
            "first": F.shiftright("place", 24),
            "count": F.shiftright("place", 12).bitwiseAND(4095),
            "offset": F.col("place").bitwiseAND(4095),
        }
    )
    alike = hits.filter("not mixed").select(
        "digest", "check", F.col("first").alias("start"), (F.col("first") + F.col("count") - 1 + length).alias("stop")
    )

    # anchors whose surroundings differ: the bytes around them, each distinct context once
    wanted = (
        hits.filter("mixed").groupBy("digest", "check").agg(F.collect_list(F.struct("anchor", "place")).alias("places"))
    )
    named = docs.withColumnRenamed("digest", "id").withColumnRenamed("check", "same")
    around = named.join(
        wanted, (F.col("id") == F.col("digest")) & (F.col("same") == F.col("check"))
    ).select("digest", "check", "text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            columns: dict[str, list] = {n: [] for n in ("anchor", "doc", "place", "bytes", "context")}
            for row, (value, places) in enumerate(
                zip(block.column("text").to_pylist(), block.column("places").to_pylist(), strict=True)
            ):
                data = value.encode()
                for item in places:
                    first, count = item["place"] >> 24, item["place"] >> 12 & 4095
                    piece = data[first : first + count - 1 + length]
                    digest = hashlib.blake2b(piece, digest_size=8, key=(item["place"] & 0xFFFFFF).to_bytes(4, "little"))
                    columns["anchor"].append(item["anchor"])
                    columns["doc"].append(row)
                    columns["place"].append(item["place"])
                    columns["bytes"].append(piece)
                    columns["context"].append(int.from_bytes(digest.digest(), "little", signed=True))
            doc = pa.array(columns.pop("doc"), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("digest").take(doc),
                    block.column("check").take(doc),
                    pa.array(columns["anchor"], pa.int64()),
                    pa.array(columns["context"], pa.int64()),
                    pa.array(columns["place"], pa.int64()),
                    pa.array(columns["bytes"], pa.binary()),
                ],
                ["digest", "check", "anchor", "context", "place", "bytes"],
            )

    surroundings = materialize(
        around.mapInArrow(cut, "digest long, check long, anchor long, context long, place long, bytes binary"),
        "contexts",
    )
    classes = surroundings.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("n"),
        F.first("bytes").alias("bytes"),
        F.first(F.shiftright("place", 12).bitwiseAND(4095)).alias("count"),
        F.first(F.col("place").bitwiseAND(4095)).alias("offset"),
    )
    classes = materialize(classes, "context-classes")
    sizes = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts"))
    sized = classes.join(sizes, "anchor")
    solved = (
        sized.filter(F.col("contexts").between(2, TOGETHER))
        .select("anchor", "context", "bytes", "count", "offset")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_sorted_groups(length), "anchor long, context long, low long, high long")
    )
    # anchors with more contexts than one task should sort: each window by itself
    single = sized.filter(F.col("contexts") > TOGETHER).select(
        "anchor", "context", "bytes", "offset", F.explode(F.expr("sequence(0, int(count) - 1)")).alias("w")
    )
    piece = F.sha2(F.expr(f"substring(bytes, w + 1, {length})"), 256)
    windows = single.select("anchor", "context", "w", F.xxhash64("anchor", F.col("offset") - F.col("w")).alias("k"), piece.alias("piece"))
    twice = windows.groupBy("k", "piece").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counted = windows.join(twice, ["k", "piece"]).select(
        "anchor", "context", F.col("w").cast("long").alias("low"), F.col("w").cast("long").alias("high")
    )
    whole = classes.filter("n > 1").select(
        "anchor", "context", F.lit(0).cast("long").alias("low"), (F.col("count") - 1).alias("high")
    )
    repeats = solved.union(counted).union(whole)
    first = F.shiftright("place", 24)
    partly = (
        surroundings.select("digest", "check", "anchor", "context", "place")
        .join(repeats, ["anchor", "context"])
        .select("digest", "check", (first + F.col("low")).alias("start"), (first + F.col("high") + length).alias("stop"))
    )
    return alike.union(partly)


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: texts without the bytes of strings of ``length`` that start elsewhere too.

    Every byte that lies in such a string is removed, in all its copies, in the same document too;
    strings are those of the input and never cross documents. ``spans`` are the maximal removed byte
    ranges in order, ``kept`` the remaining bytes, which need not be valid UTF-8. A null text
    counts as empty; texts shorter than ``length`` keep all bytes. Repeated rows are copies of each other: a text of
    ``length`` bytes or more goes wholly in all of them. Null
    ids are kept as they are, other columns are left out. ``length`` may be 2 to 4000.

    Equal windows have equal anchors, so anchors with a hash of their own are done with at
    once, and so are those whose whole surroundings are equal everywhere. For the others the bytes
    around them are fetched, and each distinct context is sorted once; see ``repeated_windows``.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # id and text by 128 bits, as many rows may share an id or have none
    whole = F.sha2("text", 256)
    texts = texts.withColumns({"digest": F.xxhash64("doc_id", whole), "check": F.xxhash64(F.lit(1), "doc_id", whole)})
    long = texts.filter(F.octet_length("text") >= length).drop("doc_id")
    # rows that repeat id and text: every string of theirs starts elsewhere too, and one of them stands for all beside the others
    again = long.groupBy("digest", "check").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "check")
    again = small_side(again)
    repeated = long.join(again, ["digest", "check"], "left_semi").dropDuplicates(["digest", "check"])
    others = long.join(again, ["digest", "check"], "left_anti")
    entire = repeated.select(
        "digest", "check", F.lit(0).cast("long").alias("start"), F.octet_length("text").cast("long").alias("stop")
    )
    spans = (
        repeated_spans(others.unionByName(repeated), length)
        .union(entire)
        .groupBy("digest", "check")
        .agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    )
    joined = texts.join(spans, ["digest", "check"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            sizes, spans_of, kept = [], [], []
            for value, ranges in zip(
                block.column("text").to_pylist(), block.column("ranges").to_pylist(), strict=True
            ):
                data = np.frombuffer(value.encode(), np.uint8)
                steps = np.zeros(len(data) + 1, np.int64)
                for r in ranges or ():
                    steps[r["start"]] += 1
                    steps[r["stop"]] -= 1
                gone = np.cumsum(steps) > 0
                edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                sizes.append(len(data))
                spans_of.append([{"start": a, "stop": b} for a, b in edges.reshape(-1, 2).tolist()])
                kept.append(data[~gone[:-1]].tobytes())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans_of, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    return joined.select("doc_id", "text", "ranges").mapInArrow(
        run, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"
    )

"""Byte-level BPE by ranks: encoding in padded matrices, and decoding."""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from logweave.llm.blocks import mixed, text_blocks, worker_state

NONE = np.int32(2**31 - 1)
# pieces that a worker remembers, rows that are merged together, and the longest row of a matrix: a round moves the whole
# row, so the work of a row grows by the square of its length
REMEMBERED, ROWS, LONGEST = 150_000, 16_384, 512


class PairTable:
    """Rank of the token that two adjacent tokens make, looked up by an open-addressing hash table."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, made = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(rank)
        keys = self._key(np.array(left, np.int64), np.array(right, np.int64))
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, NONE, np.int32)
        values, slots = np.array(made, np.int32), self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] == np.uint64(2**64 - 1))
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            self.keys[slots[placed]], self.values[slots[placed]] = keys[placed], values[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where the two don't merge."""
        keys = self._key(left, right)
        slots = self._slot(keys)
        found = self.values[slots].copy()
        there = self.keys[slots]
        wrong = there != keys
        found[wrong] = NONE
        look = np.flatnonzero(wrong & (there != np.uint64(2**64 - 1)))
        while len(look):  # another pair lies in the slot: go on from slot to slot
            slots[look] = (slots[look] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slots[look]]
            hit = look[there == keys[look]]
            found[hit] = self.values[slots[hit]]
            look = look[(there != keys[look]) & (there != np.uint64(2**64 - 1))]
        return found


class Encoder:
    """Pieces of a text to ids and back. Every byte must have a rank of its own."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.whole = ranks
        self.find = regex.compile(pattern).findall
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.known: dict[str, bytes] = {}
        self.pair_ranks: dict[int, int] = {}

    def merge_rows(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of similar length, one matrix row each.

        In each round every row merges its leftmost pair of minimum rank and moves what
        follows one place to the left; rows without a pair leave the matrix.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(lengths.max())
        cols = np.arange(width)
        inside = cols < lengths[:, None]
        ids = np.zeros((len(pieces), width), np.int32)
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full((len(pieces), width), NONE, np.int32)
        row, col = np.nonzero(inside[:, 1:])
        ranks[row, col] = self.pairs.ranks(ids[row, col], ids[row, col + 1])
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        place = np.arange(len(pieces))
        while len(place):
            at = ranks.argmin(axis=1)
            every = np.arange(len(place))
            best = ranks[every, at]
            done = best == NONE
            for r in np.flatnonzero(done):
                out[place[r]] = ids[r, : lengths[r]].copy()
            go = ~done
            if not go.any():
                break
            ids, ranks, lengths, place = ids[go], ranks[go], lengths[go], place[go]
            at, best, every = at[go], best[go], np.arange(len(place))
            lengths -= 1
            width = int(lengths.max())
            source = cols[:width] + (cols[:width] > at[:, None])
            ids = np.take_along_axis(ids, source, axis=1)
            ranks = np.take_along_axis(ranks, source, axis=1)
            ids[every, at] = best
            has_left, has_right = at > 0, at + 1 < lengths
            ranks[every, at] = NONE
            r, c = every[has_left], at[has_left]
            ranks[r, c - 1] = self.pairs.ranks(ids[r, c - 1], ids[r, c])
            r, c = every[has_right], at[has_right]
            ranks[r, c] = self.pairs.ranks(ids[r, c], ids[r, c + 1])
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece, by the same rule: the leftmost pair of minimum rank is merged next.

        Pairs wait in a heap by rank and place, tokens are linked to their neighbours. A merge looks up the two pairs it
        makes; a pair that is gone or has changed is passed over when it comes up. Work grows with
        n log n, memory is about 60 bytes for each byte of the piece.
        """
        if not self.pair_ranks:
            there = self.pairs.keys != np.uint64(2**64 - 1)
            self.pair_ranks = dict(zip(self.pairs.keys[there].tolist(), self.pairs.values[there].tolist(), strict=True))
        rank_of = self.pair_ranks.get
        start = self.byte_ids[np.frombuffer(piece, np.uint8)]
        ranks = self.pairs.ranks(start[:-1], start[1:])
        at = np.flatnonzero(ranks != NONE)
        heap = ((ranks[at].astype(np.int64) << 32) | at).tolist()
        heapq.heapify(heap)
        n = len(start)
        ids = array("i", start.tobytes())
        # rank of the pair that begins at a place, -1 if it does not merge or no token begins there
        now = array("i", np.append(np.where(ranks == NONE, -1, ranks), -1).astype(np.int32).tobytes())
        left, right = array("q", range(-1, n - 1)), array("q", range(1, n + 1))
        alive = bytearray(b"\x01") * n
        while heap:
            top = heapq.heappop(heap)
            rank, i = top >> 32, top & 0xFFFFFFFF
            if now[i] != rank:
                continue
            j = right[i]
            k = right[j]
            alive[j], now[j], now[i] = 0, -1, -1
            ids[i], right[i] = rank, k
            if k < n:
                left[k] = i
                made = rank_of(rank << 32 | ids[k])
                if made is not None:
                    now[i] = made
                    heapq.heappush(heap, made << 32 | i)
            h = left[i]
            if h >= 0:
                made = rank_of(ids[h] << 32 | rank)
                now[h] = -1 if made is None else made
                if made is not None:
                    heapq.heappush(heap, made << 32 | h)
        return np.frombuffer(ids, np.int32)[np.frombuffer(alive, bool)]

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode the pieces that aren't known yet, in buckets of doubling length."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            if piece not in self.known:
                data = piece.encode()
                rank = self.whole.get(data)
                if rank is not None:
                    self.known[piece] = rank.to_bytes(4, "little")
                elif len(data) > LONGEST:
                    self.known[piece] = self.merge_long(data).astype("<u4").tobytes()
                else:
                    buckets.setdefault((len(data) - 1).bit_length(), []).append((piece, data))
        for rows in buckets.values():
            for start in range(0, len(rows), ROWS):
                part = rows[start : start + ROWS]
                merged = self.merge_rows([data for _, data in part])
                self.known.update((piece, ids.astype("<u4").tobytes()) for (piece, _), ids in zip(part, merged, strict=True))

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        pieces = [self.find(text) for text in texts]
        self.learn(set(chain.from_iterable(pieces)))
        return [b"".join(map(self.known.__getitem__, found)) for found in pieces]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def load_encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Encoder(ranks, pattern)


def encode_texts(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: whole texts as ids, and the bytes that these decode to.

    ``ids`` holds little-endian unsigned 32-bit numbers. Every match of ``pattern`` is encoded by itself, a match that
    is a token as a whole as that token; there are no special tokens. A null text counts as
    empty and gives no ids; null and repeated document ids are kept as they are, other columns are left out. Distinct
    matches are encoded once per block of texts and then remembered, up to a bound, by the worker.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(load_encoder, path, pattern)
        for block in text_blocks(batches, text_col):
            ids = encoder.encode_block([text or "" for text in block.column(text_col).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(id_col),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([encoder.decode(x) for x in ids], pa.binary()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    schema = f"doc_id {id_type}, n_tokens long, ids binary, decoded binary"
    return docs.select(id_col, text_col).mapInArrow(encode, schema)

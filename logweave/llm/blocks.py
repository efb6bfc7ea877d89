"""Arrow batches cut into blocks of bounded size, and 64-bit mixing, shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20

# the word separators of every operator that counts or shingles words: blank and \t \n \v \f \r
WORD = r"[^\x20\x09-\x0D]+"


_state: dict = {}


def worker_state(make: Callable, *args):
    """What ``make(*args)`` returns, kept by a Python worker until it needs another one.

    Workers outlive stages, so remembered tables of several operators would add up.
    """
    if (make, args) not in _state:
        _state.clear()
        _state[make, args] = make(*args)
    return _state[make, args]


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices whose texts have ``limit`` bytes in all; a longer text is alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, used = 0, 0
        for row, size in enumerate(sizes):
            if used and used + size > limit:
                yield batch.slice(start, row - start)
                start, used = row, 0
            used += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which every bit depends on all others."""
    values = np.asarray(values, np.uint64)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        values = (values ^ (values >> np.uint64(33))) * np.uint64(factor)
    return values ^ (values >> np.uint64(33))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_ids(
    df: DataFrame, ids: DataFrame, column: str | list[str], how: str = "left_semi", largest: int = 500_000
) -> DataFrame:
    """The rows of ``df`` whose ``column`` is among ``ids`` (that column, or these), or is not (``left_anti``).

    ``ids`` should be written to storage, as up to ``largest`` of them are counted first and then
    broadcast, so the rows stay where they are; more are joined by a shuffle.
    """
    if ids.limit(largest + 1).count() <= largest:
        ids = F.broadcast(ids)
    return df.join(ids, column, how)


def text_digest(text: Column) -> Column:
    """128 bits of a text, a null one being empty; ``hashlib.md5`` of its UTF-8 bytes gives the same."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Complete groups of equal ``column`` from batches that are sorted by it."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            if kept and kept[-1].column(column)[0].as_py() != keys[start]:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch.slice(start, stop - start))
    if kept:
        yield pa.Table.from_batches(kept)

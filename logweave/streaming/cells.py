"""Delivery metrics of a stream that late attempts still reach, and that roll up to longer windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from logweave.operators.metrics import ACCURACY, CELL_COUNTS, merge_cells, metric_cells
from logweave.session import drop_table
from logweave.sinks import batches
from logweave.sinks.batches import commit_batch, last_batch, read_one_batch, stage_batch
from logweave.streaming.run import for_each_batch

# Parts of a generation that become one of the next.
FANOUT = 8
PARTITION = (T.StructField("partition", T.IntegerType()),)


def cells_stream(
    attempts: DataFrame,
    root: str,
    checkpoint: str,
    every: str = "1 minute",
    by: Sequence[str] = ("partition",),
    accuracy: float = ACCURACY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep ``metric_cells`` of all attempts, however late they come; nothing is held in a state store.

    A micro-batch adds the cells of its own attempts. Every eighth one adds up those of eight, every 64th the sums of eight
    such, and so on: a reader opens at most seven parts of each generation, and a cell is
    written once per generation.
    """
    schema = cell_schema([attempts.schema[c] for c in by])

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cells = metric_cells(batch, every, by, accuracy).select(*schema.fieldNames())
        stage_batch(cells, root, batch_id, _part(0))
        for generation in _ending_at(batch_id):
            parts = [
                read_one_batch(spark, root, schema, at, _part(generation - 1)) for at in _merged(batch_id, generation)
            ]
            stage_batch(merge_cells(_union(parts), None, by).select(*schema.fieldNames()), root, batch_id, _part(generation))
        commit_batch(spark, root, batch_id)
        # what was merged stays for a while, for readers and reruns that have begun
        old = batch_id - batches.KEPT_STATES
        for generation in _ending_at(old):
            for at in _merged(old, generation):
                drop_table(spark, f"{root}/{_part(generation - 1)}/batch_id={at}")

    return for_each_batch(attempts, step, root, checkpoint, trigger)


def read_cells(
    spark: SparkSession, root: str, by: Sequence[T.StructField] = PARTITION, every: str | None = None
) -> DataFrame:
    """Cells of all committed micro-batches, added up; ``every`` makes windows longer, ``by`` are the fields of the groups."""
    schema, last = cell_schema(by), last_batch(spark, root)
    held = [] if last is None else parts_until(last)
    parts = [read_one_batch(spark, root, schema, at, _part(generation)) for generation, at in held]
    return merge_cells(_union(parts or [spark.createDataFrame([], schema)]), every, [f.name for f in by])


def cell_schema(by: Sequence[T.StructField]) -> T.StructType:
    """Fields of cells whose groups have the fields ``by``."""
    counts = [T.StructField(c, T.DoubleType() if c == "latency_sum" else T.LongType()) for c in CELL_COUNTS]
    return T.StructType([T.StructField("window_start_ms", T.LongType()), *by, T.StructField("cell", T.LongType()), *counts])


def parts_until(last: int) -> list[tuple[int, int]]:
    """Generation and last micro-batch of the parts that together hold micro-batches 0 to ``last``, fewest of them."""
    held, done, generation = [], 0, 0
    while FANOUT ** (generation + 1) <= last + 1:
        generation += 1
    for g in range(generation, -1, -1):
        while done + FANOUT**g <= last + 1:
            done += FANOUT**g
            held.append((g, done - 1))
    return held


def _ending_at(batch_id: int) -> Iterator[int]:
    """Generations, from 1, of which a part ends with this micro-batch."""
    generation = 1
    while batch_id >= 0 and (batch_id + 1) % FANOUT**generation == 0:
        yield generation
        generation += 1


def _merged(batch_id: int, generation: int) -> list[int]:
    """Last micro-batches of the parts that a part of ``generation`` is made of."""
    return [batch_id - i * FANOUT ** (generation - 1) for i in range(FANOUT - 1, -1, -1)]


def _part(generation: int) -> str:
    return f"cells{generation}"


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole

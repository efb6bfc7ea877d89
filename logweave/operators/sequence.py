"""Dense sequence numbers and fixed-size chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logweave.functions.headers import SEQUENCE_HEADER, header_array
from logweave.session import materialize, small_side


def stamp_sequence(
    df: DataFrame, order: list[str], by: list[str] | None = None, into: str = "seq", start: int = 0
) -> DataFrame:
    """Number rows ``start, start + 1, ...`` in ``order`` within ``by`` (or overall).

    Rows are range-partitioned on ``by`` and ``order`` and sorted inside each partition, so a
    large group spreads over many tasks. A row's number is its place in its partition plus the
    rows of its group in earlier partitions. The placed rows are written once, because places and
    counts must come from one and the same partitioning. ``order`` has to be unique within ``by``.
    """
    by = by or []
    keys = [*by, *order]
    placed = materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()),
        "placed",
    )
    # the identifier counts rows in its low 33 bits and holds the partition above them
    run = F.shiftright("_place", 33)
    earlier = Window.partitionBy(*by).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy(*by, run.alias("_run"))
        .agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .select(*[F.col(c).alias(f"_by_{c}") for c in by], "_run", "_first", "_before")
    )
    same = run == F.col("_run")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    number = F.col("_place") - F.col("_first") + F.col("_before") + F.lit(start)
    return placed.join(small_side(runs), same).select(*df.columns, number.alias(into))


def numbered_messages(
    df: DataFrame, order: list[str], at: Column, by: list[str] | None = None, producer: str = "logweave"
) -> DataFrame:
    """Number rows, and add the sequence header and the text ``Message #n at <UTC time>``."""
    stamped = stamp_sequence(df, order, by)
    text = F.concat(
        F.lit("Message #"), F.col("seq").cast("string"), F.lit(" at "),
        F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.lit("Z"),
    )
    headers = {"producer": producer, "machine": "localhost", SEQUENCE_HEADER: F.col("seq").cast("string")}
    return stamped.withColumns({"value": text.cast("binary"), "headers": header_array(headers)})


def chunk(df: DataFrame, order: list[str], size: int = 10, by: list[str] | None = None) -> DataFrame:
    """Add ``chunk``: rows in ``order``, ``size`` to a chunk, none lost."""
    stamped = stamp_sequence(df, order, by, "_seq")
    return stamped.withColumn("chunk", F.expr(f"_seq div {int(size)}")).drop("_seq")

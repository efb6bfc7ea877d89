"""Message headers: an ordered list in which a name may occur more than once."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEQUENCE_HEADER = "sequenceId"


def header_last(headers: Column | str, name: str) -> Column:
    """Bytes of the last header called ``name``; null when there is none."""
    column = F.col(headers) if isinstance(headers, str) else headers
    hits = F.filter(column, lambda h: h["key"] == F.lit(name))
    return F.try_element_at(hits, F.lit(-1))["value"]


def sequence_id(headers: Column | str = "headers") -> Column:
    """The sequence header as BIGINT; text beyond 32 bits or not a number is null."""
    return header_last(headers, SEQUENCE_HEADER).cast("string").try_cast("int").cast("bigint")


def sequence_error(headers: Column | str = "headers") -> Column:
    """Why :func:`sequence_id` is null: header absent, or not a 32-bit number."""
    return F.when(header_last(headers, SEQUENCE_HEADER).isNull(), "missing_header").when(
        sequence_id(headers).isNull(), "bad_sequence_id"
    )


def header_array(headers: dict[str, Column | str]) -> Column:
    """Header list in the given order; plain strings become literals."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("key"),
                (F.lit(v) if isinstance(v, str) else v).cast("string").cast("binary").alias("value"),
            )
            for name, v in headers.items()
        ]
    )

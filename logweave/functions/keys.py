"""Message keys: partition from a key's suffix, and 64-bit integer keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def partition_by_suffix(key: Column | str, partitions: int) -> Column:
    """Last space-separated token of the UTF-8 key, as a number, modulo ``partitions``.

    Null for keys without such a number and for negative ones, which name no partition.
    """
    number = F.element_at(F.split(_column(key).cast("string"), " "), -1).try_cast("int")
    return F.when(number >= 0, number % F.lit(partitions))


def partition_error(key: Column | str) -> Column:
    """Why :func:`partition_by_suffix` is null; null for a usable key."""
    number = F.element_at(F.split(_column(key).cast("string"), " "), -1).try_cast("int")
    return (
        F.when(_column(key).isNull(), "null_key")
        .when(number.isNull(), "no_key_number")
        .when(number < 0, "negative_key_number")
    )


def encode_int64(value: Column | str) -> Column:
    """Eight big-endian bytes of a BIGINT."""
    return F.unhex(F.lpad(F.hex(_column(value).cast("bigint")), 16, "0"))


def decode_int64(key: Column | str) -> Column:
    """BIGINT held in eight big-endian bytes; null for any other length."""
    column = _column(key)
    return F.when(
        F.octet_length(column) == 8, F.conv(F.hex(column), 16, -10).cast("bigint")
    )

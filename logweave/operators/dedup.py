"""Removing redelivered messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _has_key(key: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])


def null_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows without a usable key, with ``_error``; they can be neither new nor duplicate."""
    return df.filter(~_has_key(key)).withColumn("_error", F.lit("null_key"))


def dedup_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First arrival of every key; ``order`` says what arrived first. Rows without a key are left out.

    Every task reduces its rows to one per key before the shuffle.
    """
    keyed = df.filter(_has_key(key))
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return keyed.distinct()
    return (
        keyed.groupBy(*key)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*[F.col(c) if c in key else F.col(f"_row.`{c}`").alias(c) for c in df.columns])
    )


def duplicates(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """All later arrivals, the rows ``dedup_first`` leaves out; ``order`` is unique within a key.

    The first arrivals are found by an aggregate and removed by key and order together, so the
    copies of one key spread over all tasks.
    """
    keyed = df.filter(_has_key(key))
    names = [f"_o{i}" for i in range(len(order))]
    first = (
        keyed.groupBy(*key)
        .agg(F.min(F.struct(*[F.col(c).alias(n) for c, n in zip(order, names)])).alias("_first"))
        .select(*key, *[F.col(f"_first.{n}").alias(c) for n, c in zip(names, order)])
    )
    return keyed.join(first, [*key, *[c for c in order if c not in key]], "left_anti")


def new_only(df: DataFrame, ledger: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key the ledger does not hold."""
    return df.join(ledger.select(*key), key, "left_anti")

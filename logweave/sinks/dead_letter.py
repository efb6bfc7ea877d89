"""Dead letters: rows that failed for good."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def dead_letters(
    df: DataFrame,
    error: str = "_error",
    attempts: Column | int = 1,
    failed_at: Column | None = None,
) -> DataFrame:
    """Rows with an error, as ``error, attempts, failed_at`` plus their own columns."""
    tries = F.lit(attempts) if isinstance(attempts, int) else attempts
    return (
        df.filter(F.col(error).isNotNull())
        .withColumns(
            {
                "error": F.col(error),
                "attempts": tries,
                "failed_at": F.current_timestamp() if failed_at is None else failed_at,
            }
        )
        .drop(*([error] if error != "error" else []))
    )


def split_dlq(
    df: DataFrame,
    error: str = "_error",
    attempts: Column | int = 1,
    failed_at: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good rows without the error column, dead letters).

    Both sides are plain filters, so one job that writes both should go through
    ``write_outcomes``, which reads the input once.
    """
    good = df.filter(F.col(error).isNull()).drop(error)
    return good, dead_letters(df, error, attempts, failed_at)


def write_outcomes(df: DataFrame, path: str, error: str = "_error") -> None:
    """Append good and bad rows in one pass, below ``outcome=ok`` and ``outcome=dead``."""
    outcome = F.when(F.col(error).isNull(), "ok").otherwise("dead")
    df.withColumn("outcome", outcome).write.mode("append").partitionBy("outcome").parquet(path)

"""Adding columns to a table that already has rows."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, functions as F


def evolve(old: DataFrame, new: DataFrame, defaults: dict[str, Any] | None = None) -> DataFrame:
    """Old and new rows under the new layout; columns the old rows lack get their default, or null."""
    defaults = defaults or {}
    missing = {
        f.name: F.lit(defaults.get(f.name)).cast(f.dataType)
        for f in new.schema.fields
        if f.name not in old.columns
    }
    widened = old.withColumns(missing) if missing else old
    return widened.unionByName(new, allowMissingColumns=True)

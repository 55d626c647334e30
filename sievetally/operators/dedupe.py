"""Deduplication by business key with a survivor that does not depend on layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), copies: str | None = None
) -> DataFrame:
    """One row per key: the smallest by `order`, then by every remaining column.

    Written as min(struct) instead of row_number, because the minimum is also taken before the
    shuffle: a task sends one row per key however many copies it read, so a key that holds a
    third of all rows costs the receiving task one row per sending task. Rows with a null key
    form one group, as in dropDuplicates. `copies` names a column that counts the rows of a key.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [c for c in order if c not in keys] + rest
    aggregates = []
    if ranked:
        aggregates.append(F.min(F.struct(*ranked)).alias("_first"))
    if copies:
        aggregates.append(F.count("*").alias(copies))
    if not aggregates:
        return df.dropDuplicates(list(keys))
    best = df.groupBy(*keys).agg(*aggregates)
    columns = [F.col(c) if c in keys else F.col(f"_first.{c}") for c in df.columns]
    return best.select(*columns, *([copies] if copies else []))

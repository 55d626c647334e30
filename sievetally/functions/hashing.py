"""Repeatable pseudo-random values from an id: the same on every partitioning and every retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(row_id: Column, label: str, size: int) -> Column:
    """Integer in [0, size), independent for every label."""
    digest = F.md5(F.concat(row_id.cast("string"), F.lit(f"|{label}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % size


def pick(row_id: Column, label: str, values: list[str | None]) -> Column:
    choices = F.array(*[F.lit(value).cast("string") for value in values])
    return F.get(choices, draw(row_id, label, len(values)).cast("int"))


def uuid_text(row_id: Column, label: str) -> Column:
    """The md5 of the id, written in the 8-4-4-4-12 form of a UUID."""
    digest = F.md5(F.concat(row_id.cast("string"), F.lit(f"|{label}")))
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in parts])

"""Terms of UTF-8 texts, and bounded marks of rows that a second scan is to look at."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievetally.llm.common import SLICE_CHARS

# Runs of ASCII letters (and digits) and of all characters beyond ASCII, as bytes of UTF-8.
LETTERS_AND_DIGITS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
LETTERS = re.compile(rb"[A-Za-z\x80-\xff]+")


def term_runs(text: bytes | None, terms: re.Pattern) -> Iterator[list[bytes]]:
    """All maximal runs of `terms` in a text, A-Z in lower case; none for a null text.

    A very long text is read in slices that end where a run ends.
    """
    start = 0
    while text and start < len(text):
        stop = start + SLICE_CHARS
        if stop < len(text) and (run := terms.match(text, stop)):
            stop = run.end()
        yield terms.findall(text[start:stop].lower())
        start = stop


def term_counts(text: bytes | None, terms: re.Pattern) -> Counter:
    """How often each run stands in a text."""
    counts = Counter()
    for runs in term_runs(text, terms):
        counts.update(runs)
    return counts


def mark_table(hashes: DataFrame, bits: int, **conditions: str) -> DataFrame:
    """(bucket, one bitmap for each condition): marks of the long column `hash` of the rows that satisfy the condition.

    At most bits / 32,768 rows of 4 KB for each condition, however many hashes there are.
    """
    placed = hashes.withColumn("place", F.expr(f"pmod(hash, {bits}L) + 1")).withColumn("bucket", F.expr("bitmap_bucket_number(place)"))
    return placed.groupBy("bucket").agg(*(F.expr(f"bitmap_construct_agg(bitmap_bit_position(place)) FILTER (WHERE {c})").alias(name) for name, c in conditions.items()))


def with_marks(rows: DataFrame, marks: DataFrame, bits: int) -> DataFrame:
    """rows, which have a long column `hash`, each beside the bitmaps of its bucket; the bitmaps, of bounded size, are broadcast."""
    rows = rows.withColumn("place", F.expr(f"pmod(hash, {bits}L) + 1"))
    return rows.withColumn("bucket", F.expr("bitmap_bucket_number(place)")).join(F.broadcast(marks), "bucket", "left").withColumn("place", F.expr("bitmap_bit_position(place)"))


def marked(bitmap: str) -> Column:
    """Whether a row of with_marks() is marked in a bitmap: certain for hashes that were marked, and possible for others."""
    byte = f"conv(hex(substring({bitmap}, CAST(place DIV 8 AS INT) + 1, 1)), 16, 10)"
    return F.expr(f"{bitmap} IS NOT NULL AND getbit(CAST({byte} AS BIGINT), CAST(place % 8 AS INT)) = 1")

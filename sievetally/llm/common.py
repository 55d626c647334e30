"""What several operators share: batch sizes, files on shared storage, fixed hashing of ids."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievetally.session import pin_settings, size_partitions

BATCH_ROWS = 500
BATCH_BYTES = 16 * 1024 * 1024
# Of a very long text, words are held for so many characters at a time.
SLICE_CHARS = 1 << 20
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with small Arrow batches, as texts may be long."""
    small_batches(pin_settings(spark))
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    size_partitions(spark, df)
    return df


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows or about BATCH_BYTES."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def as_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no name of theirs can clash with those of an operator; see from_row()."""
    return F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in df.columns))


def from_row(rows: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The struct `row` of rows as columns again, some of them replaced."""
    return rows.select(*(replaced.get(c, F.col("row").getField(c)).alias(c) for c in columns))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def sample_of(rows: DataFrame, id_col: str, size: int) -> DataFrame:
    """One row (id_col, and the least of all other columns) for each of about `size` ids, chosen by a hash of the id; all ids where there are fewer.

    The share to keep follows from an estimate of the distinct ids, so no task and no driver sorts or holds
    more than the sample, and repeated ids are reduced before the shuffle.
    """
    total = rows.agg(F.approx_count_distinct(id_col, 0.01)).first()[0]
    if total > size:
        rows = rows.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < int((1 << 30) * size / total))
    others = [c for c in rows.columns if c != id_col]
    return rows.groupBy(id_col).agg(F.min(F.struct(*others)).alias("least")).select(id_col, *(f"least.{c}" for c in others))


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """A text in parts of at most `size` characters, cut at blanks, so that no word is in two parts; a longer word is one part."""
    start = 0
    while len(text) - start > size:
        stop = max(text.rfind(c, start + 1, start + size) for c in BLANKS)
        if stop < 0:
            stop = min((at for c in BLANKS if (at := text.find(c, start + size)) >= 0), default=len(text))
        yield text[start:stop]
        start = stop
    yield text[start:]


def spread(key: Column, groups: int) -> Column:
    """A group number from 0 that depends on key alone."""
    return F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")


def task_count(spark: SparkSession) -> int:
    """Partitions for work whose cost does not follow its bytes: more than for plain shuffles, and not merged by size."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def release_memory() -> None:
    """At the end of a task: give Arrow's unused memory back, as workers stay and executors count theirs too."""
    pa.default_memory_pool().release_unused()


def qualified(spark: SparkSession, path: str) -> str:
    """path with the scheme that Spark would give it, so that executors and Spark mean the same place."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return str(folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder))


def storage(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a qualified URI, usable in tasks."""
    uri = re.sub(r"^file:/(?!/)", "file:///", re.sub(r"^s3[an]://", "s3://", uri))
    return pafs.FileSystem.from_uri(uri)


def open_new(uri: str) -> pa.NativeFile:
    """A new file for sequential writing; its folder is made where the storage has folders."""
    fs, path = storage(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    return fs.open_output_stream(path)


def open_range(uri: str) -> pa.NativeFile:
    """A file for reads of ranges."""
    fs, path = storage(uri)
    return fs.open_input_file(path)

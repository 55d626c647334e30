"""Readers for tables published with sinks.managed.

A table is a folder below a root. Its subfolder `versions` has one small file for each finished publish, numbered, that names the
folders which hold the table from then on. Readers follow the file with the highest number, so any process that
knows the root reads the same table, with or without a shared catalog.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievetally.schemas import RUN_LOG

VERSIONS = "versions"
# Data folders are named <this>=<run id>. Spark takes that for a partition column, which readers leave out.
RUN_FOLDER = "version_run"


def table_folder(table: str, root: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Hadoop objects."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def list_folder(spark: SparkSession, path: str) -> list:
    """Hadoop's status of everything in a folder; nothing where there is no such folder."""
    fs, place = hadoop_path(spark, path)
    return list(fs.listStatus(place)) if fs.exists(place) else []


def version_numbers(spark: SparkSession, table: str, root: str) -> list[int]:
    """Numbers of the versions on record, oldest first."""
    names = [s.getPath().getName() for s in list_folder(spark, f"{table_folder(table, root)}/{VERSIONS}")]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def read_version(spark: SparkSession, table: str, root: str, number: int) -> dict:
    fs, place = hadoop_path(spark, f"{table_folder(table, root)}/{VERSIONS}/{number:012d}.json")
    stream = fs.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def newest_version(spark: SparkSession, table: str, root: str) -> dict | None:
    """The record of the last finished publish; None if there was none."""
    numbers = version_numbers(spark, table, root)
    return read_version(spark, table, root, numbers[-1]) if numbers else None


def history(spark: SparkSession, table: str, root: str, fmt: str = "parquet") -> DataFrame:
    """Publishes of the table, newest first: the records that readers follow, as far as they are kept."""
    folder = table_folder(table, root)
    if fmt == "delta":
        return spark.sql(f"DESCRIBE HISTORY delta.`{folder}`")
    if not version_numbers(spark, table, root):
        raise FileNotFoundError(f"{table} was never published below {root}")
    log = spark.read.schema(RUN_LOG).json(f"{folder}/{VERSIONS}/*.json")
    return log.orderBy(F.desc("version"))


def is_published(spark: SparkSession, table: str, root: str, fmt: str = "parquet") -> bool:
    if fmt == "delta":
        fs, place = hadoop_path(spark, f"{table_folder(table, root)}/_delta_log")
        return fs.exists(place)
    return bool(version_numbers(spark, table, root))


def read_record(spark: SparkSession, table: str, root: str, record: dict) -> DataFrame:
    """The table as a version's record has it, in its declared schema."""
    folder, schema = table_folder(table, root), StructType.fromJson(json.loads(record["schema"]))
    if not record["folders"]:
        return spark.createDataFrame([], schema)
    reader = spark.read.format(record["format"]).schema(schema).option("basePath", folder)
    return reader.load([f"{folder}/{f}" for f in record["folders"]]).select(*schema.names)


def read_managed(spark: SparkSession, table: str, root: str, fmt: str = "parquet", as_of: datetime | None = None) -> DataFrame:
    """The table as of its last finished publish, or of the last one up to as_of; a publish under way is not seen.

    Columns have their declared types, also where they are partition folders. Later publishes do not change what was opened.
    """
    if fmt == "delta":
        reader = spark.read.format("delta")
        return (reader.option("timestampAsOf", as_of.isoformat()) if as_of else reader).load(table_folder(table, root))
    numbers = version_numbers(spark, table, root)
    for number in reversed(numbers):
        record = read_version(spark, table, root, number)
        if as_of is None or datetime.fromisoformat(record["committed_at"]) <= as_of:
            return read_record(spark, table, root, record)
    raise FileNotFoundError(f"{table} was never published below {root}" + (f" up to {as_of}" if numbers else ""))


def source_available(df: DataFrame, name: str) -> DataFrame:
    """One row (source, available, has_rows) of a table that could be opened; an empty one is available.

    One row is read at most, so the check costs the same on any size.
    """
    first = df.select(F.lit(1).alias("one")).limit(1).agg(F.count("one").alias("n"))
    return first.select(F.lit(name).alias("source"), F.lit(True).alias("available"), (F.col("n") > 0).alias("has_rows"))

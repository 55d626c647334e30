"""Session settings, shuffle sizing and the shared scratch folder."""

from __future__ import annotations

import atexit
import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MB = 1024 * 1024

# File bytes per shuffle partition. Decoded rows take a few times the size of their Parquet file.
SHUFFLE_BYTES = 256 * MB
# Every map task keeps a size per shuffle partition, so both counts need an end: with these, 100 TB
# are 100,000 scan tasks of 1 GB and 32,768 shuffle partitions of at most 3 GB, sorted with spill.
# They bound sizes of tasks, never rows; settings of the session or arguments replace them.
MAX_SHUFFLE_PARTITIONS = 32768
MAX_SCAN_TASKS = 100_000
MAX_SCAN_BYTES = 1024 * MB
_scratch_roots: dict[str, str] = {}
SIZED = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
# Spark reports about this size for a source it knows nothing about.
UNKNOWN_SIZE = 2**62

PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
}


def build_session(app_name: str = "sievetally", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**PINNED, **conf}.items():
        builder = builder.config(key, value)
    return pin_settings(builder.getOrCreate())


def pin_settings(spark: SparkSession) -> SparkSession:
    """Calendar days follow UTC and bad casts raise, whoever built the session."""
    for key, value in PINNED.items():
        spark.conf.set(key, value)
    return spark


def plan_bytes(df: DataFrame) -> int:
    """Spark's estimate of the size of df; for a file scan, the size of the files."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < UNKNOWN_SIZE else 0


def byte_count(text: str) -> int:
    """Bytes of a Spark size setting such as 134217728b, 128MB or 1g."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", text.strip().lower()).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


def size_partitions(
    spark: SparkSession,
    *inputs: DataFrame,
    max_partitions: int | None = None,
    max_scan_tasks: int | None = None,
    max_scan_bytes: int | None = None,
) -> None:
    """Raise shuffle partition count and scan task size to fit the inputs; never lower them.

    The default of 200 partitions over 100 TB would be 500 GB each, and adaptive execution merges
    the partitions of an aggregation but does not split them. Too high a count costs little,
    because small partitions are merged at run time. The bounds may also be set on the session, as
    spark.sievetally.maxShufflePartitions, maxScanTasks and maxScanBytes.
    """

    def bound(given: int | None, key: str, default: int) -> int:
        return given or byte_count(str(spark.conf.get(f"spark.sievetally.{key}", str(default))))

    total = sum(plan_bytes(df) for df in inputs)
    partitions = min(math.ceil(total / SHUFFLE_BYTES), bound(max_partitions, "maxShufflePartitions", MAX_SHUFFLE_PARTITIONS))
    if partitions > int(spark.conf.get(SIZED[0])):
        spark.conf.set(SIZED[0], str(partitions))
    scan = min(total // bound(max_scan_tasks, "maxScanTasks", MAX_SCAN_TASKS), bound(max_scan_bytes, "maxScanBytes", MAX_SCAN_BYTES))
    if scan > byte_count(spark.conf.get(SIZED[1])):
        spark.conf.set(SIZED[1], str(scan))


@contextmanager
def sized_for(spark: SparkSession, *inputs: DataFrame, **bounds: int) -> Iterator[None]:
    """size_partitions for the length of a job; the session's own settings hold again afterwards."""
    before = {key: spark.conf.get(key) for key in SIZED}
    try:
        size_partitions(spark, *inputs, **bounds)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """The application's own folder in the place that every executor can see; removed when the driver ends.

    Clusters name the shared place in spark.checkpoint.dir. Only a local session, where driver
    and executors are one process, may fall back to a temporary folder of its own.
    """
    application = spark.sparkContext.applicationId
    if application not in _scratch_roots:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="run-")
        _scratch_roots[application] = f"{shared.rstrip('/')}/scratch-{application}"
        atexit.register(_delete, spark, _scratch_roots[application])
    return _scratch_roots[application]


def remove_scratch(spark: SparkSession) -> None:
    """Remove all scratch folders of the application; what was read from them can't be read any more."""
    root = _scratch_roots.pop(spark.sparkContext.applicationId, None)
    if root:
        _delete(spark, root)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below scratch_root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Compute df once into the shared folder and go on from the written files.

    Used where several actions follow: lost executors then re-read files instead of
    recomputing the whole pipeline.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_table(df: DataFrame, label: str = "cut") -> Iterator[DataFrame]:
    """cut_lineage for the length of a with block; its folder is removed afterwards."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)

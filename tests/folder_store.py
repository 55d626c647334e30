"""A stand-in for a serving store: upserts kept as Parquet files in a local folder."""

import os
import sys

from pyarrow import RecordBatch, Table, parquet
from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F

from sievetally.schemas import DAILY_KEY, SERVING_ROW

# Executors have no path to the tests.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FolderStore:
    """File names come from load, task and batch number, so a repeated task replaces its own files."""

    def __init__(self, folder: str, load: int):
        self.path = f"{folder.removeprefix('file:')}/load={load}"
        os.makedirs(self.path, exist_ok=True)
        self.task = TaskContext.get().partitionId()
        self.batch = 0

    def upsert(self, batch: RecordBatch) -> None:
        parquet.write_table(Table.from_batches([batch]), f"{self.path}/task-{self.task:05d}-{self.batch:05d}.parquet")
        self.batch += 1

    def close(self) -> None:
        pass


def read_folder_store(spark, folder):
    """What the store holds: per key the row of the latest load."""
    values = [c for c in SERVING_ROW.names if c not in DAILY_KEY]
    latest = spark.read.parquet(folder).groupBy(*DAILY_KEY).agg(F.max(F.struct("load", *values)).alias("row"))
    return latest.select(*DAILY_KEY, *[F.col(f"row.{c}") for c in values])

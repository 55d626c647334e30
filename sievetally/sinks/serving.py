"""Keyed upserts: into a served table by a merge, or into a serving store straight from the executors.

A store is any object with upsert(batch) for an Arrow record batch and close(). `connect` is a
function without arguments that opens one; it is sent to the executors and called once per task.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievetally.schemas import DAILY_KEY, SERVING_ROW
from sievetally.sinks.managed import upsert

SERVED = "customer_daily_served"

# The code below runs on the executors; sent by value, it needs no installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def serving_rows(df: DataFrame) -> DataFrame:
    """Daily totals in the types of the store; a count beyond 32 bits raises."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in SERVING_ROW])


def serving_layout(df: DataFrame, writers: int) -> DataFrame:
    """At most `writers` tasks, each with a contiguous run of customers, newest day first.

    Ranges over customer and day put every key into exactly one task, and unlike a hash of the
    customer they split a customer that holds much of the table.
    """
    order = [F.col("customer_id"), F.desc("transaction_date")]
    return df.repartitionByRange(writers, *order).sortWithinPartitions(*order)


def upsert_served(totals: DataFrame, root: str, fmt: str = "parquet") -> None:
    """Upsert daily totals by (customer_id, transaction_date) into the served table below root, a managed table with a folder per day.

    Days that are not in totals keep their files. Totals are computed twice: pass a written table.
    """
    upsert(serving_rows(totals), SERVED, root, DAILY_KEY, "transaction_date", fmt, SERVING_ROW)


def open_store(connect: Callable[[], object], tries: int, wait_seconds: float):
    for attempt in range(tries):
        try:
            return connect()
        except Exception as error:
            if attempt + 1 == tries:
                raise RuntimeError(f"serving store not reachable after {tries} tries") from error
            time.sleep(wait_seconds)


def load_serving(
    df: DataFrame,
    connect: Callable[[], object],
    writers: int | None = None,
    tries: int = 5,
    wait_seconds: float = 3.0,
) -> int:
    """Upsert daily totals by (customer_id, transaction_date); returns the number of rows sent.

    Rows reach the store in Arrow batches, and a task that runs again repeats the same upserts.
    Keys that are no longer in df stay in the store. `writers` bounds the tasks, and with them the connections;
    by default there are as many as shuffle partitions. df is computed twice, as the ranges of the tasks
    are found in a sample: pass a written table.
    """
    writers = writers or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, sent = None, 0
        try:
            for batch in batches:
                if batch.num_rows:
                    if store is None:
                        store = open_store(connect, tries, wait_seconds)
                    store.upsert(batch)
                    sent += batch.num_rows
        finally:
            if store is not None:
                store.close()
        yield pa.RecordBatch.from_pydict({"sent": [sent]})

    placed = serving_layout(serving_rows(df), writers)
    return placed.mapInArrow(write, "sent bigint").agg(F.coalesce(F.sum("sent"), F.lit(0))).head()[0]


class CqlStore:
    """A table of a wide-column database that speaks CQL; needs the cassandra-driver package."""

    def __init__(self, hosts: list[str], keyspace: str, table: str, port: int = 9042, concurrency: int = 100):
        from cassandra.cluster import Cluster

        self.concurrency = concurrency
        self.cluster = Cluster(hosts, port=port)
        try:
            self.session = self.cluster.connect(keyspace)
            columns = SERVING_ROW.names
            marks = ", ".join("?" for _ in columns)
            self.insert = self.session.prepare(f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({marks})")
        except Exception:
            self.cluster.shutdown()
            raise

    def upsert(self, batch: pa.RecordBatch) -> None:
        from cassandra.concurrent import execute_concurrent_with_args

        rows = [tuple(row.values()) for row in batch.to_pylist()]
        execute_concurrent_with_args(
            self.session, self.insert, rows, concurrency=self.concurrency, raise_on_first_error=True
        )

    def close(self) -> None:
        self.cluster.shutdown()

"""The transaction jobs: raw Parquet to a managed table, daily totals, serving store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievetally.functions.transactions import is_positive, transaction_date
from sievetally.operators import contracts
from sievetally.operators.dedupe import keep_first
from sievetally.operators.filters import keep_positive_amounts
from sievetally.operators.reports import stage_rows
from sievetally.operators.totals import total_by_customer_day
from sievetally.schemas import DAILY_KEY, DAILY_TOTAL, TRANSACTION_ORDER
from sievetally.session import pin_settings, sized_for
from sievetally.sinks.managed import publish, register_table
from sievetally.sinks.serving import load_serving, upsert_served
from sievetally.sources.managed import history, read_managed, source_available

TRANSACTIONS = "customer_transactions"
DAILY_TOTALS = "customer_daily_aggregates"


def unique_transactions(df: DataFrame) -> DataFrame:
    return keep_first(df, ["transaction_id"], TRANSACTION_ORDER)


def _totals_input(df: DataFrame) -> DataFrame:
    """The columns that decide a total. Rows that differ in nothing else give the same total."""
    return df.select("transaction_id", "timestamp", "customer_id", "amount")


def daily_totals(df: DataFrame) -> DataFrame:
    """Total and number of positive transactions per customer and day, each id counted once.

    Ids are deduplicated before amounts are checked: an id whose first row is not positive is lost.
    The merchant only breaks ties between rows that agree in all else, so it is not read.
    """
    first = keep_first(_totals_input(df), ["transaction_id"], ["timestamp", "customer_id", "amount"])
    dated = keep_positive_amounts(first).withColumn("transaction_date", transaction_date(F.col("timestamp")))
    return total_by_customer_day(dated)


def stage_counts(df: DataFrame) -> DataFrame:
    """Rows (stage, rows) of the daily-totals job, counted in one pass over the transactions."""
    first = keep_first(_totals_input(df), ["transaction_id"], ["timestamp", "customer_id", "amount"], copies="copies")
    positive = is_positive(F.col("amount"), first.schema["amount"].dataType)
    groups = first.groupBy("customer_id", transaction_date(F.col("timestamp")).alias("transaction_date")).agg(
        F.sum("copies").alias("raw"),
        F.count("*").alias("deduplicated"),
        F.count_if(positive).alias("positive"),
    )
    stages = ["raw", "deduplicated", "positive"]
    counts = groups.agg(
        *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in stages],
        F.count_if(F.col("positive") > 0).alias("daily_totals"),
    )
    return stage_rows(counts, [*stages, "daily_totals"])


def _published(spark: SparkSession, df: DataFrame, table: str, root: str, name: str | None, options: dict, schema=None) -> DataFrame:
    location = publish(df, table, root, schema=schema, **options)
    fmt = options.get("fmt", "parquet")
    if name:
        register_table(spark, name, location, fmt, None if fmt == "delta" else read_managed(spark, table, root, fmt).schema)
    return history(spark, table, root, fmt)


def publish_transactions(
    spark: SparkSession, raw_path: str, root: str, name: str | None = None, **options
) -> DataFrame:
    """Raw Parquet to the managed transaction table; returns the report of its publishes. `name` is one more catalog name."""
    pin_settings(spark)
    raw = spark.read.parquet(raw_path)
    with sized_for(spark, raw):
        return _published(spark, raw, TRANSACTIONS, root, name, options)


def publish_daily_totals(spark: SparkSession, root: str, name: str | None = None, **options) -> DataFrame:
    """Managed transactions to managed daily totals; returns the report of the totals' publishes."""
    pin_settings(spark)
    transactions = read_managed(spark, TRANSACTIONS, root, options.get("fmt", "parquet"))
    with sized_for(spark, transactions):
        return _published(spark, daily_totals(transactions), DAILY_TOTALS, root, name, options, DAILY_TOTAL)


def load_daily_totals(
    spark: SparkSession,
    root: str,
    connect: Callable[[], object] | None = None,
    writers: int | None = None,
    fmt: str = "parquet",
    check: bool = True,
) -> int:
    """Managed daily totals upserted into the served table, or with `connect` into a serving store; returns their number.

    The key is checked before the first upsert, unless the caller has just made the totals.
    """
    pin_settings(spark)
    totals = read_managed(spark, DAILY_TOTALS, root, fmt)
    with sized_for(spark, totals):
        if check:
            contracts.require(contracts.check_all(totals, unique=[DAILY_KEY], not_null=DAILY_KEY))
        if connect:
            return load_serving(totals, connect, writers)
        upsert_served(totals, root, fmt)
        return totals.count()


def run_daily(
    spark: SparkSession, root: str, connect: Callable[[], object] | None = None, writers: int | None = None, **options
) -> dict[str, int]:
    """Source check, daily totals, serving load, in this order; the first failure ends the run."""
    pin_settings(spark)
    fmt = options.get("fmt", "parquet")
    source_available(read_managed(spark, TRANSACTIONS, root, fmt), TRANSACTIONS).collect()
    publish_daily_totals(spark, root, **options)
    # Totals are grouped by their key, so it is unique and needs no check of its own.
    served = load_daily_totals(spark, root, connect, writers, fmt, check=False)
    return {"daily_totals": served, "served": served}

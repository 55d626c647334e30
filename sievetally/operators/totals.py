"""Totals per customer and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievetally.functions.transactions import total_amount


def total_by_customer_day(df: DataFrame) -> DataFrame:
    """Sum and row count; both are partly added up before the shuffle."""
    return df.groupBy("customer_id", "transaction_date").agg(
        total_amount(F.col("amount"), df.schema["amount"].dataType).alias("total_amount"),
        F.count("*").alias("transaction_count"),
    )

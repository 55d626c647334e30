"""Column functions for transactions and their daily totals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def transaction_date(timestamp: Column) -> Column:
    """Calendar day in the session zone, which the jobs pin to UTC."""
    return F.to_date(timestamp)


def is_positive(amount: Column, dtype: DataType) -> Column:
    """True for finite amounts above zero; NaN and infinity count as larger than any number."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return (amount > 0) & ~F.isnan(amount) & (amount < float("inf"))
    return amount > 0


def total_amount(amount: Column, dtype: DataType) -> Column:
    """Sum of amounts as a double.

    Decimals are summed as they are. A float counts as the decimal that it is written as, where that has at
    most 15 digits before and 10 after the point, so that the sum does not depend on the order of rows;
    what does not fit is added as a double. No amount is dropped, rounded or refused.
    """
    if not isinstance(dtype, (DoubleType, FloatType)):
        return F.sum(amount).cast("double")
    written = amount.cast("string").try_cast("decimal(25,10)")
    fits = F.coalesce(written.cast(dtype) == amount, F.lit(False))
    exact, rest = F.sum(F.when(fits, written.cast("decimal(38,10)"))), F.sum(F.when(~fits, amount.cast("double")))
    return F.when(rest.isNull(), exact.cast("double")).otherwise(rest + F.coalesce(exact.cast("double"), F.lit(0.0)))

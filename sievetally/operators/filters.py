"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievetally.functions.employees import is_hired_by, is_valid_email
from sievetally.functions.transactions import is_positive
from sievetally.schemas import REQUIRED_EMPLOYEE


def drop_null_required(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keep rows with every required column set; whitespace counts as set."""
    return df.dropna(subset=columns or REQUIRED_EMPLOYEE)


def has_required(columns: list[str] | None = None) -> Column:
    condition = F.lit(True)
    for name in columns or REQUIRED_EMPLOYEE:
        condition = condition & F.col(name).isNotNull()
    return condition


def keep_valid_email(df: DataFrame, column: str = "email") -> DataFrame:
    return df.filter(is_valid_email(F.col(column)))


def drop_future_hires(df: DataFrame, as_of, column: str = "hire_date") -> DataFrame:
    return df.filter(is_hired_by(F.col(column), as_of))


def keep_positive_amounts(df: DataFrame, column: str = "amount") -> DataFrame:
    """Drops null, zero, negative and non-finite amounts."""
    return df.filter(is_positive(F.col(column), df.schema[column].dataType))

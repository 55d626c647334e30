"""The employee job: dirty CSV to a clean relational table."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievetally.functions import employees as fn
from sievetally.operators import contracts
from sievetally.operators.cells import cell_readers, unreadable_cells
from sievetally.operators.dedupe import keep_first
from sievetally.operators.filters import drop_future_hires, drop_null_required, keep_valid_email
from sievetally.operators.rejects import quarantine, reject_funnel
from sievetally.schemas import (
    CLEAN_EMPLOYEE,
    CLEAN_MAX_LENGTH,
    CLEAN_NOT_NULL,
    CLEAN_NUMERIC,
    CLEAN_UNIQUE,
    EMAIL_ORDER,
    EMPLOYEE_ORDER,
)
from sievetally.session import pin_settings, scratch_table, sized_for
from sievetally.sinks.files import write_parquet
from sievetally.sinks.relational import append_rows
from sievetally.sources.files import read_csv_text, type_columns

# Holds a CSV line with too few or too many cells as it was read.
CORRUPT = "corrupt_line"


def unique_employees(df: DataFrame) -> DataFrame:
    return keep_first(df, ["employee_id"], EMPLOYEE_ORDER)


def unique_emails(df: DataFrame) -> DataFrame:
    """One row per email in any case; expects unique employee ids."""
    return keep_first(df.withColumn("email", fn.normalize_email(F.col("email"))), ["email"], EMAIL_ORDER)


def derive_employee_columns(df: DataFrame, as_of) -> DataFrame:
    """All derived columns, in the order of the target table."""
    first, last = fn.standardize_name(F.col("first_name")), fn.standardize_name(F.col("last_name"))
    salary = fn.clean_salary(F.col("salary"))
    values = {
        "first_name": first,
        "last_name": last,
        "full_name": fn.full_name(first, last),
        "email_domain": fn.email_domain(F.col("email")),
        "salary": salary,
        "salary_band": fn.salary_band(salary),
        "age": fn.age_years(F.col("birth_date"), as_of),
        "tenure_years": fn.tenure_years(F.col("hire_date"), as_of),
        "status": fn.normalize_status(F.col("status")),
    }
    return df.select(*[values.get(name, F.col(name)).alias(name) for name in CLEAN_EMPLOYEE.names])


def clean_employees(df: DataFrame, as_of=None) -> DataFrame:
    """Typed raw employees to the 20 columns of the clean table.

    The order of the steps is part of the result: a row that wins its id but fails validation takes
    its valid twin with it. Derived columns come last, after both shuffles, because no step before
    needs them.
    """
    complete = drop_null_required(df)
    valid = drop_future_hires(keep_valid_email(unique_employees(complete)), as_of)
    return derive_employee_columns(unique_emails(valid), as_of)


def quarantine_delivered(text: DataFrame, as_of) -> DataFrame:
    """The rejected rows of read_csv_text as delivered: every cell as text, the whole line where it was malformed, and which cells could not be read."""
    columns = text.columns
    typed = type_columns(text.withColumn("delivered", F.struct(*columns)).drop(CORRUPT))
    rejected = quarantine(typed, as_of).select("delivered.*", "reject_reason", "copies")
    return rejected.withColumn("unreadable", F.transform(unreadable_cells(), lambda x: x["column_name"]))


def check_clean_employees(df: DataFrame) -> DataFrame:
    return contracts.check_all(
        df, unique=CLEAN_UNIQUE, not_null=CLEAN_NOT_NULL, max_length=CLEAN_MAX_LENGTH, numeric=CLEAN_NUMERIC
    )


def load_employees(
    spark: SparkSession,
    csv_path: str,
    url: str,
    table: str,
    driver: str,
    as_of: date | str | None = None,
    user: str = "",
    password: str = "",
    column_types: str | None = None,
    quarantine_path: str | None = None,
    writers: int = 8,
    escaped: bool = False,
) -> dict[str, int]:
    """CSV to relational table; nothing is written unless the clean rows keep the table's contract.

    Returns the reject funnel with the numbers of malformed lines and, by column, of unreadable cells, how many accepted rows have no readable
    salary (they are Senior), and how many rows were new to the table. `escaped` is for files of write_csv().
    """
    pin_settings(spark)
    as_of = as_of or datetime.now(timezone.utc).date()
    # CSV is parsed once, as text; the steps below then read only the columns they need.
    with scratch_table(read_csv_text(spark, csv_path, corrupt=CORRUPT, escaped=escaped), "employees-raw") as text, sized_for(spark, text):
        raw = type_columns(text.drop(CORRUPT))
        with scratch_table(clean_employees(raw, as_of), "employees-clean") as clean:
            contracts.require(check_clean_employees(contracts.enforce_schema(clean, CLEAN_EMPLOYEE)))
            if quarantine_path:
                write_parquet(quarantine_delivered(text, as_of), quarantine_path)
            added = append_rows(clean, url, table, ["employee_id"], driver, user, password, column_types, writers)
            counts = {r["stage"]: r["rows"] for r in reject_funnel(type_columns(text, unreadable=unreadable_cells()), as_of, CORRUPT, list(cell_readers())).collect()}
            return {**counts, "salary_missing": clean.filter("salary IS NULL").count(), "added": added}

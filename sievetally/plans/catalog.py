"""Every operator and job as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievetally.functions import employees as fn
from sievetally.functions.transactions import transaction_date
from sievetally.operators import contracts, filters
from sievetally.operators.cells import cell_readers, cell_report, unreadable_cells
from sievetally.operators.rejects import quarantine, reject_funnel
from sievetally.plans import employees as employee_plans
from sievetally.plans import transactions as transaction_plans
from sievetally.plans.bindings import (
    AS_OF,
    employee_lines,
    employees,
    employees_text,
    table,
    transactions,
    transactions_float,
)
from sievetally.schemas import (
    CLEAN_EMPLOYEE,
    CLEAN_MAX_LENGTH,
    CLEAN_NOT_NULL,
    CLEAN_NUMERIC,
    DAILY_KEY,
    REQUIRED_EMPLOYEE,
    TRANSACTION,
)
from sievetally.session import cut_lineage, scratch_dir
from sievetally.sinks.files import write_csv, write_parquet
from sievetally.sinks.managed import publish, register_table, unregister_table
from sievetally.sinks.relational import create_table, run_in_transaction, staging_types
from sievetally.sinks.serving import SERVED, serving_layout, serving_rows, upsert_served
from sievetally.sources.files import read_csv_text, read_employees, read_parquet, type_columns
from sievetally.sources.managed import history, read_managed, source_available
from sievetally.sources.relational import read_table
from sievetally.sources.synthetic import synth_employees, synth_transactions

RUN_TS = datetime(2024, 1, 1, 6, 0, 0)
BASE_TIME = "2024-01-01 00:00:00"
WRITERS = 8

# The clean table in a database whose long text cannot be compared.
CLEAN_TABLE = create_table(
    "employees_clean",
    CLEAN_EMPLOYEE,
    CLEAN_MAX_LENGTH,
    CLEAN_NOT_NULL,
    key=["employee_id"],
    unique=[["email"]],
    defaults={"status": "'Active'", "created_at": "CURRENT_TIMESTAMP", "updated_at": "CURRENT_TIMESTAMP"},
    text="VARCHAR(2000)",
)
STAGING_TYPES = staging_types(CLEAN_EMPLOYEE, CLEAN_MAX_LENGTH, "VARCHAR(2000)")
DERBY_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


# --- transactions -------------------------------------------------------------------------------


def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_plans.daily_totals(transactions(spark, sf_dir))


def daily_totals_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_plans.daily_totals(transactions_float(spark, sf_dir))


def stage_counts_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_plans.stage_counts(transactions_float(spark, sf_dir))


def dedupe_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_plans.unique_transactions(transactions(spark, sf_dir))


def positive_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.keep_positive_amounts(transactions(spark, sf_dir))


def transaction_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = transaction_date(F.col("timestamp")).alias("transaction_date")
    return transactions(spark, sf_dir).select("transaction_id", "amount", "timestamp", day)


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_plans.stage_counts(transactions(spark, sf_dir))


def serving_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving_rows(daily_totals(spark, sf_dir))


def serving_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Ranges are found by sampling, so the totals are computed once and read back.
    totals = cut_lineage(daily_totals(spark, sf_dir), "totals")
    return serving_layout(serving_rows(totals), WRITERS)


def serving_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load without deduplication, then the correct one: the served table must show the second, and keys of the first alone."""
    root = scratch_dir(spark, "lake")
    dated = filters.keep_positive_amounts(transactions(spark, sf_dir)).withColumn(
        "transaction_date", transaction_date(F.col("timestamp"))
    )
    upsert_served(cut_lineage(transaction_plans.total_by_customer_day(dated), "totals"), root)
    upsert_served(cut_lineage(daily_totals(spark, sf_dir), "totals"), root)
    return read_managed(spark, SERVED, root)


def serving_upsert_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days served without deduplication, then the last seven of them corrected; the files of the others stay."""
    root = scratch_dir(spark, "lake")
    dated = filters.keep_positive_amounts(transactions(spark, sf_dir)).withColumn(
        "transaction_date", transaction_date(F.col("timestamp"))
    )
    upsert_served(cut_lineage(transaction_plans.total_by_customer_day(dated), "totals"), root)
    totals = cut_lineage(daily_totals(spark, sf_dir), "totals")
    last = totals.agg(F.max("transaction_date")).head()[0]
    upsert_served(totals.where(F.date_diff(F.lit(last), "transaction_date") < 7), root)
    return read_managed(spark, SERVED, root)


def run_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "lake")
    publish(transactions(spark, sf_dir), transaction_plans.TRANSACTIONS, root)
    transaction_plans.run_daily(spark, root)
    return read_managed(spark, SERVED, root)


# --- employees ----------------------------------------------------------------------------------


def _valid_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = employee_plans.unique_employees(filters.drop_null_required(employees(spark, sf_dir)))
    return filters.drop_future_hires(filters.keep_valid_email(unique), AS_OF)


def employee_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employee_plans.clean_employees(employees(spark, sf_dir), AS_OF)


def drop_null_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.drop_null_required(employees(spark, sf_dir))


def dedupe_employee_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employee_plans.unique_employees(drop_null_required(spark, sf_dir))


def valid_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.keep_valid_email(employees(spark, sf_dir))


def not_future_hire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.drop_future_hires(employees(spark, sf_dir), AS_OF)


def dedupe_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employee_plans.unique_emails(_valid_employees(spark, sf_dir))


def standardize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employees(spark, sf_dir).select(
        "zip_code",
        fn.standardize_name(F.col("first_name")).alias("first_name"),
        fn.standardize_name(F.col("last_name")).alias("last_name"),
    )


def clean_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employees(spark, sf_dir).select(
        "zip_code", F.col("salary").alias("salary_text"), fn.clean_salary(F.col("salary")).alias("salary")
    )


def salary_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    salary = fn.clean_salary(F.col("salary"))
    return employees(spark, sf_dir).select("zip_code", salary.alias("salary"), fn.salary_band(salary).alias("salary_band"))


def full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employees(spark, sf_dir).select(
        "zip_code", fn.full_name(F.col("first_name"), F.col("last_name")).alias("full_name")
    )


def email_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    email = fn.normalize_email(F.col("email"))
    return employees(spark, sf_dir).select("zip_code", email.alias("email"), fn.email_domain(email).alias("email_domain"))


def age_tenure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employees(spark, sf_dir).select(
        "zip_code",
        "birth_date",
        "hire_date",
        fn.age_years(F.col("birth_date"), AS_OF).alias("age"),
        fn.tenure_years(F.col("hire_date"), AS_OF).alias("tenure_years"),
    )


def normalize_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employees(spark, sf_dir).select(
        "zip_code", F.col("status").alias("status_text"), fn.normalize_status(F.col("status")).alias("status")
    )


def sql_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    employee_etl(spark, sf_dir).createOrReplaceTempView("employees_clean")
    return spark.sql("SELECT COUNT(*) AS employees FROM employees_clean")


def sql_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    employee_etl(spark, sf_dir).createOrReplaceTempView("employees_clean")
    return spark.sql("SELECT employee_id, full_name, salary FROM employees_clean ORDER BY employee_id LIMIT 5")


# --- contracts, on the dirty tables so that there is something to find ------------------------------


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    of_employees = contracts.check_unique(employees(spark, sf_dir), [["employee_id"], ["email"]])
    of_transactions = contracts.check_unique(transaction_dates(spark, sf_dir), [["transaction_id"]])
    of_days = contracts.check_unique(
        transactions(spark, sf_dir).withColumn("transaction_date", transaction_date(F.col("timestamp"))), [DAILY_KEY]
    )
    return of_employees.unionByName(of_transactions).unionByName(of_days)


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.check_not_null(employees(spark, sf_dir), [*REQUIRED_EMPLOYEE, "salary", "status"])


def check_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Tighter than the target table, which nothing here exceeds.
    return contracts.check_length(
        employees(spark, sf_dir), {"first_name": 8, "email": 22, "address": 34, "state": 2, "zip_code": 10}
    )


def check_numeric_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = fn.exact_tenure(F.col("hire_date"), "2150-01-01")
    df = employees(spark, sf_dir).select("salary", "employee_id", exact.alias("tenure_years"))
    return contracts.check_numeric_fit(df, {c: CLEAN_NUMERIC[c] for c in df.columns})


def check_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.check_outcome(employees(spark, sf_dir), employee_etl(spark, sf_dir), REQUIRED_EMPLOYEE)


def check_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = transactions(spark, sf_dir).drop("merchant").withColumn("channel", F.col("customer_id"))
    return contracts.check_schema(df, TRANSACTION)


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.add_audit_columns(employee_etl(spark, sf_dir).select("employee_id", "status"), RUN_TS)


def employee_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_funnel(employees(spark, sf_dir), AS_OF)


def employee_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(employees(spark, sf_dir), AS_OF)


# --- sources and sinks: write, then read back ---------------------------------------------------


def csv_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with bad cells and with too few or too many cells, read in the declared types."""
    path = scratch_dir(spark, "employees-csv")
    employee_lines(spark, sf_dir).write.text(path)
    df = read_employees(spark, path, corrupt="corrupt_line", header=False)
    return df.withColumn("corrupt_line", F.col("corrupt_line").isNotNull())


def _lines_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "employees-csv")
    employee_lines(spark, sf_dir).write.text(path)
    text = read_csv_text(spark, path, corrupt=employee_plans.CORRUPT, header=False)
    return type_columns(text, unreadable=unreadable_cells())


def unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text that could not be read as its column's type, with its number of rows."""
    return cell_report(_lines_read(spark, sf_dir))


def funnel_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject funnel of delivered lines, with malformed lines and unreadable cells, in one pass."""
    return reject_funnel(_lines_read(spark, sf_dir), AS_OF, employee_plans.CORRUPT, list(cell_readers()))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "employees-csv")
    write_csv(employees_text(spark, sf_dir), path)
    return read_csv_text(spark, path, escaped=True)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "transactions")
    write_parquet(transactions(spark, sf_dir), path)
    return read_parquet(spark, path)


def managed_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "lake")
    publish(transactions(spark, sf_dir), transaction_plans.TRANSACTIONS, root)
    return read_managed(spark, transaction_plans.TRANSACTIONS, root)


def managed_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files published as a table, then the table replaced by a filtered version of itself."""
    root, raw, name = scratch_dir(spark, "lake"), scratch_dir(spark, "raw"), transaction_plans.TRANSACTIONS
    write_parquet(transactions(spark, sf_dir), raw)
    transaction_plans.publish_transactions(spark, raw, root)
    publish(filters.keep_positive_amounts(read_managed(spark, name, root)), name, root)
    return read_managed(spark, name, root)


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, name = scratch_dir(spark, "lake"), f"daily_totals_{uuid.uuid4().hex}"
    register_table(spark, name, publish(daily_totals(spark, sf_dir), name, root))
    df = spark.table(name)
    unregister_table(spark, name)
    return df


def publish_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, name = scratch_dir(spark, "lake"), transaction_plans.TRANSACTIONS
    publish(transactions(spark, sf_dir), name, root, run_id="run-1", run_ts=RUN_TS)
    publish(dedupe_transactions(spark, sf_dir), name, root, run_id="run-2", run_ts=RUN_TS)
    return history(spark, name, root).select("run_id", "table_name", "operation", "mode", "num_output_rows")


def available(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_available(table(spark, sf_dir, "events"), "events")


def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole employee job: CSV to table, the same again (adds nothing), read back.

    The embedded database lives in the driver process, so this query needs a local session. On a
    cluster the same functions take the URL of a database that all executors reach.
    """
    log = f"{tempfile.mkdtemp(prefix='run-')}/derby.log"
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", log)
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    run_in_transaction(spark, url, [CLEAN_TABLE], DERBY_DRIVER)
    path = scratch_dir(spark, "employees-csv")
    write_csv(employees_text(spark, sf_dir), path)
    for _ in range(2):
        employee_plans.load_employees(
            spark, path, url, "employees_clean", DERBY_DRIVER, AS_OF, column_types=STAGING_TYPES, escaped=True
        )
    stored = read_table(spark, url, "employees_clean", "EMPLOYEE_ID", driver=DERBY_DRIVER)
    return stored.select(*CLEAN_EMPLOYEE.names)


# --- generators, one row per row of a given table -------------------------------------------------


def synthetic_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = synth_transactions(table(spark, sf_dir, "events").select(F.col("event_id").alias("id")), BASE_TIME)
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def synthetic_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth_employees(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), AS_OF)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "daily_totals": daily_totals,
    "employee_etl": employee_etl,
    "daily_totals_float": daily_totals_float,
    "stage_counts_float": stage_counts_float,
    "parquet_scan": parquet_scan,
    "source_available": available,
    "csv_scan_typed": csv_scan_typed,
    "csv_roundtrip": csv_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "managed_table_scan": managed_table_scan,
    "managed_overwrite": managed_overwrite,
    "register_table": register,
    "publish_history": publish_history,
    "jdbc_roundtrip": jdbc_roundtrip,
    "serving_projection": serving_projection,
    "serving_layout": serving_order,
    "serving_upsert": serving_upsert,
    "serving_upsert_days": serving_upsert_days,
    "run_daily": run_daily,
    "dedupe_transactions": dedupe_transactions,
    "positive_amounts": positive_amounts,
    "transaction_date": transaction_dates,
    "stage_counts": stage_counts,
    "drop_null_required": drop_null_required,
    "dedupe_employee_id": dedupe_employee_id,
    "valid_email": valid_email,
    "not_future_hire": not_future_hire,
    "dedupe_email": dedupe_email,
    "standardize_names": standardize_names,
    "clean_salary": clean_salary,
    "salary_band": salary_band,
    "full_name": full_name,
    "email_parts": email_parts,
    "age_tenure": age_tenure,
    "normalize_status": normalize_status,
    "sql_count": sql_count,
    "sql_sample": sql_sample,
    "check_unique": check_unique,
    "check_not_null": check_not_null,
    "check_length": check_length,
    "check_numeric_fit": check_numeric_fit,
    "check_outcome": check_outcome,
    "check_schema": check_schema,
    "audit_columns": audit_columns,
    "reject_funnel": employee_funnel,
    "reject_funnel_lines": funnel_of_lines,
    "unreadable_cells": unreadable,
    "reject_quarantine": employee_quarantine,
    "synth_transactions": synthetic_transactions,
    "synth_employees": synthetic_employees,
}

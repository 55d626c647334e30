"""Declared schemas, key columns and limits of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns.items()])


# Names and types of the tables are given by their owners.
# One employee as delivered: salary stays text until it is cleaned, zip codes keep leading zeros.
EMPLOYEE = _struct(
    employee_id=IntegerType(),
    first_name=StringType(),
    last_name=StringType(),
    email=StringType(),
    hire_date=DateType(),
    job_title=StringType(),
    department=StringType(),
    salary=StringType(),
    manager_id=IntegerType(),
    address=StringType(),
    city=StringType(),
    state=StringType(),
    zip_code=StringType(),
    birth_date=DateType(),
    status=StringType(),
)

# The same columns as CSV text.
EMPLOYEE_TEXT = _struct(**{field.name: StringType() for field in EMPLOYEE})

CLEAN_EMPLOYEE = _struct(
    employee_id=IntegerType(),
    first_name=StringType(),
    last_name=StringType(),
    full_name=StringType(),
    email=StringType(),
    email_domain=StringType(),
    hire_date=DateType(),
    job_title=StringType(),
    department=StringType(),
    salary=DecimalType(10, 2),
    salary_band=StringType(),
    manager_id=IntegerType(),
    address=StringType(),
    city=StringType(),
    state=StringType(),
    zip_code=StringType(),
    birth_date=DateType(),
    age=IntegerType(),
    tenure_years=DecimalType(3, 1),
    status=StringType(),
)

TRANSACTION = _struct(
    transaction_id=StringType(),
    customer_id=StringType(),
    amount=DecimalType(12, 2),
    timestamp=TimestampType(),
    merchant=StringType(),
)

DAILY_TOTAL = _struct(
    customer_id=StringType(),
    transaction_date=DateType(),
    total_amount=DoubleType(),
    transaction_count=LongType(),
)

SERVING_ROW = _struct(
    customer_id=StringType(),
    transaction_date=DateType(),
    total_amount=DoubleType(),
    transaction_count=IntegerType(),
)

# One record per publish of a managed table; folders are those that hold the table from then on.
RUN_LOG = _struct(
    version=LongType(),
    run_id=StringType(),
    table_name=StringType(),
    operation=StringType(),
    mode=StringType(),
    num_output_rows=LongType(),
    committed_at=TimestampType(),
    format=StringType(),
    partition_by=ArrayType(StringType()),
    folders=ArrayType(StringType()),
)

# The columns that an employee must have.
REQUIRED_EMPLOYEE = ["employee_id", "first_name", "last_name", "email", "hire_date"]

# Which of several rows with one key survives. Remaining columns are appended by the dedupe
# operator, so the order is total and the survivor does not depend on file layout.
EMPLOYEE_ORDER = ["hire_date", "email", "first_name", "last_name", "birth_date"]
EMAIL_ORDER = ["employee_id"]
TRANSACTION_ORDER = ["timestamp", "customer_id", "amount", "merchant"]

# Contract of the clean employee table (fixed values of the target schema).
CLEAN_NOT_NULL = ["employee_id", "first_name", "last_name", "full_name", "email", "hire_date"]
CLEAN_MAX_LENGTH = {
    "first_name": 50,
    "last_name": 50,
    "full_name": 100,
    "email": 100,
    "email_domain": 50,
    "job_title": 100,
    "department": 50,
    "salary_band": 20,
    "city": 50,
    "state": 2,
    "zip_code": 10,
    "status": 20,
}
CLEAN_NUMERIC = {
    "employee_id": "int",
    "salary": "decimal(10,2)",
    "manager_id": "int",
    "age": "int",
    "tenure_years": "decimal(3,1)",
}
CLEAN_UNIQUE = [["employee_id"], ["email"]]
DAILY_KEY = ["customer_id", "transaction_date"]

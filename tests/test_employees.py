"""Edge cases of the employee job; expected rows written by hand."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sievetally.functions import employees as fn
from sievetally.operators.filters import drop_future_hires, drop_null_required, keep_valid_email
from sievetally.operators.rejects import STAGES, quarantine, reject_funnel
from sievetally.plans.employees import clean_employees, unique_emails, unique_employees
from sievetally.schemas import CLEAN_EMPLOYEE, EMPLOYEE, EMPLOYEE_TEXT
from sievetally.sources.files import type_columns

AS_OF = "2024-01-01"

# id, first, last, email, hire date, salary, birth date, status
CASES = [
    ("1", "ANN", "o'NEIL", "ann.o@COMPANY.COM", "2020-01-01", "₹1,250,000", "1990-01-01", "INACTIVE"),
    ("2", None, "x", "two@x.co", "2020-01-01", "1", "1990-01-01", "Active"),
    ("3", "cy", "d", "cy@company", "2019-01-01", "1", "1990-01-01", "Active"),
    ("3", "cy", "d", "cy@x.co", "2020-01-01", "1", "1990-01-01", "Active"),
    ("4", "di", "e", "di@x.co", "2024-01-01", "50000", "1990-01-01", "active"),
    ("5", "ed", "f", "ed@x.co", "2024-01-02", "1", "1990-01-01", "Active"),
    ("6", "fy", "g", "Same@X.co", "2020-01-01", "80000", "1990-01-01", "Active"),
    ("7", "gi", "h", "same@x.CO", "2020-01-01", "1", "1990-01-01", "Active"),
    ("8", "hy", "i", "hy@x.co", "2020-01-01", None, "1990-01-01", None),
    ("9", "ian", "j", "ian@x.co", "2020-01-01", "n/a", "1990-01-01", "retired"),
    ("10", "jo", "k", "jo@x.co", "2020-01-01", "49999.99", None, "Active"),
    ("11", "ky", "l", "ky@x.co", "2020-01-01", "80000.01", "2024-03-01", "Active"),
    ("12", "li", "m", "li@x.co", "1900-01-01", "60000", "1884-01-01", "Active"),
    ("13", "  ", "VAN der-berg", "mo@x.co", "2020-01-01", "$70,000", "1990-01-02", "Active"),
    ("14", "ny", "o", "ny@x.co", "notadate", "1", "1990-01-01", "Active"),
]

REASONS = {
    ("2", "two@x.co"): "null_required",
    ("14", "ny@x.co"): "null_required",
    ("3", "cy@x.co"): "duplicate_employee_id",
    ("3", "cy@company"): "bad_email",
    ("5", "ed@x.co"): "future_hire",
    ("7", "same@x.CO"): "duplicate_email",
}


@pytest.fixture(scope="module")
def raw(spark):
    names = ["employee_id", "first_name", "last_name", "email", "hire_date", "salary", "birth_date", "status"]
    text = spark.createDataFrame(CASES, ", ".join(f"{n} string" for n in names))
    missing = [c for c in EMPLOYEE_TEXT.names if c not in names]
    text = text.withColumns({c: F.lit(None).cast("string") for c in missing})
    return type_columns(text.select(*EMPLOYEE_TEXT.names), EMPLOYEE)


@pytest.fixture(scope="module")
def clean(raw):
    return {r["employee_id"]: r for r in clean_employees(raw, AS_OF).collect()}


def test_schema(raw):
    df = clean_employees(raw, AS_OF)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CLEAN_EMPLOYEE]


def test_kept_ids(clean):
    assert sorted(clean) == [1, 4, 6, 8, 9, 10, 11, 12, 13]


def test_names_salary_and_dates(clean):
    ann = clean[1]
    assert (ann["full_name"], ann["email"], ann["email_domain"]) == ("Ann O'neil", "ann.o@company.com", "company.com")
    assert (ann["salary"], ann["salary_band"], ann["status"]) == (Decimal("1250000.00"), "Senior", "Inactive")
    assert (ann["age"], ann["tenure_years"]) == (34, Decimal("4.0"))


@pytest.mark.parametrize(
    ("employee", "column", "value"),
    [
        (4, "salary_band", "Mid"),
        (4, "tenure_years", Decimal("0.0")),
        (6, "salary_band", "Mid"),
        (6, "email", "same@x.co"),
        (8, "salary", None),
        (8, "salary_band", "Senior"),
        (8, "status", "Active"),
        (9, "salary", None),
        (9, "salary_band", "Senior"),
        (9, "status", "Active"),
        (10, "salary_band", "Junior"),
        (10, "age", None),
        (11, "salary_band", "Senior"),
        (11, "age", -1),
        (12, "age", 140),
        (12, "tenure_years", None),
        (13, "full_name", "Van Der-berg"),
        (13, "salary", Decimal("70000.00")),
        (13, "age", 34),
    ],
)
def test_derived_values(clean, employee, column, value):
    assert clean[employee][column] == value


def test_quarantine_names_every_reject(raw):
    rows = quarantine(raw, AS_OF).collect()
    assert {(str(r["employee_id"]), r["email"]): r["reject_reason"] for r in rows} == REASONS
    assert all(r["copies"] == 1 for r in rows)


def test_funnel_sums_to_raw(raw):
    funnel = {r["stage"]: r["rows"] for r in reject_funnel(raw, AS_OF).collect()}
    assert list(funnel) == STAGES
    assert funnel == {
        "raw": 15,
        "null_required": 2,
        "duplicate_employee_id": 1,
        "bad_email": 1,
        "future_hire": 1,
        "duplicate_email": 1,
        "accepted": 9,
    }


def test_funnel_of_nothing(raw):
    assert {r["rows"] for r in reject_funnel(raw.limit(0), AS_OF).collect()} == {0}


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_layout_does_not_change_the_result(raw, clean, parts):
    shuffled = raw.repartition(parts, F.reverse("email"))
    assert {r["employee_id"]: r for r in clean_employees(shuffled, AS_OF).collect()} == clean


def test_identical_copies_are_counted_not_multiplied(raw):
    twice = raw.unionByName(raw).unionByName(raw)
    kept = {r["employee_id"] for r in clean_employees(twice, AS_OF).collect()}
    assert len(kept) == 9
    counts = {}
    for r in quarantine(twice, AS_OF).collect():
        counts[r["reject_reason"]] = counts.get(r["reject_reason"], 0) + r["copies"]
    funnel = {r["stage"]: r["rows"] for r in reject_funnel(twice, AS_OF).collect()}
    assert counts == {s: funnel[s] for s in STAGES[1:-1]}
    assert sum(counts.values()) + funnel["accepted"] == funnel["raw"] == 45


def test_hot_key_and_hot_email(spark):
    """A third of the rows under one id and a third under one email, all different."""
    k = F.col("id")
    df = spark.range(3000).select(
        F.when(k % 3 == 0, 1).otherwise(k + 10).cast("int").alias("employee_id"),
        F.lit("a").alias("first_name"),
        F.concat(F.lit("b"), k.cast("string")).alias("last_name"),
        F.when(k % 3 == 1, "Hot@x.co").otherwise(F.concat(F.lit("u"), k.cast("string"), F.lit("@x.co"))).alias("email"),
        F.date_add(F.lit("2000-01-01").cast("date"), (k % 500).cast("int")).alias("hire_date"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in EMPLOYEE.fields[5:]],
    )
    assert clean_employees(df, AS_OF).count() == 1 + 1 + 1000
    funnel = {r["stage"]: r["rows"] for r in reject_funnel(df, AS_OF).collect()}
    assert (funnel["duplicate_employee_id"], funnel["duplicate_email"], funnel["accepted"]) == (999, 999, 1002)
    assert quarantine(df, AS_OF).agg(F.sum("copies")).head()[0] == 1998


def test_null_filter_keeps_blank_text(raw):
    assert drop_null_required(raw).filter("employee_id = 13").count() == 1
    assert drop_null_required(raw).count() == 13


def test_dedupe_takes_earliest_hire(raw):
    row = unique_employees(drop_null_required(raw)).filter("employee_id = 3").collect()
    assert [r["email"] for r in row] == ["cy@company"]


def test_email_dedupe_ignores_case(raw):
    kept = unique_emails(unique_employees(drop_null_required(raw))).filter("email = 'same@x.co'").collect()
    assert [r["employee_id"] for r in kept] == [6]


@pytest.mark.parametrize(
    ("email", "valid"),
    [
        ("a@b.co", True),
        ("A.b+c%d_e-f@x-y.z.org", True),
        ("a@b..co", True),
        ("ann@company", False),
        ("a b@c.co", False),
        ("a@b.co\n", True),  # the end anchor also matches before a last line break
        ("a@b.c", False),
        ("@b.co", False),
        ("", False),
        (None, False),
    ],
)
def test_email_pattern(spark, email, valid):
    df = spark.createDataFrame([(email,)], "email string")
    assert (keep_valid_email(df).count() == 1) is valid


def test_email_domain_without_at(spark):
    df = spark.createDataFrame([("plain",), (None,), ("a@b@c",)], "email string")
    assert [r[0] for r in df.select(fn.email_domain(F.col("email"))).collect()] == [None, None, "b"]


def test_future_hires(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 2),), (None,)], "hire_date date")
    assert [r[0] for r in drop_future_hires(df, AS_OF).collect()] == [date(2024, 1, 1)]
    assert drop_future_hires(df, date(2024, 1, 2)).count() == 2


def test_without_evaluation_date_today_counts(spark):
    df = spark.sql("SELECT current_date() AS hire_date UNION ALL SELECT date_add(current_date(), 1)")
    assert drop_future_hires(df, None).count() == 1


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("₹1,250,000", Decimal("1250000.00")),
        ("$70,000", Decimal("70000.00")),
        ("12.345", Decimal("12.35")),
        ("Rs. 5", None),
        ("", None),
        ("123456789012", None),
        (None, None),
    ],
)
def test_salary_text(spark, text, value):
    df = spark.createDataFrame([(text,)], "salary string")
    assert df.select(fn.clean_salary(F.col("salary"))).head()[0] == value

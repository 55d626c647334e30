from datetime import datetime, timedelta, timezone

import pytest

from sievetally.operators import contracts
from sievetally.schemas import DAILY_TOTAL, TRANSACTION


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "a@x.co", "MH", "10"), (1, "a@x.co", "MHX", "1e9"), (2, None, None, "n/a"), (3, None, "KA", None)]
    return spark.createDataFrame(rows, "id int, email string, state string, pay string")


def report(df):
    return {(r["rule"], r["column"]): r["violations"] for r in df.collect()}


def test_unique_counts_rows_beyond_the_first(people):
    found = report(contracts.check_unique(people, [["id"], ["email"], ["id", "state"]]))
    assert found == {("unique", "id"): 1, ("unique", "email"): 1, ("unique", "id,state"): 0}


def test_unique_on_empty(people):
    assert report(contracts.check_unique(people.limit(0), [["id"]])) == {("unique", "id"): 0}


def test_one_pass_rules(people):
    assert report(contracts.check_not_null(people, ["id", "email"])) == {("not_null", "id"): 0, ("not_null", "email"): 2}
    assert report(contracts.check_length(people, {"state": 2})) == {("max_length", "state"): 1}
    assert report(contracts.check_numeric_fit(people, {"pay": "decimal(10,2)"})) == {("numeric_fit", "pay"): 2}


def test_require(people):
    contracts.require(contracts.check_all(people, not_null=["id"], max_length={"state": 3}))
    with pytest.raises(contracts.ContractViolation, match=r"unique\(id\): 1; not_null\(email\): 2"):
        contracts.require(contracts.check_all(people, unique=[["id"]], not_null=["email", "id"]))


def test_all_row_rules_share_one_scan(people, capsys):
    report_df = contracts.check_all(people, not_null=["id", "email"], max_length={"state": 2}, numeric={"pay": "int"})
    report_df.explain()
    assert capsys.readouterr().out.count("Scan") == 1
    assert report(report_df) == {
        ("not_null", "id"): 0, ("not_null", "email"): 2, ("max_length", "state"): 1, ("numeric_fit", "pay"): 2
    }


def test_outcome(people):
    good = contracts.check_outcome(people, people.dropna(), ["email"])
    assert set(report(good).values()) == {0}
    bad = report(contracts.check_outcome(people, people, ["email", "state"]))
    assert bad == {("clean_below_raw", "*"): 1, ("critical_not_null", "email,state"): 2}


def test_schema_drift(spark):
    df = spark.sql("SELECT 'C1' AS customer_id, current_date() AS transaction_date, 1.5D AS total_amount, 1 AS transaction_count")
    with pytest.raises(contracts.ContractViolation, match="transaction_count: declared bigint, found int"):
        contracts.enforce_schema(df, DAILY_TOTAL)
    with pytest.raises(contracts.ContractViolation, match="merchant: declared string, found nothing"):
        contracts.enforce_schema(df, TRANSACTION)
    ok = df.selectExpr("cast(transaction_count as bigint) transaction_count", "total_amount", "transaction_date", "customer_id")
    assert contracts.enforce_schema(ok, DAILY_TOTAL).columns == DAILY_TOTAL.names


def test_check_schema_rows(spark):
    df = spark.createDataFrame([("C1", None), ("C2", 1)], "customer_id string, extra int")
    found = {r["column_name"]: tuple(r)[1:] for r in contracts.check_schema(df, DAILY_TOTAL).collect()}
    assert found["customer_id"] == ("string", "string", True, 2)
    assert found["total_amount"] == ("double", None, False, 0)
    assert found["extra"] == (None, "int", False, 1)


def test_audit_columns(people):
    stamp = datetime(2024, 1, 1, 6)
    for given in (stamp, "2024-01-01 06:00:00", datetime(2024, 1, 1, 11, 30, tzinfo=timezone(timedelta(hours=5.5)))):
        row = contracts.add_audit_columns(people, given).head()
        assert row["created_at"] == row["updated_at"] == stamp

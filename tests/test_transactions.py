"""Edge cases of the transaction jobs; expected rows written by hand."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sievetally.functions.transactions import transaction_date
from sievetally.operators.dedupe import keep_first
from sievetally.operators.filters import keep_positive_amounts
from sievetally.plans.transactions import daily_totals, stage_counts, unique_transactions

SCHEMA = "transaction_id string, customer_id string, amount decimal(12,2), timestamp timestamp_ntz, merchant string"


def at(text):
    return datetime.fromisoformat(text)


CASES = [
    ("T1", "C1", Decimal("-5.00"), at("2024-01-01 08:00"), "A"),
    ("T1", "C1", Decimal("10.00"), at("2024-01-01 09:00"), "A"),
    ("T2", "C1", Decimal("0.00"), at("2024-01-01 09:00"), "A"),
    ("T3", "C1", None, at("2024-01-01 09:00"), "A"),
    ("T4", "C1", Decimal("3.80"), at("2024-01-01 23:59:59"), "B"),
    ("T5", "C1", Decimal("5.00"), at("2024-01-02 00:00:00"), "B"),
    ("T6", "C1", Decimal("1.10"), at("2024-01-01 00:00:00"), "A"),
    ("T7", "C1", Decimal("2.20"), at("2024-01-01 12:00:00"), "A"),
    ("T8", "C2", Decimal("0.01"), at("2024-01-01 12:00:00"), "A"),
    ("T8", "C3", Decimal("9.00"), at("2024-01-03 12:00:00"), "A"),
]

TOTALS = [
    ("C1", date(2024, 1, 1), 7.1, 3),
    ("C1", date(2024, 1, 2), 5.0, 1),
    ("C2", date(2024, 1, 1), 0.01, 1),
]


@pytest.fixture(scope="module")
def transactions(spark):
    return spark.createDataFrame(CASES, SCHEMA)


def test_totals(transactions):
    assert sorted(tuple(r) for r in daily_totals(transactions).collect()) == TOTALS


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_layout_does_not_change_totals(transactions, parts):
    shuffled = transactions.repartition(parts, "amount")
    assert sorted(tuple(r) for r in daily_totals(shuffled).collect()) == TOTALS


def test_stage_counts(transactions):
    counts = {r["stage"]: r["rows"] for r in stage_counts(transactions).collect()}
    assert counts == {"raw": 10, "deduplicated": 8, "positive": 5, "daily_totals": 3}


def test_totals_agree_with_the_full_dedupe(transactions):
    """Leaving out the merchant must not change which total comes out."""
    copies = transactions.unionByName(transactions.withColumn("merchant", F.lit("Z")))
    full = keep_positive_amounts(unique_transactions(copies)).groupBy(
        "customer_id", transaction_date(F.col("timestamp")).alias("transaction_date")
    ).agg(F.sum("amount").cast("double").alias("total_amount"), F.count("*").alias("transaction_count"))
    assert sorted(tuple(r) for r in full.collect()) == sorted(tuple(r) for r in daily_totals(copies).collect())


def test_non_finite_amounts(spark):
    rows = [
        ("a", "C1", 1.5), ("b", "C1", float("nan")), ("c", "C1", float("inf")), ("d", "C1", float("-inf")), ("e", "C1", 0.0)
    ]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, amount double").withColumns(
        {"timestamp": F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"), "merchant": F.lit("A")}
    )
    assert [r["transaction_id"] for r in keep_positive_amounts(df).collect()] == ["a"]
    assert [tuple(r) for r in daily_totals(df).collect()] == [("C1", date(2024, 1, 1), 1.5, 1)]


def test_float_amounts_sum_exactly(spark):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.lit("C1").alias("customer_id"),
        F.lit(0.1).cast("float").alias("amount"),
        F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("timestamp"),
        F.lit("A").alias("merchant"),
    )
    assert [tuple(r) for r in daily_totals(df).collect()] == [("C1", date(2024, 1, 1), 100.0, 1000)]


@pytest.mark.parametrize("kind", ["double", "float"])
def test_no_float_amount_is_dropped_or_refused(spark, kind):
    amounts = {"C1": [0.004, 1.0], "C2": [1e10, -1e10, 2.5], "C3": [1e-12], "C4": [1e30, 1.0], "C5": [float("nan"), float("inf"), None, -0.0], "C6": [1e300] * (kind == "double")}
    rows = [(f"{c}-{i}", c, a) for c, own in amounts.items() for i, a in enumerate(own)]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, amount double").withColumn("amount", F.col("amount").cast(kind))
    df = df.withColumns({"timestamp": F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"), "merchant": F.lit("A")})
    found = {r["customer_id"]: (r["total_amount"], r["transaction_count"]) for r in daily_totals(df).collect()}
    want = {"C1": (1.004, 2), "C2": (1e10 + 2.5, 2), "C3": (1e-12, 1), "C4": (1e30, 2)} | ({"C6": (1e300, 1)} if kind == "double" else {})
    assert found.keys() == want.keys()
    assert all(found[c][1] == want[c][1] and found[c][0] == pytest.approx(want[c][0], rel=1e-6) for c in want)
    if kind == "double":
        assert found["C1"][0] == 1.004 and found["C2"][0] == 1e10 + 2.5
    counts = {r["stage"]: r["rows"] for r in stage_counts(df).collect()}
    assert counts == {"raw": len(rows), "deduplicated": len(rows), "positive": sum(n for _, n in want.values()), "daily_totals": len(want)}


def test_day_follows_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_seconds(1704065400) AS timestamp")  # 2023-12-31 23:30 UTC
    day = df.select(transaction_date(F.col("timestamp")))
    assert day.head()[0] == date(2023, 12, 31)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert df.select(transaction_date(F.col("timestamp"))).head()[0] == date(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_ids_form_one_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, v int")
    assert sorted((r["k"] or "", r["v"]) for r in keep_first(df, ["k"], ["v"]).collect()) == [("", 1), ("a", 3)]


def test_keep_first_orders_nulls_first_and_counts(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", None, "z"), ("a", None, "y")], "k string, v int, w string")
    assert [tuple(r) for r in keep_first(df, ["k"], ["v"], copies="n").collect()] == [("a", None, "y", 3)]
    assert keep_first(df.select("k"), ["k"]).count() == 1


def test_keep_first_matches_brute_force(spark):
    import random

    rng = random.Random(5)
    rows = [(rng.randrange(20), rng.choice([None, 1, 2]), rng.choice("abc"), rng.random()) for _ in range(500)]
    best = {}
    for row in rows:
        rank = (row[2], (row[1] is not None, row[1] or 0), row[3])
        if row[0] not in best or rank < best[row[0]][0]:
            best[row[0]] = (rank, row)
    df = spark.createDataFrame(rows, "k int, a int, b string, c double").repartition(9)
    found = {tuple(r) for r in keep_first(df, ["k"], ["b"]).collect()}
    assert found == {row for _, row in best.values()}

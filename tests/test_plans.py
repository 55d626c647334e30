"""Physical plans: what is read, how often data is shuffled, and what is reduced before a shuffle."""

import re

import pytest

from __spark_entry__ import queries
from sievetally.plans.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def lines_with(plan, word):
    return [line for line in plan.splitlines() if re.search(rf"[+:]- (\*\(\d+\) )?{word}\b", line)]


@pytest.mark.parametrize(
    ("name", "by_key"),
    [
        ("daily_totals", 2),
        ("employee_etl", 2),
        ("dedupe_transactions", 1),
        ("dedupe_employee_id", 1),
        ("dedupe_email", 2),
        ("stage_counts", 2),
        ("reject_funnel", 2),
        ("positive_amounts", 0),
        ("clean_salary", 0),
        ("check_not_null", 0),
        ("synth_employees", 0),
    ],
)
def test_shuffles(spark, capsys, name, by_key):
    exchanges = lines_with(plan_of(queries()[name](spark, SF), capsys), "Exchange")
    assert len([e for e in exchanges if "hashpartitioning" in e]) == by_key
    assert len([e for e in exchanges if "SinglePartition" in e]) <= 1


@pytest.mark.parametrize("name", ["daily_totals", "employee_etl", "dedupe_email", "reject_funnel", "check_unique"])
def test_every_shuffle_is_preceded_by_partial_aggregation(spark, capsys, name):
    lines = plan_of(queries()[name](spark, SF), capsys).splitlines()
    for number, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert "partial_" in lines[number + 1]


LAZY = sorted(set(QUERIES) - {"jdbc_roundtrip"})


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_python_or_window_in_any_plan(spark, capsys, name):
    plan = plan_of(queries()[name](spark, "/root/testdata/sf0.001"), capsys)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "PythonUDF", "Window"):
        assert word not in plan


def test_daily_totals_reads_four_columns(spark, capsys):
    plan = plan_of(queries()["daily_totals"](spark, SF), capsys)
    assert "FileScan parquet [event_id#" in plan and "event_type" not in plan and "props" not in plan


def test_amount_filter_stays_above_the_dedupe(spark, capsys):
    """Pushing it below would let another copy of an id survive."""
    plan = plan_of(queries()["daily_totals"](spark, SF), capsys).splitlines()
    kinds = [k for line in plan for k in re.findall(r"- (?:\*\(\d+\) )?(Filter|SortAggregate|FileScan)", line)]
    assert kinds == ["Filter", "SortAggregate", "SortAggregate", "FileScan"]


def test_filters_reach_the_scan(spark, capsys):
    df = spark.read.parquet(f"{SF}/events.parquet")
    from sievetally.operators.filters import keep_positive_amounts

    plan = plan_of(keep_positive_amounts(df, "value").select("event_id"), capsys)
    assert "GreaterThan(value,0.0)" in plan
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_quarantine_moves_rows_twice_and_else_only_ids(spark, capsys):
    df = queries()["reject_quarantine"](spark, SF)
    lines = plan_of(df, capsys).splitlines()
    below = [lines[n + 1] for n, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    unreduced = [line for line in below if "partial_" not in line]
    # The ids that won their email, one per email, go back to the survivors.
    assert len(unreduced) == 1 and re.search(r"Filter isnotnull\(employee_id#\d+\)", unreduced[0])
    assert sum("SortMergeJoin" in line for line in lines) == 1
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()

"""The jobs against plain loops over small random inputs with hot keys, copies and nulls."""

import random
import re
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest

from sievetally.operators.rejects import quarantine, reject_funnel
from sievetally.plans.employees import clean_employees
from sievetally.plans.transactions import daily_totals, stage_counts
from sievetally.schemas import EMPLOYEE, EMPLOYEE_ORDER, REQUIRED_EMPLOYEE, TRANSACTION

AS_OF = date(2024, 1, 1)
NAMES = EMPLOYEE.names


def random_employee(rng):
    email = rng.choice(["a", "B", "c.d", "e"]) + str(rng.randrange(25)) + rng.choice(["@x.co", "@X.CO", "@company", ""])
    return {
        "employee_id": 7 if rng.random() < 0.33 else rng.choice([None, *range(20, 300)]),
        "first_name": rng.choice([None, "ann", "BO", " ", "mary-ann  lee"]),
        "last_name": rng.choice(["o'neil", "VAN dam", "", "rao"]),
        "email": "hot@x.co" if rng.random() < 0.2 else rng.choice([None, *[email] * 20]),
        "hire_date": rng.choice([None, *[AS_OF + timedelta(days=rng.choice([0, 1, 300, -rng.randrange(40000)]))] * 15]),
        "job_title": None,
        "department": rng.choice([None, "IT"]),
        "salary": rng.choice([None, "n/a", "₹1,250,000", "49999.99", "50000", "80000", "80000.01", "$7,0", "99999999999"]),
        "manager_id": rng.choice([None, 5000]),
        "address": "x",
        "city": "y",
        "state": "MH",
        "zip_code": "012345",
        "birth_date": rng.choice([None, date(1990, 1, 1), date(2025, 1, 1), date(1884, 6, 1)]),
        "status": rng.choice([None, "Active", "INACTIVE", "inActive", "retired"]),
    }


def rank(row, order):
    """Nulls first, as the ascending order of Spark."""
    return tuple((row[c] is not None, row[c] if row[c] is not None else 0) for c in order)


def first_per_key(rows, key, order):
    groups = defaultdict(list)
    for row in rows:
        groups[row[key]].append(row)
    winners, losers = [], []
    for group in groups.values():
        group.sort(key=lambda r: rank(r, order))
        winners.append(group[0])
        losers += group[1:]
    return winners, losers


def half_up(value, places):
    return Decimal(repr(value)).quantize(Decimal(places), rounding="ROUND_HALF_UP")


def derive(row):
    def name(text):
        return " ".join(word[:1].upper() + word[1:] for word in text.lower().split(" "))

    salary = None
    text = re.sub("[₹$,]", "", row["salary"] or "")
    if re.fullmatch(r"[0-9]+(\.[0-9]+)?", text) and Decimal(text) < 10**8:
        salary = Decimal(text).quantize(Decimal("0.01"))
    tenure = half_up((AS_OF - row["hire_date"]).days / 365, "0.1")
    first, last = name(row["first_name"]), name(row["last_name"])
    return {
        "employee_id": row["employee_id"],
        "first_name": first,
        "last_name": last,
        "full_name": f"{first} {last}".strip(" "),
        "email": row["email"].lower(),
        "email_domain": row["email"].lower().split("@")[1],
        "hire_date": row["hire_date"],
        "salary": salary,
        "salary_band": "Senior" if salary is None or salary > 80000 else "Mid" if salary >= 50000 else "Junior",
        "age": (AS_OF - row["birth_date"]).days // 365 if row["birth_date"] else None,
        "tenure_years": tenure if tenure < 100 else None,
        "status": "Inactive" if (row["status"] or "").lower() == "inactive" else "Active",
    }


def brute_force_employees(rows):
    rejects = Counter()

    def reject(lost, reason):
        for row in lost:
            rejects[tuple(row[c] for c in NAMES), reason] += 1

    complete = [r for r in rows if all(r[c] is not None for c in REQUIRED_EMPLOYEE)]
    reject([r for r in rows if r not in complete], "null_required")
    order = EMPLOYEE_ORDER + [c for c in NAMES if c not in EMPLOYEE_ORDER and c != "employee_id"]
    unique, lost = first_per_key(complete, "employee_id", order)
    reject(lost, "duplicate_employee_id")
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
    good = [r for r in unique if pattern.fullmatch(r["email"])]
    reject([r for r in unique if r not in good], "bad_email")
    hired = [r for r in good if r["hire_date"] <= AS_OF]
    reject([r for r in good if r not in hired], "future_hire")
    keyed = [{**r, "_key": r["email"].lower()} for r in hired]
    kept, lost = first_per_key(keyed, "_key", ["employee_id"])
    reject(lost, "duplicate_email")
    return [derive(r) for r in kept], rejects


@pytest.mark.parametrize("seed", range(4))
def test_employees(spark, seed):
    rng = random.Random(seed)
    rows = [random_employee(rng) for _ in range(300)]
    rows += [dict(rng.choice(rows)) for _ in range(150)]
    rng.shuffle(rows)
    kept, rejects = brute_force_employees(rows)
    assert len(kept) > 10 and len({reason for _, reason in rejects}) == 5

    df = spark.createDataFrame([tuple(r[c] for c in NAMES) for r in rows], EMPLOYEE).repartition(5)
    columns = list(kept[0])
    found = {tuple(r) for r in clean_employees(df, AS_OF).select(*columns).collect()}
    assert found == {tuple(r.values()) for r in kept}

    lost = Counter()
    for r in quarantine(df, AS_OF).collect():
        lost[tuple(r[c] for c in NAMES), r["reject_reason"]] += r["copies"]
    assert lost == rejects

    per_reason = Counter()
    for (_, reason), copies in rejects.items():
        per_reason[reason] += copies
    funnel = {r["stage"]: r["rows"] for r in reject_funnel(df, AS_OF).collect()}
    assert funnel == {"raw": 450, "accepted": len(kept), **per_reason}


@pytest.mark.parametrize("seed", range(4))
def test_transactions(spark, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = []
    for i in range(600):
        rows.append(
            {
                "transaction_id": "HOT" if rng.random() < 0.33 else rng.choice([None, *[f"T{rng.randrange(200)}"] * 30]),
                "customer_id": "C" if rng.random() < 0.33 else rng.choice([None, "C1", "C2", "C3"]),
                "amount": rng.choice([None, *[Decimal(rng.randrange(-500, 5000)) / 100] * 10]),
                "timestamp": start + timedelta(hours=rng.randrange(72)),
                "merchant": rng.choice("AB"),
            }
        )
    order = ["timestamp", "customer_id", "amount", "merchant"]
    first, _ = first_per_key(rows, "transaction_id", order)
    totals = defaultdict(list)
    for r in first:
        if r["amount"] is not None and r["amount"] > 0:
            totals[r["customer_id"], r["timestamp"].date()].append(r["amount"])
    expected = {(c, d, float(sum(a)), len(a)) for (c, d), a in totals.items()}

    df = spark.createDataFrame([tuple(r[c] for c in TRANSACTION.names) for r in rows], TRANSACTION).repartition(6)
    assert {tuple(r) for r in daily_totals(df).collect()} == expected
    counts = {r["stage"]: r["rows"] for r in stage_counts(df).collect()}
    assert counts == {
        "raw": 600,
        "deduplicated": len(first),
        "positive": sum(len(a) for a in totals.values()),
        "daily_totals": len(expected),
    }

"""The catalog's queries as plain SQL over the same tables, for checking results in another engine."""

from __future__ import annotations

from sievetally.schemas import CLEAN_EMPLOYEE, EMPLOYEE, TRANSACTION

# Written out here once more, so that a slip in the jobs' own values shows.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
MERCHANTS = ["Harbour Books", "Corner Bakery", "Lantern Travel", "Maple Hardware", "Tidewater Grill", "Juniper Pharmacy"]
JOB_TITLES = ["Archivist", "Crane Operator", "Payroll Clerk", "Field Surveyor", "Translator", "Lab Technician", "Night Porter"]
DEPARTMENTS = ["Warehouse", "Legal", "Research", "Fleet", "Catering"]
STATES = ["QA", "QB", "QC", "QD", "QE", "QF", "QG"]
STATUSES = ["Active", "active", "INACTIVE", None]
EMAIL_DOMAINS = ["company.com", "COMPANY.COM"]
FIRST_NAMES = ["Aarav", "Diya", "Ishaan", "Kavya", "Meera", "Nikhil", "Priya", "Rohan", "Sana", "Vikram"]
LAST_NAMES = ["Bose", "Das", "Gupta", "Iyer", "Joshi", "Khan", "Nair", "Patel", "Rao", "Singh"]
CITIES = ["Mumbai", "Pune", "Chennai", "Delhi", "Hyderabad", "Jaipur", "Kolkata", "Surat"]

AS_OF = "DATE '2024-01-01'"


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


def _entry(values) -> str:
    return f"{_list(values)}[CAST(c_custkey % {len(values)} AS INT) + 1]"


TXN = """txn AS (
  SELECT 'T' || CAST(CASE WHEN event_id % 20 = 0 AND event_id > 0 THEN event_id - 1 ELSE event_id END AS VARCHAR)
           AS transaction_id,
         'C' || CAST(1000 + user_id % 101 AS VARCHAR) AS customer_id,
         CAST(CAST(value AS DECIMAL(12,2)) - 5 AS DECIMAL(12,2)) AS amount,
         ts AS "timestamp",
         event_type AS merchant
  FROM events)"""

TXN_FIRST = """txn_first AS (
  SELECT * FROM txn
  QUALIFY row_number() OVER (PARTITION BY transaction_id
    ORDER BY "timestamp", customer_id, amount, merchant) = 1)"""

DAILY = """daily AS (
  SELECT customer_id, CAST("timestamp" AS DATE) AS transaction_date,
         CAST(sum(amount) AS DOUBLE) AS total_amount, count(*) AS transaction_count
  FROM txn_first WHERE amount > 0 GROUP BY 1, 2)"""

TXN_FLOAT = """txn AS (
  SELECT 'T' || CAST(CASE WHEN event_id % 20 = 0 AND event_id > 0 THEN event_id - 1 ELSE event_id END AS VARCHAR)
           AS transaction_id,
         'C' || CAST(1000 + user_id % 101 AS VARCHAR) AS customer_id,
         CASE event_id % 97 WHEN 0 THEN CAST('0.004' AS DOUBLE) WHEN 1 THEN CAST('1e10' AS DOUBLE) WHEN 2 THEN CAST('-1e10' AS DOUBLE)
           WHEN 3 THEN CAST('NaN' AS DOUBLE) WHEN 4 THEN CAST('Infinity' AS DOUBLE) WHEN 5 THEN CAST('-Infinity' AS DOUBLE)
           WHEN 6 THEN NULL ELSE CAST(CAST(value AS DECIMAL(12,2)) - 5 AS DOUBLE) END AS amount,
         ts AS "timestamp"
  FROM events)"""

TXN_FLOAT_FIRST = """txn_first AS (
  SELECT * FROM txn
  QUALIFY row_number() OVER (PARTITION BY transaction_id
    ORDER BY "timestamp", customer_id, amount NULLS FIRST) = 1)"""

DAILY_FLOAT = """daily AS (
  SELECT customer_id, CAST("timestamp" AS DATE) AS transaction_date,
         CAST(sum(CAST(amount AS DECIMAL(25,3))) AS DOUBLE) AS total_amount, count(*) AS transaction_count
  FROM txn_first WHERE amount > 0 AND isfinite(amount) GROUP BY 1, 2)"""

EMP = f"""emp AS (
  SELECT CAST(CASE WHEN c_custkey % 10 = 0 THEN 1000 + c_custkey % 101 ELSE 5000 + c_custkey END AS INT) AS employee_id,
         CASE WHEN c_custkey % 37 = 0 THEN NULL
              WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE upper(c_mktsegment) END AS first_name,
         'van ' || lower(replace(c_name, '#', '-')) AS last_name,
         CASE WHEN c_custkey % 7 = 0 THEN c_mktsegment || '@company'
              ELSE c_mktsegment || '.' || CAST(c_custkey % 900 + (c_custkey - 1) // 15000 * 900 AS VARCHAR)
                || CASE WHEN c_custkey % 2 = 0 THEN '@company.com' ELSE '@COMPANY.COM' END END AS email,
         CAST(DATE '2014-01-01' + CAST(c_custkey * 13 % 4380 AS INT) AS DATE) AS hire_date,
         {_entry(JOB_TITLES)} AS job_title,
         {_entry(DEPARTMENTS)} AS department,
         CASE WHEN c_custkey % 41 = 0 THEN NULL
              WHEN c_custkey % 53 = 0 THEN 'n/a'
              WHEN c_custkey % 5 < 2 THEN '₹' || CAST(CAST(floor(abs(c_acctbal) / 100) AS BIGINT) AS VARCHAR) || ','
                || lpad(CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 1000 AS VARCHAR), 3, '0')
              ELSE CAST(CAST(floor(abs(c_acctbal) * 10) AS BIGINT) AS VARCHAR) END AS salary,
         CAST(CASE WHEN c_custkey % 2 = 0 THEN 5000 + c_custkey % 201 END AS INT) AS manager_id,
         CAST(c_custkey % 999 AS VARCHAR) || ', "Lake View" Road,'
           || CASE c_custkey % 11 WHEN 0 THEN chr(10) WHEN 1 THEN chr(13) || chr(10) WHEN 2 THEN ' 5%0A ' ELSE ' ' END
           || 'Block ' || CAST(c_nationkey AS VARCHAR) AS address,
         {_entry(CITIES)} AS city,
         {_entry(STATES)} AS state,
         lpad(CAST(c_custkey % 1000000 AS VARCHAR), 6, '0') AS zip_code,
         CAST(DATE '1964-01-01' + CAST(c_custkey * 29 % 14000 AS INT) AS DATE) AS birth_date,
         CASE c_custkey % 4 WHEN 0 THEN 'Active' WHEN 1 THEN 'active' WHEN 2 THEN 'INACTIVE' END AS status
  FROM customer)"""

COMPLETE = "employee_id IS NOT NULL AND first_name IS NOT NULL AND last_name IS NOT NULL AND email IS NOT NULL AND hire_date IS NOT NULL"
GOOD_EMAIL = f"regexp_matches(email, '{EMAIL_PATTERN}')"

EMP_FIRST = f"""emp_first AS (
  SELECT * FROM emp WHERE {COMPLETE}
  QUALIFY row_number() OVER (PARTITION BY employee_id
    ORDER BY hire_date, email, first_name, last_name, birth_date) = 1)"""

EMP_VALID = f"""emp_valid AS (
  SELECT * REPLACE (lower(email) AS email) FROM emp_first
  WHERE {GOOD_EMAIL} AND hire_date <= {AS_OF})"""

EMP_UNIQUE = """emp_unique AS (
  SELECT * FROM emp_valid
  QUALIFY row_number() OVER (PARTITION BY email ORDER BY employee_id) = 1)"""


def _name(column: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({column}), ' '), "
        "lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"
    )


SALARY = "TRY_CAST(regexp_replace(salary, '[₹$,]', '', 'g') AS DECIMAL(10,2))"
BAND = f"CASE WHEN {SALARY} < 50000 THEN 'Junior' WHEN {SALARY} <= 80000 THEN 'Mid' ELSE 'Senior' END"
STATUS = "CASE WHEN lower(status) = 'inactive' THEN 'Inactive' ELSE 'Active' END"
AGE = f"CAST(floor(date_diff('day', birth_date, {AS_OF}) / 365) AS INT)"
TENURE = f"TRY_CAST(date_diff('day', hire_date, {AS_OF}) / 365 AS DECIMAL(3,1))"
DOMAIN = "nullif(split_part(email, '@', 2), '')"

DERIVED = {
    "first_name": _name("first_name"),
    "last_name": _name("last_name"),
    "full_name": f"trim({_name('first_name')} || ' ' || {_name('last_name')})",
    "email_domain": DOMAIN,
    "salary": SALARY,
    "salary_band": BAND,
    "age": AGE,
    "tenure_years": TENURE,
    "status": STATUS,
}
CLEAN = (
    "clean AS (\n  SELECT "
    + ",\n         ".join(f"{DERIVED.get(c, c)} AS {c}" for c in CLEAN_EMPLOYEE.names)
    + "\n  FROM emp_unique)"
)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


TXN_ALL = _with(TXN)
DAILY_ALL = _with(TXN, TXN_FIRST, DAILY)
EMP_ALL = _with(EMP)
CLEAN_ALL = _with(EMP, EMP_FIRST, EMP_VALID, EMP_UNIQUE, CLEAN)
TXN_ROWS = 'transaction_id, customer_id, amount, "timestamp", merchant'
SERVED = """SELECT customer_id, transaction_date, total_amount,
       CAST(transaction_count AS INT) AS transaction_count FROM daily"""

# Checks: one output row per rule.


def _violations(rule: str, column: str, condition: str, source: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{column}' AS \"column\", "
        f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT) AS violations FROM {source}"
    )


def _duplicates(key: list[str], source: str) -> str:
    columns = ", ".join(key)
    given = " AND ".join(f"{c} IS NOT NULL" for c in key)
    return (
        f"SELECT 'unique' AS rule, '{','.join(key)}' AS \"column\", "
        f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations "
        f"FROM (SELECT count(*) AS n FROM {source} WHERE {given} GROUP BY {columns})"
    )


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


REQUIRED = ["employee_id", "first_name", "last_name", "email", "hire_date"]
TENURE_2150 = "CAST(date_diff('day', hire_date, DATE '2150-01-01') AS DOUBLE) / 365"

# Rejects: first failing stage per row; ranks are taken among the rows that reach the stage.
JUDGED = f"""ranked AS (
  SELECT *, {COMPLETE} AS complete,
         row_number() OVER (PARTITION BY CASE WHEN {COMPLETE} THEN employee_id END, {COMPLETE}
           ORDER BY hire_date, email, first_name, last_name, birth_date) AS id_rank
  FROM emp),
staged AS (
  SELECT *, CASE WHEN NOT complete THEN 'null_required'
                 WHEN id_rank > 1 THEN 'duplicate_employee_id'
                 WHEN NOT {GOOD_EMAIL} THEN 'bad_email'
                 WHEN hire_date > {AS_OF} THEN 'future_hire' END AS early_reason
  FROM ranked),
judged AS (
  SELECT *, CASE WHEN early_reason IS NOT NULL THEN early_reason
                 WHEN row_number() OVER (PARTITION BY early_reason, lower(email) ORDER BY employee_id) > 1
                   THEN 'duplicate_email'
                 ELSE 'accepted' END AS verdict
  FROM staged)"""
VERDICTS = ["null_required", "duplicate_employee_id", "bad_email", "future_hire", "duplicate_email", "accepted"]


def _schema_row(name: str, declared: str | None, found: str | None) -> str:
    declared_sql = f"'{declared}'" if declared else "CAST(NULL AS VARCHAR)"
    found_sql = f"'{found}'" if found else "CAST(NULL AS VARCHAR)"
    source = {"channel": "customer_id", "timestamp": '"timestamp"'}.get(name, name)
    value = f"count({source})" if found else "0 * count(*)"
    conforms = "TRUE" if declared == found else "FALSE"
    return (
        f"SELECT '{name}' AS column_name, {declared_sql} AS declared_type, {found_sql} AS found_type, "
        f"{conforms} AS conforms, {value} AS values_set FROM txn"
    )


# Generators.


def _draw(label: str, size: int, row: str = "id") -> str:
    return f"(CAST('0x' || substr(md5(CAST({row} AS VARCHAR) || '|{label}'), 1, 8) AS BIGINT) % {size})"


def _pick(label: str, values) -> str:
    return f"{_list(values)}[CAST({_draw(label, len(values))} AS INT) + 1]"


def _uuid(row: str, label: str) -> str:
    digest = f"md5(CAST({row} AS VARCHAR) || '|{label}')"
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({digest}, {start}, {length})" for start, length in parts)


SYNTH_TXN = f"""WITH ids AS (SELECT event_id AS id FROM events)
SELECT {_uuid("(CASE WHEN id % 20 = 0 AND id > 0 THEN id - 1 ELSE id END)", "transaction")} AS transaction_id,
       'C' || CAST({_draw("customer", 101)} + 1000 AS VARCHAR) AS customer_id,
       CAST(CAST({_draw("amount", 55001)} - 5000 AS DECIMAL(12,2)) * 0.01 AS DECIMAL(12,2)) AS amount,
       TIMESTAMP '2024-01-01 00:00:00' - to_hours(CAST({_draw("day", 6)} * 24 + {_draw("hour", 24)} AS INT)) AS "timestamp",
       {_pick("merchant", MERCHANTS)} AS merchant
FROM ids"""

SYNTH_EMP = f"""WITH ids AS (SELECT c_custkey AS id FROM customer),
drawn AS (
  SELECT id, {_pick("first", FIRST_NAMES)} AS first_drawn, {_pick("last", LAST_NAMES)} AS last_drawn,
         {_pick("city", CITIES)} AS city, {_draw("salary", 2700001)} + 300000 AS salary_drawn
  FROM ids)
SELECT CAST(CASE WHEN {_draw("collide", 10)} = 0 THEN {_draw("shared_id", 101)} + 1000 ELSE id + 5000 END AS INT)
         AS employee_id,
       CASE WHEN {_draw("first_case", 2)} = 0 THEN lower(first_drawn) ELSE upper(first_drawn) END AS first_name,
       CASE WHEN {_draw("last_case", 2)} = 0 THEN lower(last_drawn) ELSE upper(last_drawn) END AS last_name,
       CASE WHEN {_draw("bad_email", 100)} < 15 THEN first_drawn || '@company'
            ELSE first_drawn || '.' || last_drawn || '@' || {_pick("domain", EMAIL_DOMAINS)} END AS email,
       CAST({AS_OF} + CAST({_draw("hired", 4381)} - 3650 AS INT) AS DATE) AS hire_date,
       {_pick("title", JOB_TITLES)} AS job_title,
       {_pick("department", DEPARTMENTS)} AS department,
       CASE WHEN {_draw("currency", 10)} < 4 THEN '₹' || format('{{:,}}', salary_drawn)
            ELSE CAST(salary_drawn AS VARCHAR) END AS salary,
       CAST(CASE WHEN {_draw("managed", 2)} = 0 THEN {_draw("manager", 201)} + 5000 END AS INT) AS manager_id,
       CAST({_draw("house", 999)} + 1 AS VARCHAR) || ', ' || last_drawn || ' Road ' || city AS address,
       city,
       {_pick("state", STATES)} AS state,
       lpad(CAST({_draw("zip", 1000000)} AS VARCHAR), 6, '0') AS zip_code,
       CAST({AS_OF} - CAST({_draw("born", 14600)} + 7665 AS INT) AS DATE) AS birth_date,
       {_pick("status", STATUSES)} AS status
FROM drawn"""

_FOUND = {
    "transaction_id": "string",
    "customer_id": "string",
    "amount": "decimal(12,2)",
    "timestamp": "timestamp_ntz",
    "merchant": None,
}

# Cells that do not parse, by the number in the zip code; lines cut after five cells have no others.
_BAD = {"employee_id": "k % 31 = 4", "hire_date": "k % 29 = 3"}
LINE_IS_BAD = "(k % 43 = 5 OR k % 47 = 6)"
# The employees as they were before they became lines, and as they come back from lines.
EMP_LINES = EMP.replace("emp AS (", "delivered AS (", 1) + ", lines AS (SELECT *, CAST(zip_code AS INT) AS k FROM delivered)"


def _from_line(column: str) -> str:
    lost = _BAD.get(column, "FALSE") + ("" if column in EMPLOYEE.names[:5] else " OR k % 43 = 5")
    value = "regexp_replace(address, '\\r?\\n', ' ', 'g')" if column == "address" else column
    return f"CASE WHEN {lost} THEN NULL ELSE {value} END AS {column}"


EMP_AS_LINES = EMP_LINES + f", emp AS (SELECT {', '.join(map(_from_line, EMPLOYEE.names))}, k FROM lines)"

ORACLES: dict[str, str] = {
    "daily_totals": DAILY_ALL + "SELECT * FROM daily",
    "register_table": DAILY_ALL + "SELECT * FROM daily",
    "serving_projection": DAILY_ALL + SERVED,
    "serving_layout": DAILY_ALL + SERVED,
    "run_daily": DAILY_ALL + SERVED,
    "serving_upsert": _with(TXN, TXN_FIRST, DAILY)
    + """SELECT coalesce(d.customer_id, f.customer_id) AS customer_id,
       coalesce(d.transaction_date, f.transaction_date) AS transaction_date,
       coalesce(d.total_amount, f.total_amount) AS total_amount,
       CAST(coalesce(d.transaction_count, f.transaction_count) AS INT) AS transaction_count
FROM daily d FULL JOIN (
  SELECT customer_id, CAST("timestamp" AS DATE) AS transaction_date,
         CAST(sum(amount) AS DOUBLE) AS total_amount, count(*) AS transaction_count
  FROM txn WHERE amount > 0 GROUP BY 1, 2) f
ON d.customer_id = f.customer_id AND d.transaction_date = f.transaction_date""",
    "serving_upsert_days": _with(TXN, TXN_FIRST, DAILY)
    + """SELECT coalesce(d.customer_id, f.customer_id) AS customer_id,
       coalesce(d.transaction_date, f.transaction_date) AS transaction_date,
       coalesce(d.total_amount, f.total_amount) AS total_amount,
       CAST(coalesce(d.transaction_count, f.transaction_count) AS INT) AS transaction_count
FROM (SELECT * FROM daily WHERE transaction_date > (SELECT max(transaction_date) FROM daily) - 7) d FULL JOIN (
  SELECT customer_id, CAST("timestamp" AS DATE) AS transaction_date,
         CAST(sum(amount) AS DOUBLE) AS total_amount, count(*) AS transaction_count
  FROM txn WHERE amount > 0 GROUP BY 1, 2) f
ON d.customer_id = f.customer_id AND d.transaction_date = f.transaction_date""",
    "daily_totals_float": _with(TXN_FLOAT, TXN_FLOAT_FIRST, DAILY_FLOAT) + "SELECT * FROM daily",
    "stage_counts_float": _with(TXN_FLOAT, TXN_FLOAT_FIRST, DAILY_FLOAT)
    + _union(
        [
            "SELECT 'raw' AS stage, count(*) AS rows FROM txn",
            "SELECT 'deduplicated', count(*) FROM txn_first",
            "SELECT 'positive', count(*) FROM txn_first WHERE amount > 0 AND isfinite(amount)",
            "SELECT 'daily_totals', count(*) FROM daily",
        ]
    ),
    "dedupe_transactions": _with(TXN, TXN_FIRST) + f"SELECT {TXN_ROWS} FROM txn_first",
    "positive_amounts": TXN_ALL + f"SELECT {TXN_ROWS} FROM txn WHERE amount > 0",
    "managed_overwrite": TXN_ALL + f"SELECT {TXN_ROWS} FROM txn WHERE amount > 0",
    "managed_table_scan": TXN_ALL + f"SELECT {TXN_ROWS} FROM txn",
    "parquet_roundtrip": TXN_ALL + f"SELECT {TXN_ROWS} FROM txn",
    "transaction_date": TXN_ALL
    + 'SELECT transaction_id, amount, "timestamp", CAST("timestamp" AS DATE) AS transaction_date FROM txn',
    "stage_counts": DAILY_ALL
    + _union(
        [
            "SELECT 'raw' AS stage, count(*) AS rows FROM txn",
            "SELECT 'deduplicated', count(*) FROM txn_first",
            "SELECT 'positive', count(*) FROM txn_first WHERE amount > 0",
            "SELECT 'daily_totals', count(*) FROM daily",
        ]
    ),
    "parquet_scan": "SELECT * FROM events",
    "source_available": "SELECT 'events' AS source, TRUE AS available, count(*) > 0 AS has_rows FROM events",
    "publish_history": _with(TXN, TXN_FIRST)
    + """SELECT 'run-1' AS run_id, 'customer_transactions' AS table_name, 'WRITE' AS operation,
       'Overwrite' AS mode, count(*) AS num_output_rows FROM txn
UNION ALL SELECT 'run-2', 'customer_transactions', 'WRITE', 'Overwrite', count(*) FROM txn_first""",
    "employee_etl": CLEAN_ALL + "SELECT * FROM clean",
    "jdbc_roundtrip": CLEAN_ALL + "SELECT * FROM clean",
    "drop_null_required": EMP_ALL + f"SELECT * FROM emp WHERE {COMPLETE}",
    "dedupe_employee_id": _with(EMP, EMP_FIRST) + "SELECT * FROM emp_first",
    "valid_email": EMP_ALL + f"SELECT * FROM emp WHERE {GOOD_EMAIL}",
    "not_future_hire": EMP_ALL + f"SELECT * FROM emp WHERE hire_date <= {AS_OF}",
    "dedupe_email": _with(EMP, EMP_FIRST, EMP_VALID, EMP_UNIQUE) + "SELECT * FROM emp_unique",
    "standardize_names": EMP_ALL
    + f"SELECT zip_code, {_name('first_name')} AS first_name, {_name('last_name')} AS last_name FROM emp",
    "clean_salary": EMP_ALL + f"SELECT zip_code, salary AS salary_text, {SALARY} AS salary FROM emp",
    "salary_band": EMP_ALL + f"SELECT zip_code, {SALARY} AS salary, {BAND} AS salary_band FROM emp",
    "full_name": EMP_ALL + "SELECT zip_code, trim(concat_ws(' ', first_name, last_name)) AS full_name FROM emp",
    "email_parts": EMP_ALL
    + f"SELECT zip_code, email, {DOMAIN} AS email_domain FROM (SELECT zip_code, lower(email) AS email FROM emp)",
    "age_tenure": EMP_ALL
    + f"SELECT zip_code, birth_date, hire_date, {AGE} AS age, {TENURE} AS tenure_years FROM emp",
    "normalize_status": EMP_ALL + f"SELECT zip_code, status AS status_text, {STATUS} AS status FROM emp",
    "sql_count": CLEAN_ALL + "SELECT count(*) AS employees FROM clean",
    "sql_sample": CLEAN_ALL + "SELECT employee_id, full_name, salary FROM clean ORDER BY employee_id LIMIT 5",
    "csv_scan_typed": _with(EMP_AS_LINES) + f"SELECT {', '.join(EMPLOYEE.names)}, {LINE_IS_BAD} AS corrupt_line FROM emp",
    "unreadable_cells": _with(EMP_LINES)
    + """SELECT column_name, cell, count(*) AS rows FROM (
  SELECT 'employee_id' AS column_name, 'x' || CAST(employee_id AS VARCHAR) AS cell FROM lines WHERE k % 31 = 4
  UNION ALL SELECT 'hire_date', 'notadate' FROM lines WHERE k % 29 = 3
  UNION ALL SELECT 'salary', salary FROM lines WHERE salary IS NOT NULL AND k % 43 <> 5 AND """
    + f"{SALARY} IS NULL) GROUP BY ALL",
    "reject_funnel_lines": _with(EMP_AS_LINES, JUDGED)
    + _union(
        ["SELECT 'raw' AS stage, count(*) AS rows FROM judged"]
        + [f"SELECT '{v}', count(*) FROM judged WHERE verdict = '{v}'" for v in VERDICTS]
        + [f"SELECT 'corrupt_line', count(*) FROM lines WHERE {LINE_IS_BAD}"]
        + [f"SELECT 'unreadable_{c}', count(*) FROM lines WHERE {_BAD.get(c, 'FALSE')}" for c in ["employee_id", "hire_date", "manager_id", "birth_date"]]
        + [f"SELECT 'unreadable_salary', count(*) FROM lines WHERE salary IS NOT NULL AND k % 43 <> 5 AND {SALARY} IS NULL"]
    ),
    "csv_roundtrip": EMP_ALL
    + "SELECT "
    + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in EMPLOYEE.names)
    + " FROM emp",
    "check_unique": _with(EMP, TXN)
    + _union(
        [
            _duplicates(["employee_id"], "emp"),
            _duplicates(["email"], "emp"),
            _duplicates(["transaction_id"], "txn"),
            _duplicates(
                ["customer_id", "transaction_date"],
                '(SELECT customer_id, CAST("timestamp" AS DATE) AS transaction_date FROM txn)',
            ),
        ]
    ),
    "check_not_null": EMP_ALL
    + _union([_violations("not_null", c, f"{c} IS NULL", "emp") for c in [*REQUIRED, "salary", "status"]]),
    "check_length": EMP_ALL
    + _union(
        [
            _violations("max_length", c, f"length({c}) > {n}", "emp")
            for c, n in {"first_name": 8, "email": 22, "address": 34, "state": 2, "zip_code": 10}.items()
        ]
    ),
    "check_numeric_fit": EMP_ALL
    + _union(
        [
            _violations(
                "numeric_fit", "salary", "salary IS NOT NULL AND TRY_CAST(salary AS DECIMAL(10,2)) IS NULL", "emp"
            ),
            _violations("numeric_fit", "employee_id", "FALSE", "emp"),
            _violations("numeric_fit", "tenure_years", f"TRY_CAST({TENURE_2150} AS DECIMAL(3,1)) IS NULL", "emp"),
        ]
    ),
    "check_outcome": CLEAN_ALL
    + f"""SELECT 'clean_below_raw' AS rule, '*' AS "column",
       CAST(CASE WHEN (SELECT count(*) FROM clean) < (SELECT count(*) FROM emp) THEN 0 ELSE 1 END AS BIGINT) AS violations
UNION ALL SELECT 'critical_not_null', '{",".join(REQUIRED)}', count(*) FROM clean WHERE NOT ({COMPLETE})""",
    "check_schema": TXN_ALL
    + _union(
        [_schema_row(f.name, f.dataType.simpleString(), _FOUND[f.name]) for f in TRANSACTION]
        + [_schema_row("channel", None, "string")]
    ),
    "audit_columns": CLEAN_ALL
    + "SELECT employee_id, status, TIMESTAMP '2024-01-01 06:00:00' AS created_at, "
    "TIMESTAMP '2024-01-01 06:00:00' AS updated_at FROM clean",
    "reject_funnel": _with(EMP, JUDGED)
    + _union(
        ["SELECT 'raw' AS stage, count(*) AS rows FROM judged"]
        + [f"SELECT '{v}', count(*) FROM judged WHERE verdict = '{v}'" for v in VERDICTS]
    ),
    "reject_quarantine": _with(EMP, JUDGED)
    + f"SELECT {', '.join(EMPLOYEE.names)}, verdict AS reject_reason, count(*) AS copies "
    f"FROM judged WHERE verdict <> 'accepted' GROUP BY ALL",
    "synth_transactions": SYNTH_TXN,
    "synth_employees": SYNTH_EMP,
}

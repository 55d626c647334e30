"""The given test tables, reshaped into the inputs of the jobs, with dirt injected by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievetally.schemas import EMPLOYEE_TEXT
from sievetally.session import pin_settings, size_partitions
from sievetally.sources.synthetic import CITIES, DEPARTMENTS, JOB_TITLES, STATES

AS_OF = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_settings(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    size_partitions(spark, df)
    return df


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions: every 20th event repeats the id before it, about a tenth is not positive."""
    return table(spark, sf_dir, "events").selectExpr(
        "'T' || IF(event_id % 20 = 0 AND event_id > 0, event_id - 1, event_id) AS transaction_id",
        "'C' || (1000 + user_id % 101) AS customer_id",
        "CAST(CAST(value AS DECIMAL(12,2)) - 5 AS DECIMAL(12,2)) AS amount",
        "ts AS timestamp",
        "event_type AS merchant",
    )


def transactions_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same transactions with amounts as doubles, among them parts of a cent, very large, non-finite and missing ones."""
    return table(spark, sf_dir, "events").selectExpr(
        "'T' || IF(event_id % 20 = 0 AND event_id > 0, event_id - 1, event_id) AS transaction_id",
        "'C' || (1000 + user_id % 101) AS customer_id",
        """CASE event_id % 97 WHEN 0 THEN DOUBLE('0.004') WHEN 1 THEN DOUBLE('1e10') WHEN 2 THEN DOUBLE('-1e10')
             WHEN 3 THEN DOUBLE('NaN') WHEN 4 THEN DOUBLE('Infinity') WHEN 5 THEN DOUBLE('-Infinity') WHEN 6 THEN NULL
             ELSE CAST(CAST(value AS DECIMAL(12,2)) - 5 AS DOUBLE) END AS amount""",
        "ts AS timestamp",
        "event_type AS merchant",
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw employees: colliding ids, bad and shared emails, odd salaries, missing names."""

    def entry(values):
        words = ", ".join(f"'{v}'" for v in values)
        return f"GET(ARRAY({words}), CAST(c_custkey % {len(values)} AS INT))"

    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(IF(c_custkey % 10 = 0, 1000 + c_custkey % 101, 5000 + c_custkey) AS INT) AS employee_id",
        """CASE WHEN c_custkey % 37 = 0 THEN NULL
                WHEN c_custkey % 2 = 0 THEN LOWER(c_mktsegment) ELSE UPPER(c_mktsegment) END AS first_name""",
        "'van ' || LOWER(REPLACE(c_name, '#', '-')) AS last_name",
        """CASE WHEN c_custkey % 7 = 0 THEN c_mktsegment || '@company'
                ELSE c_mktsegment || '.' || (c_custkey % 900 + (c_custkey - 1) DIV 15000 * 900)
                  || IF(c_custkey % 2 = 0, '@company.com', '@COMPANY.COM') END AS email""",
        "DATE_ADD(DATE'2014-01-01', CAST(c_custkey * 13 % 4380 AS INT)) AS hire_date",
        f"{entry(JOB_TITLES)} AS job_title",
        f"{entry(DEPARTMENTS)} AS department",
        """CASE WHEN c_custkey % 41 = 0 THEN NULL
                WHEN c_custkey % 53 = 0 THEN 'n/a'
                WHEN c_custkey % 5 < 2 THEN '₹' || FLOOR(ABS(c_acctbal) / 100) || ','
                  || LPAD(CAST(FLOOR(ABS(c_acctbal)) % 1000 AS STRING), 3, '0')
                ELSE CAST(FLOOR(ABS(c_acctbal) * 10) AS STRING) END AS salary""",
        "CAST(IF(c_custkey % 2 = 0, 5000 + c_custkey % 201, NULL) AS INT) AS manager_id",
        """c_custkey % 999 || ', "Lake View" Road,' || CASE c_custkey % 11 WHEN 0 THEN '\\n' WHEN 1 THEN '\\r\\n' WHEN 2 THEN ' 5%0A ' ELSE ' ' END
             || 'Block ' || c_nationkey AS address""",
        f"{entry(CITIES)} AS city",
        f"{entry(STATES)} AS state",
        "LPAD(CAST(c_custkey % 1000000 AS STRING), 6, '0') AS zip_code",
        "DATE_ADD(DATE'1964-01-01', CAST(c_custkey * 29 % 14000 AS INT)) AS birth_date",
        "CASE c_custkey % 4 WHEN 0 THEN 'Active' WHEN 1 THEN 'active' WHEN 2 THEN 'INACTIVE' END AS status",
    )


def employee_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The employees as lines of a CSV file without header: some ids and dates do not parse, some lines are cut short or too long.

    They go by the last digits of the zip code, which are those of the customer key.
    """
    text, key = employees_text(spark, sf_dir), F.col("zip_code").cast("int")
    text = text.withColumn("address", F.regexp_replace("address", r"\r?\n", " "))
    text = text.withColumn("hire_date", F.when(key % 29 == 3, "notadate").otherwise(F.col("hire_date")))
    text = text.withColumn("employee_id", F.when(key % 31 == 4, F.concat(F.lit("x"), "employee_id")).otherwise(F.col("employee_id")))
    line = F.to_csv(F.struct(*EMPLOYEE_TEXT.names), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    cut = F.when(key % 43 == 5, F.substring_index(line, ",", 5)).when(key % 47 == 6, F.concat(line, F.lit(",surplus,cells")))
    return text.select(cut.otherwise(line).alias("value"))


def employees_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same employees as the text of a CSV file."""
    df = employees(spark, sf_dir)
    return df.select(*[F.col(c).cast("string").alias(c) for c in EMPLOYEE_TEXT.names])

"""Table contracts checked before a write.

Every check returns rows (rule, column, violations), so reports can be united, stored and
compared; `require` turns a report into an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievetally.operators.reports import spread

class ContractViolation(ValueError):
    """Data or schema breaks the contract of the table it was meant for."""


# A rule that looks at one row: name, column, and the condition that breaks it.
RowRule = tuple[str, str, Column]


def _count_broken(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """All rules in one scan, one output row per rule."""
    counts = df.agg(*[F.count_if(broken).alias(f"_{number}") for number, (_, _, broken) in enumerate(rules)])
    rows = [
        F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.col(f"_{number}").alias("violations"))
        for number, (rule, column, _) in enumerate(rules)
    ]
    return spread(counts, rows)


def _null_rules(columns: Sequence[str]) -> list[RowRule]:
    return [("not_null", c, F.col(c).isNull()) for c in columns]


def _length_rules(limits: Mapping[str, int]) -> list[RowRule]:
    return [("max_length", c, F.length(c) > n) for c, n in limits.items()]


def _numeric_rules(types: Mapping[str, str]) -> list[RowRule]:
    return [("numeric_fit", c, F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()) for c, t in types.items()]


def check_unique(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """Rows beyond the first of each key, one row per key; rows with a null in the key do not clash."""
    report = None
    for key in keys:
        extra = (
            df.select(*key)
            .dropna(subset=list(key))
            .groupBy(*key)
            .agg((F.count("*") - 1).alias("extra"))
            .agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("violations"))
            .select(F.lit("unique").alias("rule"), F.lit(",".join(key)).alias("column"), "violations")
        )
        report = extra if report is None else report.unionByName(extra)
    return report


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _count_broken(df, _null_rules(columns))


def check_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    return _count_broken(df, _length_rules(limits))


def check_numeric_fit(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Values that are set but do not fit the declared numeric type."""
    return _count_broken(df, _numeric_rules(types))


def check_outcome(raw: DataFrame, clean: DataFrame, critical: Sequence[str]) -> DataFrame:
    """Cleansing must lose rows and leave no null in a critical column."""
    any_null = F.lit(False)
    for name in critical:
        any_null = any_null | F.col(name).isNull()
    rows = raw.select(F.lit(1).alias("raw"), F.lit(0).alias("clean"), F.lit(0).alias("nulls")).unionByName(
        clean.select(F.lit(0).alias("raw"), F.lit(1).alias("clean"), any_null.cast("int").alias("nulls"))
    )
    counts = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("raw", "clean", "nulls")])
    return spread(
        counts,
        [
            F.struct(
                F.lit("clean_below_raw").alias("rule"),
                F.lit("*").alias("column"),
                F.when(F.col("clean") < F.col("raw"), 0).otherwise(1).cast("bigint").alias("violations"),
            ),
            F.struct(
                F.lit("critical_not_null").alias("rule"),
                F.lit(",".join(critical)).alias("column"),
                F.col("nulls").alias("violations"),
            ),
        ],
    )


def check_all(
    df: DataFrame,
    unique: Sequence[Sequence[str]] = (),
    not_null: Sequence[str] = (),
    max_length: Mapping[str, int] | None = None,
    numeric: Mapping[str, str] | None = None,
) -> DataFrame:
    """The named checks in one report: one scan per key and one for all other rules."""
    rules = _null_rules(not_null) + _length_rules(max_length or {}) + _numeric_rules(numeric or {})
    if not rules:
        return check_unique(df, unique)
    report = _count_broken(df, rules)
    return check_unique(df, unique).unionByName(report) if unique else report


def require(report: DataFrame) -> None:
    """Raise if any rule is broken. A report has one row per rule, so it is small."""
    broken = report.filter(F.col("violations") > 0).collect()
    if broken:
        lines = [f"{r['rule']}({r['column']}): {r['violations']}" for r in broken]
        raise ContractViolation("; ".join(lines))


def check_schema(df: DataFrame, declared: StructType) -> DataFrame:
    """One row per declared or found column: both types, whether they agree, and how many values are set."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in declared}
    names = list(wanted) + [c for c in found if c not in wanted]
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in found])
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(wanted.get(name)).cast("string").alias("declared_type"),
            F.lit(found.get(name)).cast("string").alias("found_type"),
            F.lit(wanted.get(name) == found.get(name)).alias("conforms"),
            (F.col(name) if name in found else F.lit(0).cast("bigint")).alias("values_set"),
        )
        for name in names
    ]
    return spread(counts, rows)


def enforce_schema(df: DataFrame, declared: StructType) -> DataFrame:
    """df in declared column order; a missing, extra or differently typed column raises."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in declared}
    drift = [
        f"{name}: declared {wanted.get(name, 'nothing')}, found {found.get(name, 'nothing')}"
        for name in list(wanted) + [c for c in found if c not in wanted]
        if wanted.get(name) != found.get(name)
    ]
    if drift:
        raise ContractViolation("schema drift: " + "; ".join(drift))
    return df.select(*wanted)


def add_audit_columns(df: DataFrame, run_ts: datetime | str) -> DataFrame:
    """created_at and updated_at for sinks without column defaults; one value for the whole run.

    The value is UTC; a datetime without zone is taken as it is, whatever zone the driver is in.
    """
    if isinstance(run_ts, datetime) and run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(timezone.utc).replace(tzinfo=None)
    stamp = F.lit(str(run_ts)).cast("timestamp_ntz")
    return df.withColumns({"created_at": stamp, "updated_at": stamp})

"""The jobs as commands: spark-submit --py-files sievetally.zip run_job.py <job> ..."""

from __future__ import annotations

import argparse
import json
import os
from datetime import timedelta
from functools import partial

from pyspark.sql import functions as F

from sievetally.plans import employees, transactions
from sievetally.session import build_session
from sievetally.sinks import managed
from sievetally.sinks.files import write_csv, write_parquet
from sievetally.sinks.managed import default_format
from sievetally.sinks.serving import CqlStore
from sievetally.sources.managed import read_managed, source_available
from sievetally.sources.synthetic import row_ids, synth_employees, synth_transactions


def generate_employees(spark, args):
    df = synth_employees(row_ids(spark, args.rows), args.as_of)
    write_csv(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]), args.out)
    return {"rows": args.rows}


def clean_employees(spark, args):
    password = os.environ.get(args.password_env, "") if args.password_env else ""
    return employees.load_employees(
        spark, args.input, args.url, args.table, args.driver, args.as_of, args.user, password,
        column_types=args.column_types, quarantine_path=args.quarantine, writers=args.writers, escaped=args.escaped,
    )


def generate_transactions(spark, args):
    write_parquet(synth_transactions(row_ids(spark, args.rows), args.base_time), args.out, args.files)
    return {"rows": args.rows}


def _publish(job, spark, args, *source, **options):
    log = job(spark, *source, args.root, args.name, fmt=default_format(spark), **options)
    log.show(truncate=False)
    return {"published": args.name or args.root}


def publish_transactions(spark, args):
    return _publish(transactions.publish_transactions, spark, args, args.raw)


def daily_totals(spark, args):
    days = ["transaction_date"] if args.by_day else None
    return _publish(transactions.publish_daily_totals, spark, args, partition_by=days)


def check_source(spark, args):
    fmt, name = default_format(spark), transactions.TRANSACTIONS
    return source_available(read_managed(spark, name, args.root, fmt), name).head().asDict()


def _store(args):
    """The store to load, or None for the served table."""
    return partial(CqlStore, args.hosts.split(","), args.keyspace, args.table) if args.hosts else None


def load_serving(spark, args):
    served = transactions.load_daily_totals(spark, args.root, _store(args), args.writers, default_format(spark))
    return {"served": served}


def run_daily(spark, args):
    return transactions.run_daily(spark, args.root, _store(args), args.writers, fmt=default_format(spark))


def remove_old_versions(spark, args):
    return {"removed": managed.remove_old_versions(spark, args.table, args.root, timedelta(hours=args.hours))}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, *options):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for flag, settings in options:
            sub.add_argument(flag, **settings)

    needed, optional = {"required": True}, {"default": None}
    rows = ("--rows", {"type": int, "default": 1200})
    root, name = ("--root", needed), ("--name", optional)
    store = [
        ("--hosts", {"default": None, "help": "hosts of a serving store; without them the served table below the root is loaded"}),
        ("--keyspace", {"default": "analytics"}),
        ("--table", {"default": transactions.DAILY_TOTALS}),
        ("--writers", {"type": int, "default": None, "help": "bound on tasks that write to the store at a time"}),
    ]
    job("generate-employees", generate_employees, rows, ("--out", needed), ("--as-of", optional))
    job(
        "clean-employees", clean_employees, ("--input", needed), ("--url", needed),
        ("--table", {"default": "employees_clean"}), ("--driver", {"default": "org.postgresql.Driver"}),
        ("--user", {"default": ""}), ("--password-env", optional), ("--as-of", optional), ("--quarantine", optional),
        ("--writers", {"type": int, "default": 8}),
        ("--escaped", {"action": "store_true", "help": "the file was written by this library: line breaks within texts come back"}),
        ("--column-types", {"default": None, "help": "column types of the staging table, as in Spark's createTableColumnTypes"}),
    )
    job(
        "generate-transactions", generate_transactions, rows, ("--out", needed), ("--base-time", needed),
        ("--files", {"type": int, "default": None}),
    )
    job("publish-transactions", publish_transactions, ("--raw", needed), root, name)
    job("daily-totals", daily_totals, root, name, ("--by-day", {"action": "store_true"}))
    job("check-source", check_source, root)
    job("load-serving", load_serving, root, *store)
    job("run-daily", run_daily, root, *store)
    job(
        "remove-old-versions", remove_old_versions, root, ("--table", needed),
        ("--hours", {"type": float, "default": 168.0, "help": "age from which replaced versions go; longer than any reader works on one"}),
    )
    return top


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    result = args.run(build_session(f"sievetally {args.job}"), args)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()

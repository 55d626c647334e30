"""Managed tables: full overwrite, upsert of the partitions that a load touches, catalog names and removal of old versions.

With Delta on the session the table format does this. Without it, each publish writes a new
folder and then adds the next numbered record to the table's `versions`; that record is the commit. Readers
go by the newest record, so they see either the old table or the new one, whichever publish ended last, and a
table may be rebuilt from itself. No record is ever replaced: of two publishes that end at the same time
one takes the next number.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievetally.operators.contracts import enforce_schema
from sievetally.sinks.files import sized
from sievetally.sources.managed import (
    RUN_FOLDER,
    VERSIONS,
    hadoop_path,
    is_published,
    list_folder,
    newest_version,
    read_managed,
    read_record,
    read_version,
    table_folder,
    version_numbers,
)

# Tries of an upsert that other publishes of the table overtake.
MERGE_TRIES = 5
# What follows a name in the catalog entry of one version of it.
VERSION_MARK = "__at_"


def default_format(spark: SparkSession) -> str:
    extensions = spark.conf.get("spark.sql.extensions", None) or ""
    return "delta" if "DeltaSparkSessionExtension" in extensions else "parquet"


def _utc(moment: datetime | None) -> datetime:
    """The moment, by default now; without zone it is UTC."""
    moment = moment or datetime.now(timezone.utc)
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """A new file with the text, seen as a whole or not at all; False if the name is taken."""
    fs, place = hadoop_path(spark, path)
    _, draft = hadoop_path(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    full = fs.makeQualified(draft), fs.makeQualified(place)
    try:
        if fs.getUri().getScheme() == "file":
            # A rename on a local disk may replace a file; a second name for a file never does.
            names = [spark._jvm.java.nio.file.Paths.get(p.toUri()) for p in full]
            spark._jvm.java.nio.file.Files.createLink(names[1], names[0])
        else:
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
            context.rename(*full, spark._sc._gateway.new_array(rename, 0))
        return True
    except Exception:
        if fs.exists(place):
            return False
        raise
    finally:
        fs.delete(draft, False)


def _commit(spark: SparkSession, table: str, root: str, record: dict, after: int | None = None) -> bool:
    """Add the record as the next version; False if `after` is given and no longer the newest."""
    while True:
        newest = max(version_numbers(spark, table, root), default=0)
        if after is not None and newest != after:
            return False
        line = json.dumps({"version": newest + 1, "table_name": table, **record})
        if _create(spark, f"{table_folder(table, root)}/{VERSIONS}/{newest + 1:012d}.json", line):
            return True


def _write(df: DataFrame, table: str, root: str, fmt: str, partition_by: list[str] | None, files: int | None, run_id: str) -> tuple[str, int]:
    """The folder of a run, written and not yet seen by any reader, and its number of rows."""
    if RUN_FOLDER in df.columns:
        raise ValueError(f"{RUN_FOLDER} names the folders of a managed table and can't be a column")
    spark, location = df.sparkSession, f"{table_folder(table, root)}/{RUN_FOLDER}={run_id}"
    writer = sized(df, files, partition_by).write.format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).mode("errorifexists").save(location)
    # Counted from the footers of the committed files: exact even where a lost executor made
    # tasks run twice, which would count twice in accumulator-based metrics.
    return location, spark.read.format(fmt).schema(df.schema).load(location).count()


def publish(
    df: DataFrame,
    table: str,
    root: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    partition_by: list[str] | None = None,
    files: int | None = None,
    run_id: str | None = None,
    run_ts: datetime | None = None,
    after: int | None = None,
) -> str | None:
    """Replace the table by df; returns the folder that now holds it. run_ts, for the record, is now by default; without zone it is UTC.

    With `after`, the table is replaced only while that is its newest version (0: none yet); else None is returned and nothing changes.
    """
    spark = df.sparkSession
    if schema is not None:
        df = enforce_schema(df, schema)
    declared = df.schema
    if partition_by:
        df = df.select(*[c for c in df.columns if c not in partition_by], *partition_by)
    if fmt == "delta":
        writer = sized(df, files, partition_by).write.format(fmt)
        writer = writer.partitionBy(*partition_by) if partition_by else writer
        location = table_folder(table, root)
        writer.mode("overwrite").save(location)
        return location

    run_id = run_id or uuid.uuid4().hex
    location, count = _write(df, table, root, fmt, partition_by, files, run_id)
    record = _record(run_id, "WRITE", declared, fmt, partition_by or [], [f"{RUN_FOLDER}={run_id}"], count, run_ts)
    return location if _commit(spark, table, root, record, after) else None


def _record(run_id: str, operation: str, schema: StructType, fmt: str, partition_by: list[str], folders: list[str], rows: int, run_ts: datetime | None = None) -> dict:
    mode = "Overwrite" if operation == "WRITE" else "Upsert"
    return {
        "run_id": run_id, "operation": operation, "mode": mode, "num_output_rows": rows, "committed_at": _utc(run_ts).isoformat(),
        "format": fmt, "partition_by": partition_by, "schema": schema.json(), "folders": folders,
    }


def _partitions(spark: SparkSession, table: str, root: str, folders: list[str]) -> dict[str, str]:
    """Folder of every partition: whole runs by what they hold."""
    out = {}
    for folder in folders:
        run, _, part = folder.partition("/")
        inner = [part] if part else [s.getPath().getName() for s in list_folder(spark, f"{table_folder(table, root)}/{run}") if s.isDirectory() and "=" in s.getPath().getName()]
        out |= {name: f"{run}/{name}" for name in inner}
    return out


def merge_upsert(held: DataFrame, load: DataFrame, key: list[str]) -> DataFrame:
    """held with the rows of load: a key of both takes the row of load, keys of one side stay, nothing is deleted.

    Both sides have the same columns and unique keys. One aggregation, reduced before its shuffle, so
    that it makes no difference how many rows a customer has.
    """
    values = [c for c in held.columns if c not in key]
    both = held.withColumn("_load", F.lit(0)).unionByName(load.withColumn("_load", F.lit(1)))
    newest = both.groupBy(*key).agg(F.max(F.struct("_load", *values)).alias("_row"))
    return newest.select(*[F.col(c) if c in key else F.col(f"_row.{c}") for c in held.columns])


def upsert(load: DataFrame, table: str, root: str, key: list[str], by: str, fmt: str = "parquet", schema: StructType | None = None) -> None:
    """Upsert load by its unique key into a table with one folder for each value of `by`, a column of the key.

    Only folders of values in the load are read and written; the files of all others stay as they are, and the next version names them again.
    `by` has few values, such as days: those of the load are collected. The load is computed twice. If another publish of the table
    ends meanwhile the merge is done again on the newer version, so that no update is lost.
    """
    spark = load.sparkSession
    if schema is not None:
        load = enforce_schema(load, schema)
    if fmt == "delta":
        rows = merge_upsert(read_managed(spark, table, root, fmt), load, key) if is_published(spark, table, root, fmt) else load
        publish(rows, table, root, fmt)
        return
    values = [r[0] for r in load.select(by).distinct().collect()]
    for _ in range(MERGE_TRIES):
        record = newest_version(spark, table, root)
        if record is None:
            if publish(load, table, root, fmt, partition_by=[by], after=0):
                return
            continue
        held = read_record(spark, table, root, record)
        if record["partition_by"] == [by]:
            touched = held.where(F.col(by).isin([v for v in values if v is not None]) | (F.col(by).isNull() if None in values else F.lit(False)))
        else:
            touched = held  # a table that was written without folders gets them once
        run_id = uuid.uuid4().hex
        rows = merge_upsert(touched, load.select(*held.columns), key)
        rows = rows.select(*[c for c in rows.columns if c != by], by)
        _, count = _write(rows, table, root, fmt, [by], None, run_id)
        parts = _partitions(spark, table, root, record["folders"]) if record["partition_by"] == [by] else {}
        parts |= _partitions(spark, table, root, [f"{RUN_FOLDER}={run_id}"])
        line = _record(run_id, "MERGE", held.schema, fmt, [by], sorted(parts.values()), count)
        if _commit(spark, table, root, line, after=record["version"]):
            return
    raise RuntimeError(f"{table} changed during each of {MERGE_TRIES} merges")


# --- catalog names --------------------------------------------------------------------------------
def _entry(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def register_table(spark: SparkSession, name: str, location: str, fmt: str = "parquet", schema: StructType | None = None) -> None:
    """Make the folder readable under a name of the catalog; an existing name is moved to the new folder.

    The name is a view over the catalog entry of one version, which has the declared schema, by default that of the files; folders of
    partition values take the declared types. The view is replaced in one step, so the name is always there, whatever changes in the
    schema. Files are never deleted. A plain table of that name becomes a view, once.
    """
    if fmt == "delta":
        if not spark.catalog.tableExists(name):
            spark.catalog.createTable(name, path=location, source=fmt)
        return
    version = f"{name}{VERSION_MARK}{hashlib.md5(f'{location} {fmt}'.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(version):
        schema = schema or spark.read.format(fmt).load(location).schema
        spark.catalog.createTable(version, path=location, source=fmt, schema=schema)
    known = spark.catalog.tableExists(name)
    if known and _entry(spark, name).get("Type") != "VIEW":
        spark.sql(f"DROP TABLE {name}")
        known = False
    # CREATE OR REPLACE would drop the view and create it anew; ALTER changes its entry in one step.
    spark.sql(f"{'ALTER' if known else 'CREATE'} VIEW {name} AS SELECT * FROM {version}")


def unregister_table(spark: SparkSession, name: str) -> None:
    """Remove a name of register_table() and the entries of its versions from the catalog; the files stay."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for r in spark.sql(f"SHOW TABLES LIKE '{name}{VERSION_MARK}*'").collect():
        spark.sql(f"DROP TABLE IF EXISTS {r['tableName']}")


def _named_folders(spark: SparkSession, folder: str) -> tuple[set[str], dict[str, str]]:
    """(folders below the table's that the catalog's names read, entries of versions that no name reads any more with their folder)."""
    fs, place = hadoop_path(spark, folder)
    base, used, unused = f"{fs.makeQualified(place).toString()}/", set(), {}
    for r in spark.sql("SHOW TABLES").where("NOT isTemporary").collect():
        entry = _entry(spark, r["tableName"])
        if "Location" not in entry:
            continue
        fs, place = hadoop_path(spark, entry["Location"])
        full = fs.makeQualified(place).toString()
        if not full.startswith(base):
            continue
        name, mark, _ = r["tableName"].rpartition(VERSION_MARK)
        view = _entry(spark, name) if mark and spark.catalog.tableExists(name) else {}
        if mark and not view.get("View Text", "").endswith(r["tableName"]):
            unused[r["tableName"]] = full.removeprefix(base)
        else:
            used.add(full.removeprefix(base))
    return used, unused


def remove_old_versions(spark: SparkSession, table: str, root: str, older_than: timedelta, now: datetime | None = None) -> list[str]:
    """Delete what versions before the newest have left for longer than older_than; returns the deleted folders.

    What the newest version, a version of less age or a name in the catalog reads stays, and so does any folder changed within that time,
    as a publish may be writing it. older_than has to be longer than any reader works on a version that it has opened.
    """
    cutoff = _utc(now) - older_than
    folder = table_folder(table, root)
    numbers = version_numbers(spark, table, root)
    kept, old = set(), []
    for number in numbers:
        record = read_version(spark, table, root, number)
        if number == numbers[-1] or datetime.fromisoformat(record["committed_at"]) >= cutoff:
            kept |= set(record["folders"])
        else:
            old.append(number)
    named, unused = _named_folders(spark, folder)
    kept |= named
    removed = []

    def remove(status, name: str) -> None:
        if status.getModificationTime() / 1000 < cutoff.timestamp():
            fs, place = hadoop_path(spark, f"{folder}/{name}")
            fs.delete(place, True)
            removed.append(name)

    # The records go first: a reader must not open a version whose files are about to go.
    for number in old:
        fs, place = hadoop_path(spark, f"{folder}/{VERSIONS}/{number:012d}.json")
        fs.delete(place, False)
    for run in list_folder(spark, folder):
        name = run.getPath().getName()
        if not name.startswith(f"{RUN_FOLDER}=") or name in kept:
            continue
        if not any(k.startswith(f"{name}/") for k in kept):
            remove(run, name)
            continue
        for part in list_folder(spark, f"{folder}/{name}"):
            inner = f"{name}/{part.getPath().getName()}"
            if part.isDirectory() and inner not in kept:
                remove(part, inner)
    for entry, place in unused.items():
        if place in removed:
            spark.sql(f"DROP TABLE IF EXISTS {entry}")
    return sorted(removed)

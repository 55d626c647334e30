import threading
import time
from datetime import date, datetime, timedelta, timezone
from functools import partial
from pathlib import Path

import pytest
from folder_store import FolderStore, read_folder_store
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievetally import session
from sievetally.operators.contracts import ContractViolation, enforce_schema
from sievetally.operators.cells import cell_report, unreadable_cells
from sievetally.operators.rejects import reject_funnel
from sievetally.plans import transactions as plans
from sievetally.plans.catalog import CLEAN_TABLE, DERBY_DRIVER, STAGING_TYPES
from sievetally.plans.employees import CORRUPT, load_employees, quarantine_delivered
from sievetally.schemas import DAILY_KEY, DAILY_TOTAL, EMPLOYEE_TEXT, SERVING_ROW, TRANSACTION
from sievetally.sinks.files import sized, write_csv, write_parquet
from sievetally.sinks.managed import (
    default_format,
    merge_upsert,
    publish,
    register_table,
    remove_old_versions,
    unregister_table,
    upsert,
)
from sievetally.sinks.relational import append_rows, run_in_transaction, staging_tables, sweep_staging
from sievetally.sinks.serving import (
    SERVED,
    load_serving,
    open_store,
    serving_layout,
    serving_rows,
    upsert_served,
)
from sievetally.sources.files import read_csv_text, read_employees, read_parquet, type_columns
from sievetally.sources.managed import history, newest_version, read_managed, source_available, version_numbers
from sievetally.sources.relational import read_table
from sievetally.sources.synthetic import row_ids, synth_employees, synth_transactions

AS_OF = "2024-01-01"


def rows(df):
    return sorted(map(repr, df.collect()))


# --- CSV and Parquet ----------------------------------------------------------------------------


def test_csv_keeps_awkward_text(spark, scratch):
    values = {"salary": "₹1,250,000", "address": ' 4 "Lake" \\ Road, ', "zip_code": "012345", "first_name": "", "city": "  "}
    df = spark.range(1).select(*[F.lit(values.get(c)).cast("string").alias(c) for c in EMPLOYEE_TEXT.names])
    write_csv(df, f"{scratch}/csv")
    # An empty cell is null, whether it was written for null or for empty text.
    expected = df.withColumn("first_name", F.lit(None).cast("string"))
    assert rows(read_csv_text(spark, f"{scratch}/csv")) == rows(expected)


def test_csv_is_read_typed_and_bad_cells_become_null(spark, scratch, tmp_path):
    header = ",".join(EMPLOYEE_TEXT.names)
    lines = [
        "5001,ann,rao,a@x.co,2020-02-30,Analyst,IT,100,,road,Pune,MH,012345,1990-01-01,Active",
        "x1,bo,rao,b@x.co,2020-02-28,Analyst,IT,100,7,road,Pune,MH,000001,nodate,",
        "5003,cy,rao,c@x.co,2020-02-28",
    ]
    (tmp_path / "in.csv").write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    df = read_employees(spark, f"{scratch}/in.csv", corrupt="_line")
    found = {r["email"]: r for r in df.collect()}
    assert (found["a@x.co"]["employee_id"], found["a@x.co"]["hire_date"], found["a@x.co"]["zip_code"]) == (5001, None, "012345")
    assert (found["b@x.co"]["employee_id"], found["b@x.co"]["birth_date"], found["b@x.co"]["status"]) == (None, None, None)
    assert found["c@x.co"]["job_title"] is None and found["c@x.co"]["_line"] == lines[2]
    assert found["a@x.co"]["_line"] is None


def test_csv_header_must_match(spark, scratch, tmp_path):
    names = list(EMPLOYEE_TEXT.names)
    names[1], names[2] = names[2], names[1]
    (tmp_path / "in.csv").write_text(",".join(names) + "\n" + ",".join("x" for _ in names) + "\n", encoding="utf-8")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv_text(spark, f"{scratch}/in.csv").collect()


def test_parquet_file_bound(spark, scratch):
    df = spark.range(1000).repartition(9)
    write_parquet(df, f"{scratch}/bounded", files=4)
    write_parquet(df, f"{scratch}/sized")
    assert "Exchange" not in sized(spark.range(10))._jdf.queryExecution().toString()
    assert len(spark.read.parquet(f"{scratch}/bounded").inputFiles()) == 4
    assert len(spark.read.parquet(f"{scratch}/sized").inputFiles()) == 9
    assert read_parquet(spark, f"{scratch}/bounded").count() == read_parquet(spark, f"{scratch}/sized").count() == 1000


def test_rebalance_splits_a_hot_partition_value(spark, scratch):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        df = spark.range(200_000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("day"))
        sized(df, by=["day"]).write.partitionBy("day").parquet(f"{scratch}/days")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = spark.read.parquet(f"{scratch}/days")
    assert back.count() == 200_000
    assert len(back.filter("day = -1").select(F.input_file_name()).distinct().collect()) > 1


def test_parquet_refuses_its_own_input(spark, scratch):
    write_parquet(spark.range(10), f"{scratch}/t")
    with pytest.raises(ValueError, match="input of the table"):
        write_parquet(spark.read.parquet(f"{scratch}/t").filter("id > 3"), f"file://{scratch}/t/")
    assert spark.read.parquet(f"{scratch}/t").count() == 10
    write_parquet(spark.read.parquet(f"{scratch}/t"), f"{scratch}/t2")


@pytest.mark.parametrize("folder", ["a b", "a%20b", "it's", "ä"])
@pytest.mark.parametrize("form", ["{}", "{}/", "file:{}", "file://{}", "{}/../{name}", "{}/part"])
def test_own_input_is_known_however_it_is_written(spark, scratch, folder, form):
    place = f"{scratch}/{folder}"
    write_parquet(spark.range(3), place)
    target = form.format(place, name=folder)
    if form.endswith("part"):
        Path(target).mkdir()
    with pytest.raises(ValueError, match="input of the table"):
        write_parquet(spark.read.parquet(place).unionByName(spark.range(2)), target)
    assert spark.read.parquet(place).count() == 3


def test_a_path_without_scheme_is_on_the_default_file_system(spark, scratch):
    from sievetally.sinks.files import _place

    path = spark._jvm.org.apache.hadoop.fs.Path
    assert _place(spark, path(f"{scratch}/t")) == _place(spark, path(f"file:{scratch}//t/"))
    assert _place(spark, path(f"{scratch}/t")) != _place(spark, path(f"{scratch}/t2"))


def test_csv_never_has_more_rows_than_it_got(spark, scratch):
    texts = ["a\nb", "c\r\nd", "e\rf", '"\n"', "g"]
    df = spark.createDataFrame([(t,) for t in texts], "address string").select(*[(F.col(c) if c == "address" else F.lit("x")).alias(c) for c in EMPLOYEE_TEXT.names])
    write_csv(df, f"{scratch}/csv")
    back = read_csv_text(spark, f"{scratch}/csv", corrupt="bad").cache()
    assert len(back.collect()) == len(texts) and back.filter("bad IS NOT NULL").count() == 0
    assert {r["address"] for r in read_csv_text(spark, f"{scratch}/csv", escaped=True).collect()} == set(texts)


def test_line_breaks_come_back(spark, scratch):
    texts = ["a\nb", "\r\n", "5%", "%0A", "%250A", "%%0D\r", "%25", "%2\n5", "%\n", "%%25", "\n%0a", 'x"\n"y,', "%0\nA"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    write_csv(df, f"{scratch}/csv")
    files = [p.read_text() for p in Path(f"{scratch}/csv").glob("part-*")]
    assert sum(f.count("\n") for f in files) == len(texts) + len([f for f in files if f])
    back = read_csv_text(spark, f"{scratch}/csv", T.StructType.fromDDL("id string, t string"), escaped=True)
    assert {int(r["id"]): r["t"] for r in back.collect()} == dict(enumerate(texts))


# --- managed tables -----------------------------------------------------------------------------


def test_publish_replaces_and_logs(spark, scratch):
    assert default_format(spark) == "parquet"
    first = publish(spark.range(10), "t", scratch, run_ts=datetime(2024, 1, 1, 1), run_id="a")
    second = publish(read_managed(spark, "t", scratch).filter("id < 4"), "t", scratch, run_ts=datetime(2024, 1, 1, 2), run_id="b")
    publish(spark.range(3), "other", scratch)
    assert first != second and newest_version(spark, "t", scratch)["folders"] == [second.rpartition("/")[2]]
    assert read_managed(spark, "t", scratch).count() == 4
    log = history(spark, "t", scratch).collect()
    assert [(r["run_id"], r["num_output_rows"], r["mode"], r["operation"]) for r in log] == [
        ("b", 4, "Overwrite", "WRITE"),
        ("a", 10, "Overwrite", "WRITE"),
    ]
    committed = history(spark, "t", scratch).select(F.unix_timestamp("committed_at")).head()[0]
    assert committed == datetime(2024, 1, 1, 2, tzinfo=timezone.utc).timestamp()


def test_failed_publish_leaves_the_table(spark, scratch):
    publish(spark.range(5), "t", scratch)
    broken = spark.range(5).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        publish(broken, "t", scratch)
    assert read_managed(spark, "t", scratch).count() == 5
    assert history(spark, "t", scratch).count() == 1


def test_publish_checks_the_schema(spark, scratch):
    with pytest.raises(ContractViolation, match="schema drift"):
        publish(spark.range(5), "t", scratch, schema=DAILY_TOTAL)


def test_publish_in_another_file_format(spark, scratch):
    publish(spark.range(6), "t", scratch, fmt="orc")
    assert read_managed(spark, "t", scratch, "orc").count() == 6
    assert history(spark, "t", scratch).head()["num_output_rows"] == 6


def test_register_follows_the_newest_publish(spark, scratch):
    name = "registered_table"
    register_table(spark, name, publish(spark.range(10), "t", scratch))
    register_table(spark, name, publish(spark.range(7), "t", scratch))
    assert spark.table(name).count() == 7
    unregister_table(spark, name)
    assert spark.sql(f"SHOW TABLES LIKE '{name}*'").count() == 0
    spark.catalog.createTable(name, path=publish(spark.range(2), "t", scratch), source="parquet", schema=spark.range(1).schema)
    register_table(spark, name, publish(spark.range(3), "t", scratch))
    assert spark.table(name).count() == 3
    unregister_table(spark, name)


def test_a_reader_never_misses_a_name_whose_schema_changes(spark, scratch):
    name, done, counts, errors = "changing", threading.Event(), [], []
    register_table(spark, name, publish(spark.range(1), "t", scratch))

    def read():
        while not done.is_set():
            try:
                counts.append(spark.table(name).count())
            except Exception as error:
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 10):
        df = spark.range(n) if n % 2 else spark.range(n).withColumn(f"x{n}", F.lit("a"))
        register_table(spark, name, publish(df, "t", scratch, fmt="orc" if n % 3 else "parquet"), "orc" if n % 3 else "parquet")
    done.set()
    reader.join()
    assert not errors, str(errors[0])[:800]
    assert counts == sorted(counts) and len(set(counts)) > 1
    assert spark.table(name).columns == ["id"] and spark.table(name).count() == 9
    unregister_table(spark, name)


def test_partitioned_publish(spark, scratch):
    name = "by_day"
    declared = "id bigint, day string"
    for rows_in in (100, 60):
        df = spark.range(rows_in).select("id", F.concat(F.lit("0"), (F.col("id") % 4).cast("string")).alias("day"))
        register_table(spark, name, publish(df, "t", scratch, partition_by=["day"]), schema=T.StructType.fromDDL(declared))
        back = read_managed(spark, "t", scratch)
        assert back.filter("day = '03'").count() == rows_in // 4 and back.count() == rows_in
        assert spark.table(name).filter("day = '03'").count() == rows_in // 4
        assert spark.table(name).count() == rows_in
    unregister_table(spark, name)


def test_empty_partitioned_table_reads_as_empty(spark, scratch):
    df = spark.range(4).select("id", F.lit("012345").alias("day"))
    publish(df.limit(0), "t", scratch, partition_by=["day"])
    assert read_managed(spark, "t", scratch).collect() == []
    publish(df, "t", scratch, partition_by=["day"])
    assert {r["day"] for r in read_managed(spark, "t", scratch).collect()} == {"012345"}


def test_new_columns_are_seen(spark, scratch):
    publish(spark.range(3), "t", scratch)
    publish(spark.range(3).withColumn("x", F.lit(1)), "t", scratch)
    assert read_managed(spark, "t", scratch).columns == ["id", "x"]
    publish(spark.range(3), "t", scratch, fmt="orc")
    assert read_managed(spark, "t", scratch).columns == ["id"]


def test_the_publish_that_ends_last_is_read(spark, scratch):
    """A slow one that began first; its time in the report is when it ended, whatever clock or run id say."""
    wait = threading.Event()

    @F.udf("long")
    def slow(i):
        import time

        time.sleep(3)
        return i

    publish(spark.range(1), "t", scratch)
    worker = threading.Thread(target=lambda: (wait.set(), publish(spark.range(7).repartition(1).select(slow("id").alias("id")).filter("id >= 0").coalesce(1), "t", scratch, run_id="a")))
    worker.start()
    wait.wait()
    publish(spark.range(3), "t", scratch, run_id="z")
    worker.join()
    assert read_managed(spark, "t", scratch).count() == 7
    assert history(spark, "t", scratch).head()["run_id"] == "a"


def test_awkward_roots(spark, scratch):
    root = f"{scratch}/it's 100% a b"
    publish(spark.range(2), "t", root)
    publish(spark.range(5), "t", root)
    assert read_managed(spark, "t", root).count() == 5


def test_unpublished_table(spark, scratch):
    with pytest.raises(FileNotFoundError, match="never published"):
        read_managed(spark, "t", scratch)
    with pytest.raises(FileNotFoundError, match="never published"):
        history(spark, "t", scratch)


def test_earlier_versions_stay_readable(spark, scratch):
    publish(spark.range(4), "t", scratch, run_ts=datetime(2024, 1, 1))
    opened = read_managed(spark, "t", scratch)
    publish(spark.range(9).withColumn("x", F.lit(1)), "t", scratch, run_ts=datetime(2024, 1, 3))
    assert opened.count() == 4
    assert read_managed(spark, "t", scratch, as_of=datetime(2024, 1, 2, tzinfo=timezone.utc)).columns == ["id"]
    assert read_managed(spark, "t", scratch).count() == 9
    with pytest.raises(FileNotFoundError, match="up to"):
        read_managed(spark, "t", scratch, as_of=datetime(2023, 1, 1, tzinfo=timezone.utc))


def test_a_version_is_not_taken_twice(spark, scratch):
    assert publish(spark.range(1), "t", scratch, after=0)
    assert publish(spark.range(2), "t", scratch, after=0) is None
    assert publish(spark.range(3), "t", scratch, after=1)
    assert version_numbers(spark, "t", scratch) == [1, 2] and read_managed(spark, "t", scratch).count() == 3


def test_publishes_of_one_table_at_the_same_time_all_get_a_version(spark, scratch):
    threads = [threading.Thread(target=publish, args=(spark.range(n + 1), "t", scratch)) for n in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    log = history(spark, "t", scratch).collect()
    assert [r["version"] for r in log] == [6, 5, 4, 3, 2, 1] and sorted(r["num_output_rows"] for r in log) == list(range(1, 7))
    assert read_managed(spark, "t", scratch).count() == log[0]["num_output_rows"]
    assert not [p for p in Path(scratch, "t", "versions").iterdir() if not p.name.endswith(".json")]


def test_folder_column_is_refused(spark, scratch):
    with pytest.raises(ValueError, match="version_run"):
        publish(spark.range(1).withColumn("version_run", F.lit(1)), "t", scratch)


# --- upserts and removal of versions --------------------------------------------------------------


def keyed(spark, *parts):
    """Rows (k, day, v) for each (keys, day, v)."""
    rows_in = [(k, day, v) for keys, day, v in parts for k in keys]
    return spark.createDataFrame(rows_in, "k long, day string, v string")


def data_files(scratch, table="t"):
    return {str(p.relative_to(scratch)): p.stat().st_mtime_ns for p in Path(scratch, table).glob("version_run=*/**/part-*")}


def test_upsert_writes_only_the_days_of_the_load(spark, scratch):
    upsert(keyed(spark, (range(5), "01", "a"), (range(5), "02", "a"), (range(5), None, "a")), "t", scratch, ["k", "day"], "day")
    before = data_files(scratch)
    upsert(keyed(spark, ([3, 9], "02", "b"), ([1], "03", "b")), "t", scratch, ["k", "day"], "day")
    after = data_files(scratch)
    assert before.items() <= after.items() and all("day=02" in f or "day=03" in f for f in after.keys() - before.keys())
    upsert(keyed(spark, ([0], None, "c")), "t", scratch, ["k", "day"], "day")
    held = sorted((r["day"] or "-", r["k"], r["v"]) for r in read_managed(spark, "t", scratch).collect())
    assert held == [("-", 0, "c"), *(("-", k, "a") for k in range(1, 5)), *(("01", k, "a") for k in range(5)), ("02", 0, "a"), ("02", 1, "a"), ("02", 2, "a"), ("02", 3, "b"), ("02", 4, "a"), ("02", 9, "b"), ("03", 1, "b")]
    log = history(spark, "t", scratch).collect()
    assert [(r["operation"], r["num_output_rows"]) for r in log] == [("MERGE", 5), ("MERGE", 7), ("WRITE", 15)]
    upsert(keyed(spark), "t", scratch, ["k", "day"], "day")
    assert read_managed(spark, "t", scratch).count() == len(held)


def test_upsert_into_a_table_without_folders(spark, scratch):
    publish(keyed(spark, (range(3), "01", "a"), (range(3), "02", "a")), "t", scratch)
    for _ in range(2):
        upsert(keyed(spark, ([1], "02", "b")), "t", scratch, ["k", "day"], "day")
    assert rows(read_managed(spark, "t", scratch).select("k", "day", "v")) == rows(keyed(spark, (range(3), "01", "a"), ([0, 2], "02", "a"), ([1], "02", "b")))


def test_upserts_at_the_same_time_lose_nothing(spark, scratch):
    loads = [keyed(spark, (range(n, n + 3), f"{n % 2}", f"v{n}")) for n in range(0, 9, 3)]
    errors = []

    def work(load):
        try:
            upsert(load, "t", scratch, ["k", "day"], "day")
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=work, args=(load,)) for load in loads]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and sorted(r["k"] for r in read_managed(spark, "t", scratch).collect()) == list(range(9))


def test_old_versions_are_removed(spark, scratch):
    old = datetime(2024, 1, 1, tzinfo=timezone.utc)
    first = publish(spark.range(1), "t", scratch, run_ts=old)
    named = publish(spark.range(2), "t", scratch, run_ts=old)
    register_table(spark, "kept_name", first)
    register_table(spark, "kept_name", named)
    recent = publish(spark.range(3), "t", scratch)
    newest = publish(spark.range(4), "t", scratch)
    reader = read_managed(spark, "t", scratch)
    unfinished = Path(scratch, "t", "version_run=unfinished")
    unfinished.mkdir()
    tomorrow = datetime.now(timezone.utc) + timedelta(days=1)
    assert remove_old_versions(spark, "t", scratch, timedelta(days=2), now=tomorrow) == []
    assert version_numbers(spark, "t", scratch) == [3, 4]
    assert unfinished.exists() and Path(first).exists()
    gone = remove_old_versions(spark, "t", scratch, timedelta(hours=1), now=tomorrow)
    assert gone == sorted(Path(x).name for x in (first, recent, unfinished))
    assert reader.count() == 4 and spark.table("kept_name").count() == 2 and Path(newest).exists()
    assert spark.sql("SHOW TABLES LIKE 'kept_name*'").count() == 2 and version_numbers(spark, "t", scratch) == [4]
    unregister_table(spark, "kept_name")


def test_replaced_days_are_removed(spark, scratch):
    for v in "abc":
        upsert(keyed(spark, (range(2), "01", v), *([(range(2), "02", v)] if v == "a" else [])), "t", scratch, ["k", "day"], "day")
    gone = remove_old_versions(spark, "t", scratch, timedelta(0), now=datetime.now(timezone.utc) + timedelta(minutes=1))
    assert len(gone) == 2 and {x.partition("/")[2] for x in gone} == {"day=01", ""}
    assert rows(read_managed(spark, "t", scratch).select("k", "day", "v")) == rows(keyed(spark, (range(2), "01", "c"), (range(2), "02", "a")))


def test_daily_totals_by_day(spark, scratch):
    write_parquet(synth_transactions(row_ids(spark, 500), "2024-01-07 12:00:00"), f"{scratch}/raw")
    plans.publish_transactions(spark, f"{scratch}/raw", f"{scratch}/lake")
    plans.publish_daily_totals(spark, f"{scratch}/lake")
    whole = read_managed(spark, plans.DAILY_TOTALS, f"{scratch}/lake")
    expected = rows(whole)
    plans.publish_daily_totals(spark, f"{scratch}/lake", partition_by=["transaction_date"])
    by_day = read_managed(spark, plans.DAILY_TOTALS, f"{scratch}/lake")
    assert rows(by_day.select(*whole.columns)) == expected
    assert "transaction_date" in by_day.inputFiles()[0]
    assert plans.load_daily_totals(spark, f"{scratch}/lake", partial(FolderStore, f"{scratch}/s", 1)) == len(expected)


def test_source_available(spark, scratch):
    write_parquet(spark.range(0), f"{scratch}/empty")
    write_parquet(spark.range(5), f"{scratch}/full")
    assert tuple(source_available(spark.read.parquet(f"{scratch}/empty"), "e").head()) == ("e", True, False)
    assert tuple(source_available(spark.read.parquet(f"{scratch}/full"), "f").head()) == ("f", True, True)
    Path(f"{scratch}/broken").mkdir()
    Path(f"{scratch}/broken/part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="broken"):
        source_available(spark.read.schema("id long").parquet(f"{scratch}/broken"), "b").head()


# --- relational ---------------------------------------------------------------------------------


@pytest.fixture
def derby(spark, tmp_path):
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    return f"jdbc:derby:memory:{tmp_path.name};create=true"


def test_append_is_repeatable_and_all_or_nothing(spark, derby):
    ddl = "CREATE TABLE people (id INTEGER NOT NULL PRIMARY KEY, email VARCHAR(20) NOT NULL UNIQUE, status VARCHAR(9) DEFAULT 'new')"
    run_in_transaction(spark, derby, [ddl], DERBY_DRIVER)

    def append(pairs):
        df = spark.createDataFrame(pairs, "id int, email string").repartition(4)
        return append_rows(df, derby, "people", ["id"], DERBY_DRIVER, column_types="email VARCHAR(20)")

    def stored():
        return sorted(tuple(r) for r in read_table(spark, derby, "people", "ID", driver=DERBY_DRIVER).collect())

    assert append([(1, "a"), (2, "b")]) == 2
    assert append([(1, "a"), (2, "b"), (3, "c")]) == 1
    # Identical rows, as a task that ran twice leaves them.
    assert append([(4, "d"), (4, "d")]) == 1
    before = stored()
    assert before == [(1, "a", "new"), (2, "b", "new"), (3, "c", "new"), (4, "d", "new")]
    with pytest.raises(Exception, match="duplicate key"):
        append([(10 + i, f"e{i}") for i in range(20)] + [(99, "a")])
    assert stored() == before


PEOPLE = "CREATE TABLE people (id INTEGER NOT NULL PRIMARY KEY, email VARCHAR(20) NOT NULL UNIQUE)"


def append_people(spark, derby, pairs):
    df = spark.createDataFrame(pairs, "id int, email string").repartition(2)
    return append_rows(df, derby, "people", ["id"], DERBY_DRIVER, column_types="email VARCHAR(20)")


def test_loads_at_the_same_time_all_add_their_rows(spark, derby):
    """Their keys overlap, so that a row is in two loads at once."""
    run_in_transaction(spark, derby, [PEOPLE], DERBY_DRIVER)
    added, errors = {}, []

    def load(n):
        try:
            added[n] = append_people(spark, derby, [(i, f"u{i}@x.co") for i in range(10 * n, 10 * n + 15)])
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=load, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and sum(added.values()) == 45
    assert sorted(r["id"] for r in read_table(spark, derby, "people", "ID", driver=DERBY_DRIVER).collect()) == list(range(45))
    assert staging_tables(spark, derby, "people", DERBY_DRIVER) == {}


def test_a_failed_load_leaves_no_staging_table(spark, derby):
    run_in_transaction(spark, derby, [PEOPLE], DERBY_DRIVER)
    with pytest.raises(Exception, match="(?i)unique|duplicate"):
        append_people(spark, derby, [(1, "same@x.co"), (2, "same@x.co")])
    assert staging_tables(spark, derby, "people", DERBY_DRIVER) == {}
    dead, live = (f"people_staging_{int(t):x}_0" for t in (1, time.time()))
    run_in_transaction(spark, derby, [f"CREATE TABLE {t} (x INTEGER)" for t in (dead, live)], DERBY_DRIVER)
    assert [n.lower() for n in sweep_staging(spark, derby, "people", DERBY_DRIVER)] == [dead]
    assert [n.lower() for n in staging_tables(spark, derby, "people", DERBY_DRIVER)] == [live]
    assert append_people(spark, derby, [(3, "c@x.co")]) == 1


def test_read_of_an_empty_table(spark, derby):
    run_in_transaction(spark, derby, ["CREATE TABLE nothing (id INTEGER)"], DERBY_DRIVER)
    assert read_table(spark, derby, "nothing", "ID", driver=DERBY_DRIVER).count() == 0


def test_employee_job_from_csv_to_table(spark, derby, scratch):
    raw = synth_employees(row_ids(spark, 600), AS_OF)
    write_csv(raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]), f"{scratch}/in")
    run_in_transaction(spark, derby, [CLEAN_TABLE], DERBY_DRIVER)
    job = partial(
        load_employees, spark, f"{scratch}/in", derby, "employees_clean", DERBY_DRIVER, AS_OF, column_types=STAGING_TYPES
    )
    first = job(quarantine_path=f"{scratch}/rejected")
    assert first["raw"] == 600 and first["accepted"] == first["added"] > 50
    assert job()["added"] == 0
    stored = read_table(spark, derby, "employees_clean", "EMPLOYEE_ID", driver=DERBY_DRIVER)
    assert stored.count() == first["accepted"]
    assert stored.filter("created_at IS NULL").count() == 0
    lost = spark.read.parquet(f"{scratch}/rejected").agg(F.sum("copies")).head()[0]
    assert lost == first["raw"] - first["accepted"]


def test_quarantine_keeps_what_was_delivered(spark, scratch, tmp_path):
    header = ",".join(EMPLOYEE_TEXT.names)
    lines = ["1,a,b,a@x.co,notadate,t,d,1,,r,c,QA,012345,1990-01-01,Active", "x2,a,b,b@x.co,2020-01-01", "3,a,b,c@x.co,2020-01-01,t,d,1,,r,c,QA,1,1990-01-01,Active,surplus"]
    (tmp_path / "in.csv").write_text("\n".join([header, *lines, lines[0]]) + "\n", encoding="utf-8")
    text = session.cut_lineage(read_csv_text(spark, f"{scratch}/in.csv", corrupt=CORRUPT), "text")
    lost = {r["email"]: r for r in quarantine_delivered(text, AS_OF).collect()}
    assert set(lost) == {"a@x.co", "b@x.co"}
    assert (lost["a@x.co"]["hire_date"], lost["a@x.co"]["reject_reason"], lost["a@x.co"]["copies"]) == ("notadate", "null_required", 2)
    assert (lost["b@x.co"]["employee_id"], lost["b@x.co"][CORRUPT]) == ("x2", lines[1])
    assert lost["a@x.co"]["unreadable"] == ["hire_date"] and lost["b@x.co"]["unreadable"] == ["employee_id"]
    typed = type_columns(text, unreadable=unreadable_cells())
    funnel = {r["stage"]: r["rows"] for r in reject_funnel(typed, AS_OF, CORRUPT, ["employee_id", "hire_date", "salary"]).collect()}
    assert (funnel["raw"], funnel["null_required"], funnel["accepted"], funnel["corrupt_line"]) == (4, 3, 1, 2)
    assert [funnel[f"unreadable_{c}"] for c in ("employee_id", "hire_date", "salary")] == [1, 2, 0]
    assert sorted(map(tuple, cell_report(typed).collect())) == [("employee_id", "x2", 1), ("hire_date", "notadate", 2)]


def test_cells_that_are_empty_or_blank(spark):
    row = {"employee_id": None, "hire_date": " ", "salary": "Rs. 5", "manager_id": "7", "birth_date": " 1990-01-01 "}
    df = spark.range(1).select(*[F.lit(row.get(c)).cast("string").alias(c) for c in EMPLOYEE_TEXT.names])
    assert [(x["column_name"], x["cell"]) for x in df.select(unreadable_cells().alias("x")).head()["x"]] == [("hire_date", " "), ("salary", "Rs. 5")]


def test_employee_job_stops_at_a_broken_contract(spark, derby, scratch):
    raw = synth_employees(row_ids(spark, 100), AS_OF).withColumn("state", F.lit("MAH"))
    write_csv(raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]), f"{scratch}/in")
    run_in_transaction(spark, derby, [CLEAN_TABLE], DERBY_DRIVER)
    with pytest.raises(ContractViolation, match=r"max_length\(state\)"):
        load_employees(spark, f"{scratch}/in", derby, "employees_clean", DERBY_DRIVER, AS_OF, column_types=STAGING_TYPES)
    assert read_table(spark, derby, "employees_clean", "EMPLOYEE_ID", driver=DERBY_DRIVER).count() == 0


# --- serving ------------------------------------------------------------------------------------


def totals(spark, pairs):
    return spark.createDataFrame(
        [(c, date.fromisoformat(d), t, n) for c, d, t, n in pairs], DAILY_TOTAL
    )


def test_upsert_replaces_and_never_deletes(spark, scratch):
    first = [("C1", "2024-01-01", 1.0, 1), ("C1", "2024-01-02", 2.0, 2), ("C2", "2024-01-01", 3.0, 3)]
    second = [("C1", "2024-01-01", 9.0, 9), ("C3", "2024-01-05", 5.0, 5)]
    assert load_serving(totals(spark, first), partial(FolderStore, f"file:{scratch}/s", 1)) == 3
    assert load_serving(totals(spark, second), partial(FolderStore, f"{scratch}/s", 2)) == 2
    held = sorted((r[0], r[1].isoformat(), r[2], r[3]) for r in read_folder_store(spark, f"{scratch}/s").collect())
    assert held == [
        ("C1", "2024-01-01", 9.0, 9),
        ("C1", "2024-01-02", 2.0, 2),
        ("C2", "2024-01-01", 3.0, 3),
        ("C3", "2024-01-05", 5.0, 5),
    ]


def test_served_table_is_merged(spark, scratch):
    first = [("C1", "2024-01-01", 1.0, 1), ("C1", "2024-01-02", 2.0, 2), ("C2", "2024-01-01", 3.0, 3)]
    second = [("C1", "2024-01-01", 0.5, 9), ("C3", "2024-01-05", 5.0, 5)]
    for load in (first, second, [], second):
        upsert_served(totals(spark, load), scratch)
    held = sorted((r[0], r[1].isoformat(), r[2], r[3]) for r in read_managed(spark, SERVED, scratch).collect())
    assert held == [("C1", "2024-01-01", 0.5, 9), ("C1", "2024-01-02", 2.0, 2), ("C2", "2024-01-01", 3.0, 3), ("C3", "2024-01-05", 5.0, 5)]


def test_merge_reduces_before_its_one_shuffle(spark, capsys):
    df = serving_rows(totals(spark, [("C1", "2024-01-01", 1.0, 1)]))
    merge_upsert(df, df, DAILY_KEY).explain()
    lines = capsys.readouterr().out.splitlines()
    exchanges = [n for n, line in enumerate(lines) if "Exchange" in line]
    assert len(exchanges) == 1 and "partial_max" in "".join(lines[exchanges[0] : exchanges[0] + 3])


def test_empty_load(spark, scratch):
    assert load_serving(totals(spark, []), partial(FolderStore, f"{scratch}/s", 1)) == 0


def test_serving_types_and_overflow(spark):
    assert serving_rows(totals(spark, [("C1", "2024-01-01", 1.0, 1)])).schema == SERVING_ROW
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        serving_rows(totals(spark, [("C1", "2024-01-01", 1.0, 2**31)])).collect()


def test_layout_keeps_keys_together_and_splits_a_hot_customer(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("C"), (F.col("id") % 50).cast("string"))).alias("customer_id"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("transaction_date"),
        F.lit(1.0).alias("total_amount"),
        F.lit(1).alias("transaction_count"),
    )
    placed = serving_layout(df, 4).withColumn("task", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())
    found = placed.orderBy("place").collect()
    keys = [(r["customer_id"], -r["transaction_date"].toordinal()) for r in found]
    assert keys == sorted(keys) and len(set(keys)) == 4000
    sizes = {}
    for r in found:
        sizes[r["task"]] = sizes.get(r["task"], 0) + 1
    assert 1 < len(sizes) <= 4
    assert max(sizes.values()) < 2000
    assert len({r["task"] for r in found if r["customer_id"] == "HOT"}) > 1


class Flaky:
    def __init__(self):
        self.calls = 0

    def __call__(self):
        self.calls += 1
        if self.calls < 3:
            raise ConnectionError("not yet")
        return "store"


def test_connect_is_retried_then_fails():
    assert open_store(Flaky(), tries=5, wait_seconds=0) == "store"
    with pytest.raises(RuntimeError, match="after 2 tries"):
        open_store(Flaky(), tries=2, wait_seconds=0)


def test_unreachable_store_fails_the_load(spark):
    def connect():
        raise ConnectionError("down")

    with pytest.raises(Exception, match="not reachable after 2 tries"):
        load_serving(totals(spark, [("C1", "2024-01-01", 1.0, 1)]), connect, tries=2, wait_seconds=0)


def test_store_is_closed_when_an_upsert_fails(spark, tmp_path):
    marker = str(tmp_path / "closed")

    class Failing:
        def upsert(self, batch):
            raise ValueError("bad row")

        def close(self):
            open(marker, "w").close()

    with pytest.raises(Exception, match="bad row"):
        load_serving(totals(spark, [("C1", "2024-01-01", 1.0, 1)]), lambda: Failing())
    assert (tmp_path / "closed").exists()


def test_a_task_that_runs_again_repeats_its_upserts(spark, scratch):
    class DiesOnce(FolderStore):
        def upsert(self, batch):
            from pyspark import TaskContext

            super().upsert(batch)
            if TaskContext.get().attemptNumber() == 0:
                raise ConnectionError("lost after the write")

    pairs = [(f"C{i}", "2024-01-01", float(i), i) for i in range(50)]
    assert load_serving(totals(spark, pairs), partial(DiesOnce, f"{scratch}/s", 1), writers=4) == 50
    assert spark.read.parquet(f"{scratch}/s").count() == 50
    assert read_folder_store(spark, f"{scratch}/s").count() == 50


def test_cql_store_sends_prepared_rows(monkeypatch):
    """Against stand-ins for the driver package, which is not installed here."""
    import sys
    import types

    import pyarrow as pa

    from sievetally.sinks.serving import CqlStore

    log = []

    class Session:
        def prepare(self, text):
            log.append(text)
            return "prepared"

    class Cluster:
        def __init__(self, hosts, port):
            log.append((tuple(hosts), port))

        def connect(self, keyspace):
            log.append(keyspace)
            return Session()

        def shutdown(self):
            log.append("shutdown")

    def execute(session, statement, parameters, concurrency, raise_on_first_error):
        log.append((statement, list(parameters), raise_on_first_error))

    for name in ("cassandra", "cassandra.cluster", "cassandra.concurrent"):
        monkeypatch.setitem(sys.modules, name, types.ModuleType(name))
    sys.modules["cassandra.cluster"].Cluster = Cluster
    sys.modules["cassandra.concurrent"].execute_concurrent_with_args = execute
    store = CqlStore(["h1"], "analytics", "totals")
    store.upsert(pa.RecordBatch.from_pydict({"customer_id": ["C1"], "transaction_date": [date(2024, 1, 1)], "total_amount": [1.5], "transaction_count": [2]}))
    store.close()
    assert log == [
        (("h1",), 9042),
        "analytics",
        "INSERT INTO totals (customer_id, transaction_date, total_amount, transaction_count) VALUES (?, ?, ?, ?)",
        ("prepared", [("C1", date(2024, 1, 1), 1.5, 2)], True),
        "shutdown",
    ]


# --- jobs ---------------------------------------------------------------------------------------


def test_daily_run_end_to_end(spark, scratch):
    write_parquet(synth_transactions(row_ids(spark, 1200), "2024-01-07 12:00:00"), f"{scratch}/raw", files=4)
    log = plans.publish_transactions(spark, f"{scratch}/raw", f"{scratch}/lake")
    assert [r["num_output_rows"] for r in log.collect()] == [1200]
    done = plans.run_daily(spark, f"{scratch}/lake", partial(FolderStore, f"{scratch}/store", 1))
    again = plans.run_daily(spark, f"{scratch}/lake")
    assert done == again and done["daily_totals"] == done["served"] > 400
    assert rows(read_managed(spark, SERVED, f"{scratch}/lake")) == rows(read_folder_store(spark, f"{scratch}/store"))
    assert read_folder_store(spark, f"{scratch}/store").count() == done["served"]
    assert history(spark, plans.DAILY_TOTALS, f"{scratch}/lake").count() == 2


def test_daily_run_stops_without_source(spark, scratch):
    with pytest.raises(FileNotFoundError, match="never published"):
        plans.run_daily(spark, f"{scratch}/lake", partial(FolderStore, f"{scratch}/store", 1))


# --- generators ---------------------------------------------------------------------------------


def test_transactions_look_as_declared(spark):
    df = synth_transactions(row_ids(spark, 2000), "2024-01-07 00:00:00")
    assert enforce_schema(df, TRANSACTION).columns == TRANSACTION.names
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    found = df.agg(
        F.count("*"), F.count_distinct("transaction_id"), F.min("amount"), F.max("amount"),
        F.count_distinct("customer_id"), F.count_distinct("merchant"), F.min("timestamp"), F.max("timestamp"),
    ).head()
    assert found[0] == 2000 and found[1] == 2000 - 99
    assert -50 <= found[2] < 0 and 490 < found[3] <= 500
    assert found[4] == 101 and found[5] == 6
    assert datetime(2024, 1, 1, 1) <= found[6] and found[7] <= datetime(2024, 1, 7)
    assert df.filter(~F.col("transaction_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).count() == 0


def test_employees_look_as_declared(spark):
    df = synth_employees(row_ids(spark, 5000), AS_OF)
    share = {
        "collide": "employee_id < 5000",
        "bad_email": "email NOT LIKE '%.%'",
        "grouped": "salary LIKE '₹%,%'",
        "no_manager": "manager_id IS NULL",
        "future": f"hire_date > '{AS_OF}'",
    }
    found = df.agg(*[F.avg(F.expr(e).cast("int")).alias(n) for n, e in share.items()]).head().asDict()
    expected = {"collide": 0.10, "bad_email": 0.15, "grouped": 0.40, "no_manager": 0.50, "future": 0.166}
    assert {n: abs(found[n] - expected[n]) < 0.03 for n in expected} == dict.fromkeys(expected, True)
    assert df.filter(F.col("address").contains("\n") | (F.length("zip_code") != 6)).count() == 0


@pytest.mark.parametrize("parts", [1, 13])
def test_generators_ignore_partitioning(spark, parts):
    ids = row_ids(spark, 300)
    assert rows(synth_employees(ids.repartition(parts), AS_OF)) == rows(synth_employees(ids, AS_OF))


# --- session ------------------------------------------------------------------------------------


def test_partitions_follow_the_input_and_only_grow(spark, monkeypatch):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"]
    before = {k: spark.conf.get(k) for k in keys}
    df = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    assert 100_000 < session.plan_bytes(df) < 1_000_000
    try:
        session.size_partitions(spark, df)
        assert {k: spark.conf.get(k) for k in keys} == before
        for size, partitions, split in [(10**12, 3726, None), (10**14, 32768, 10**9), (10**16, 32768, 2**30)]:
            monkeypatch.setattr(session, "plan_bytes", lambda _, size=size: size)
            session.size_partitions(spark, df)
            assert int(spark.conf.get(keys[0])) == partitions
            assert spark.conf.get(keys[1]) == (str(split) if split else before[keys[1]])
        spark.conf.set(keys[1], "2g")
        for size in (1, 10**16):
            monkeypatch.setattr(session, "plan_bytes", lambda _, size=size: size)
            session.size_partitions(spark, df)
            assert (spark.conf.get(keys[0]), spark.conf.get(keys[1])) == ("32768", "2g")
        session.size_partitions(spark, df, max_partitions=400_000, max_scan_bytes=2**33)
        assert (spark.conf.get(keys[0]), spark.conf.get(keys[1])) == ("400000", str(2**33))
        spark.conf.set("spark.sievetally.maxShufflePartitions", "500000")
        with session.sized_for(spark, df):
            assert spark.conf.get(keys[0]) == "500000"
        assert spark.conf.get(keys[0]) == "400000"
        spark.conf.unset("spark.sievetally.maxShufflePartitions")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_byte_counts():
    sizes = {"134217728b": 2**27, "134217728": 2**27, "128MB": 2**27, "1g": 2**30, "64k": 2**16, "2TB": 2**41}
    assert {text: session.byte_count(text) for text in sizes} == sizes


def fake_session(master, settings):
    class Fake:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: settings.get(key, default))})
        sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{len(settings)}"})

    return Fake()


def test_scratch_uses_the_shared_folder(monkeypatch):
    monkeypatch.setattr(session, "_scratch_roots", {})
    monkeypatch.setattr(session.atexit, "register", lambda *_: None)
    shared = fake_session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/"})
    first, second = (session.scratch_dir(shared, "x") for _ in range(2))
    assert first.startswith("hdfs://nn/shared/scratch-app-1/x-") and first != second


def test_scratch_is_removed_with_the_application(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch_roots", {})
    monkeypatch.setattr(session.atexit, "register", lambda *_: None)
    session.cut_lineage(spark.range(3), "x")
    folder = Path(session.scratch_root(spark))
    assert folder.exists()
    session.remove_scratch(spark)
    assert not folder.exists()


def test_scratch_refuses_a_local_folder_on_a_cluster():
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.scratch_dir(fake_session(master, {}), "x")


def test_cut_lineage_reads_back_what_was_written(spark):
    cut = session.cut_lineage(spark.range(5), "five")
    assert cut.count() == 5 and cut.schema.simpleString() == spark.range(5).schema.simpleString()
    assert len(cut.inputFiles()) > 0


def test_scratch_table_is_removed(spark):
    with pytest.raises(RuntimeError, match="stop"):
        with session.scratch_table(spark.range(5), "five") as kept:
            folder = Path(kept.inputFiles()[0].removeprefix("file:")).parent
            assert kept.count() == 5 and folder.exists()
            raise RuntimeError("stop")
    assert not folder.exists()


def test_publishes_at_the_same_time(spark, scratch):
    errors = []

    def work(number):
        try:
            publish(spark.range(number + 1), f"t{number}", scratch)
        except Exception as error:  # pragma: no cover
            errors.append(error)

    threads = [threading.Thread(target=work, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert [read_managed(spark, f"t{n}", scratch).count() for n in range(4)] == [1, 2, 3, 4]

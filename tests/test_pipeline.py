"""Sinks, sources and whole runs."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from sessionloom import sinks
from sessionloom.config import SEQUENCE_RENAMES, SEQUENCE_SPECS, SPECS, Layout, Rules, RunWindow, Source, TableSpec, Tenant
from sessionloom.operators.dedup import duplicate_ids, losers
from sessionloom.operators.sessions import session_blocks, sessionize
from sessionloom.operators.shape import add_ymd
from sessionloom.plans import pipeline
from sessionloom.plans.pipeline import run
from sessionloom.functions.times import local_day_bounds
from sessionloom.session import Staging, scratch_root, settings
from sessionloom.sources.reader import Unreadable, read_table, time_window

DAY = RunWindow("2024-01-10", "2024-01-11")
NOON = dt.datetime(2024, 1, 10, 6, 30)  # 12:00 at +05:30
TENANTS = [Tenant("north", "n"), Tenant("south", "s")]


def at(minutes):
    return NOON + dt.timedelta(minutes=minutes)


def days(spark, *dates):
    return add_ymd(spark.createDataFrame([(dt.date.fromisoformat(d), i) for i, d in enumerate(dates)], "date date, n int"))


def read(spark, path, like):
    return spark.read.schema(like.schema).parquet(path)


# -- sinks and sources ------------------------------------------------------


def test_touched_partitions_only(spark, folder):
    by, path = ["year", "month", "day"], folder + "/t"
    first = days(spark, "2024-01-10", "2024-01-11")
    sinks.write_partitions(first, path, by)
    sinks.write_partitions(days(spark, "2024-01-11", "2024-01-11"), path, by)
    assert read(spark, path, first).groupBy("day").count().orderBy("day").collect() == [("10", 1), ("11", 2)]
    sinks.write_partitions(first.limit(0), path, by)
    assert read(spark, path, first).count() == 3
    sinks.clear_partitions(spark, path, [{"year": "2024", "month": "01", "day": "10"}])
    assert [r["day"] for r in read(spark, path, first).collect()] == ["11", "11"]
    sinks.write_partitions(days(spark, "2024-02-01"), path, by, refresh="all")
    assert read(spark, path, first).count() == 1
    with pytest.raises(ValueError):
        sinks.write_partitions(first, path, by, refresh="some")


def files_of(path, *partition):
    return [f for f in os.listdir("/".join([path, *partition])) if f.endswith(".parquet")]


def test_one_file_per_small_partition(spark, folder):
    many = days(spark, *["2024-01-10"] * 50, *["2024-01-11"] * 50).repartition(8)
    sinks.write_partitions(many, folder + "/t", ["year", "month", "day"], max_files=4)
    for day in ("10", "11"):
        assert len(files_of(folder + "/t", "year=2024", "month=01", f"day={day}")) == 1


@pytest.fixture()
def splitting(spark):
    """Settings under which AQE and the writer split whatever they may."""
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.sql.files.maxRecordsPerFile": "1000"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("broadcast", [True, False])
def test_max_files_is_a_bound(spark, folder, splitting, broadcast, monkeypatch):
    """One partition with nearly all rows, small ones and a null one, rebalanced into many tasks if nothing held them together."""
    if not broadcast:
        monkeypatch.setattr(sinks, "fits_broadcast", lambda df: False)
    day = F.when(F.col("id") % 1000 == 0, F.lit("a")).when(F.col("id") % 1000 == 1, F.lit(None)).otherwise("hot")
    rows = spark.range(400_000, numPartitions=16).select("id", day.alias("part"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    slots = sinks.partition_slots(rows, ["part"], 2, 10_000)
    sinks.write_partitions(rows, folder + "/bound", ["part"], max_files=2, slots=slots)
    counts = {p: len(files_of(folder + "/bound", p)) for p in os.listdir(folder + "/bound") if p.startswith("part=")}
    assert counts == {"part=hot": 2, "part=a": 1, "part=__HIVE_DEFAULT_PARTITION__": 1}
    assert spark.read.parquet(folder + "/bound").agg(F.count("id"), F.count_distinct("id")).first() == (400_000, 400_000)
    sinks.write_partitions(rows, folder + "/numbered", ["part"], max_files=3, slots=sinks.partition_slots(rows, ["part"], 3, 1000), pick_by=["id"])
    assert len(files_of(folder + "/numbered", "part=hot")) == 3 and len(files_of(folder + "/numbered", "part=a")) <= 3
    assert spark.read.parquet(folder + "/numbered").columns == ["text", "part"]
    sinks.write_partitions(rows, folder + "/free", ["part"])
    assert len(files_of(folder + "/free", "part=hot")) > 3
    with pytest.raises(ValueError):
        sinks.write_partitions(rows, folder + "/none", ["part"], max_files=0)


def test_slots_of_equal_rows_and_empty_tables(spark, folder):
    rows = spark.range(100).select(F.lit(1).alias("n"), F.lit("x").alias("part"))
    sinks.write_partitions(rows, folder + "/t", ["part"], max_files=4, slots=sinks.partition_slots(rows, ["part"], 4, 10))
    assert len(files_of(folder + "/t", "part=x")) == 1 and spark.read.parquet(folder + "/t").count() == 100
    sinks.write_partitions(rows.limit(0), folder + "/t", ["part"], max_files=4)
    assert spark.read.parquet(folder + "/t").count() == 100


def test_read_table(spark, folder):
    spark.range(3).withColumn("n", F.col("id")).write.json(folder + "/n_raw")
    spec = TableSpec("raw", "out", force_string=("n",))
    df = read_table(spark, Source("json", location=folder + "/{prefix}_{suffix}"), TENANTS[0], spec)
    assert dict(df.dtypes)["n"] == "string" and df.count() == 3
    with pytest.raises(Unreadable):
        read_table(spark, Source("json", location=folder + "/{prefix}_{suffix}"), TENANTS[1], spec)
    with pytest.raises(Unreadable):
        read_table(spark, Source("no-such-format", name_option="collection"), TENANTS[0], spec)


def test_text_times_are_left_to_the_later_check(spark):
    df = spark.createDataFrame([("2024-01-01",)], "t string")
    assert time_window(df, "t", F.lit(0), F.lit(0)) is df


def test_iso_text_is_filtered_at_the_scan(spark, folder):
    texts = ["2024-01-09T18:30:00Z", "2024-01-09T18:29:59.999Z", "2024-01-10 18:29:59", "2024-01-10T18:30:00Z", "2024-01-08T23:59:59Z",
             "2024-01-11T08:00:00+14:00", "2024-01-09T04:30:00-14:00", "2024-01-12T00:00:00Z", "some day", None, "2024-01-10"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").write.parquet(folder + "/t")
    lo, hi = local_day_bounds("2024-01-10", "2024-01-11", "Asia/Kolkata")
    raw = spark.read.parquet(folder + "/t")
    found = time_window(raw, "t", lo, hi, iso_text=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t,2024-01-08)" in plan and "LessThan(t,2024-01-12)" in plan
    exact = found.withColumn("u", F.try_to_timestamp("t").cast("timestamp_ntz")).filter((F.col("u") >= lo) & (F.col("u") < hi))
    assert sorted(r["id"] for r in exact.collect()) == [0, 2, 5, 6, 10]
    assert time_window(raw, "t", lo, hi) is raw


def test_settings_come_back_after_the_last_holder(spark):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    with settings(spark, {key: "Asia/Tokyo"}):
        with settings(spark, {key: "UTC"}):
            assert spark.conf.get(key) == "UTC"
        assert spark.conf.get(key) == "UTC"  # still held
    assert spark.conf.get(key) == before
    with pytest.raises(ZeroDivisionError), settings(spark, {"spark.sql.join.preferSortMergeJoin": "false"}):
        1 / 0
    assert spark.conf.get("spark.sql.join.preferSortMergeJoin") == "true"


def test_staging(spark):
    with Staging(spark, "test") as st:
        assert st.path.startswith(scratch_root(spark))
        assert st.put("x", spark.range(3)).count() == 3
        assert os.path.isdir(st.path)
    assert not os.path.exists(st.path)


# -- runs -------------------------------------------------------------------

SESSION = "_id string, fingerprint string, user_id string, createdAt timestamp, sessionEnd timestamp, userAgent string"
ACTIVITY = (
    "_id string, fingerprint string, user_id string, createdAt timestamp, activity string, page string, "
    "details struct<timestamp:string>"
)
UA = "Mozilla/5.0"


def session_rows():
    return [
        ("1", "f1", "ann", at(0), at(5), UA),
        ("2", "f2", "ann", at(10), None, UA),           # second fingerprint, same session
        ("2", "f2", "ann", at(10), None, UA),           # copy
        (None, "f1", "bob", at(0), None, UA),
        (None, "f1", "bob", at(0), None, UA),           # no id: both stay
        ("5", "f3", "null", at(0), None, UA),           # falls back to the fingerprint
        ("6", "f4", None, at(0), None, "GoogleBot"),
        ("7", "f5", None, at(0), None, None),
        ("8", " Unknown ", None, at(0), None, UA),
        ("9", "f1", "ann", at(-2000), None, UA),        # the day before
        ("10", "f1", "ann", None, None, UA),
    ]


def activity_rows():
    return [
        ("a", "f1", "ann", at(1), "scroll", "/x", ("2024-01-10T06:31:00.000Z",)),
        ("b", "f1", "ann", at(2), "click", "/y", ("bad",)),
        ("b", "f1", "ann", at(2), "click", "/y", ("bad",)),
        ("c", "f9", "zoe", at(2), "click", "/y", (None,)),   # nobody's session
        (None, "f1", "ann", at(3), "other", "/x", (None,)),
        (None, "f1", "ann", at(3), "other", "/x", (None,)),
    ]


def put(spark, folder, prefix, suffix, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/src/{prefix}_{suffix}")


@pytest.fixture()
def source(spark, folder):
    put(spark, folder, "n", "user_sessions_v2", session_rows(), SESSION)
    put(spark, folder, "n", "activity_logs_v2", activity_rows(), ACTIVITY)
    put(spark, folder, "s", "user_sessions_v2", session_rows()[:1], SESSION)
    put(spark, folder, "s", "activity_logs_v2", activity_rows()[:1], ACTIVITY)
    return Source("parquet", location=folder + "/src/{prefix}_{suffix}")


CORE = tuple(s for s in SPECS if s.is_session or s.is_activity)


def audit_of(result):
    return {(r["client_name"], r["source_table"]): r.asDict() for r in result.audit.collect()}


def test_run(spark, folder, source):
    out = folder + "/out"
    result = run(spark, source, TENANTS, out, DAY, specs=CORE)
    audit = audit_of(result)
    north = audit["north", "user_sessions_v2"]
    assert north["status"] == "SUCCESS" and north["run_date"] == dt.date(2024, 1, 10)
    assert north["rows_read_raw"] == 9  # the scan already skips other days and null times
    assert [north[c] for c in ("null_user_agent_dropped", "bots_dropped", "invalid_identity_dropped")] == [1, 1, 1]
    assert (north["duplicate_mongo_id_dropped"], north["final_rows_written"]) == (1, 5)
    act = audit["north", "activity_logs_v2"]
    assert (act["rows_read_raw"], act["duplicate_mongo_id_dropped"], act["orphans_dropped"], act["final_rows_written"]) == (6, 1, 1, 4)
    assert audit["south", "activity_logs_v2"]["final_rows_written"] == 1

    sessions = result.tables["user_sessions_v2"].filter("tenant = 'north'")
    assert {r["resolved_user_id"] for r in sessions.collect()} == {"ann", "bob", "f3"}
    ann = sessions.filter("resolved_user_id = 'ann'").collect()
    assert {r["session_label"] for r in ann} == {"ann__2024-01-10 12:00:00"}
    assert {r["session_end"] for r in ann} == {dt.datetime(2024, 1, 10, 12, 10)}
    assert ann[0]["event_timestamp"].date() == dt.date(2024, 1, 10) and "event_timestamp_utc" not in sessions.columns

    activity = result.tables["activity_logs_v2"].filter("tenant = 'north'")
    assert {r["session_id"] for r in activity.collect()} == {ann[0]["session_id"]}
    assert {r["details"] for r in activity.collect()} >= {'{"timestamp":"2024-01-10T06:31:00.000Z"}', "{}"}

    master = {r["resolved_user_id"]: r for r in result.tables["session_master"].filter("tenant = 'north'").collect()}
    assert (master["ann"]["scroll_count"], master["ann"]["click_count"], master["ann"]["unique_pages"]) == (1, 1, 2)
    assert master["ann"]["session_duration"] == 600.0 and master["ann"]["is_engaged"]
    assert master["bob"]["event_count"] == 2 and master["bob"]["is_bounce"]
    assert len(master) == 3  # two fingerprints of one person: one session

    stored = spark.read.parquet(out + "/etl_quality_audit")
    assert stored.count() == 4 and {"year", "month", "day"} <= set(stored.columns)
    for row in audit.values():
        dropped = sum(v for k, v in row.items() if k.endswith("_dropped"))
        assert row["rows_read_raw"] == dropped + row["final_rows_written"]


def test_rerun_is_idempotent_and_clears_days_left_without_rows(spark, folder, source):
    out = folder + "/out"
    tables = lambda r: {k: sorted(map(str, v.collect())) for k, v in r.tables.items()}
    first = tables(run(spark, source, TENANTS, out, DAY, specs=CORE))
    assert tables(run(spark, source, TENANTS, out, DAY, specs=CORE)) == first
    put(spark, folder, "n", "user_sessions_v2", [], SESSION)
    put(spark, folder, "n", "activity_logs_v2", [], ACTIVITY)
    again = run(spark, source, TENANTS, out, DAY, specs=CORE)
    for df in again.tables.values():
        assert {r["tenant"] for r in df.collect()} == {"south"}
    assert audit_of(again)["north", "user_sessions_v2"]["status"] == "EMPTY"


def test_other_days_and_tenants_stay(spark, folder, source):
    out = folder + "/out"
    run(spark, source, TENANTS, out, RunWindow("2024-01-09", "2024-01-11"), specs=CORE)
    before = spark.read.parquet(out + "/user_sessions_v2")
    counts = {(r["tenant"], r["day"]): r["count"] for r in before.groupBy("tenant", "day").count().collect()}
    assert counts == {("north", 9): 1, ("north", 10): 5, ("south", 10): 1}
    put(spark, folder, "n", "user_sessions_v2", session_rows()[:1], SESSION)
    put(spark, folder, "s", "user_sessions_v2", [], SESSION)
    only = run(spark, source, TENANTS, out, DAY, specs=CORE, only="NORTH")
    assert {k[0] for k in audit_of(only)} == {"north"}
    after = spark.read.parquet(out + "/user_sessions_v2")
    counts = {(r["tenant"], r["day"]): r["count"] for r in after.groupBy("tenant", "day").count().collect()}
    assert counts == {("north", 9): 1, ("north", 10): 1, ("south", 10): 1}
    with pytest.raises(ValueError):
        run(spark, source, TENANTS, out, DAY, only="west")


def test_dry_run_counts_like_a_real_one_and_writes_nothing(spark, folder, source):
    dry = run(spark, source, TENANTS, folder + "/dry", DAY, specs=CORE, dry_run=True)
    assert not os.path.exists(folder + "/dry") and not dry.tables
    real = run(spark, source, TENANTS, folder + "/out", DAY, specs=CORE)
    drop = ("pipeline_run_ts", "run_id")
    clean = lambda a: {k: {c: v for c, v in r.items() if c not in drop} for k, r in audit_of(a).items()}
    assert clean(dry) == clean(real)


def test_faults_stay_local(spark, folder, source):
    specs = CORE + (TableSpec("fingerprint", "fingerprint_v2"),)
    put(spark, folder, "n", "fingerprint", [("1", "f1")], "_id string, fingerprint string")           # no time column
    put(spark, folder, "s", "fingerprint", [("1", "f1", at(0), "x", "y")], "_id string, fingerprint string, createdAt timestamp, userAgent string, user_agent string")
    audit = audit_of(run(spark, source, TENANTS + [Tenant("west", "w")], folder + "/out", DAY, specs=specs))
    stages = {k: (r["status"], r["stage_failed"]) for k, r in audit.items()}
    assert stages["west", "user_sessions_v2"] == ("FAILED", "READ")
    assert stages["north", "fingerprint_v2"] == ("FAILED", "TIMESTAMP")
    assert stages["south", "fingerprint_v2"] == ("FAILED", "CLEANSING")
    assert stages["north", "user_sessions_v2"] == stages["south", "activity_logs_v2"] == ("SUCCESS", None)
    assert all(len(r["error_message"] or "") <= 500 for r in audit.values())


def test_a_tenant_whose_files_break_does_not_stop_the_others(spark, folder, source):
    path = f"{folder}/src/n_activity_logs_v2"
    for name in os.listdir(path):
        if name.endswith(".parquet"):
            with open(f"{path}/{name}", "r+b") as f:  # spoil the data pages, keep the footer
                f.seek(4)
                f.write(b"\xff" * 200)
            crc = f"{path}/.{name}.crc"
            if os.path.exists(crc):
                os.remove(crc)
    audit = audit_of(run(spark, source, TENANTS, folder + "/out", DAY, specs=CORE))
    assert (audit["north", "activity_logs_v2"]["status"], audit["north", "activity_logs_v2"]["stage_failed"]) == ("FAILED", "READ")
    assert audit["south", "activity_logs_v2"]["final_rows_written"] == 1


def test_empty_source_without_its_columns(spark, folder, source):
    put(spark, folder, "n", "user_sessions_v2", [], "_id string")
    spec = next(s for s in SPECS if s.is_session)
    result = run(spark, source, TENANTS[:1], folder + "/out", DAY, specs=(spec,))
    assert audit_of(result)["north", "user_sessions_v2"]["status"] == "EMPTY"


def test_children_without_any_session_are_kept_unassigned(spark, folder, source):
    put(spark, folder, "s", "user_sessions_v2", [], SESSION)
    result = run(spark, source, TENANTS, folder + "/out", DAY, specs=CORE)
    row = result.tables["activity_logs_v2"].filter("tenant = 'south'").first()
    assert (row["session_id"], row["is_session_assigned"]) == (None, False)
    only_child = run(spark, source, TENANTS[:1], folder + "/out2", DAY, specs=CORE[:1])
    assert audit_of(only_child)["north", "activity_logs_v2"]["final_rows_written"] == 5


def test_text_times_leak_and_null_are_told_apart(spark, folder, source):
    rows = [(r[0], r[1], r[2], "2024-01-10T07:00:00.000Z", *r[4:]) for r in activity_rows()]
    rows[0] = (*rows[0][:3], "2024-01-12T07:00:00.000Z", *rows[0][4:])
    rows[1] = (*rows[1][:3], "some day", *rows[1][4:])
    put(spark, folder, "n", "activity_logs_v2", rows, ACTIVITY.replace("createdAt timestamp", "createdAt string"))
    row = audit_of(run(spark, source, TENANTS[:1], folder + "/out", DAY, specs=CORE))["north", "activity_logs_v2"]
    assert (row["mongo_filter_leak_dropped"], row["null_timestamp_dropped"]) == (1, 1)


def test_epoch_ms_table(spark, folder, source):
    ms = lambda t: int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    put(spark, folder, "n", "clicks", [("1", "ann", ms(at(1))), ("2", "ann", ms(at(-2000)))], "_id string, fingerprint string, createdAt long")
    specs = (next(s for s in SPECS if s.is_session), TableSpec("clicks", "clicks", time_encoding="epoch_ms"))
    result = run(spark, source, TENANTS[:1], folder + "/out", DAY, specs=specs)
    row = result.tables["clicks"].collect()
    assert len(row) == 1 and row[0]["created_at"] == row[0]["event_timestamp"] == dt.datetime(2024, 1, 10, 12, 1)
    assert row[0]["is_session_assigned"]


def test_full_load_ignores_the_window(spark, folder, source):
    spec = TableSpec("user_sessions_v2", "users", full_load=True)
    result = run(spark, source, TENANTS[:1], folder + "/out", DAY, specs=(spec,))
    row = audit_of(result)["north", "users"]
    assert row["is_full_load"] and row["final_rows_written"] == 8 and row["null_timestamp_dropped"] == 1
    assert {r["day"] for r in result.tables["users"].collect()} == {"09", "10"}


def test_master_by_fingerprint(spark, folder, source):
    rules = Rules.daily(master_user="fingerprint")
    result = run(spark, source, TENANTS[:1], folder + "/out", DAY, specs=CORE, rules=rules)
    assert {r["fingerprint"] for r in result.tables["session_master"].collect()} == {"f1", "f2", "f3"}
    assert result.tables["session_master"].count() == 4


def test_large_lookup_takes_the_salted_join(spark, folder, source):
    small = run(spark, source, TENANTS, folder + "/a", DAY, specs=CORE)
    large = run(spark, source, TENANTS, folder + "/b", DAY, specs=CORE, rules=Rules.daily(broadcast_rows=0))
    rows = lambda r: {k: sorted(map(str, v.collect())) for k, v in r.tables.items()}
    assert rows(small) == rows(large)


def test_sequence_mode(spark, folder, source):
    put(spark, folder, "n", "user_sessions_v2", [
        ("1", "f1", at(0), "2024-01-10T06:40:00.000Z"), ("2", "f1", at(20), None), ("3", "f1", at(60), None), ("4", None, at(0), None),
    ], "_id string, fingerprint string, sessionStart timestamp, sessionEnd string")
    put(spark, folder, "n", "activity_logs_v2", [
        ("a", "f1", at(49), ("x",)), ("b", "f1", at(51), ("x",)), ("c", "f2", at(0), ("x",)),
    ], "_id string, fingerprint string, time timestamp, details struct<k:string>")
    specs = tuple(s for s in SEQUENCE_SPECS if s.is_session or s.is_activity)
    result = run(spark, source, TENANTS[:1], folder + "/out", DAY, specs=specs, rules=Rules.sequence(), renames=SEQUENCE_RENAMES)
    sessions = {r["mongo_id"]: r for r in result.tables["user_sessions_v2"].collect()}
    assert {k: r["session_id"] for k, r in sessions.items()} == {"1": "f1_1", "2": "f1_1", "3": "f1_2", "4": None}
    assert sessions["1"]["session_duration"] == 600 and sessions["2"]["session_duration"] is None
    activity = {r["mongo_id"]: r["session_id"] for r in result.tables["activity_logs_v2"].collect()}
    assert activity == {"a": "f1_1", "b": None, "c": None}
    assert os.path.isdir(folder + "/out/activity_logs_v2/tenant=north/date=2024-01-10")


def test_survivors_do_not_depend_on_arrival_order(spark):
    """Exact copies, staged once with row numbers: any reading order names the same losers."""
    rows = [("n", f"id{i % 50}", at(i % 50), 7, i) for i in range(200)]
    schema = "tenant string, mongo_id string, t timestamp, content long, row long"
    found = []
    for order in (rows, rows[::-1], sorted(rows, key=lambda r: r[4] % 7)):
        df = spark.createDataFrame(order, schema).repartition(5)
        repeated = duplicate_ids(df, "mongo_id", ["tenant"])
        found.append(sorted(r["row"] for r in losers(df, "mongo_id", ["t", "content"], ["tenant"], "row", repeated).collect()))
    assert found[0] == found[1] == found[2] == list(range(50, 200))


def test_blocks_and_rows_that_differ_raise(spark):
    df = spark.createDataFrame([("a", at(i * 100), i) for i in range(20)], "u string, t timestamp_ntz, n long")
    blocks = session_blocks(df.filter("n < 10"), ["u"], "t", 1800, salt_by=["n"])
    with pytest.raises(Exception, match="no session block"):
        sessionize(df, ["u"], "t", cut_by=None, salt_by=["n"], blocks=blocks).collect()


def test_copies_read_narrow_columns_until_the_rows_are_written(spark, folder, source):
    wide = [(f"{i % 7}", "f1", "ann", at(i % 7), None, UA + "x" * 2000) for i in range(70)]
    put(spark, folder, "n", "user_sessions_v2", wide, SESSION)
    spec = next(s for s in SPECS if s.is_session)
    result = run(spark, source, TENANTS[:1], folder + "/out", DAY, specs=(spec,), rules=Rules.daily(broadcast_rows=0))
    row = audit_of(result)["north", "user_sessions_v2"]
    assert (row["duplicate_mongo_id_dropped"], row["final_rows_written"]) == (63, 7)


def test_a_lost_row_is_reported(spark, folder, source, monkeypatch):
    enriched = pipeline._Job._enriched
    monkeypatch.setattr(pipeline._Job, "_enriched", lambda self, kept, spec: enriched(self, kept, spec).filter("mongo_id is null or mongo_id <> 'a'"))
    audit = audit_of(run(spark, source, TENANTS[:1], folder + "/out", DAY, specs=CORE))
    row = audit["north", "activity_logs_v2"]
    assert (row["status"], row["stage_failed"]) == ("FAILED", "WRITE") and row["error_message"].startswith("1 of 6")
    assert row["orphans_dropped"] == 1


def test_full_refresh_from_a_run(spark, folder, source):
    out = folder + "/out"
    run(spark, source, TENANTS, out, RunWindow("2024-01-09", "2024-01-11"), specs=CORE)
    assert {r["day"] for r in spark.read.parquet(out + "/user_sessions_v2").collect()} == {9, 10}
    run(spark, source, TENANTS, out, DAY, specs=CORE, refresh="all")
    assert {r["day"] for r in spark.read.parquet(out + "/user_sessions_v2").collect()} == {10}
    with pytest.raises(ValueError):
        run(spark, source, TENANTS, out, DAY, specs=CORE, refresh="all", only="north")


def test_a_failing_master_is_audited(spark, folder, source, monkeypatch):
    def broken(*args, **kw):
        raise RuntimeError("no facts today")

    monkeypatch.setattr(pipeline, "session_master", broken)
    audit = audit_of(run(spark, source, TENANTS, folder + "/out", DAY, specs=CORE))
    row = audit["south", "session_master"]
    assert (row["status"], row["stage_failed"], row["error_message"]) == ("FAILED", "SESSION_MASTER", "no facts today")
    assert audit["south", "user_sessions_v2"]["status"] == "SUCCESS"


# -- layout, counters, bounds ------------------------------------------------


def test_only_kept_rows_are_staged_and_counters_stay(spark, folder, source, monkeypatch):
    staged = {}
    plain = Staging.put

    def put(self, name, df):
        out = plain(self, name, df)
        staged[name] = (out.columns, out.count())
        return out

    monkeypatch.setattr(Staging, "put", put)
    audit = audit_of(run(spark, source, TENANTS, folder + "/out", DAY, specs=CORE))
    columns, rows = staged["user_sessions_v2-kept"]
    assert rows == 6 + 1 and "drop_reason" not in columns  # north keeps six of nine, south its one
    north = audit["north", "user_sessions_v2"]
    assert [north[c] for c in ("rows_read_raw", "null_user_agent_dropped", "bots_dropped", "invalid_identity_dropped")] == [9, 1, 1, 1]
    assert audit["south", "user_sessions_v2"]["rows_read_raw"] == 1


@pytest.mark.parametrize("texts", [False, True])
def test_derived_columns_are_neither_staged_nor_shuffled(spark, folder, source, monkeypatch, texts):
    """Times and users that a row's other columns give back are made where rows are used; a raw text time is kept."""
    if texts:
        raw = f"{folder}/raw/n_activity_logs_v2"
        rows = spark.read.parquet(*[source.location.format(prefix="n", suffix="activity_logs_v2")])
        rows.withColumn("createdAt", F.col("createdAt").cast("string")).write.parquet(raw + "-text")
        plain_read = pipeline.read_table
        monkeypatch.setattr(pipeline, "read_table", lambda s, src, t, spec: s.read.parquet(raw + "-text")
                            if (t.prefix, spec.suffix) == ("n", "activity_logs_v2") else plain_read(s, src, t, spec))
    staged, shuffled, put, plain = {}, {}, Staging.put, sinks.write_partitions

    def noted(self, name, df):
        staged[name] = df.columns
        return put(self, name, df)

    def spy(df, path, *args, **kw):
        shuffled[path.rsplit("/", 1)[-1]] = df.columns
        plain(df, path, *args, **kw)

    monkeypatch.setattr(Staging, "put", noted)
    monkeypatch.setattr(sinks, "write_partitions", spy)
    result = run(spark, source, TENANTS[:1], folder + f"/lean{texts}", DAY, specs=CORE)
    derived = {"event_timestamp_local", "created_at_utc", "created_at_local", "resolved_user_id"}
    for columns in (staged["activity_logs_v2-kept"], shuffled["activity_logs_v2"]):
        assert not derived & set(columns) and ("created_at" in columns) == texts
    assert not derived & set(shuffled["user_sessions_v2"])
    rows = result.tables["activity_logs_v2"]
    assert {"resolved_user_id", "event_timestamp", "created_at"} <= set(rows.columns) and rows.count()
    assert rows.filter("created_at <> event_timestamp or created_at is null or resolved_user_id is null or to_date(event_timestamp) <> date").isEmpty()


def test_runs_of_two_tenants_at_the_same_time(spark, folder, source):
    """Each tenant has datasets of its own: both runs complete, and a later run of one leaves the other as it is."""
    out, layout = folder + "/out", Layout(tenant_first=True)
    one = lambda t: run(spark, source, TENANTS, out, DAY, specs=CORE, only=t.name, layout=layout, run_id="same")
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(one, TENANTS))
    together = run(spark, source, TENANTS, folder + "/flat", DAY, specs=CORE)
    for name, df in together.tables.items():
        split = [r.tables[name] for r in results]
        assert split[0].columns == split[1].columns and set(split[0].columns) == set(df.columns)
        assert sorted(map(str, split[0].unionByName(split[1]).select(*df.columns).collect())) == sorted(map(str, df.collect()))
    stored = {t.name: spark.read.parquet(f"{out}/{t.name}/etl_quality_audit") for t in TENANTS}
    assert {n: df.count() for n, df in stored.items()} == {"north": 2, "south": 2}
    assert {r["status"] for df in stored.values() for r in df.collect()} == {"SUCCESS"}
    assert os.path.isdir(f"{out}/north/user_sessions_v2/year=2024/month=01/day=10")
    put(spark, folder, "n", "user_sessions_v2", [], SESSION)
    put(spark, folder, "n", "activity_logs_v2", [], ACTIVITY)
    one(TENANTS[0])
    count = lambda t: spark.read.parquet(f"{out}/{t}/user_sessions_v2").count() if any(
        f.endswith(".parquet") for _, _, names in os.walk(f"{out}/{t}/user_sessions_v2") for f in names) else 0
    assert (count("north"), count("south")) == (0, 1)
    both = run(spark, source, TENANTS, out, DAY, specs=CORE, layout=layout, max_files=1, refresh="all")
    assert {r["tenant"] for r in both.tables["user_sessions_v2"].collect()} == {"south"}


def test_a_run_without_any_row_to_keep(spark, folder, source):
    """Every row is dropped for a reason: nothing is written, all is counted, and the tables keep their columns."""
    out = folder + "/out"
    full = run(spark, source, TENANTS, out, DAY, specs=CORE)
    columns = {k: sorted(v.columns) for k, v in full.tables.items()}
    for prefix in "ns":
        put(spark, folder, prefix, "user_sessions_v2", [r for r in session_rows() if r[0] in ("6", "7", "8")], SESSION)
        put(spark, folder, prefix, "activity_logs_v2", [("z", " null ", "unknown", at(1), "click", "/x", (None,))], ACTIVITY)
    for options in ({}, {"max_files": 2}, {"layout": Layout(tenant_first=True)}):
        target = out if not options else folder + "/" + next(iter(options))
        result = run(spark, source, TENANTS, target, DAY, specs=CORE, **options)
        audit = audit_of(result)
        assert {r["status"] for r in audit.values()} == {"EMPTY"} and len(audit) == 4
        assert {r["rows_read_raw"] for k, r in audit.items() if k[1] == "user_sessions_v2"} == {3}
        assert {k: v.count() for k, v in result.tables.items()} == dict.fromkeys(result.tables, 0)
        assert {k: sorted(v.columns) for k, v in result.tables.items()} == columns


def test_all_orphans(spark, folder, source):
    """A child table of which no row has a session: nothing to write, and every row counted."""
    put(spark, folder, "n", "activity_logs_v2", [(str(i), "f9", "zoe", at(i), "click", "/y", (None,)) for i in range(7)], ACTIVITY)
    audit = audit_of(run(spark, source, TENANTS[:1], folder + "/out", DAY, specs=CORE))
    row = audit["north", "activity_logs_v2"]
    assert (row["status"], row["orphans_dropped"], row["final_rows_written"]) == ("SUCCESS", 7, 0)


def test_the_callers_settings_are_as_before(spark, folder, source):
    key, threshold = "spark.sql.session.timeZone", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    spark.conf.set(key, "Asia/Tokyo")
    try:
        before = spark.conf.get(threshold)
        result = run(spark, source, TENANTS[:1], folder + "/out", DAY, specs=CORE)
        assert spark.conf.get(key) == "Asia/Tokyo" and spark.conf.get(threshold) == before
        assert audit_of(result)["north", "user_sessions_v2"]["final_rows_written"] == 5
        assert {r["session_label"] for r in result.tables["user_sessions_v2"].filter("resolved_user_id = 'ann'").collect()} == {"ann__2024-01-10 12:00:00"}
    finally:
        spark.conf.set(key, "UTC")


def test_bounded_files_of_a_run(spark, folder, source, splitting):
    result = run(spark, source, TENANTS, folder + "/out", DAY, specs=CORE, max_files=1)
    assert audit_of(result)["north", "user_sessions_v2"]["final_rows_written"] == 5
    for table in ("user_sessions_v2", "activity_logs_v2", "session_master"):
        assert len(files_of(f"{folder}/out/{table}", "tenant=north", "year=2024", "month=01", "day=10")) == 1
        assert "_spread" not in result.tables[table].columns


@pytest.mark.parametrize("max_files", [None, 2])
def test_ids_are_made_where_rows_are_written(spark, folder, source, monkeypatch, max_files):
    """No table's shuffled rows hold a session id, and the lookup is worked out once for all tables."""
    shuffled, staged, plain, put = {}, [], sinks.write_partitions, Staging.put

    def spy(df, path, *args, **kw):
        shuffled[path.rsplit("/", 1)[-1]] = (df.columns, kw.get("is_dealt"))
        plain(df, path, *args, **kw)

    def noted(self, name, df):
        staged.append(name.split("-")[0])
        return put(self, name, df)

    monkeypatch.setattr(sinks, "write_partitions", spy)
    monkeypatch.setattr(Staging, "put", noted)
    result = run(spark, source, TENANTS, folder + f"/ids{max_files}", DAY, specs=SPECS, rules=Rules.daily(broadcast_rows=0), max_files=max_files)
    assert {"user_sessions_v2", "activity_logs_v2", "session_master"} <= set(shuffled)
    for name, (columns, dealt) in shuffled.items():
        assert "session_id" not in columns and "session_label" not in columns
        assert bool(dealt) == (name != "session_master")
        assert "session_id" in result.tables[name].columns
    assert staged.count("entries") == staged.count("crowded") == 1

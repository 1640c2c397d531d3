"""One query per operator over the ``events`` table, for ``__spark_entry__``.

``events`` is clean, so ``raw_clicks`` derives from every event the dirt that the
operators have to handle. All queries run over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sessionloom import sinks
from sessionloom.config import (
    RENAMES, SEQUENCE_RENAMES, SEQUENCE_SPECS, SPECS, Layout, Rules, RunWindow, Source, TableSpec, Tenant,
)
from sessionloom.functions.identity import BOT_WORDS
from sessionloom.functions.times import local_day_bounds, shift_seconds
from sessionloom.operators import quality, shape
from sessionloom.operators.dedup import dedup
from sessionloom.operators.facts import activity_counts, session_master
from sessionloom.operators.intervals import assign_sessions, drop_orphans, interval_join, unassigned
from sessionloom.operators.sessions import (
    block_facts, gap_flags, previous_time, row_duration, session_blocks, session_bounds, session_names,
    session_rollup, session_sequence, sessionize,
)
from sessionloom.plans.audit import AUDIT_SCHEMA, COUNTERS
from sessionloom.plans.pipeline import AUDIT_TABLE, RunResult, run
from sessionloom.session import Staging, require_utc, settings
from sessionloom.sources.reader import date_range, read_table, time_window

ZONE = "Asia/Kolkata"
GAP = 1800
LONG_GAP = 21_600
TENANTS = [Tenant(f"tenant_{i}", str(i)) for i in range(3)]


def everything(spark: SparkSession, sf_dir: str) -> RunWindow:
    """Days that cover the local time of every event, a day wider on each side."""
    days = F.col("ts").cast("date")
    ends = events(spark, sf_dir).agg(F.date_sub(F.min(days), 1).alias("lo"), F.date_add(F.max(days), 2).alias("hi")).first()
    return RunWindow(str(ends["lo"]), str(ends["hi"])) if ends["lo"] else RunWindow("1970-01-01", "1970-01-02")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    require_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def local_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events with the local time ``t`` and the local ``date``."""
    return shape.event_time(events(spark, sf_dir), "ts", ZONE).withColumnRenamed("event_timestamp_local", "t")


def _mod(n: int) -> Column:
    return F.col("event_id") % n


def raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as dirty click records; keeps ``event_id`` and ``uid`` for further fixtures."""
    uid = F.col("user_id").cast("string")
    return events(spark, sf_dir).select(
        "event_id",
        F.col("user_id").alias("uid"),
        F.col("event_id").cast("string").alias("_id"),
        F.when(_mod(29) == 0, None).when(_mod(29) == 1, " Unknown ").when(_mod(29) == 2, "NULL")
        .when(_mod(29) == 3, "  ").otherwise(F.concat(F.lit("fp_"), uid)).alias("fingerprint"),
        F.when(_mod(3) == 0, F.concat(F.lit("u_"), uid)).when(_mod(3) == 1, "null").alias("user_id"),
        F.col("ts").alias("created_at"),
        (F.col("ts") + F.make_dt_interval(hours=(_mod(5) * 2).cast("int"))).alias("session_end_raw"),
        F.when(_mod(23) == 0, None).when(_mod(17) == 0, "Mozilla/5.0 (compatible; GoogleBot/2.1)")
        .when(_mod(19) == 0, "curl/8.0").otherwise("Mozilla/5.0 (X11; Linux)").alias("user_agent"),
        F.when(F.col("event_type") == "view", "scroll").otherwise(F.col("event_type")).alias("activity"),
        F.when(_mod(7) != 0, F.concat(F.lit("/p/"), _mod(11).cast("string"))).alias("page"),
    )


def timed_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_clicks`` with the resolved user ``x``, local ``t``, ``date`` and local raw end."""
    df, _ = quality.resolve_identity(raw_clicks(spark, sf_dir))
    df = shape.localize(shape.event_time(df, "created_at", ZONE), ["session_end_raw"], ZONE)
    return df.withColumnsRenamed({"resolved_user_id": "x", "event_timestamp_local": "t"})


def staged_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``timed_clicks`` written once for queries that read it on several sides of a join."""
    return Staging(spark, "clicks").put("timed", timed_clicks(spark, sf_dir))


def known(clicks: DataFrame) -> DataFrame:
    """Rows of somebody: the child-table view."""
    return quality.quality_filter(clicks, None, "x")


def kept(clicks: DataFrame) -> DataFrame:
    """Rows of a known person: the session-table view."""
    return quality.quality_filter(clicks, "user_agent", "x")


def click_sessions(clicks: DataFrame) -> DataFrame:
    return sessionize(kept(clicks), ["x"], "t", GAP, "date", raw_end="session_end_raw_local", salt_by=["t", "_id"])


def click_facts(clicks: DataFrame) -> DataFrame:
    blocks = session_blocks(kept(clicks), ["x", "date"], "t", GAP, "session_end_raw_local", ["t", "_id"])
    return block_facts(blocks, ["x"])


def click_lookup(clicks: DataFrame) -> DataFrame:
    """The sessions' intervals, staged: a latest-start join looks at them before it is planned."""
    return Staging(clicks.sparkSession, "clicks").put("lookup", session_bounds(click_facts(clicks), ["x"], "x", grace=60))


def enriched(clicks: DataFrame) -> DataFrame:
    return assign_sessions(
        known(clicks), click_lookup(clicks), "x", "t", pick="latest", salt_by=["t", "_id"]
    )


def user_blocks(spark: SparkSession, sf_dir: str, gap: int) -> DataFrame:
    """Uncut sessions of clean events."""
    return session_blocks(local_events(spark, sf_dir), ["user_id"], "t", gap)


def sequence_lookup(spark: SparkSession, sf_dir: str, gap: int = LONG_GAP) -> DataFrame:
    facts = block_facts(user_blocks(spark, sf_dir, gap), ["user_id"], None, "sequence")
    return session_bounds(facts, ["user_id"], "user_id", tail=gap)


# -- sessions ---------------------------------------------------------------


def previous_times(spark, sf_dir):
    return previous_time(local_events(spark, sf_dir), ["user_id", "date"], "t", ["event_id"]).select("event_id", "prev_ts")


def gap_flag_rows(spark, sf_dir):
    return gap_flags(local_events(spark, sf_dir), ["user_id", "date"], "t", GAP, ["event_id"]).select(
        "event_id", "is_new_session"
    )


def session_sequences(spark, sf_dir):
    rows = session_sequence(local_events(spark, sf_dir), ["user_id"], "t", LONG_GAP)
    return session_names(rows, "user_id", "sequence", "t", "session_seq").select("event_id", "session_seq", "session_id")


def session_hash_ids(spark, sf_dir):
    return click_sessions(staged_clicks(spark, sf_dir)).select("_id", "session_id", "session_label", "is_session_assigned")


def session_end_times(spark, sf_dir):
    return click_sessions(staged_clicks(spark, sf_dir)).select("_id", "session_end")


def long_day_sessions(spark, sf_dir):
    rows = sessionize(local_events(spark, sf_dir), ["user_id"], "t", LONG_GAP)
    return session_rollup(rows, ["session_id", "user_id", "date"], "t").drop("session_last_ts")


def session_bounds_tail(spark, sf_dir):
    return sequence_lookup(spark, sf_dir)


def session_bounds_grace(spark, sf_dir):
    return click_lookup(timed_clicks(spark, sf_dir))


def row_durations(spark, sf_dir):
    df = local_events(spark, sf_dir).withColumn("given_end", shift_seconds(F.col("t"), 90))
    df = row_duration(df, "t", "session_end", out="open_seconds")
    return row_duration(df, "t", "given_end", out="given_seconds").select("event_id", "open_seconds", "given_seconds")


# -- quality and time -------------------------------------------------------


def identity_resolved(spark, sf_dir):
    df, user = quality.resolve_identity(raw_clicks(spark, sf_dir))
    valid = quality.valid_identity(F.col(user))
    return df.select("_id", F.col(user).alias("resolved_user_id"), valid.alias("is_valid"))


def _tagged(spark, sf_dir):
    df = timed_clicks(spark, sf_dir).withColumn("tenant", F.concat(F.lit("tenant_"), (F.col("uid") % 3).cast("string")))
    lo, hi = local_day_bounds("2024-01-03", "2024-01-25", ZONE)
    late = quality.time_reason(F.col("created_at"), lo, hi)
    return quality.tag_quality(df, "user_agent", "x").withColumn("drop_reason", F.coalesce("drop_reason", late))


def quality_counts(spark, sf_dir):
    df = timed_clicks(spark, sf_dir).withColumn("tenant", F.lit("all"))
    return quality.audit_counts(quality.tag_quality(df, "user_agent", "x")).drop("null_timestamp_dropped", "mongo_filter_leak_dropped")


def quality_kept(spark, sf_dir):
    return kept(timed_clicks(spark, sf_dir)).select("_id", "x", "t", "date")


def every_bot_word(spark, sf_dir):
    """All fragments that mark an agent as automated, in three spellings, between two browsers."""
    words = F.array(*[F.lit(w) for w in (*BOT_WORDS, "Firefox/121.0", "Safari/605")])
    word = F.element_at(words, (_mod(len(BOT_WORDS) + 2) + 1).cast("int"))
    spelled = F.when(_mod(3) == 0, F.upper(word)).when(_mod(3) == 1, F.initcap(word)).otherwise(word)
    df = events(spark, sf_dir).select("event_id", F.concat(F.lit("Mozilla/5.0 ("), spelled, F.lit(")")).alias("agent"))
    return quality.tag_quality(df, "agent", None).select("event_id", "agent", F.coalesce(F.col("drop_reason"), F.lit("none")).alias("reason"))


def audit_by_tenant(spark, sf_dir):
    return quality.audit_counts(_tagged(spark, sf_dir))


def local_day_window(spark, sf_dir):
    lo, hi = local_day_bounds("2024-01-05", "2024-01-20", ZONE)
    df = time_window(events(spark, sf_dir), "ts", lo, hi)
    return shape.event_time(df, "ts", ZONE).select(
        "event_id", F.col("event_timestamp_local").alias("event_timestamp"), "date"
    )


def day_range(spark, sf_dir):
    df = shape.event_time(events(spark, sf_dir), "ts")
    return date_range(df, "2024-01-05", "2024-01-20").select("event_id", "date")


def epoch_ms_window(spark, sf_dir):
    lo, hi = local_day_bounds("2024-01-05", "2024-01-20", ZONE)
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    df = events(spark, sf_dir).withColumn("ms", ms).withColumn("ms_text", ms.cast("string"))
    df = time_window(df, "ms", lo, hi, "epoch_ms")
    return time_window(df, "ms_text", lo, hi, "epoch_ms").select("event_id", "ms")


def bad_times_dropped(spark, sf_dir):
    text = F.when(_mod(7) == 0, "not a time").when(_mod(11) != 0, F.col("ts").cast("string"))
    df = events(spark, sf_dir).withColumn("details", F.struct(text.alias("timestamp"), F.col("event_type").alias("kind")))
    df = shape.coerce_timestamp(df, "details.timestamp").select("event_id", "details.timestamp", "details.kind")
    df = shape.event_time(df, "timestamp", ZONE)
    return quality.drop_null(df, "event_timestamp_utc").select(
        "event_id", "kind", F.col("event_timestamp_local").alias("event_timestamp")
    )


def local_times(spark, sf_dir):
    df = raw_clicks(spark, sf_dir).select("_id", "created_at", "session_end_raw")
    df = shape.localize(shape.event_time(df, "created_at", ZONE), ["created_at", "session_end_raw"], ZONE)
    return shape.finalize_times(df, ["created_at", "session_end_raw"])


# -- intervals --------------------------------------------------------------


def interval_left_all(spark, sf_dir):
    rows = Staging(spark, "local").put("events", local_events(spark, sf_dir).select("event_id", "user_id", "t"))
    blocks = session_blocks(rows, ["user_id"], "t", LONG_GAP)
    lookup = session_bounds(block_facts(blocks, ["user_id"], None, "sequence"), ["user_id"], "user_id", tail=LONG_GAP)
    return interval_join(
        rows, lookup, {"user_id": "sess_user"}, "t", "sess_start", "sess_end", ["session_id"],
    ).select("event_id", "session_id")


def interval_overlaps(spark, sf_dir):
    """Every match where sessions overlap: one row per event and session."""
    clicks = staged_clicks(spark, sf_dir)
    return interval_join(
        known(clicks), click_lookup(clicks), {"x": "sess_user"}, "t", "sess_start", "sess_end",
        ["session_id"], salt_by=["t", "_id"],
    ).select("_id", "session_id")


def interval_latest(spark, sf_dir):
    clicks = staged_clicks(spark, sf_dir)
    facts = Staging(spark, "clicks").put("facts", click_facts(clicks))
    return interval_join(
        known(clicks), facts, {"x": "x"}, "t", "session_start_ts", "session_end_ts",
        ["session_id", "session_start_ts"], pick="latest", grace=60, salt_by=["t", "_id"],
    ).select("_id", "session_id", "session_start_ts")


def assigned_or_not(spark, sf_dir):
    return enriched(staged_clicks(spark, sf_dir)).select("_id", "session_id", "is_session_assigned")


def orphans_dropped(spark, sf_dir):
    return drop_orphans(enriched(staged_clicks(spark, sf_dir))).select("_id", "session_id")


def unassigned_shape(spark, sf_dir):
    return unassigned(known(timed_clicks(spark, sf_dir))).select("_id", "session_id", "is_session_assigned")


# -- facts ------------------------------------------------------------------


def activity_per_session(spark, sf_dir):
    return activity_counts(drop_orphans(enriched(staged_clicks(spark, sf_dir))), ["session_id"])


def _master(spark, sf_dir):
    clicks = staged_clicks(spark, sf_dir)
    return session_master(click_facts(clicks), drop_orphans(enriched(clicks)))


def session_master_rows(spark, sf_dir):
    return shape.add_ymd(_master(spark, sf_dir)).withColumnRenamed("x", "resolved_user_id")


def session_master_quiet(spark, sf_dir):
    """No activity table: all counts are 0."""
    return session_master(click_facts(timed_clicks(spark, sf_dir))).select(
        "session_id", "session_duration", "scroll_count", "click_count", "unique_pages", "is_bounce", "is_engaged"
    )


def bounce_engaged(spark, sf_dir):
    return _master(spark, sf_dir).groupBy("is_bounce", "is_engaged").agg(F.count(F.lit(1)).alias("sessions"))


# -- schema, dedup ----------------------------------------------------------


def dedup_keep_nulls(spark, sf_dir):
    id = F.when(_mod(5) != 0, F.floor(F.col("event_id") / 3).cast("string"))
    df = events(spark, sf_dir).select(id.alias("mongo_id"), "event_id", "ts", "user_id")
    return dedup(df, "mongo_id", ["ts", "event_id"])


def json_stringified(spark, sf_dir):
    df = events(spark, sf_dir).select(
        "event_id",
        F.struct("event_id", "event_type").alias("details"),
        F.array(F.struct("user_id"), F.struct("user_id")).alias("qa_pairs"),
        F.col("event_type").alias("user_agent"),
    )
    return shape.stringify(df, ["details", "qa_pairs", "user_agent", "missing"])


def flattened_body(spark, sf_dir):
    df = events(spark, sf_dir).select("event_id", F.struct("user_id", "event_type").alias("body"))
    return shape.flatten_struct(df, "body")


def renamed_cast(spark, sf_dir):
    df = raw_clicks(spark, sf_dir).select(
        "_id", F.col("created_at").cast("string").alias("createdAt"), F.col("uid").alias("fingerprint"),
        F.when(_mod(4) != 0, "true").otherwise("maybe").alias("is_bounce"),
        F.when(_mod(4) != 0, "1.5").otherwise("long").alias("session_duration"),
    )
    casts = {
        "created_at": T.TimestampNTZType(), "fingerprint": T.StringType(), "is_bounce": T.BooleanType(),
        "session_duration": T.DoubleType(), "missing": T.LongType(),
    }
    return shape.enforce_schema(shape.rename(df, RENAMES), casts)


def void_fixed(spark, sf_dir):
    df = events(spark, sf_dir).select("event_id", F.lit(None).alias("nothing"))
    return shape.fix_void(df)


def ensured_columns(spark, sf_dir):
    df = events(spark, sf_dir).select("event_id", F.col("event_type").alias("activity"))
    return shape.ensure_columns(df, {"activity": "string", "page": "string", "weight": "double"})


def tenants_united(spark, sf_dir):
    """Two tenants whose columns differ in presence and type."""
    df = events(spark, sf_dir)
    a = df.select(F.lit("a").alias("tenant"), "event_id", F.col("user_id").alias("who"), "event_type")
    b = df.select(F.lit("b").alias("tenant"), "event_id", F.concat(F.lit("u"), F.col("user_id")).alias("who"), "value")
    return shape.union_tenants([a, b])


def ymd_partitions(spark, sf_dir):
    return shape.add_ymd(local_events(spark, sf_dir).select("event_id", "date"))


# -- sinks ------------------------------------------------------------------


def _day_rows(spark, sf_dir):
    return shape.add_ymd(local_events(spark, sf_dir).select("event_id", "user_id", "date"))


def _write_and_redo(spark, sf_dir, refresh: str) -> DataFrame:
    """Write all days, write the busiest day's neighbours again without user 1, read back."""
    path = Staging(spark, "sink").folder("days")
    rows, by = _day_rows(spark, sf_dir), ["year", "month", "day"]
    sinks.write_partitions(rows, path, by)
    again = rows.filter((F.col("date") == F.lit("2024-01-10").cast("date")) & (F.col("user_id") != 1))
    sinks.write_partitions(again, path, by, refresh=refresh)
    stored = spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum("user_id").alias("user_sum"))


def overwrite_one_day(spark, sf_dir):
    return _write_and_redo(spark, sf_dir, "touched")


def full_refresh(spark, sf_dir):
    return _write_and_redo(spark, sf_dir, "all")


def bounded_files(spark, sf_dir):
    """At most so many files per partition as asked for, where AQE and the writer would make many."""
    path, by = Staging(spark, "sink").folder("few"), ["year", "month", "day"]
    rows = _day_rows(spark, sf_dir)
    slots = sinks.partition_slots(rows, by, 4, rows_per_file=50)
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.files.maxRecordsPerFile": "10"}):
        sinks.write_partitions(rows.repartition(16), path, by, max_files=4, slots=slots)
    stored = spark.read.schema(rows.schema).parquet(path).select("*", F.col("_metadata.file_path").alias("file"))
    return stored.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("rows"), (F.count_distinct("file") <= 4).alias("bounded"))


def forced_text(spark, sf_dir):
    """A numeric raw column read as text."""
    folder = Staging(spark, "raw").folder("typed")
    events(spark, sf_dir).select("event_id", F.col("user_id").alias("who")).write.parquet(f"{folder}/0_clicks")
    spec = TableSpec("clicks", "clicks", force_string=("who",))
    return read_table(spark, Source("parquet", {}, location=folder + "/{prefix}_{suffix}"), TENANTS[0], spec)


def append_audit(spark, sf_dir):
    """The counters of ``audit_by_tenant`` as audit rows, appended twice and read back."""
    path = Staging(spark, "sink").folder("audit")
    counts = _tagged(spark, sf_dir).transform(quality.audit_counts).withColumn("run_date", F.lit("2024-01-03").cast("date"))
    rows = counts.withColumnRenamed("tenant", "client_name")
    full = shape.ensure_columns(rows, {f.name: f.dataType for f in AUDIT_SCHEMA.fields}).select(AUDIT_SCHEMA.fieldNames())
    for _ in range(2):
        sinks.append_audit(full, path)
    stored = spark.read.schema(shape.add_ymd(full, "run_date").schema).parquet(path)
    return stored.groupBy("client_name", "run_date", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("audit_rows"), F.sum("rows_read_raw").alias("rows_read_raw"),
        F.sum("bots_dropped").alias("bots_dropped"),
    )


# -- whole runs -------------------------------------------------------------


def _raw_tables(spark, sf_dir, moved: Callable[[Column], Column] = lambda t: t) -> Source:
    """Write the five raw tables of three tenants, all derived from ``raw_clicks``, their times ``moved``."""
    clicks = raw_clicks(spark, sf_dir).withColumn("created_at", moved(F.col("created_at"))).withColumnsRenamed(
        {"created_at": "createdAt", "session_end_raw": "sessionEnd", "user_agent": "userAgent"}
    )
    common = [(F.col("uid") % 3).cast("string").alias("prefix"), "fingerprint", "user_id", "createdAt"]
    base = [*common, F.when(_mod(13) != 0, F.col("_id")).alias("_id")]
    common.append("_id")
    details = F.struct(F.col("createdAt").cast("string").alias("timestamp"), F.col("activity").alias("kind"))
    once = clicks.select(*base)
    tables = {
        "user_sessions_v2": clicks.select(*common, "sessionEnd", "userAgent"),
        "activity_logs_v2": clicks.select(*base, "activity", "page", details.alias("details"), F.col("createdAt").alias("time")),
        "nudge_recommendations": clicks.select(*base, F.array(F.struct("activity", "page")).alias("recommendations")),
        "nudge_responses_v2": once.unionByName(once),
        "fingerprint": clicks.select(*common, "userAgent"),
    }
    folder = Staging(spark, "raw").folder("tables")
    for suffix, df in tables.items():
        df.write.partitionBy("prefix").option("compression", "zstd").parquet(f"{folder}/{suffix}")
    return Source("parquet", {}, location=folder + "/{suffix}/prefix={prefix}")


def _run(spark, sf_dir, **options) -> RunResult:
    require_utc(spark)
    options = {"window": everything(spark, sf_dir), **options}
    return run(spark, _raw_tables(spark, sf_dir), TENANTS, Staging(spark, "target").folder("out"), **options)


def _audit_view(result: RunResult) -> DataFrame:
    return result.audit.select("client_name", "source_table", "status", "run_date", "is_full_load", *COUNTERS)


def tenant_run(spark, sf_dir):
    return _audit_view(_run(spark, sf_dir))


def dry_run(spark, sf_dir):
    return _audit_view(_run(spark, sf_dir, dry_run=True))


def one_tenant_run(spark, sf_dir):
    return _audit_view(_run(spark, sf_dir, only="tenant_1"))


def tenant_run_master(spark, sf_dir):
    return _run(spark, sf_dir).tables["session_master"]


def tenant_run_activity(spark, sf_dir):
    stored = _run(spark, sf_dir).tables["activity_logs_v2"]
    return stored.select(
        "tenant", "mongo_id", "event_timestamp", "date", "session_id", "is_session_assigned", "details", "year", "month", "day"
    )


def full_load_run(spark, sf_dir):
    """One table loaded whole: no time filter, no session join."""
    spec = TableSpec("nudge_responses_v2", "nudge_responses_v2", full_load=True)
    return _audit_view(_run(spark, sf_dir, specs=(spec,)))


def sequence_run(spark, sf_dir):
    """The first-generation mode, end to end."""
    specs = tuple(s if not s.is_session else TableSpec(s.suffix, s.target, "createdAt", is_session=True) for s in SEQUENCE_SPECS)
    result = _run(spark, sf_dir, specs=specs, rules=Rules.sequence(), renames=SEQUENCE_RENAMES)
    stored = result.tables["activity_logs_v2"].groupBy("tenant", "date").agg(
        F.count(F.lit(1)).alias("rows"), F.count("session_id").alias("with_session"),
        F.count_distinct("session_id").alias("sessions"),
    )
    return stored


def _session_table(spark, sf_dir, change: Callable[[DataFrame], DataFrame]) -> Source:
    """Write a changed raw session table of three tenants."""
    clicks = raw_clicks(spark, sf_dir).withColumnsRenamed(
        {"created_at": "createdAt", "session_end_raw": "sessionEnd", "user_agent": "userAgent"})
    table = clicks.select(
        (F.col("uid") % 3).cast("string").alias("prefix"), "fingerprint", "user_id", "createdAt", "_id", "sessionEnd", "userAgent")
    folder = Staging(spark, "raw").folder("sessions")
    change(table).write.partitionBy("prefix").option("compression", "zstd").parquet(f"{folder}/user_sessions_v2")
    return Source("parquet", {}, location=folder + "/{suffix}/prefix={prefix}")


def _session_run(spark, sf_dir, source: Source, tenants: list[Tenant] = TENANTS, **options) -> RunResult:
    specs = tuple(s for s in SPECS if s.is_session)
    target = Staging(spark, "target").folder("out")
    return run(spark, source, tenants, target, everything(spark, sf_dir), specs=specs, **options)


def duplicate_run(spark, sf_dir):
    """Every session record three times in different files and some once more with a later time.

    Run twice, with and without broadcasts: the survivors and their sessions are the same.
    """

    def copies(table: DataFrame) -> DataFrame:
        later = table.filter(F.col("_id").cast("long") % 10 == 0).withColumn("createdAt", F.col("createdAt") + F.expr("interval 10 minutes"))
        return table.repartition(3).unionByName(table.repartition(5, "_id")).unionByName(later).unionByName(table)

    source = _session_table(spark, sf_dir, copies)
    runs = [
        _session_run(spark, sf_dir, source, rules=Rules.daily(broadcast_rows=n, build_master=False)).tables["user_sessions_v2"]
        .select(F.lit(n).alias("broadcast_rows"), "tenant", "mongo_id", "session_id", "session_label", "session_end")
        for n in (0, 500_000)
    ]
    return runs[0].unionByName(runs[1])


def bad_times_run(spark, sf_dir):
    """Text times, some of which name no time and some of which lie outside the window."""
    number = F.col("_id").cast("long")
    later = (F.col("createdAt") + F.expr("interval 400 days")).cast("string")
    text = F.when(number % 31 == 0, "some day").when(number % 37 == 0, later).otherwise(F.col("createdAt").cast("string"))
    source = _session_table(spark, sf_dir, lambda t: t.withColumn("createdAt", text))
    return _audit_view(_session_run(spark, sf_dir, source, rules=Rules.daily(build_master=False)))


def sequence_run_sessions(spark, sf_dir):
    """The stored session rows of the first-generation mode, on the raw table's own start column."""
    start = F.col("createdAt") - F.make_dt_interval(mins=(F.col("_id").cast("long") % 7).cast("int"))
    source = _session_table(spark, sf_dir, lambda t: t.withColumn("sessionStart", start))
    specs = tuple(s for s in SEQUENCE_SPECS if s.is_session)
    target = Staging(spark, "target").folder("out")
    result = run(spark, source, TENANTS, target, everything(spark, sf_dir), specs=specs, rules=Rules.sequence(), renames=SEQUENCE_RENAMES)
    return result.tables["user_sessions_v2"].select(
        "tenant", "mongo_id", "session_start", "session_id", "session_end_ts", "session_duration", "date")


def empty_tenant_run(spark, sf_dir):
    """Tables whose rows all lie outside the window: every tenant is EMPTY, and the tables keep their columns."""
    source = _raw_tables(spark, sf_dir, lambda t: (t + F.expr("interval 400 days")).cast("string"))
    specs = tuple(s for s in SPECS if s.is_session or s.is_activity)
    target = Staging(spark, "target").folder("out")
    result = run(spark, source, TENANTS, target, everything(spark, sf_dir), specs=specs, max_files=2)
    names = spark.createDataFrame([(k, ",".join(sorted(v.columns)), v.count()) for k, v in result.tables.items()],
                                  "source_table string, columns string, stored long")
    return _audit_view(result).drop("run_date", "is_full_load").join(names, "source_table")


def concurrent_tenant_runs(spark, sf_dir):
    """One run per tenant, all at the same time and into one target, each tenant with its own datasets; their stored audits."""
    source, window, layout = _raw_tables(spark, sf_dir), everything(spark, sf_dir), Layout(tenant_first=True)
    target = Staging(spark, "target").folder("out")
    with ThreadPoolExecutor(len(TENANTS)) as pool:
        list(pool.map(lambda t: run(spark, source, TENANTS, target, window, only=t.name, layout=layout, max_files=4), TENANTS))
    stored = [spark.read.parquet(layout.root(target, AUDIT_TABLE, t.name)) for t in TENANTS]
    audit = shape.union_tenants(stored).select("client_name", "source_table", "status", "run_date", "is_full_load", *COUNTERS)
    written = [spark.read.schema("session_id string").parquet(layout.root(target, "activity_logs_v2", t.name))
               .agg(F.count(F.lit(1)).alias("activity_rows")).withColumn("client_name", F.lit(t.name)) for t in TENANTS]
    return audit.join(F.broadcast(shape.union_tenants(written)), "client_name")


def iso_text_window(spark, sf_dir):
    """ISO-8601 text times in a window of ten local days, filtered as text at the scan and then exactly."""
    folder = Staging(spark, "raw").folder("text")
    form = F.when(_mod(3) == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).when(_mod(3) == 1, F.col("ts").cast("string")).otherwise(
        F.date_format(F.col("ts") + F.expr("interval 9 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSS'+09:00'"))
    events(spark, sf_dir).select("event_id", form.alias("text")).write.parquet(folder)
    lo, hi = local_day_bounds("2024-01-10", "2024-01-20", ZONE)
    found = time_window(spark.read.parquet(folder), "text", lo, hi, iso_text=True)
    found = shape.event_time(found, "text", ZONE)
    return found.filter(quality.time_reason(F.col("event_timestamp_utc"), lo, hi).isNull()).select("event_id", "date")


def clock_change_sessions(spark, sf_dir):
    """Sessions of events moved to the weeks around a clock change: gaps are real time, days and names the wall clock."""
    moved = events(spark, sf_dir).withColumn("ts", F.col("ts") + F.expr("interval 76 days"))
    rows = shape.event_time(moved, "ts", "Europe/Berlin")
    found = sessionize(rows, ["user_id"], "event_timestamp_utc", 6 * GAP, "date", zone="Europe/Berlin")
    return found.select("event_id", "date", "session_id", "session_label", "session_end")


def faulty_tenant_run(spark, sf_dir):
    """Beside the three tenants one without a table, one without its time column, one without rows and columns."""
    source = _session_table(spark, sf_dir, lambda t: t)
    root = source.location.split("/{suffix}")[0] + "/user_sessions_v2"
    rows = raw_clicks(spark, sf_dir)
    rows.select("_id", "fingerprint").write.parquet(f"{root}/prefix=7")
    rows.select("_id").filter("false").write.parquet(f"{root}/prefix=8")
    tenants = [*TENANTS, Tenant("untimed", "7"), Tenant("empty", "8"), Tenant("missing", "9")]
    result = _session_run(spark, sf_dir, source, tenants, rules=Rules.daily(build_master=False))
    return result.audit.select("client_name", "source_table", "status", "stage_failed", "final_rows_written")


def master_by_fingerprint(spark, sf_dir):
    """Session facts per session and device."""
    result = _session_run(spark, sf_dir, _session_table(spark, sf_dir, lambda t: t), rules=Rules.daily(master_user="fingerprint"))
    return result.tables["session_master"].select(
        "tenant", "session_id", "fingerprint", "date", "session_start_ts", "session_end_ts", "event_count", "scroll_count")


def multi_tenant_sessions(spark, sf_dir):
    df = kept(timed_clicks(spark, sf_dir)).withColumn("tenant", F.concat(F.lit("tenant_"), (F.col("uid") % 3).cast("string")))
    blocks = session_blocks(df, ["tenant", "x", "date"], "t", GAP, "session_end_raw_local", ["t", "_id"])
    return block_facts(blocks, ["tenant", "x"]).groupBy("tenant").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("event_count").alias("events"),
        F.min("session_start_ts").alias("first_start"), F.max("session_end_ts").alias("last_end"),
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of ``events`` per user and local day."""
    blocks = session_blocks(local_events(spark, sf_dir), ["user_id", "date"], "t", GAP)
    return block_facts(blocks, ["user_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "previous_times": previous_times,
    "gap_flags": gap_flag_rows,
    "session_sequence": session_sequences,
    "session_hash_ids": session_hash_ids,
    "session_end_times": session_end_times,
    "long_day_sessions": long_day_sessions,
    "session_bounds_tail": session_bounds_tail,
    "session_bounds_grace": session_bounds_grace,
    "row_durations": row_durations,
    "identity_resolved": identity_resolved,
    "quality_counts": quality_counts,
    "quality_kept": quality_kept,
    "every_bot_word": every_bot_word,
    "audit_by_tenant": audit_by_tenant,
    "local_day_window": local_day_window,
    "day_range": day_range,
    "epoch_ms_window": epoch_ms_window,
    "bad_times_dropped": bad_times_dropped,
    "local_times": local_times,
    "interval_left_all": interval_left_all,
    "interval_overlaps": interval_overlaps,
    "interval_latest": interval_latest,
    "assigned_or_not": assigned_or_not,
    "orphans_dropped": orphans_dropped,
    "unassigned_shape": unassigned_shape,
    "activity_counts": activity_per_session,
    "session_master": session_master_rows,
    "session_master_quiet": session_master_quiet,
    "bounce_engaged": bounce_engaged,
    "dedup_keep_nulls": dedup_keep_nulls,
    "json_stringified": json_stringified,
    "flattened_body": flattened_body,
    "renamed_cast": renamed_cast,
    "void_fixed": void_fixed,
    "ensured_columns": ensured_columns,
    "tenants_united": tenants_united,
    "ymd_partitions": ymd_partitions,
    "overwrite_one_day": overwrite_one_day,
    "full_refresh": full_refresh,
    "bounded_files": bounded_files,
    "forced_text": forced_text,
    "append_audit": append_audit,
    "multi_tenant_sessions": multi_tenant_sessions,
    "tenant_run": tenant_run,
    "tenant_run_master": tenant_run_master,
    "tenant_run_activity": tenant_run_activity,
    "one_tenant_run": one_tenant_run,
    "dry_run": dry_run,
    "full_load_run": full_load_run,
    "sequence_run": sequence_run,
    "duplicate_run": duplicate_run,
    "bad_times_run": bad_times_run,
    "faulty_tenant_run": faulty_tenant_run,
    "sequence_run_sessions": sequence_run_sessions,
    "empty_tenant_run": empty_tenant_run,
    "concurrent_tenant_runs": concurrent_tenant_runs,
    "iso_text_window": iso_text_window,
    "clock_change_sessions": clock_change_sessions,
    "master_by_fingerprint": master_by_fingerprint,
}

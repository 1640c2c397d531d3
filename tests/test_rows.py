"""Shape, quality, dedup and facts."""

import datetime as dt

import pytest
from pyspark.sql import Window, functions as F, types as T

from sessionloom.config import CASTS, RENAMES, Rules
from sessionloom.functions.identity import BOT_WORDS, bot_pattern, is_bot
from sessionloom.functions.times import local_day_bounds
from sessionloom.operators import dedup as D, facts, quality as Q, shape
from sessionloom.operators.skew import fits_broadcast
from sessionloom.sources.reader import date_range, time_window

T0 = dt.datetime(2024, 1, 10, 10)


def test_flatten(spark):
    df = spark.range(1).select("id", F.struct(F.lit(1).alias("a"), F.lit("x").alias("b")).alias("body"))
    assert shape.flatten_struct(df).columns == ["id", "a", "b"]
    assert shape.flatten_struct(df.drop("body")).columns == ["id"]
    with pytest.raises(ValueError, match="a"):
        shape.flatten_struct(df.withColumn("a", F.lit(0)))


def test_stringify_kinds(spark):
    df = spark.range(1).select(
        F.struct(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b")).alias("s"),
        F.array(F.lit(1), F.lit(2)).alias("l"), F.create_map(F.lit("k"), F.lit(1)).alias("m"),
        F.lit("text").alias("t"), F.lit(5).alias("n"), F.lit(None).cast("struct<a:int>").alias("z"),
    )
    row = shape.stringify(df, ["s", "l", "m", "t", "n", "z", "missing"]).first()
    assert tuple(row) == ('{"a":1}', "[1,2]", '{"k":1}', "text", "5", None)


def test_rename_checks_targets(spark):
    df = spark.range(1).select(F.lit("x").alias("_id"), F.lit("y").alias("other"))
    assert shape.rename(df, RENAMES).columns == ["mongo_id", "other"]
    both = spark.range(1).select(F.lit("x").alias("userAgent"), F.lit("y").alias("user_agent"))
    with pytest.raises(ValueError, match="user_agent"):
        shape.rename(both, RENAMES)


def test_enforce_schema_turns_bad_values_to_null(spark):
    df = spark.createDataFrame([("true", "1.5"), ("maybe", "long")], "is_bounce string, session_duration string")
    assert [tuple(r) for r in shape.enforce_schema(df, CASTS).collect()] == [(True, 1.5), (None, None)]


def test_void_is_fixed_at_any_depth(spark):
    df = spark.range(1).select(
        F.lit(None).alias("a"), F.struct(F.lit(None).alias("b")).alias("s"), F.array(F.lit(None)).alias("l")
    )
    assert shape.fix_void(df).schema.simpleString() == "struct<a:string,s:struct<b:string>,l:array<string>>"


def test_coerce_timestamp(spark):
    df = spark.createDataFrame(
        [(("2024-01-10T10:00:00.000Z", 1),), (("soon", 2),), ((None, 3),)], "details struct<timestamp:string,n:int>"
    )
    got = [r["details"]["timestamp"] for r in shape.coerce_timestamp(df, "details.timestamp").collect()]
    assert got[1:] == [None, None] and got[0] is not None
    assert shape.coerce_timestamp(df, "details.missing").schema == df.schema
    assert shape.coerce_timestamp(df, "details.n").schema == df.schema


def test_time_columns_of_any_type(spark):
    df = spark.createDataFrame([(T0, "2024-01-10T10:00:00.000Z", 1704880800000)], "n timestamp_ntz, s string, ms long")
    df = df.withColumn("l", F.col("n").cast("timestamp"))
    local = dt.datetime(2024, 1, 10, 15, 30)
    for c in ("n", "s", "l"):
        assert shape.event_time(df, c, "Asia/Kolkata").first()["event_timestamp_local"] == local
    assert shape.event_time(df, "ms", "Asia/Kolkata", "epoch_ms").first()["event_timestamp_local"] == local


def test_local_day_uses_the_local_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 10, 18, 30),)], "t timestamp_ntz")
    assert shape.event_time(df, "t", "Asia/Kolkata").first()["date"] == dt.date(2024, 1, 11)


def test_finalize_times(spark):
    df = spark.createDataFrame([(T0, T0, "keep")], "createdAt timestamp_ntz, created_at timestamp_ntz, x string")
    df = shape.localize(shape.event_time(df, "createdAt", "Asia/Kolkata"), ["created_at", "session_start"], "Asia/Kolkata")
    out = shape.finalize_times(df, ["created_at", "session_start"])
    assert sorted(out.columns) == ["createdAt", "created_at", "date", "event_timestamp", "x"]
    assert out.first()["created_at"] == dt.datetime(2024, 1, 10, 15, 30)


def test_required_columns(spark):
    with pytest.raises(shape.MissingColumns, match="when"):
        shape.require_columns(spark.range(1), ["when"])


def test_ymd_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "date date")
    assert shape.add_ymd(df).schema.simpleString() == "struct<date:date,year:int,month:string,day:string>"


def test_union_aligns_types(spark):
    a = spark.range(1).select(F.lit("a").alias("tenant"), F.struct(F.lit(1).alias("v")).alias("ua"))
    b = spark.range(1).select(F.lit("b").alias("tenant"), F.lit("text").alias("ua"), F.lit(1).alias("extra"))
    c = spark.range(1).select(F.lit("c").alias("tenant"), F.lit(None).alias("ua"))
    rows = {r["tenant"]: (r["ua"], r["extra"]) for r in shape.union_tenants([a, b, c]).collect()}
    assert rows == {"a": ('{"v":1}', None), "b": ("text", 1), "c": (None, None)}


# -- filters ----------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "epoch_ms"])
def test_time_window_reaches_the_scan(spark, folder, kind):
    times = [dt.datetime(2024, 1, 9, 18, 29, 59), dt.datetime(2024, 1, 9, 18, 30), dt.datetime(2024, 1, 10, 18, 29, 59), dt.datetime(2024, 1, 10, 18, 30)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, t timestamp_ntz")
    value = F.unix_millis(F.col("t").cast("timestamp")) if kind == "epoch_ms" else F.col("t").cast(kind)
    df.withColumn("t", value).write.parquet(folder + "/t")
    lo, hi = local_day_bounds("2024-01-10", "2024-01-11", "Asia/Kolkata")
    out = time_window(spark.read.parquet(folder + "/t"), "t", lo, hi, "epoch_ms" if kind == "epoch_ms" else "time")
    assert sorted(r["id"] for r in out.collect()) == [1, 2]
    assert "GreaterThanOrEqual(t" in plan(out) and "LessThan(t" in plan(out)


def test_date_range_is_inclusive(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3, 4)], "date date")
    assert [r[0].day for r in date_range(df, "2024-01-02", "2024-01-03").collect()] == [2, 3]


def test_identity(spark):
    rows = [("u", "f"), (" Unknown ", "f"), ("NULL", "f"), ("  ", "f"), (None, "f"), (None, None), ("null", " ")]
    df, user = Q.resolve_identity(spark.createDataFrame(rows, "user_id string, fingerprint string"))
    got = [(r[user], r["ok"]) for r in df.withColumn("ok", Q.valid_identity(F.col(user))).collect()]
    assert got == [("u", True)] + [("f", True)] * 4 + [(None, False), (" ", False)]
    assert Q.resolve_identity(df.select("user_id"))[1] == "user_id"
    assert Q.resolve_identity(df.select("fingerprint"))[1] == "fingerprint"
    assert Q.resolve_identity(spark.range(1))[1] is None


def test_quality_order(spark):
    rows = [(None, None), ("GoogleBot", None), ("ok", "unknown"), ("ok", "u")]
    df = spark.createDataFrame(rows, "ua string, u string")
    reasons = [r["drop_reason"] for r in Q.tag_quality(df, "ua", "u").collect()]
    assert reasons == [Q.NULL_AGENT, Q.BOT, Q.BAD_IDENTITY, None]


def test_every_bot_word_is_found(spark):
    agents = [(f"Mozilla {w.upper()}/1",) for w in BOT_WORDS] + [(f"M\u00f6zilla {w.upper()}/1",) for w in BOT_WORDS]
    agents += [("Mozilla/5.0 (X11; Linux)",), ("Sp\u0130der",), ("",), (None,)]
    df = spark.createDataFrame(agents, "ua string")
    want = [True] * (2 * len(BOT_WORDS)) + [False] * 3 + [None]
    full = "(?i)(" + "|".join(BOT_WORDS) + ")"
    for test in (is_bot(F.col("ua"), F.lower("ua")), F.col("ua").rlike(bot_pattern()), F.col("ua").rlike(full)):
        assert [r[0] for r in df.select(test).collect()] == want
    assert len(BOT_WORDS) == 38


def test_own_bot_pattern(spark):
    df = spark.createDataFrame([("probe/1",), ("GoogleBot",)], "ua string")
    assert [r["ua"] for r in Q.quality_filter(df, "ua", None, "^probe").collect()] == ["GoogleBot"]


def test_audit_counts_add_up(spark):
    df = spark.createDataFrame(
        [("a", r) for r in (Q.NULL_AGENT, Q.BOT, Q.BOT, Q.BAD_IDENTITY, Q.NULL_TIME, Q.LEAK, None, None)], "tenant string, drop_reason string"
    )
    row = Q.audit_counts(df).first().asDict()
    assert row.pop("tenant") == "a"
    assert row.pop("rows_read_raw") == 8 == sum(row.values())


# -- dedup ------------------------------------------------------------------


def dirty(spark):
    rows = [("a", 1, 3), ("a", 1, 1), ("a", 1, 2), ("a", 2, 1), (None, 3, 1), (None, 3, 1), ("b", 4, 1)]
    return spark.createDataFrame([(i, t, k, m) for m, (i, t, k) in enumerate(rows)], "id string, tenant int, t int, n long")


@pytest.mark.parametrize("known", [False, True])
def test_dedup(spark, known):
    df = dirty(spark)
    repeated = D.duplicate_ids(df, "id", ["tenant"]) if known else None
    out = D.dedup(df, "id", ["t"], ["tenant"], repeated)
    assert sorted(r["n"] for r in out.collect()) == [1, 3, 4, 5, 6]
    assert out.columns == df.columns


def test_duplicate_ids(spark):
    assert [tuple(r) for r in D.duplicate_ids(dirty(spark), "id", ["tenant"]).collect()] == [(1, "a", 3)]
    assert fits_broadcast(D.duplicate_ids(dirty(spark), "id", ["tenant"]), max_rows=1)
    assert not fits_broadcast(D.duplicate_ids(dirty(spark), "id", ["tenant"]), max_rows=0)


def test_copies_are_cut_before_the_shuffle(spark):
    lines = plan(D.dedup(dirty(spark), "id", ["t"], ["tenant"])).splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert min(limits) < exchange < max(limits)


# -- facts ------------------------------------------------------------------


def test_bounce_engaged_neither(spark):
    end = lambda s: T0 + dt.timedelta(seconds=s)
    sessions = spark.createDataFrame(
        [(k, T0, end(s), end(s), 1) for k, s in (("bounce", 5), ("engaged", 30), ("neither", 5), ("quiet", 30))],
        "session_id string, session_start_ts timestamp_ntz, session_last_ts timestamp_ntz, session_end_ts timestamp_ntz, event_count long",
    )
    clicks = spark.createDataFrame([("engaged", "click", None), ("neither", "click", "p"), ("bounce", "x", "p")], "session_id string, activity string, page string")
    got = {r["session_id"]: (r["is_bounce"], r["is_engaged"]) for r in facts.session_master(sessions, clicks).collect()}
    assert got == {"bounce": (True, False), "engaged": (False, True), "neither": (False, False), "quiet": (False, False)}
    alone = facts.session_master(sessions).filter("session_id = 'neither'").first()
    assert (alone["click_count"], alone["is_bounce"]) == (0, True)


def test_activity_without_its_columns(spark):
    row = facts.activity_counts(spark.createDataFrame([("s",)], "session_id string"), ["session_id"]).first()
    assert tuple(row) == ("s", 0, 0, 0)


def test_duration_keeps_fractions(spark):
    one = spark.createDataFrame(
        [("s", T0, T0 + dt.timedelta(seconds=1, microseconds=123456), T0 + dt.timedelta(seconds=1, microseconds=123456), 1)],
        "session_id string, session_start_ts timestamp_ntz, session_last_ts timestamp_ntz, session_end_ts timestamp_ntz, event_count long",
    )
    assert facts.session_master(one).first()["session_duration"] == 1.1235


def test_rules_modes():
    assert Rules.daily().cut_by_day and not Rules.sequence().cut_by_day
    assert Rules.sequence(gap_seconds=5).gap_seconds == 5


def test_survivors_by_bitmap_are_those_of_a_window(spark):
    """Many ids twice or more, some null: the first by time, content and number stays, and no row is shuffled to drop the rest."""
    rows = spark.range(0, 40_000, 1, 3).select(
        F.when(F.col("id") % 11 != 0, F.col("id") % 9000).cast("string").alias("key"), F.lit("n").alias("tenant"), (F.col("id") % 7).alias("t"),
        (F.col("id") % 5).alias("content"), F.monotonically_increasing_id().alias("row")).localCheckpoint()
    bits = D.first_bits(rows, "key", ["t", "content"], ["tenant"], "row").localCheckpoint()
    kept = D.keep_first(rows, "key", ["tenant"], "row", bits)
    ordered = Window.partitionBy("key").orderBy("t", "content", "row")
    first = rows.filter("key is not null").withColumn("rank", F.row_number().over(ordered)).filter("rank = 1").select("row")
    expected = {r[0] for r in first.collect()} | {r[0] for r in rows.filter("key is null").select("row").collect()}
    assert {r["row"] for r in kept.collect()} == expected and kept.count() == len(expected)
    assert kept.columns == rows.columns and "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()

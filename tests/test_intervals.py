import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sessionloom.operators import intervals as I
from sessionloom.operators.skew import fits_broadcast

BASE = dt.datetime(2024, 1, 10)


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def inputs(spark, seed=1, n=600, m=120, days=3):
    """Overlapping and nested intervals, some days long; a third of both sides is one user's."""
    rnd = random.Random(seed)

    def user():
        return "hot" if rnd.random() < 0.34 else f"u{rnd.randrange(6)}"

    events = [(f"e{i}", user(), at(rnd.randrange(days * 86_400))) for i in range(n)]
    events += [("n1", None, at(5)), ("n2", "nobody", at(5))]
    spans = []
    for i in range(m):
        lo = rnd.randrange(-20_000, days * 86_400)
        spans.append((f"s{i}", user(), at(lo), at(lo + rnd.choice([0, 50, 1800, 30_000, 200_000]))))
    e = spark.createDataFrame(events, "id string, user string, t timestamp_ntz")
    s = spark.createDataFrame(spans, "sid string, who string, lo timestamp_ntz, hi timestamp_ntz")
    return events, spans, e, s


def expected(events, spans, grace=0):
    g = dt.timedelta(seconds=grace)
    return {
        i: sorted((lo, sid) for sid, who, lo, hi in spans if who == u and lo - g <= t <= hi + g)
        for i, u, t in events
    }


def join(e, s, **kw):
    return I.interval_join(e, s, {"user": "who"}, "t", "lo", "hi", ["sid", "lo"], **kw)


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_all_matches(spark, seed, small):
    events, spans, e, s = inputs(spark, seed)
    want = sorted((i, sid) for i, hits in expected(events, spans).items() for _, sid in (hits or [(None, None)]))
    got = [(r["id"], r["sid"]) for r in join(e, s, small=small).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    inner = join(e, s, small=small, how="inner")
    assert inner.filter("sid is null").count() == 0
    assert inner.count() == sum(1 for w in want if w[1])


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("grace", [0, 60])
@pytest.mark.parametrize("bucket", [600, 21_600, 864_000])
def test_latest_start_wins_once_per_event(spark, small, grace, bucket):
    events, spans, e, s = inputs(spark, 3)
    got = {r["id"]: r["lo"] for r in join(e, s, pick="latest", grace=grace, small=small, bucket_seconds=bucket).collect()}
    want = {i: (hits[-1][0] if hits else None) for i, hits in expected(events, spans, grace).items()}
    assert got == want
    assert join(e, s, pick="latest", grace=grace, small=small, bucket_seconds=bucket).count() == len(events)


def test_within_only_clips(spark):
    _, _, e, s = inputs(spark, 4)
    bounds = (F.lit(str(at(0))).cast("timestamp_ntz"), F.lit(str(at(3 * 86_400))).cast("timestamp_ntz"))
    a = sorted(map(str, join(e, s, pick="latest").collect()))
    assert a == sorted(map(str, join(e, s, pick="latest", within=bounds).collect()))


def test_column_clash_and_bad_arguments(spark):
    _, _, e, s = inputs(spark, 5, 5, 5)
    with pytest.raises(ValueError):
        join(e.withColumn("sid", F.lit("x")), s)
    with pytest.raises(ValueError):
        join(e, s, pick="nearest")


def lookup(spark):
    return spark.createDataFrame(
        [("a", "s1", at(0), at(5000)), ("a", "s2", at(3000), at(4000))],
        "sess_user string, session_id string, sess_start timestamp_ntz, sess_end timestamp_ntz",
    )


def child(spark, rows):
    df = spark.createDataFrame(rows, "mongo_id string, user string, t timestamp_ntz")
    return df.withColumn("date", F.to_date("t"))


def test_assignment(spark):
    rows = [("1", "a", at(3500)), ("2", "a", at(4500)), ("3", "a", at(9000)), ("4", "b", at(0))]
    out = I.assign_sessions(child(spark, rows), lookup(spark), "user", "t", pick="latest")
    got = {r["mongo_id"]: (r["session_id"], r["is_session_assigned"]) for r in out.collect()}
    assert got == {
        "1": ("s2", True), "2": ("s1", True),
        "3": ("a_2024-01-10_unassigned", False), "4": ("b_2024-01-10_unassigned", False),
    }
    assert sorted(r["mongo_id"] for r in I.drop_orphans(out).collect()) == ["1", "2"]


def test_rows_without_an_id_all_survive_the_pick(spark):
    rows = [(None, "a", at(3500)), (None, "a", at(3500)), (None, "a", at(4500))]
    out = I.assign_sessions(child(spark, rows), lookup(spark), "user", "t", pick="latest")
    assert sorted(r["session_id"] for r in out.collect()) == ["s1", "s2", "s2"]


def test_own_session_id_is_kept_aside(spark):
    df = child(spark, [("1", "a", at(3500))]).withColumn("session_id", F.lit("mine"))
    row = I.assign_sessions(df, lookup(spark), "user", "t", pick="latest").first()
    assert (row["session_id"], row["source_session_id"]) == ("s2", "mine")
    bare = I.unassigned(df).first()
    assert (bare["session_id"], bare["source_session_id"], bare["is_session_assigned"]) == (None, "mine", False)


def test_null_id_where_labels_are_off(spark):
    out = I.assign_sessions(child(spark, [("1", "b", at(0))]), lookup(spark), "user", "t", label_unassigned=False)
    assert out.first()["session_id"] is None


def test_broadcast_check_counts_buckets_not_rows(spark):
    one = spark.createDataFrame([("s", at(0), at(10 * 86_400))], "sid string, lo timestamp_ntz, hi timestamp_ntz")
    bounds = tuple(F.lit(str(at(d * 86_400))).cast("timestamp_ntz") for d in (0, 10))
    copies = I.bucket_copies("lo", "hi", bounds)
    assert fits_broadcast(one, copies, max_rows=41)
    assert not fits_broadcast(one, copies, max_rows=40)
    assert not fits_broadcast(one, copies, max_bytes=100)
    assert fits_broadcast(one.limit(0), copies)


@pytest.mark.parametrize("pick, kind", [("latest", "SortMergeJoin"), ("all", "SortMergeJoin")])
def test_salted_joins_are_equi_joins(spark, pick, kind):
    """Neither a cross nor a nested-loop join, and a form that AQE may split further."""
    _, _, e, s = inputs(spark, 6, 50, 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = join(e, s, pick=pick)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert kind in plan and "LeftOuter" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_identical_events_still_match(spark):
    """A third of all events are copies of one row: they share a salt and all find their session."""
    rows = [("copy", "hot", at(100))] * 500 + [(f"e{i}", "hot", at(100 + i)) for i in range(1000)]
    e = spark.createDataFrame(rows, "id string, user string, t timestamp_ntz")
    s = spark.createDataFrame([("s1", "hot", at(0), at(5000))], "sid string, who string, lo timestamp_ntz, hi timestamp_ntz")
    out = join(e, s, pick="latest", salt_by=["t", "id"])
    assert out.filter("sid = 's1'").count() == 1500


def test_far_off_ends_make_few_copies(spark):
    """Sessions that claim to last until 2099 are listed up to the next session only."""
    start = dt.datetime(2024, 1, 1)
    rows = [("u", f"s{i}", start + dt.timedelta(hours=5 * i), dt.datetime(2099, 1, 1) + dt.timedelta(minutes=i)) for i in range(1700)]
    intervals = spark.createDataFrame(rows, "sess_user string, session_id string, sess_start timestamp_ntz, sess_end timestamp_ntz")
    found = intervals.select(F.col("sess_user").alias("u"), F.col("sess_start").alias(I._LO), F.col("sess_end").alias(I._HI), F.struct("session_id").alias("_payload"))
    within = tuple(F.floor(F.unix_timestamp(F.lit(str(d)).cast("timestamp")) / 21600) for d in (start, dt.datetime(2025, 1, 1)))
    assert I._by_bucket(I._clipped(found, ["u"]), 21600, within).count() <= 3 * 1700
    events = spark.createDataFrame([("u", start + dt.timedelta(hours=h, minutes=7)) for h in range(0, 8000, 13)], "u string, t timestamp_ntz")
    got = I.interval_join(events, intervals, {"u": "sess_user"}, "t", "sess_start", "sess_end", ["session_id"], pick="latest").collect()
    assert all(r["session_id"] == f"s{int((r['t'] - start).total_seconds() // 18000)}" for r in got) and len(got) == 616


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("crowd", [1, 3])
def test_latest_in_parted_buckets(spark, crowd, small, monkeypatch):
    """Arrays of a few intervals: parts of buckets, down to single seconds, give the same matches."""
    monkeypatch.setattr(I, "CROWD", crowd)
    if crowd == 3:
        monkeypatch.setattr(I, "fits_broadcast", lambda df: False)
    events, spans, e, s = inputs(spark, 5 + crowd)
    extra = [(f"x{i}", "hot", at(100), at(100 + i)) for i in range(12)] + [(f"y{i}", "u1", at(40_000 + i / 3), at(90_000 - i / 3)) for i in range(60)]
    more = [(f"m{i}", "u1", at(40_000 + i * 400 + i / 7)) for i in range(150)] + [(f"k{i}", "hot", at(99 + i / 2)) for i in range(40)]
    s = s.unionByName(spark.createDataFrame(extra, s.schema))
    e = e.unionByName(spark.createDataFrame(more, e.schema))
    want = {i: hits[-1] if hits else None for i, hits in expected(events + more, spans + extra).items()}
    got = {r["id"]: r for r in join(e, s, pick="latest", small=small).collect()}
    assert len(got) == len(want)
    for i, hit in want.items():
        assert (got[i]["lo"] if hit else got[i]["sid"]) == (hit[0] if hit else None)


@pytest.mark.parametrize("crowd", [1, 64])
def test_intervals_are_shuffled_once_for_their_arrays(spark, crowd, monkeypatch):
    """Crowded buckets are counted on the staged arrays, and an array holds no more than a crowd."""
    monkeypatch.setattr(I, "CROWD", crowd)
    plans, put = {}, I.Staging.put

    def noted(self, name, df):
        plans[name.split("-")[0]] = df._jdf.queryExecution().executedPlan().toString()
        out = put(self, name, df)
        if name.startswith("entries"):
            assert out.agg(F.max(F.size("_entries"))).first()[0] <= crowd
        return out

    monkeypatch.setattr(I.Staging, "put", noted)
    _, _, e, s = inputs(spark, 11)
    join(e, s, pick="latest").collect()
    assert plans["entries"].count("Exchange hashpartitioning") == 1
    assert "Window" not in plans["crowded"] and ("parted" in plans) == (crowd == 1)


def test_nested_intervals_do_not_crowd_one_array(spark):
    """100,000 intervals of one user, each inside the one before: no array grows with their number."""
    n = 100_000
    spans = spark.range(n).select(
        F.concat(F.lit("s"), "id").alias("sid"), F.lit("hot").alias("who"),
        F.timestamp_seconds(F.lit(1_704_844_800) + F.col("id")).cast("timestamp_ntz").alias("lo"),
        F.timestamp_seconds(F.lit(1_704_844_800 + 300_000) - F.col("id")).cast("timestamp_ntz").alias("hi"))
    events = spark.range(0, 300_000, 97).select(
        F.col("id").cast("string").alias("id"), F.lit("hot").alias("user"), F.timestamp_seconds(F.lit(1_704_844_800) + F.col("id")).cast("timestamp_ntz").alias("t"))
    found = join(events, spans, pick="latest")
    rows = {int(r["id"]): r["sid"] for r in found.collect()}
    assert rows == {t: f"s{min(t, n - 1, 300_000 - t)}" for t in range(0, 300_000, 97)}
    entries = I._parted(
        I._by_bucket(I._clipped(spans.select(F.col("who").alias("user"), F.col("lo").alias(I._LO), F.col("hi").alias(I._HI), F.struct("sid").alias("_payload")),
                                ["user"]), 21_600, (F.lit(0), F.lit(10 ** 6))), ["user"], 21_600, I.CROWD, I.Staging(spark, "t"))
    longest = entries[0].groupBy("user", I.BUCKET, I.PART).count().agg(F.max("count")).first()[0]
    assert entries[1].count() > 5 and longest <= 2 * I.CROWD


def test_dealt_joins_keep_every_match_and_shuffle_rows_once(spark):
    """A hot user among many: the same matches as the salted join, and no shuffle but that by date and slot."""
    from sessionloom.operators import skew
    from sessionloom.session import RUN_SETTINGS, settings

    spans = spark.range(300).select(
        F.concat(F.lit("s"), "id").alias("sid"), F.concat(F.lit("u"), F.col("id") % 40).alias("who"),
        F.timestamp_seconds(F.lit(1_704_844_800) + F.col("id") * 977).cast("timestamp_ntz").alias("lo"),
        F.timestamp_seconds(F.lit(1_704_844_800) + F.col("id") * 977 + 9000).cast("timestamp_ntz").alias("hi")).localCheckpoint()
    user = F.when(F.col("id") % 3 == 0, F.lit("u7")).when(F.col("id") % 50 != 1, F.concat(F.lit("u"), F.col("id") % 60))
    events = spark.range(6000).select(
        F.col("id").cast("string").alias("id"), user.alias("user"),
        F.timestamp_seconds(F.lit(1_704_844_800) + F.col("id") * 50).cast("timestamp_ntz").alias("t"))
    zone = "Asia/Kolkata"
    events = events.withColumn("date", F.from_utc_timestamp(F.col("t").cast("timestamp"), zone).cast("date")).localCheckpoint()
    slots = events.groupBy("date").agg(F.lit(3).alias(skew.SLOTS)).localCheckpoint()
    hot = skew.crowded_hashes(events.withColumn(I.BUCKET, I._bucket_of(F.col("t"), 21_600)), ["user", I.BUCKET], 20).localCheckpoint()
    assert 0 < hot.count() < 400 and hot.agg(F.max("_deal")).first()[0] > 1
    deal = skew.Deal(["date"], slots, zone)
    with settings(spark, {**RUN_SETTINGS, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for pick in ("latest", "all"):
            plain = join(events, spans, pick=pick, salt_by=["id"])
            dealt = join(events, spans, pick=pick, salt_by=["id"], hot=hot, deal=deal)
            assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
            plan = dealt._jdf.queryExecution().executedPlan().toString()
            wide = {line.split("hashpartitioning")[1].split(", [plan_id")[0] for line in plan.splitlines()
                    if "Exchange hashpartitioning" in line and "_slot" in line}
            assert len(wide) == 2 and all("date" in keys and "user" not in keys for keys in wide)

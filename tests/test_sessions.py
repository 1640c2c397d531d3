import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from sessionloom.functions.times import whole_seconds
from sessionloom.operators import sessions as S
from sessionloom.operators.shape import event_time
from sessionloom.operators.skew import SALTS, copies_made, fits_broadcast, spread

BASE = dt.datetime(2024, 1, 10, 10, 0, 0)


def frame(spark, rows, schema="id string, user string, t timestamp_ntz"):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("date", F.to_date("t"))


def at(seconds):
    return BASE + dt.timedelta(microseconds=round(seconds * 1_000_000))


def random_rows(n=4000, hot=0.35, users=12, days=3, seed=7):
    """A hot user with a third of the rows, repeated times, bursts and long pauses."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if rnd.random() < hot else f"u{rnd.randrange(users)}"
        seconds = rnd.choice([rnd.randrange(days * 86_400), rnd.randrange(3) * 30_000 + rnd.randrange(4000)])
        rows.append((f"e{i:05d}", user, at(seconds + rnd.choice([0, 0, 0.25, 0.9]))))
    return rows


def plain_sessions(df, keys, gap, end=None):
    """The textbook window formulation, one window per key."""
    w = Window.partitionBy(*keys).orderBy("t", "id")
    prev = F.lag("t").over(w)
    apart = whole_seconds(F.col("t")) - whole_seconds(prev)
    df = df.withColumn("prev", prev).withColumn("flag", F.when(prev.isNull() | (apart > gap), 1).otherwise(0))
    df = df.withColumn("seq", F.sum("flag").over(w))
    inner = Window.partitionBy(*keys, "seq")
    last = F.max("t").over(inner)
    raw = F.max(end).over(inner) if end else last
    return df.withColumn("start", F.min("t").over(inner)).withColumn(
        "stop", F.when(raw >= last, raw).otherwise(last)
    )


def as_dict(df, *cols):
    return {r[0]: tuple(r[1:]) for r in df.select("id", *cols).collect()}


def test_gap_is_measured_in_whole_seconds(spark):
    rows = [("a", "u", at(0)), ("b", "u", at(1800)), ("c", "u", at(3600.9)), ("d", "u", at(5402))]
    got = as_dict(S.gap_flags(frame(spark, rows), ["user"], "t", 1800, ["id"]), "is_new_session")
    assert got == {"a": (1,), "b": (0,), "c": (0,), "d": (1,)}
    seq = as_dict(S.session_sequence(frame(spark, rows), ["user"], "t", 1800), "session_seq")
    assert [seq[k][0] for k in "abcd"] == [1, 1, 1, 2]


def test_ties_share_a_session_and_one_opens_it(spark):
    rows = [("a", "u", at(0)), ("b", "u", at(0)), ("c", "u", at(9000)), ("d", "u", at(9000))]
    got = as_dict(S.gap_flags(frame(spark, rows), ["user"], "t", 1800, ["id"]), "is_new_session")
    assert got == {"a": (1,), "b": (0,), "c": (1,), "d": (0,)}
    ids = as_dict(S.sessionize(frame(spark, rows), ["user"], "t"), "session_id")
    assert ids["a"] == ids["b"] != ids["c"] == ids["d"]


def test_local_midnight_cuts_only_when_asked(spark):
    # 18:20 and 18:40 UTC are 23:50 and 00:10 at +05:30
    rows = [("a", "u", dt.datetime(2024, 1, 10, 18, 20)), ("b", "u", dt.datetime(2024, 1, 10, 18, 40))]
    df = event_time(frame(spark, rows).drop("date"), "t", "Asia/Kolkata")
    cut = as_dict(S.sessionize(df, ["user"], "event_timestamp_local"), "session_id")
    run_on = as_dict(S.sessionize(df, ["user"], "event_timestamp_local", cut_by=None), "session_id")
    assert cut["a"] != cut["b"] and run_on["a"] == run_on["b"]


def test_session_end_falls_back_to_the_last_event(spark):
    schema = "id string, user string, t timestamp_ntz, e timestamp_ntz"
    rows = [
        ("a", "late", at(0), at(-50)), ("b", "late", at(100), at(50)),
        ("c", "none", at(0), None),
        ("d", "long", at(0), at(500)), ("e", "long", at(100), None),
    ]
    got = as_dict(S.sessionize(frame(spark, rows, schema), ["user"], "t", raw_end="e"), "session_end")
    assert got == {"a": (at(100),), "b": (at(100),), "c": (at(0),), "d": (at(500),), "e": (at(500),)}


def test_hashed_id_and_label(spark):
    import hashlib

    row = S.sessionize(frame(spark, [("a", "u", at(0.25))]), ["user"], "t").first()
    assert row["session_label"] == "u__2024-01-10 10:00:00.25"
    assert row["session_id"] == hashlib.sha256(b"u||2024-01-10 10:00:00.25").hexdigest()
    assert row["is_session_assigned"] is True


def test_unknown_id_style(spark):
    with pytest.raises(ValueError):
        S.sessionize(frame(spark, [("a", "u", at(0))]), ["user"], "t", id_style="other")


@pytest.mark.parametrize("keys", [["user", "date"], ["user"]])
@pytest.mark.parametrize("gap", [60, 1800])
def test_matches_plain_windows_with_a_hot_user(spark, keys, gap):
    df = frame(spark, random_rows())
    want = plain_sessions(df, keys, gap)
    assert as_dict(S.previous_time(df, keys, "t", ["id"]), "prev_ts") == as_dict(want, "prev")
    assert as_dict(S.gap_flags(df, keys, "t", gap, ["id"]), "is_new_session") == as_dict(want, "flag")
    assert as_dict(S.session_sequence(df, keys, "t", gap), "session_seq") == as_dict(want, "seq")
    cut = "date" if "date" in keys else None
    rows = S.sessionize(df, ["user"], "t", gap, cut)
    assert as_dict(rows, "session_end") == as_dict(want, "stop")
    want_ids = S.session_names(want, "user", "hash", "start", "seq")
    assert as_dict(rows, "session_id") == as_dict(want_ids, "session_id")


@pytest.mark.parametrize("width", [1, 40, 5_000, None])
def test_previous_time_in_slices_of_any_width(spark, width, monkeypatch):
    monkeypatch.setattr(S.slice_width, "__defaults__", (100,))
    rows = random_rows(1500, seed=width or 2)
    rows += [(f"n{i}", None, at(i * 7)) for i in range(200)] + [(f"s{i}", "hot", at(3)) for i in range(50)]  # null keys, one moment
    df = frame(spark, rows).withColumns({"n": F.when(F.col("user") != "hot", F.length("user")), "b": F.col("user").cast("binary")})
    for keys in (["user"], ["user", "date"], ["n", "date"], ["b", "n"]):
        want = df.withColumn("prev", F.lag("t").over(Window.partitionBy(*keys).orderBy("t", "id")))
        found = S.previous_time(df, keys, "t", ["id"], slice_seconds=width)
        assert found.columns == [*df.columns, "prev_ts"]
        assert as_dict(found, "prev_ts") == as_dict(want, "prev")
    empty = S.previous_time(df.limit(0), ["user"], "t", slice_seconds=width)
    assert empty.count() == 0


def test_slices_follow_the_hottest_key(spark):
    hot = [(str(i), "hot", at(i % 3600)) for i in range(2000)]
    width = lambda rows, limit: spark.range(1).select(S.slice_width(frame(spark, rows), ["user"], "t", limit)).first()[0]
    assert width(hot, 100) == 180 and width(hot, 4000) == 7200 and width(hot, 10 ** 9) == 30 * 86_400
    assert width([("a", "u", at(0))] * 5000, 1) == 1 and width(hot[:0], 100) == 30 * 86_400


def test_previous_time_moves_its_rows_once(spark):
    """The join with the carried times uses the shuffle and the order that the lag needs."""
    df = frame(spark, random_rows(300)).withColumn("wide", F.repeat("id", 20))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = S.previous_time(df, ["user", "date"], "t", ["id"], slice_seconds=60)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above, below = plan.split("SortMergeJoin")
    rows, carried = below.split("+- Sort [_r__k0")
    assert rows.count("Exchange hashpartitioning") == rows.count("Sort [") == 1 and "wide" in rows
    assert "Exchange" not in above and "wide" not in carried


def test_gaps_across_a_clock_change(spark):
    """Real gaps decide, the wall clock names: 01:30 UTC is 02:30 once before and once after clocks go back."""
    zone, night = "Europe/Berlin", dt.datetime(2024, 10, 27)
    minutes = [-30, -5, 0, 25, 50, 60, 75, 110, 200, 1400, 1439]
    spring = dt.datetime(2024, 3, 31)
    rows = [(f"a{m}", "u", night + dt.timedelta(minutes=m)) for m in minutes] + [(f"s{m}", "u", spring + dt.timedelta(minutes=m)) for m in minutes]
    df = event_time(spark.createDataFrame(rows, "id string, user string, t timestamp_ntz"), "t", zone)
    found = S.sessionize(df, ["user"], "event_timestamp_utc", 1800, "date", zone=zone)
    offset = lambda t: dt.timedelta(hours=2 if dt.datetime(2024, 3, 31, 1) <= t < dt.datetime(2024, 10, 27, 1) else 1)
    days = {}
    for i, _, t in rows:
        days.setdefault((t + offset(t)).date(), []).append((t, i))
    want = {}
    for day in days.values():
        start = last = None
        for t, i in sorted(day):
            if last is None or (t - last).total_seconds() > 1800:
                start, members = t, []
            last = t
            members.append(i)
            for m in members:
                want[m] = (f"u__{start + offset(start)}", last + offset(last))
    got = {r["id"]: (r["session_label"], r["session_end"]) for r in found.collect()}
    assert got == want
    local = {r["id"]: r["session_label"] for r in S.sessionize(df, ["user"], "event_timestamp_local", 1800).collect()}
    assert local != {i: v[0] for i, v in want.items()}  # the wall clock alone would cut elsewhere


def test_raw_end_matches_plain_windows(spark):
    df = frame(spark, random_rows(seed=3)).withColumn(
        "e", F.when(F.xxhash64("id") % 3 != 0, F.col("t") + F.expr("make_dt_interval(0, 0, int(pmod(xxhash64(id), 90)))"))
    )
    want = plain_sessions(df, ["user", "date"], 1800, "e")
    assert as_dict(S.sessionize(df, ["user"], "t", raw_end="e"), "session_end") == as_dict(want, "stop")


def test_facts_agree_with_rolled_up_rows(spark):
    df = frame(spark, random_rows(seed=5))
    facts = S.block_facts(S.session_blocks(df, ["user", "date"], "t"), ["user"])
    rows = S.session_rollup(S.sessionize(df, ["user"], "t"), ["user", "date", "session_id", "session_label"], "t")
    cols = sorted(rows.columns)
    assert sorted(facts.select(cols).collect()) == sorted(rows.select(cols).collect())
    assert facts.agg(F.sum("event_count")).first()[0] == df.count()


def test_sessions_partition_rows_by_the_gap(spark):
    df = frame(spark, random_rows(seed=11))
    rows = S.sessionize(df, ["user"], "t")
    assert rows.count() == df.count()
    bad_inside = plain_sessions(rows, ["session_id"], 1800).filter("flag = 1").count()
    assert bad_inside == rows.select("session_id").distinct().count()


def test_broadcast_blocks_give_the_same_sessions(spark):
    df = frame(spark, random_rows(seed=13))
    blocks = S.session_blocks(df, ["user", "date"], "t")
    assert fits_broadcast(blocks, copies_made())
    small = S.sessionize(df, ["user"], "t", blocks=blocks, small=True)
    assert "BroadcastHashJoin" in executed(small)
    assert as_dict(small, "session_id") == as_dict(S.sessionize(df, ["user"], "t"), "session_id")


def test_a_hot_block_is_one_row_with_many_salts(spark):
    rows = [(f"e{i:04d}", "hot", at(i / 10)) for i in range(3000)] + [("x", "cold", at(0))]
    blocks = S.session_blocks(frame(spark, rows), ["user", "date"], "t", salt_by=["t", "id"])
    per_user = {r["user"]: r["count"] for r in blocks.groupBy("user").count().collect()}
    assert per_user == {"hot": 1, "cold": 1}
    copies = {r["user"]: r["count"] for r in spread(blocks).groupBy("user").count().collect()}
    assert copies["cold"] == 1 and SALTS // 2 < copies["hot"] <= SALTS


def test_rows_without_a_user_stay_in_sequence_mode(spark):
    rows = [("a", None, at(0)), ("b", "u", at(0)), ("c", "u", at(9000))]
    got = as_dict(S.sessionize(frame(spark, rows), ["user"], "t", cut_by=None, id_style="sequence"), "session_id")
    assert got == {"a": (None,), "b": ("u_1",), "c": ("u_2",)}


def test_bounds(spark):
    facts = S.block_facts(S.session_blocks(frame(spark, [("a", "u", at(0.5)), ("b", "u", at(10.5))]), ["user", "date"], "t"), ["user"])
    grace = S.session_bounds(facts, ["user"], "user", grace=60).first()
    assert (grace["sess_start"], grace["sess_end"]) == (at(-59.5), at(70.5))
    tail = S.session_bounds(facts, ["user"], "user", tail=1800).first()
    assert (tail["sess_start"], tail["sess_end"]) == (at(0.5), at(1810))
    with pytest.raises(ValueError):
        S.session_bounds(facts, ["user"], "user")


def test_row_duration(spark):
    df = frame(spark, [("a", "u", at(0.75))])
    assert S.row_duration(df, "t").first()["session_duration"] == 300
    with_end = df.withColumn("session_end", F.lit("2024-01-10 10:01:30.9"))
    assert S.row_duration(with_end, "t").first()["session_duration"] == 90


def test_empty_input_keeps_the_schema(spark):
    df = frame(spark, [])
    out = S.sessionize(df, ["user"], "t")
    assert out.count() == 0
    assert {"session_id", "session_label", "session_end", "is_session_assigned"} <= set(out.columns)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_shuffled_once_and_windows_see_blocks_only(spark):
    wide = frame(spark, random_rows(200)).withColumn("payload", F.repeat("id", 5))
    plan = executed(S.sessionize(wide, ["user"], "t"))
    assert plan.count("Exchange hashpartitioning") == 4 and "SortMergeJoin" in plan  # hashed by AQE where it fits
    assert "partial_min" in plan and "partial_bit_or" in plan
    assert not [line for line in plan.splitlines() if "Window [" in line and "payload" in line]


def test_facts_add_no_exchange_to_the_blocks(spark):
    blocks = S.session_blocks(frame(spark, random_rows(200)), ["user", "date"], "t")
    count = executed(blocks).count("Exchange hashpartitioning")
    assert executed(S.block_facts(blocks, ["user"])).count("Exchange hashpartitioning") == count == 2


def test_facts_of_staged_blocks_are_not_shuffled(spark):
    df = frame(spark, random_rows(200)).unionByName(frame(spark, [("n0", None, at(1)), ("n1", None, at(2)), ("n2", None, at(300))]))
    blocks = S.session_blocks(df, ["user", "date"], "t").localCheckpoint()
    facts = S.block_facts(blocks, ["user"])
    assert "Exchange" not in facts._jdf.queryExecution().executedPlan().toString()
    plain = blocks.groupBy("user", "date", "session_seq").agg(
        F.min("block_first"), F.max("block_last"), F.max(F.greatest("block_last", "block_end")), F.sum("block_rows"))
    told = facts.join(S.block_facts(blocks, ["user"], named=False).select("session_seq", F.col("session_start_ts").alias("s"), F.col("user").alias("u")),
                      F.col("user").eqNullSafe(F.col("u")) & (F.col("s") == F.col("session_start_ts")))
    got = told.select("user", "date", "session_seq", "session_start_ts", "session_last_ts", "session_end_ts", "event_count")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, plain.collect())))


def test_null_keys_are_a_group_of_their_own(spark):
    base = dt.datetime(2024, 1, 10)
    rows = [(None, base), (None, base + dt.timedelta(seconds=30)), ("a", base + dt.timedelta(seconds=40)), (None, base + dt.timedelta(hours=2))]
    df = spark.createDataFrame(rows, "u string, t timestamp_ntz")
    found = {(r["u"], r["t"]): r["is_new_session"] for r in S.gap_flags(df, ["u"], "t").collect()}
    assert [found[r] for r in rows] == [1, 0, 1, 1]

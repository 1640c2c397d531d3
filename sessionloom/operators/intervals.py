"""Attaching events to per-key time intervals.

Both sides meet on (key, time bucket). An interval is listed under every bucket it
touches, an event under its own, so that a user with many intervals is cut into
many join keys. Events of a hot key are salted, unless the caller has checked that
the interval side is small enough to broadcast.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from sessionloom.functions.times import shift_seconds, whole_seconds
from sessionloom.operators.skew import SLOT, Deal, crowded_hashes, dealt_left_join, fits_broadcast, left_join, salted_left_join
from sessionloom.session import Staging

BUCKET, PART, PARTS = "_bucket", "_part", "_parts"
_LO, _HI = "_iv_start", "_iv_end"
#: Intervals that one array of ``pick="latest"`` holds, about; where more crowd, a bucket is parted.
CROWD = 64


def bucket_copies(
    start: str, end: str, within: tuple[Column, Column], grace: int = 0, bucket_seconds: int = 21_600
) -> Column:
    """How many buckets an interval touches: the copies of it that ``interval_join`` sends."""
    lo, hi = (F.floor(whole_seconds(c) / bucket_seconds) for c in within)
    first = F.greatest(F.floor((whole_seconds(F.col(start)) - grace) / bucket_seconds), lo)
    last = F.least(F.floor((whole_seconds(F.col(end)) + grace) / bucket_seconds), hi)
    return F.greatest(last - first + 1, F.lit(0))


def _by_bucket(intervals: DataFrame, width: int, within: tuple[Column, Column]) -> DataFrame:
    first = F.greatest(F.floor(whole_seconds(F.col(_LO)) / width), within[0])
    last = F.least(F.floor(whole_seconds(F.col(_HI)) / width), within[1])
    return intervals.filter(first <= last).withColumn(BUCKET, F.explode(F.sequence(first, last)))


def _clipped(intervals: DataFrame, on: list[str]) -> DataFrame:
    """End an interval where the next start of its key hides it for good.

    From the next start on, the next interval wins if it ends no earlier. So a far-off raw end
    is listed under the buckets up to the next session only, not up to the end of the window.
    """
    rising = Window.partitionBy(*on).orderBy(_LO, _HI, "_payload")
    following = F.col("_next")
    until = F.when(following[_HI] >= F.col(_HI), F.least(F.col(_HI), following[_LO])).otherwise(F.col(_HI))
    return intervals.withColumn("_next", F.lead(F.struct(_LO, _HI)).over(rising)).withColumn(_HI, until).drop("_next")


def _visible(intervals: DataFrame, on: list[str], width: int) -> DataFrame:
    """Drop carried-in intervals that can never be the latest one in their bucket.

    An interval that started before the bucket is hidden for good if a later start, also
    before the bucket, reaches no less far into it. So what is left are the intervals that
    start in the bucket, those that end in it, and one.
    """
    carried = whole_seconds(F.col(_LO)) < F.col(BUCKET) * width
    reach = F.least(F.unix_micros(F.col(_HI).cast("timestamp")), (F.col(BUCKET) + 1) * width * 1_000_000)
    later = (
        Window.partitionBy(*on, BUCKET).orderBy(F.desc(_LO), F.desc(_HI), F.desc("_payload"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        intervals.withColumns({"_reach": reach, "_carried": carried})
        .withColumn("_until", F.max(F.when(F.col("_carried"), F.col("_reach"))).over(later))
        .filter(~F.col("_carried") | F.col("_until").isNull() | (F.col("_reach") > F.col("_until")))
        .drop("_until", "_reach", "_carried")
    )


def part_of(t: Column, width: int) -> Column:
    """The part of its bucket that a time lies in; a bucket has ``_parts`` of them."""
    return F.floor((whole_seconds(t) - F.col(BUCKET) * width) * F.col(PARTS) / width).cast("int")


def _entries_of(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """An array of intervals per ``keys``, the latest start first."""
    return intervals.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(_LO, _HI, "_payload")), asc=False).alias("_entries"))


def _placed(found: DataFrame, on: list[str], width: int, crowd: int, stage: Staging) -> tuple[DataFrame, DataFrame]:
    """The visible intervals of a bucket in arrays of ``crowd`` at most, with their number ``_held``; and ``on, _bucket, _parts`` of the buckets with more.

    Intervals are shuffled by their key, once: what hides them, their number and the arrays all go by it. Both are staged.
    """
    inside = Window.partitionBy(*on, BUCKET)
    place = F.row_number().over(inside.orderBy(F.desc(_LO), F.desc(_HI), F.desc("_payload")))
    seen = _visible(found, on, width).withColumns({"_chunk": F.floor((place - 1) / crowd), "_held": F.count(F.lit(1)).over(inside)})
    placed = stage.put(f"entries-{uuid.uuid4().hex}", _entries_of(seen, [*on, BUCKET, "_chunk", "_held"]).drop("_chunk"))
    parts = F.least(F.lit(width), F.ceil(F.col("_held") * 2 / crowd)).cast("int")
    held = placed.filter(F.col("_held") > crowd).select(*on, BUCKET, parts.alias(PARTS)).distinct()
    return placed, stage.put(f"crowded-{uuid.uuid4().hex}", held)


def _parted(found: DataFrame, on: list[str], width: int, crowd: int, stage: Staging) -> tuple[DataFrame, DataFrame | None]:
    """The visible intervals by bucket and part; and ``on, _bucket, _parts`` of the buckets with several parts, None without any."""
    placed, crowded = _placed(found, on, width, crowd, stage)
    one = placed.filter(F.col("_held") <= crowd).select(*on, BUCKET, F.lit(0).alias(PART), F.inline("_entries"))
    return (one, None) if crowded.isEmpty() else (one.unionByName(_in_parts(placed, crowded, on, width, crowd)), crowded)


def _in_parts(placed: DataFrame, crowded: DataFrame, on: list[str], width: int, crowd: int) -> DataFrame:
    """The intervals of ``crowded`` buckets by part.

    Crowded buckets were counted on the intervals alone, and staged. In such a
    bucket an interval is listed under the parts that it starts and ends in. Of those that
    cover a part from end to end only the latest start matters: a cover is kept as the
    latest start per power-of-two run of parts, and every part looks at the runs around it.
    So an interval has some rows per doubling of the parts, not one per part.
    """
    columns = [*on, BUCKET, PART, _LO, _HI, "_payload"]
    seen = placed.filter(F.col("_held") > crowd).select(*on, BUCKET, F.inline("_entries"))
    seen = salted_left_join(seen, crowded, [*on, BUCKET], [_LO, _HI])
    first, last = F.greatest(part_of(F.col(_LO), width), F.lit(-1)), F.least(part_of(F.col(_HI), width), F.col(PARTS))
    ranged = seen.filter(F.col(PARTS).isNotNull()).withColumns({"_first": first, "_last": last}).filter("_first <= _last")
    ends = F.array_distinct(F.filter(F.array("_first", "_last"), lambda p: (p >= 0) & (p < F.col(PARTS))))
    own = ranged.withColumn(PART, F.explode(ends)).select(*columns)

    levels, runs = width.bit_length(), []
    for level in range(levels):  # the runs of 2^level parts that make up what is between the first and the last part
        size = F.lit(1 << level)
        a, b = F.ceil((F.col("_first") + 1) / size).cast("int"), F.floor(F.col("_last") / size).cast("int")
        run = lambda at: F.struct(F.lit(level).alias("level"), at.alias("run"))  # noqa: B023, E731
        runs += [F.when((a < b) & (a % 2 == 1), run(a)), F.when((a < b) & (b % 2 == 1), run(b - 1))]
    covers = ranged.withColumn("_run", F.explode(F.filter(F.array(*runs), lambda r: r.isNotNull())))
    entry = F.struct(_LO, _HI, "_payload")
    tops = covers.groupBy(*on, BUCKET, F.col("_run.level").alias("_level"), F.col("_run.run").alias("_at")).agg(F.max(entry).alias("_top"))
    around = crowded.withColumn(PART, F.explode(F.sequence(F.lit(0), F.col(PARTS) - 1))).withColumn(
        "_level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))).withColumn("_at", F.expr(f"shiftright({PART}, _level)"))
    best = around.join(tops, [*on, BUCKET, "_level", "_at"]).groupBy(*on, BUCKET, PART).agg(F.max("_top").alias("_top"))
    best = best.select(*on, BUCKET, PART, f"_top.{_LO}", f"_top.{_HI}", "_top._payload")
    return own.unionByName(best)


def _bucket_of(c: Column, width: int) -> Column:
    return F.floor(whole_seconds(c) / width)


def latest_entries(
    intervals: DataFrame, on: dict[str, str], start: str, end: str, payload: list[str], within: tuple[Column, Column], stage: Staging,
    grace: int = 0, bucket_seconds: int = 21_600,
) -> tuple[DataFrame, DataFrame | None]:
    """The intervals as a latest-start join reads them: an array per key, bucket and part, and the parted buckets.

    They are staged and serve any number of ``interval_join`` calls over the same intervals, keys and bounds.
    Only the intervals of crowded buckets are shuffled again, to be parted.
    """
    found = _clipped(_by_key(intervals, on, start, end, payload, grace), list(on))
    found = _by_bucket(found, bucket_seconds, tuple(_bucket_of(c, bucket_seconds) for c in within))
    placed, crowded = _placed(found, list(on), bucket_seconds, CROWD, stage)
    if crowded.isEmpty():
        return placed.drop("_held"), None
    parted = _entries_of(_in_parts(placed, crowded, list(on), bucket_seconds, CROWD), [*on, BUCKET, PART])
    parted = stage.put(f"parted-{uuid.uuid4().hex}", parted)
    one = placed.filter(F.col("_held") <= CROWD).withColumn(PART, F.lit(0)).drop("_held")
    return one.unionByName(parted), crowded


def _by_key(intervals: DataFrame, on: dict[str, str], start: str, end: str, payload: list[str], grace: int) -> DataFrame:
    return intervals.select(
        *[F.col(r).alias(e) for e, r in on.items()],
        shift_seconds(F.col(start), -grace).alias(_LO),
        shift_seconds(F.col(end), grace).alias(_HI),
        F.struct(*payload).alias("_payload"),
    )


def crowded_events(events: DataFrame, on: list[str], t: str, bucket_seconds: int = 21_600) -> DataFrame:
    """The ``skew.crowded_hashes`` of events by key and bucket; stage it for ``interval_join``."""
    return crowded_hashes(events.withColumn(BUCKET, _bucket_of(F.col(t), bucket_seconds)), [*on, BUCKET])


def interval_join(
    events: DataFrame, intervals: DataFrame, on: dict[str, str], t: str, start: str, end: str, payload: list[str],
    how: str = "left", pick: str = "all", grace: int = 0, bucket_seconds: int = 21_600,
    within: tuple[Column, Column] | None = None, salt_by: list[str] | None = None, small: bool = False,
    stage: Staging | None = None, entries: tuple[DataFrame, DataFrame | None] | None = None, hot: DataFrame | None = None,
    deal: Deal | None = None,
) -> DataFrame:
    """Join events to the intervals of the same key with ``start - grace <= t <= end + grace``.

    ``on`` maps event key columns to interval key columns. ``pick="all"`` returns every
    match, ``pick="latest"`` the match with the latest start (a backward as-of join
    bounded by the interval end), at most one row per event. ``within`` gives time
    bounds that hold for all events; without it they are taken from the events.
    ``small`` says that ``skew.fits_broadcast`` holds for the intervals and their ``bucket_copies``.

    With ``latest`` the intervals of one key and bucket travel as one array: those that start or
    end in the bucket, and one. Where more than ``CROWD`` meet, as nested intervals may, the bucket is
    parted by time until a part holds about as many, down to single seconds; which buckets
    those are is counted when the join is made. ``entries`` is a ``latest_entries`` result for the same
    intervals; ``hot`` a ``crowded_events`` result, with which only crowded keys are salted.
    With a ``deal`` the joined rows are dealt out by it; events have its columns then, and either ``hot`` is given or ``small`` holds.
    """
    if pick not in ("all", "latest") or how not in ("left", "inner"):
        raise ValueError(f"unsupported: pick={pick}, how={how}")
    clash = sorted(set(payload) & set(events.columns))
    if clash:
        raise ValueError(f"interval columns collide with event columns: {', '.join(clash)}")

    if within is None:
        ends = events.agg(F.struct(F.min(t).alias("lo"), F.max(t).alias("hi")).alias("ends")).scalar()
        within = (ends["lo"], ends["hi"])
    keys = [*on, BUCKET]
    rows = events.withColumn(BUCKET, _bucket_of(F.col(t), bucket_seconds))
    where = None
    if pick == "latest":
        stage = stage or Staging(events.sparkSession, "intervals")
        found, crowded = entries or latest_entries(intervals, on, start, end, payload, within, stage, grace, bucket_seconds)
        if crowded is not None:
            if fits_broadcast(crowded):
                rows = left_join(rows, F.broadcast(crowded), keys)
            else:
                rows = salted_left_join(rows, crowded, keys, salt_by or [t])
            rows = rows.withColumn(PARTS, F.coalesce(PARTS, F.lit(1))).withColumn(PART, part_of(F.col(t), bucket_seconds)).drop(PARTS)
            keys = [*keys, PART]
    else:
        found = _by_key(intervals, on, start, end, payload, grace)
        found = _by_bucket(found, bucket_seconds, tuple(_bucket_of(c, bucket_seconds) for c in within))
        where = (F.col(t) >= F.col(_LO)) & (F.col(t) <= F.col(_HI))

    if small:
        rows = rows if deal is None else deal.out(rows, [*on, BUCKET, *(salt_by or [t])]).drop(SLOT)
        joined = left_join(rows, F.broadcast(found), keys, where)
    elif hot is not None:
        if deal is not None:
            found = deal.dated(found, F.col(BUCKET) * bucket_seconds, (F.col(BUCKET) + 1) * bucket_seconds - 1)
        joined = dealt_left_join(rows, found, keys, salt_by or [t], hot, [*on, BUCKET], where, deal)
    else:
        joined = salted_left_join(rows, found, keys, salt_by or [t], where)

    if pick == "latest":
        hits = F.filter("_entries", lambda e: (e[_LO] <= F.col(t)) & (e[_HI] >= F.col(t)))
        joined = joined.withColumn("_payload", F.get(hits, F.lit(0))["_payload"])
    if how == "inner":
        joined = joined.filter(F.col("_payload").isNotNull())
    return joined.select(*events.columns, *[F.col("_payload")[c].alias(c) for c in payload])


def assign_sessions(
    events: DataFrame, lookup: DataFrame, user: str, t: str, date: str = "date", tenant: str | None = None,
    label_unassigned: bool = True, **join,
) -> DataFrame:
    """Add ``session_id`` and ``is_session_assigned`` from a ``session_bounds`` lookup.

    Unmatched events get ``<user>_<date>_unassigned``, or a null id. A session id that the
    events bring along is kept as ``source_session_id``.
    """
    events = without_session(events)
    on = {**({tenant: tenant} if tenant else {}), user: "sess_user"}
    rows = interval_join(events, lookup, on, t, "sess_start", "sess_end", ["session_id"], **join)
    rows = rows.withColumn("is_session_assigned", F.col("session_id").isNotNull())
    if not label_unassigned:
        return rows
    fallback = F.concat(F.col(user).cast("string"), F.lit("_"), F.col(date).cast("string"), F.lit("_unassigned"))
    return rows.withColumn("session_id", F.coalesce("session_id", fallback))


def without_session(events: DataFrame) -> DataFrame:
    """Make room for the columns of a session; an id that the events bring along is ``source_session_id`` from here on."""
    if "session_id" in events.columns:
        events = events.withColumnRenamed("session_id", "source_session_id")
    return events.drop("is_session_assigned")


def unassigned(events: DataFrame) -> DataFrame:
    """The same columns as ``assign_sessions`` where there is nothing to join."""
    if "session_id" in events.columns:
        events = events.withColumnRenamed("session_id", "source_session_id")
    return events.withColumn("session_id", F.lit(None).cast("string")).withColumn("is_session_assigned", F.lit(False))


def drop_orphans(df: DataFrame) -> DataFrame:
    """Keep rows that belong to a session."""
    return df.filter("is_session_assigned")

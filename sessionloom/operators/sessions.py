"""Gap sessions.

Time is cut into blocks of ``gap + 1`` whole seconds. Two events of one user in
the same block are at most ``gap`` seconds apart, and so is every event between
them, so a block never spans two sessions. All rows of a (user, block) pair can
therefore be pre-aggregated, map side first, and the gap test runs on blocks: at
most 48 per user and day for a 30-minute gap, however many rows a user has. Rows
find their session again through a salted equi-join on the block.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sessionloom.functions.times import local_time, shift_seconds, utc_time, whole_seconds
from sessionloom.operators.skew import SALT, SLOT, Deal, left_join, salt_marks, spread, with_salt

BLOCK = "_block"
SLICE = "_slice"
#: Rows of one key that one window of ``previous_time`` orders.
ROWS_PER_SLICE = 500_000


def slice_width(df: DataFrame, keys: list[str], t: str, rows_per_slice: int = ROWS_PER_SLICE) -> Column:
    """Seconds such that no key has many more than ``rows_per_slice`` rows in as much time, a month at most.

    Rows are counted per hour and per hash bucket of the keys, so that the count stays small
    however many keys there are. A bucket has at least the rows of each of its keys.
    """
    hour, bucket = F.floor(whole_seconds(F.col(t)) / 3600), F.pmod(F.xxhash64(*keys), F.lit(4096))
    counts = df.groupBy(hour.alias("_hour"), bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    width = F.floor(3600 * rows_per_slice / F.max("_rows"))
    return counts.agg(F.greatest(F.lit(1), F.least(F.lit(30 * 86_400), width)).alias("width")).scalar()


def _never_null(df: DataFrame, keys: list[str]) -> dict[str, Column]:
    """Columns that are equal just where ``keys`` are equal or both null, and never null themselves.

    A null-safe join would compare expressions that a window on the keys is not partitioned by, and
    shuffle and sort its rows a second time.
    """
    out, nulls = {}, F.lit(0)
    for i, k in enumerate(keys):
        dtype = df.schema[k].dataType
        if isinstance(dtype, (T.NumericType, T.BooleanType)):
            instead = F.lit(0).cast(dtype)
        elif isinstance(dtype, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            instead = F.lit("1970-01-01").cast(dtype)
        else:
            instead = None
        out[f"_k{i}"] = F.struct(F.col(k)) if instead is None else F.coalesce(F.col(k), instead)
        nulls = nulls * 2 + F.col(k).isNull().cast("int")
    return {**out, "_nulls": nulls}


def previous_time(
    df: DataFrame, keys: list[str], t: str, tie: list[str] | None = None, out: str = "prev_ts", slice_seconds: int | None = None
) -> DataFrame:
    """Add the previous event time within ``keys``, ordered by ``t`` then ``tie``.

    The lag runs inside time slices, whose width follows from the rows (``slice_width``) unless it
    is given: a slice of a hot key is one task's work, and a key with few rows has few slices.
    The first row of a slice takes the last time of the slice before it, found on one narrow
    row per slice. Rows are shuffled and sorted once, for the lag; the join with the carried
    times uses that order. Null keys form a group of their own; times must not be null.
    """
    width = F.lit(slice_seconds) if slice_seconds else slice_width(df, keys, t)
    same = _never_null(df, keys)
    sliced = df.withColumns({**same, SLICE: F.floor(whole_seconds(F.col(t)) / width)})
    by = [*same, SLICE]
    inside = Window.partitionBy(*by).orderBy(t, *(tie or []))
    across = Window.partitionBy(*same).orderBy(SLICE)
    carry = (
        sliced.groupBy(*by).agg(F.max(t).alias("_last"))
        .select(*by, F.lag("_last").over(across).alias("_carry"))
        .filter(F.col("_carry").isNotNull())
    )
    joined = left_join(sliced.withColumn("_local", F.lag(t).over(inside)), carry, by)
    return joined.withColumn(out, F.coalesce("_local", "_carry")).drop("_local", "_carry", *by)


def gap_flags(
    df: DataFrame, keys: list[str], t: str, gap: int = 1800, tie: list[str] | None = None, out: str = "is_new_session"
) -> DataFrame:
    """Add 1 for the first event of ``keys`` or after more than ``gap`` whole seconds, else 0."""
    apart = whole_seconds(F.col(t)) - whole_seconds(F.col("_prev"))
    return (
        previous_time(df, keys, t, tie, out="_prev")
        .withColumn(out, F.when(F.col("_prev").isNull() | (apart > gap), 1).otherwise(0))
        .drop("_prev")
    )


def _with_block(df: DataFrame, t: str, gap: int) -> DataFrame:
    return df.withColumn(BLOCK, F.floor(whole_seconds(F.col(t)) / (gap + 1)))


def session_blocks(
    df: DataFrame, keys: list[str], t: str, gap: int = 1800, raw_end: str | None = None,
    salt_by: list[str] | None = None,
) -> DataFrame:
    """One row per key and non-empty block, with the session it belongs to.

    Adds ``session_seq`` (1, 2, … within the key), ``session_start`` and ``session_end``:
    the latest event or, if later, the latest ``raw_end`` of the session; and its latest event and
    number of rows, ``session_last`` and ``session_rows``, so that its facts need no further shuffle.
    """
    end = F.max(raw_end) if raw_end else F.lit(None).cast("timestamp_ntz")
    blocks = (
        with_salt(_with_block(df, t, gap), salt_by or [t])
        .groupBy(*keys, BLOCK)
        .agg(
            F.min(t).alias("block_first"),
            F.max(t).alias("block_last"),
            end.alias("block_end"),
            F.count(F.lit(1)).alias("block_rows"),
            *salt_marks(),
        )
    )
    ordered = Window.partitionBy(*keys).orderBy(BLOCK)
    whole = Window.partitionBy(*keys, "session_seq")
    apart = whole_seconds(F.col("block_first")) - whole_seconds(F.col("_prev"))
    opens = F.when(F.col("_prev").isNull() | (apart > gap), 1).otherwise(0)
    return (
        blocks.withColumn("_prev", F.lag("block_last").over(ordered))
        .withColumn("_opens", opens)
        .withColumn("session_seq", F.sum("_opens").over(ordered))
        .withColumn("session_start", F.max(F.when(F.col("_opens") == 1, F.col("block_first"))).over(ordered))
        .withColumn("session_last", F.max("block_last").over(whole))
        .withColumn("session_end", F.greatest("session_last", F.max("block_end").over(whole)))
        .withColumn("session_rows", F.sum("block_rows").over(whole))
        .drop("_prev", "_opens")
    )


def attach_sessions(
    df: DataFrame, blocks: DataFrame, keys: list[str], t: str, gap: int, salt_by: list[str] | None, small: bool = False,
    deal: Deal | None = None,
) -> DataFrame:
    """Give every row the ``_seq``, ``_start`` and ``_end`` of its session; ``name_sessions`` makes its id of them.

    With a ``deal`` the rows come dealt out by it; they have its columns then.
    """
    found = spread(blocks).select(
        *keys, BLOCK, SALT,
        F.col("session_seq").alias("_seq"),
        F.col("session_start").alias("_start"),
        F.col("session_end").alias("_end"),
    )
    rows = with_salt(_with_block(df, t, gap), salt_by or [t])
    # Not broadcast, the join sorts and can spill, or hashes if AQE finds all partitions small (``session.RUN_SETTINGS``).
    on = [*keys, BLOCK, SALT]
    if deal is None:
        joined = left_join(rows, found, on, hint="broadcast" if small else None)
    elif small:
        joined = left_join(deal.out(rows, on).drop(SLOT), found, on, hint="broadcast")
    else:
        if "date" not in keys:
            found = deal.dated(found, F.col(BLOCK) * (gap + 1), (F.col(BLOCK) + 1) * (gap + 1) - 1)
        joined = deal.left_join(rows, found, on, on)
    # Blocks come from the same rows, so only a null key or time may be without one.
    whole = reduce(and_, [F.col(c).isNotNull() for c in [*keys, BLOCK]])
    lost = F.col("_seq").isNull() & whole
    error = F.raise_error(F.lit("a row has no session block: blocks and rows differ"))
    checked = {c: F.when(lost, error).otherwise(F.col(c)) for c in ("_seq", "_start", "_end")}
    return joined.withColumns(checked).select(*df.columns, "_seq", "_start", "_end")


def session_sequence(
    df: DataFrame, keys: list[str], t: str, gap: int = 1800, out: str = "session_seq",
    salt_by: list[str] | None = None,
) -> DataFrame:
    """Add the session number within ``keys``."""
    blocks = session_blocks(df, keys, t, gap, salt_by=salt_by)
    return attach_sessions(df, blocks, keys, t, gap, salt_by).withColumn(out, F.col("_seq")).drop("_seq", "_start", "_end")


def session_id_of(user: Column, id_style: str, found: Column) -> Column:
    """A session's id from its user and its start or, for sequence ids, its number."""
    who, what = user.cast("string"), found.cast("string")
    if id_style == "sequence":
        return F.concat(who, F.lit("_"), what)
    if id_style != "hash":
        raise ValueError(f"unknown id style: {id_style}")
    return F.sha2(F.concat_ws("||", who, what), 256)


def session_names(df: DataFrame, user: str, id_style: str, start: str, seq: str) -> DataFrame:
    """Add ``session_id`` and, for hashed ids, ``session_label``."""
    df = df.withColumn("session_id", session_id_of(F.col(user), id_style, F.col(seq if id_style == "sequence" else start)))
    return df if id_style == "sequence" else df.withColumn("session_label", F.concat(F.col(user).cast("string"), F.lit("__"), F.col(start).cast("string")))


def sessionize(
    df: DataFrame, keys: list[str], t: str, gap: int = 1800, cut_by: str | None = "date", id_style: str = "hash",
    raw_end: str | None = None, salt_by: list[str] | None = None, blocks: DataFrame | None = None,
    small: bool = False, zone: str | None = None,
) -> DataFrame:
    """Give every row its session.

    ``keys`` end with the user column. ``cut_by`` (the local date) starts a new session
    at midnight; ``None`` lets sessions run on. Hashed ids come with ``session_label``,
    ``session_end`` and ``is_session_assigned``. Pass ``blocks`` to reuse a materialised
    ``session_blocks`` of the same rows; ``small`` says that ``skew.fits_broadcast`` holds
    for them and their ``copies_made``. With a ``zone``, ``t`` and ``raw_end`` are UTC, so that gaps
    are real time across a clock change, and ids, labels and ends show the wall clock of the zone.
    """
    by = [*keys, cut_by] if cut_by else list(keys)
    if blocks is None:
        blocks = session_blocks(df, by, t, gap, raw_end, salt_by)
    return name_sessions(attach_sessions(df, blocks, by, t, gap, salt_by, small), keys[-1], id_style, zone)


def name_sessions(rows: DataFrame, user: str, id_style: str = "hash", zone: str | None = None) -> DataFrame:
    """The session columns of ``sessionize`` from those of ``attach_sessions``: row-local, so it can come after a shuffle."""
    if zone:
        rows = rows.withColumns({c: local_time(F.col(c), zone) for c in ("_start", "_end")})
    rows = session_names(rows, user, id_style, "_start", "_seq")
    if id_style == "hash":
        rows = rows.withColumn("session_end", F.col("_end")).withColumn("is_session_assigned", F.lit(True))
    return rows.drop("_seq", "_start", "_end")


def block_facts(
    blocks: DataFrame, keys: list[str], cut_by: str | None = "date", id_style: str = "hash", zone: str | None = None,
    named: bool = True,
) -> DataFrame:
    """One row per session straight from its blocks; the rows are not read again.

    The block that opens a session has all of its facts, so blocks read from a staged table are not shuffled.
    With a ``zone`` the blocks' times are UTC and stay so, and ids show the wall clock of the zone.
    Not ``named``, a session has its ``session_seq`` and no id yet.
    """
    by = [*keys, cut_by] if cut_by else list(keys)
    opening = blocks.filter(F.col("block_first").eqNullSafe(F.col("session_start")))
    facts = opening.select(
        *by, "session_seq",
        F.col("session_start").alias("session_start_ts"),
        F.col("session_last").alias("session_last_ts"),
        F.col("session_end").alias("session_end_ts"),
        F.col("session_rows").alias("event_count"),
    )
    if not named:
        return facts
    start = local_time(F.col("session_start_ts"), zone) if zone else F.col("session_start_ts")
    return session_names(facts.withColumn("_start", start), keys[-1], id_style, "_start", "session_seq").drop("session_seq", "_start")


def session_rollup(rows: DataFrame, by: list[str], t: str = "event_timestamp", end: str | None = "session_end") -> DataFrame:
    """One row per session from rows that carry a session id; ``by`` holds that id."""
    return rows.groupBy(*by).agg(
        F.min(t).alias("session_start_ts"),
        F.max(t).alias("session_last_ts"),
        F.max(end or t).alias("session_end_ts"),
        F.count(F.lit(1)).alias("event_count"),
    )


def session_bounds(
    facts: DataFrame, keys: list[str], user: str, grace: int | None = None, tail: int | None = None,
    name: str = "session_id",
) -> DataFrame:
    """Lookup intervals ``sess_start`` … ``sess_end`` per session.

    ``tail``: from the first event to the last event's whole second plus ``tail``.
    ``grace``: from ``grace`` seconds before the start to ``grace`` seconds after the session end.
    ``name`` is the column of ``facts`` that tells the sessions apart.
    """
    if (grace is None) == (tail is None):
        raise ValueError("give either grace or tail")
    if tail is not None:
        lo = F.col("session_start_ts")
        hi = F.timestamp_seconds(whole_seconds(F.col("session_last_ts")) + tail).cast("timestamp_ntz")
    else:
        lo = shift_seconds(F.col("session_start_ts"), -grace)
        hi = shift_seconds(F.col("session_end_ts"), grace)
    others = [F.col(k) for k in keys if k != user]
    return facts.select(
        *others, F.col(user).alias("sess_user"), name, lo.alias("sess_start"), hi.alias("sess_end")
    )


def row_duration(
    df: DataFrame, t: str, end: str = "session_end", default_tail: int = 300, out: str = "session_duration"
) -> DataFrame:
    """Add ``session_end_ts`` and the whole seconds from ``t`` to it.

    Without an ``end`` column a row ends ``default_tail`` seconds after its own whole second.
    """
    if end in df.columns:
        stop = utc_time(F.col(end), df.schema[end].dataType)
    else:
        stop = F.timestamp_seconds(whole_seconds(F.col(t)) + default_tail).cast("timestamp_ntz")
    return df.withColumn("session_end_ts", stop).withColumn(
        out, whole_seconds(F.col("session_end_ts")) - whole_seconds(F.col(t))
    )

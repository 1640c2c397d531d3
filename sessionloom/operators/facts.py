"""Session facts: activity counts, duration, bounce and engagement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sessionloom.functions.times import exact_seconds, local_time
from sessionloom.operators.shape import ensure_columns

COUNTS = ("scroll_count", "click_count", "unique_pages")

# Fixed value: a session shorter than this many seconds can be a bounce.
SHORT_SESSION = 10.0


def activity_counts(activity: DataFrame, by: list[str]) -> DataFrame:
    """Scrolls, clicks and distinct pages per session."""
    known = ensure_columns(activity, {"activity": "string", "page": "string"})
    return known.groupBy(*by).agg(
        F.count_if(F.col("activity") == "scroll").alias("scroll_count"),
        F.count_if(F.col("activity") == "click").alias("click_count"),
        F.countDistinct("page").alias("unique_pages"),
    )


def is_bounce() -> Column:
    """Short, without scrolls or clicks, on one page at most."""
    return (
        (F.col("session_duration") < SHORT_SESSION)
        & (F.col("scroll_count") == 0)
        & (F.col("click_count") == 0)
        & (F.col("unique_pages") <= 1)
    )


def is_engaged() -> Column:
    """Not a bounce, not short, and with some activity."""
    active = (F.col("scroll_count") > 0) | (F.col("click_count") > 0) | (F.col("unique_pages") > 1)
    return ~is_bounce() & (F.col("session_duration") >= SHORT_SESSION) & active


def session_master(
    facts: DataFrame, activity: DataFrame | None = None, on: list[str] | None = None, zone: str | None = None
) -> DataFrame:
    """One row per session with duration, activity counts and both flags.

    ``facts`` is a ``block_facts`` or ``session_rollup`` result; ``activity`` holds rows
    that carry a session id. Without it the work is row-local: counts are those that the facts bring along, or 0. With a ``zone`` the facts' times are UTC;
    the duration is real time, and the times come out as the wall clock of the zone.
    """
    on = on or ["session_id"]
    if activity is not None:
        facts = facts.join(activity_counts(activity, on), on, "left")
    length = exact_seconds(F.col("session_end_ts")) - exact_seconds(F.col("session_start_ts"))
    master = facts.drop("session_last_ts").withColumn("session_duration", F.round(length, 4))
    if zone:
        master = master.withColumns({c: local_time(F.col(c), zone) for c in ("session_start_ts", "session_end_ts")})
    master = ensure_columns(master, {c: "bigint" for c in COUNTS}).fillna(0, list(COUNTS))
    master = master.select(*[c for c in master.columns if c not in COUNTS], *COUNTS)
    return master.withColumn("is_bounce", is_bounce()).withColumn("is_engaged", is_engaged())

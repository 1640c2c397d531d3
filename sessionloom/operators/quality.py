"""Row quality: one ``drop_reason`` per row, and counters taken from it in a single aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sessionloom.functions.identity import is_bot, resolved_identity, valid_identity

NULL_AGENT = "null_user_agent"
BOT = "bot"
BAD_IDENTITY = "invalid_identity"
NULL_TIME = "null_timestamp"
LEAK = "outside_window"


def resolve_identity(df: DataFrame, primary: str = "user_id", fallback: str = "fingerprint") -> tuple[DataFrame, str | None]:
    """Add ``resolved_user_id`` when both columns exist; return the frame and its user column."""
    have = set(df.columns)
    if primary in have and fallback in have:
        user = resolved_identity(F.col(primary), F.col(fallback))
        return df.withColumn("resolved_user_id", user), "resolved_user_id"
    for c in (fallback, primary):
        if c in have:
            return df, c
    return df, None


LOWERED = "_lowered_agent"


def tag_quality(
    df: DataFrame, agent: str | None, user: str | None, pattern: str | None = None, out: str = "drop_reason"
) -> DataFrame:
    """Add the first reason to drop a row: null agent, then bot, then invalid identity; null keeps it.

    ``pattern`` replaces the built-in bot words by a regex of the caller's.
    """
    reason = F.when(~valid_identity(F.col(user)), BAD_IDENTITY) if user else F.lit(None).cast("string")
    if not agent:
        return df.withColumn(out, reason)
    name = F.col(agent)
    bot = name.rlike(pattern) if pattern else is_bot(name, F.col(LOWERED))
    tagged = F.when(name.isNull(), NULL_AGENT).when(bot, BOT).otherwise(reason)
    # A column of its own, so that the agent is lowered once and not once per word.
    return df.withColumn(LOWERED, F.lower(name)).withColumn(out, tagged).drop(LOWERED)


def time_reason(t: Column, lo: Column | None = None, hi: Column | None = None) -> Column:
    """Null time, then outside ``[lo, hi)``; null keeps the row."""
    reason = F.when(t.isNull(), NULL_TIME)
    if lo is None or hi is None:
        return reason
    return reason.when((t < lo) | (t >= hi), LEAK)


def drop_null(df: DataFrame, c: str) -> DataFrame:
    """Keep rows whose ``c`` is known."""
    return df.filter(F.col(c).isNotNull())


def quality_filter(df: DataFrame, agent: str | None, user: str | None, pattern: str | None = None) -> DataFrame:
    """Rows without any quality reason."""
    if user:
        df = df.filter(valid_identity(F.col(user)))
    if agent:
        df = tag_quality(df.filter(F.col(agent).isNotNull()), agent, None, pattern, "_quality")
        df = df.filter(F.col("_quality").isNull()).drop("_quality")
    return df


def audit_counts(tagged: DataFrame, by: str = "tenant", reason: str = "drop_reason") -> DataFrame:
    """All counters per ``by`` in one pass over the tagged rows.

    Rows are first counted per reason, so that the reason is worked out once per row and
    not once per counter; the counters are then picked from those few groups.
    """
    r, n = F.col(reason), F.col("_rows")

    def counter(match: Column) -> Column:
        return F.coalesce(F.sum(F.when(match, n)), F.lit(0))

    return tagged.groupBy(by, reason).agg(F.count(F.lit(1)).alias("_rows")).groupBy(by).agg(
        F.sum(n).alias("rows_read_raw"),
        counter(r == NULL_AGENT).alias("null_user_agent_dropped"),
        counter(r == BOT).alias("bots_dropped"),
        counter(r == BAD_IDENTITY).alias("invalid_identity_dropped"),
        counter(r == NULL_TIME).alias("null_timestamp_dropped"),
        counter(r == LEAK).alias("mongo_filter_leak_dropped"),
        counter(r.isNull()).alias("rows_kept"),
    )


def reason_metrics(reason: str = "drop_reason") -> list[Column]:
    """The counters of ``audit_counts`` as metrics of an ``Observation`` on one tenant's tagged rows."""
    r = F.col(reason)
    return [
        F.count(F.lit(1)).alias("rows_read_raw"),
        F.count_if(r == NULL_AGENT).alias("null_user_agent_dropped"),
        F.count_if(r == BOT).alias("bots_dropped"),
        F.count_if(r == BAD_IDENTITY).alias("invalid_identity_dropped"),
        F.count_if(r == NULL_TIME).alias("null_timestamp_dropped"),
        F.count_if(r == LEAK).alias("mongo_filter_leak_dropped"),
        F.count_if(r.isNull()).alias("rows_kept"),
    ]

"""Declarative configuration: tenants, table specs, time windows and processing rules."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import types as T


@dataclass(frozen=True)
class Tenant:
    """One customer: its partition name in the target and its prefix in the source."""

    name: str
    prefix: str


@dataclass(frozen=True)
class Source:
    """Where raw tables live. Format and options are the caller's; credentials belong in ``options``.

    ``location`` is a path template with ``{prefix}`` and ``{suffix}``. Connectors that
    take a table name as an option set ``name_option`` instead of ``location``.
    """

    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    location: str | None = None
    name_option: str | None = None


@dataclass(frozen=True)
class Layout:
    """Where target tables lie below a run's target.

    By default a table is one dataset, partitioned by tenant first. With ``tenant_first`` every
    tenant has a dataset of its own per table, ``<target>/<tenant>/<table>``, and an audit of its
    own, so that runs for different tenants can write at the same time.
    """

    tenant_first: bool = False

    def root(self, target: str, table: str, tenant: str) -> str:
        return f"{target}/{tenant}/{table}" if self.tenant_first else f"{target}/{table}"


@dataclass(frozen=True)
class TableSpec:
    """How one raw table maps to one target table.

    ``iso_text`` says that a text time column holds ISO-8601 dates, so that the time window can
    be pushed to the scan as a range of text; rows whose text lies outside are not read at all.
    """

    suffix: str
    target: str
    time_col: str = "createdAt"
    user_col: str = "fingerprint"
    nested: tuple[str, ...] = ()
    coerce_times: tuple[str, ...] = ()
    force_string: tuple[str, ...] = ()
    time_encoding: str = "time"
    iso_text: bool = False
    is_session: bool = False
    is_activity: bool = False
    check_agents: bool = False
    needs_session: bool = False
    full_load: bool = False


@dataclass(frozen=True)
class RunWindow:
    """Local days ``[day, next_day)`` as ISO dates."""

    day: str
    next_day: str

    @classmethod
    def yesterday(cls, zone: str = "Asia/Kolkata") -> "RunWindow":
        today = datetime.now(ZoneInfo(zone)).date()
        return cls((today - timedelta(days=1)).isoformat(), today.isoformat())

    def days(self) -> list[date]:
        first, last = date.fromisoformat(self.day), date.fromisoformat(self.next_day)
        return [first + timedelta(days=i) for i in range((last - first).days)]


@dataclass(frozen=True)
class Rules:
    """Processing rules; ``Rules.daily()`` is the default, ``Rules.sequence()`` the first-generation mode."""

    zone: str = "Asia/Kolkata"
    gap_seconds: int = 1800
    cut_by_day: bool = True
    id_style: str = "hash"
    grace_seconds: int = 60
    tail_seconds: int | None = None
    default_duration: int | None = None
    pick: str = "latest"
    resolve_users: bool = True
    quality: bool = True
    deduplicate: bool = True
    label_unassigned: bool = True
    enforce_types: bool = True
    build_master: bool = True
    master_user: str = "resolved_user_id"
    inclusive_days: bool = False
    partition_by: tuple[str, ...] = ("year", "month", "day")
    broadcast_rows: int = 500_000
    parallel_tables: int = 4

    @classmethod
    def daily(cls, **changes) -> "Rules":
        return replace(cls(), **changes)

    @classmethod
    def sequence(cls, **changes) -> "Rules":
        """No day cut, numbered session ids, lookup end = last event + gap, every row kept."""
        base = cls(
            zone="UTC", cut_by_day=False, id_style="sequence", grace_seconds=0, tail_seconds=1800,
            default_duration=300, pick="all", resolve_users=False, quality=False, deduplicate=False,
            label_unassigned=False, enforce_types=False, build_master=False, inclusive_days=True, partition_by=("date",),
        )
        return replace(base, **changes)


# Raw column names and the names they take in the target.
RENAMES = {
    "_id": "mongo_id",
    "sessionStart": "session_start",
    "sessionEnd": "session_end_raw",
    "sessionend": "session_end_raw",
    "createdAt": "created_at",
    "userAgent": "user_agent",
}

# The first-generation rename map.
SEQUENCE_RENAMES = {
    "_id": "mongo_id",
    "sessionStart": "session_start",
    "sessionEnd": "session_end",
    "createdAt": "created_at",
    "userAgent": "user_agent",
    "productId": "product_id",
}

# Declared types of known target columns. Local wall-clock times are NTZ.
CASTS = {
    "fingerprint": T.StringType(),
    "session_id": T.StringType(),
    "event_timestamp": T.TimestampNTZType(),
    "created_at": T.TimestampNTZType(),
    "session_start": T.TimestampNTZType(),
    "is_session_assigned": T.BooleanType(),
    "is_bounce": T.BooleanType(),
    "is_engaged": T.BooleanType(),
    "session_duration": T.DoubleType(),
}

# The standard click-tracking tables.
SPECS = (
    TableSpec(
        "activity_logs_v2", "activity_logs_v2", nested=("userAgent", "user_agent", "details"),
        coerce_times=("details.timestamp",), is_activity=True, needs_session=True,
    ),
    TableSpec("user_sessions_v2", "user_sessions_v2", is_session=True, check_agents=True),
    TableSpec(
        "nudge_recommendations", "nudge_recommendations_v2",
        nested=("recommendations", "qa_pairs"), needs_session=True,
    ),
    TableSpec("nudge_responses_v2", "nudge_responses_v2", needs_session=True),
    TableSpec("fingerprint", "fingerprint_v2", nested=("userAgent", "user_agent"), check_agents=True),
)

# The same tables as the first-generation mode reads them.
SEQUENCE_SPECS = (
    TableSpec("activity_logs_v2", "activity_logs_v2", time_col="time", nested=("details",), is_activity=True),
    TableSpec("fingerprint", "fingerprint_v2", nested=("userAgent",)),
    TableSpec("nudge_recommendations", "nudge_recommendations_v2", nested=("recommendations", "qa_pairs")),
    TableSpec("nudge_responses_v2", "nudge_responses_v2"),
    TableSpec("user_sessions_v2", "user_sessions_v2", time_col="sessionStart", is_session=True),
)

"""The tenant run: raw tables in, sessions, enriched tables, session facts and audit out.

Each table is one plan over all tenants, with the tenant as a key. Raw data is read
once and tagged row by row; the write that stages the rows to keep counts the dropped ones
by reason. Everything after that reads staged or target Parquet with pruned columns.
"""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from sessionloom import sinks
from sessionloom.config import CASTS, RENAMES, SPECS, Layout, Rules, RunWindow, Source, TableSpec, Tenant
from sessionloom.functions.times import local_day_bounds, local_time
from sessionloom.operators import dedup as copies, quality, shape
from sessionloom.operators.facts import activity_counts, session_master
from sessionloom.operators.intervals import (
    bucket_copies, crowded_events, interval_join, latest_entries, unassigned, without_session,
)
from sessionloom.operators.sessions import (
    attach_sessions, block_facts, name_sessions, row_duration, session_blocks, session_bounds, session_id_of, session_names,
    session_rollup,
)
from sessionloom.operators.skew import SLOTS, Deal, copies_made, fits_broadcast
from sessionloom.plans.audit import Audit
from sessionloom.session import RUN_SETTINGS, Staging, settings
from sessionloom.sources.reader import Unreadable, read_table, time_window

log = logging.getLogger(__name__)

TENANT = "tenant"
USER = "_user"
ENRICH = "_enrich"
SPREAD = "_spread"
RESOLVED = "resolved_user_id"
CONTENT = "_content"
ORPHAN = "_orphan"
#: What a row carries of its session through the shuffles: its start or number. Ids are made of it where rows are written.
FOUND, JOINED = "_found", "_joined"
_KEY = "_session_key"
#: Gaps, intervals and orders are real time; the wall clock only names days and sessions.
TIME = "event_timestamp_utc"
ID = "mongo_id"
EXTRA_TIMES = ("created_at", "session_start", "session_end_raw")
MASTER = "session_master"
AUDIT_TABLE = "etl_quality_audit"


class NoUser(ValueError):
    """The session table has no user column."""


@dataclass
class RunResult:
    """Audit rows of a run, and the written tables (none in a dry run)."""

    run_id: str
    audit: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)


def shape_table(
    df: DataFrame, spec: TableSpec, rules: Rules, bounds: tuple[Column, Column] | None,
    renames: dict[str, str] = RENAMES,
) -> DataFrame:
    """Row-local part of a table: filter, flatten, rename, identity, times and ``drop_reason``."""
    if bounds is not None and spec.time_col in df.columns:
        df = time_window(df, spec.time_col, *bounds, encoding=spec.time_encoding, iso_text=spec.iso_text)
    df = shape.stringify(shape.flatten_struct(df, "body"), spec.nested)
    df = shape.rename(df, renames)
    time_col = renames.get(spec.time_col, spec.time_col)
    if time_col not in df.columns and df.isEmpty():
        df = shape.ensure_columns(df, {c: "string" for c in (time_col, spec.user_col, "user_agent", "user_id")})
    shape.require_columns(df, [time_col])

    user = spec.user_col if spec.user_col in df.columns else None
    if rules.resolve_users:
        df, user = quality.resolve_identity(df, fallback=spec.user_col)
    if spec.is_session and user is None:
        raise NoUser(f"User column '{spec.user_col}' not found")
    df = df.withColumn(USER, F.col(user).cast("string") if user else F.lit(None).cast("string"))
    df = df.withColumn(ENRICH, F.lit(user is not None and not spec.full_load))

    df = shape.event_time(df, time_col, rules.zone, spec.time_encoding)
    df = shape.localize(df, EXTRA_TIMES, rules.zone, {time_col: spec.time_encoding})
    reason = quality.time_reason(F.col("event_timestamp_utc"), *(bounds if bounds is not None else ()))
    if not rules.quality:
        return df.withColumn("drop_reason", reason)
    agent = None
    if spec.check_agents and "user_agent" in df.columns:
        agent = "_agent"
        df = df.withColumn(agent, shape.text_of(F.col("user_agent"), df.schema["user_agent"].dataType))
    df = quality.tag_quality(df, agent, USER if user else None).withColumn("_time_reason", reason)
    return df.withColumn("drop_reason", F.coalesce("drop_reason", "_time_reason")).drop("_time_reason", "_agent")


def run(
    spark: SparkSession, source: Source, tenants: list[Tenant], target: str, window: RunWindow | None = None,
    specs: tuple[TableSpec, ...] = SPECS, rules: Rules = Rules(), only: str | None = None, dry_run: bool = False,
    renames: dict[str, str] = RENAMES, max_files: int | None = None, run_id: str | None = None, refresh: str = "touched",
    layout: Layout = Layout(),
) -> RunResult:
    """Process every spec for every tenant and append one audit row per pair.

    ``window`` defaults to yesterday in the rules' zone; any range of days back-fills.
    ``only`` isolates one tenant; partitions of the others stay as they are. A tenant or
    table that fails is recorded in the audit and does not stop the rest. A dry run
    computes and counts everything and writes nothing to ``target``. ``refresh="all"``
    replaces each table as a whole instead of the touched partitions; where all tenants share
    a dataset, for all tenants only. ``max_files`` bounds the files of every partition. With
    ``Layout(tenant_first=True)`` runs for different tenants may go on at the same time. The
    caller's session settings are as before when the run ends.
    """
    if refresh == "all" and only is not None and not layout.tenant_first:
        raise ValueError("a full refresh replaces the rows of all tenants")
    with settings(spark, RUN_SETTINGS):
        return _run(spark, source, tenants, target, window, specs, rules, only, dry_run, renames, max_files, run_id, refresh, layout)


def _run(spark, source, tenants, target, window, specs, rules, only, dry_run, renames, max_files, run_id, refresh, layout) -> RunResult:
    window = window or RunWindow.yesterday(rules.zone)
    chosen = [t for t in tenants if only is None or t.name.lower() == only.lower()]
    if not chosen:
        raise ValueError(f"no such tenant: {only}")
    run_id = run_id or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    audit = Audit(run_id, date.fromisoformat(window.day))
    with Staging(spark, run_id) as staging:
        job = _Job(spark, source, chosen, target.rstrip("/"), window, rules, dry_run, renames, max_files, audit, staging, refresh, layout)
        for spec in (s for s in specs if s.is_session):
            job.table(spec)
        others = sorted((s for s in specs if not s.is_session), key=lambda s: not s.is_activity)
        with ThreadPoolExecutor(max_workers=rules.parallel_tables) as pool:  # the driver only submits Spark jobs
            list(pool.map(job.table, others))
        job.master()
        if not dry_run:
            job.append_audit()
    return RunResult(run_id, audit.frame(spark), job.written)


@dataclass
class _Job:
    spark: SparkSession
    source: Source
    tenants: list[Tenant]
    target: str
    window: RunWindow
    rules: Rules
    dry_run: bool
    renames: dict[str, str]
    max_files: int | None
    audit: Audit
    staging: Staging
    refresh: str = "touched"
    layout: Layout = Layout()
    written: dict[str, DataFrame] = field(default_factory=dict)
    sessions: DataFrame | None = None
    blocks: DataFrame | None = None
    lookup: DataFrame | None = None
    lookup_small: bool = False
    entries: tuple[DataFrame, DataFrame | None] | None = None
    session_tenants: list[str] = field(default_factory=list)
    session_ready: list[str] = field(default_factory=list)
    activity: DataFrame | None = None

    def __post_init__(self) -> None:
        last = date.fromisoformat(self.window.next_day)
        if self.rules.inclusive_days:
            last += timedelta(days=1)
        self.days = RunWindow(self.window.day, last.isoformat()).days()
        self.bounds = local_day_bounds(self.window.day, last.isoformat(), self.rules.zone)
        self.by = [TENANT, *self.rules.partition_by]
        self.dated = {"year", "month", "day"} == set(self.rules.partition_by)  # a date is a partition, and the only column to deal by
        self.deal = [TENANT, "date"] if self.dated else self.by
        self.preparing = threading.Lock()
        self.deals: dict[str, Deal] = {}
        self.plain: dict[str, set[str]] = {}
        self.keys = [TENANT, USER]
        self.cut = "date" if self.rules.cut_by_day else None

    # -- one table ---------------------------------------------------------

    def table(self, spec: TableSpec) -> None:
        for t in self.tenants:
            self.audit.open(t.name, spec.target, spec.full_load)
        rows, kept_counts = self._staged(spec)
        if rows is None:
            return
        ready, stage = list(kept_counts), "CLEANSING"
        try:
            slots = self._slots(rows)
            self._plan_deal(rows, spec)
            kept, repeats = self._unique(rows, spec)
            stage = "SESSION_BOUNDARY" if spec.is_session else "SESSION_ENRICHMENT"
            rows = self._sessions(kept, self.deals.get(spec.target)) if spec.is_session else self._enriched(kept, spec)
            stage = "WRITE"
            whole, final = rows.columns, self._final(rows)
            derived = self._derived(rows, spec)

            def finish(df: DataFrame) -> DataFrame:
                return self._final(self._restored(df, derived, whole))

            counts, orphans = self._store(self._narrow(rows.drop(*derived)), finish, spec.target, ready, spec.full_load, slots)
        except Exception as e:  # a failing table must not stop the run
            for name in ready:
                self.audit.fail(name, spec.target, stage, e)
            return
        for name in ready:
            kept_n, repeat_n, out_n = kept_counts[name], repeats.get(name, 0), counts.get(name, 0)
            orphan_n = orphans.get(name, 0)
            self.audit.count(
                name, spec.target, duplicate_mongo_id_dropped=repeat_n, orphans_dropped=orphan_n, final_rows_written=out_n
            )
            if kept_n != repeat_n + orphan_n + out_n:  # each figure is counted on its own
                lost = kept_n - repeat_n - orphan_n - out_n
                self.audit.fail(name, spec.target, "WRITE", f"{lost} of {kept_n} kept rows are neither written nor dropped")
            self.audit.close(name, spec.target, kept_n)
        unwritten = final.filter(~F.col(ORPHAN)) if ORPHAN in final.columns else final
        result = self.written.get(spec.target, unwritten.drop(ORPHAN, SPREAD))
        if spec.is_session:
            self.sessions, self.session_ready = result, ready
        elif spec.is_activity:
            self.activity = result

    def _staged(self, spec: TableSpec) -> tuple[DataFrame | None, dict[str, int]]:
        """Scan, shape and stage the rows to keep of all tenants in one plan; and their number per tenant.

        A tenant that fails drops out.
        """
        frames: dict[str, DataFrame] = {}
        for t in self.tenants:
            try:
                raw = read_table(self.spark, self.source, t, spec)
                frames[t.name] = shape_table(raw, spec, self.rules, None if spec.full_load else self.bounds, self.renames)
            except Unreadable as e:
                self.audit.fail(t.name, spec.target, "READ", e)
            except shape.MissingColumns as e:
                self.audit.fail(t.name, spec.target, "TIMESTAMP", e)
            except NoUser as e:
                self.audit.fail(t.name, spec.target, "SESSION_BOUNDARY", e)
            except Exception as e:  # schema surprises of one tenant
                self.audit.fail(t.name, spec.target, "CLEANSING", e)
        if not frames:
            return None, {}
        self.plain[spec.target] = {
            c for c in EXTRA_TIMES if all(c in df.columns or not {f"{c}_utc", f"{c}_local"} & set(df.columns) for df in frames.values())
        } | ({RESOLVED} if self.rules.resolve_users and all({"user_id", spec.user_col} <= set(df.columns) for df in frames.values()) else set())
        try:
            return self._put(f"{spec.target}-kept", frames, spec)
        except Exception:  # one of the scans failed; find the tenants that can be read
            parts, kept = [], {}
            for i, (name, df) in enumerate(frames.items()):
                try:
                    part, counts = self._put(f"{spec.target}-kept-{i}", {name: df}, spec)
                    parts.append(part)
                    kept |= counts
                except Exception as e:
                    self.audit.fail(name, spec.target, "READ", e)
            return (shape.union_tenants(parts) if parts else None), kept

    def _put(self, name: str, frames: dict[str, DataFrame], spec: TableSpec) -> tuple[DataFrame, dict[str, int]]:
        """Stage the rows without a reason to drop them; the tasks that write them count the others by reason.

        The write has no shuffle, so every row passes through one writing task, and Spark counts
        each of those once.
        """
        seen, rows = {t: Observation() for t in frames}, []
        for tenant, df in frames.items():
            kept = df.observe(seen[tenant], *quality.reason_metrics()).filter(F.col("drop_reason").isNull()).drop("drop_reason")
            # Written to the staged table and read from there on, so every later use sees the same number.
            numbered = kept.withColumns({CONTENT: copies.content_hash(kept), SPREAD: F.monotonically_increasing_id()})
            rows.append(numbered.withColumn(TENANT, F.lit(tenant)))
        whole = shape.fix_void(shape.union_tenants(rows))
        derived = self._derived(whole, spec)
        staged = self._restored(self.staging.put(name, whole.drop(*derived)), derived, whole.columns)
        counts = {}
        for tenant, metrics in seen.items():
            counters = dict(metrics.get)
            counts[tenant] = counters.pop("rows_kept")
            self.audit.count(tenant, spec.target, **counters)
        return staged, counts

    def _derived(self, df: DataFrame, spec: TableSpec) -> dict[str, Column]:
        """Columns that other columns of their row give back exactly, and how: they are neither staged nor shuffled."""
        kinds, zone = {f.name: f.dataType for f in df.schema.fields}, self.rules.zone
        out = {"event_timestamp_local": local_time(F.col(TIME), zone)}
        for c in self.plain[spec.target] - {RESOLVED}:
            if f"{c}_utc" not in kinds:
                continue
            own = c == self.renames.get(spec.time_col, spec.time_col)
            utc = F.col(TIME if own else f"{c}_utc")
            out |= {f"{c}_utc": utc} if own else {}
            out[f"{c}_local"] = local_time(utc, zone)
            if isinstance(kinds[c], (T.TimestampType, T.TimestampNTZType)) and not (own and spec.time_encoding != "time"):
                out[c] = utc.cast(kinds[c])
        return out | ({RESOLVED: F.col(USER)} if RESOLVED in self.plain[spec.target] else {})

    @staticmethod
    def _restored(df: DataFrame, derived: dict[str, Column], whole: list[str]) -> DataFrame:
        """``df`` with its ``derived`` columns, those of ``whole`` in their order there."""
        df = df.withColumns(derived)
        return df.select(*[c for c in whole if c in df.columns], *[c for c in df.columns if c not in whole])

    def _slots(self, rows: DataFrame) -> DataFrame | None:
        """Files per target partition, from the staged rows; some of those are not written, which does no harm."""
        if not self.max_files:
            return None
        dated = rows.select(TENANT, "date")
        dated = shape.add_ymd(dated) if "year" in self.by else dated
        return self.staging.put(f"slots-{uuid.uuid4().hex}", sinks.partition_slots(dated, self.deal, self.max_files))

    def _plan_deal(self, rows: DataFrame, spec: TableSpec) -> None:
        """Slots by which a table's rows are joined and written in one shuffle, unless a bound on the files leaves a slot too many rows."""
        if self.deal != [TENANT, "date"]:
            return
        dated = rows.select(*self.deal)
        if self.max_files:
            wanted = sinks.partition_slots(dated, self.deal, 1 << 30)
            wanted = self.staging.put(f"deal-{uuid.uuid4().hex}", wanted)
            if not wanted.filter(F.col(SLOTS) > self.max_files).isEmpty():
                return
        else:
            wanted = self.staging.put(f"deal-{uuid.uuid4().hex}", sinks.partition_slots(dated, self.deal, 1 << 30, sinks.ROWS_PER_TASK))
        if fits_broadcast(wanted):
            self.deals[spec.target] = Deal(self.deal, wanted, self.rules.zone)

    def _unique(self, kept: DataFrame, spec: TableSpec) -> tuple[DataFrame, dict[str, int]]:
        """Deduplicate by record id: the rows that stay or go are found on narrow columns, and their numbers staged.

        Every later use of the survivors reads that table, so all uses see the same rows, whatever
        the join strategy and arrival order. A few losers are anti-joined; where many ids repeat, bitmaps
        of the survivors are broadcast, so that no row is shuffled for it.
        """
        if not self.rules.deduplicate or ID not in kept.columns:
            return kept.drop(CONTENT), {}
        repeated = self.staging.put(f"{spec.target}-repeated", copies.duplicate_ids(kept, ID, [TENANT]))
        extra = repeated.groupBy(TENANT).agg(F.sum(F.col("copies") - 1).alias("n")).collect()  # one row per tenant
        counts = {r[TENANT]: r["n"] for r in extra}
        if not counts:
            return kept.drop(CONTENT), counts
        narrow = kept.filter(F.col(ID).isNotNull()).select(TENANT, ID, TIME, CONTENT, SPREAD)
        if not fits_broadcast(repeated, max_rows=self.rules.broadcast_rows):
            bits = self.staging.put(f"{spec.target}-first", copies.first_bits(narrow, ID, [TIME, CONTENT], [TENANT], SPREAD))
            if fits_broadcast(bits):
                return copies.keep_first(kept.drop(CONTENT), ID, [TENANT], SPREAD, bits), counts
        gone = copies.losers(narrow, ID, [TIME, CONTENT], [TENANT], SPREAD, repeated)
        gone = self.staging.put(f"{spec.target}-losers", gone)
        if fits_broadcast(gone, max_rows=self.rules.broadcast_rows):
            gone = F.broadcast(gone)
        return kept.drop(CONTENT).join(gone, [TENANT, SPREAD], "left_anti").select(*kept.drop(CONTENT).columns), counts

    # -- sessions and enrichment ------------------------------------------

    def _sessions(self, kept: DataFrame, deal: Deal | None = None) -> DataFrame:
        rules = self.rules
        by = [*self.keys, self.cut] if self.cut else self.keys
        end = "session_end_raw_utc" if "session_end_raw_utc" in kept.columns else None
        blocks = session_blocks(kept, by, TIME, rules.gap_seconds, end, [SPREAD])
        self.blocks = self.staging.put("blocks", blocks.drop("block_last", "block_end", "block_rows"))  # the session's own are staged
        facts = block_facts(self.blocks, self.keys, self.cut, rules.id_style, rules.zone, named=False)
        facts = facts.withColumn(FOUND, F.col("session_start_ts" if rules.id_style == "hash" else "session_seq"))
        grace = None if rules.tail_seconds is not None else rules.grace_seconds
        known = facts.filter(F.col(USER).isNotNull())
        self.lookup = self.staging.put("lookup", session_bounds(known, self.keys, USER, grace, rules.tail_seconds, FOUND))
        per_bucket = bucket_copies("sess_start", "sess_end", self.bounds)
        self.lookup_small = fits_broadcast(self.lookup, per_bucket, rules.broadcast_rows)
        self.session_tenants = [r[0] for r in self.lookup.select(TENANT).distinct().collect()]  # tenants only
        small = fits_broadcast(self.blocks, copies_made(), rules.broadcast_rows)
        return attach_sessions(kept, self.blocks, by, TIME, rules.gap_seconds, [SPREAD], small, deal)

    def _entries(self) -> tuple[DataFrame, DataFrame | None] | None:
        """The lookup as latest-start joins read it, worked out once for all tables."""
        if self.rules.pick != "latest":
            return None
        with self.preparing:
            if self.entries is None:
                self.entries = latest_entries(
                    self.lookup, {TENANT: TENANT, USER: "sess_user"}, "sess_start", "sess_end", [FOUND], self.bounds, self.staging)
        return self.entries

    def _enriched(self, kept: DataFrame, spec: TableSpec) -> DataFrame:
        """Sessions from the lookup; tenants without sessions keep their rows unassigned."""
        if spec.full_load or not self.session_tenants:
            self.deals.pop(spec.target, None)
            return unassigned(kept)
        on = [TENANT, USER]
        hot = None if self.lookup_small else self.staging.put(f"{spec.target}-hot", crowded_events(kept, on, TIME))
        rows = interval_join(
            without_session(kept), self.lookup, {TENANT: TENANT, USER: "sess_user"}, TIME, "sess_start", "sess_end", [FOUND],
            pick=self.rules.pick, within=self.bounds, salt_by=[SPREAD], small=self.lookup_small, stage=self.staging,
            entries=self._entries(), hot=hot, deal=self.deals.get(spec.target),
        )
        rows = rows.withColumn(JOINED, F.col(ENRICH) & F.col(TENANT).isin(self.session_tenants))
        if spec.needs_session and self.rules.quality:
            rows = rows.withColumn(ORPHAN, F.col(FOUND).isNull() & F.col(JOINED))
        return rows

    def _named(self, rows: DataFrame) -> DataFrame:
        """The session columns of rows that carry what their ids are made of."""
        rules = self.rules
        if "_seq" in rows.columns:
            rows = name_sessions(rows, USER, rules.id_style, rules.zone)
            return rows if rules.default_duration is None else row_duration(rows, TIME, default_tail=rules.default_duration)
        if FOUND not in rows.columns:
            return rows
        who, found = F.col(USER), F.col(FOUND)
        of = local_time(found, rules.zone) if rules.id_style == "hash" else found
        name = F.when(found.isNotNull(), session_id_of(who, rules.id_style, of))
        if rules.label_unassigned:
            name = F.coalesce(name, F.concat(who, F.lit("_"), F.col("date").cast("string"), F.lit("_unassigned")))
        orphan = [ORPHAN] if ORPHAN in rows.columns else []
        return rows.select(
            *[c for c in rows.columns if c not in (FOUND, JOINED, ORPHAN)], F.when(F.col(JOINED), name).alias("session_id"),
            found.isNotNull().alias("is_session_assigned"), *orphan)

    # -- sinks -------------------------------------------------------------

    def _narrow(self, rows: DataFrame) -> DataFrame:
        """What a row needs to be dealt out and finished."""
        rows = rows.drop(ENRICH, CONTENT, *([] if self.max_files else [SPREAD]))
        return rows if self.dated or "year" not in self.by else shape.add_ymd(rows)

    def _final(self, rows: DataFrame) -> DataFrame:
        """The target's columns: row-local, so they are made after the last shuffle."""
        rows = self._named(rows).drop(USER, ENRICH, CONTENT, *([] if self.max_files else [SPREAD]))
        final = shape.finalize_times(rows, EXTRA_TIMES)
        final = shape.fix_void(shape.enforce_schema(final, CASTS) if self.rules.enforce_types else final)
        return shape.add_ymd(final) if "year" in self.by else final

    def _stored(self, schema: T.StructType, name: str) -> DataFrame:
        """All written rows of this run's tenants."""
        if not self.layout.tenant_first:
            stored = self.spark.read.schema(schema).parquet(f"{self.target}/{name}")
            return stored.filter(F.col(TENANT).isin([t.name for t in self.tenants]))
        own = T.StructType([f for f in schema.fields if f.name != TENANT])
        parts = [
            self.spark.read.schema(own).parquet(self.layout.root(self.target, name, t.name)).withColumn(TENANT, F.lit(t.name))
            for t in self.tenants
        ]
        return shape.union_tenants(parts).select(*schema.fieldNames())

    def _read_back(self, schema: T.StructType, name: str) -> DataFrame:
        """The written rows of this run's tenants and days, by partition pruning."""
        day = F.col("date") if "date" in self.by else F.make_date(
            F.col("year"), F.col("month").try_cast("int"), F.col("day").try_cast("int")
        )
        return self._stored(schema, name).filter(day.between(F.lit(self.days[0]), F.lit(self.days[-1])))

    def _store(
        self, rows: DataFrame, finish: Callable[[DataFrame], DataFrame], name: str, ready: list[str], full_load: bool = False,
        slots: DataFrame | None = None,
    ) -> tuple[dict[str, int], dict[str, int]]:
        """Write ``finish(rows)`` but for its orphans; the rows written and the orphans, per tenant.

        Emptied days of the window are cleared.
        """
        if self.dry_run:
            orphan = F.col(ORPHAN) if ORPHAN in rows.columns else F.lit(False)
            found = rows.groupBy(TENANT).agg(F.count_if(~orphan).alias("written"), F.count_if(orphan).alias("orphans")).collect()
            return tuple({r[TENANT]: r[c] for r in found} for c in ("written", "orphans"))
        touched, orphans = self._write(rows, finish, name, slots)
        schema = finish(rows).drop(ORPHAN, SPREAD).schema
        if full_load:
            self.written[name] = self._stored(schema, name)
            return self._per_tenant(self.written[name]), {}
        counts: dict[str, int] = {}
        emptied: dict[str, list[dict[str, str]]] = {}
        for row in self._read_back(schema, name).groupBy(*self.by).count().collect():  # one row per tenant and day
            part = tuple(row[c] for c in self.by)
            if part in touched:
                counts[part[0]] = counts.get(part[0], 0) + row["count"]
            elif part[0] in ready:
                emptied.setdefault(part[0], []).append({c: str(v) for c, v in zip(self.by, part)})
        for tenant, parts in emptied.items():
            if self.layout.tenant_first:
                parts = [{c: v for c, v in p.items() if c != TENANT} for p in parts]
            sinks.clear_partitions(self.spark, self.layout.root(self.target, name, tenant), parts)
        self.written[name] = self._read_back(schema, name)
        return counts, orphans

    def _write(
        self, rows: DataFrame, finish: Callable[[DataFrame], DataFrame], name: str, slots: DataFrame | None
    ) -> tuple[set[tuple], dict[str, int]]:
        """Write all tenants; the partitions that got rows, at most one per tenant and day, and the orphans per tenant."""
        if not self.layout.tenant_first:
            return self._write_part(rows, finish, f"{self.target}/{name}", self.by, slots, is_dealt=name in self.deals)
        if len(self.tenants) > 1:  # worked out once, then written tenant by tenant
            rows = self.staging.put(f"{name}-final", rows)
        touched, orphans = set(), {}
        for t in self.tenants:
            mine = None if slots is None else slots.filter(F.col(TENANT) == t.name).drop(TENANT)
            root = self.layout.root(self.target, name, t.name)
            parts, lost = self._write_part(rows.filter(F.col(TENANT) == t.name).drop(TENANT), finish, root, self.by[1:], mine, t.name, name in self.deals and len(self.tenants) == 1)
            touched |= {(t.name, *p) for p in parts}
            orphans |= lost
        return touched, orphans

    def _write_part(
        self, rows: DataFrame, finish: Callable[[DataFrame], DataFrame], path: str, by: list[str], slots: DataFrame | None,
        tenant: str | None = None, is_dealt: bool = False,
    ) -> tuple[set[tuple], dict[str, int]]:
        """Write one dataset: of one ``tenant``, or of all as its first partition column."""
        orphan = F.col(ORPHAN) if ORPHAN in rows.columns else F.lit(False)
        seen = Observation()
        of = {f"orphans_{i}": t.name for i, t in enumerate(self.tenants) if tenant in (None, t.name)}  # one figure per tenant
        mine = (lambda t: F.lit(True)) if tenant else (lambda t: F.col(TENANT) == t)
        metrics = [F.collect_set(F.when(~orphan, F.struct(*by))).alias("partitions"),
                   *[F.count_if(orphan & mine(t)).alias(c) for c, t in of.items()]]
        with_orphans = ORPHAN in rows.columns
        sinks.write_partitions(
            rows, path, by, self.refresh, self.max_files, slots, [SPREAD] if self.max_files and SPREAD in rows.columns else None,
            (seen, metrics), ~orphan if with_orphans else None, (ORPHAN,) if with_orphans else (),
            deal_by=[c for c in self.deal if c in rows.columns], finish=finish, is_dealt=is_dealt)
        found = seen.get
        return {tuple(p) for p in found["partitions"]}, {t: found[c] for c, t in of.items()}

    @staticmethod
    def _per_tenant(df: DataFrame) -> dict[str, int]:
        return {r[TENANT]: r["count"] for r in df.groupBy(TENANT).count().collect()}

    def append_audit(self) -> None:
        rows = self.audit.frame(self.spark)
        if not self.layout.tenant_first:
            return sinks.append_audit(rows, f"{self.target}/{AUDIT_TABLE}")
        for t in self.tenants:
            sinks.append_audit(rows.filter(F.col("client_name") == t.name), self.layout.root(self.target, AUDIT_TABLE, t.name))

    def _facts_named(self, facts: DataFrame) -> DataFrame:
        start = local_time(F.col("session_start_ts"), self.rules.zone)
        return session_names(facts.withColumn("_start", start), USER, self.rules.id_style, "_start", "session_seq").drop("_start")

    def _master_finished(self, facts: DataFrame) -> DataFrame:
        facts = self._facts_named(facts).drop("session_seq").withColumnRenamed(USER, self.rules.master_user)
        first = [] if self.activity is None else [c for c in (TENANT, "session_id") if c in facts.columns]
        facts = facts.select(*first, *[c for c in facts.columns if c not in first])
        return self._master_typed(session_master(facts, zone=self.rules.zone))

    def _master_typed(self, master: DataFrame) -> DataFrame:
        master = shape.enforce_schema(master, CASTS)
        return shape.add_ymd(master) if "year" in self.by else master

    def _master_slots(self) -> DataFrame | None:
        """Files per partition of the facts: every session has one block that opens it."""
        if not self.cut or self.rules.master_user != "resolved_user_id":
            return None
        return self._slots(self.blocks.filter(F.col("block_first") == F.col("session_start")))

    def master(self) -> None:
        """Session facts with activity counts, from the staged blocks."""
        if not self.rules.build_master or self.blocks is None or self.sessions is None:
            return
        name = self.rules.master_user
        try:
            if name == "resolved_user_id":
                facts = block_facts(self.blocks, self.keys, self.cut, self.rules.id_style, self.rules.zone, named=False)
                facts = facts.drop("session_last_ts", *(["session_seq"] if self.rules.id_style == "hash" else []))
                if self.activity is not None:  # a hashed id is a key of 32 bytes, and null for rows without a session
                    key = F.unhex if self.rules.id_style == "hash" else lambda c: c
                    found = self.activity.withColumn(_KEY, key(F.col("session_id"))).filter(F.col(_KEY).isNotNull())
                    keyed = self._facts_named(facts).select(*facts.columns, key(F.col("session_id")).alias(_KEY))
                    counts = activity_counts(found, [TENANT, _KEY])
                    facts = keyed.join(counts, [TENANT, _KEY], "left").drop(_KEY)
                rows, finish = facts, self._master_finished
            else:  # from the written rows, whose times are the wall clock
                facts = session_rollup(self.sessions, [TENANT, "session_id", "session_label", name, "date"])
                rows = session_master(facts, self.activity, [TENANT, "session_id"])
                finish = self._master_typed
            if not self.dated and "year" in self.by:
                rows = shape.add_ymd(rows)
            self._store(rows, finish, MASTER, self.session_ready, slots=self._master_slots())
        except Exception as e:  # the other tables go on, and the audit names the missing facts
            log.exception("session master failed")
            for t in self.tenants:
                self.audit.open(t.name, MASTER, False)
                self.audit.fail(t.name, MASTER, "SESSION_MASTER", e)

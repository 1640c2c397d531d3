"""SQL equivalents of the check queries, for DuckDB."""

from __future__ import annotations

from sessionloom.functions.identity import BOT_WORDS

BOTS = "[" + ", ".join(f"'{w}'" for w in (*BOT_WORDS, "Firefox/121.0", "Safari/605")) + "]"

LOCAL = """
ev AS (
  SELECT *, ts + INTERVAL 330 MINUTE AS t, CAST(ts + INTERVAL 330 MINUTE AS DATE) AS date FROM events)"""

RAW = """
raw AS (
  SELECT event_id, user_id AS uid, CAST(event_id AS VARCHAR) AS _id,
         CASE event_id % 29 WHEN 0 THEN NULL WHEN 1 THEN ' Unknown ' WHEN 2 THEN 'NULL' WHEN 3 THEN '  '
              ELSE 'fp_' || CAST(user_id AS VARCHAR) END AS fingerprint,
         CASE WHEN event_id % 3 = 0 THEN 'u_' || CAST(user_id AS VARCHAR)
              WHEN event_id % 3 = 1 THEN 'null' ELSE NULL END AS user_id,
         ts AS created_at,
         ts + (event_id % 5) * INTERVAL '2' HOUR AS session_end_raw,
         CASE WHEN event_id % 23 = 0 THEN NULL
              WHEN event_id % 17 = 0 THEN 'Mozilla/5.0 (compatible; GoogleBot/2.1)'
              WHEN event_id % 19 = 0 THEN 'curl/8.0' ELSE 'Mozilla/5.0 (X11; Linux)' END AS user_agent,
         CASE event_type WHEN 'view' THEN 'scroll' ELSE event_type END AS activity,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE '/p/' || CAST(event_id % 11 AS VARCHAR) END AS page
  FROM events)"""

CLICKS = RAW + """,
r AS (
  SELECT *, 'tenant_' || CAST(uid % 3 AS VARCHAR) AS tenant,
         created_at + INTERVAL 330 MINUTE AS t, CAST(created_at + INTERVAL 330 MINUTE AS DATE) AS date,
         COALESCE(CASE WHEN lower(trim(user_id)) NOT IN ('unknown', 'null', '') THEN user_id END, fingerprint) AS x
  FROM raw),
tagged AS (
  SELECT *, CASE WHEN user_agent IS NULL THEN 'null_user_agent'
                 WHEN regexp_matches(user_agent, 'bot|curl', 'i') THEN 'bot'
                 WHEN x IS NULL OR lower(trim(x)) IN ('unknown', 'null', '') THEN 'invalid_identity' END AS reason
  FROM r),
known AS (SELECT * FROM r WHERE x IS NOT NULL AND lower(trim(x)) NOT IN ('unknown', 'null', '')),
kept AS (SELECT * FROM tagged WHERE reason IS NULL)"""

SESSIONS = CLICKS + """,
g AS (
  SELECT *, CASE WHEN lag(t) OVER w IS NULL OR floor(epoch(t)) - floor(epoch(lag(t) OVER w)) > 1800
                 THEN 1 ELSE 0 END AS opens
  FROM kept WINDOW w AS (PARTITION BY x, date ORDER BY t, _id)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY x, date ORDER BY t, _id) AS seq FROM g),
m AS (
  SELECT tenant, x, date, seq, min(t) AS st, max(t) AS last_t, count(*) AS n,
         greatest(max(t), max(session_end_raw + INTERVAL 330 MINUTE)) AS en
  FROM s GROUP BY tenant, x, date, seq),
sess AS (
  SELECT *, sha256(x || '||' || CAST(st AS VARCHAR)) AS session_id, x || '__' || CAST(st AS VARCHAR) AS session_label
  FROM m)"""

ENRICHED = SESSIONS + """,
hits AS (
  SELECT k._id, max_by(sess.session_id, sess.st) AS hit, max(sess.st) AS hit_start
  FROM known k JOIN sess ON k.x = sess.x
   AND k.t BETWEEN sess.st - INTERVAL 60 SECOND AND sess.en + INTERVAL 60 SECOND
  GROUP BY k._id),
child AS (SELECT k.*, h.hit, h.hit_start FROM known k LEFT JOIN hits h ON k._id = h._id)"""

MASTER = ENRICHED + """,
act AS (
  SELECT hit AS session_id, count(*) FILTER (activity = 'scroll') AS scroll_count,
         count(*) FILTER (activity = 'click') AS click_count, count(DISTINCT page) AS unique_pages
  FROM child WHERE hit IS NOT NULL GROUP BY hit),
facts AS (
  SELECT sess.*, round(epoch(en) - epoch(st), 4) AS dur, coalesce(scroll_count, 0) AS sc,
         coalesce(click_count, 0) AS cc, coalesce(unique_pages, 0) AS up
  FROM sess LEFT JOIN act USING (session_id)),
master AS (
  SELECT *, dur < 10 AND sc = 0 AND cc = 0 AND up <= 1 AS is_bounce,
         dur >= 10 AND (sc > 0 OR cc > 0 OR up > 1) AS is_engaged
  FROM facts)"""

MASTER_COLUMNS = """
  session_id, session_label, x AS resolved_user_id, date, st AS session_start_ts, en AS session_end_ts,
  n AS event_count, dur AS session_duration, sc AS scroll_count, cc AS click_count, up AS unique_pages,
  is_bounce, is_engaged, CAST(year(date) AS INTEGER) AS year, strftime(date, '%m') AS month, strftime(date, '%d') AS day"""

UNCUT = LOCAL + """,
g AS (
  SELECT *, CASE WHEN lag(t) OVER w IS NULL OR floor(epoch(t)) - floor(epoch(lag(t) OVER w)) > {gap}
                 THEN 1 ELSE 0 END AS opens
  FROM ev WINDOW w AS (PARTITION BY {keys} ORDER BY t, event_id)),
s AS (
  SELECT *, CAST(sum(opens) OVER (PARTITION BY {keys} ORDER BY t, event_id) AS BIGINT) AS seq FROM g)"""

SEQUENCE = UNCUT.format(gap=21600, keys="user_id") + """,
b AS (
  SELECT user_id, CAST(user_id AS VARCHAR) || '_' || CAST(seq AS VARCHAR) AS session_id, min(t) AS sess_start,
         date_trunc('second', max(t)) + INTERVAL 21600 SECOND AS sess_end
  FROM s GROUP BY user_id, seq)"""

# Counters of a whole run, one row per tenant and table.
AUDIT = ENRICHED + """,
per AS (
  SELECT tenant, count(*) AS total, count(*) FILTER (reason = 'null_user_agent') AS ua,
         count(*) FILTER (reason = 'bot') AS bots, count(*) FILTER (reason = 'invalid_identity') AS ident,
         count(*) FILTER (reason IS NULL) AS kept,
         count(*) FILTER (x IS NULL OR lower(trim(x)) IN ('unknown', 'null', '')) AS bad
  FROM tagged GROUP BY tenant),
kid AS (
  SELECT tenant, count(*) AS known, count(*) FILTER (hit IS NULL) AS orphans,
         count(*) FILTER (event_id % 13 = 0) AS no_id,
         count(*) FILTER (event_id % 13 = 0 AND hit IS NULL) AS no_id_orphans
  FROM child GROUP BY tenant),
base AS (SELECT * FROM per JOIN kid USING (tenant)),
audit AS (
  SELECT tenant, 'user_sessions_v2' AS tab, total AS rows_read, ua, bots, ident, 0 AS orph, kept AS written, 0 AS dup FROM base
  UNION ALL SELECT tenant, 'activity_logs_v2', total, 0, 0, bad, orphans, known - orphans, 0 FROM base
  UNION ALL SELECT tenant, 'nudge_recommendations_v2', total, 0, 0, bad, orphans, known - orphans, 0 FROM base
  UNION ALL SELECT tenant, 'nudge_responses_v2', 2 * total, 0, 0, 2 * bad, orphans + no_id_orphans,
                   (known - orphans) + (no_id - no_id_orphans), known - no_id FROM base
  UNION ALL SELECT tenant, 'fingerprint_v2', total, ua, bots, ident, 0, kept, 0 FROM base)"""

AUDIT_COLUMNS = """
  tenant AS client_name, tab AS source_table, 'SUCCESS' AS status, (SELECT CAST(min(ts) AS DATE) - 1 FROM events) AS run_date, false AS is_full_load,
  CAST(rows_read AS BIGINT) AS rows_read_raw, CAST(ua AS BIGINT) AS null_user_agent_dropped,
  CAST(bots AS BIGINT) AS bots_dropped, CAST(ident AS BIGINT) AS invalid_identity_dropped,
  CAST(0 AS BIGINT) AS mongo_filter_leak_dropped, CAST(orph AS BIGINT) AS orphans_dropped,
  CAST(written AS BIGINT) AS final_rows_written, CAST(0 AS BIGINT) AS null_timestamp_dropped,
  CAST(dup AS BIGINT) AS duplicate_mongo_id_dropped"""

IN_LOCAL_WINDOW = "ts >= TIMESTAMP '2024-01-04 18:30:00' AND ts < TIMESTAMP '2024-01-19 18:30:00'"

TAGGED_COUNTS = """
tt AS (
  SELECT *, CASE WHEN reason IS NOT NULL THEN reason
                 WHEN created_at < TIMESTAMP '2024-01-02 18:30:00' OR created_at >= TIMESTAMP '2024-01-24 18:30:00'
                 THEN 'outside_window' END AS why
  FROM tagged),
counts AS (
  SELECT tenant, count(*) AS rows_read_raw, count(*) FILTER (why = 'null_user_agent') AS null_user_agent_dropped,
         count(*) FILTER (why = 'bot') AS bots_dropped, count(*) FILTER (why = 'invalid_identity') AS invalid_identity_dropped,
         CAST(0 AS BIGINT) AS null_timestamp_dropped, count(*) FILTER (why = 'outside_window') AS mongo_filter_leak_dropped,
         count(*) FILTER (why IS NULL) AS rows_kept
  FROM tt GROUP BY tenant)"""

ORACLES: dict[str, str] = {
    "previous_times": f"""WITH {LOCAL}
SELECT event_id, lag(t) OVER (PARTITION BY user_id, date ORDER BY t, event_id) AS prev_ts FROM ev""",
    "gap_flags": f"""WITH {UNCUT.format(gap=1800, keys='user_id, date')}
SELECT event_id, opens AS is_new_session FROM g""",
    "session_sequence": f"""WITH {UNCUT.format(gap=21600, keys='user_id')}
SELECT event_id, seq AS session_seq, CAST(user_id AS VARCHAR) || '_' || CAST(seq AS VARCHAR) AS session_id FROM s""",
    "session_hash_ids": f"""WITH {SESSIONS}
SELECT s._id, sess.session_id, sess.session_label, true AS is_session_assigned
FROM s JOIN sess ON s.x = sess.x AND s.date = sess.date AND s.seq = sess.seq""",
    "session_end_times": f"""WITH {SESSIONS}
SELECT s._id, sess.en AS session_end
FROM s JOIN sess ON s.x = sess.x AND s.date = sess.date AND s.seq = sess.seq""",
    "long_day_sessions": f"""WITH {UNCUT.format(gap=21600, keys='user_id, date')}
SELECT sha256(CAST(user_id AS VARCHAR) || '||' || CAST(min(t) AS VARCHAR)) AS session_id, user_id, date,
       min(t) AS session_start_ts, max(t) AS session_end_ts, count(*) AS event_count
FROM s GROUP BY user_id, date, seq""",
    "session_bounds_tail": f"""WITH {SEQUENCE}
SELECT user_id AS sess_user, session_id, sess_start, sess_end FROM b""",
    "session_bounds_grace": f"""WITH {SESSIONS}
SELECT x AS sess_user, session_id, st - INTERVAL 60 SECOND AS sess_start, en + INTERVAL 60 SECOND AS sess_end FROM sess""",
    "row_durations": """SELECT event_id, CAST(300 AS BIGINT) AS open_seconds,
       CAST(floor(epoch(ts + INTERVAL 90 SECOND)) - floor(epoch(ts)) AS BIGINT) AS given_seconds FROM events""",
    "identity_resolved": f"""WITH {CLICKS}
SELECT _id, x AS resolved_user_id, x IS NOT NULL AND lower(trim(x)) NOT IN ('unknown', 'null', '') AS is_valid FROM r""",
    "quality_counts": f"""WITH {CLICKS}
SELECT 'all' AS tenant, count(*) AS rows_read_raw, count(*) FILTER (reason = 'null_user_agent') AS null_user_agent_dropped,
       count(*) FILTER (reason = 'bot') AS bots_dropped, count(*) FILTER (reason = 'invalid_identity') AS invalid_identity_dropped,
       count(*) FILTER (reason IS NULL) AS rows_kept FROM tagged""",
    "quality_kept": f"WITH {CLICKS} SELECT _id, x, t, date FROM kept",
    "audit_by_tenant": f"WITH {CLICKS}, {TAGGED_COUNTS} SELECT * FROM counts",
    "local_day_window": f"WITH {LOCAL} SELECT event_id, t AS event_timestamp, date FROM ev WHERE {IN_LOCAL_WINDOW}",
    "day_range": """SELECT event_id, CAST(ts AS DATE) AS date FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    "epoch_ms_window": f"SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events WHERE {IN_LOCAL_WINDOW}",
    "bad_times_dropped": """WITH x AS (
  SELECT event_id, event_type AS kind,
         CASE WHEN event_id % 7 = 0 THEN 'not a time' WHEN event_id % 11 <> 0 THEN CAST(ts AS VARCHAR) END AS txt FROM events)
SELECT event_id, kind, TRY_CAST(txt AS TIMESTAMP) + INTERVAL 330 MINUTE AS event_timestamp
FROM x WHERE TRY_CAST(txt AS TIMESTAMP) IS NOT NULL""",
    "local_times": f"""WITH {RAW}
SELECT _id, created_at + INTERVAL 330 MINUTE AS created_at, session_end_raw + INTERVAL 330 MINUTE AS session_end_raw,
       created_at + INTERVAL 330 MINUTE AS event_timestamp, CAST(created_at + INTERVAL 330 MINUTE AS DATE) AS date FROM raw""",
    "interval_left_all": f"""WITH {SEQUENCE}
SELECT ev.event_id, b.session_id FROM ev LEFT JOIN b
ON ev.user_id = b.user_id AND ev.t >= b.sess_start AND ev.t <= b.sess_end""",
    "interval_overlaps": f"""WITH {SESSIONS}
SELECT k._id, sess.session_id FROM known k LEFT JOIN sess ON k.x = sess.x
AND k.t BETWEEN sess.st - INTERVAL 60 SECOND AND sess.en + INTERVAL 60 SECOND""",
    "interval_latest": f"WITH {ENRICHED} SELECT _id, hit AS session_id, hit_start AS session_start_ts FROM child",
    "assigned_or_not": f"""WITH {ENRICHED}
SELECT _id, coalesce(hit, x || '_' || CAST(date AS VARCHAR) || '_unassigned') AS session_id,
       hit IS NOT NULL AS is_session_assigned FROM child""",
    "orphans_dropped": f"WITH {ENRICHED} SELECT _id, hit AS session_id FROM child WHERE hit IS NOT NULL",
    "unassigned_shape": f"""WITH {CLICKS}
SELECT _id, CAST(NULL AS VARCHAR) AS session_id, false AS is_session_assigned FROM known""",
    "activity_counts": f"WITH {MASTER} SELECT * FROM act",
    "session_master": f"WITH {MASTER} SELECT {MASTER_COLUMNS} FROM master",
    "session_master_quiet": f"""WITH {SESSIONS}, d AS (SELECT session_id, round(epoch(en) - epoch(st), 4) AS dur FROM sess)
SELECT session_id, dur AS session_duration, CAST(0 AS BIGINT) AS scroll_count, CAST(0 AS BIGINT) AS click_count,
       CAST(0 AS BIGINT) AS unique_pages, dur < 10 AS is_bounce, false AS is_engaged FROM d""",
    "bounce_engaged": f"""WITH {MASTER}
SELECT is_bounce, is_engaged, count(*) AS sessions FROM master GROUP BY is_bounce, is_engaged""",
    "dedup_keep_nulls": """WITH d AS (
  SELECT CASE WHEN event_id % 5 <> 0 THEN CAST(event_id // 3 AS VARCHAR) END AS mongo_id, event_id, ts, user_id FROM events)
SELECT mongo_id, event_id, ts, user_id FROM (
  SELECT *, row_number() OVER (PARTITION BY mongo_id ORDER BY ts, event_id) AS k FROM d)
WHERE k = 1 OR mongo_id IS NULL""",
    "json_stringified": """SELECT event_id,
       CAST(to_json({'event_id': event_id, 'event_type': event_type}) AS VARCHAR) AS details,
       CAST(to_json([{'user_id': user_id}, {'user_id': user_id}]) AS VARCHAR) AS qa_pairs, event_type AS user_agent FROM events""",
    "flattened_body": "SELECT event_id, user_id, event_type FROM events",
    "renamed_cast": """SELECT CAST(event_id AS VARCHAR) AS mongo_id, ts AS created_at, CAST(user_id AS VARCHAR) AS fingerprint,
       CASE WHEN event_id % 4 <> 0 THEN true END AS is_bounce,
       CASE WHEN event_id % 4 <> 0 THEN CAST(1.5 AS DOUBLE) END AS session_duration FROM events""",
    "void_fixed": "SELECT event_id, CAST(NULL AS VARCHAR) AS nothing FROM events",
    "ensured_columns": """SELECT event_id, event_type AS activity, CAST(NULL AS VARCHAR) AS page, CAST(NULL AS DOUBLE) AS weight
FROM events""",
    "tenants_united": """SELECT 'a' AS tenant, event_id, CAST(user_id AS VARCHAR) AS who, event_type, CAST(NULL AS DOUBLE) AS value FROM events
UNION ALL SELECT 'b', event_id, 'u' || CAST(user_id AS VARCHAR), NULL, value FROM events""",
    "ymd_partitions": f"""WITH {LOCAL}
SELECT event_id, date, CAST(year(date) AS INTEGER) AS year, lpad(CAST(month(date) AS VARCHAR), 2, '0') AS month,
       lpad(CAST(day(date) AS VARCHAR), 2, '0') AS day FROM ev""",
    "overwrite_one_day": f"""WITH {LOCAL}
SELECT CAST(year(date) AS INTEGER) AS year, strftime(date, '%m') AS month, strftime(date, '%d') AS day,
       count(*) AS rows, CAST(sum(user_id) AS BIGINT) AS user_sum
FROM ev WHERE date <> DATE '2024-01-10' OR user_id <> 1 GROUP BY date""",
    "full_refresh": f"""WITH {LOCAL}
SELECT CAST(year(date) AS INTEGER) AS year, strftime(date, '%m') AS month, strftime(date, '%d') AS day,
       count(*) AS rows, CAST(sum(user_id) AS BIGINT) AS user_sum
FROM ev WHERE date = DATE '2024-01-10' AND user_id <> 1 GROUP BY date""",
    "append_audit": f"""WITH {CLICKS}, {TAGGED_COUNTS}
SELECT tenant AS client_name, DATE '2024-01-03' AS run_date, CAST(2024 AS INTEGER) AS year, '01' AS month, '03' AS day,
       CAST(2 AS BIGINT) AS audit_rows, CAST(2 * rows_read_raw AS BIGINT) AS rows_read_raw,
       CAST(2 * bots_dropped AS BIGINT) AS bots_dropped FROM counts""",
    "multi_tenant_sessions": f"""WITH {SESSIONS}
SELECT tenant, count(*) AS sessions, CAST(sum(n) AS BIGINT) AS events, min(st) AS first_start, max(en) AS last_end
FROM sess GROUP BY tenant""",
    "tenant_run": f"WITH {AUDIT} SELECT {AUDIT_COLUMNS} FROM audit",
    "dry_run": f"WITH {AUDIT} SELECT {AUDIT_COLUMNS} FROM audit",
    "one_tenant_run": f"WITH {AUDIT} SELECT {AUDIT_COLUMNS} FROM audit WHERE tenant = 'tenant_1'",
    "tenant_run_master": f"WITH {MASTER} SELECT tenant, {MASTER_COLUMNS} FROM master",
    "tenant_run_activity": f"""WITH {ENRICHED}
SELECT tenant, CASE WHEN event_id % 13 <> 0 THEN _id END AS mongo_id, t AS event_timestamp, date, hit AS session_id,
       true AS is_session_assigned, '{{"timestamp":"' || strftime(created_at, '%Y-%m-%dT%H:%M:%S.%g') || 'Z","kind":"' || activity || '"}}' AS details,
       CAST(year(date) AS INTEGER) AS year, strftime(date, '%m') AS month, strftime(date, '%d') AS day
FROM child WHERE hit IS NOT NULL""",
    "every_bot_word": f"""WITH a AS (
  SELECT event_id, {BOTS}[1 + event_id % {len(BOT_WORDS) + 2}] AS word FROM events),
b AS (
  SELECT event_id, 'Mozilla/5.0 (' || CASE event_id % 3 WHEN 0 THEN upper(word) WHEN 1 THEN upper(word[1]) || lower(word[2:]) ELSE word END || ')' AS agent
  FROM a)
SELECT event_id, agent, CASE WHEN len(list_filter({BOTS}[:{len(BOT_WORDS)}], lambda w: contains(lower(agent), w))) > 0 THEN 'bot' ELSE 'none' END AS reason
FROM b""",
    "bounded_files": f"""WITH {LOCAL}
SELECT CAST(year(date) AS INTEGER) AS year, strftime(date, '%m') AS month, strftime(date, '%d') AS day, count(*) AS rows, true AS bounded
FROM ev GROUP BY date""",
    "forced_text": "SELECT event_id, CAST(user_id AS VARCHAR) AS who FROM events",
    "duplicate_run": f"""WITH {SESSIONS}
SELECT m.b AS broadcast_rows, s.tenant, _id AS mongo_id, session_id, session_label, en AS session_end
FROM s JOIN sess USING (tenant, x, date, seq), (VALUES (0), (500000)) AS m(b)""",
    "bad_times_run": f"""WITH {CLICKS},
timed AS (
  SELECT *, CASE WHEN reason IS NOT NULL THEN reason WHEN event_id % 31 = 0 THEN 'null_time' WHEN event_id % 37 = 0 THEN 'leak' END AS why
  FROM tagged)
SELECT tenant AS client_name, 'user_sessions_v2' AS source_table, 'SUCCESS' AS status,
       (SELECT CAST(min(ts) AS DATE) - 1 FROM events) AS run_date, false AS is_full_load, count(*) AS rows_read_raw,
       count(*) FILTER (why = 'null_user_agent') AS null_user_agent_dropped, count(*) FILTER (why = 'bot') AS bots_dropped,
       count(*) FILTER (why = 'invalid_identity') AS invalid_identity_dropped, count(*) FILTER (why = 'leak') AS mongo_filter_leak_dropped,
       CAST(0 AS BIGINT) AS orphans_dropped, count(*) FILTER (why IS NULL) AS final_rows_written,
       count(*) FILTER (why = 'null_time') AS null_timestamp_dropped, CAST(0 AS BIGINT) AS duplicate_mongo_id_dropped
FROM timed GROUP BY tenant""",
    "faulty_tenant_run": f"""WITH {CLICKS}
SELECT tenant AS client_name, 'user_sessions_v2' AS source_table, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS stage_failed,
       count(*) AS final_rows_written FROM kept GROUP BY tenant
UNION ALL VALUES ('untimed', 'user_sessions_v2', 'FAILED', 'TIMESTAMP', 0), ('empty', 'user_sessions_v2', 'EMPTY', NULL, 0),
  ('missing', 'user_sessions_v2', 'FAILED', 'READ', 0)""",
    "master_by_fingerprint": f"""WITH {SESSIONS}
SELECT s.tenant, session_id, fingerprint, s.date, min(t) AS session_start_ts, max(en) AS session_end_ts, count(*) AS event_count,
       CAST(0 AS BIGINT) AS scroll_count
FROM s JOIN sess USING (tenant, x, date, seq) GROUP BY s.tenant, session_id, fingerprint, s.date""",
    "full_load_run": f"""WITH {RAW}
SELECT 'tenant_' || CAST(uid % 3 AS VARCHAR) AS client_name, 'nudge_responses_v2' AS source_table, 'SUCCESS' AS status,
       (SELECT CAST(min(ts) AS DATE) - 1 FROM events) AS run_date, true AS is_full_load, 2 * count(*) AS rows_read_raw, CAST(0 AS BIGINT) AS null_user_agent_dropped,
       CAST(0 AS BIGINT) AS bots_dropped, 2 * count(*) FILTER (bad) AS invalid_identity_dropped,
       CAST(0 AS BIGINT) AS mongo_filter_leak_dropped, CAST(0 AS BIGINT) AS orphans_dropped,
       2 * count(*) FILTER (NOT bad) - count(*) FILTER (NOT bad AND event_id % 13 <> 0) AS final_rows_written,
       CAST(0 AS BIGINT) AS null_timestamp_dropped, count(*) FILTER (NOT bad AND event_id % 13 <> 0) AS duplicate_mongo_id_dropped
FROM (SELECT *, NOT coalesce(lower(trim(user_id)) NOT IN ('unknown', 'null', ''), false)
             AND NOT coalesce(lower(trim(fingerprint)) NOT IN ('unknown', 'null', ''), false) AS bad FROM raw)
GROUP BY uid % 3""",
    "sequence_run": f"""WITH {RAW},
g AS (
  SELECT *, CASE WHEN lag(created_at) OVER w IS NULL OR floor(epoch(created_at)) - floor(epoch(lag(created_at) OVER w)) > 1800
                 THEN 1 ELSE 0 END AS opens
  FROM raw WHERE fingerprint IS NOT NULL WINDOW w AS (PARTITION BY uid % 3, fingerprint ORDER BY created_at, _id)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY uid % 3, fingerprint ORDER BY created_at, _id) AS seq FROM g),
b AS (
  SELECT uid % 3 AS k, fingerprint, fingerprint || '_' || CAST(seq AS VARCHAR) AS session_id, min(created_at) AS st,
         date_trunc('second', max(created_at)) + INTERVAL 1800 SECOND AS en
  FROM s GROUP BY uid % 3, fingerprint, seq)
SELECT 'tenant_' || CAST(uid % 3 AS VARCHAR) AS tenant, CAST(created_at AS DATE) AS date, count(*) AS rows,
       count(b.session_id) AS with_session, count(DISTINCT b.session_id) AS sessions
FROM raw LEFT JOIN b ON raw.fingerprint = b.fingerprint AND raw.uid % 3 = b.k AND raw.created_at BETWEEN b.st AND b.en
GROUP BY uid % 3, CAST(created_at AS DATE)""",
    "sequence_run_sessions": f"""WITH {RAW},
k AS (SELECT *, created_at - (event_id % 7) * INTERVAL '1' MINUTE AS st FROM raw),
g AS (
  SELECT *, CASE WHEN lag(st) OVER w IS NULL OR floor(epoch(st)) - floor(epoch(lag(st) OVER w)) > 1800 THEN 1 ELSE 0 END AS opens
  FROM k WINDOW w AS (PARTITION BY uid % 3, fingerprint ORDER BY st, event_id)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY uid % 3, fingerprint ORDER BY st RANGE UNBOUNDED PRECEDING) AS seq FROM g)
SELECT 'tenant_' || CAST(uid % 3 AS VARCHAR) AS tenant, _id AS mongo_id, st AS session_start,
       fingerprint || '_' || CAST(seq AS VARCHAR) AS session_id, session_end_raw AS session_end_ts,
       CAST(floor(epoch(session_end_raw)) - floor(epoch(st)) AS BIGINT) AS session_duration, CAST(st AS DATE) AS date
FROM s""",
    "empty_tenant_run": f"""WITH {CLICKS},
t AS (
  SELECT tenant AS client_name, count(*) AS n, count(*) FILTER (reason = 'null_user_agent') AS no_agent,
         count(*) FILTER (reason = 'bot') AS bots, count(*) FILTER (reason = 'invalid_identity') AS bad,
         count(*) FILTER (x IS NULL OR lower(trim(x)) IN ('unknown', 'null', '')) AS nobody
  FROM tagged GROUP BY tenant),
z AS (SELECT CAST(0 AS BIGINT) AS null_timestamp_dropped, CAST(0 AS BIGINT) AS orphans_dropped, CAST(0 AS BIGINT) AS final_rows_written,
        CAST(0 AS BIGINT) AS duplicate_mongo_id_dropped, CAST(0 AS BIGINT) AS stored)
SELECT 'user_sessions_v2' AS source_table, client_name, 'EMPTY' AS status, n AS rows_read_raw, no_agent AS null_user_agent_dropped,
       bots AS bots_dropped, bad AS invalid_identity_dropped, n - no_agent - bots - bad AS mongo_filter_leak_dropped, z.*,
       'created_at,date,day,event_timestamp,fingerprint,is_session_assigned,mongo_id,month,resolved_user_id,session_end,session_end_raw,session_id,session_label,tenant,user_agent,user_id,year' AS columns
FROM t, z
UNION ALL BY NAME
SELECT 'activity_logs_v2' AS source_table, client_name, 'EMPTY' AS status, n AS rows_read_raw, CAST(0 AS BIGINT) AS null_user_agent_dropped,
       CAST(0 AS BIGINT) AS bots_dropped, nobody AS invalid_identity_dropped, n - nobody AS mongo_filter_leak_dropped, z.*,
       'activity,created_at,date,day,details,event_timestamp,fingerprint,is_session_assigned,mongo_id,month,page,resolved_user_id,session_id,tenant,time,user_id,year' AS columns
FROM t, z""",
    "concurrent_tenant_runs": f"""WITH {AUDIT},
n AS (SELECT tenant, count(*) AS activity_rows FROM child WHERE hit IS NOT NULL GROUP BY tenant)
SELECT {AUDIT_COLUMNS}, activity_rows FROM audit JOIN n USING (tenant)""",
    "iso_text_window": f"""WITH {LOCAL}
SELECT event_id, date FROM ev WHERE date >= DATE '2024-01-10' AND date < DATE '2024-01-20'""",
    "clock_change_sessions": """
WITH m AS (SELECT event_id, user_id, ts + INTERVAL 76 DAY AS u FROM events),
l AS (SELECT *, u + CASE WHEN u >= TIMESTAMP '2024-03-31 01:00:00' THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS t FROM m),
g AS (
  SELECT *, CAST(t AS DATE) AS date, CASE WHEN lag(u) OVER w IS NULL OR floor(epoch(u)) - floor(epoch(lag(u) OVER w)) > 10800 THEN 1 ELSE 0 END AS opens
  FROM l WINDOW w AS (PARTITION BY user_id, CAST(t AS DATE) ORDER BY u, event_id)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id, date ORDER BY u, event_id) AS seq FROM g),
f AS (SELECT *, CAST(user_id AS VARCHAR) AS x, min(t) OVER p AS st, max(t) OVER p AS en FROM s WINDOW p AS (PARTITION BY user_id, date, seq))
SELECT event_id, date, sha256(x || '||' || CAST(st AS VARCHAR)) AS session_id, x || '__' || CAST(st AS VARCHAR) AS session_label, en AS session_end
FROM f""",
}

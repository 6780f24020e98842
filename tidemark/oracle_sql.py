"""DuckDB SQL equivalents of the registered queries (same column names, any row order)."""

from __future__ import annotations

OPEN = "TIMESTAMP '9999-12-31 00:00:00'"

LOG = """log AS (
  SELECT user_id AS id, concat('user_', CAST(user_id AS VARCHAR)) AS name,
         concat('u', CAST(user_id AS VARCHAR), '@', event_type) AS email,
         CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS action,
         ts AS updated_timestamp, CAST(ts AS DATE) AS partition_date, event_id AS seq
  FROM events)"""

LATEST = """SELECT id, name, email, action, updated_timestamp, partition_date FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_timestamp DESC, seq DESC) AS rn
  FROM log WHERE partition_date <= DATE '2024-01-15') t
WHERE rn = 1 AND action IN ('INSERT', 'UPDATE')"""

SCD2 = f"""SELECT id, name, email, action, valid_from, valid_to, valid_to = {OPEN} AS is_current FROM (
  SELECT *, updated_timestamp AS valid_from,
         coalesce(lead(updated_timestamp) OVER (PARTITION BY id ORDER BY updated_timestamp, seq), {OPEN}) AS valid_to
  FROM log) t
WHERE action <> 'DELETE'"""

MERGE_INPUTS = f"""tgt AS (
  SELECT id, name, email, action, updated_timestamp AS valid_from, {OPEN} AS valid_to, true AS t FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_timestamp DESC, seq DESC) AS rn
    FROM log WHERE partition_date <= DATE '2024-01-14') a
  WHERE rn = 1 AND action IN ('INSERT', 'UPDATE')),
src AS (
  SELECT id, name, email, action, updated_timestamp AS valid_from, true AS s FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_timestamp DESC, seq DESC) AS rn
    FROM log WHERE partition_date = DATE '2024-01-15') b
  WHERE rn = 1)"""

# the source of the MERGE limited to the first hour of day 15 (an hourly batch)
MERGE_INPUTS_HOURLY = MERGE_INPUTS.replace(
    "FROM log WHERE partition_date = DATE '2024-01-15') b",
    "FROM log WHERE partition_date = DATE '2024-01-15' AND updated_timestamp < TIMESTAMP '2024-01-15 01:00:00') b")
HOURLY_LOG = "hlog AS (SELECT * FROM log WHERE updated_timestamp < TIMESTAMP '2024-01-15 01:00:00')"

ENVELOPE_TS = "make_timestamp((epoch_us(updated_timestamp) // 1000) * 1000)"

ORACLES = {
    "latest_current": f"WITH {LOG} {LATEST}",
    "latest_current_incremental": f"WITH {LOG} {LATEST}",
    "latest_current_hourly": f"""WITH {LOG}
SELECT id, name, email, action, updated_timestamp, partition_date FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_timestamp DESC, seq DESC) AS rn
  FROM log WHERE updated_timestamp < TIMESTAMP '2024-01-15 01:00:00') t
WHERE rn = 1 AND action IN ('INSERT', 'UPDATE')""",
    "scd2_from_log": f"WITH {LOG} {SCD2}",
    "scd2_apply": f"WITH {LOG} {SCD2}",
    "scd2_incremental_commits": f"WITH {LOG} {SCD2}",
    "scd2_hourly_commit": f"WITH {LOG}, {HOURLY_LOG} " + SCD2.replace("FROM log", "FROM hlog"),
    "scd2_as_of_view": f"""WITH {LOG}, scd2 AS ({SCD2})
SELECT * FROM scd2 WHERE valid_from <= TIMESTAMP '2024-01-15 12:00:00' AND TIMESTAMP '2024-01-15 12:00:00' < valid_to""",
    "merge_current": f"""WITH {LOG}, {MERGE_INPUTS}
SELECT coalesce(tgt.id, src.id) AS id,
  CASE WHEN t IS NULL OR (s AND src.action = 'UPDATE') THEN src.name ELSE tgt.name END AS name,
  CASE WHEN t IS NULL OR (s AND src.action = 'UPDATE') THEN src.email ELSE tgt.email END AS email,
  CASE WHEN t IS NULL OR (s AND src.action IN ('UPDATE', 'DELETE')) THEN src.action ELSE tgt.action END AS action,
  CASE WHEN t IS NULL OR (s AND src.action = 'UPDATE') THEN src.valid_from ELSE tgt.valid_from END AS valid_from,
  CASE WHEN t AND s AND src.action = 'DELETE' THEN src.valid_from ELSE {OPEN} END AS valid_to
FROM tgt FULL JOIN src ON tgt.id = src.id""",
    "merge_current_hourly": f"""WITH {LOG}, {MERGE_INPUTS_HOURLY}
SELECT coalesce(tgt.id, src.id) AS id,
  CASE WHEN t IS NULL OR (s AND src.action = 'UPDATE') THEN src.name ELSE tgt.name END AS name,
  CASE WHEN t IS NULL OR (s AND src.action = 'UPDATE') THEN src.email ELSE tgt.email END AS email,
  CASE WHEN t IS NULL OR (s AND src.action IN ('UPDATE', 'DELETE')) THEN src.action ELSE tgt.action END AS action,
  CASE WHEN t IS NULL OR (s AND src.action = 'UPDATE') THEN src.valid_from ELSE tgt.valid_from END AS valid_from,
  CASE WHEN t AND s AND src.action = 'DELETE' THEN src.valid_from ELSE {OPEN} END AS valid_to
FROM tgt FULL JOIN src ON tgt.id = src.id""",
    "merge_close_and_insert": f"""WITH {LOG}, {MERGE_INPUTS}
SELECT tgt.id, tgt.name, tgt.email,
  CASE WHEN src.action = 'DELETE' THEN src.action ELSE tgt.action END AS action, tgt.valid_from,
  CASE WHEN src.action IN ('DELETE', 'UPDATE') THEN src.valid_from ELSE tgt.valid_to END AS valid_to,
  DATE '2024-01-15' AS partition_date
FROM tgt LEFT JOIN src ON tgt.id = src.id
UNION ALL
SELECT id, name, email, action, valid_from, {OPEN} AS valid_to, DATE '2024-01-15' AS partition_date
FROM src WHERE action IN ('INSERT', 'UPDATE')""",
    "snapshot_current": f"""WITH {LOG}
SELECT id, name, email, action, updated_timestamp, DATE '2024-01-15' AS partition_date
FROM log WHERE partition_date = DATE '2024-01-15' AND action IN ('INSERT', 'UPDATE')""",
    "read_partition_day": f"WITH {LOG} SELECT * FROM log WHERE partition_date = DATE '2024-01-15'",
    "read_as_of": f"WITH {LOG} SELECT * FROM log WHERE partition_date <= DATE '2024-01-15'",
    "read_csv_header": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
    "write_dynamic_overwrite": f"WITH {LOG} SELECT * FROM log",
    "append_history": f"""WITH {LOG}
SELECT * FROM log WHERE partition_date IN (DATE '2024-01-15', DATE '2024-01-16')""",
    "snapshot_append": f"""WITH {LOG}
SELECT id, name, email, action, updated_timestamp, partition_date FROM log WHERE action IN ('INSERT', 'UPDATE')""",
    "two_stage_snapshot": f"""WITH {LOG}, cur AS ({LATEST})
SELECT id, name, email, action, updated_timestamp, DATE '2024-01-15' AS partition_date FROM cur""",
    "normalize_envelope": f"""WITH {LOG}
SELECT CASE action WHEN 'INSERT' THEN 'c' WHEN 'DELETE' THEN 'd' ELSE 'u' END AS operation, action, id, name, email,
  {ENVELOPE_TS} AS updated_timestamp, CAST({ENVELOPE_TS} AS DATE) AS partition_date
FROM log""",
    "normalize_envelope_quarantine": "SELECT props AS raw, 'malformed envelope' AS reason FROM events",
    "normalize_after_image": f"""WITH {LOG}
SELECT CASE WHEN action = 'DELETE' THEN NULL ELSE id END AS id,
  CASE WHEN action = 'DELETE' THEN NULL ELSE name END AS name,
  CASE WHEN action = 'DELETE' THEN NULL ELSE email END AS email,
  CASE WHEN action = 'DELETE' THEN NULL ELSE updated_timestamp END AS update_timestamp,
  CASE action WHEN 'INSERT' THEN 'c' WHEN 'DELETE' THEN 'd' ELSE 'u' END AS op
FROM log""",
    "stream_to_bronze": f"""WITH {LOG}
SELECT CASE action WHEN 'INSERT' THEN 'c' WHEN 'DELETE' THEN 'd' ELSE 'u' END AS operation, action, id, name, email,
  {ENVELOPE_TS} AS updated_timestamp, CAST({ENVELOPE_TS} AS DATE) AS partition_date
FROM log""",
    "stream_scd2": f"""WITH {LOG}, env AS (SELECT id, name, email, action, {ENVELOPE_TS} AS ts, seq FROM log)
SELECT id, name, email, action, valid_from, valid_to, valid_to = {OPEN} AS is_current FROM (
  SELECT *, ts AS valid_from,
         coalesce(lead(ts) OVER (PARTITION BY id ORDER BY ts, seq), {OPEN}) AS valid_to
  FROM env) t
WHERE action <> 'DELETE'""",
    "run_spec_sql_step": f"WITH {LOG} {LATEST}",
    "run_spec_steps": """SELECT user_id AS id,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS action,
  CAST(ts AS DATE) AS partition_date, count(*) AS n_changes, max(ts) AS last_change
FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-15' OR event_type IN ('signup', 'error')
GROUP BY 1, 2, 3""",
    "run_spec_callable": """SELECT o_orderstatus AS grp, count(*) AS n, round(sum(o_totalprice), 2) AS total, 'status' AS kind
FROM orders GROUP BY o_orderstatus
UNION ALL
SELECT o_orderpriority AS grp, count(*) AS n, round(sum(o_totalprice), 2) AS total, 'priority' AS kind
FROM orders GROUP BY o_orderpriority""",
    "multi_sink": f"""WITH {LOG}, hist AS (SELECT * FROM log WHERE partition_date <= DATE '2024-01-15')
SELECT id, name, email, action, updated_timestamp, partition_date, 'hist' AS sink FROM hist
UNION ALL
SELECT id, name, email, action, updated_timestamp, partition_date, 'current' AS sink FROM ({LATEST}) c
UNION ALL
SELECT id, name, email, action, updated_timestamp, partition_date, 'copy' AS sink FROM hist""",
    "top_users": """SELECT c.c_custkey, c.c_name, count(DISTINCT o.o_orderkey) AS n_orders,
       round(sum(l.l_extendedprice * (1 - l.l_discount)), 2) AS revenue
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY c.c_custkey, c.c_name ORDER BY revenue DESC, c.c_custkey LIMIT 10""",
}

COARSE_LOG = """clog AS (
  SELECT CASE WHEN id % 17 = 0 THEN NULL ELSE id END AS id, name, email, action, seq, partition_date,
         date_trunc('day', updated_timestamp) + to_hours(CAST(floor(hour(updated_timestamp) / 6) * 6 AS INT)) AS updated_timestamp
  FROM log)"""
MERGED = ORACLES["merge_current"].split("tgt", 1)[1].split("WHERE rn = 1)\nSELECT", 1)[1]
CLOSED = ORACLES["merge_close_and_insert"].split("WHERE rn = 1)\n", 1)[1]
SIDE_COLUMNS = "id, name, email, action, valid_from, valid_to"
TILL_15 = "SELECT id, name, email, action, updated_timestamp, partition_date"

ORACLES |= {
    "latest_current_hourly_split": ORACLES["latest_current_hourly"],
    "scd2_hourly_commit_split": ORACLES["scd2_hourly_commit"],
    "merge_current_hourly_split": ORACLES["merge_current_hourly"],
    "scd2_any_batching": f"WITH {LOG}, {COARSE_LOG} " + SCD2.replace("FROM log", "FROM clog"),
    "scd2_late_rows": f"""WITH {LOG}, last AS (
  SELECT id, max({{'t': updated_timestamp, 's': seq}}) AS p FROM log WHERE day(partition_date) % 2 = 0 GROUP BY id)
SELECT log.id, name, email, action, updated_timestamp, seq FROM log JOIN last ON last.id = log.id
WHERE day(partition_date) % 2 = 1 AND {{'t': updated_timestamp, 's': seq}} <= p""",
    "scd2_apply_state": f"""WITH {LOG}, {COARSE_LOG}, part AS (
  SELECT * FROM clog WHERE partition_date >= DATE '2024-01-15' OR seq % 2 = 0)
SELECT *, CAST(valid_from AS DATE) AS partition_date FROM ({SCD2.replace("FROM log", "FROM part")}) x""",
    "scd2_close_only": f"""WITH {LOG}, old AS ({SCD2.replace("FROM log", "FROM log WHERE partition_date <= DATE '2024-01-14'")}),
first AS (SELECT id, min(updated_timestamp) AS t FROM log WHERE partition_date = DATE '2024-01-15' GROUP BY id)
SELECT old.id, name, email, action, valid_from, CASE WHEN is_current THEN coalesce(t, valid_to) ELSE valid_to END AS valid_to,
       is_current AND t IS NULL AS is_current
FROM old LEFT JOIN first ON first.id = old.id""",
    "scd2_init": f"""WITH {LOG} SELECT id, name, email, action, updated_timestamp AS valid_from, {OPEN} AS valid_to, true AS is_current,
  DATE '2024-01-15' AS partition_date FROM log""",
    "merge_current_with_history": f"""WITH {LOG}, {MERGE_INPUTS}, cur AS (SELECT {MERGED})
SELECT {SIDE_COLUMNS}, 'current' AS side FROM cur
UNION ALL
SELECT id, name, email, action, updated_timestamp, {OPEN}, 'history' FROM log
WHERE partition_date = DATE '2024-01-15' AND action = 'DELETE'""",
    "merge_close_and_insert_with_archive": f"""WITH {LOG}, {MERGE_INPUTS}, cur AS ({CLOSED})
SELECT {SIDE_COLUMNS}, 'current' AS side FROM cur
UNION ALL
SELECT {SIDE_COLUMNS}, 'history' FROM tgt""",
    "scd4_multi_batch_day": f"""WITH {LOG} {TILL_15}, 'hist' AS sink FROM log WHERE partition_date <= DATE '2024-01-15'
UNION ALL {TILL_15}, 'current' FROM ({LATEST}) c""",
    "catalog_kinds": f"""WITH {LOG}, kinds AS (SELECT unnest(['scd2', 'scd4_hist', 'scd4a_hist']) AS kind)
SELECT log.*, kind FROM log, kinds
UNION ALL
SELECT log.*, kind FROM log, (SELECT unnest(['scd4_current', 'scd4a_current']) AS kind) k
WHERE partition_date = (SELECT max(partition_date) FROM log)""",
    "csv_to_table": """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation""",
    "sql_partition_scan": f"""WITH {LOG}
SELECT c_mktsegment, action, count(*) AS n_changes, count(DISTINCT id) AS n_customers
FROM log JOIN customer ON c_custkey = id WHERE partition_date = DATE '2024-01-15' GROUP BY 1, 2""",
    "run_spec_more_steps": """WITH top AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS seg
  FROM customer ORDER BY c_custkey LIMIT 100),
segs AS (SELECT DISTINCT k, coalesce(seg, 'none') AS seg FROM (
  SELECT c_custkey AS k, c_mktsegment AS seg FROM customer WHERE c_custkey % 5 <> 0 AND c_mktsegment IS NOT NULL UNION ALL SELECT * FROM top) u)
SELECT seg, status, count(*) AS n FROM (SELECT DISTINCT o_custkey AS k, o_orderstatus AS status FROM orders) o JOIN segs USING (k) GROUP BY 1, 2""",
    "spec_file": "SELECT o_orderstatus AS grp, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
    "run_stream_spec": ORACLES["stream_to_bronze"],
    "stream_to_bronze_quarantine": """SELECT props AS raw, 'malformed envelope' AS reason FROM events
UNION ALL SELECT concat('{"op":"d","source":{"ts_ms":1},"seq":', event_id, '}'), 'missing row image' FROM events""",
    "append_history": f"WITH {LOG} SELECT * FROM log",
}
ORACLES["scd4_multi_batch_day_state"] = ORACLES["scd4_multi_batch_day"]

ORACLES |= {
    "stream_dedup": ORACLES["stream_to_bronze"],
    "scd2_with_truncates": f"""WITH {LOG}, env AS (SELECT id, name, email, action, {ENVELOPE_TS} AS ts, seq FROM log),
cuts AS (SELECT ts, seq FROM env WHERE seq % 997 = 5),
steps AS (SELECT *, coalesce(lead(ts) OVER (PARTITION BY id ORDER BY ts, seq), {OPEN}) AS nxt FROM env),
ended AS (SELECT *, least(nxt, coalesce((SELECT min(c.ts) FROM cuts c WHERE c.ts > steps.ts OR (c.ts = steps.ts AND c.seq > steps.seq)), nxt)) AS valid_to
          FROM steps WHERE action <> 'DELETE')
SELECT id, name, email, action, ts AS valid_from, valid_to, valid_to = {OPEN} AS is_current, built_from
FROM ended, (SELECT unnest(['log', 'batches']) AS built_from)""",
    "as_of_join": """WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
c AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'click'),
b AS (SELECT p.event_id, max({'t': c.ts, 'e': c.event_id}) AS x FROM p JOIN c ON c.user_id = p.user_id AND c.ts < p.ts GROUP BY 1),
f AS (SELECT p.event_id, min({'t': c.ts, 'e': c.event_id}) AS x FROM p JOIN c ON c.user_id = p.user_id AND c.ts > p.ts GROUP BY 1)
SELECT event_id, user_id, ts, b.x.t AS last_at, b.x.e AS last_click, f.x.t AS next_at, f.x.e AS next_click
FROM p LEFT JOIN b USING (event_id) LEFT JOIN f USING (event_id)""",
    "point_in_time": f"""WITH {LOG}, dim AS ({SCD2}),
facts AS (SELECT seq, id, updated_timestamp - INTERVAL 1 HOUR AS at FROM log WHERE seq % 2 = 0)
SELECT facts.seq, facts.id, facts.at, email AS dim_email, action AS dim_action, valid_from AS dim_valid_from, valid_to AS dim_valid_to
FROM facts LEFT JOIN dim ON dim.id = facts.id AND valid_from <= facts.at AND facts.at < valid_to""",
    "top_users_incremental": """WITH v AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 10 <> 0 THEN o_custkey + 1 ELSE o_custkey END AS custkey,
         o_orderkey % 5 = 0 AND o_orderkey % 10 <> 0 AS moved
  FROM orders WHERE o_orderkey % 7 <> 0),
r AS (SELECT custkey, o_orderkey, sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS rev
      FROM v JOIN lineitem ON l_orderkey = o_orderkey WHERE NOT moved OR l_linenumber <= 2 GROUP BY 1, 2)
SELECT c_custkey, c_name, count(*) AS n_orders, CAST(round(sum(rev), 2) AS DOUBLE) AS revenue
FROM r JOIN customer ON c_custkey = custkey GROUP BY 1, 2""",
}

# the live rows at the end of every day but the 20th, and the snapshot days in order
SNAPSHOTS = """days AS (SELECT DISTINCT partition_date AS d FROM log),
ends AS (SELECT d, log.*, row_number() OVER (PARTITION BY d, id ORDER BY updated_timestamp DESC, seq DESC) AS rn
         FROM days JOIN log ON log.partition_date <= d),
snap AS (SELECT id, name, email, d FROM ends WHERE rn = 1 AND action <> 'DELETE' AND day(d) <> 20),
ordered AS (SELECT d, row_number() OVER (ORDER BY d) AS n FROM (SELECT DISTINCT d FROM snap)),
numbered AS (SELECT snap.*, n FROM snap JOIN ordered USING (d))"""
ORACLES |= {
    "snapshot_changes": f"""WITH {LOG}, {SNAPSHOTS}
SELECT a.id, a.name, a.email, CASE WHEN b.id IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS action, a.d AS partition_date
FROM numbered a LEFT JOIN numbered b ON b.id = a.id AND b.n = a.n - 1
WHERE b.id IS NULL OR b.name IS DISTINCT FROM a.name OR b.email IS DISTINCT FROM a.email
UNION ALL
SELECT a.id, a.name, a.email, 'DELETE', o.d FROM numbered a JOIN ordered o ON o.n = a.n + 1
WHERE NOT EXISTS (SELECT 1 FROM numbered b WHERE b.id = a.id AND b.n = a.n + 1)""",
    "snapshot_intervals": f"""WITH {LOG}, {SNAPSHOTS},
runs AS (SELECT *, n - row_number() OVER (PARTITION BY id, name, email ORDER BY n) AS run FROM numbered),
folded AS (SELECT id, name, email, min(d) AS a, max(n) AS z FROM runs GROUP BY id, name, email, run)
SELECT id, name, email, CAST(a AS TIMESTAMP) AS valid_from, coalesce(CAST(o.d AS TIMESTAMP), {OPEN}) AS valid_to, o.d IS NULL AS is_current
FROM folded LEFT JOIN ordered o ON o.n = z + 1""",
    "merge_current_bucketed": ORACLES["merge_current"],
    "stream_offset_ranges": f"""WITH {LOG}, sent AS (SELECT id % 4 AS p, seq * 2 + id % 4 AS o, seq % 97 = 0 AND partition_date <= (
    SELECT max(partition_date) FROM (SELECT DISTINCT partition_date FROM log ORDER BY 1 LIMIT 20)) AS again FROM log WHERE seq % 211 <> 0),
runs AS (SELECT *, o - row_number() OVER (PARTITION BY p ORDER BY o) AS run FROM sent),
ranges AS (SELECT p, min(o) AS a, max(o) AS z, count(*) AS n, count(*) FILTER (again) AS r FROM runs GROUP BY p, run)
SELECT 'range' AS kind, p AS "partition", a AS first_offset, z AS last_offset, n AS n_messages FROM ranges
UNION ALL SELECT 'repeat', p, a, z, r FROM ranges WHERE r > 0
UNION ALL SELECT 'gap', p, last + 1, a - 1, a - last - 1 FROM (SELECT p, a, lag(z) OVER (PARTITION BY p ORDER BY a) AS last FROM ranges) WHERE last IS NOT NULL""",
}

ORACLES |= {
    "normalize_envelope_evolving": f"""WITH {LOG}
SELECT CASE action WHEN 'INSERT' THEN 'c' WHEN 'DELETE' THEN 'd' ELSE 'u' END AS operation, action,
  CASE WHEN day(partition_date) > 20 THEN concat('u', id) ELSE CAST(id AS VARCHAR) END AS id, name, email,
  CASE WHEN day(partition_date) > 20 THEN 'gold' WHEN day(partition_date) > 10 THEN CAST(seq % 5 AS VARCHAR) END AS tier,
  {ENVELOPE_TS} AS updated_timestamp, CAST({ENVELOPE_TS} AS DATE) AS partition_date
FROM log""",
    "even_ranges": "SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 1 WHEN user_id % 11 = 0 THEN NULL ELSE user_id END AS k FROM events",
    "raw_to_bronze_incremental": f"WITH {LOG} SELECT * FROM log",
    "raw_to_bronze_snapshot": """SELECT customer.*, d AS partition_date FROM customer,
  (SELECT unnest([DATE '2024-01-15', DATE '2024-01-16', DATE '2024-01-17']) AS d)""",
    "bootstrap_bronze": f"WITH {LOG} SELECT * FROM log",
    "run_spec_date_sub": f"WITH {LOG} SELECT * FROM log WHERE partition_date BETWEEN DATE '2024-01-11' AND DATE '2024-01-15'",
    "run_spec_set_steps": """WITH o AS (SELECT o_orderkey, o_custkey AS k, o_orderstatus AS status, o_orderpriority AS priority FROM orders),
both_ AS (SELECT k, status, priority FROM o WHERE o_orderkey % 2 = 0 INTERSECT ALL SELECT k, status, priority FROM o WHERE o_orderkey % 3 = 0),
rest AS (SELECT k, status, priority FROM o EXCEPT ALL SELECT * FROM both_)
SELECT priority, s AS status, nullif(count(*) FILTER (rest.status = c), 0) AS n
FROM rest, (VALUES ('done', 'F'), ('open', 'O')) v(s, c) GROUP BY priority, s""",
    "run_spec_scd4_upkeep": ORACLES["merge_current_with_history"],
    "run_spec_scd4a_upkeep": ORACLES["merge_close_and_insert_with_archive"],
}

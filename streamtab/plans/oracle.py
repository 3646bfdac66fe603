"""Independent SQL (DuckDB dialect) for every registered query in :mod:`.catalog`.

Written from the semantics, not from the Spark plans: ordered replays use SQL
window functions over the whole key, as-of lookups use ``ASOF JOIN``, lateness
uses a running ``max`` - the straightforward forms the skew-safe Spark plans
must agree with.  Column names match the Spark aliases.
"""

from __future__ import annotations

DAY_BUCKET = "time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01')"
K = "CAST(json_extract(props, '$.k') AS INTEGER)"
TRACKED = "('the', 'der', 'la', 'el')"

_SHUFFLED = """
  SELECT event_id, user_id, ts, user_id % 4 AS b,
         event_id + ((event_id * 7919) % 50) * 4 AS arr
  FROM events"""

_LATE = f"""
  WITH a AS ({_SHUFFLED}),
  s AS (
    SELECT *, max(ts) OVER (PARTITION BY b ORDER BY arr, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time,
           {DAY_BUCKET} AS window_start
    FROM a)
  SELECT *, window_start + INTERVAL 1 DAY AS window_end,
         (window_start + INTERVAL 1 DAY) <= stream_time - INTERVAL 2 HOUR AS is_late
  FROM s"""

_DAILY = f"""
  SELECT user_id, window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS n
  FROM (SELECT user_id, {DAY_BUCKET} AS window_start FROM events)
  GROUP BY user_id, window_start"""

_MERGED_DOCS = """
  SELECT doc_id, lang, text, false AS translated FROM documents WHERE lang = 'en'
  UNION ALL
  SELECT doc_id, lang, 'Translated: ' || text AS text, true AS translated FROM documents WHERE lang <> 'en'"""

_TOP3 = """
  WITH e AS (
    SELECT n_nationkey, n_name, o_orderkey, o_custkey, c_name, o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
  f AS (
    SELECT * FROM e
    QUALIFY row_number() OVER (PARTITION BY n_nationkey, o_totalprice ORDER BY o_orderkey) = 1)
  SELECT *, CAST(row_number() OVER (PARTITION BY n_nationkey ORDER BY o_totalprice DESC) AS INTEGER) AS rank
  FROM f QUALIFY rank <= 3"""

_LB_ARRAY = f"""
  SELECT n_nationkey,
         CAST(to_json(list(struct_pack(rank := rank, o_orderkey := o_orderkey, c_name := c_name,
                                       o_totalprice := o_totalprice) ORDER BY rank)) AS VARCHAR) AS entries
  FROM ({_TOP3}) GROUP BY n_nationkey"""

_POWER = f"CASE WHEN {K} % 2 = 0 THEN 'ON' ELSE 'OFF' END"
_TWIN_INPUTS = f"""
  WITH r AS (
    SELECT user_id AS key, event_id, ts AS timestamp, value AS wind_speed_mph, {_POWER} AS power
    FROM events WHERE event_type = 'view')
  SELECT key, event_id, 0 AS emit_idx, timestamp, wind_speed_mph, power, 'REPORTED' AS type FROM r
  UNION ALL
  SELECT key, event_id, 1, timestamp, wind_speed_mph, 'OFF', 'DESIRED' FROM r
    WHERE wind_speed_mph > 65 AND power = 'ON'
  UNION ALL
  SELECT user_id, event_id, 0, ts, CAST(NULL AS DOUBLE), {_POWER}, 'DESIRED' FROM events
    WHERE event_type = 'signup'"""

_TWIN_COLS = """
  d.timestamp AS desired_timestamp, d.wind_speed_mph AS desired_wind_speed_mph, d.power AS desired_power,
  r.timestamp AS reported_timestamp, r.wind_speed_mph AS reported_wind_speed_mph, r.power AS reported_power"""

_TWIN_LATEST = f"""
  WITH i AS ({_TWIN_INPUTS}),
  d AS (SELECT * FROM i WHERE type = 'DESIRED'
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id DESC, emit_idx DESC) = 1),
  r AS (SELECT * FROM i WHERE type = 'REPORTED'
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id DESC, emit_idx DESC) = 1),
  k AS (SELECT DISTINCT key FROM i)
  SELECT k.key, {_TWIN_COLS}
  FROM k LEFT JOIN d ON d.key = k.key LEFT JOIN r ON r.key = k.key"""

_CHANGES = f"""
  SELECT CAST(user_id AS VARCHAR) AS rowkey, event_id AS uuid, user_id AS title_id,
         CASE WHEN event_type = 'purchase' THEN 'release_date' ELSE 'season_length' END AS change_type,
         {K} % 3 AS before_season_id, CAST(floor(value) AS INTEGER) % 13 AS before_episode_count,
         CASE WHEN event_id % 4 <> 0 THEN {K} % 3 END AS after_season_id,
         CASE WHEN event_id % 4 <> 0 THEN (CAST(floor(value) AS INTEGER) + {K}) % 13 END AS after_episode_count,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at
  FROM events"""

_CSAS = f"""
  SELECT rowkey, uuid, title_id, coalesce(after_season_id, before_season_id) AS season_id,
         before_episode_count AS old_episode_count, after_episode_count AS new_episode_count, created_at
  FROM ({_CHANGES}) WHERE change_type = 'season_length'"""

_CTAS = f"""
  WITH s AS (
    SELECT c.*, strptime(created_at, '%Y-%m-%d %H:%M:%S') AS event_ts, t.c_name AS title,
           title_id % 4 AS b
    FROM ({_CSAS}) c JOIN customer t ON c.title_id = t.c_custkey),
  m AS (
    SELECT *, max(event_ts) OVER (PARTITION BY b ORDER BY uuid
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time,
           time_bucket(INTERVAL 1 DAY, event_ts, TIMESTAMP '1970-01-01') AS window_start
    FROM s)
  SELECT title_id, season_id, window_start, window_start + INTERVAL 1 DAY AS window_end,
         any_value(title) AS title, count(*) AS change_count,
         arg_max(new_episode_count, CASE WHEN new_episode_count IS NOT NULL THEN uuid END) AS episode_count,
         CAST(title_id AS VARCHAR) || '|+|' || CAST(season_id AS VARCHAR) AS key
  FROM m
  WHERE window_start + INTERVAL 1 DAY > stream_time - INTERVAL 10 MINUTE
  GROUP BY title_id, season_id, window_start"""


ORACLE_SQL: dict[str, str] = {
    "greet_projection": "SELECT c_custkey, 'Hello, ' || c_name AS greeting FROM customer",

    "json_decode_project": f"SELECT event_id, CAST(user_id AS VARCHAR) AS key, {K} AS k FROM events",

    "keyed_text_decode": """
      SELECT event_id, CAST(substr(line, 1, strpos(line, '|') - 1) AS BIGINT) AS key,
             CAST(json_extract(substr(line, strpos(line, '|') + 1), '$.k') AS INTEGER) AS k
      FROM (SELECT event_id, CAST(user_id AS VARCHAR) || '|' || props AS line FROM events)""",

    "declared_stream": """
      SELECT event_id, CAST(user_id AS VARCHAR) AS rowkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at,
             strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS event_ts
      FROM events""",

    "json_encode_roundtrip": "SELECT event_id, user_id, event_type, value FROM events",

    "malformed_split": """
      SELECT CASE WHEN json_valid(p) THEN 'good' ELSE 'bad' END AS status, count(*) AS n,
             CAST(sum(CASE WHEN json_valid(p) THEN CAST(json_extract(p, '$.k') AS BIGINT) END) AS BIGINT) AS k_sum
      FROM (SELECT CASE WHEN event_id % 10 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS p
            FROM events)
      GROUP BY 1""",

    "sink_roundtrip": "SELECT event_id, user_id, event_type, value FROM events",

    "filter_not_error": """
      SELECT event_id, user_id, event_type, value FROM events
      WHERE NOT (event_type = 'error') AND value > 100""",

    "branch_first_match": """
      SELECT branch, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars
      FROM (SELECT CASE WHEN lang = 'en' THEN 0 WHEN n_chars > 5000 THEN 1
                        WHEN lang IN ('fr', 'de') THEN 2 END AS branch, n_chars FROM documents)
      WHERE branch IS NOT NULL GROUP BY branch""",

    "branch_translate_merge": f"""
      SELECT doc_id, lang, translated, CAST(length(text) AS INTEGER) AS text_len, md5(text) AS text_md5
      FROM ({_MERGED_DOCS})""",

    "entity_flatmap": f"""
      SELECT doc_id, pos, entity FROM (
        SELECT doc_id, CAST(unnest(generate_series(1, len(toks))) AS INTEGER) AS pos, unnest(toks) AS entity
        FROM (SELECT doc_id, string_split(replace(lower(text), '#', ''), ' ') AS toks FROM documents))
      WHERE entity IN {TRACKED}""",

    "entity_sentiment": f"""
      WITH m AS (
        SELECT doc_id, text FROM documents WHERE NOT (source = 'src1') AND lang = 'en'
        UNION ALL
        SELECT doc_id, 'Translated: ' || text FROM documents WHERE NOT (source = 'src1') AND lang <> 'en'),
      t AS (
        SELECT doc_id AS id, text_md5, CAST(unnest(generate_series(1, len(toks))) AS INTEGER) AS pos,
               unnest(toks) AS entity
        FROM (SELECT doc_id, md5(text) AS text_md5, string_split(replace(lower(text), '#', ''), ' ') AS toks FROM m))
      SELECT id, pos, entity, text_md5,
             ((id * 31 + pos * 17) % 1000) / 1000.0 AS sentiment_score,
             ((id * 13 + pos * 7) % 1000) / 1000.0 AS sentiment_magnitude,
             ((id * 7 + pos * 29) % 1000) / 1000.0 AS salience
      FROM t WHERE entity IN {TRACKED}""",

    "rekey_group_count": "SELECT event_type AS key, count(*) AS n FROM events GROUP BY event_type",

    "conditional_emit": """
      SELECT event_id, event_type, user_id, value, 0 AS emit_idx FROM events
      UNION ALL
      SELECT event_id, 'alert', user_id, value, 1 FROM events WHERE event_type = 'view' AND value > 100""",

    "latest_table": """
      SELECT user_id, event_id, event_type, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",

    "latest_table_tombstones": """
      SELECT user_id, event_id, event_type, value FROM (
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
      WHERE event_type <> 'error'""",

    "stream_table_join": """
      SELECT event_id, user_id, c_name, c_mktsegment, value
      FROM events JOIN customer ON user_id = c_custkey""",

    "stream_table_asof": """
      SELECT p.event_id, p.user_id, p.value, s.event_id AS t_event_id, s.value AS t_value
      FROM (SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase') p
      ASOF JOIN (SELECT event_id, user_id, event_type, value FROM events
                 WHERE event_type IN ('signup', 'error')) s
        ON p.user_id = s.user_id AND p.event_id > s.event_id
      WHERE s.event_type = 'signup'""",

    "global_table_join": """
      SELECT c_custkey, c_name, n_name, r_name
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",

    "table_table_join": """
      WITH v AS (SELECT user_id, event_id AS view_event_id, value AS view_value FROM events
                 WHERE event_type = 'view'
                 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
           p AS (SELECT user_id, event_id AS purchase_event_id, value AS purchase_value FROM events
                 WHERE event_type = 'purchase'
                 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
      SELECT v.user_id, view_event_id, view_value, purchase_event_id, purchase_value
      FROM v JOIN p ON v.user_id = p.user_id""",

    "interval_join": """
      SELECT c.event_id AS click_id, p.event_id AS purchase_id, c.user_id, c.ts AS click_ts,
             p.ts AS purchase_ts, greatest(c.ts, p.ts) AS joined_ts
      FROM events c JOIN events p
        ON c.user_id = p.user_id
       AND p.ts BETWEEN c.ts - INTERVAL 6 HOUR AND c.ts + INTERVAL 6 HOUR
      WHERE c.event_type = 'click' AND p.event_type = 'purchase'""",

    "leaderboard_top3": _TOP3,
    "leaderboard_array": _LB_ARRAY,

    "tumbling_count": _DAILY,
    "tumbling_final": f"""
      SELECT * FROM ({_DAILY})
      WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
    "tumbling_refining": f"""
      SELECT event_id, user_id, window_start,
             count(*) OVER (PARTITION BY user_id, window_start ORDER BY event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
      FROM (SELECT event_id, user_id, {DAY_BUCKET} AS window_start FROM events)""",
    "tumbling_grace": f"""
      SELECT user_id, window_start, window_end, count(*) AS n
      FROM ({_LATE}) WHERE NOT is_late GROUP BY user_id, window_start, window_end""",
    "late_rows": f"""
      SELECT event_id, user_id, ts, window_start, stream_time FROM ({_LATE}) WHERE is_late""",
    "latest_by_offset": f"""
      SELECT user_id, event_type, window_start, window_start + INTERVAL 1 DAY AS window_end,
             count(*) AS change_count,
             arg_max(value, CASE WHEN value IS NOT NULL THEN event_id END) AS latest_value
      FROM (SELECT *, {DAY_BUCKET} AS window_start FROM events)
      GROUP BY user_id, event_type, window_start""",
    "composite_key": """
      SELECT CAST(user_id AS VARCHAR) || '|+|' || event_type AS key, count(*) AS n
      FROM events GROUP BY 1""",
    "high_rate_rekey": f"SELECT * FROM ({_DAILY}) WHERE n >= 4",
    "vitals_alerts": f"""
      WITH c AS (
        SELECT user_id, window_start, count(*) AS heart_rate, max(ts) AS beat_ts
        FROM (SELECT user_id, ts, {DAY_BUCKET} AS window_start FROM events)
        GROUP BY user_id, window_start HAVING count(*) >= 4),
      h AS (SELECT event_id, user_id, ts, value FROM events WHERE value > 150)
      SELECT c.user_id, c.window_start, c.heart_rate, h.event_id, h.value,
             greatest(c.beat_ts, h.ts) AS alert_ts
      FROM c JOIN h ON c.user_id = h.user_id
       AND h.ts BETWEEN c.beat_ts - INTERVAL 1 HOUR AND c.beat_ts + INTERVAL 1 HOUR""",
    "hopping_count": f"""
      SELECT user_id, window_start, window_start + INTERVAL 2 DAY AS window_end, count(*) AS n
      FROM (SELECT user_id, {DAY_BUCKET} AS window_start FROM events
            UNION ALL
            SELECT user_id, {DAY_BUCKET} - INTERVAL 1 DAY FROM events)
      GROUP BY user_id, window_start""",
    "session_count": """
      WITH s AS (
        SELECT user_id, event_id, ts,
               CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 2 HOUR
                    THEN 1 ELSE 0 END AS new_session
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
      g AS (
        SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
        FROM s)
      SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 2 HOUR AS window_end, count(*) AS n
      FROM g GROUP BY user_id, sid""",
    "sliding_sum": """
      SELECT event_id, user_id, count(*) OVER w AS window_count, round(sum(value) OVER w, 2) AS window_sum
      FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)""",
    "retention_filter": f"""
      SELECT * FROM ({_DAILY})
      WHERE window_end > (SELECT max(ts) FROM events) - INTERVAL 2 DAY""",
    "event_time_fallback": """
      SELECT event_id, user_id, ts_raw,
             coalesce(ts_raw, max(ts_raw) OVER (PARTITION BY user_id % 4 ORDER BY event_id
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS event_ts
      FROM (SELECT event_id, user_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts_raw FROM events)""",

    "twin_changelog": f"""
      WITH i AS ({_TWIN_INPUTS}),
      s AS (
        SELECT key, event_id, emit_idx,
               last_value(CASE WHEN type = 'DESIRED' THEN struct_pack(timestamp := timestamp,
                            wind_speed_mph := wind_speed_mph, power := power) END IGNORE NULLS)
                 OVER w AS d,
               last_value(CASE WHEN type = 'REPORTED' THEN struct_pack(timestamp := timestamp,
                            wind_speed_mph := wind_speed_mph, power := power) END IGNORE NULLS)
                 OVER w AS r
        FROM i
        WINDOW w AS (PARTITION BY key ORDER BY event_id, emit_idx
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
      SELECT key, event_id, emit_idx, {_TWIN_COLS} FROM s""",
    "twin_latest": _TWIN_LATEST,
    "twin_ttl": f"""
      SELECT * FROM ({_TWIN_LATEST})
      WHERE reported_timestamp IS NULL
         OR floor((epoch(CAST((SELECT max(ts) FROM events) AS TIMESTAMP)) - epoch(reported_timestamp)) / 86400) < 7""",

    "csas_changes": _CSAS,
    "ctas_counts": _CTAS,

    "store_all": _LB_ARRAY,
    "window_all": _DAILY,
    "store_get": f"SELECT * FROM ({_LB_ARRAY}) WHERE n_nationkey = 7",
    "store_count": f"SELECT count(*) AS n FROM ({_LB_ARRAY})",
    "window_range": f"""
      SELECT * FROM ({_DAILY})
      WHERE window_start BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'""",
    "window_key_range": f"""
      SELECT * FROM ({_DAILY})
      WHERE window_start BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'
        AND user_id = 7""",
    "pull_windowstart": f"""
      SELECT * FROM ({_CTAS}) WHERE key = '7|+|1' AND window_start = TIMESTAMP '2024-01-03 00:00:00'""",
}

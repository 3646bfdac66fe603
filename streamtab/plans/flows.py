"""The reference's flows with exact arrival semantics (E3-E6, J1, J4 grace, W6, T3-T5),
batch and streaming, on the driver's tables.

Arrival is shuffled (``arr``, ties by ``event_id``), so that rows do come late, table
updates come after rows that want them, and names change between rows.  ``b`` is the
input partition that stream time belongs to.  The streaming forms take the same
rows in ``SLICES`` micro-batches and carry state between them
(:mod:`streamtab.streaming.exact`).  The SQL of each is below it, written from the semantics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..operators import joins, stateless as st, tables, topk, windows as win
from ..operators import state as twin_ops
from ..session import scratch_path
from ..sources.declared import declare_stream, format_time
from ..streaming import exact
from ..streaming.sources import arrivals
from . import catalog as C
from .oracle import K, _TWIN_INPUTS

SLICES = 3
ORDER = ["arr", "event_id"]
JOIN_GRACE_S = 3600
CHANGE_GRACE = "10 minutes"
RETENTION_DAYS = 2
VITALS_BOUND_S, VITALS_GRACE_S = 86400, 4 * 3600


def _arrived(spark, d) -> DataFrame:
    return C._shuffled_arrival(C._t(spark, d).events)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


_ARRIVED = f"""
  SELECT e.*, user_id % 4 AS b, event_id + ((event_id * 7919) % 50) * 4 AS arr,
         (event_id + ((event_id * 7919) % 50) * 4) * 1000000000 + event_id AS pos
  FROM events e"""


# ---- J4 with grace ---------------------------------------------------------------------

def _click_side(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    clicks = e.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"), "b", *ORDER)
    purchases = e.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), F.col("user_id").alias("p_user_id"), F.col("ts").alias("purchase_ts"), "b", *ORDER)
    return clicks, purchases


def _joined_clicks(j: DataFrame) -> DataFrame:
    return j.select("click_id", "purchase_id", "user_id", "click_ts", "purchase_ts", joins.joined_time("click_ts", "purchase_ts").alias("joined_ts"))


def interval_join_grace(spark, d):  # J4
    clicks, purchases = _click_side(_arrived(spark, d))
    return _joined_clicks(joins.interval_join_grace(clicks, purchases, "user_id", "click_ts", "purchase_ts", C.CLICK_PURCHASE_BOUND_S,
                                                    JOIN_GRACE_S, ["b"], ORDER, right_key="p_user_id"))


def stream_interval_join_grace(spark, d):  # J4, buffer carried between batches
    s = arrivals(spark, _arrived(spark, d).select("event_id", "user_id", "event_type", "ts", "b", "arr"), "arr", SLICES)
    path = scratch_path(spark, "join-grace")
    buffer = exact.JoinBuffer(spark, path, "user_id", "p_user_id", "click_ts", "purchase_ts", C.CLICK_PURCHASE_BOUND_S, JOIN_GRACE_S, ["b"], ORDER)
    out = f"{path}/pairs"

    def body(rows, i):
        _joined_clicks(buffer.join(*_click_side(rows), i)).write.mode("overwrite").parquet(f"{out}/batch={i}")

    exact.run_batches(spark, s, "join-grace", body)
    return spark.read.parquet(f"{out}/batch=*")


_JOIN_GRACE = f"""
  WITH u AS (
    SELECT *, max(ts) OVER (PARTITION BY b ORDER BY arr, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st
    FROM ({_ARRIVED}) WHERE event_type IN ('click', 'purchase')),
  k AS (SELECT * FROM u WHERE ts + INTERVAL 7 HOUR >= st)
  SELECT c.event_id AS click_id, p.event_id AS purchase_id, c.user_id, c.ts AS click_ts, p.ts AS purchase_ts, greatest(c.ts, p.ts) AS joined_ts
  FROM k c JOIN k p ON c.user_id = p.user_id AND p.ts BETWEEN c.ts - INTERVAL 6 HOUR AND c.ts + INTERVAL 6 HOUR
  WHERE c.event_type = 'click' AND p.event_type = 'purchase'"""


# ---- E3: leaderboard with the players table as of each score's arrival --------------------

def _scores(e: DataFrame) -> DataFrame:
    return e.where(F.col("event_type") == "click").select(
        "user_id", *ORDER, F.pmod(C._k(), F.lit(25)).alias("product_id"), F.col("value").alias("score"))


def _players(e: DataFrame) -> DataFrame:
    """The players' changelog: signups name or rename a player, errors delete one."""
    return e.where(F.col("event_type").isin("signup", "error")).select(
        "user_id", *ORDER, F.concat(F.lit("player-"), F.col("event_id")).alias("name"), (F.col("event_type") == "error").alias("dead"))


def _board(top: DataFrame, nations: DataFrame) -> DataFrame:
    out = joins.global_table_join(top, nations, top["product_id"] == nations["n_nationkey"])
    return out.select("n_nationkey", "n_name", "rank", "event_id", "user_id", F.col("t_name").alias("player_name"), "score")


def leaderboard_asof(spark, d):  # E3: J1 at arrival, J3, A8
    e = _arrived(spark, d)
    named = tables.asof_lookup(_scores(e), _players(e), "user_id", ORDER, ["name"], tombstone=F.col("dead"))
    nations = C._t(spark, d).nation.select("n_nationkey", "n_name")
    scored = joins.global_table_join(named, nations.select(F.col("n_nationkey").alias("known")), F.col("product_id") == F.col("known"))
    top = topk.top_k_distinct(scored.select("product_id", "score", *ORDER, "user_id", "t_name"), ["product_id"], "score", ORDER, 3)
    return _board(top, nations)


def stream_leaderboard_asof(spark, d):  # E3: table updates and scores in one stream, state carried
    s = arrivals(spark, _arrived(spark, d).select("event_id", "user_id", "event_type", "value", "props", "arr"), "arr", SLICES)
    path = scratch_path(spark, "board")
    players = exact.TableCarry(spark, f"{path}/players", "user_id", ORDER, ["name"])
    board = exact.TopK(spark, f"{path}/board", ["product_id"], "score", ORDER, 3)
    nations = C._t(spark, d).nation.select("n_nationkey", "n_name")

    def body(rows, i):
        changes = _players(rows)
        named = players.asof(_scores(rows), changes, i)
        known = joins.global_table_join(named, nations, F.col("product_id") == F.col("n_nationkey"))
        board.commit(i, known.select("product_id", "score", *ORDER, "user_id", "t_name"))
        players.commit(i, changes)

    exact.run_batches(spark, s, "board", body)
    return _board(board.read(), nations)


_BOARD = f"""
  WITH a AS ({_ARRIVED}),
  s AS (SELECT user_id, arr, event_id, pos, ({K} % 25 + 25) % 25 AS product_id, value AS score FROM a WHERE event_type = 'click'),
  p AS (SELECT user_id AS pid, pos AS ppos, 'player-' || event_id AS name, event_type FROM a WHERE event_type IN ('signup', 'error')),
  j AS (SELECT s.*, p.name FROM s ASOF JOIN p ON s.user_id = p.pid AND s.pos > p.ppos WHERE p.event_type = 'signup'),
  f AS (SELECT j.*, n_nationkey, n_name FROM j JOIN nation ON product_id = n_nationkey
        QUALIFY row_number() OVER (PARTITION BY n_nationkey, score ORDER BY arr, event_id) = 1)
  SELECT n_nationkey, n_name, CAST(row_number() OVER (PARTITION BY n_nationkey ORDER BY score DESC) AS INTEGER) AS rank,
         event_id, user_id, name AS player_name, score
  FROM f QUALIFY rank <= 3"""


# ---- E6: change monitoring, titles as of arrival, late rows, retention ----------------------

def _changes(e: DataFrame) -> DataFrame:
    """S5 and the CSAS: season-length changes as a declared stream."""
    ep, k = F.floor("value").cast("int"), F.col("__k")
    raw = e.where(F.col("event_type").isin("view", "click")).withColumn("__k", C._k()).select(
        *ORDER, "b", F.col("user_id").alias("title_id"),
        F.when(F.col("event_type") == "view", "season_length").otherwise("release_date").alias("change_type"),
        fx.make_struct(season_id=k % 3, episode_count=ep % 13).alias("before"),
        F.when(F.col("event_id") % 4 != 0, fx.make_struct(season_id=k % 3, episode_count=(ep + k) % 13)).alias("after"),
        format_time("ts").alias("created_at"))
    s = declare_stream(raw, key="title_id", timestamp="created_at")
    return st.keep(s, "change_type = 'season_length'").select(
        *ORDER, "b", "title_id", fx.ifnull(fx.field("after", "season_id"), fx.field("before", "season_id")).alias("season_id"),
        fx.field("after", "episode_count").alias("new_episode_count"), "event_ts")


def _titles(e: DataFrame) -> DataFrame:
    return e.where(F.col("event_type").isin("signup", "error")).select(
        F.col("user_id").alias("title_id"), *ORDER, F.concat(F.lit("title-"), F.col("event_id")).alias("title"),
        (F.col("event_type") == "error").alias("dead"))


_CHANGE_KEYS = ["title_id", "season_id"]


def _change_aggs() -> dict:
    at = F.struct(*ORDER)
    last = lambda c: F.max_by(F.struct(*ORDER, F.col(c).alias("v")), F.when(F.col(c).isNotNull(), at))
    again = lambda c: F.max_by(c, F.struct(F.col(c)["arr"], F.col(c)["event_id"]))
    return {"change_count": (F.count(F.lit(1)), F.sum("change_count")),
            "last_title": (last("t_title"), again("last_title")), "last_count": (last("new_episode_count"), again("last_count"))}


def _change_result(counts: DataFrame) -> DataFrame:
    return counts.select(*_CHANGE_KEYS, "window_start", "window_end", F.col("last_title.v").alias("title"), "change_count",
                         F.col("last_count.v").alias("episode_count"),
                         F.concat_ws("|+|", F.col("title_id").cast("string"), F.col("season_id").cast("string")).alias("key"))


def change_monitoring(spark, d):  # E6: S5, CSAS, J1 at arrival, W2, A3-A5, W6
    e = _arrived(spark, d)
    named = tables.asof_lookup(_changes(e), _titles(e), "title_id", ORDER, ["title"], tombstone=F.col("dead"))
    marked = win.settled(win.mark_late(named, ["b"], ORDER, "event_ts", C.DAY, CHANGE_GRACE))    # read twice below
    counts = marked.where(~F.col("is_late")).groupBy(*_CHANGE_KEYS, "window_start", "window_end").agg(
        *[a.alias(n) for n, (a, _) in _change_aggs().items()])
    return win.retained(_change_result(counts), win.max_of(marked, "stream_time"), f"{RETENTION_DAYS} days")


def stream_change_monitoring(spark, d):  # E6: versioned titles, stream time and result between batches
    s = arrivals(spark, _arrived(spark, d), "arr", SLICES)
    path = scratch_path(spark, "changes")
    titles = exact.TableCarry(spark, f"{path}/titles", "title_id", ORDER, ["title"])
    time = exact.StreamTime(spark, f"{path}/time", ["b"])
    result = exact.WindowCounts(spark, f"{path}/counts", _CHANGE_KEYS, _change_aggs(), RETENTION_DAYS)

    def body(rows, i):
        log = _titles(rows)
        named = win.settled(titles.asof(_changes(rows), log, i))
        marked = time.mark_late(named, i, ORDER, "event_ts", C.DAY, CHANGE_GRACE)
        now = time.of(named, "event_ts")
        before = time.prior(i)
        result.commit(i, marked.where(~F.col("is_late")), times=now if before is None else now.unionByName(before))
        time.commit(i, now)
        titles.commit(i, log)

    exact.run_batches(spark, s, "changes", body)
    end = F.timestamp_micros(time.store.read().select(F.max("st_us")).scalar()).cast("timestamp_ntz")
    return win.retained(_change_result(result.read()), end, f"{RETENTION_DAYS} days")


_MONITORING = f"""
  WITH a AS ({_ARRIVED}),
  c AS (SELECT arr, event_id, pos, b, user_id AS title_id, {K} % 3 AS season_id,
               CASE WHEN event_id % 4 <> 0 THEN (CAST(floor(value) AS INTEGER) + {K}) % 13 END AS new_episode_count,
               date_trunc('second', ts) AS event_ts FROM a WHERE event_type = 'view'),
  t AS (SELECT user_id AS id, pos AS tpos, 'title-' || event_id AS title, event_type FROM a WHERE event_type IN ('signup', 'error')),
  j AS (SELECT c.*, t.title FROM c ASOF JOIN t ON c.title_id = t.id AND c.pos > t.tpos WHERE t.event_type = 'signup'),
  m AS (SELECT *, max(event_ts) OVER (PARTITION BY b ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time,
               time_bucket(INTERVAL 1 DAY, event_ts, TIMESTAMP '1970-01-01') AS window_start FROM j)
  SELECT title_id, season_id, window_start, window_start + INTERVAL 1 DAY AS window_end, arg_max(title, pos) AS title,
         count(*) AS change_count, arg_max(new_episode_count, CASE WHEN new_episode_count IS NOT NULL THEN pos END) AS episode_count,
         CAST(title_id AS VARCHAR) || '|+|' || CAST(season_id AS VARCHAR) AS key
  FROM m WHERE window_start + INTERVAL 1 DAY > stream_time - INTERVAL 10 MINUTE
    AND window_start + INTERVAL 1 DAY > (SELECT max(stream_time) FROM m) - INTERVAL 2 DAY
  GROUP BY title_id, season_id, window_start"""


# ---- E4: vitals, whole -----------------------------------------------------------------------

def _pulses(e: DataFrame) -> DataFrame:
    """Every 7th pulse carries no time of its own and takes its partition's."""
    raw = e.select("user_id", "b", *ORDER, F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts_raw"))
    return win.event_time_with_fallback(raw, ["b"], ORDER, "ts_raw", "ts").where(F.col("ts").isNotNull())


def vitals_monitoring(spark, d):  # E4: F7, W2, A4, W4, P2, P9, J4 with grace
    e = _arrived(spark, d).select("event_id", "user_id", "ts", "value", "b", "arr")
    marked = win.settled(win.mark_late(_pulses(e), ["b"], ORDER, "ts", C.DAY, C.GRACE))      # read twice below
    counts = marked.where(~F.col("is_late")).groupBy("b", "user_id", "window_start", "window_end").agg(
        F.count(F.lit(1)).alias("heart_rate"), F.max("ts").alias("beat_ts"))
    closed = win.window_closings(marked.drop("window_start", "window_end"), ["b"], ORDER, "ts", C.DAY, C.GRACE)
    high = st.keep(counts.join(joins.broadcast_if_small(closed), ["b", "window_end"]), F.col("heart_rate") >= C.HIGH_COUNT).drop("window_end")
    temps = st.keep(e, F.col("value") > C.HIGH_VALUE).select(
        F.col("event_id").alias("temp_id"), F.col("user_id").alias("t_user_id"), F.col("ts").alias("temp_ts"), "value", "b", *ORDER)
    j = joins.interval_join_grace(high, temps, "user_id", "beat_ts", "temp_ts", VITALS_BOUND_S, VITALS_GRACE_S, ["b"], ORDER, right_key="t_user_id")
    return j.select("user_id", "window_start", "heart_rate", F.col("temp_id").alias("event_id"), "value",
                    joins.joined_time("beat_ts", "temp_ts").alias("alert_ts"))


_VITALS = f"""
  WITH a AS ({_ARRIVED}),
  f AS (SELECT user_id, b, arr, event_id, pos, coalesce(CASE WHEN event_id % 7 <> 0 THEN ts END,
               max(CASE WHEN event_id % 7 <> 0 THEN ts END) OVER (PARTITION BY b ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS ts FROM a),
  s AS (SELECT *, max(ts) OVER (PARTITION BY b ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st,
               time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start FROM f WHERE ts IS NOT NULL),
  c AS (SELECT b, user_id, window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS heart_rate, max(ts) AS beat_ts
        FROM s WHERE window_start + INTERVAL 1 DAY > st - INTERVAL 2 HOUR GROUP BY b, user_id, window_start HAVING count(*) >= 4),
  ends AS (SELECT DISTINCT b, window_end FROM c),
  closed AS (SELECT ends.b, ends.window_end, min(s.pos) AS pos FROM ends JOIN s ON s.b = ends.b AND s.st >= ends.window_end + INTERVAL 2 HOUR GROUP BY ALL),
  u AS (SELECT 0 AS side, c.b, closed.pos, c.user_id, beat_ts AS ts, window_start, heart_rate, NULL AS event_id, NULL AS value
        FROM c JOIN closed ON c.b = closed.b AND c.window_end = closed.window_end
        UNION ALL
        SELECT 1, b, pos, user_id, ts, NULL, NULL, event_id, value FROM a WHERE value > 150),
  k AS (SELECT * FROM (SELECT *, max(ts) OVER (PARTITION BY b ORDER BY pos, side RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mx,
               max(ts) OVER (PARTITION BY b ORDER BY pos, side, ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st FROM u)
        WHERE ts + INTERVAL 28 HOUR >= mx)
  SELECT l.user_id, l.window_start, l.heart_rate, r.event_id, r.value, greatest(l.ts, r.ts) AS alert_ts
  FROM k l JOIN k r ON l.side = 0 AND r.side = 1 AND l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL 1 DAY AND l.ts + INTERVAL 1 DAY"""


# ---- W2, J2, T1, Q11 as streams of several batches ---------------------------------------------

def stream_tumbling_grace(spark, d):  # W2: exact per record and partition
    s = arrivals(spark, _arrived(spark, d).select("event_id", "user_id", "ts", "b", "arr"), "arr", SLICES)
    path = scratch_path(spark, "grace")
    time = exact.StreamTime(spark, f"{path}/time", ["b"])
    counts = exact.WindowCounts(spark, f"{path}/counts", ["user_id"], {"n": (F.count(F.lit(1)), F.sum("n"))})

    def body(rows, i):
        marked = time.mark_late(rows, i, ORDER, "ts", C.DAY, C.GRACE)
        counts.commit(i, marked.where(~F.col("is_late")))
        time.commit(i, time.of(rows, "ts"))

    exact.run_batches(spark, s, "grace", body)
    return counts.read()


def stream_refining_exact(spark, d):  # A7, S13: every record emits the new count of its window
    s = arrivals(spark, C._t(spark, d).events.select("event_id", "user_id", "ts"), "event_id", SLICES)
    path = scratch_path(spark, "refining")
    counts = exact.WindowCounts(spark, f"{path}/counts", ["user_id"], {"n": (F.count(F.lit(1)), F.sum("n"))})

    def body(rows, i):
        log = win.refining_counts(rows, ["user_id"], ["event_id"], "ts", C.DAY)
        before = counts.store.read(before=i)
        if before is not None:
            old = before.select(F.col("user_id").alias("of"), F.col("window_start").alias("at"), F.col("n").alias("before"))
            log = log.join(old, F.col("user_id").eqNullSafe(F.col("of")) & (F.col("window_start") == F.col("at")), "left").withColumn(
                "running_count", F.col("running_count") + F.coalesce("before", F.lit(0)))
        log.select("event_id", "user_id", "window_start", "running_count").write.mode("overwrite").parquet(f"{path}/log/batch={i}")
        counts.commit(i, win.with_bounds(rows.withColumn("w", F.window("ts", C.DAY)), "w"))

    exact.run_batches(spark, s, "refining", body)
    return spark.read.parquet(f"{path}/log/batch=*").drop("batch")


def stream_late_rows(spark, d):  # W3: the side output
    s = arrivals(spark, _arrived(spark, d).select("event_id", "user_id", "ts", "b", "arr"), "arr", SLICES)
    path = scratch_path(spark, "late")
    time = exact.StreamTime(spark, f"{path}/time", ["b"])

    def body(rows, i):
        late = time.mark_late(rows, i, ORDER, "ts", C.DAY, C.GRACE).where("is_late")
        late.select("event_id", "user_id", "ts", "window_start", "stream_time").write.mode("overwrite").parquet(f"{path}/rows/batch={i}")
        time.commit(i, time.of(rows, "ts"))

    exact.run_batches(spark, s, "late", body)
    return spark.read.parquet(f"{path}/rows/batch=*").drop("batch")


def stream_ctas_exact(spark, d):  # E6 on a fixed titles table, exact grace
    t = C._t(spark, d)
    titles = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    s = arrivals(spark, C._season_length_changes(spark, d).withColumn("b", F.col("title_id") % C.PARTITIONS), "uuid", SLICES)
    path = scratch_path(spark, "ctas")
    time = exact.StreamTime(spark, f"{path}/time", ["b"])
    last = F.struct("uuid", F.col("new_episode_count").alias("v"))
    counts = exact.WindowCounts(spark, f"{path}/counts", _CHANGE_KEYS, {
        "title": (F.max("title"), F.max("title")), "change_count": (F.count(F.lit(1)), F.sum("change_count")),
        "last": (F.max_by(last, F.when(F.col("new_episode_count").isNotNull(), F.col("uuid"))), F.max_by("last", "last.uuid"))})

    def body(rows, i):
        s = declare_stream(rows, timestamp="created_at")
        en = win.settled(joins.stream_table_join(s, titles, s["title_id"] == titles["id"]).drop("id"))
        counts.commit(i, time.mark_late(en, i, ["uuid"], "event_ts", C.DAY, CHANGE_GRACE).where(~F.col("is_late")))
        time.commit(i, time.of(en, "event_ts"))

    exact.run_batches(spark, s, "ctas", body)
    return counts.read().select("title_id", "season_id", "window_start", "window_end", "title", "change_count", F.col("last.v").alias("episode_count"),
                                F.concat_ws("|+|", F.col("title_id").cast("string"), F.col("season_id").cast("string")).alias("key"))


def stream_asof_join(spark, d):  # J1/J2: table updates arrive while the job runs
    s = arrivals(spark, C._t(spark, d).events.select("event_id", "user_id", "event_type", "value"), "event_id", SLICES)
    path = scratch_path(spark, "asof")
    table = exact.TableCarry(spark, f"{path}/table", "user_id", ["event_id"], ["value"])

    def body(rows, i):
        log = rows.where(F.col("event_type").isin("signup", "error")).withColumn("dead", F.col("event_type") == "error")
        sales = rows.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")
        table.asof(sales, log, i).write.mode("overwrite").parquet(f"{path}/out/batch={i}")
        table.commit(i, log)

    exact.run_batches(spark, s, "asof", body)
    return spark.read.parquet(f"{path}/out/batch=*").select("event_id", "user_id", "value", "t_event_id", "t_value")


# ---- E5: device twin between batches ------------------------------------------------------------

_TWIN_ORDER = ["event_id", "emit_idx"]


def _twin_inputs(e: DataFrame) -> DataFrame:
    power = F.when(C._k() % 2 == 0, F.lit(twin_ops.POWER_ON)).otherwise(F.lit(twin_ops.POWER_OFF))
    base = e.where(F.col("event_type").isin("view", "signup")).select(
        F.col("user_id").alias("key"), "event_id", F.col("ts").alias("timestamp"), power.alias("power"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("wind_speed_mph"), F.col("event_type"))
    rep, des = (base.where(F.col("event_type") == t).drop("event_type") for t in ("view", "signup"))
    return twin_ops.twin_inputs(rep, des)


def _stream_twin(spark, d, name: str, ttl: bool) -> DataFrame:
    e = C._t(spark, d).events.select("event_id", "user_id", "event_type", "ts", "value", "props")
    s = arrivals(spark, e, "event_id", SLICES)
    path = scratch_path(spark, name)
    twins = exact.TwinCarry(spark, f"{path}/twins", "key", _TWIN_ORDER, C.TWIN_STATE)
    time = exact.StreamTime(spark, f"{path}/time", ["all"])

    def body(rows, i):
        inputs = win.settled(_twin_inputs(rows))
        C._flat_twin(twins.changelog(inputs, i), "key", *_TWIN_ORDER).write.mode("overwrite").parquet(f"{path}/log/batch={i}")
        now = None
        if ttl:                                          # T4: stream time at the end of the batch
            time.commit(i, time.of(inputs.withColumn("all", F.lit(0)), "timestamp"))
            now = F.timestamp_micros(F.lit(time.store.read(before=i + 1).first()["st_us"])).cast("timestamp_ntz")
        twins.commit(i, inputs, now)

    exact.run_batches(spark, s, name, body)
    return spark.read.parquet(f"{path}/log/batch=*").drop("batch")


def stream_twin_changelog(spark, d):  # T1 T2 P11
    return _stream_twin(spark, d, "twin", ttl=False)


def stream_twin_ttl(spark, d):  # T3-T5: devices expire at the end of a batch and start anew
    return _stream_twin(spark, d, "twin-ttl", ttl=True)


def _twin_ttl_sql(slices: int) -> str:
    """The device state from slice to slice, expired devices left out between them."""
    cols = "struct_pack(timestamp := timestamp, wind_speed_mph := wind_speed_mph, power := power)"
    parts = [f"""i AS (SELECT *, CAST(floor((event_id - (SELECT min(event_id) FROM events)) /
                   ((SELECT max(event_id) - min(event_id) FROM events) // {slices} + 1)) AS INTEGER) AS s FROM ({_TWIN_INPUTS}))""",
             "st0 AS (SELECT key, CAST(NULL AS STRUCT(timestamp TIMESTAMP, wind_speed_mph DOUBLE, power VARCHAR)) AS d,"
             " CAST(NULL AS STRUCT(timestamp TIMESTAMP, wind_speed_mph DOUBLE, power VARCHAR)) AS r FROM i WHERE false)"]
    for j in range(slices):
        side = lambda c, t: (f"SELECT key, -1, 0, {c}.timestamp, {c}.wind_speed_mph, {c}.power, '{t}' FROM st{j} WHERE {c} IS NOT NULL")  # noqa: E731,B023
        parts.append(f"""c{j} AS (SELECT key, event_id, emit_idx, timestamp, wind_speed_mph, power, type FROM i WHERE s = {j}
                         UNION ALL {side('d', 'DESIRED')} UNION ALL {side('r', 'REPORTED')})""")
        parts.append(f"""l{j} AS (SELECT key, event_id, emit_idx,
                           last_value(CASE WHEN type = 'DESIRED' THEN {cols} END IGNORE NULLS) OVER w AS d,
                           last_value(CASE WHEN type = 'REPORTED' THEN {cols} END IGNORE NULLS) OVER w AS r
                         FROM c{j} WINDOW w AS (PARTITION BY key ORDER BY event_id, emit_idx, type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
        parts.append(f"""st{j + 1} AS (SELECT key, d, r FROM (SELECT * FROM l{j}
                           QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id DESC, emit_idx DESC, r IS NULL, d IS NULL) = 1)
                         WHERE r IS NULL OR floor((epoch((SELECT max(timestamp) FROM i WHERE s <= {j})) - epoch(r.timestamp)) / 86400) < 7)""")
    flat = ", ".join(f"{c}.{f} AS {n}_{f}" for c, n in (("d", "desired"), ("r", "reported")) for f in ("timestamp", "wind_speed_mph", "power"))
    logs = " UNION ALL ".join(f"SELECT key, event_id, emit_idx, {flat} FROM l{j} WHERE event_id >= 0" for j in range(slices))
    return "WITH " + ",\n".join(parts) + f"\n{logs}"


QUERIES = {f.__name__: f for f in (interval_join_grace, leaderboard_asof, change_monitoring, vitals_monitoring)}
ORACLE_SQL = {"interval_join_grace": _JOIN_GRACE, "leaderboard_asof": _BOARD, "change_monitoring": _MONITORING, "vitals_monitoring": _VITALS}

STREAM_QUERIES = {f.__name__: f for f in (
    stream_interval_join_grace, stream_leaderboard_asof, stream_change_monitoring, stream_tumbling_grace, stream_late_rows, stream_refining_exact, stream_ctas_exact,
    stream_asof_join, stream_twin_changelog, stream_twin_ttl)}


def stream_oracles(batch: dict[str, str]) -> dict[str, str]:
    return {"stream_interval_join_grace": _JOIN_GRACE, "stream_leaderboard_asof": _BOARD, "stream_change_monitoring": _MONITORING,
            "stream_tumbling_grace": batch["tumbling_grace"], "stream_late_rows": batch["late_rows"], "stream_refining_exact": batch["tumbling_refining"],
            "stream_ctas_exact": batch["ctas_counts"],
            "stream_asof_join": batch["stream_table_asof"], "stream_twin_changelog": batch["twin_changelog"],
            "stream_twin_ttl": _twin_ttl_sql(SLICES)}


__all__ = ["QUERIES", "ORACLE_SQL", "STREAM_QUERIES", "stream_oracles"]

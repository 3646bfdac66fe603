"""Registered streaming queries (t3: stream = batch).

Each runs a real Structured Streaming job over a whole table (events and orders in
several micro-batches by arrival; ``availableNow``), writes to a sink below the shared
checkpoint folder and returns the sink's content.  Its oracle is the SQL of the
batch twin (restricted to closed windows where the stream emits only those).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import joins
from ..plans import catalog as C
from ..sources.declared import parse_time
from ..streaming import jobs, runner
from ..streaming.sources import arrivals, event_time, table_stream


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _events(spark, d, *cols) -> DataFrame:
    """The events in arrival order, as several micro-batches."""
    e = C._t(spark, d).events
    return arrivals(spark, e.select(*cols) if cols else e, "event_id")


def stream_greeting(spark, d):  # E1 S1 P12 Q9
    c = table_stream(spark, d, "customer")
    out = runner.run_append(spark, c.select("c_custkey", F.concat(F.lit("Hello, "), "c_name").alias("greeting")),
                            "greeting")
    return out


def stream_entity_sentiment(spark, d):  # E2 streaming: stateless flow, typed sink
    docs = table_stream(spark, d, "documents")
    return runner.run_append(spark, C.entity_sentiment_of(docs), "sentiment")


def stream_tumbling_final(spark, d):  # W1 W4 S11
    e = event_time(_events(spark, d, "event_id", "user_id", "ts")).drop("event_id")
    agg = jobs.windowed_final(e, ["user_id"], "ts", C.DAY, C.GRACE, [F.count(F.lit(1)).alias("n")])
    return _ntz(runner.run_append(spark, agg, "tumbling"), "window_start", "window_end")


def stream_hopping_final(spark, d):  # W7 streaming
    e = event_time(_events(spark, d, "event_id", "user_id", "ts")).drop("event_id")
    agg = jobs.windowed_final(e, ["user_id"], "ts", "2 days", C.GRACE, [F.count(F.lit(1)).alias("n")], slide=C.DAY)
    return _ntz(runner.run_append(spark, agg, "hopping"), "window_start", "window_end")


def stream_session_final(spark, d):  # W8 streaming (session_window, append)
    e = event_time(_events(spark, d, "event_id", "user_id", "ts")).drop("event_id")
    agg = jobs.session_final(e, ["user_id"], "ts", C.SESSION_GAP, C.GRACE, [F.count(F.lit(1)).alias("n")])
    return _ntz(runner.run_append(spark, agg, "sessions"), "window_start", "window_end")


def stream_tumbling_refining(spark, d):  # A7 S13 streaming: update mode changelog, last value per window
    e = event_time(_events(spark, d, "event_id", "user_id", "ts")).drop("event_id")
    agg = (e.groupBy("user_id", F.window("ts", C.DAY).alias("w")).agg(F.count(F.lit(1)).alias("n"))
             .select("user_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n"))
    final = runner.final_rows(runner.run_changelog(spark, agg, "refining"), ["user_id", "window_start"])
    return _ntz(final, "window_start", "window_end")


def stream_vitals_alerts(spark, d):  # E4 streaming: final windowed count -> filter -> interval join
    e = event_time(_events(spark, d, "event_id", "user_id", "ts", "value"))
    temps = e.select(
        "event_id", F.col("user_id").alias("r_key"), F.col("ts").alias("temp_ts"), "value")
    j = jobs.alerts_from_windows(e.select("user_id", "ts"), temps, "user_id", "ts", "temp_ts", C.DAY, C.GRACE,
                                 C.HIGH_COUNT, C.ALERT_BOUND_S, reading_keep=F.col("value") > C.HIGH_VALUE)
    j = j.select("user_id", "window_start", "heart_rate", "event_id", "value",
                 F.greatest("beat_ts", "temp_ts").alias("alert_ts"))
    return _ntz(runner.run_append(spark, j, "vitals"), "window_start", "alert_ts")


def stream_interval_join(spark, d):  # J4 streaming
    e = event_time(_events(spark, d, "event_id", "user_id", "event_type", "ts"))
    c = e.select(F.col("event_id").alias("click_id"), "user_id", F.col("event_type").alias("c_type"),
                                                        F.col("ts").alias("click_ts"))
    p = e.select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("p_user_id"),
                                                          F.col("event_type").alias("p_type"),
                                                          F.col("ts").alias("purchase_ts"))
    j = jobs.interval_join(c, p, "user_id", "p_user_id", "click_ts", "purchase_ts", C.CLICK_PURCHASE_BOUND_S,
                           "1 hour", "1 hour", F.col("c_type") == "click", F.col("p_type") == "purchase")
    j = j.select("click_id", "purchase_id", "user_id", "click_ts", "purchase_ts",
                 F.greatest("click_ts", "purchase_ts").alias("joined_ts"))
    return _ntz(runner.run_append(spark, j, "interval"), "click_ts", "purchase_ts", "joined_ts")


def stream_table_join_live(spark, d):  # J1 streaming, table re-read per batch (H7)
    e = _events(spark, d, "event_id", "user_id", "value")

    def load():
        return C._t(spark, d).customer.select("c_custkey", "c_name", "c_mktsegment")

    body = jobs.live_table_join(load, lambda b, t: b["user_id"] == t["c_custkey"])
    out = runner.run_foreach_batch(spark, e, "live-join", body)
    return spark.read.parquet(f"{out}/batch=*").select("event_id", "user_id", "c_name", "c_mktsegment", "value")


def stream_latest_table(spark, d):  # S3 T6 S13 streaming
    e = _events(spark, d)
    lt = jobs.latest_table(e, ["user_id"], ["event_id"], ["event_type", "value"], F.col("event_type") == "error")
    final = runner.final_rows(runner.run_changelog(spark, lt, "latest"), ["user_id"])
    return final.where(~F.col("deleted")).drop("deleted")


def stream_leaderboard(spark, d):  # A8 E3 streaming (transformWithState)
    runner.use_rocksdb(spark)
    t = C._t(spark, d)
    o = arrivals(spark, t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    en = (o.join(c, o["o_custkey"] == c["c_custkey"]).join(joins.broadcast_if_small(n), F.col("c_nationkey") == n["n_nationkey"])
           .select("n_nationkey", F.col("o_totalprice").alias("score"), F.col("o_orderkey").alias("seq"),
                   "n_name", "o_custkey", "c_name"))
    payload = T.StructType([en.schema["n_name"], en.schema["o_custkey"], en.schema["c_name"]])
    top = jobs.top_k(en, ["n_nationkey"], payload, 3)
    final = runner.final_rows(runner.run_changelog(spark, top, "leaderboard"), ["n_nationkey"])
    return final.select("n_nationkey", "n_name", "rank", F.col("seq").alias("o_orderkey"), "o_custkey", "c_name",
                        F.col("score").alias("o_totalprice"))


def stream_ctas_counts(spark, d):  # Q11 E6 streaming: chained join -> windowed count + latest-by-offset
    t = C._t(spark, d)
    e = _events(spark, d)
    k = C._k()
    ep = F.floor("value").cast("int")
    s = e.where(F.col("event_type") != "purchase").select(
        F.col("event_id").alias("uuid"), F.col("user_id").alias("title_id"),
        (k % 3).alias("season_id"),
        F.when(F.col("event_id") % 4 != 0, (ep + k) % 13).alias("new_episode_count"),
        parse_time(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).cast("timestamp").alias("event_ts"))
    titles = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    enriched = s.join(titles, s["title_id"] == titles["id"]).drop("id")
    agg = jobs.windowed_final(
        enriched, ["title_id", "season_id"], "event_ts", C.DAY, "10 minutes",
        [F.any_value("title").alias("title"), F.count(F.lit(1)).alias("change_count"),
         F.max_by("new_episode_count", F.when(F.col("new_episode_count").isNotNull(), F.col("uuid")))
          .alias("episode_count")])
    agg = agg.withColumn("key", F.concat_ws("|+|", F.col("title_id").cast("string"), F.col("season_id").cast("string")))
    # every window, open ones too: update mode, the last value of each (the watermark only frees closed windows)
    final = runner.final_rows(runner.run_changelog(spark, agg, "ctas"), ["title_id", "season_id", "window_start"])
    return _ntz(final, "window_start", "window_end")


STREAM_QUERIES = {f.__name__: f for f in [
    stream_greeting, stream_entity_sentiment, stream_tumbling_final, stream_hopping_final, stream_session_final, stream_tumbling_refining,
    stream_vitals_alerts, stream_interval_join, stream_table_join_live,
    stream_latest_table, stream_leaderboard, stream_ctas_counts,
]}


def _stream_oracles() -> dict[str, str]:
    from .oracle import DAY_BUCKET, ORACLE_SQL as O, _CTAS
    hop_closed = f"""
      SELECT * FROM ({O['hopping_count']})
      WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR"""
    del DAY_BUCKET
    return {
        "stream_greeting": O["greet_projection"],
        "stream_entity_sentiment": O["entity_sentiment"],
        "stream_tumbling_final": O["tumbling_final"],
        "stream_hopping_final": hop_closed,
        "stream_session_final": f"""
      SELECT * FROM ({O['session_count']})
      WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
        "stream_tumbling_refining": O["tumbling_count"],
        "stream_vitals_alerts": f"""
      SELECT * FROM ({O['vitals_alerts']})
      WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
        "stream_interval_join": O["interval_join"],
        "stream_table_join_live": O["stream_table_join"],
        "stream_latest_table": O["latest_table_tombstones"],
        "stream_leaderboard": O["leaderboard_top3"],
        "stream_ctas_counts": _CTAS,
    }


STREAM_ORACLE_SQL = _stream_oracles()

"""Registered queries on the driver's test tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` over whole tables.  The mapping
of the reference's flows onto the test data is fixed here once:

* offset (arrival position) := ``event_id``;
* input partition of a stream := ``user_id % 4`` (the reference's topics have 4
  partitions), used where stream time is per partition;
* shuffled arrival for lateness tests := ``event_id + (event_id*7919 % 50)*4``;
* day-sized windows and hour-sized join bounds (about 67 events per user and month).

Computed columns carry the same aliases as the SQL in :mod:`.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as fx
from ..operators import joins, lookups, stateless as st, tables, topk, windows as win
from ..operators import state as twin
from ..operators.store import day_of
from ..session import scratch_path
from ..sources import json_codec as jc
from ..sources import sinks
from ..sources.declared import declare_stream, format_time, parse_time
from ..sources.tables import Tables, fingerprint

# ---- fixed parameters of the test-data mapping --------------------------------
TRACKED_ENTITIES = ("the", "der", "la", "el")   # tracked tokens (the reference tracks coin names)
RETWEET_SOURCE = "src1"                          # documents from this source play "retweets"
PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])
PARTITIONS = 4
DAY = "1 day"
GRACE = "2 hours"
RETENTION = "2 days"
HIGH_COUNT = 4            # "high heart rate": events per user and day
HIGH_VALUE = 150.0        # "high temperature"
ALERT_BOUND_S = 3600      # join bound of the alert join
CLICK_PURCHASE_BOUND_S = 6 * 3600
VIEW_ALERT_VALUE = 100.0
SESSION_GAP = "2 hours"
SLIDING_SIZE = "1 hour"
RANGE_FROM, RANGE_TO = "2024-01-10 00:00:00", "2024-01-12 00:00:00"
LOOKUP_USER = 7
LOOKUP_NATION = 7
PULL_KEY, PULL_START = "7|+|1", "2024-01-03 00:00:00"


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _k():
    return F.from_json("props", PROPS_SCHEMA)["k"]


# ---- sources / sinks ----------------------------------------------------------------

def greet_projection(spark, d):  # E1 P12 P1
    c = _t(spark, d).customer
    return st.project(st.greet(c, "c_name"), "c_custkey", "greeting")


def json_decode_project(spark, d):  # S6 P1 F11
    e = _t(spark, d).events
    return st.map_values(e.select("event_id", fx.as_key("user_id").alias("key"), "props"),
                         k=jc.decode("props", PROPS_SCHEMA)["k"]).drop("props")


def keyed_text_decode(spark, d):  # S8 S6
    e = _t(spark, d).events
    lines = e.select("event_id", F.concat_ws("|", F.col("user_id").cast("string"), "props").alias("value"))
    return jc.decode_keyed_text(lines, PROPS_SCHEMA, key_type="long", keep=["event_id"])


def declared_stream(spark, d):  # S5 F12
    e = _t(spark, d).events
    txt = e.select("event_id", "user_id", format_time("ts").alias("created_at"))
    return declare_stream(txt, key="user_id", timestamp="created_at").select("event_id", "rowkey", "created_at", "event_ts")


def json_encode_roundtrip(spark, d):  # S7 S6
    e = _t(spark, d).events
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    enc = e.select(jc.encode("event_id", "user_id", "event_type", "value").alias("json"))
    return enc.select(jc.decode("json", schema).alias("r")).select("r.*")


def malformed_split(spark, d):  # S9
    e = _t(spark, d).events
    bad = e.select(F.when(F.col("event_id") % 10 == 0,
                          F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props")).alias("p"))
    flagged = jc.with_corrupt_flag(bad, "p", PROPS_SCHEMA)
    return (flagged.groupBy(F.when(F.col("is_malformed"), "bad").otherwise("good").alias("status"))
                   .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("parsed.k").cast("long")).alias("k_sum")))


def sink_roundtrip(spark, d):  # S10 S11 S12 S14 S16
    e = _t(spark, d).events
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))      # as wide as the cluster's shuffles
    return sinks.write_and_reread(spark, e, scratch_path(spark, "sink"), schema, n, "user_id")


# ---- stateless ----------------------------------------------------------------------

def filter_not_error(spark, d):  # P2 P3 P4
    e = _t(spark, d).events
    kept = st.drop_where(e, F.col("event_type") == "error")
    return st.keep(kept, "value > 100").select("event_id", "user_id", "event_type", "value")


def branch_first_match(spark, d):  # P5
    doc = _t(spark, d).documents.select("lang", "n_chars")
    tagged = doc.withColumn("branch", st.branch_id(F.col("lang") == "en", F.col("n_chars") > 5000,
                                                   F.col("lang").isin("fr", "de")))
    return (tagged.where(F.col("branch").isNotNull()).groupBy("branch")
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")))


def _merged_documents(doc: DataFrame) -> DataFrame:
    """E2 front half: branch by language, translate the non-English branch, merge."""
    return st.branch_map(doc, [F.col("lang") == "en", F.col("lang") != "en"],
                         translated=[F.lit(False), F.lit(True)],
                         text=[F.col("text"), F.concat(F.lit("Translated: "), F.col("text"))])


def branch_translate_merge(spark, d):  # P5 P7 P6
    doc = _t(spark, d).documents.select("doc_id", "lang", "text")
    m = _merged_documents(doc)
    return m.select("doc_id", "lang", "translated", F.length("text").alias("text_len"),
                    F.md5(F.col("text").cast("binary")).alias("text_md5"))


def entity_flatmap(spark, d):  # P8 F4 F5
    doc = _t(spark, d).documents.select("doc_id", "text")
    ex = st.flat_map(doc.select("doc_id", fx.tokens("text").alias("toks")), "toks", "entity", "pos",
                     keep=lambda t: fx.tracked(t, TRACKED_ENTITIES))
    return ex.select("doc_id", "pos", "entity")


def entity_sentiment(spark, d):  # E2: P3 P5 P7 P6 P8 F4-F6
    return entity_sentiment_of(_t(spark, d).documents)


def entity_sentiment_of(documents: DataFrame) -> DataFrame:
    """The E2 flow on a documents frame (batch or streaming)."""
    doc = documents.select("doc_id", "text", "lang", "source")
    kept = st.drop_where(doc, F.col("source") == RETWEET_SOURCE)
    m = _merged_documents(kept.select("doc_id", "lang", "text"))
    toks = m.select(F.col("doc_id").alias("id"), F.md5(F.col("text").cast("binary")).alias("text_md5"),
                    fx.tokens("text").alias("toks"))
    ex = st.flat_map(toks, "toks", "entity", "pos", keep=lambda t: fx.tracked(t, TRACKED_ENTITIES)).drop("toks")
    return ex.select("id", "pos", "entity", "text_md5", *[c.alias(n) for n, c in fx.sentiment_scores("id", "pos").items()])


def rekey_group_count(spark, d):  # P10 A2 A4
    e = _t(spark, d).events
    return st.select_key(e, "event_type").groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def conditional_emit(spark, d):  # P11 F9
    e = _t(spark, d).events.select("event_id", "event_type", "user_id", "value")
    cond = (F.col("event_type") == "view") & (F.col("value") > VIEW_ALERT_VALUE)
    return st.emit_with_derived(e, cond, {"event_type": F.lit("alert")})


# ---- tables and joins ------------------------------------------------------------------

def latest_table(spark, d):  # S3 D2
    e = _t(spark, d).events
    return tables.latest(e, "user_id", "event_id", ["event_type", "value"], tombstone=F.lit(False))


def latest_table_tombstones(spark, d):  # S3 T6
    e = _t(spark, d).events
    return tables.latest(e, "user_id", "event_id", ["event_type", "value"],
                         tombstone=F.col("event_type") == "error")


def stream_table_join(spark, d):  # J1 J6
    t = _t(spark, d)
    e = t.events.select("event_id", "user_id", "value")
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return joins.stream_table_join(e, c, e["user_id"] == c["c_custkey"]).select(
        "event_id", "user_id", "c_name", "c_mktsegment", "value")


def stream_table_asof(spark, d):  # J2
    e = _t(spark, d).events
    purchases = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")
    changelog = e.where(F.col("event_type").isin("signup", "error")).select("event_id", "user_id", "event_type", "value")
    return tables.asof_lookup(purchases, changelog, "user_id", ["event_id"], ["value"],
                              tombstone=F.col("event_type") == "error")


def global_table_join(spark, d):  # J3 S4
    t = _t(spark, d)
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    cn = joins.global_table_join(c, n, c["c_nationkey"] == n["n_nationkey"])
    return joins.global_table_join(cn, r, cn["n_regionkey"] == r["r_regionkey"]).select(
        "c_custkey", "c_name", "n_name", "r_name")


def table_table_join(spark, d):  # J5
    e = _t(spark, d).events
    v = tables.latest(e.where(F.col("event_type") == "view"), "user_id", "event_id", ["value"], F.lit(False))
    p = tables.latest(e.where(F.col("event_type") == "purchase"), "user_id", "event_id", ["value"], F.lit(False))
    v = v.select("user_id", F.col("event_id").alias("view_event_id"), F.col("value").alias("view_value"))
    p = p.select("user_id", F.col("event_id").alias("purchase_event_id"), F.col("value").alias("purchase_value"))
    return tables.table_join(v, p, "user_id")


def interval_join(spark, d):  # J4 J6
    e = _t(spark, d).events
    c = e.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"))
    p = e.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), F.col("user_id").alias("p_user_id"), F.col("ts").alias("purchase_ts"))
    j = joins.interval_join(c, p, "user_id", "click_ts", "purchase_ts", CLICK_PURCHASE_BOUND_S,
                            right_key="p_user_id")
    return j.select("click_id", "purchase_id", "user_id", "click_ts", "purchase_ts",
                    joins.joined_time("click_ts", "purchase_ts").alias("joined_ts"))


# ---- leaderboard (E3) ----------------------------------------------------------------

def leaderboard_top3(spark, d):  # A8 E3
    """Scores keyed by nation; the tie-collapsing aggregate and the top-k run
    on fixed-width columns (hash aggregate with map-side combine), names are
    attached afterwards to at most 3 rows per nation."""
    t = _t(spark, d)
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    c = t.customer.select("c_custkey", "c_nationkey")
    scored = joins.stream_table_join(o, c, o["o_custkey"] == c["c_custkey"]).select(
        F.col("c_nationkey").alias("n_nationkey"), "o_orderkey", "o_custkey", "o_totalprice")
    bounds = topk.score_bounds(scored, ["n_nationkey"], "o_totalprice", ["o_orderkey"], 3)
    top = topk.top_k_distinct(scored, ["n_nationkey"], "o_totalprice", ["o_orderkey"], 3, bounds=bounds)
    names = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    nations = t.nation.select("n_nationkey", "n_name")
    out = top.join(names, "o_custkey").join(joins.broadcast_if_small(nations), "n_nationkey")
    return out.select("n_nationkey", "n_name", "rank", "o_orderkey", "o_custkey", "c_name", "o_totalprice")


def leaderboard_array(spark, d):  # A9 A6
    top = leaderboard_top3(spark, d)
    arr = topk.as_sorted_list(top, ["n_nationkey"], ["o_orderkey", "c_name", "o_totalprice"])
    return arr.select("n_nationkey", F.to_json("entries").alias("entries"))


# ---- windows (E4 / E6 building blocks) -------------------------------------------------

def _daily_counts(e: DataFrame, extra=()) -> DataFrame:
    return win.windowed(e, ["user_id"], "ts", DAY, [F.count(F.lit(1)).alias("n"), *extra])


def tumbling_count(spark, d):  # W1 A1 A4 W5
    return _daily_counts(_t(spark, d).events.select("user_id", "ts"))


def tumbling_final(spark, d):  # W4
    e = _t(spark, d).events
    return win.closed_windows(_daily_counts(e.select("user_id", "ts")), win.max_of(e, "ts"), GRACE)


def tumbling_refining(spark, d):  # A7 S13
    e = _t(spark, d).events.select("event_id", "user_id", "ts")
    r = win.refining_counts(e, ["user_id"], ["event_id"], "ts", DAY)
    return r.select("event_id", "user_id", "window_start", "running_count")


def _shuffled_arrival(e: DataFrame) -> DataFrame:
    return (e.withColumn("arr", F.col("event_id") + (F.col("event_id") * 7919 % 50) * 4)
             .withColumn("b", F.col("user_id") % PARTITIONS))


def _late_marked(spark, d) -> DataFrame:
    e = _shuffled_arrival(_t(spark, d).events.select("event_id", "user_id", "ts"))
    return win.mark_late(e, ["b"], ["arr", "event_id"], "ts", DAY, GRACE)


def tumbling_grace(spark, d):  # W2
    m = _late_marked(spark, d)
    return (m.where(~F.col("is_late")).groupBy("user_id", "window_start", "window_end")
             .agg(F.count(F.lit(1)).alias("n")))


def late_rows(spark, d):  # W3
    m = _late_marked(spark, d)
    return m.where(F.col("is_late")).select("event_id", "user_id", "ts", "window_start", "stream_time")


def latest_by_offset(spark, d):  # A5 A3
    e = _t(spark, d).events.select("event_id", "user_id", "event_type", "ts", "value")
    return win.windowed(e, ["user_id", "event_type"], "ts", DAY,
                        [F.count(F.lit(1)).alias("change_count"),
                         tables.latest_non_null("value", "event_id").alias("latest_value")])


def composite_key(spark, d):  # A3 Q7
    e = _t(spark, d).events
    key = F.concat_ws("|+|", F.col("user_id").cast("string"), F.col("event_type"))
    return e.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))


def high_rate_rekey(spark, d):  # P2 P9 W5
    c = _daily_counts(_t(spark, d).events.select("user_id", "ts"))
    return st.keep(c, F.col("n") >= HIGH_COUNT)


def vitals_alerts(spark, d):  # E4
    e = _t(spark, d).events
    beats = win.windowed(e.select("user_id", "ts"), ["user_id"], "ts", DAY,
                         [F.count(F.lit(1)).alias("heart_rate"), F.max("ts").alias("beat_ts")])
    high = st.keep(beats, F.col("heart_rate") >= HIGH_COUNT)
    temps = st.keep(e, F.col("value") > HIGH_VALUE).select(
        "event_id", F.col("user_id").alias("t_user_id"), F.col("ts").alias("temp_ts"), "value")
    j = joins.interval_join(high, temps, "user_id", "beat_ts", "temp_ts", ALERT_BOUND_S, right_key="t_user_id")
    return j.select("user_id", "window_start", "heart_rate", "event_id", "value",
                    joins.joined_time("beat_ts", "temp_ts").alias("alert_ts"))


def hopping_count(spark, d):  # W7
    e = _t(spark, d).events.select("user_id", "ts")
    return win.windowed(e, ["user_id"], "ts", "2 days", [F.count(F.lit(1)).alias("n")], slide=DAY)


def session_count(spark, d):  # W8
    e = _t(spark, d).events.select("event_id", "user_id", "ts")
    return win.sessions(e, ["user_id"], "ts", SESSION_GAP, "event_id", [F.count(F.lit(1)).alias("n")])


def sliding_sum(spark, d):  # W9
    e = _t(spark, d).events.select("event_id", "user_id", "ts", "value")
    s = win.sliding(e, ["user_id"], "ts", SLIDING_SIZE, "value")
    return s.select("event_id", "user_id", "window_count", F.round("window_sum", 2).alias("window_sum"))


def retention_filter(spark, d):  # W6
    e = _t(spark, d).events
    return win.retained(_daily_counts(e.select("user_id", "ts")), win.max_of(e, "ts"), RETENTION)


def event_time_fallback(spark, d):  # F7 F8 F12
    e = _t(spark, d).events.select("event_id", "user_id", "ts")
    raw = (e.withColumn("ts_raw", F.when(F.col("event_id") % 7 != 0, F.col("ts")))
             .withColumn("b", F.col("user_id") % PARTITIONS).drop("ts"))
    return win.event_time_with_fallback(raw, ["b"], ["event_id"], "ts_raw", "event_ts", "fallback").select(
        "event_id", "user_id", "ts_raw", "event_ts")


# ---- device twin (E5) ------------------------------------------------------------------

TWIN_STATE = ["timestamp", "wind_speed_mph", "power"]


def _twin_inputs(spark, d) -> DataFrame:
    e = _t(spark, d).events
    power = F.when(_k() % 2 == 0, F.lit(twin.POWER_ON)).otherwise(F.lit(twin.POWER_OFF))
    rep = e.where(F.col("event_type") == "view").select(
        F.col("user_id").alias("key"), "event_id", F.col("ts").alias("timestamp"),
        F.col("value").alias("wind_speed_mph"), power.alias("power"))
    des = e.where(F.col("event_type") == "signup").select(
        F.col("user_id").alias("key"), "event_id", F.col("ts").alias("timestamp"),
        F.lit(None).cast("double").alias("wind_speed_mph"), power.alias("power"))
    return twin.twin_inputs(rep, des)


def _flat_twin(df: DataFrame, *lead: str) -> DataFrame:
    return df.select(*lead,
                     *[F.col(f"desired.{f}").alias(f"desired_{f}") for f in TWIN_STATE],
                     *[F.col(f"reported.{f}").alias(f"reported_{f}") for f in TWIN_STATE])


def twin_changelog(spark, d):  # T1 T2 P11 E5
    ch = twin.twin_changelog(_twin_inputs(spark, d), "key", ["event_id", "emit_idx"], TWIN_STATE)
    return _flat_twin(ch, "key", "event_id", "emit_idx")


def _twin_latest(spark, d) -> DataFrame:
    return twin.twin_latest(_twin_inputs(spark, d), "key", ["event_id", "emit_idx"], TWIN_STATE)


def twin_latest(spark, d):  # T1 (final store content)
    return _flat_twin(_twin_latest(spark, d), "key")


def twin_ttl(spark, d):  # T5 F10
    e = _t(spark, d).events
    return _flat_twin(twin.twin_ttl(_twin_latest(spark, d), win.max_of(e, "ts")), "key")


# ---- change monitoring (E6) ---------------------------------------------------------------

def _production_changes(spark, d) -> DataFrame:
    e = _t(spark, d).events.withColumn("__k", _k())  # parse props once, reuse the column
    k = F.col("__k")
    ep = F.floor("value").cast("int")
    before = fx.make_struct(season_id=k % 3, episode_count=ep % 13)
    after = F.when(F.col("event_id") % 4 != 0, fx.make_struct(season_id=k % 3, episode_count=(ep + k) % 13))
    return e.select(
        F.col("user_id").cast("string").alias("rowkey"), F.col("event_id").alias("uuid"),
        F.col("user_id").alias("title_id"),
        F.when(F.col("event_type") == "purchase", "release_date").otherwise("season_length").alias("change_type"),
        before.alias("before"), after.alias("after"), format_time("ts").alias("created_at"))


def _season_length_changes(spark, d) -> DataFrame:  # Q10 (CSAS) with F1 F2
    return _season_length_select(_production_changes(spark, d))


def _season_length_select(pc: DataFrame) -> DataFrame:
    """The CSAS on a batch or streaming frame of production changes."""
    return st.keep(pc, "change_type = 'season_length'").select(
        "rowkey", "uuid", "title_id",
        fx.ifnull(fx.field("after", "season_id"), fx.field("before", "season_id")).alias("season_id"),
        fx.field("before", "episode_count").alias("old_episode_count"),
        fx.field("after", "episode_count").alias("new_episode_count"),
        "created_at")


def csas_changes(spark, d):
    return _season_length_changes(spark, d)


def ctas_counts(spark, d):  # Q11: J1 + A3 W1 W2 A4 A5
    t = _t(spark, d)
    s = _season_length_changes(spark, d).withColumn("event_ts", parse_time("created_at"))
    titles = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    enriched = joins.stream_table_join(s, titles, s["title_id"] == titles["id"]).drop("id")
    marked = win.mark_late(enriched.withColumn("b", F.col("title_id") % PARTITIONS),
                           ["b"], ["uuid"], "event_ts", DAY, "10 minutes")
    return (marked.where(~F.col("is_late"))
                  .groupBy("title_id", "season_id", "window_start", "window_end")
                  .agg(F.any_value("title").alias("title"),
                       F.count(F.lit(1)).alias("change_count"),
                       tables.latest_non_null("new_episode_count", "uuid").alias("episode_count"))
                  .withColumn("key", F.concat_ws("|+|", F.col("title_id").cast("string"),
                                                 F.col("season_id").cast("string"))))


# ---- lookups over materialized results (Q1-Q8) -------------------------------------------------

def _leaderboard_store(spark, d) -> DataFrame:
    return lookups.opened(spark, "top-scores", fingerprint(spark, d, "orders", "customer", "nation"),
                          lambda: leaderboard_array(spark, d), keys=["n_nationkey"])


def _window_store(spark, d) -> DataFrame:
    return lookups.opened(spark, "daily-counts", fingerprint(spark, d, "events"),
                          lambda: tumbling_count(spark, d), day_of("window_start"))


def store_all(spark, d):  # Q1
    return lookups.store_all(_leaderboard_store(spark, d))


def window_all(spark, d):  # Q4
    return lookups.store_all(_window_store(spark, d))


def store_get(spark, d):  # Q2
    return lookups.store_get(_leaderboard_store(spark, d), "n_nationkey", LOOKUP_NATION)


def store_count(spark, d):  # Q3
    return lookups.store_count(_leaderboard_store(spark, d))


def window_range(spark, d):  # Q4 Q5
    return lookups.window_range(_window_store(spark, d), _ts(RANGE_FROM), _ts(RANGE_TO))


def window_key_range(spark, d):  # Q6
    return lookups.window_key_range(_window_store(spark, d), "user_id", LOOKUP_USER, _ts(RANGE_FROM), _ts(RANGE_TO))


def pull_windowstart(spark, d):  # Q7 Q8
    store = lookups.opened(spark, "change-counts", fingerprint(spark, d, "events", "customer"),
                           lambda: ctas_counts(spark, d), day_of("window_start"))
    return lookups.pull(store, "key", PULL_KEY, _ts(PULL_START))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in [
        greet_projection, json_decode_project, keyed_text_decode, declared_stream, json_encode_roundtrip,
        malformed_split, sink_roundtrip, filter_not_error, branch_first_match, branch_translate_merge,
        entity_flatmap, entity_sentiment, rekey_group_count, conditional_emit, latest_table,
        latest_table_tombstones, stream_table_join, stream_table_asof, global_table_join, table_table_join,
        interval_join, leaderboard_top3, leaderboard_array, tumbling_count, tumbling_final, tumbling_refining,
        tumbling_grace, late_rows, latest_by_offset, composite_key, high_rate_rekey, vitals_alerts,
        hopping_count, session_count, sliding_sum, retention_filter, event_time_fallback, twin_changelog,
        twin_latest, twin_ttl, csas_changes, ctas_counts, store_all, store_get, store_count, window_all, window_range,
        window_key_range, pull_windowstart,
    ]
}

"""The six end-to-end flows (E1-E6) over inputs shaped like the reference's
topics, with the reference's parameters.  Batch forms; the streaming forms
are in :mod:`streamtab.streaming`.

Inputs carry an explicit arrival position ``seq`` (one sequence across all
topics of a flow, the order in which records were produced) so that
arrival-order semantics (latest-wins, as-of lookups, grace periods) are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..operators import joins, stateless as st, tables, topk, windows as win
from ..operators import state as twin
from ..sources import json_codec as jc
from ..sources import schemas as S
from ..sources import sinks
from ..sources.declared import declare_stream, parse_time

# ---- fixed values of the reference flows ------------------------------------------
GREETING_PREFIX = "Hello, "
TRACKED_CURRENCIES = ("bitcoin", "ethereum")
LEADERBOARD_SIZE = 3
PULSE_WINDOW = "60 seconds"
PULSE_GRACE = "5 seconds"
HIGH_PULSE_BPM = 100
HIGH_TEMP_F = 100.4
VITALS_JOIN_S = 60
VITALS_JOIN_GRACE_S = 10
CHANGE_WINDOW = "1 hour"
CHANGE_GRACE = "10 minutes"
CHANGE_RETENTION = "2 days"
PARTITIONS = 4


# E1 -------------------------------------------------------------------------------
def greeting(values: DataFrame, col: str = "value") -> DataFrame:
    """S1 -> P12: ``Hello, <value>`` for every record."""
    return st.greet(values, col).select("greeting")


# E2 -------------------------------------------------------------------------------
def entity_sentiment(tweets: DataFrame, col: str = "value", seed: int | None = None) -> DataFrame:
    """Raw tweet JSON -> one row per tracked entity mention (ENTITY_SENTIMENT)."""
    t = jc.decode_columns(tweets, col, S.TWEET, naming="upper_camel")
    t = st.drop_where(t, F.col("retweet"))
    merged = st.branch_map(t, [F.col("lang") == "en", F.col("lang") != "en"],
                           text=[F.col("text"), F.concat(F.lit("Translated: "), F.col("text"))])
    ex = st.flat_map(merged.withColumn("__toks", fx.tokens("text")), "__toks", "entity", "pos",
                     keep=lambda token: fx.tracked(token, TRACKED_CURRENCIES)).drop("__toks")
    return sinks.enforce(ex.withColumns(fx.sentiment_scores("id", "pos", seed)), S.ENTITY_SENTIMENT)


# E3 -------------------------------------------------------------------------------
def leaderboard(scores: DataFrame, players: DataFrame, products: DataFrame) -> DataFrame:
    """Scores (``value`` JSON, ``seq``) joined as-of with the players table
    (``value`` = ``key|json`` lines, ``seq``), then with the products global
    table, top-3 distinct scores per product, earliest arrival wins ties."""
    sc = jc.decode_columns(scores, "value", S.SCORE_EVENT, keep=["seq"])
    sc = st.select_key(sc, "player_id")
    pl = _keyed(players, S.PLAYER)
    pr = _keyed(products, S.PRODUCT)
    with_players = tables.asof_lookup(sc, pl.select("key", "seq", "name"), "key", ["seq"], ["name"],
                                      prefix="player_")
    prod_table = tables.latest(pr, "key", "seq", ["name"]).select(
        F.col("key").alias("product_key"), F.col("name").alias("game_name"))
    enriched = joins.global_table_join(with_players, prod_table,
                                       fx.as_key("product_id") == F.col("product_key"))
    enriched = enriched.select("product_id", "player_id", "player_name", "game_name", "score", "seq")
    return topk.top_k_distinct(enriched, ["product_id"], "score", ["seq"], LEADERBOARD_SIZE).drop("seq")


def _keyed(lines: DataFrame, schema) -> DataFrame:
    """``key|json`` text lines with ``seq`` -> key + typed columns."""
    return jc.decode_keyed_text(lines, schema, keep=["seq"])


# E4 -------------------------------------------------------------------------------
def _timed(lines: DataFrame, schema, out: str) -> DataFrame:
    """Keyed lines with event time; records without one take their partition's."""
    d = _keyed(lines, schema).withColumn("__ts", parse_time("timestamp", None))
    d = d.withColumn("b", F.pmod(F.hash("key"), F.lit(PARTITIONS)))
    return win.event_time_with_fallback(d, ["b"], ["seq"], "__ts", out).drop("__ts").where(F.col(out).isNotNull())


def pulse_counts(pulses: DataFrame, final: bool = True) -> DataFrame:
    """Heart rate per patient and 60 s window.  ``final`` keeps windows that their
    partition's stream time closed (grace 5 s), with the position ``seq`` of the
    record that closed them; otherwise the refining store content."""
    p = _timed(pulses, S.PULSE, "ts")
    m = win.mark_late(p, ["b"], ["seq"], "ts", PULSE_WINDOW, PULSE_GRACE)
    counts = (m.where(~F.col("is_late")).groupBy("b", "key", "window_start", "window_end")
                .agg(F.count(F.lit(1)).alias("heart_rate"), F.max("ts").alias("beat_ts")))
    if final:
        counts = counts.join(win.window_closings(p, ["b"], ["seq"], "ts", PULSE_WINDOW, PULSE_GRACE), ["b", "window_end"])
    return counts


def vitals_alerts(pulses: DataFrame, temps: DataFrame) -> DataFrame:
    """High heart rate (final windows) joined with high temperature within 60 s; records
    that arrive more than 10 s after their join window closed are dropped."""
    high = st.keep(pulse_counts(pulses, final=True), F.col("heart_rate") >= HIGH_PULSE_BPM)
    t = st.keep(_timed(temps, S.BODY_TEMP, "temp_ts"), F.col("temperature") > HIGH_TEMP_F).select(
        F.col("key").alias("t_key"), "temp_ts", "b", "seq",
        F.struct("timestamp", "temperature", "unit").alias("body_temp"))
    j = joins.interval_join_grace(high, t, "key", "beat_ts", "temp_ts", VITALS_JOIN_S, VITALS_JOIN_GRACE_S, ["b"], ["seq"],
                                  right_key="t_key")
    return j.select("key", F.col("heart_rate").cast("int").alias("heart_rate"), "body_temp",
                    joins.joined_time("beat_ts", "temp_ts").alias("alert_ts"))


# E5 -------------------------------------------------------------------------------
TWIN_STATE = ["timestamp", "wind_speed_mph", "power", "type"]


def twin_inputs(reported: DataFrame, desired: DataFrame) -> DataFrame:
    rep = _keyed(reported, S.TURBINE_STATE).withColumn(
        "power", fx.enum_value("power", [twin.POWER_ON, twin.POWER_OFF]))
    des = _keyed(desired, S.TURBINE_STATE).withColumn(
        "power", fx.enum_value("power", [twin.POWER_ON, twin.POWER_OFF]))
    return twin.twin_inputs(rep, des)


def twin_changelog(reported: DataFrame, desired: DataFrame) -> DataFrame:
    return twin.twin_changelog(twin_inputs(reported, desired), "key", ["seq", "emit_idx"], TWIN_STATE)


def twin_store(reported: DataFrame, desired: DataFrame, as_of=None) -> DataFrame:
    latest = twin.twin_latest(twin_inputs(reported, desired), "key", ["seq", "emit_idx"], TWIN_STATE)
    if as_of is None:
        return latest
    return twin.twin_ttl(latest, F.lit(as_of).cast("timestamp"),
                         ts_field="reported.timestamp")


# E6 -------------------------------------------------------------------------------
def season_length_changes(changes: DataFrame) -> DataFrame:
    """CSAS: season-length changes with IFNULL and struct access."""
    return st.keep(changes, "change_type = 'season_length'").select(
        "rowkey", "seq", "title_id",
        fx.ifnull(fx.field("after", "season_id"), fx.field("before", "season_id")).alias("season_id"),
        fx.field("before", "episode_count").alias("old_episode_count"),
        fx.field("after", "episode_count").alias("new_episode_count"),
        "created_at")


def change_counts(titles: DataFrame, changes: DataFrame) -> DataFrame:
    """CTAS: join with the titles table as of each change's arrival, 1 h tumbling windows,
    grace 10 min, count and latest-by-offset episode count per (title, season,
    window), windows of the last 2 days of stream time."""
    s = declare_stream(season_length_changes(changes).drop("rowkey"), key="title_id", timestamp="created_at")
    t = titles.select(F.col("id").alias("title_id"), "seq", "title")
    enriched = tables.asof_lookup(s, t, "title_id", ["seq"], ["title"])
    m = win.mark_late(enriched.withColumn("b", F.pmod(F.hash("rowkey"), F.lit(PARTITIONS))),
                      ["b"], ["seq"], "event_ts", CHANGE_WINDOW, CHANGE_GRACE)
    counts = (m.where(~F.col("is_late")).groupBy("title_id", "season_id", "window_start", "window_end")
               .agg(tables.latest_non_null("t_title", "seq").alias("title"), F.count(F.lit(1)).alias("change_count"),
                    tables.latest_non_null("new_episode_count", "seq").alias("episode_count"))
               .withColumn("key", F.concat_ws("|+|", F.col("title_id").cast("string"),
                                              F.col("season_id").cast("string"))))
    return win.retained(counts, win.max_of(m, "stream_time"), CHANGE_RETENTION)

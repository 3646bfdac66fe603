"""t3: streaming jobs replayed micro-batch by micro-batch equal their batch forms
(fixtures of the reference, one file = one micro-batch)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.operators import state as twin_ops
from streamtab.plans import apps
from streamtab.session import scratch_path
from streamtab.sources import schemas as S
from streamtab.sources.declared import parse_time
from streamtab.streaming import jobs, runner
from streamtab.streaming.sources import replay, replay_stream

from .test_fixtures import REPORTED, _changes, _lines, _pulse_lines, _titles


def _replay(spark, df, chunks):
    path = scratch_path(spark, "replay")
    replay(spark, df, "seq", chunks, path)
    return replay_stream(spark, path, df.schema)


def test_change_counts_one_record_per_batch(spark):
    # H1: single stateful operator + allowMultiple=false drops the late row exactly
    spark.conf.set("spark.sql.streaming.statefulOperator.allowMultiple", "false")
    try:
        ch = _changes(spark).unionByName(
            spark.createDataFrame([("1", 99, 1, "season_length", (1, 1), (1, 1), "2021-02-24 12:30:00", 20)],
                                  _changes(spark).schema))  # sentinel closes 11-12
        s = _replay(spark, ch, 6)
        titles = _titles(spark).select(F.col("id").alias("t_id"), "title")
        c = apps.season_length_changes(s).withColumn("event_ts", parse_time("created_at").cast("timestamp"))
        enriched = c.join(titles, c["title_id"] == titles["t_id"]).drop("t_id")
        agg = jobs.windowed_final(enriched, ["title_id", "season_id"], "event_ts", "1 hour", "10 minutes",
                                  [F.count(F.lit(1)).alias("change_count"),
                                   F.max_by("new_episode_count", F.when(F.col("new_episode_count").isNotNull(),
                                                                         F.col("seq"))).alias("episode_count")])
        out = runner.run_append(spark, agg, "e6")
        got = {r.window_start.hour: (r.change_count, r.episode_count) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.streaming.statefulOperator.allowMultiple")
    assert got == {10: (2, 8), 11: (2, 12)}


def test_pulse_counts_stream_final(spark):
    pulses = _lines(spark, _pulse_lines() + ['1|{"timestamp": "2020-11-23T09:05:00.000Z"}'])
    s = _replay(spark, pulses, 4)
    p = (s.select(F.split("value", "\\|", 2).getItem(0).alias("key"),
                  F.from_json(F.split("value", "\\|", 2).getItem(1), S.PULSE).alias("v"))
          .select("key", parse_time("v.timestamp", None).cast("timestamp").alias("ts")))
    agg = jobs.windowed_final(p, ["key"], "ts", "60 seconds", "5 seconds", [F.count(F.lit(1)).alias("n")])
    out = {(r.window_start.minute, r.n) for r in runner.run_append(spark, agg, "pulse").collect()}
    assert out == {(2, 120), (3, 7)}


def _twin_inputs_stream(spark, reported_lines, desired_lines, chunks):
    rep = _lines(spark, reported_lines)
    des = _lines(spark, desired_lines, 100)
    both = rep.withColumn("src", F.lit("r")).unionByName(des.withColumn("src", F.lit("d")))
    s = _replay(spark, both, chunks)
    parsed = (s.select("seq", "src", F.split("value", "\\|", 2).getItem(0).alias("key"),
                       F.from_json(F.split("value", "\\|", 2).getItem(1), S.TURBINE_STATE).alias("v"))
               .select("key", F.col("seq").alias("event_id"), "src",
                       parse_time("v.timestamp", None).cast("timestamp").alias("timestamp"),
                       "v.wind_speed_mph", "v.power"))
    r = parsed.where(F.col("src") == "r").drop("src")
    d = parsed.where(F.col("src") == "d").drop("src")
    return twin_ops.twin_inputs(r, d).withColumn("emit_idx", F.col("emit_idx").cast("long"))


def test_twin_stream_equals_batch(spark):
    runner.use_rocksdb(spark)
    desired = ['1|{"timestamp": "2020-11-23T09:12:00.000Z", "power": "ON", "type": "DESIRED"}']
    inputs = _twin_inputs_stream(spark, REPORTED, desired, 3)
    out = runner.run_changelog(spark, jobs.twin(inputs, T.StringType()), "twin").orderBy("event_id", "emit_idx")
    rows = out.collect()
    assert len(rows) == 6
    assert (rows[4].desired_power, rows[4].desired_wind_speed_mph, rows[4].reported_power) == ("OFF", 68.0, "ON")
    assert (rows[5].desired_power, rows[5].desired_timestamp) == ("ON", dt.datetime(2020, 11, 23, 9, 12))


def test_twin_ttl_event_time_timer(spark):
    runner.use_rocksdb(spark)
    rep = REPORTED + ['2|{"timestamp": "2020-11-30T10:00:00.000Z", "wind_speed_mph": 1, "power": "ON"}',
                      '2|{"timestamp": "2020-11-30T10:00:30.000Z", "wind_speed_mph": 1, "power": "ON"}']
    desired = ['1|{"timestamp": "2020-11-30T10:01:00.000Z", "power": "ON"}']
    inputs = _twin_inputs_stream(spark, rep, desired, 7)
    out = runner.run_changelog(spark, jobs.twin(inputs, T.StringType(), event_time_col="timestamp"), "ttl")
    last_for_1 = out.where(F.col("key") == "1").orderBy(F.col("event_id").desc()).first()
    # key 1's reported state is 7 days old when the watermark passes: expired, new twin starts empty
    assert last_for_1.reported_timestamp is None
    assert last_for_1.desired_timestamp == dt.datetime(2020, 11, 30, 10, 1)


def test_leaderboard_stream_ties_across_batches(spark):
    runner.use_rocksdb(spark)
    rows = [(1, 50.0, "a", 0), (1, 50.0, "b", 1), (1, 40.0, "c", 2), (1, 60.0, "d", 3),
            (1, 40.0, "e", 4), (1, 45.0, "f", 5), (2, 10.0, "g", 6)]
    df = spark.createDataFrame(rows, "product_id long, score double, player string, seq long")
    s = _replay(spark, df, 4)
    payload = T.StructType([T.StructField("player", T.StringType())])
    top = jobs.top_k(s, ["product_id"], payload, 3)
    final = runner.final_rows(runner.run_changelog(spark, top, "lb"), ["product_id"])
    got = sorted((r.product_id, r.rank, r.player, r.score) for r in final.collect())
    assert got == [(1, 1, "d", 60.0), (1, 2, "a", 50.0), (1, 3, "f", 45.0), (2, 1, "g", 10.0)]


def test_twin_ttl_wall_clock_punctuation(spark):
    """Periodic wall-clock TTL check (processing-time timers, processingTime trigger)."""
    import time
    runner.use_rocksdb(spark)
    src = scratch_path(spark, "wallclock-src")
    schema = "value string, seq long, src string"

    def put(lines, start, kind):
        _lines(spark, lines, start).withColumn("src", F.lit(kind)).coalesce(1).write.mode("append").parquet(src)

    put(REPORTED, 0, "r")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    parsed = (s.select("seq", "src", F.split("value", "\\|", 2).getItem(0).alias("key"),
                       F.from_json(F.split("value", "\\|", 2).getItem(1), S.TURBINE_STATE).alias("v"))
               .select("key", F.col("seq").alias("event_id"), "src",
                       parse_time("v.timestamp", None).cast("timestamp").alias("timestamp"),
                       "v.wind_speed_mph", "v.power"))
    inputs = twin_ops.twin_inputs(parsed.where(F.col("src") == "r").drop("src"),
                                  parsed.where(F.col("src") == "d").drop("src"))
    inputs = inputs.withColumn("emit_idx", F.col("emit_idx").cast("long"))
    out = jobs.twin(inputs, T.StringType(), wall_clock_check_ms=500)
    name = "wallclock_twin"
    q = (out.writeStream.outputMode("update").format("memory").queryName(name)
            .option("checkpointLocation", scratch_path(spark, "wallclock-ck"))
            .trigger(processingTime="500 milliseconds").start())
    def wait_for(event_id):  # periodic timers keep no-data batches running: poll the sink
        deadline = time.time() + 60
        while time.time() < deadline:
            if spark.sql(f"SELECT count(*) AS n FROM {name} WHERE event_id = {event_id}").first().n:
                return
            assert q.exception() is None, q.exception()
            time.sleep(0.5)
        raise TimeoutError(event_id)

    try:
        wait_for(3)
        time.sleep(2)  # the reported state (2020) is years old: the next check clears it
        put(['1|{"timestamp": "2020-11-23T09:12:00.000Z", "power": "ON"}'], 10, "d")
        wait_for(10)
        time.sleep(2)
        put(['1|{"timestamp": "2020-11-23T09:13:00.000Z", "power": "OFF"}'], 11, "d")
        wait_for(11)
    finally:
        q.stop()
    last = spark.sql(f"SELECT * FROM {name} ORDER BY event_id DESC").first()
    assert last.event_id == 11 and last.desired_power == "OFF"
    assert last.reported_timestamp is None


def test_vitals_chained_stream_multi_batch_equals_batch(spark, duck001):
    """E4 chained stateful stream replayed in 6 micro-batches equals the batch SQL
    on closed windows (join state is evicted by watermark between batches)."""
    from streamtab.plans import catalog as C
    from streamtab.plans.streams import STREAM_ORACLE_SQL
    from streamtab.plans.verify import _rows
    from .conftest import SF001
    ev = spark.read.parquet(f"{SF001}/events.parquet").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value").withColumn("seq", F.col("event_id"))
    s = _replay(spark, ev, 6)
    temps = s.where(F.col("value") > C.HIGH_VALUE).select(
        "event_id", F.col("user_id").alias("r_key"), F.col("ts").alias("temp_ts"), "value")
    j = jobs.alerts_from_windows(s.select("user_id", "ts"), temps, "user_id", "ts", "temp_ts", C.DAY, C.GRACE,
                                 C.HIGH_COUNT, C.ALERT_BOUND_S)
    j = j.select("user_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "heart_rate",
                 "event_id", "value", F.greatest("beat_ts", "temp_ts").cast("timestamp_ntz").alias("alert_ts"))
    out = runner.run_append(spark, j, "vitals-replay")
    res = duck001.execute(STREAM_ORACLE_SQL["stream_vitals_alerts"])
    exp_cols = [x[0] for x in res.description]
    assert _rows(out.columns, [tuple(r) for r in out.collect()]) == _rows(exp_cols, res.fetchall())


def test_asof_join_stream_sees_table_updates_across_batches(spark):
    """A player renamed while the job runs is seen by later scores only."""
    runner.use_rocksdb(spark)
    rows = [("t", 1, "Ann", None, 0), ("t", 2, "Bo", None, 1), ("s", 1, None, 50.0, 2), ("s", 2, None, 50.0, 3),
            ("s", 2, None, 40.0, 4), ("t", 2, "Bob", None, 5), ("s", 2, None, 30.0, 6), ("s", 9, None, 99.0, 7),
            ("t", 1, None, None, 8), ("s", 1, None, 10.0, 9)]          # seq 8: tombstone for player 1
    df = spark.createDataFrame(rows, "kind string, player_id long, name string, score double, seq long")
    s = _replay(spark, df, 5)
    stream = s.where(F.col("kind") == "s").select("player_id", "score", "seq")
    table = s.where(F.col("kind") == "t").select("player_id", "seq", F.col("name").alias("player_name"))
    j = jobs.asof_join(stream, table, "player_id", "seq", ["player_id", "score", "seq"], ["player_name"],
                       tombstone=F.col("player_name").isNull())
    got = sorted((r.seq, r.player_name) for r in runner.run_append(spark, j, "asof-replay").collect())
    assert got == [(2, "Ann"), (3, "Bo"), (4, "Bo"), (6, "Bob")]


@pytest.mark.parametrize("chunks", [1, 6])
def test_exact_grace_in_chained_stream(spark, chunks):
    """H1: per-record, per-partition lateness in front of an aggregate, exact
    whatever the micro-batching (one batch or one record per batch)."""
    runner.use_rocksdb(spark)
    ch = _changes(spark).unionByName(
        spark.createDataFrame([("1", 99, 1, "season_length", (1, 1), (1, 1), "2021-02-24 12:30:00", 20)],
                              _changes(spark).schema))
    s = _replay(spark, ch, chunks)
    titles = _titles(spark).select(F.col("id").alias("t_id"), "title")
    c = apps.season_length_changes(s).withColumn("event_ts", parse_time("created_at").cast("timestamp"))
    en = c.join(titles, c["title_id"] == titles["t_id"]).drop("t_id").withColumn("b", F.lit(0))
    m = jobs.mark_late_stream(en, "b", "seq", "event_ts", "1 hour", "10 minutes")
    agg = (m.where(~F.col("is_late")).groupBy("title_id", "season_id", "window_start")
            .agg(F.count(F.lit(1)).alias("change_count"),
                 F.max_by("new_episode_count", F.when(F.col("new_episode_count").isNotNull(), F.col("seq")))
                  .alias("episode_count")))
    fin = runner.final_rows(runner.run_changelog(spark, agg, "grace"), ["title_id", "season_id", "window_start"])
    got = {r.window_start.hour: (r.change_count, r.episode_count) for r in fin.collect()}
    assert got == {10: (2, 8), 11: (2, 12), 12: (1, 1)}


def _events_replay(spark, seq_expr, chunks):
    from .conftest import SF001
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn("seq", seq_expr)
    return _replay(spark, ev, chunks)


def _matches_oracle(out, duck, sql):
    from streamtab.plans.verify import _rows
    res = duck.execute(sql)
    cols = [x[0] for x in res.description]
    exp = res.fetchall()
    assert exp, "oracle result is empty"
    got, want = _rows(out.columns, [tuple(r) for r in out.collect()]), _rows(cols, exp)
    if got != want:
        sg, sw = set(got), set(want)
        raise AssertionError(f"{len(got)} vs {len(want)} rows; only stream: {[x for x in got if x not in sw][:5]}; "
                             f"only batch: {[x for x in want if x not in sg][:5]}; cols {sorted(cols)}")


def test_grace_stream_shuffled_arrival_multi_batch_equals_batch(spark, duck001):
    """W2 on the test table: arrival order shuffled, replayed in 6 micro-batches,
    per-partition exact lateness equals the batch SQL."""
    from streamtab.plans import catalog as C
    from streamtab.plans.oracle import ORACLE_SQL
    runner.use_rocksdb(spark)
    s = _events_replay(spark, F.col("event_id") + (F.col("event_id") * 7919 % 50) * 4, 6)
    e = (s.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "seq")
          .withColumn("b", F.col("user_id") % C.PARTITIONS))
    m = jobs.mark_late_stream(e, "b", "seq", "ts", C.DAY, C.GRACE)
    agg = m.where(~F.col("is_late")).groupBy("user_id", "window_start", "window_end").agg(
        F.count(F.lit(1)).alias("n"))
    fin = runner.final_rows(runner.run_changelog(spark, agg, "grace-replay"), ["user_id", "window_start"])
    fin = fin.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
    _matches_oracle(fin, duck001, ORACLE_SQL["tumbling_grace"])


def test_twin_stream_multi_batch_equals_batch(spark, duck001):
    """T1/T2 on the test table through transformWithState in 5 micro-batches."""
    from streamtab.plans import catalog as C
    from streamtab.plans.oracle import ORACLE_SQL
    runner.use_rocksdb(spark)
    e = _events_replay(spark, F.col("event_id"), 5)
    power = F.when(C._k() % 2 == 0, F.lit("ON")).otherwise(F.lit("OFF"))
    base = e.where(F.col("event_type").isin("view", "signup")).select(
        F.col("user_id").alias("key"), "event_id", F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("wind_speed_mph"), power.alias("power"),
        F.when(F.col("event_type") == "view", "REPORTED").otherwise("DESIRED").alias("type"))
    inputs = twin_ops.twin_inputs(base.where(F.col("type") == "REPORTED").drop("type"),
                                  base.where(F.col("type") == "DESIRED").drop("type"))
    inputs = inputs.withColumn("emit_idx", F.col("emit_idx").cast("long"))
    ch = runner.run_changelog(spark, jobs.twin(inputs, T.LongType()), "twin-replay").drop("batch_id")
    ch = ch.withColumns({"desired_timestamp": F.col("desired_timestamp").cast("timestamp_ntz"),
                         "reported_timestamp": F.col("reported_timestamp").cast("timestamp_ntz"),
                         "emit_idx": F.col("emit_idx").cast("int")})
    _matches_oracle(ch, duck001, ORACLE_SQL["twin_changelog"])


def test_asof_stream_multi_batch_equals_batch(spark, duck001):
    """J2 on the test table: purchases see the signup table as of their arrival,
    across 5 micro-batches (errors are tombstones)."""
    from streamtab.plans.oracle import ORACLE_SQL
    runner.use_rocksdb(spark)
    e = _events_replay(spark, F.col("event_id"), 5)
    purchases = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")
    changelog = e.where(F.col("event_type").isin("signup", "error")).select(
        "event_id", "user_id", F.col("event_id").alias("t_event_id"), F.col("value").alias("t_value"),
        (F.col("event_type") == "error").alias("is_error"))
    j = jobs.asof_join(purchases, changelog, "user_id", "event_id", ["event_id", "user_id", "value"],
                       ["t_event_id", "t_value"], tombstone=F.col("is_error"))
    out = runner.run_append(spark, j, "asof-table").select(
        F.col("seq").alias("event_id"), "user_id", "value", "t_event_id", "t_value")
    _matches_oracle(out, duck001, ORACLE_SQL["stream_table_asof"])


def test_leaderboard_stream_multi_batch_equals_batch(spark, duck001):
    """A8 on the test tables: orders replayed in 5 micro-batches."""
    from streamtab.operators import joins as J
    from streamtab.plans import catalog as C
    from streamtab.plans.oracle import ORACLE_SQL
    from .conftest import SF001
    runner.use_rocksdb(spark)
    o = _replay(spark, spark.read.parquet(f"{SF001}/orders.parquet").withColumn("seq", F.col("o_orderkey")), 5)
    t = C._t(spark, SF001)
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    en = (o.join(c, o["o_custkey"] == c["c_custkey"]).join(J.broadcast_if_small(n), F.col("c_nationkey") == n["n_nationkey"])
           .select("n_nationkey", F.col("o_totalprice").alias("score"), "seq", "n_name", "o_custkey", "c_name"))
    payload = T.StructType([en.schema["n_name"], en.schema["o_custkey"], en.schema["c_name"]])
    fin = runner.final_rows(runner.run_changelog(spark, jobs.top_k(en, ["n_nationkey"], payload, 3), "lb-replay"),
                            ["n_nationkey"])
    out = fin.select("n_nationkey", "n_name", "rank", F.col("seq").alias("o_orderkey"), "o_custkey", "c_name",
                     F.col("score").alias("o_totalprice"))
    _matches_oracle(out, duck001, ORACLE_SQL["leaderboard_top3"])


def test_change_counts_exact_stream_multi_batch_equals_batch(spark, duck001):
    """E6 flagship on the test tables: CSAS -> titles join -> exact grace ->
    count + latest-by-offset, replayed in 5 micro-batches, equals the batch SQL."""
    from streamtab.plans import catalog as C
    from streamtab.plans.oracle import ORACLE_SQL
    from streamtab.sources.declared import parse_time as pt
    from .conftest import SF001
    runner.use_rocksdb(spark)
    e = _events_replay(spark, F.col("event_id"), 5)
    k = C._k()
    ep = F.floor("value").cast("int")
    s = e.where(F.col("event_type") != "purchase").select(
        F.col("event_id").alias("uuid"), F.col("user_id").alias("title_id"), (k % 3).alias("season_id"),
        F.when(F.col("event_id") % 4 != 0, (ep + k) % 13).alias("new_episode_count"),
        pt(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).cast("timestamp").alias("event_ts"))
    titles = C._t(spark, SF001).customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    en = s.join(titles, s["title_id"] == titles["id"]).drop("id").withColumn("b", F.col("title_id") % C.PARTITIONS)
    m = jobs.mark_late_stream(en, "b", "uuid", "event_ts", C.DAY, "10 minutes")
    agg = (m.where(~F.col("is_late")).groupBy("title_id", "season_id", "window_start", "window_end")
             .agg(F.any_value("title").alias("title"), F.count(F.lit(1)).alias("change_count"),
                  F.max_by("new_episode_count", F.when(F.col("new_episode_count").isNotNull(), F.col("uuid")))
                   .alias("episode_count")))
    fin = runner.final_rows(runner.run_changelog(spark, agg, "ctas-replay"), ["title_id", "season_id", "window_start"])
    fin = (fin.withColumn("key", F.concat_ws("|+|", F.col("title_id").cast("string"), F.col("season_id").cast("string")))
              .withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}))
    _matches_oracle(fin, duck001, ORACLE_SQL["ctas_counts"])


@pytest.mark.parametrize("name", ["stream_hopping_final", "stream_session_final"])
def test_watermark_windows_multi_batch_equal_batch(spark, duck001, name):
    """W7/W8 streaming with watermarks over 6 micro-batches (arrival in event
    order, so nothing is late) equal the batch SQL restricted to closed windows."""
    from streamtab.plans import catalog as C
    from streamtab.plans.streams import STREAM_ORACLE_SQL
    e = _events_replay(spark, F.col("event_id"), 6).select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    if name == "stream_hopping_final":
        agg = jobs.windowed_final(e, ["user_id"], "ts", "2 days", C.GRACE, [F.count(F.lit(1)).alias("n")], slide=C.DAY)
    else:
        agg = jobs.session_final(e, ["user_id"], "ts", C.SESSION_GAP, C.GRACE, [F.count(F.lit(1)).alias("n")])
    out = runner.run_append(spark, agg, name)
    out = out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
    _matches_oracle(out, duck001, STREAM_ORACLE_SQL[name])


def test_stream_ids_beyond_53_bits(spark, tmp_path):
    """As-of join and leaderboard keep 64-bit ids next to nulls."""
    big = 2 ** 60
    s = spark.createDataFrame([(2, 1, big + 1), (3, 1, big + 5), (4, 1, None)], "seq long, k long, sid long")
    t = spark.createDataFrame([(1, 1, big + 3), (3, 1, big + 7)], "seq long, k long, tid long")
    s.write.parquet(f"{tmp_path}/s")
    t.write.parquet(f"{tmp_path}/t")
    stream = spark.readStream.schema(s.schema).parquet(f"{tmp_path}/s")
    table = spark.readStream.schema(t.schema).parquet(f"{tmp_path}/t")
    j = jobs.asof_join(stream, table, "k", "seq", ["k", "sid", "seq"], ["tid"])
    got = sorted((r.seq, r.sid, r.tid) for r in runner.run_append(spark, j, "asof-big").collect())
    assert got == [(2, big + 1, big + 3), (3, big + 5, big + 3), (4, None, big + 7)]
    payload = T.StructType([T.StructField("sid", T.LongType())])
    top = jobs.top_k(stream.withColumn("score", F.col("seq").cast("double")), ["k"], payload, 3)
    rows = runner.final_rows(runner.run_changelog(spark, top, "top-big"), ["k"]).collect()
    assert sorted((r["rank"], r.sid) for r in rows) == [(1, None), (2, big + 5), (3, big + 1)]

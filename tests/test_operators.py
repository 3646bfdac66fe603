"""Operator edge cases against brute force on small hand-made inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.operators import joins, stateless as st, tables, topk, windows as win
from streamtab.operators.scan import Agg, ScanConfig, running, split_keys
from streamtab.sources import json_codec as jc
from streamtab.operators import lookups

T0 = dt.datetime(2024, 1, 1)


def _events(spark, n=300, users=3, seed=7, null_key=True):
    rnd = random.Random(seed)
    rows = []
    t = T0
    for i in range(n):
        t = t + dt.timedelta(seconds=rnd.choice([0, 30, 600, 3600, 7200, 7201]))
        u = rnd.randrange(users)
        if null_key and i % 17 == 0:
            u = None
        rows.append((i, u, t, float(rnd.randrange(100)), rnd.choice(["a", "b", None])))
    return spark.createDataFrame(rows, "off long, k long, ts timestamp_ntz, v double, tag string"), rows


@pytest.mark.parametrize("cfg", [ScanConfig(), ScanConfig(chunk_rows=3)])
def test_running_matches_brute_force_with_null_keys(spark, cfg):
    df, rows = _events(spark)
    out = running(df, ["k"], ["off"], {"c": Agg("count"), "s": Agg("sum", "v"), "m": Agg("max", "v"),
                                       "l": Agg("last", "tag"), "p": Agg("max", "v", inclusive=False)}, cfg)
    got = {r.off: (r.c, r.s, r.m, r.l, r.p) for r in out.collect()}
    exp = {}
    hist = {}
    for off, k, ts, v, tag in rows:
        h = hist.setdefault(k, [])
        prev_max = max((x[1] for x in h), default=None)
        h.append((off, v, tag))
        tags = [x[2] for x in h if x[2] is not None]
        exp[off] = (len(h), sum(x[1] for x in h), max(x[1] for x in h), tags[-1] if tags else None, prev_max)
    assert got == exp


def test_interval_join_brute_force(spark):
    df, rows = _events(spark, 200, 2, seed=3, null_key=False)
    left = df.where(F.col("tag") == "a").select(F.col("off").alias("lo"), "k", F.col("ts").alias("lts"))
    right = df.where(F.col("tag") != "a").select(F.col("off").alias("ro"), F.col("k").alias("rk"),
                                                 F.col("ts").alias("rts"))
    j = joins.interval_join(left, right, "k", "lts", "rts", 3600, 600, right_key="rk")
    got = sorted((r.lo, r.ro) for r in j.collect())
    L = [r for r in rows if r[4] == "a"]
    R = [r for r in rows if r[4] is not None and r[4] != "a"]
    exp = sorted((a[0], b[0]) for a in L for b in R if a[1] == b[1]
                 and a[2] - dt.timedelta(seconds=3600) <= b[2] <= a[2] + dt.timedelta(seconds=600))
    assert got == exp and exp


def test_sliding_infinity_and_large_values_stay_in_their_frames(spark):
    at = lambda minutes: T0 + dt.timedelta(minutes=minutes)
    df = spark.createDataFrame([(0, 1, at(0), float("inf")), (1, 1, at(90), 2.0), (2, 1, at(100), 3.0),
                                (3, 2, at(0), 1e17), (4, 2, at(90), 2.5)], "off long, k long, ts timestamp_ntz, v double")
    got = {r.off: r.window_sum for r in win.sliding(df, ["k"], "ts", "1 hour", "v").collect()}
    assert got == {0: float("inf"), 1: 2.0, 2: 5.0, 3: 1e17, 4: 2.5}


@pytest.mark.parametrize("step", [1, 60_000_000])
def test_chunks_of_a_key_grow_with_the_root_of_its_rows(spark, step):
    df = spark.range(4000).select((F.col("id") * step + 10 ** 15).alias("o"), F.lit(1).alias("k"))
    split = split_keys(df, ["k"], ["o"], ScanConfig(chunk_rows=100)).collect()
    assert [r["__chunks"] for r in split] == [40]
    assert split_keys(df, ["k"], ["o"], ScanConfig(chunk_rows=1)).collect()[0]["__chunks"] == 64
    assert split_keys(df, ["o"], ["o"]) is None


def test_running_keeps_null_order_values_first(spark):
    rows = [(None, 1)] + [(i, 1) for i in range(20)]
    df = spark.createDataFrame(rows, "o long, k long")
    got = running(df, ["k"], ["o"], {"n": Agg("count")}, ScanConfig(chunk_rows=2)).collect()
    assert sorted((-1 if r.o is None else r.o, r.n) for r in got) == [(i - 1, i + 1) for i in range(21)]


def test_asof_tie_goes_to_the_stream_row(spark):
    s = spark.createDataFrame([(5, 1), (6, 1)], "seq long, k long")
    t = spark.createDataFrame([(5, 1, 9.0)], "seq long, k long, v double")
    got = tables.asof_lookup(s, t, "k", ["seq"], ["v"], tombstone=F.lit(False)).collect()
    assert [(r.seq, r.t_v) for r in got] == [(6, 9.0)]


def test_sliding_brute_force(spark):
    df, rows = _events(spark, 250, 2, seed=5, null_key=False)
    out = win.sliding(df.select("off", "k", "ts", "v"), ["k"], "ts", "1 hour", "v")
    got = {r.off: (r.window_count, round(r.window_sum, 6)) for r in out.collect()}
    exp = {}
    for off, k, ts, v, _ in rows:
        w = [x for x in rows if x[1] == k and ts - dt.timedelta(hours=1) <= x[2] <= ts]
        exp[off] = (len(w), round(sum(x[3] for x in w), 6))
    assert got == exp


def test_sessions_gap_boundary(spark):
    rows = [(0, 1, T0), (1, 1, T0 + dt.timedelta(hours=2)),                 # exactly one gap apart: merge
            (2, 1, T0 + dt.timedelta(hours=4, seconds=1)),                   # gap + 1 s: new session
            (3, 2, T0)]
    df = spark.createDataFrame(rows, "off long, k long, ts timestamp_ntz")
    for cfg in (None, ScanConfig(chunk_rows=1)):
        out = win.sessions(df, ["k"], "ts", "2 hours", "off", [F.count(F.lit(1)).alias("n")], cfg)
        got = sorted((r.k, r.window_start, r.n) for r in out.collect())
        assert got == [(1, T0, 2), (1, T0 + dt.timedelta(hours=4, seconds=1), 1), (2, T0, 1)]


def test_mark_late_boundary(spark):
    # window [10:00, 11:00), grace 10 min: accepted while end > stream_time - grace
    ts = [dt.datetime(2021, 2, 24, 10, 0), dt.datetime(2021, 2, 24, 11, 10), dt.datetime(2021, 2, 24, 10, 59),
          dt.datetime(2021, 2, 24, 11, 9, 59), dt.datetime(2021, 2, 24, 10, 58)]
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate(ts)], "off long, b long, ts timestamp_ntz")
    m = win.mark_late(df, ["b"], ["off"], "ts", "1 hour", "10 minutes")
    assert {r.off: r.is_late for r in m.collect()} == {0: False, 1: False, 2: True, 3: False, 4: True}


def test_latest_tombstone_then_reinsert(spark):
    rows = [(1, 0, "x"), (1, 1, None), (2, 2, "y"), (2, 3, None), (2, 4, "z")]
    df = spark.createDataFrame(rows, "k long, off long, v string")
    got = {r.k: r.v for r in tables.latest(df, "k", "off", ["v"]).collect()}
    assert got == {2: "z"}


def test_top_k_ties_and_fewer_than_k(spark):
    rows = [(1, 5.0, 0, "a"), (1, 5.0, 1, "b"), (1, 4.0, 2, "c"), (1, 3.0, 3, "d"), (1, 2.0, 4, "e"), (2, 1.0, 5, "f")]
    df = spark.createDataFrame(rows, "g long, score double, seq long, who string")
    got = sorted((r.g, r.rank, r.who) for r in topk.top_k_distinct(df, ["g"], "score", ["seq"], 3).collect())
    assert got == [(1, 1, "a"), (1, 2, "c"), (1, 3, "d"), (2, 1, "f")]


def test_branch_first_match_and_null(spark):
    df = spark.createDataFrame([(1, "en", 10), (2, "en", 9000), (3, "fr", 9000), (4, None, 1)],
                               "id long, lang string, n long")
    b0, b1 = st.branch(df, F.col("lang") == "en", F.col("n") > 5000)
    assert [r.id for r in b0.collect()] == [1, 2]
    assert [r.id for r in b1.collect()] == [3]


def test_filter_not_counts_null_flags_and_peek(spark):
    from pyspark.sql import Observation
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id long, rt boolean")
    obs, seen = Observation("retweets"), Observation("peek")
    kept = st.peek(st.drop_where(df, F.col("rt"), observe_name=obs), seen)
    assert [r.id for r in kept.collect()] == [2]
    assert obs.get["null_flag_rows"] == 1
    assert seen.get["rows"] == 1


def test_malformed_policies(spark):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": 2',), (None,)], "p string")
    good, bad = jc.split_malformed(df, "p", schema)
    assert good.count() == 2 and bad.count() == 1
    with pytest.raises(Exception):
        df.select(jc.decode("p", schema, mode="FAILFAST").alias("x")).collect()


def test_event_time_policies(spark):
    df = spark.createDataFrame([(0, T0), (1, None), (2, T0 + dt.timedelta(minutes=1)), (3, None)],
                               "off long, ts timestamp_ntz").withColumn("b", F.lit(0))
    fb = {r.off: r.event_ts for r in win.event_time_with_fallback(df, ["b"], ["off"], "ts").collect()}
    assert fb == {0: T0, 1: T0, 2: T0 + dt.timedelta(minutes=1), 3: T0 + dt.timedelta(minutes=1)}
    assert win.event_time_with_fallback(df, ["b"], ["off"], "ts", policy="skip").count() == 2
    with pytest.raises(Exception):
        win.event_time_with_fallback(df, ["b"], ["off"], "ts", policy="fail").collect()


def test_broadcast_only_when_small(spark):
    small = spark.range(10)
    assert joins.estimated_bytes(small) is not None
    assert "broadcast" in str(joins.broadcast_if_small(small)._jdf.queryExecution().logical()).lower()
    big = spark.range(10)
    assert joins.broadcast_if_small(big, limit=1) is big


def test_lookups_and_describe(spark):
    store = spark.createDataFrame([(1, T0, 3), (1, T0 + dt.timedelta(days=1), 4), (2, T0, 5)],
                                  "k long, window_start timestamp_ntz, n long")
    assert lookups.store_get(store, "k", 3).count() == 0
    assert lookups.store_count(store).first().n == 3
    assert lookups.window_key_range(store, "k", 1, T0, T0).count() == 1
    assert ("n", "bigint") in lookups.describe(store)

"""Exact flows: every registered one against its SQL, restart after a failure, and edges."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.operators import joins, topk, windows as win
from streamtab.plans import apps, flows, registry, surface
from streamtab.plans.verify import compare
from streamtab.session import scratch_path
from streamtab.sources import sinks
from streamtab.streaming import exact, push
from streamtab.streaming.sources import arrivals, file_stream, replay

from .conftest import SF001
from .test_fixtures import _changes, _lines, _pulse_lines

T0 = dt.datetime(2024, 1, 1)
BATCH = [*flows.QUERIES, *surface.QUERIES]
STREAMS = [*flows.STREAM_QUERIES, *surface.STREAM_QUERIES]


def test_names_do_not_shadow_each_other():
    from streamtab.plans import catalog, streams
    parts = (catalog.QUERIES, flows.QUERIES, surface.QUERIES, streams.STREAM_QUERIES, flows.STREAM_QUERIES, surface.STREAM_QUERIES)
    assert sum(map(len, parts)) == len(set().union(*parts))
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL) and set(registry.STREAM_QUERIES) == set(registry.STREAM_ORACLE_SQL)


@pytest.mark.parametrize("name", BATCH + STREAMS)
def test_flow_matches_sql(spark, duck001, name):
    r = compare(spark, name, SF001, duck001)
    assert r["cols_match"] and r["values_match"], r


def _late_table(spark, n=400, seed=5):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(3), T0 + dt.timedelta(minutes=10 * i - rng.choice([0, 0, 0, 30, 200, 900])), rng.choice([0, 1, None])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "seq long, k long, ts timestamp_ntz, b int")


def test_failed_batch_is_replayed_exactly(spark):
    """A body that dies after its commits leaves the same result once resumed."""
    rows, df = _late_table(spark)
    s = arrivals(spark, df, "seq", 4)
    base, died = scratch_path(spark, "crash"), []
    clock = exact.StreamTime(spark, f"{base}/time", ["b"])
    counts = exact.WindowCounts(spark, f"{base}/counts", ["k"], {"n": (F.count(F.lit(1)), F.sum("n"))})

    def body(batch, i):
        marked = clock.mark_late(batch, i, ["seq"], "ts", "1 hour", "20 minutes")
        counts.commit(i, marked.where(~F.col("is_late")))
        clock.commit(i, clock.of(batch, "ts"))
        if i == 2 and not died:
            died.append(i)
            raise RuntimeError("executor lost")

    with pytest.raises(Exception, match="executor lost"):
        exact.run_batches(spark, s, "crash", body, base)
    assert clock.store.versions()[-1] == 2
    exact.run_batches(spark, s, "crash", body, base)
    marked = win.mark_late(df, ["b"], ["seq"], "ts", "1 hour", "20 minutes").where(~F.col("is_late"))
    want = marked.groupBy("k", "window_start", "window_end").agg(F.count(F.lit(1)).alias("n"))
    got = counts.read().select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and died == [2]


def test_join_grace_against_brute_force(spark):
    rows, df = _late_table(spark, 300, 9)
    left = df.where("seq % 2 = 0").select("seq", "k", F.col("ts").alias("lts"), "b", F.col("seq").alias("l"))
    right = df.where("seq % 2 = 1").select("seq", F.col("k").alias("rk"), F.col("ts").alias("rts"), "b", F.col("seq").alias("r"))
    got = sorted((x.l, x.r) for x in joins.interval_join_grace(left, right, "k", "lts", "rts", 3600, 1800, ["b"], ["seq"], 1200, "rk").collect())
    st, kept = {}, []
    for seq, k, ts, b in rows:
        st[b] = max(st.get(b, ts), ts)
        close = dt.timedelta(seconds=(1200 if seq % 2 == 0 else 3600) + 1800)
        if ts + close >= st[b]:
            kept.append((seq, k, ts))
    want = sorted((x[0], y[0]) for x in kept if x[0] % 2 == 0 for y in kept if y[0] % 2 and x[1] == y[1]
                  and x[2] - dt.timedelta(seconds=3600) <= y[2] <= x[2] + dt.timedelta(seconds=1200))
    assert got == want and 0 < len(kept) < len(rows)
    dropped = {r[0] for r in rows} - {x[0] for x in kept}
    assert {s % 2 for s in dropped} == {0, 1}                              # late rows on both sides


def test_window_closings_name_the_closing_record(spark):
    times = [0, 30, 65, 59, 66, 300, 180]
    df = spark.createDataFrame([(i, 0, T0 + dt.timedelta(seconds=t)) for i, t in enumerate(times)], "seq long, b int, ts timestamp_ntz")
    got = sorted((r.window_end, r.seq) for r in win.window_closings(df, ["b"], ["seq"], "ts", "60 seconds", "5 seconds").collect())
    # the window before the first record may still take records until seq 1 closes it
    assert got == [(T0, 1), (T0 + dt.timedelta(seconds=60), 2), (T0 + dt.timedelta(seconds=120), 5)]
    assert win.window_closings(df.limit(0), ["b"], ["seq"], "ts", "60 seconds", "5 seconds").isEmpty()


def test_titles_are_seen_from_their_arrival(spark):
    """A change before its title is dropped, a rename shows from its arrival, a delete ends it."""
    titles = spark.createDataFrame([(1, "late title", 11), (1, "renamed", 12), (1, None, 13)], "id int, title string, seq long")
    got = apps.change_counts(titles, _changes(spark)).collect()
    assert {(r.window_start.hour, r.change_count, r.title) for r in got} == {(10, 1, "late title"), (11, 1, "renamed")}


def test_old_windows_leave_the_change_counts(spark):
    ch = _changes(spark)
    far = spark.createDataFrame([("1", 9, 1, "season_length", (1, 1), (1, 2), "2021-03-20 10:00:00", 50)], ch.schema)
    titles = spark.createDataFrame([(1, "t", 0)], "id int, title string, seq long")
    assert [r.window_start.day for r in apps.change_counts(titles, ch.unionByName(far)).collect()] == [20]


def test_pulse_without_time_counts_in_its_partitions_time(spark):
    lines = _pulse_lines()
    lines.insert(60, '1|{"timestamp": null}')
    assert [r.heart_rate for r in apps.pulse_counts(_lines(spark, lines)).collect()] == [121]


def test_late_temperature_raises_no_alert(spark):
    """61 s behind stream time and 10 s of grace: a reading at 09:03:06.5 after one at 09:04:17 is dropped."""
    late = ['1|{"timestamp": "2020-11-23T09:04:17.000Z", "temperature": 101.0, "unit": "F"}',
            '1|{"timestamp": "2020-11-23T09:03:06.500Z", "temperature": 101.2, "unit": "F"}']
    assert apps.vitals_alerts(_lines(spark, _pulse_lines()), _lines(spark, late, 1000)).isEmpty()
    in_time = [late[0].replace("09:04:17", "09:04:16"), late[1]]
    assert apps.vitals_alerts(_lines(spark, _pulse_lines()), _lines(spark, in_time, 1000)).count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_score_bounds_drop_rows_but_no_result(spark, seed):
    rng = random.Random(seed)
    special = [float("nan"), float("inf"), float("-inf"), None, 0.0]
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), rng.choice(special) if rng.random() < 0.02 else float(rng.randrange(2_000)), i) for i in range(6_000)]
    rows += [(4, 1.0, 10_000), (5, None, 10_001)]
    df = spark.createDataFrame(rows, "g int, score double, seq long").repartition(3)
    bounds = topk.score_bounds(df, ["g"], "score", ["seq"], 3)
    with_, without = (topk.top_k_distinct(df, ["g"], "score", ["seq"], 3, bounds=b) for b in (bounds, None))
    show = lambda d: sorted((r.g is None, r.g or 0, r["rank"], r.seq) for r in d.collect())
    assert show(with_) == show(without)
    left = df.join(bounds, F.col("g").eqNullSafe(F.col("__g0")), "left").where("__bound is null or score >= __bound")
    assert left.count() < 0.5 * len(rows)                                  # most rows are never shuffled


def test_push_query_limits_cancels_and_leaves_nothing(spark):
    path = scratch_path(spark, "push-test")
    for i in range(3):
        replay(spark, spark.range(i * 10, i * 10 + 10), "id", 1, path)
    read = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(path)
    q = push.PushQuery(spark, read(), 15, "id")
    assert [r.id for r in q.result().collect()] == list(range(15)) and q.batches >= 2 and not q.query.isActive
    all_ = push.PushQuery(spark, read(), 1_000, "id")
    assert all_.result().count() == 30
    live = push.PushQuery(spark, read(), 1_000, "id", available_now=False)
    while len(live.rows) < 30:
        time.sleep(0.1)
    replay(spark, spark.range(100, 103), "id", 1, path)                    # arrives while the query runs
    assert live.result(timeout_s=5).count() == 33 and not live.query.isActive
    fs = spark._jvm.org.apache.hadoop.fs.Path(q.checkpoint).getFileSystem(spark._jsc.hadoopConfiguration())
    assert not any(fs.exists(spark._jvm.org.apache.hadoop.fs.Path(x.checkpoint)) for x in (q, all_, live))


def test_start_position_is_kept_over_restarts(spark):
    base = scratch_path(spark, "start")

    def run(name, start):
        s = file_stream(spark, f"{base}/src", "id long", f"{base}/{name}", start)
        sinks.stream_sink(s, f"{base}/{name}-out", f"{base}/{name}").awaitTermination()
        return sorted(r.id for r in spark.read.schema("id long").parquet(f"{base}/{name}-out").collect())

    replay(spark, spark.range(0, 2), "id", 1, f"{base}/src")
    assert run("late", "latest") == [] and run("early", "earliest") == [0, 1]
    replay(spark, spark.range(2, 4), "id", 1, f"{base}/src")
    assert run("late", "earliest") == [2, 3] and run("early", "latest") == [0, 1, 2, 3]
    assert run("at", 0) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        run("odd", "somewhere")


def test_twin_state_is_one_row_a_device(spark):
    fields = ["v"]
    tw = exact.TwinCarry(spark, scratch_path(spark, "tw"), "key", ["seq", "emit_idx"], fields, buckets=2)
    rows = lambda r: spark.createDataFrame(r, "key long, seq long, emit_idx int, type string, v int")
    tw.commit(0, rows([(1, 1, 0, "DESIRED", 5), (1, 2, 0, "REPORTED", 6), (2, 3, 0, "REPORTED", 7), (None, 4, 0, "DESIRED", 1)]))
    second = rows([(1, 5, 0, "REPORTED", 8), (3, 6, 0, None, 9)])
    log = {r.key: (r.desired and r.desired.v, r.reported and r.reported.v) for r in tw.changelog(second, 1).collect()}
    assert log == {1: (5, 8), 3: (None, None)}
    tw.commit(1, second)
    assert {r.key: (r.desired and r.desired.v, r.reported and r.reported.v) for r in tw.store.read().collect()} == \
           {1: (5, 8), 2: (None, 7), None: (1, None), 3: (None, None)}


def test_hot_key_in_one_batch_uses_no_python_worker(spark):
    """A device with nearly all rows of a batch is split by the ordered scan; no plan step hands a key to Python."""
    from streamtab.operators.scan import ScanConfig, set_scan_config
    prev = set_scan_config(ScanConfig(chunk_rows=512))
    try:
        n = 60_000
        df = spark.range(n).select(F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(-1).alias("key"), F.col("id").alias("seq"), F.lit(0).alias("emit_idx"),
                                   F.when(F.col("id") % 2 == 0, "DESIRED").otherwise("REPORTED").alias("type"), F.col("id").alias("v"))
        tw = exact.TwinCarry(spark, scratch_path(spark, "tw"), "key", ["seq", "emit_idx"], ["v"])
        log = tw.changelog(df, 0)
        plan = log._jdf.queryExecution().executedPlan().toString()
        assert "__chunk" in plan and "Python" not in plan and "Pandas" not in plan
        last = log.where("key = -1").orderBy(F.col("seq").desc()).first()
        assert (last.desired.v, last.reported.v) == (n - 2, n - 1) and log.count() == n
    finally:
        set_scan_config(prev)


def test_typed_sink_refuses_missing_fields(spark):
    from streamtab.sources import schemas as S
    with pytest.raises(sinks.SchemaMismatch):
        sinks.enforce(spark.createDataFrame([(1,)], "id long"), S.ENTITY_SENTIMENT)
    path = scratch_path(spark, "ins")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", S.SEASON_LENGTH)])
    sinks.insert_rows(spark, path, schema, [(1, (2, 3)), (2, None)])
    sinks.insert_rows(spark, path, schema, [(3, (None, 4))])
    assert sorted((r.id, r.x and tuple(r.x)) for r in spark.read.schema(schema).parquet(path).collect()) == [(1, (2, 3)), (2, None), (3, (None, 4))]


def test_timestamp_policies(spark):
    df = spark.createDataFrame([(1, T0), (2, None)], "i int, t timestamp_ntz")
    assert win.event_time_with_fallback(df, ["i"], ["i"], "t", "e", "skip").count() == 1
    with pytest.raises(Exception, match="missing event timestamp"):
        win.event_time_with_fallback(df, ["i"], ["i"], "t", "e", "fail").collect()


def test_entry_survives_a_missing_module_of_the_optional_part(tmp_path):
    """Without a module that only the training-data operators import, the rest stays registered."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.modules['xxhash'] = None;\n"
            "import builtins; real = builtins.__import__\n"
            "def no(name, *a, **k):\n"
            "    if name in ('xxhash', 'corpus_pipeline'): raise ModuleNotFoundError(name, name=name)\n"
            "    return real(name, *a, **k)\n"
            "builtins.__import__ = no\n"
            f"import importlib.util as u; s = u.spec_from_file_location('e', {root!r} + '/__spark_entry__.py'); m = u.module_from_spec(s); s.loader.exec_module(m)\n"
            "print(len(m.queries()), m.LLM_QUERIES)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[0]) >= 70 and out.stdout.strip().endswith("{}")

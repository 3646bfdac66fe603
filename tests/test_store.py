"""Versioned stores: merges, replays, expiry, snapshots, and lookups that only read."""

from pyspark.sql import functions as F

from streamtab.operators import lookups
from streamtab.operators.store import TableStore, day_of, hash_buckets, merge_latest, merge_sums
from streamtab.plans import catalog
from streamtab.session import scratch_path
from streamtab.sources.tables import fingerprint

from .conftest import SF001


def _counts(spark, rows):
    return spark.createDataFrame(rows, "k long, window_start timestamp_ntz, n long") if rows else \
        spark.createDataFrame([], "k long, window_start timestamp_ntz, n long")


def _day(d):
    import datetime as dt
    return dt.datetime(2024, 1, d)


def _rows(df):
    return sorted((r.k, r.window_start.day, r.n) for r in df.collect())


def SUM(rows):
    return merge_sums(["k", "window_start"], n=F.sum("n"))(rows)


def _window_store(spark):
    return TableStore(spark, scratch_path(spark, "st"), day_of("window_start"))


def test_merge_touches_only_changed_partitions_and_replays_are_exact(spark):
    st = _window_store(spark)
    assert st.read() is None
    st.commit(0, _counts(spark, [(1, _day(1), 2), (2, _day(1), 1), (1, _day(2), 5)]), SUM)
    st.commit(1, _counts(spark, [(1, _day(2), 1), (1, _day(2), 1), (3, _day(3), 1)]), SUM)
    want = [(1, 1, 2), (1, 2, 7), (2, 1, 1), (3, 3, 1)]
    assert _rows(st.read()) == want
    assert st._manifest(1)[0] == {"2024-01-01": 0, "2024-01-02": 1, "2024-01-03": 1}
    st.commit(1, _counts(spark, [(1, _day(2), 1), (1, _day(2), 1), (3, _day(3), 1)]), SUM)       # replayed
    assert _rows(st.read()) == want and _rows(st.read(before=1)) == [(1, 1, 2), (1, 2, 5), (2, 1, 1)]


def test_expired_partitions_leave_disk_and_late_changes_to_them_are_dropped(spark):
    st = _window_store(spark)
    st.commit(0, _counts(spark, [(1, _day(d), d) for d in (1, 2, 3)]), SUM)
    st.commit(1, _counts(spark, [(1, _day(1), 9), (1, _day(4), 4), (1, _day(3), 1)]), SUM, expire_before="2024-01-03")
    assert _rows(st.read()) == [(1, 3, 4), (1, 4, 4)]
    st.commit(2, _counts(spark, [(1, _day(4), 1)]), SUM, expire_before="2024-01-04")
    st.commit(3, _counts(spark, []), SUM)
    assert _rows(st.read()) == [(1, 4, 5)]
    assert st._numbers("data", complete=False) == [2]                       # folders of expired days are gone


def test_a_reader_keeps_its_version(spark):
    st = _window_store(spark)
    st.commit(0, _counts(spark, [(1, _day(1), 1)]), SUM)
    held = st.read()
    st.commit(1, _counts(spark, [(1, _day(1), 1), (2, _day(2), 1)]), SUM)
    assert _rows(held) == [(1, 1, 1)] and _rows(st.read()) == [(1, 1, 2), (2, 2, 1)]


def test_a_version_without_manifest_does_not_exist(spark):
    st = _window_store(spark)
    st.commit(0, _counts(spark, [(1, _day(1), 1)]), SUM)
    spark.range(3).write.parquet(f"{st.path}/data/v=1/p=2024-01-01")        # a job that died before its manifest
    assert _rows(st.read()) == [(1, 1, 1)] and st.versions() == [0]
    st.commit(1, _counts(spark, [(1, _day(1), 4)]), SUM)
    assert _rows(st.read()) == [(1, 1, 5)]


def test_latest_merge_with_deletes(spark):
    st = TableStore(spark, scratch_path(spark, "kv"), hash_buckets(["k"], 4))
    rows = lambda r: spark.createDataFrame(r, "k long, seq long, name string, dead boolean")
    merge = merge_latest(["k"], ["seq"], ["name", "dead"], ~F.col("dead"))
    st.commit(0, rows([(i, i, f"n{i}", False) for i in range(20)]), merge)
    st.commit(1, rows([(3, 30, None, True), (4, 31, "new", False), (5, 2, "older", False), (None, 40, "null key", False)]), merge)
    got = {r.k: r.name for r in st.read().collect()}
    assert 3 not in got and got[4] == "new" and got[5] == "n5" and got[None] == "null key" and len(got) == 20


def test_second_lookup_starts_no_upstream_scan(spark):
    of, calls = fingerprint(spark, SF001, "orders"), []

    def build():
        calls.append(1)
        return catalog.leaderboard_array(spark, SF001)
    name = "t-" + scratch_path(spark, "x").rsplit("-", 1)[1]
    first = lookups.opened(spark, name, of, build, keys=["n_nationkey"])
    again = lookups.opened(spark, name, of, build, keys=["n_nationkey"])
    assert calls == [1] and again.count() == first.count() > 0
    plan = lookups.store_get(again, "n_nationkey", 7)._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan and "n_nationkey" in plan.split("PushedFilters")[1]
    assert fingerprint(spark, SF001, "orders") == of != fingerprint(spark, SF001, "customer")

"""t1/t2: every registered query equals its SQL oracle.

* all queries at sf0.001 with the default scan configuration;
* the queries built on the skew-safe scan again at sf0.01 with a tiny hot-key
  threshold, so hot keys are split into many chunks and the prefix/join-back
  path is checked against the plain-window SQL.
"""

import pytest

from streamtab.operators.scan import ScanConfig, set_scan_config
from streamtab.plans.catalog import QUERIES
from streamtab.plans.oracle import ORACLE_SQL
from streamtab.plans.verify import compare

from .conftest import SF001, SF01

SCAN_QUERIES = ["stream_table_asof", "tumbling_refining", "tumbling_grace", "late_rows", "session_count",
                "event_time_fallback", "twin_changelog", "ctas_counts"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle_sf0001(spark, duck001, name):
    r = compare(spark, name, SF001, duck001)
    assert r["cols_match"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", SCAN_QUERIES)
def test_hot_key_path_matches_oracle_sf001(spark, duck01, name):
    prev = set_scan_config(ScanConfig(chunk_rows=8))
    try:
        r = compare(spark, name, SF01, duck01)
    finally:
        set_scan_config(prev)
    assert r["values_match"], r


@pytest.mark.parametrize("name", ["stream_tumbling_final", "stream_interval_join", "stream_latest_table",
                                  "stream_twin_changelog", "stream_leaderboard", "stream_ctas_counts"])
def test_stream_query_matches_batch_oracle_sf0001(spark, duck001, name):
    r = compare(spark, name, SF001, duck001)
    assert r["values_match"], r


def test_registered_names_are_unique_and_complete():
    from streamtab.plans.streams import STREAM_ORACLE_SQL, STREAM_QUERIES
    assert not set(QUERIES) & set(STREAM_QUERIES)
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(STREAM_QUERIES) == set(STREAM_ORACLE_SQL)

"""The change counts are emitted for every window, also those open at the end of input."""

from streamtab.plans import catalog, streams
from streamtab.plans.oracle import ORACLE_SQL
from streamtab.plans.verify import compare

from .conftest import SF001


def test_ctas_stream_emits_open_windows(spark, duck001):
    got, want = streams.stream_ctas_counts(spark, SF001), catalog.ctas_counts(spark, SF001)
    cols = ["title_id", "season_id", "window_start", "change_count", "episode_count"]
    assert got.select(cols).exceptAll(want.select(cols)).isEmpty() and want.select(cols).exceptAll(got.select(cols)).isEmpty()
    assert streams.STREAM_ORACLE_SQL["stream_ctas_counts"] == ORACLE_SQL["ctas_counts"]
    r = compare(spark, "stream_ctas_counts", SF001, duck001)
    assert r["values_match"], r

"""Plan shape: the physical plans keep the properties the scale design relies on."""

from streamtab.operators.scan import ScanConfig, set_scan_config
from streamtab.plans.catalog import QUERIES

from .conftest import SF001


def _plan(spark, name, aqe=False):
    spark.conf.set("spark.sql.adaptive.enabled", str(aqe).lower())
    try:
        df = QUERIES[name](spark, SF001)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_topk_partial_limit_before_shuffle_and_hash_aggregate(spark):
    p = _plan(spark, "leaderboard_top3")
    assert p.count("WindowGroupLimit") >= 2          # partial (map side) + final
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_hot_keys_are_chunked(spark):
    prev = set_scan_config(ScanConfig(chunk_rows=1))
    try:
        p = _plan(spark, "tumbling_refining")
    finally:
        set_scan_config(prev)
    assert "__chunk" in p and "BroadcastExchange" in p


def test_text_flow_reads_once_and_filters_before_explode(spark):
    p = _plan(spark, "entity_sentiment")
    assert p.count("FileScan") == 1 and "lambdafunction" in p.split("Generate inline")[1].split("\n")[0]


def test_stream_filters_stay_above_the_watermark(spark):
    from streamtab.streaming import jobs
    from streamtab.streaming.sources import event_time, table_stream
    from pyspark.sql import functions as F
    e = event_time(table_stream(spark, SF001, "events").select("event_id", "ts", "value")).withWatermark("ts", "1 hour")

    def optimized(df):
        return spark._jsparkSession.sessionState().optimizer().execute(df._jdf.queryExecution().analyzed()).toString()

    p, plain = optimized(jobs.above_watermark(e, "ts", F.col("value") > 150)), optimized(e.where(F.col("value") > 150))
    assert p.index("Filter") < p.index("EventTimeWatermark")
    assert plain.index("Filter") > plain.index("EventTimeWatermark")      # what the helper prevents


def test_no_hot_keys_plain_window(spark):
    p = _plan(spark, "tumbling_refining")
    assert "__chunk" not in p and p.count("Exchange hashpartitioning") == 1


def test_interval_join_is_bucketed_equi_join(spark):
    p = _plan(spark, "interval_join")
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    assert "__jb" in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = QUERIES["filter_not_error"](spark, SF001)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)" in p or "GreaterThan(value,100.0)" in p
    assert "props" not in p.split("ReadSchema:")[1].split("\n")[0]

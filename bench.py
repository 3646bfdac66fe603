"""Benchmark: every registered batch query at $BENCH_SF_DIR on

Each query is planned and fully executed into Spark's ``noop`` sink (every row
is produced, nothing is collected to the driver).  One warm-up pass, then the
median of ``$BENCH_RUNS`` (default 5) timed runs per query.  Plan construction
(including the small hot-key check of ordered scans) is inside the timing.
Prints ONE JSON line; ``headline`` sums the 18 headline queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

STREAMING = ["stream_tumbling_final", "stream_tumbling_grace", "stream_twin_changelog", "stream_leaderboard",
             "stream_change_monitoring", "stream_ctas_exact"]

HEADLINE = [
    "ctas_counts", "leaderboard_top3", "interval_join", "vitals_alerts", "stream_table_asof",
    "tumbling_grace", "tumbling_refining", "twin_changelog", "twin_ttl", "session_count", "sliding_sum",
    "latest_table_tombstones", "entity_sentiment", "event_time_fallback", "hopping_count",
    "stream_table_join", "global_table_join", "latest_by_offset",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    from streamtab.plans.registry import QUERIES, STREAM_QUERIES
    names = sys.argv[1:] or list(QUERIES)
    from streamtab.session import get_session
    mem = os.environ.get("BENCH_MEM", "16g")
    spark = get_session(f"local[{cpus}]", partitions=int(cpus), extra={"spark.driver.memory": mem})
    times = {}
    for n in names:
        fn = QUERIES[n]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        ts = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t0)
        times[n] = round(statistics.median(ts), 3)
    # streaming forms: one availableNow run each over the whole table (fresh
    # checkpoint per run), reported separately; $BENCH_STREAMS=0 skips them
    stream_times = {}
    if os.environ.get("BENCH_STREAMS", "1") != "0" and not sys.argv[1:]:
        for n in STREAMING:
            try:
                t0 = time.perf_counter()
                STREAM_QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
                stream_times[n] = round(time.perf_counter() - t0, 3)
            except Exception as e:  # noqa: BLE001 - keep the batch numbers
                stream_times[n] = f"error: {type(e).__name__}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf, "cpus": int(cpus), "runs": runs, "driver_memory": mem,
        "headline": round(sum(v for k, v in times.items() if k in HEADLINE), 3),
        "stream_queries": stream_times,
        "conf": {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled",
                                                 "spark.sql.adaptive.skewJoin.enabled",
                                                 "spark.sql.autoBroadcastJoinThreshold",
                                                 "spark.sql.files.maxPartitionBytes")},
    }))
    spark.stop()


if __name__ == "__main__":
    main()

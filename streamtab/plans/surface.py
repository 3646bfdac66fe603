"""Sources, sinks and standing queries on the driver's tables: start positions (S17),
typed records (S10-S12), literal rows (S15), peek and print (P13, P14), timestamp
policies (F8), describe (Q12), push queries (Q9) and chained persistent ones (Q10, Q11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import lookups, stateless as st, windows as win
from ..session import scratch_path
from ..sources import schemas as S
from ..sources import sinks
from ..sources.declared import declare_stream
from ..streaming import exact
from ..streaming.push import PushQuery
from ..streaming.sources import file_stream, replay, table_stream
from . import catalog as C
from .oracle import _CSAS, DAY_BUCKET, ORACLE_SQL as O

SLICES = 3
PUSH_LIMIT = 100


# ---- batch ------------------------------------------------------------------------------

def peek_counts(spark, d):  # P13, P3: what a peek saw, and rows whose flag is null
    e = C._t(spark, d).events.withColumn("flag", F.when(F.col("event_id") % 10 != 0, F.col("value") > 100))
    seen, null_flags = Observation("seen"), Observation("null-flags")
    kept = st.peek(st.drop_where(e, F.col("flag"), null_flags), seen, F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))
    kept.write.format("noop").mode("overwrite").save()
    row = (seen.get["n"], seen.get["last_id"], null_flags.get["null_flag_rows"])
    return spark.createDataFrame([row], "kept long, last_id long, null_flags long")


def print_lines(spark, d):  # P14
    e = C._t(spark, d).events.where(F.col("event_type") == "error")
    return st.labeled(e, "errors", "user_id", "event_type").select("event_id", "line")


def event_time_skip(spark, d):  # F8: rows without a time are dropped
    e = C._t(spark, d).events.select("event_id", "user_id", F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts_raw"))
    return win.event_time_with_fallback(e, ["user_id"], ["event_id"], "ts_raw", "event_ts", "skip").select("event_id", "user_id", "event_ts")


def describe_collections(spark, d):  # Q12
    t = C._t(spark, d)
    parts = [lookups.described(getattr(t, n)).withColumn("collection", F.lit(n)) for n in ("events", "customer", "documents")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_TITLE = T.StructType([T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
                       T.StructField("length", S.SEASON_LENGTH)])


def insert_literals(spark, d):  # S15: literal rows with a struct, appended to a written table
    path = scratch_path(spark, "titles")
    c = C._t(spark, d).customer.select(F.col("c_custkey").cast("long").alias("id"), F.col("c_name").alias("title"), F.struct(
        (F.col("c_custkey") % 5).cast("int").alias("season_id"), (F.col("c_custkey") % 13).cast("int").alias("episode_count")).alias("length"))
    sinks.write_table(c, path, _TITLE)
    sinks.insert_rows(spark, path, _TITLE, [(-1, "inserted title", (1, 8)), (-2, None, None)])
    return spark.read.schema(_TITLE).parquet(path).select("id", "title", F.col("length.season_id"), F.col("length.episode_count"))


# ---- streams ------------------------------------------------------------------------------

def stream_sentiment_records(spark, d):  # E2 with S10-S12: the seven-field record, enforced by the sink
    rows = C.entity_sentiment_of(table_stream(spark, d, "documents"))
    rec = rows.withColumns({"created_at": F.col("id") * 1000, "text": F.col("text_md5")})    # the digest stands for the text
    base = scratch_path(spark, "sentiment-records")
    sinks.stream_sink(sinks.enforce(rec, S.ENTITY_SENTIMENT), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(S.ENTITY_SENTIMENT).parquet(f"{base}/out")


def _slices(spark, d, path: str, which: range, df: DataFrame | None = None) -> None:
    """Write the slices ``which`` of the events (equal ranges of event_id) as files below ``path``."""
    e = C._t(spark, d).events if df is None else df
    lo, hi = e.agg(F.min("event_id"), F.max("event_id")).first()
    width = (hi - lo) // SLICES + 1
    for i in which:
        replay(spark, e.where((F.col("event_id") >= lo + i * width) & (F.col("event_id") < lo + (i + 1) * width)), "event_id", 1, path)


def stream_from_latest(spark, d):  # S17: only what comes after the first start, across a restart
    base = scratch_path(spark, "from-latest")
    schema = C._t(spark, d).events.schema

    def run():
        s = file_stream(spark, f"{base}/src", schema, f"{base}/checkpoint", "latest").select("event_id", "user_id", "value")
        sinks.stream_sink(s, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    for i in range(SLICES):
        _slices(spark, d, f"{base}/src", range(i, i + 1))
        run()
    return spark.read.schema("event_id long, user_id long, value double").parquet(f"{base}/out")


def stream_push_changes(spark, d):  # Q9: SELECT ... EMIT CHANGES LIMIT 100
    path = scratch_path(spark, "push-src")
    e = C._t(spark, d).events
    _slices(spark, d, path, range(SLICES))
    s = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return PushQuery(spark, s.where(F.col("value") > 100).select("event_id", "user_id", "value"), PUSH_LIMIT, "event_id").result()


def stream_persistent_chain(spark, d):  # Q10 -> Q11: one standing query feeds the next, both stopped and resumed
    base = scratch_path(spark, "chain")
    raw = C._production_changes(spark, d).withColumn("event_id", F.col("uuid"))
    changes = T.StructType([f for f in C._season_length_changes(spark, d).schema.fields])
    last = F.struct("uuid", F.col("new_episode_count").alias("v"))
    result = exact.WindowCounts(spark, f"{base}/counts", ["title_id", "season_id"], {
        "change_count": (F.count(F.lit(1)), F.sum("change_count")),
        "last": (F.max_by(last, F.when(F.col("new_episode_count").isNotNull(), F.col("uuid"))), F.max_by("last", "last.uuid"))})

    def csas():
        s = file_stream(spark, f"{base}/src", raw.schema, f"{base}/csas", max_files_per_trigger=1)
        sinks.stream_sink(sinks.enforce(C._season_length_select(s), changes), f"{base}/changes", f"{base}/csas").awaitTermination()

    def ctas():
        s = file_stream(spark, f"{base}/changes", changes, f"{base}/ctas", max_files_per_trigger=1)

        def body(rows, i):
            w = declare_stream(rows, timestamp="created_at").withColumn("w", F.window("event_ts", "1 day"))
            result.commit(i, win.with_bounds(w, "w"))
        exact.run_batches(spark, s, "ctas", body, f"{base}/ctas-run")

    for i in range(SLICES):                              # every round both go on from their checkpoints
        _slices(spark, d, f"{base}/src", range(i, i + 1), raw)
        csas()
        ctas()
    return result.read().select("title_id", "season_id", "window_start", "window_end", "change_count", F.col("last.v").alias("episode_count"))


QUERIES = {f.__name__: f for f in (peek_counts, print_lines, event_time_skip, describe_collections, insert_literals)}
STREAM_QUERIES = {f.__name__: f for f in (stream_sentiment_records, stream_from_latest, stream_push_changes, stream_persistent_chain)}

ORACLE_SQL = {
    "peek_counts": """
      SELECT count(*) FILTER (NOT flag) AS kept, max(event_id) FILTER (NOT flag) AS last_id, count(*) FILTER (flag IS NULL) AS null_flags
      FROM (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN value > 100 END AS flag FROM events)""",
    "print_lines": "SELECT event_id, '[errors]: ' || user_id || ', ' || event_type AS line FROM events WHERE event_type = 'error'",
    "event_time_skip": "SELECT event_id, user_id, ts AS event_ts FROM events WHERE event_id % 7 <> 0",
    "describe_collections": """
      SELECT CAST(ordinal_position AS INTEGER) AS position, column_name AS name, table_name AS collection,
             CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
                            WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' ELSE lower(data_type) END AS type
      FROM information_schema.columns WHERE table_name IN ('events', 'customer', 'documents')""",
    "insert_literals": """
      SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS title, CAST(c_custkey % 5 AS INTEGER) AS season_id, CAST(c_custkey % 13 AS INTEGER) AS episode_count FROM customer
      UNION ALL VALUES (-1, 'inserted title', 1, 8), (-2, NULL, NULL, NULL)""",
}
STREAM_ORACLE_SQL = {
    "stream_sentiment_records": f"""
      SELECT id * 1000 AS created_at, id, entity, text_md5 AS text, sentiment_score, sentiment_magnitude, salience FROM ({O['entity_sentiment']})""",
    "stream_from_latest": f"""
      SELECT event_id, user_id, value FROM events
      WHERE event_id >= (SELECT min(event_id) + (max(event_id) - min(event_id)) // {SLICES} + 1 FROM events)""",
    "stream_push_changes": f"SELECT event_id, user_id, value FROM events WHERE value > 100 ORDER BY event_id LIMIT {PUSH_LIMIT}",
    "stream_persistent_chain": f"""
      SELECT title_id, season_id, window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS change_count,
             arg_max(new_episode_count, CASE WHEN new_episode_count IS NOT NULL THEN uuid END) AS episode_count
      FROM (SELECT *, {DAY_BUCKET} AS window_start FROM (SELECT *, strptime(created_at, '%Y-%m-%d %H:%M:%S') AS ts FROM ({_CSAS})))
      GROUP BY title_id, season_id, window_start""",
}

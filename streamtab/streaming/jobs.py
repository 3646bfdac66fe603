"""Streaming forms of the operators.

All are lazy streaming DataFrames (or, for stream-table joins that must see
table updates, a ``foreachBatch`` body); :mod:`.runner` executes them.

Notes on Spark semantics versus the reference (see SURVEY H1-H7):
* the watermark is global per query and advances per micro-batch, so grace
  periods act at batch granularity; exact per-record lateness is the batch
  form (``windows.mark_late``);
* a filter below a watermark can stall event time (H2) - filters on watermarked
  inputs here go through ``above_watermark``;
* a stream-static join reads a static snapshot (H7); ``live_table_join``
  re-reads the table in every micro-batch instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import joins
from ..operators.windows import _seconds
from .processors import (AsOfJoinProcessor, GraceProcessor, TopKDistinctProcessor, TwinProcessor,
                         twin_output_schema)


def _as_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """64-bit integers as text: next to nulls pandas would turn them into
    doubles, which hold 53 bits."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def _as_long(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in cols})


def _longs(schema: T.StructType, cols) -> list[str]:
    return [c for c in cols if isinstance(schema[c].dataType, T.LongType)]


def above_watermark(df: DataFrame, ts: str, cond: Column) -> DataFrame:
    """Filter that stays above the watermark on ``ts`` (H2): rows it drops still
    move event time on.  The optimizer pushes a predicate below a watermark
    unless it reads the event time, so this one compares with it; rows without
    event time are dropped."""
    return df.where(F.coalesce(cond, F.lit(False)).eqNullSafe(F.unix_micros(ts) > F.lit(-(2 ** 63))))


def windowed_final(stream: DataFrame, keys: list[str], ts: str, size: str, grace: str,
                   aggs: list[Column], slide: str | None = None) -> DataFrame:
    """Windowed aggregate emitted once per window when the watermark
    (max event time - grace) passes its end (append mode)."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (stream.withWatermark(ts, grace).groupBy(*keys, w.alias("window")).agg(*aggs)
                  .withColumn("window_start", F.col("window.start"))
                  .withColumn("window_end", F.col("window.end")).drop("window"))


def session_final(stream: DataFrame, keys: list[str], ts: str, gap: str, grace: str,
                  aggs: list[Column]) -> DataFrame:
    """W8 streaming: Spark's session windows, final in append mode."""
    return (stream.withWatermark(ts, grace).groupBy(*keys, F.session_window(ts, gap).alias("window"))
                  .agg(*aggs).withColumn("window_start", F.col("window.start"))
                  .withColumn("window_end", F.col("window.end")).drop("window"))


def interval_join(left: DataFrame, right: DataFrame, key: str, right_key: str, left_ts: str, right_ts: str,
                  bound_s: int, left_delay: str, right_delay: str, left_keep: Column | None = None,
                  right_keep: Column | None = None) -> DataFrame:
    """J4 streaming: both sides watermarked; the time-range condition lets Spark
    drop join state older than watermark - bound (append mode).  ``left_keep``
    and ``right_keep`` filter above the watermarks."""
    lw = left.withWatermark(left_ts, left_delay)
    rw = right.withWatermark(right_ts, right_delay)
    lw = lw if left_keep is None else above_watermark(lw, left_ts, left_keep)
    rw = rw if right_keep is None else above_watermark(rw, right_ts, right_keep)
    cond = (F.col(key) == F.col(right_key)) & \
           (F.col(right_ts) >= F.col(left_ts) - F.expr(f"INTERVAL {bound_s} SECONDS")) & \
           (F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {bound_s} SECONDS"))
    return lw.join(rw, cond, "inner")


def live_table_join(load_table: Callable[[], DataFrame], on, how: str = "inner",
                    out_fmt: str = "parquet") -> Callable[[DataFrame, int, str], None]:
    """J1 streaming with a table that changes while the job runs (H7): the
    ``foreachBatch`` body re-reads the table for every micro-batch, so each
    batch sees the table as of its processing.  The table side is joined with
    the planner's choice (broadcast only when small, else shuffle)."""
    def body(batch: DataFrame, batch_id: int, out: str) -> None:
        table = load_table()
        cond = on(batch, table) if callable(on) else on
        # one folder per batch id, overwritten on replay: exactly once per batch
        (joins.stream_table_join(batch, table, cond, how).write.mode("overwrite").format(out_fmt)
              .save(f"{out}/batch={batch_id}"))
    return body


def latest_table(stream: DataFrame, key: list[str], order: list[str], values: list[str],
                 tombstone: Column | None = None) -> DataFrame:
    """S3/T6 streaming: latest value per key as a streaming aggregate (update
    mode); tombstoned keys are reported with ``deleted = true``."""
    dead = tombstone if tombstone is not None else F.lit(False)
    rec = F.struct(*[F.col(o) for o in order], *[F.col(v) for v in values], dead.alias("deleted"))
    return (stream.groupBy(*key).agg(F.max_by(rec, F.struct(*[F.col(o) for o in order])).alias("r"))
                  .select(*key, "r.*"))


def twin(stream_inputs: DataFrame, key_type: T.DataType, ttl_days: int = 7,
         event_time_col: str | None = None, delay: str = "0 seconds",
         wall_clock_check_ms: int | None = None) -> DataFrame:
    """T1-T5 streaming: ``transformWithStateInPandas`` over the union of both
    inputs grouped by device key.  With ``event_time_col`` the input is
    watermarked and event-time timers implement the TTL (T4/T5); without it
    the state never expires (T1/T2 only).  ``wall_clock_check_ms`` instead
    checks every key periodically against the wall clock (T3, the reference's
    behaviour); such a query needs a processing-time trigger."""
    inp = stream_inputs
    if wall_clock_check_ms:
        proc = TwinProcessor(ttl_days, processing_check_ms=wall_clock_check_ms)
        mode = "ProcessingTime"
    elif event_time_col:
        inp = inp.withWatermark(event_time_col, delay)
        proc, mode = TwinProcessor(ttl_days, use_timers=True), "EventTime"
    else:
        proc, mode = TwinProcessor(ttl_days), "None"
    return (inp.groupBy("key")
            .transformWithStateInPandas(proc, twin_output_schema(key_type), "Update", mode))


def top_k(stream: DataFrame, key_cols: list[str], payload: T.StructType, k: int = 3) -> DataFrame:
    """A8 streaming: bounded top-k per group (update mode: every batch emits the
    current list of the groups it touched)."""
    longs = _longs(payload, payload.fieldNames())
    payload = T.StructType([T.StructField(f.name, T.StringType() if f.name in longs else f.dataType) for f in payload])
    stream = _as_text(stream, longs)
    proc = TopKDistinctProcessor(key_cols, payload, k)
    key_fields = [stream.schema[c] for c in key_cols]
    out = T.StructType(list(proc.state_schema.fields) + [T.StructField("rank", T.IntegerType())] + key_fields)
    return _as_long(stream.groupBy(*key_cols).transformWithStateInPandas(proc, out, "Update", "None"), longs)


def alerts_from_windows(pulses: DataFrame, readings: DataFrame, key: str, ts: str, reading_ts: str,
                        size: str, grace: str, min_count: int, bound_s: int,
                        reading_key: str = "r_key", reading_delay: str | None = None,
                        reading_keep: Column | None = None) -> DataFrame:
    """E4 streaming, two chained stateful operators (append mode): final
    windowed counts per key (emitted once the watermark passes window end +
    grace), filtered to ``count >= min_count``, then joined with the readings
    stream on ``|reading_ts - beat_ts| <= bound``.  ``beat_ts`` (the window's
    last event) is the aggregate's record time; the implied bounds against
    ``window_time`` let Spark evict join state by watermark (SURVEY H4)."""
    size_s = _seconds(size)
    beats = (pulses.withWatermark(ts, grace).groupBy(key, F.window(ts, size).alias("w"))
                   .agg(F.count(F.lit(1)).alias("heart_rate"), F.max(ts).alias("beat_ts")))
    high = (beats.where(F.col("heart_rate") >= min_count)
                 .select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         "heart_rate", "beat_ts", F.window_time("w").alias("__wt")))
    r = readings.withWatermark(reading_ts, reading_delay or grace)
    r = r if reading_keep is None else above_watermark(r, reading_ts, reading_keep)
    b = F.expr(f"INTERVAL {int(bound_s)} SECONDS")
    cond = ((F.col(key) == F.col(reading_key)) &
            (F.col(reading_ts) >= F.col("beat_ts") - b) & (F.col(reading_ts) <= F.col("beat_ts") + b) &
            (F.col(reading_ts) >= F.col("__wt") - F.expr(f"INTERVAL {size_s} SECONDS") - b) &
            (F.col(reading_ts) <= F.col("__wt") + b))
    return high.join(r, cond, "inner").drop("__wt")


def asof_join(stream: DataFrame, changelog: DataFrame, key: str, seq: str, stream_cols: list[str],
              table_cols: list[str], tombstone: Column | None = None) -> DataFrame:
    """J1/J2 streaming, exact arrival-order semantics: the stream and
    the table changelog are one keyed input to a stateful processor holding the
    latest table value per key, so table updates that arrive while the job runs
    are seen by later stream rows.  Column names of both sides must differ."""
    dead = tombstone if tombstone is not None else F.lit(False)
    s_part = stream.select(F.col(key).alias("asof_key"), F.col(seq).alias("seq"), F.lit(0).alias("asof_side"),
                           F.lit(False).alias("asof_dead"), *[F.col(c) for c in stream_cols if c != seq],
                           *[F.lit(None).cast(changelog.schema[c].dataType).alias(c) for c in table_cols])
    t_part = changelog.select(F.col(key).alias("asof_key"), F.col(seq).alias("seq"), F.lit(1).alias("asof_side"),
                              dead.alias("asof_dead"),
                              *[F.lit(None).cast(stream.schema[c].dataType).alias(c) for c in stream_cols if c != seq],
                              *[F.col(c) for c in table_cols])
    both = s_part.unionByName(t_part)
    out_cols = [c for c in stream_cols if c != seq] + ["seq"]
    longs = _longs(both.schema, out_cols[:-1] + table_cols)
    both = _as_text(both, longs)
    table_schema = T.StructType([both.schema[c] for c in table_cols])
    out_schema = T.StructType([both.schema[c] for c in out_cols] + list(table_schema.fields))
    proc = AsOfJoinProcessor(out_cols, table_cols, table_schema)
    return _as_long(both.groupBy("asof_key").transformWithStateInPandas(proc, out_schema, "Append", "None"), longs)


def mark_late_stream(stream: DataFrame, partition: str, seq: str, ts: str, size: str, grace: str) -> DataFrame:
    """W2/W3 streaming with the reference's exact rule: per input
    partition, in arrival order ``seq``, a row is late when its window end is
    not after the partition's stream time minus ``grace``.  Unlike a watermark
    this is per record (also inside one micro-batch) and per partition, and it
    works in front of further stateful operators.  Adds ``window_start``,
    ``window_end``, ``stream_time`` and ``is_late``; ``ts`` must be TIMESTAMP."""
    en = (stream.withColumn("seq", F.col(seq)) if seq != "seq" else stream)
    en = (en.withColumn("__w", F.window(ts, size))
            .withColumn("window_start", F.col("__w.start")).withColumn("window_end", F.col("__w.end"))
            .drop("__w")
            .withColumn("ts_us", F.unix_micros(ts)).withColumn("window_end_us", F.unix_micros("window_end")))
    longs = _longs(en.schema, [c for c in en.columns if c not in (partition, "seq", "ts_us", "window_end_us")])
    en = _as_text(en, longs)
    schema = T.StructType(list(en.schema.fields) + [T.StructField("stream_time_us", T.LongType()),
                                                    T.StructField("is_late", T.BooleanType())])
    proc = GraceProcessor(_seconds(grace) * 1_000_000)
    marked = en.groupBy(partition).transformWithStateInPandas(proc, schema, "Append", "None")
    return (_as_long(marked, longs).withColumn("stream_time", F.timestamp_micros("stream_time_us"))
                  .drop("ts_us", "window_end_us", "stream_time_us"))

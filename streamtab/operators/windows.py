"""Event-time windows and aggregations: W1-W9, A1-A7.

Batch forms are *exact* replays of the streaming semantics:

* lateness (W2/W3) uses the stream time of each row's input partition, i.e. the
  running max of event time in arrival order, computed with the skew-safe scan;
* final-only output (W4) keeps windows closed by the end of the input;
* refining output (A7) is the running count per (key, window) in arrival order.

Window bounds follow Spark: epoch-aligned, ``[start, end)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import micros
from ..session import ensure_checkpoint_dir
from .joins import broadcast_if_small
from .scan import Agg, ScanConfig, running, running_chunked, running_plain, settled, split_keys


def _seconds(spec: str | int) -> int:
    if isinstance(spec, int):
        return spec
    n, unit = spec.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    return int(n) * mult[unit.rstrip("s")]


def _interval(s: int) -> str:
    return f"{int(s)} seconds"


def with_bounds(df: DataFrame, window: str = "window") -> DataFrame:
    """Window bounds as plain columns."""
    return (df.withColumn("window_start", F.col(f"{window}.start"))
              .withColumn("window_end", F.col(f"{window}.end")).drop(window))


def windowed(df: DataFrame, keys: list[str], ts: str, size: str | int, aggs: list[Column],
             slide: str | int | None = None, drop_null_keys: bool = True) -> DataFrame:
    """W1 tumbling / W7 hopping aggregation per key (A1, A2, A4).

    Hash aggregate with partial (map-side) aggregation: a hot key contributes
    one partial row per map task and window.  Null keys are skipped, as the
    reference's grouping does.
    """
    d = df
    if drop_null_keys:
        for k in keys:
            d = d.where(F.col(k).isNotNull())
    w = F.window(ts, _interval(_seconds(size)), _interval(_seconds(slide)) if slide else None)
    return with_bounds(d.groupBy(*keys, w.alias("window")).agg(*aggs))


def max_of(df: DataFrame, col: str) -> Column:
    """Scalar subquery: the max of ``col`` over ``df`` as a Column (computed by
    one distributed aggregate, inlined into the plan as a literal)."""
    return df.select(F.max(col)).scalar()


def closed_windows(agg: DataFrame, stream_end: Column, grace: str | int,
                   end_col: str = "window_end") -> DataFrame:
    """W4 final-only: windows with ``end <= stream_end - grace`` are closed and
    emitted once; still-open windows are held back."""
    return agg.where(F.col(end_col) <= stream_end - F.expr(f"INTERVAL {_seconds(grace)} SECONDS"))


def retained(agg: DataFrame, stream_end: Column, retention: str | int,
             end_col: str = "window_end") -> DataFrame:
    """Windows still inside the retention period of the store."""
    return agg.where(F.col(end_col) > stream_end - F.expr(f"INTERVAL {_seconds(retention)} SECONDS"))


def stream_time(df: DataFrame, partition: list[str], order: list[str], ts: str,
                out: str = "stream_time", cfg: ScanConfig | None = None, prior: DataFrame | None = None) -> DataFrame:
    """Stream time of each row: highest event time seen so far (this row
    included) in its input partition, in arrival order.  ``prior`` (partition
    columns and ``st_us``, microseconds) is the stream time that earlier input left."""
    d = df.withColumn("__tsu", micros(ts))
    s = running(d, partition, order, {"__st": Agg("max", "__tsu")}, cfg)
    if prior is not None:
        p = prior.select(*[F.col(c).alias(f"__p{i}") for i, c in enumerate(partition)], F.col("st_us").alias("__before"))
        cond = [F.col(c).eqNullSafe(F.col(f"__p{i}")) for i, c in enumerate(partition)]
        s = (s.join(broadcast_if_small(p), cond, "left").withColumn("__st", F.greatest("__st", "__before"))
              .drop("__before", *[f"__p{i}" for i in range(len(partition))]))
    return (s.withColumn(out, F.timestamp_micros(F.col("__st")).cast("timestamp_ntz"))
              .drop("__tsu", "__st"))


def mark_late(df: DataFrame, partition: list[str], order: list[str], ts: str, size: str | int,
              grace: str | int, slide: str | int | None = None,
              cfg: ScanConfig | None = None, prior: DataFrame | None = None) -> DataFrame:
    """Assign windows and flag rows that arrive after their window closed.

    A row is accepted for a window while ``window_end > stream_time - grace``;
    otherwise it is late (dropped by the aggregate, kept by the side output).
    Hopping windows are checked per window.  ``prior``: see :func:`stream_time`.
    """
    st = stream_time(df, partition, order, ts, cfg=cfg, prior=prior)
    w = F.window(ts, _interval(_seconds(size)), _interval(_seconds(slide)) if slide else None)
    return (with_bounds(st.withColumn("window", w))
            .withColumn("is_late", F.col("window_end") <=
                        F.col("stream_time") - F.expr(f"INTERVAL {_seconds(grace)} SECONDS")))


def window_closings(df: DataFrame, partition: list[str], order: list[str], ts: str, size: str | int,
                    grace: str | int, cfg: ScanConfig | None = None) -> DataFrame:
    """W4 per input partition: the partition columns, ``window_end`` and the ``order``
    columns of the record at which each tumbling window closed, that is the first one
    to bring stream time to ``window_end + grace``.  Windows still open have no row.

    Only windows that may hold accepted records are named: those that end by the
    stream time before plus one window."""
    size_us, grace_us = _seconds(size) * 1_000_000, _seconds(grace) * 1_000_000
    d = df.withColumn("__tsu", micros(ts)).where(F.col("__tsu").isNotNull())
    s = running(d, partition, order, {"__st": Agg("max", "__tsu"), "__before": Agg("max", "__tsu", inclusive=False)}, cfg)
    nth = lambda c, shift=0: F.floor((F.col(c) - F.lit(shift)) / F.lit(size_us)).cast("long")
    to = F.least(nth("__st", grace_us), nth("__before") + 1)
    s = s.withColumn("__from", nth("__before", grace_us)).withColumn("__to", to).where(F.col("__to") > F.col("__from"))
    return s.select(*partition, F.explode(F.sequence(F.col("__from") + 1, F.col("__to"))).alias("__w"), *order).select(
        *partition, F.timestamp_micros(F.col("__w") * F.lit(size_us)).cast("timestamp_ntz").alias("window_end"), *order)


def refining_counts(df: DataFrame, keys: list[str], order: list[str], ts: str, size: str | int,
                    out: str = "running_count", cfg: ScanConfig | None = None) -> DataFrame:
    """Each input row emits the updated count of its (key, window)."""
    w = F.window(ts, _interval(_seconds(size)))
    d = with_bounds(df.withColumn("window", w))
    return running(d, keys + ["window_start"], order, {out: Agg("count")}, cfg)


def sessions(df: DataFrame, keys: list[str], ts: str, gap: str | int, tiebreak: str,
             aggs: list[Column] | None = None, cfg: ScanConfig | None = None,
             checkpoint: bool = True) -> DataFrame:
    """W8 session windows.  Rows at most ``gap`` apart join one session;
    ``window_end = last event + gap`` (Spark's convention).

    Skew-safe form: the previous event time per key is a running max
    (exclusive), a new session starts after a gap, and the session number is a
    running sum of starts; both are scans over the same key and order, then a
    plain hash aggregate.  Where keys are split, the second scan reads its input
    twice, so the first scan's result is checkpointed (reliable, below
    ``spark.checkpoint.dir``) instead of being recomputed.
    """
    g_us = _seconds(gap) * 1_000_000
    d = settled(df.withColumn("__tsu", micros(ts)))
    order = ["__tsu", tiebreak]
    split = split_keys(d, keys, order, cfg)
    scan = (lambda x, a: running_plain(x, keys, order, a)) if split is None else \
           (lambda x, a: running_chunked(x, keys, order, a, split))
    d = scan(d, {"__prev": Agg("max", "__tsu", inclusive=False)})
    d = d.withColumn("__new", F.when(F.col("__prev").isNull() |
                                     (F.col("__tsu") - F.col("__prev") > F.lit(g_us)), 1).otherwise(0))
    if split is not None and checkpoint:
        ensure_checkpoint_dir(d.sparkSession)
        d = d.checkpoint(eager=True)
    d = scan(d, {"__sid": Agg("sum", "__new")})
    extra = aggs or []
    out = d.groupBy(*keys, "__sid").agg(
        F.min(ts).alias("window_start"),
        (F.max(ts) + F.expr(f"INTERVAL {_seconds(gap)} SECONDS")).alias("window_end"),
        *extra)
    return out.drop("__sid")


def sliding(df: DataFrame, keys: list[str], ts: str, size: str | int, value: str) -> DataFrame:
    """W9 record-aligned sliding aggregation: for every row, count and sum of
    ``value`` over the same key with event time in ``[ts - size, ts]``.

    A range-frame window per (key, 4*size bucket) plus context rows (the last
    ``size`` of the previous bucket), so a hot key is spread over its buckets.
    Each frame is summed from its own rows: an infinity, NaN or huge value
    counts only in the frames that hold it."""
    size_us = _seconds(size) * 1_000_000
    width = 4 * size_us
    d = df.withColumn("__tsu", micros(ts)).withColumn("__b", F.floor(F.col("__tsu") / F.lit(width)).cast("long"))
    home = d.withColumn("__ctx", F.lit(False))
    ctx = (d.where(F.col("__tsu") >= (F.col("__b") + 1) * F.lit(width) - F.lit(size_us))
             .withColumn("__b", F.col("__b") + 1).withColumn("__ctx", F.lit(True)))
    w = Window.partitionBy(*keys, "__b").orderBy("__tsu").rangeBetween(-size_us, 0)
    out = (home.unionByName(ctx).withColumn("window_count", F.count(F.lit(1)).over(w))
               .withColumn("window_sum", F.sum(value).over(w))
               .where(~F.col("__ctx")))
    return out.select(*df.columns, "window_count", "window_sum")


def event_time_with_fallback(df: DataFrame, partition: list[str], order: list[str], ts: str,
                             out: str = "event_ts", policy: str = "fallback",
                             cfg: ScanConfig | None = None) -> DataFrame:
    """Event time from ``ts``; when it is null:

    * ``fallback``: the partition time, i.e. the highest event time seen before
      this row in its input partition (running max, exclusive; skew-safe scan);
    * ``skip``: drop the row;
    * ``fail``: raise at run time.
    """
    c = F.col(ts)
    if policy == "skip":
        return df.where(c.isNotNull()).withColumn(out, c)
    if policy == "fail":
        return df.withColumn(out, F.when(c.isNull(), F.raise_error(F.lit("missing event timestamp")))
                             .otherwise(c))
    if policy != "fallback":
        raise ValueError(policy)
    d = df.withColumn("__tsu", micros(ts))
    s = running(d, partition, order, {"__pt": Agg("max", "__tsu", inclusive=False)}, cfg)
    fb = F.timestamp_micros(F.col("__pt")).cast("timestamp_ntz")
    return s.withColumn(out, F.coalesce(c, fb)).drop("__tsu", "__pt")

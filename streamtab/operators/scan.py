"""Skew-safe running aggregates in arrival order ("segmented scan").

Many stream semantics are *running* values over a key in arrival order: a
refining count, the stream time used by a grace period, the table value a
stream row sees (as-of), the merged state of a digital twin.  The textbook
Spark form is ``Window.partitionBy(key).orderBy(offset)``, which puts every row
of a key into one task.  If one key holds a third of the data that task is the
whole job.

``running`` splits every key that holds enough rows into chunks whose bounds are
quantiles of the data:

1. key and order of rows chosen by their hash (``samples`` per ``chunk_rows`` rows,
   all of them for small chunks) are written once to the shared folder; their number
   estimates the rows n of a key, which gets ``min(n / chunk_rows, sqrt(n),
   MAX_CHUNKS)`` chunks.  The bounds are evenly spaced ranks of the key's sample,
   thinned to ``samples / 4`` a chunk, as whole order tuples: bursts, gaps and ties
   of the first order column are split alike, and neither a key's bounds nor its
   thinned sample outgrow one row.  Keys of two or more chunks
   are broadcast only if their files are small;
2. each row finds its chunk by binary search in the bounds of its key (``0`` for
   the other keys);
3. the running value is computed inside each ``(key, chunk)`` window;
4. one summary row per ``(key, chunk)`` carries the chunk total; a window over
   the summaries gives the prefix of all earlier chunks, which is joined back
   on ``(key, chunk)`` and combined.

If no key has a second chunk, steps 2 and 4 have nothing to do and are left out.
An input that is more than a scan (joins, aggregates, parsing) is written once and
read back, so that its plan does not run for sample, totals and rows each.

The combine step needs an associative aggregate: count, sum, max, min and
last-non-null are provided.  The result does not depend on ``chunk_rows``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .joins import broadcast_if_small


#: Chunks of one key, at most: bounds stay one small row; larger keys get larger chunks.
MAX_CHUNKS = 1 << 14


@dataclass(frozen=True)
class ScanConfig:
    chunk_rows: int = 8192      # least mean number of rows in a chunk
    samples: int = 128          # rows sampled per chunk_rows rows; a quarter of them is kept per chunk


DEFAULT_SCAN = ScanConfig()
_current = [DEFAULT_SCAN]


def set_scan_config(cfg: ScanConfig) -> ScanConfig:
    """Replace the package-wide scan configuration; returns the previous one."""
    prev = _current[0]
    _current[0] = cfg
    return prev


def scan_config() -> ScanConfig:
    return _current[0]


@dataclass(frozen=True)
class Agg:
    """One running aggregate: ``kind`` in count/sum/max/min/last over ``col``."""
    kind: str
    col: str | None = None
    inclusive: bool = True


def _inner(a: Agg, w) -> Column:
    c = F.col(a.col) if a.col else None
    if a.kind == "count":
        return F.count(F.lit(1)).over(w) if c is None else F.count(c).over(w)
    if a.kind == "sum":
        return F.sum(c).over(w)
    if a.kind == "max":
        return F.max(c).over(w)
    if a.kind == "min":
        return F.min(c).over(w)
    if a.kind == "last":
        return F.last(c, ignorenulls=True).over(w)
    raise ValueError(a.kind)


def _total(a: Agg, order: Column) -> Column:
    """Aggregate total of one (key, chunk); ``order`` is a struct of the order
    columns so that ``last`` resolves ties exactly."""
    c = F.col(a.col) if a.col else None
    if a.kind == "count":
        return F.count(F.lit(1)) if c is None else F.count(c)
    if a.kind == "sum":
        return F.sum(c)
    if a.kind == "max":
        return F.max(c)
    if a.kind == "min":
        return F.min(c)
    if a.kind == "last":
        return F.max_by(c, F.when(c.isNotNull(), order))
    raise ValueError(a.kind)


def _prefix(a: Agg, name: str, w) -> Column:
    c = F.col(name)
    if a.kind in ("count", "sum"):
        return F.sum(c).over(w)
    if a.kind == "max":
        return F.max(c).over(w)
    if a.kind == "min":
        return F.min(c).over(w)
    return F.last(c, ignorenulls=True).over(w)


def _combine(a: Agg, prefix: Column, inner: Column) -> Column:
    if a.kind == "count":
        return F.coalesce(prefix, F.lit(0)) + F.coalesce(inner, F.lit(0))
    if a.kind == "sum":
        return F.when(prefix.isNull(), inner).when(inner.isNull(), prefix).otherwise(prefix + inner)
    if a.kind == "max":
        return F.greatest(prefix, inner)
    if a.kind == "min":
        return F.least(prefix, inner)
    return F.coalesce(inner, prefix)


def _default(dt: T.DataType) -> Column:
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                       T.DecimalType)):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit(0).cast("timestamp").cast(dt)
    return F.lit(None).cast(dt)


def _key_columns(df: DataFrame, keys: list[str], prefix: str) -> dict[str, Column]:
    """Null-safe grouping with plain equality: each key k becomes
    (coalesce(k, default), isnull(k))."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out: dict[str, Column] = {}
    for i, k in enumerate(keys):
        out[f"__{prefix}k{i}"] = F.coalesce(F.col(k), _default(types[k]))
        out[f"__{prefix}n{i}"] = F.col(k).isNull()
    return out


def settled(df: DataFrame) -> DataFrame:
    """``df`` itself where its plan only scans and projects; otherwise a copy written
    once below the shared folder."""
    if _HEAVY.search(df._jdf.queryExecution().optimizedPlan().toString()) and "void" not in df.schema.simpleString():
        path = scratch_path(df.sparkSession, "scan-input")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    return df


_HEAVY = re.compile(r"\b(Join|Aggregate|Window|Generate|Expand|from_json|get_json_object|PythonUDF|MapInArrow|MapInPandas)\b")


def _share(hash_: Column, share) -> Column:
    """Whether a hash falls in a share of its range."""
    return F.pmod(hash_, F.lit(1 << 20)) < share * F.lit(float(1 << 20))


def split_keys(df: DataFrame, keys: list[str], order: list[str], cfg: ScanConfig | None = None) -> DataFrame | None:
    """Step 1: the keys of two or more chunks with ``__bounds``, the least order tuple
    of every chunk but the first; None when there is no such key."""
    cfg = cfg or scan_config()
    spark = df.sparkSession
    kcols = _key_columns(df, keys, "s")
    names = list(kcols)
    rate = min(1.0, cfg.samples / cfg.chunk_rows)
    rows = df.select(*[c.alias(k) for k, c in kcols.items()], F.struct(*[F.col(c) for c in order]).alias("__o"))
    rows = rows.withColumn("__h", F.xxhash64(*names, "__o")).where(_share(F.col("__h"), F.lit(rate)))
    path = scratch_path(spark, "split-sample")
    rows.write.parquet(path)
    sample = spark.read.schema(rows.schema).parquet(path)
    n = F.col("__m") / F.lit(rate)
    stats = (sample.groupBy(*names).agg(F.count(F.lit(1)).alias("__m"))
                   .withColumn("__chunks", F.least(F.floor(n / F.lit(cfg.chunk_rows)), F.ceil(F.sqrt(n)), F.lit(MAX_CHUNKS)))
                   .where(F.col("__chunks") > 1))
    thin = _share(F.shiftright("__h", 20), F.col("__chunks") * F.lit(max(cfg.samples / 4, 1.0)) / F.col("__m"))
    held = sample.join(stats, names).where(thin).groupBy(*names, "__chunks").agg(F.sort_array(F.collect_list("__o")).alias("__s"))
    rank = F.transform(F.sequence(F.lit(1).cast("long"), F.col("__chunks") - 1), lambda i: F.floor(i * F.size("__s") / F.col("__chunks")))
    bounds = held.where(F.col("__chunks") > 1).select(
        *names, "__chunks", F.array_distinct(F.transform(rank, lambda r: F.get("__s", r.cast("int")))).alias("__bounds"))
    path = scratch_path(spark, "split-keys")
    bounds.write.parquet(path)
    found = spark.read.schema(bounds.schema).parquet(path)
    most = found.agg(F.max(F.size("__bounds"))).first()[0]
    if most is None:
        return None
    found.most_bounds = most                             # read by running_chunked, which else asks again
    return found


def _chunk_of(x: Column, bounds: Column, most: int) -> Column:
    """Number of sorted ``bounds`` (``most`` at most) that are not above ``x``, by binary
    search; beyond the end ``get`` is null, which is not below anything."""
    steps = [F.lit(1 << i) for i in range(most.bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*steps), F.lit(0), lambda at, step: at + F.when(
        F.get(bounds, at + step - 1) <= x, step).otherwise(0))


def running_plain(df: DataFrame, keys: list[str], order: list[str], aggs: dict[str, Agg]) -> DataFrame:
    """The window form, for inputs without hot keys: one shuffle by key (and
    chained scans over the same key reuse that partitioning)."""
    base = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order])
    w_inc = base.rowsBetween(Window.unboundedPreceding, 0)
    w_exc = base.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({n: _inner(a, w_inc if a.inclusive else w_exc) for n, a in aggs.items()})


def running(df: DataFrame, keys: list[str], order: list[str], aggs: dict[str, Agg],
            cfg: ScanConfig | None = None) -> DataFrame:
    """Add one column per entry of ``aggs``: the aggregate over all earlier rows
    of the same key in ``order`` (and the row itself when ``inclusive``).

    ``order`` holds any columns that can be ordered (an offset, ``unix_micros(ts)``;
    nulls first); later entries break ties.  Keys with null parts form their own
    group, as in SQL windows.
    """
    df = settled(df)
    split = split_keys(df, keys, order, cfg)
    return running_plain(df, keys, order, aggs) if split is None else running_chunked(df, keys, order, aggs, split)


def running_chunked(df: DataFrame, keys: list[str], order: list[str], aggs: dict[str, Agg],
                    split: DataFrame) -> DataFrame:
    """Steps 2-4 of the module docstring, for the keys in ``split``."""
    # The same columns partition the window and key the join-back, so the big
    # side keeps its partitioning through the join.
    kexpr, sk = _key_columns(df, keys, ""), list(_key_columns(df, keys, "s"))
    kcols = list(kexpr)
    df = df.withColumns(kexpr)
    cond = [F.col(k) == F.col(s) for k, s in zip(kcols, sk)]
    most = vars(split).get("most_bounds") or split.agg(F.max(F.size("__bounds"))).first()[0]
    chunk = F.when(F.col("__bounds").isNull(), 0).otherwise(
        _chunk_of(F.struct(*[F.col(c) for c in order]), F.col("__bounds"), most))
    flagged = (df.join(broadcast_if_small(split), cond, "left").withColumn("__chunk", chunk.cast("long"))
                 .drop(*sk, "__bounds", "__chunks"))

    # (3) running value inside each (key, chunk): the only full shuffle.
    part = kcols + ["__chunk"]
    ocols = [F.col(c).asc() for c in order]
    base = Window.partitionBy(*part).orderBy(*ocols)
    w_inc = base.rowsBetween(Window.unboundedPreceding, 0)
    w_exc = base.rowsBetween(Window.unboundedPreceding, -1)
    with_inner = flagged.withColumns(
        {f"__in_{n}": _inner(a, w_inc if a.inclusive else w_exc) for n, a in aggs.items()})

    # (4) chunk totals as a hash aggregate with map-side combine (the shuffle
    #     carries one partial row per (key, chunk) and task, not the data),
    #     prefix over earlier chunks (#chunks rows per key), join back on
    #     (key, chunk) - the big side is already partitioned that way.
    ordkey = F.struct(*[F.col(c) for c in order])
    totals = flagged.groupBy(*part).agg(*[_total(a, ordkey).alias(f"__tot_{n}") for n, a in aggs.items()])
    w_chunks = Window.partitionBy(*kcols).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    pk = [f"__pk{i}" for i in range(len(kcols))]
    prefixes = totals.select(*[F.col(k).alias(p) for k, p in zip(kcols, pk)],
                             F.col("__chunk").alias("__pchunk"),
                             *[_prefix(a, f"__tot_{n}", w_chunks).alias(f"__pre_{n}")
                               for n, a in aggs.items()])
    pcond = [F.col(k) == F.col(p) for k, p in zip(kcols, pk)] + \
            [F.col("__chunk") == F.col("__pchunk")]
    joined = with_inner.join(prefixes, pcond, "inner").drop(*pk, "__pchunk")
    out = joined.withColumns({n: _combine(a, F.col(f"__pre_{n}"), F.col(f"__in_{n}"))
                              for n, a in aggs.items()})
    drop = ["__chunk"] + kcols + [f"__{p}_{n}" for n in aggs for p in ("in", "pre", "tot")]
    return out.drop(*drop)


__all__ = ["Agg", "ScanConfig", "running", "running_plain", "running_chunked", "split_keys", "settled",
           "set_scan_config", "scan_config", "DEFAULT_SCAN"]

"""Joins J1, J3, J4, J6.

* J1 stream-table join (table state at query time) is an equi-join; the exact
  arrival-order replay is ``tables.asof_lookup`` (J2).
* J3 global-table join replicates the table: broadcast, but only behind a size
  check; above the limit the same join runs as a shuffle join.
* J4 windowed stream-stream join: equal keys and ``|dt| <= bound``.  Rows are
  matched inside time buckets of the bound's width, so a hot key is spread over
  many (key, bucket) tasks and candidate pairs stay proportional to the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 64 MiB: replicated side limit for J3 (Spark's own auto threshold is 10 MiB)
BROADCAST_LIMIT_BYTES = 64 << 20


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` (after column pruning), no job run."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate unavailable (e.g. remote session)
        return None


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when its estimated size is known and under ``limit``;
    otherwise ``df`` unchanged, so the planner/AQE pick a shuffle join."""
    size = estimated_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


def stream_table_join(stream: DataFrame, table: DataFrame, on, how: str = "inner") -> DataFrame:
    """J1 against the table's current state.  Sort-merge join by default; AQE
    broadcasts the table when its real size is small and splits skewed stream
    partitions (``spark.sql.adaptive.skewJoin.enabled``)."""
    return stream.join(table, on, how)


def global_table_join(stream: DataFrame, table: DataFrame, on, how: str = "inner",
                      limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Join on a key derived from the stream row; the table is replicated
    (broadcast) when it fits, so the stream is never re-shuffled."""
    return stream.join(broadcast_if_small(table, limit), on, how)


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  before_s: int, after_s: int | None = None, right_key: str | None = None) -> DataFrame:
    """``left.key = right.key AND right_ts BETWEEN left_ts - before AND left_ts + after``
    (both ends inclusive).

    Bucketing: ``b = floor(epoch_seconds / width)`` with ``width = before + after``
    (at least 1 s).  The matching right rows of one left row lie in an interval
    of length ``width``, so in at most two buckets: the left row is expanded to
    those (one or two) buckets and the join is an equi-join on ``(key, bucket)``
    plus the exact time filter.
    Returns all columns of both sides (names must not clash).
    """
    after_s = before_s if after_s is None else after_s
    right_key = right_key or key
    width = max(1, before_s + after_s)
    lsec = F.unix_micros(F.col(left_ts).cast("timestamp")) / F.lit(1_000_000)
    rsec = F.unix_micros(F.col(right_ts).cast("timestamp")) / F.lit(1_000_000)
    lo = F.floor((lsec - F.lit(before_s)) / F.lit(width)).cast("long")
    hi = F.floor((lsec + F.lit(after_s)) / F.lit(width)).cast("long")
    le = left.withColumn("__jb", F.explode(F.array_distinct(F.array(lo, hi))))
    re_ = right.withColumn("__jb", F.floor(rsec / F.lit(width)).cast("long"))
    cond = [le[key] == re_[right_key], le["__jb"] == re_["__jb"],
            re_[right_ts] >= le[left_ts] - F.expr(f"INTERVAL {int(before_s)} SECONDS"),
            re_[right_ts] <= le[left_ts] + F.expr(f"INTERVAL {int(after_s)} SECONDS")]
    out = le.join(re_, cond, "inner")
    return out.drop(le["__jb"]).drop(re_["__jb"])


def within_grace(left: DataFrame, right: DataFrame, partition: list[str], order: list[str], left_ts: str, right_ts: str,
                 before_s: int, grace_s: int, after_s: int | None = None, cfg=None,
                 prior: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """J4 grace: the records of both inputs that arrive before their join window closes.

    One stream time per input partition runs over the union of both inputs in arrival
    order (left first at one position).  A left record at t can match right ones up to
    ``t + after``; it is dropped once stream time exceeds that by more than ``grace``
    (right records accordingly, with ``before``).  ``partition`` and ``order`` are columns
    of both sides; ``prior`` (partition columns, ``st_us``) is the stream time that
    earlier input left.  Returns (left, right, new stream times)."""
    from .scan import Agg, running, settled
    after_s = before_s if after_s is None else after_s
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    keys = [F.col(p).alias(f"__p{i}") for i, p in enumerate(partition)]
    pos = [F.col(o).alias(f"__o{i}") for i, o in enumerate(order)]
    kinds = [left.select(F.struct(*left.columns).alias("r")).schema["r"].dataType, right.select(F.struct(*right.columns).alias("r")).schema["r"].dataType]
    sides = []
    for i, (d, ts, close) in enumerate(((left, left_ts, after_s), (right, right_ts, before_s))):
        row = [F.struct(*d.columns) if i == j else F.lit(None).cast(k) for j, k in enumerate(kinds)]
        sides.append(d.select(*keys, *pos, F.lit(i).alias("__side"), us(ts).alias("__us"),
                              (us(ts) + F.lit((close + grace_s) * 1_000_000)).alias("__last"), row[0].alias("__l"), row[1].alias("__r")))
    both = sides[0].unionByName(sides[1])
    names = [f"__p{i}" for i in range(len(partition))]
    s = running(both, names, [f"__o{i}" for i in range(len(order))] + ["__side"], {"__st": Agg("max", "__us")}, cfg)
    now = both.groupBy(*names).agg(F.max("__us").alias("st_us"))
    if prior is not None:
        p = prior.select(*[F.col(c).alias(f"__q{i}") for i, c in enumerate(partition)], F.col("st_us").alias("__before"))
        cond = [F.col(n).eqNullSafe(F.col(f"__q{i}")) for i, n in enumerate(names)]
        s = s.join(broadcast_if_small(p), cond, "left").withColumn("__st", F.greatest("__st", "__before"))
    kept = settled(s.where(F.col("__last") >= F.col("__st")).select("__side", "__l", "__r"))
    return (kept.where(F.col("__side") == 0).select("__l.*"), kept.where(F.col("__side") == 1).select("__r.*"),
            now.select(*[F.col(n).alias(p) for n, p in zip(names, partition)], "st_us"))


def interval_join_grace(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, before_s: int,
                        grace_s: int, partition: list[str], order: list[str], after_s: int | None = None,
                        right_key: str | None = None, cfg=None) -> DataFrame:
    """J4 as the reference runs it: :func:`interval_join` of the records that arrive
    within the grace period.  The partition and order columns of the result are the left side's."""
    lk, rk, _ = within_grace(left, right, partition, order, left_ts, right_ts, before_s, grace_s, after_s, cfg)
    rk = rk.drop(*[c for c in (*partition, *order) if c in rk.columns and c != (right_key or key)])
    return interval_join(lk, rk, key, left_ts, right_ts, before_s, after_s, right_key)


def joined_time(left_ts: str, right_ts: str) -> Column:
    """Result time of a stream-stream join: the later of the two inputs."""
    return F.greatest(F.col(left_ts), F.col(right_ts))

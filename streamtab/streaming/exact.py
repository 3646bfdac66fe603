"""Exact streaming forms: every micro-batch replays the batch operator.

A watermark judges lateness per micro-batch and keyed Python state sees whole keys.
Here ``foreachBatch`` runs the batch operators (skew-safe ordered scans) over the
rows of a micro-batch together with what earlier batches left behind, the *carry*:

* stream time per input partition (grace periods),
* the latest table value per key (as-of joins), the merged twin per device,
* the accepted rows that later ones may still join (interval joins),
* the result itself (window counts, leaderboards).

Carries are :class:`~streamtab.operators.store.TableStore` tables with one version a
batch id: a batch reads versions before its own and commits its own, so a batch that
is replayed after a failure gives the same result.  The order inside a batch is that of
its order columns; batches must arrive in that order.  No step collects rows or
gives a task a whole key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import micros
from ..operators import joins, state, tables, topk, windows
from ..operators.store import TableStore, day_of, hash_buckets, merge_latest, merge_sums
from ..session import scratch_path
from .runner import use_rocksdb


def run_batches(spark: SparkSession, sdf: DataFrame, name: str, body: Callable[[DataFrame, int], None],
                base: str | None = None) -> str:
    """Run ``body(rows, batch_id)`` per micro-batch until the input is used up.  Rows are
    written once and read back, so that a body of several jobs does not read the
    source for each.  A run with the ``base`` of an earlier one resumes it."""
    use_rocksdb(spark)
    base = base or scratch_path(spark, f"exact-{name}")

    def sink(batch: DataFrame, batch_id: int) -> None:
        path = f"{base}/in/batch={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        body(spark.read.schema(batch.schema).parquet(path), batch_id)
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)

    q = (sdf.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).start())
    q.awaitTermination()
    return base


class StreamTime:
    """Stream time per input partition, carried from batch to batch."""

    def __init__(self, spark: SparkSession, path: str, partition: list[str]):
        self.store, self.partition = TableStore(spark, path, F.lit("all")), partition

    def prior(self, batch_id: int) -> DataFrame | None:
        return self.store.read(before=batch_id)

    def mark_late(self, rows: DataFrame, batch_id: int, order: list[str], ts: str, size: str, grace: str,
                  slide: str | None = None) -> DataFrame:
        return windows.mark_late(rows, self.partition, order, ts, size, grace, slide, prior=self.prior(batch_id))

    def commit(self, batch_id: int, times: DataFrame) -> None:
        """``times``: partition columns and ``st_us`` of this batch."""
        self.store.commit(batch_id, times, merge_sums(self.partition, st_us=F.max("st_us")))

    def of(self, rows: DataFrame, ts: str) -> DataFrame:
        return rows.groupBy(*self.partition).agg(F.max(micros(ts)).alias("st_us"))


class TableCarry:
    """The latest value per key of a table changelog, for as-of joins."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: list[str], values: list[str], buckets: int = 16):
        self.key, self.order, self.values = key, order, values
        self.store = TableStore(spark, path, hash_buckets([key], buckets))

    def asof(self, stream: DataFrame, changes: DataFrame, batch_id: int, how: str = "inner", prefix: str = "t_") -> DataFrame:
        """Every stream row with the table as of its arrival.  ``changes`` holds key, order,
        values and ``dead`` (a delete)."""
        cols = [self.key, *self.order, *self.values, "dead"]
        log, before = changes.select(*cols), self.store.read(before=batch_id)
        if before is not None:                       # of earlier batches only the keys that this one asks for
            asked = stream.select(F.col(self.key)).distinct()
            log = log.unionByName(before.join(asked, self.key, "left_semi").select(*cols))
        return tables.asof_lookup(stream, log, self.key, self.order, self.values, tombstone=F.col("dead"), how=how, prefix=prefix)

    def commit(self, batch_id: int, changes: DataFrame) -> None:
        merge = merge_latest([self.key], self.order, [*self.values, "dead"], ~F.col("dead"))
        self.store.commit(batch_id, changes.select(self.key, *self.order, *self.values, "dead").where(F.col(self.key).isNotNull()), merge)


class WindowCounts:
    """A windowed result, merged per batch and kept by day.  ``aggs`` maps a
    column to (aggregate of rows, aggregate that merges partial values)."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], aggs: dict[str, tuple[Column, Column]],
                 retention_days: int | None = None):
        self.store = TableStore(spark, path, day_of("window_start"))
        self.keys, self.aggs, self.retention = [*keys, "window_start", "window_end"], aggs, retention_days

    def commit(self, batch_id: int, accepted: DataFrame, stream_end: Column | None = None, times: DataFrame | None = None) -> None:
        """Merge the accepted rows.  With a retention the days that ended before the
        greatest stream time in ``times`` less the retention are dropped."""
        expire = None
        if self.retention is not None and times is not None:
            limit = F.timestamp_micros(F.max("st_us")) - F.expr(f"INTERVAL {self.retention} DAYS")
            # a day d is over at d + 1; it stays while its end lies after the limit
            expire = times.agg(F.date_format(limit, "yyyy-MM-dd")).first()[0]
        part = accepted.groupBy(*self.keys).agg(*[a.alias(n) for n, (a, _) in self.aggs.items()])
        self.store.commit(batch_id, part, merge_sums(self.keys, **{n: m for n, (_, m) in self.aggs.items()}), expire_before=expire)

    def read(self) -> DataFrame:
        return self.store.read()


class TwinCarry:
    """Merged device state between batches, with deletion at the end of a batch."""

    SIDES = ("desired", "reported")

    def __init__(self, spark: SparkSession, path: str, key: str, order: list[str], fields: list[str], buckets: int = 16):
        self.key, self.order, self.fields = key, order, fields
        self.store = TableStore(spark, path, hash_buckets([key], buckets))

    def _with_prior(self, inputs: DataFrame, batch_id: int) -> DataFrame:
        before = self.store.read(before=batch_id)
        rows = inputs.select(self.key, *self.order, "type", *self.fields).withColumn("carried", F.lit(False))
        if before is None:
            return rows
        asked = inputs.select(self.key).distinct()
        held = before.join(asked, self.key, "left_semi")
        old = [held.where(F.col(s).isNotNull()).select(
            self.key, *[F.lit(None).cast(inputs.schema[o].dataType).alias(o) for o in self.order],   # nulls come first
            F.lit(s.upper()).alias("type"), f"{s}.*", F.lit(True).alias("carried")) for s in self.SIDES]
        return rows.unionByName(old[0]).unionByName(old[1])

    def changelog(self, inputs: DataFrame, batch_id: int) -> DataFrame:
        """The merged state after every input of the batch."""
        log = state.twin_changelog(self._with_prior(inputs, batch_id), self.key, self.order, self.fields)
        return log.where(F.col(self.order[0]).isNotNull())

    def commit(self, batch_id: int, inputs: DataFrame, now: Column | None = None, ts_field: str = "timestamp",
               ttl_days: int = state.TTL_DAYS) -> None:
        """Merge the batch's latest states; at stream time ``now`` (T4) devices whose reported
        state is ``ttl_days`` whole days old are deleted (T5), which emits nothing."""
        def present(rows: DataFrame) -> DataFrame:
            return state.twin_latest(rows, self.key, self.order, self.fields)

        fresh = present(inputs)
        # a side that a later batch sets replaces the one before
        fresh = fresh.withColumn("seen", F.lit(batch_id).cast("long"))

        def merge(rows: DataFrame) -> DataFrame:
            out = rows.groupBy(self.key).agg(
                *[F.max_by(s, F.when(F.col(s).isNotNull(), F.col("seen"))).alias(s) for s in self.SIDES], F.max("seen").alias("seen"))
            return out if now is None else state.twin_ttl(out, now, f"reported.{ts_field}", ttl_days)
        if now is not None:                                  # every bucket is looked through, not those of the batch alone
            every = self.store.read(before=batch_id)
            fresh = fresh if every is None else fresh.unionByName(every)
        self.store.commit(batch_id, fresh, merge)


class JoinBuffer:
    """Interval join with grace across batches.  Accepted rows stay in the buffer
    while a later row may still be accepted and match them."""

    def __init__(self, spark: SparkSession, path: str, key: str, right_key: str, left_ts: str, right_ts: str, bound_s: int,
                 grace_s: int, partition: list[str], order: list[str]):
        self.spark, self.path = spark, path
        self.key, self.right_key, self.left_ts, self.right_ts = key, right_key, left_ts, right_ts
        self.bound, self.grace, self.partition, self.order = bound_s, grace_s, partition, order
        self.time = StreamTime(spark, f"{path}/time", partition)
        self.held = [TableStore(spark, f"{path}/{side}", F.date_format(ts, "yyyy-MM-dd-HH"))
                     for side, ts in (("left", left_ts), ("right", right_ts))]

    def join(self, left: DataFrame, right: DataFrame, batch_id: int) -> DataFrame:
        """New pairs of this batch; also commits the buffer and the stream time."""
        lk, rk, times = joins.within_grace(left, right, self.partition, self.order, self.left_ts, self.right_ts,
                                           self.bound, self.grace, prior=self.time.prior(batch_id))
        old_l, old_r = (s.read(before=batch_id) for s in self.held)
        drop = [c for c in (*self.partition, *self.order) if c != self.right_key]
        pair = lambda a, b: joins.interval_join(a, b.drop(*drop), self.key, self.left_ts, self.right_ts, self.bound,
                                                right_key=self.right_key)
        out = pair(lk, rk)
        if old_r is not None:
            out = out.unionByName(pair(lk, old_r)).unionByName(pair(old_l, rk))
        path = f"{self.path}/out/batch={batch_id}"
        out.write.mode("overwrite").parquet(path)
        prior = self.time.prior(batch_id)
        total = times if prior is None else merge_sums(self.partition, st_us=F.max("st_us"))(times.unionByName(prior))
        # a row accepted later lies at least at (least stream time) - bound - grace, and matches back to a bound before
        least = total.agg(F.date_format(F.timestamp_micros(F.min("st_us") - F.lit((2 * self.bound + self.grace) * 1_000_000)),
                                        "yyyy-MM-dd-HH")).first()[0]
        for store, rows in zip(self.held, (lk, rk)):
            store.commit(batch_id, rows, lambda both: both, expire_before=least)
        self.time.commit(batch_id, times)
        return self.spark.read.schema(out.schema).parquet(path)


class TopK:
    """A8/A9 across batches: the bounded leaderboard of every group, merged per batch."""

    def __init__(self, spark: SparkSession, path: str, group: list[str], score: str, order: list[str], k: int, buckets: int = 8):
        self.store = TableStore(spark, path, hash_buckets(group, buckets))
        self.group, self.score, self.order, self.k = group, score, order, k

    def top(self, rows: DataFrame) -> DataFrame:
        return topk.top_k_distinct(rows, self.group, self.score, self.order, self.k)

    def commit(self, batch_id: int, rows: DataFrame) -> None:
        cols = rows.columns
        self.store.commit(batch_id, self.top(rows).select(*cols), lambda both: self.top(both).select(*cols))

    def read(self) -> DataFrame:
        return self.top(self.store.read())


__all__ = ["run_batches", "StreamTime", "TableCarry", "WindowCounts", "TwinCarry", "JoinBuffer", "TopK"]

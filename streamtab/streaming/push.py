"""Q9: transient push queries (continuous SELECT ... EMIT CHANGES [LIMIT n])."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


class PushQuery:
    """Rows of a streaming select as they arrive, at most ``limit``, held in the caller's
    memory only.  It ends by itself at the limit or when the input is used up (with
    ``available_now``), or by :meth:`cancel`; then its checkpoint is deleted, so that
    nothing stays on disk.  Rows of a micro-batch come in the order of ``order``."""

    def __init__(self, spark: SparkSession, sdf: DataFrame, limit: int, order: str, available_now: bool = True):
        self.spark, self.limit, self.rows, self.batches = spark, limit, [], 0
        self.schema, self._lock, self._full = sdf.schema, threading.Lock(), threading.Event()
        self.checkpoint = scratch_path(spark, "push")

        def take(batch: DataFrame, batch_id: int) -> None:
            with self._lock:
                if len(self.rows) < limit:
                    self.rows += batch.orderBy(order).limit(limit - len(self.rows)).collect()
                self.batches += 1
                if len(self.rows) >= limit:
                    self._full.set()

        w = sdf.writeStream.foreachBatch(take).option("checkpointLocation", self.checkpoint)
        self.query = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="200 milliseconds")).start()

    def cancel(self) -> None:
        self.query.stop()
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.checkpoint)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def result(self, timeout_s: float | None = None) -> DataFrame:
        """The rows once the limit is reached, the input is used up or the time is over."""
        end = None if timeout_s is None else time.monotonic() + timeout_s
        try:
            while not self._full.is_set() and self.query.isActive and (end is None or time.monotonic() < end):
                self._full.wait(0.05)
            if not self.query.isActive and self.query.exception() is not None:
                raise self.query.exception()
        finally:
            self.cancel()
        return self.spark.createDataFrame(self.rows, self.schema)


__all__ = ["PushQuery"]

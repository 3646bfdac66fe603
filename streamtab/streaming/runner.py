"""Run a streaming query to completion (``availableNow``) and read its result.

Checkpoints and outputs live below the shared ``spark.checkpoint.dir``; each
run takes a fresh folder, so a restarted job resumes from its own checkpoint
and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """transformWithState needs the RocksDB state store (also the right store
    for large keyed state: off-heap, spills to local disk, checkpointed)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ship_package(spark)


def run_append(spark: SparkSession, sdf: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Append-mode query into files; returns the files as a batch DataFrame."""
    use_rocksdb(spark)
    base = scratch_path(spark, f"stream-{name}")
    q = (sdf.writeStream.outputMode("append").format(fmt)
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination()
    return spark.read.format(fmt).schema(sdf.schema).load(f"{base}/out")


def run_changelog(spark: SparkSession, sdf: DataFrame, name: str, mode: str = "update") -> DataFrame:
    """Update/append query whose every emitted row is kept with its batch id
    (the table's changelog, S13).  ``foreachBatch`` writes each micro-batch to
    its own ``batch=<id>`` folder in overwrite mode, so a batch replayed after
    a failure replaces its own output: exactly once per batch id."""
    use_rocksdb(spark)
    base = scratch_path(spark, f"stream-{name}")
    out = f"{base}/out"

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = (sdf.writeStream.outputMode(mode).foreachBatch(sink)
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).start())
    q.awaitTermination()
    schema = sdf.schema.add("batch_id", "long")
    return spark.read.schema(schema).parquet(f"{out}/batch=*")


def final_rows(changelog: DataFrame, key: list[str]) -> DataFrame:
    """Rows of the last batch that emitted each key (current table content)."""
    last = changelog.groupBy(*key).agg(F.max("batch_id").alias("__last"))
    return changelog.join(last, key).where(F.col("batch_id") == F.col("__last")).drop("__last", "batch_id")


def run_foreach_batch(spark: SparkSession, sdf: DataFrame, name: str, fn) -> str:
    """Run ``fn(batch_df, batch_id, out_path)`` per micro-batch; returns the
    output path.  ``fn`` should write below ``out_path`` idempotently per batch
    id (see ``jobs.live_table_join``)."""
    use_rocksdb(spark)
    base = scratch_path(spark, f"stream-{name}")
    out = f"{base}/out"
    q = (sdf.writeStream.foreachBatch(lambda b, i: fn(b, i, out))
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).start())
    q.awaitTermination()
    return out

"""Streaming sources.

On a cluster a stream comes from Kafka (``format("kafka")`` + ``from_json``;
the connector jar is not on this classpath, so that path is configuration
only).  Here a stream is a directory of parquet/JSON files:

* ``table_stream`` streams an existing table folder/file (arrival = file order);
* ``replay`` writes a DataFrame as arrival-ordered chunk files, one file per
  chunk, so ``maxFilesPerTrigger=1`` turns each chunk into one micro-batch.
  It is a test harness for the stream = batch checks (small inputs);
* ``arrivals`` does the same for whole tables, with as many files a chunk as its
  rows need.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Files that one micro-batch takes from a table, which bounds the rows of a trigger.
MAX_FILES = 256
#: Rows of a slice of arrivals that make a file of their own, up to a file a core.
FILE_ROWS = 100_000


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = MAX_FILES,
                 fmt: str = "parquet") -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.{fmt}"
    schema = spark.read.format(fmt).load(path).schema
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # the file source needs a pattern; this one matches the table's own path alone
    return r.load(f"{path[:-1]}[{path[-1]}]")


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """S1/S17 on a cluster: key/value/timestamp/partition/offset columns.  The
    value is then decoded with :func:`streamtab.sources.json_codec.decode`."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                 .option("subscribe", topic).option("startingOffsets", starting).load()
                 .select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                         "timestamp", "partition", "offset"))


def _newest_file_ms(spark: SparkSession, path: str) -> int:
    """Modification time of the newest file below ``path`` (0 without files)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    newest, files = 0, fs.listFiles(p, True) if fs.exists(p) else None
    while files is not None and files.hasNext():
        newest = max(newest, files.next().getModificationTime())
    return newest


def file_stream(spark: SparkSession, path: str, schema, checkpoint: str, start: str | int = "earliest", fmt: str = "parquet",
                max_files_per_trigger: int = MAX_FILES) -> DataFrame:
    """A folder as a stream from a start position: ``earliest`` (all files), ``latest``
    (only files that come after the first start) or a time in epoch milliseconds.

    As with a consumer group's offsets, the position counts only where there is none
    yet: it is kept beside the checkpoint, and a restart goes on from it whatever
    ``start`` says."""
    kept = f"{checkpoint.rstrip('/')}-start"
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{kept}/_SUCCESS")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        ms = {"earliest": -1, "latest": None}.get(start, start) if isinstance(start, str) else int(start)
        ms = _newest_file_ms(spark, path) if ms is None else ms
        if not isinstance(ms, int):
            raise ValueError(f"start position {start!r}")
        spark.createDataFrame([(ms,)], "after_ms long").coalesce(1).write.mode("overwrite").json(kept)
    after = spark.read.schema("after_ms long").json(kept).first()[0]
    s = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files_per_trigger).load(path)
    if after < 0:
        return s
    return s.where(F.unix_millis(F.col("_metadata.file_modification_time")) > F.lit(after))


def event_time(df: DataFrame, col: str = "ts", out: str | None = None) -> DataFrame:
    """Watermarks need TIMESTAMP; wall-clock columns (TIMESTAMP_NTZ) are read as
    UTC instants (the session time zone is UTC)."""
    return df.withColumn(out or col, F.col(col).cast("timestamp"))


def replay(spark: SparkSession, df: DataFrame, order_col: str, chunks: int, path: str,
           fmt: str = "parquet") -> str:
    """Write ``df`` as ``chunks`` files in ascending ``order_col`` ranges."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    width = (hi - lo) // chunks + 1
    for i in range(chunks):
        part = df.where((F.col(order_col) >= lo + i * width) & (F.col(order_col) < lo + (i + 1) * width))
        part.coalesce(1).write.mode("append").format(fmt).save(path)
        time.sleep(0.02)  # distinct modification times keep the file order
    return path


def _files(spark: SparkSession, path: str) -> int:
    """Number of data files in ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return sum(1 for s in found if s.isFile() and not s.getPath().getName().startswith(("_", ".")))


def arrivals(spark: SparkSession, rows: DataFrame, order_col: str, slices: int = 3) -> DataFrame:
    """``rows`` as a stream of ``slices`` micro-batches in the order of ``order_col`` (equal
    ranges of its values).  Large slices are written, and so read, by many tasks:
    every slice has the same number of files, which one trigger takes, and empty files
    make up for tasks without rows."""
    path = scratch_path(spark, "arrivals")
    lo, hi, n = rows.agg(F.min(order_col), F.max(order_col), F.count(order_col)).first()
    width = (hi - lo) // slices + 1
    files = max(1, min(n // (slices * FILE_ROWS), spark.sparkContext.defaultParallelism))
    for i in range(slices):
        part = rows.where((F.col(order_col) >= lo + i * width) & (F.col(order_col) < lo + (i + 1) * width))
        part = part.coalesce(1) if files == 1 else part.repartition(files, order_col)
        part.write.mode("append").parquet(path)
        if i == 0:
            files = max(files, _files(spark, path))
        for _ in range((i + 1) * files - _files(spark, path)):
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)  # distinct modification times keep the slices' order
    return replay_stream(spark, path, rows.schema, files=files)


def replay_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files).load(path)

"""Large slices of arrivals are written and read by several tasks, each slice in one micro-batch."""

from pyspark.sql import functions as F

from streamtab.session import scratch_path
from streamtab.streaming import sources


def _batches(spark, s, name):
    seen, base = {}, scratch_path(spark, name)

    def sink(batch, i):
        seen[i] = (sorted(r.seq for r in batch.collect()), batch.where("seq >= 0").select(F.input_file_name()).distinct().count())
    s.writeStream.foreachBatch(sink).option("checkpointLocation", base).trigger(availableNow=True).start().awaitTermination()
    return [seen[i] for i in sorted(seen)]


def test_slices_of_several_files_are_one_batch_each(spark, monkeypatch):
    monkeypatch.setattr(sources, "FILE_ROWS", 50)
    rows = spark.range(600).select(F.col("id").alias("seq"), (F.col("id") % 7).alias("v"))
    got = _batches(spark, sources.arrivals(spark, rows, "seq", 3), "slices")
    assert [s for s, _ in got] == [list(range(i * 200, i * 200 + 200)) for i in range(3)]
    assert all(n > 1 for _, n in got)


def test_slices_with_few_values_are_filled_with_empty_files(spark, monkeypatch):
    monkeypatch.setattr(sources, "FILE_ROWS", 10)
    values = [0] * 100 + [15] * 3 + [29] * 40                  # the same position many times
    rows = spark.createDataFrame([(x,) for x in values] + [(None,)], "seq long")
    got = _batches(spark, sources.arrivals(spark, rows, "seq", 3), "few")
    assert [s for s, _ in got] == [[0] * 100, [15] * 3, [29] * 40]

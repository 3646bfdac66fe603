"""Chunks of an ordered scan follow the data: bursts, gaps and ties do not fill one chunk."""

import random

import pytest
from pyspark.sql import functions as F

from streamtab.operators import scan
from streamtab.operators.scan import Agg, ScanConfig, running


def _sizes(df, keys, order, cfg):
    """Rows of every chunk of every split key, and of the keys that are not split."""
    split = scan.split_keys(df, keys, order, cfg)
    kexpr, sk = scan._key_columns(df, keys, ""), list(scan._key_columns(df, keys, "s"))
    most = split.agg(F.max(F.size("__bounds"))).first()[0]
    at = scan._chunk_of(F.struct(*order), F.col("__bounds"), most)
    return (df.withColumns(kexpr).join(split, [F.col(k) == F.col(s) for k, s in zip(kexpr, sk)])
              .groupBy(*sk, at.alias("chunk")).count().collect())


def _burst(spark):
    """99,990 of 100,000 rows of a key within one second, ten spread over a year."""
    burst = spark.range(99_990).select(F.lit(1).alias("k"), (F.col("id") % 1_000_000 + 10 ** 13).alias("us"), "id")
    rare = spark.range(10).select(F.lit(1).alias("k"), (F.col("id") * 3 * 10 ** 12).alias("us"), (F.col("id") + 99_990).alias("id"))
    return burst.unionByName(rare)


def test_a_burst_fills_no_single_chunk(spark):
    got = _sizes(_burst(spark), ["k"], ["us", "id"], ScanConfig(chunk_rows=512))
    sizes = [r["count"] for r in got]
    assert sum(sizes) == 100_000 and len(sizes) > 150 and max(sizes) <= 4 * sum(sizes) / len(sizes)


def test_ties_of_the_first_order_column_are_split(spark):
    df = spark.range(60_000).select(F.lit(None).cast("int").alias("k"), F.lit(7).alias("us"), "id")
    sizes = [r["count"] for r in _sizes(df, ["k"], ["us", "id"], ScanConfig(chunk_rows=512))]
    assert len(sizes) > 80 and max(sizes) <= 4 * 60_000 / len(sizes)


def test_default_chunks_of_a_burst(spark):
    sizes = [r["count"] for r in _sizes(_burst(spark), ["k"], ["us", "id"], ScanConfig())]
    assert len(sizes) > 8 and max(sizes) <= 4 * 100_000 / len(sizes)


def test_text_and_null_order_values_are_split(spark):
    df = spark.range(30_000).select(F.lit("a").alias("k"), F.when(F.col("id") % 3 > 0, F.sha2(F.col("id").cast("string"), 256)).alias("o"), "id")
    sizes = [r["count"] for r in _sizes(df, ["k"], ["o", "id"], ScanConfig(chunk_rows=512))]
    assert len(sizes) > 30 and max(sizes) <= 4 * 30_000 / len(sizes)


@pytest.mark.parametrize("seed", range(3))
def test_running_values_over_bursts_and_ties(spark, seed):
    rng = random.Random(seed)
    rows, t = [], 0
    for i in range(1_200):
        t += rng.choice([0, 0, 0, 1, 1, 10 ** 6]) if i % 400 > 200 else 0
        rows.append((rng.choice([None, 1, 1, 1, 1, 2]), t if rng.random() < 0.98 else None, i, rng.randrange(100) if rng.random() < 0.9 else None))
    df = spark.createDataFrame(rows, "k int, t long, i long, v int").repartition(4)
    aggs = {"c": Agg("count"), "s": Agg("sum", "v"), "m": Agg("max", "v", inclusive=False), "l": Agg("last", "v"), "n": Agg("min", "v")}
    got = {r.i: (r.c, r.s, r.m, r.l, r.n) for r in running(df, ["k"], ["t", "i"], aggs, ScanConfig(chunk_rows=8)).collect()}
    want, hist = {}, {}
    for k, tt, i, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        h = hist.setdefault(k, [])
        before = [x for x in h if x is not None]
        h.append(v)
        now = [x for x in h if x is not None]
        want[i] = (len(h), sum(now) if now else None, max(before, default=None), now[-1] if now else None, min(now, default=None))
    assert got == want


def test_heavy_inputs_are_computed_once(spark):
    """A join below a scan is written once; a bare scan is not copied."""
    df = _burst(spark)
    assert scan.settled(df) is df
    joined = df.join(spark.range(10).withColumnRenamed("id", "k"), "k")
    again = scan.settled(joined)
    assert again is not joined and "Join" not in again._jdf.queryExecution().optimizedPlan().toString()
    assert again.dtypes == joined.dtypes and again.count() == joined.count()

"""Hard negatives: the curve, the bounds and whole results against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamtab.llm import hard_negatives as hn
from streamtab.llm import registry

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, relabel=True):
    seen = {}
    for k, v, x in rows:
        if k is None or v is None or x is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        label = (x + 1) % 10 if relabel and k % 7 == 0 else x
        seen.setdefault(k, []).append((label, [float(np.float32(c)) for c in v]))
    taken = {k: (min(v)[0], [math.floor(256 * c) for c in min(v)[1]]) for k, v in seen.items()}
    out = []
    for a, (label, v) in taken.items():
        if a % every:
            continue
        score = {k: sum(p * q for p, q in zip(v, w)) for k, (_, w) in taken.items()}
        order = sorted((k for k in taken if k != a), key=lambda k: (-score[k], k))
        for p in [k for k in order if taken[k][0] == label][:5]:
            near = [k for k in order if taken[k][0] != label and 80 * score[p] <= 100 * score[k] <= 100 * score[p]][:5]
            out += [(a, p, i, k, score[p], score[k]) for i, k in enumerate(near, 1)]
    return sorted(out)


def clustered(rng, n, dims, clusters=6, spread=0.3):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(clusters)]
    out = []
    for i in range(n):
        c = rng.randrange(clusters)
        out.append((i, [x + rng.gauss(0, spread) for x in centres[c]], (c if rng.random() < 0.7 else rng.randrange(10))))
    return out


def test_curve_visits_every_cell_by_unit_steps():
    for dims, bits in ((2, 4), (3, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        place = hn.hilbert(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("seed,dims,zones", [(1, 8, 2), (2, 16, 1000), (3, 1, 3)])
def test_results_equal_brute_force_over_many_blocks(spark, seed, dims, zones):
    rows = clustered(random.Random(seed), 900, dims)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hn.mine(spark.createDataFrame(rows, SCHEMA).repartition(5), label=label, every=20, block=32, group=7, zones=zones)
    assert sorted(map(tuple, got.collect())) == brute(rows, every=20)


def test_blocks_are_skipped(spark):
    rows = clustered(random.Random(6), 3_000, 8, spread=0.05)
    taken = hn.usable(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", F.col("label"), 256)
    space = hn._fit(taken, 256)
    blocks = hn._written(hn._blocks(taken, space, 256, 32), "b")
    groups = hn._written(hn._anchors(blocks, space, 100, 1), "a")
    n, g = blocks.count(), groups.count()
    assert hn._choose(groups, hn._chunked(blocks, 10), space, windows=False).count() < 0.4 * n * g


def test_query_with_odd_rows_ties_and_repeats(spark, tmp_path):
    rng = random.Random(4)
    rows = clustered(rng, 450, 6)
    rows += [(1_000 + i, [0.5] * 6, 3) for i in range(60)] + [(2_000 + i, [0.5] * 6, 4) for i in range(60)]     # ties
    rows += [(700, [1.0, 0.5, 0.1, 0.2, 0.3, -0.7], 3)] * 3 + [(700, [0.9, 0.5, 0.1, 0.2, 0.3, -0.7], 3)]
    rows += [(800, None, 1), (801, [0.1] * 6, None), (802, [0.1, None, 0.2, 0.1, 0.1, 0.1], 1), (803, [float("nan")] * 6, 2),
             (804, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0], 2), (None, [0.2] * 6, 2), (900, [], 5), (1_000_000, [0.0] * 6, 3), (805, [0.5, 0.25], 4)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("grp", F.lit("mine")).withColumn("block", F.lit(1)).withColumn("id", F.lit("x"))
    df.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = registry.op11_hard_negatives(spark, str(tmp_path))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_empty_tables_and_huge_values(spark):
    assert hn.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hn.mine(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0
    big = [(0, [5e6, 1.0], 1), (1, [4e6, 2.0], 1), (2, [3.9e6, 3.0], 2), (3, [4e6, 1.0], 2), (4, [-1e6, 1.0], 2), (5, [4e6, 2.0], 3), (6, [4e6, 2.0], 2)]
    assert sorted(map(tuple, hn.mine(spark.createDataFrame(big, SCHEMA), every=100).collect())) == brute(big, relabel=False) != []

"""Hard negatives: for each anchor and each of its best positives, the best rows of
other labels whose scores lie in a window below the positive's score.

Scores are exact integer inner products of quantised vectors (``floor(scale * x)``).
Higher scores come first, ties by smaller id.

* **Blocks.**  Rows are ordered along a Hilbert curve over their first ``CURVE_DIMS``
  principal coordinates (a rotation fitted on a documented bounded sample; it only
  affects how well blocks are skipped) and written as Parquet rows of at most
  ``BLOCK`` vectors each, beside a zone map: the least and greatest value of every
  rotated coordinate, and the labels that occur.
* **Choice.**  The rotation keeps inner products, so interval arithmetic over a zone
  map bounds all scores of an anchor within the block.  A block is read for an
  anchor only if its interval reaches the anchor's threshold: the fifth best
  positive seen in the anchor's own block, then, for each window, its lower end or
  the fifth best negative seen in it, and not below the block's least score.
* **Reading.**  Anchors (a stated query set) travel in groups of at most ``GROUP``;
  each chosen (group, block) pair is one matrix product, whose best rows are
  reduced by rank.  Zone maps are paired with groups in chunks of ``ZONES``, so no
  task holds all of them.

Defined results: rows with a null id, label or vector, or with a null or non-finite
component (also after scaling) take no part; of repeated ids the row with the least
(label, vector) takes part; shorter vectors count as padded by zeros; no rows give
no rows; sums beyond 2^53 are computed in whole numbers, and beyond a long taken as
its greatest or least value; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamtab.llm import common

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: Window of negative scores: LOW * positive <= 100 * negative <= HIGH * positive.
LOW, HIGH = 80, 100
BLOCK, GROUP, ZONES = 1024, 256, 2048
#: Rows that the rotation and the ranges of the curve are fitted on, at most.
FIT_ROWS = 20_000
CURVE_DIMS, CURVE_BITS = 8, 7
#: Scores of negatives in its own block that an anchor remembers.
SEEN = 64

ROWS = "id long, label long, vector binary, place long"
BLOCKS = "block long, ids array<long>, labels array<long>, vectors binary, lo binary, hi binary, present array<long>"
ANCHORS = "grp long, ids array<long>, labels array<long>, vectors binary, least binary, seen binary"


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Places of points (n x dims, whole numbers below 2^bits) on the Hilbert curve."""
    x = x.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            set_ = (x[:, i] & q) != 0
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(set_, low, swap)
            if i:
                x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flip, q = np.zeros(len(x), np.int64), 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[:, -1] & q, q - 1, 0)
        q >>= 1
    x ^= flip[:, None]
    place = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            place = (place << 1) | ((x[:, i] >> b) & 1)
    return place


class Space:
    """The width of the vectors, the rotation of the zone maps and the ranges of the curve."""

    def __init__(self, sample: np.ndarray, greatest: float):
        self.dims = max(sample.shape[1], 1)
        sample = sample if sample.shape[1] else np.zeros((len(sample), 1))
        _, turn = np.linalg.eigh(np.cov(sample.T).reshape(self.dims, self.dims) if len(sample) > 1 else np.eye(self.dims))
        self.turn = np.ascontiguousarray(turn[:, ::-1])
        at = sample @ self.turn[:, :CURVE_DIMS]
        self.lo, self.hi = at.min(axis=0), at.max(axis=0)
        self.exact = self.dims * greatest * greatest < 2.0 ** 53

    def places(self, v: np.ndarray) -> np.ndarray:
        span = np.where(self.hi > self.lo, self.hi - self.lo, 1.0)
        cell = (v @ self.turn[:, :CURVE_DIMS] - self.lo) / span * (1 << CURVE_BITS)
        return hilbert(np.clip(cell, 0, (1 << CURVE_BITS) - 1), CURVE_BITS)

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact whole-number products of rows."""
        if self.exact:
            return (a @ b.T).astype(np.int64)
        whole = np.frompyfunc(int, 1, 1)
        return np.asarray(whole(a) @ whole(b).T, dtype=object).reshape(len(a), len(b))

    def matrix(self, raw) -> np.ndarray:
        return np.frombuffer(raw.as_buffer(), "<f8").reshape(-1, self.dims)


def _vectors(column, scale: int) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(column.value_lengths())
    return np.split(np.floor(flat * scale), ends[:-1].astype(np.int64)) if len(ends) else []


def _stack(vectors: list[np.ndarray], dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def usable(rows: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """(id, label, vector) of the rows that take part."""
    of = F.col(f"`{vector}`").cast("array<double>")
    x = lambda c: F.coalesce(F.abs(c * F.lit(float(scale))) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(c)
    got = rows.select(F.col(f"`{key}`").cast("long").alias("id"), label.cast("long").alias("label"), of.alias("vector"))
    got = got.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", x))
    return got.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r")).select("id", "r.*")


def _fit(rows: DataFrame, scale: int) -> Space | None:
    size = rows.agg(F.max(F.size("vector")), F.max(F.greatest(F.abs(F.array_min("vector")), F.abs(F.array_max("vector"))))).first()
    if size[0] is None:
        return None
    sample = common.bounded_sample(rows.select("id", "vector"), FIT_ROWS, "id").select("vector").toArrow().column(0)
    vectors = [v for chunk in sample.chunks for v in _vectors(chunk, scale)]
    return Space(_stack(vectors, size[0]), (size[1] or 0.0) * scale + 1)


def _written(df: DataFrame, name: str) -> DataFrame:
    return common.materialize(df, f"negatives-{name}")


def _blocks(rows: DataFrame, space: Space, scale: int, block: int) -> DataFrame:
    """Blocks of rows along the curve, with their zone maps."""
    def place(batches):
        for b in batches:
            v = _stack(_vectors(b.column(2), scale), space.dims)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in v], pa.binary()),
                                              pa.array(space.places(v))], names=["id", "label", "vector", "place"])

    placed = rows.mapInArrow(place, ROWS).repartitionByRange("place", "id").sortWithinPartitions("place", "id")

    def build(batches):
        number, held = TaskContext.get().partitionId() << 32, []

        def close():
            ids, labels, raw = (np.concatenate(c) for c in zip(*held))
            turned = raw @ space.turn
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.int64())),
                 *[pa.array([m.tobytes()], pa.binary()) for m in (raw, turned.min(axis=0), turned.max(axis=0))],
                 pa.array([np.unique(labels)], pa.list_(pa.int64()))],
                names=["block", "ids", "labels", "vectors", "lo", "hi", "present"])

        n = 0
        for b in batches:
            cols = (b.column(0).to_numpy(), b.column(1).to_numpy(),
                    np.frombuffer(b"".join(b.column(2).to_pylist()), "<f8").reshape(-1, space.dims))
            at = 0
            while at < b.num_rows:
                step = min(block - n, b.num_rows - at)
                held.append([c[at:at + step] for c in cols])
                n, at = n + step, at + step
                if n == block:
                    yield close()
                    number, n, held = number + 1, 0, []
        if held:
            yield close()

    return placed.mapInArrow(build, BLOCKS)


def _best(scores: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The first k of the rows ``at`` by score, then smaller id."""
    if len(at) > 4 * k and scores.dtype != object:
        s = scores[at]
        at = at[s >= np.partition(s, len(s) - k)[len(s) - k]]
    return at[np.lexsort((ids[at], -scores[at]))[:k]] if scores.dtype != object else \
        np.array(sorted(at.tolist(), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)


def _anchors(blocks: DataFrame, space: Space, every: int, group: int) -> DataFrame:
    """Groups of anchors; each knows the least score that its positives have to
    reach and some scores of negatives, both from its own block."""
    def run(batches):
        number, held = TaskContext.get().partitionId() << 32, []

        def close(part):
            cols = list(zip(*part))
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([list(cols[0])], pa.list_(pa.int64())), pa.array([list(cols[1])], pa.list_(pa.int64())),
                 *[pa.array([np.array(c, "<f8").tobytes()], pa.binary()) for c in cols[2:]]],
                names=["grp", "ids", "labels", "vectors", "least", "seen"])

        for b in batches:
            for r in range(b.num_rows):
                ids, labels = (b.column(c)[r].values.to_numpy() for c in (0, 1))
                v = space.matrix(b.column(2)[r])
                own = np.flatnonzero(ids % every == 0)
                scores = space.scores(v[own], v) if len(own) else None
                for i, s in zip(own.tolist(), scores if len(own) else ()):
                    same = np.flatnonzero((labels == labels[i]) & (ids != ids[i]))
                    other = np.flatnonzero(labels != labels[i])
                    top = _best(s, ids, same, POSITIVES)
                    least = float(s[top[-1]]) if len(top) == POSITIVES else -np.inf
                    seen = np.full(SEEN, -np.inf)
                    near = _best(s, ids, other, SEEN)
                    seen[:len(near)] = s[near].astype(np.float64)
                    held.append((int(ids[i]), int(labels[i]), v[i], least, seen))
                    if len(held) == group:
                        yield close(held)
                        number, held = number + 1, []
        if held:
            yield close(held)

    return blocks.select("ids", "labels", "vectors").mapInArrow(run, ANCHORS)


def _chunked(blocks: DataFrame, zones: int) -> tuple[DataFrame, int]:
    """Zone maps in chunks of about ``zones`` blocks, and the number of chunks."""
    maps = blocks.select("block", "lo", "hi", "present")
    chunks = max(1, -(-maps.count() // zones))
    packed = maps.groupBy(F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int").alias("chunk")).agg(
        F.collect_list(F.struct("block", "lo", "hi", "present")).alias("maps"))
    return packed, chunks


def _choose(groups: DataFrame, zones: tuple[DataFrame, int], space: Space, windows: bool) -> DataFrame:
    """(grp, block) of the blocks whose bounds reach a threshold of some anchor of the group."""
    maps, chunks = zones
    slots = "slots" if windows else F.lit(None).cast("array<struct<a:int,positive:long,score:long>>").alias("slots")
    paired = groups.select("grp", "labels", "vectors", "least", "seen", slots,
                           F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("to")).join(maps, F.col("to") == F.col("chunk"))

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                grp, labels = b.column(0)[r].as_py(), b.column(1)[r].values.to_numpy()
                a = space.matrix(b.column(2)[r]) @ space.turn
                maps = b.column(6)[r].values
                block, lo, hi = maps.field(0).to_numpy(), *(
                    np.frombuffer(b"".join(maps.field(c).to_pylist()), "<f8").reshape(-1, space.dims) for c in (1, 2))
                up, down = np.maximum(a, 0), np.minimum(a, 0)
                most, least = up @ hi.T + down @ lo.T, up @ lo.T + down @ hi.T
                slack = 1e-9 * (np.abs(a) @ np.maximum(np.abs(lo), np.abs(hi)).T) + 1e-6    # rounding of the rotation
                sets = [set(p) for p in maps.field(3).to_pylist()]
                has = {x: np.array([x in p for p in sets]) for x in set(labels.tolist())}
                others = {x: np.array([bool(p - {x}) for p in sets]) for x in has}
                need = np.zeros(len(block), bool)
                if not windows:
                    bar = np.frombuffer(b.column(3)[r].as_buffer(), "<f8")
                    for i, x in enumerate(labels.tolist()):
                        need |= has[x] & (most[i] + slack[i] >= bar[i])
                else:
                    seen = np.frombuffer(b.column(4)[r].as_buffer(), "<f8").reshape(-1, SEEN)
                    for s in b.column(5)[r].as_py():
                        i, p = s["a"], float(s["score"])
                        low = p * LOW / HIGH
                        inside = seen[i][(seen[i] <= (p if space.exact else p - abs(p) * 1e-12)) & (seen[i] >= low)]
                        if len(inside) >= NEGATIVES:
                            low = np.sort(inside)[-NEGATIVES]
                        need |= others[labels[i]] & (most[i] + slack[i] >= low * (1 - 1e-12) - 1e-6) & (least[i] - slack[i] <= p)
                got = block[need]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), grp)), pa.array(got)], names=["grp", "block"])

    return paired.select("grp", "labels", "vectors", "least", "seen", "slots", "maps").mapInArrow(run, "grp long, block long")


def _long(x) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(x)))


def _read(chosen: DataFrame, groups: DataFrame, blocks: DataFrame, space: Space, windows: bool) -> DataFrame:
    """The best rows of every chosen block for every anchor (its positives) or slot
    (its negatives): grp, a (place of the anchor), positive, id, score, top."""
    slots = F.col("slots") if windows else F.lit(None).cast("array<struct<a:int,positive:long,score:long>>").alias("slots")
    g = groups.select("grp", F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels"), F.col("vectors").alias("a_vectors"), slots)
    both = (chosen.join(g, "grp").join(blocks.select("block", "ids", "labels", "vectors"), "block")
            .select("grp", "a_ids", "a_labels", "a_vectors", "slots", "ids", "labels", "vectors"))
    schema = "grp long, a int, positive long, top long, id long, score long"

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                grp = b.column(0)[r].as_py()
                a_ids, a_labels = (b.column(c)[r].values.to_numpy() for c in (1, 2))
                ids, labels = (b.column(c)[r].values.to_numpy() for c in (5, 6))
                scores = space.scores(space.matrix(b.column(3)[r]), space.matrix(b.column(7)[r]))
                out = []
                if not windows:
                    for i, s in enumerate(scores):
                        at = np.flatnonzero((labels == a_labels[i]) & (ids != a_ids[i]))
                        out += [(i, None, None, int(ids[j]), _long(s[j])) for j in _best(s, ids, at, POSITIVES).tolist()]
                else:
                    for slot in b.column(4)[r].as_py():
                        i, p = slot["a"], slot["score"]
                        s = scores[i]
                        at = np.flatnonzero((labels != a_labels[i]) & (s * 100 >= LOW * p) & (s * 100 <= HIGH * p))
                        out += [(i, slot["positive"], p, int(ids[j]), _long(s[j])) for j in _best(s, ids, at, NEGATIVES).tolist()]
                if out:
                    cols = list(zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([grp] * len(out), pa.int64()), pa.array(cols[0], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                        names=["grp", "a", "positive", "top", "id", "score"])

    return both.mapInArrow(run, schema)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label", every: int = 100,
         scale: int = SCALE, block: int = BLOCK, group: int = GROUP, zones: int = ZONES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of every
    anchor (id divisible by ``every``)."""
    spark = rows.sparkSession
    common.prepare(spark)
    taken = _written(usable(rows, key, vector, F.col(f"`{label}`") if isinstance(label, str) else label, scale), "rows")
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    space = _fit(taken, scale)
    if space is None:
        return spark.createDataFrame([], out)
    blocks = _written(_blocks(taken, space, scale, block), "blocks")
    groups = _written(_anchors(blocks, space, every, group), "anchors")
    maps = _chunked(blocks, zones)
    chosen = _choose(groups, maps, space, windows=False)
    best = _first(_read(chosen, groups, blocks, space, windows=False), ["grp", "a"], POSITIVES)
    # a group has at most GROUP anchors of POSITIVES slots each
    slots = best.groupBy("grp").agg(F.collect_list(F.struct("a", F.col("id").alias("positive"), "score")).alias("slots"))
    groups = _written(groups.join(slots, "grp"), "slots")
    chosen = _choose(groups, maps, space, windows=True)
    found = _first(_read(chosen, groups, blocks, space, windows=True), ["grp", "a", "positive"], NEGATIVES)
    names = groups.select(F.col("grp").alias("of"), F.posexplode("ids").alias("at", "anchor_id"))
    return found.join(names, (F.col("grp") == F.col("of")) & (F.col("a") == F.col("at"))).select(
        "anchor_id", F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("top").alias("positive_score"), F.col("score").alias("negative_score"))

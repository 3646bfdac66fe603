"""Near-duplicate classes by ProbMinHash, banding and verification.

1. Every text becomes a weighted set of word shingles (weight: how often the
   shingle occurs).  ProbMinHash draws each element's arrivals as a Poisson
   process of rate weight, every arrival landing in a random register; a
   register keeps the element that arrives first, and an element stops once
   its next arrival is later than all registers (early termination).  Two sets
   agree in a register with the probability Jaccard similarity.
2. Texts equal byte by byte collapse to one key; registers are banded, and
   keys of one band bucket are candidates.
3. Candidates are verified with the exact probability Jaccard of their
   shingles, and verified links are joined into classes.

A bucket is never expanded into all pairs.  In each round a few members of a
bucket (1, 32, then up to 1,000) are compared with those members that are still in other
classes, then they leave the bucket, until every bucket holds one class or no
member: every pair of a bucket is compared, ruled out, or already in one class.
Pairs are ruled out by an exact bound: if a set holds at least the share u of its
weight in elements that its partner lacks, and the partner the share v, their
probability Jaccard is at most (1 - u)(1 - v) / (1 - u v).  A set's share in elements
that no other set has is such a share; so is the least weight of n - d of its n
elements, where d of the partner's elements occur in any other set; so is one element
for each bit of a 1,024-bit map of its elements that the partner's map lacks.  Pairs are also
ruled out where their registers agree too little: five standard deviations below the
threshold, a loss far below that of the bands.  Members with the least share of their
own go first, since they link most.

Defined results: a null text is a class of its own (class_id is its doc_id);
texts without a word are copies of each other only if equal; a text of fewer
words than a shingle is one shingle; class_id is the smallest non-null doc_id of
the class; repeated rows each get the row's class; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.llm import common
from streamtab.llm.decontaminate import words_of

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
#: Registers of a signature: the first BANDS * ROWS are banded, all estimate the similarity.
REGISTERS = 250
#: Standard deviations by which a pair's estimate may fall below the threshold.
SIGMAS = 5.0
#: Bits kept of every register, for the estimate of a pair's similarity.
SKETCH_BITS = 4
#: Bits of the map of a set's elements.
MARK_BITS = 1024
#: Members of a mixed bucket that are compared first.
FIRST_MEMBERS = 32
#: Most members compared at once per bucket and round (Spark limits groups before the shuffle up to 1,000).
GROUP_LIMIT = 1000
#: Shingles hashed together in one numpy pass.
PASS_SHINGLES = 150_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """word -> 64-bit hash, filled on demand."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w)
        return h


def shingles(body: bytes | None, hashes: WordHash, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and how often each occurs."""
    words = words_of(body)
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(width, len(h))):
        out = _mix(out * _GOLD + h[i:i + n] + np.uint64(i + 1))
    return np.unique(out, return_counts=True)


def registers(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, m: int) -> np.ndarray:
    """(n, m) winning elements of n weighted sets given as parallel arrays."""
    best = np.full(n * m, np.inf)
    won = np.zeros(n * m, np.uint64)
    e, w, o = elements, weights.astype(np.float64), owner.astype(np.int64)
    t = np.zeros(len(e))
    step = 0
    while len(e):
        step += 1
        u = _mix(e + np.uint64(2 * step * int(_GOLD) % 2**64))
        t = t - np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / w
        at = o * m + (_mix(u ^ _M1) % np.uint64(m)).astype(np.int64)
        early = t < best[at]
        if early.any():
            a, te, ee = at[early], t[early], e[early]
            order = np.argsort(te, kind="stable")[::-1]          # the earliest is written last
            a, te, ee = a[order], te[order], ee[order]
            best[a] = te
            won[a] = ee
        last = best.reshape(n, m).max(axis=1)
        alive = t < last[o]
        e, w, o, t = e[alive], w[alive], o[alive], t[alive]
    return won.reshape(n, m)


def band_hashes(won: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(won), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        out = _mix(out * _GOLD + won[:, r:bands * rows:rows] + np.uint64(r + 1))
    return out.view(np.int64)


def sketches(won: np.ndarray) -> np.ndarray:
    """(n, words) int64: SKETCH_BITS bits of every register's winner.  Winners
    that differ differ in half of their bits."""
    bits = ((_mix(won ^ _M2)[:, :, None] >> np.arange(SKETCH_BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    flat = bits.reshape(len(won), -1)
    packed = np.packbits(np.pad(flat, ((0, 0), (0, -flat.shape[1] % 64))), axis=1)
    return np.ascontiguousarray(packed).view(np.int64)


def marks(elements: np.ndarray) -> np.ndarray:
    """A map of MARK_BITS bits as int64 words: the bit of every element is set."""
    flat = np.zeros(MARK_BITS, np.uint8)
    flat[(_mix(elements ^ _M1) % np.uint64(MARK_BITS)).astype(np.int64)] = 1
    return np.packbits(flat).view(np.int64)


def sketch_limit(m: int, threshold: float) -> int:
    """Most differing bits that a pair at the threshold shows, up to SIGMAS standard deviations."""
    far, b = 1 - threshold, SKETCH_BITS
    return int(m * far * b / 2 + SIGMAS * (m * (far * b / 4 + threshold * far * b * b / 4)) ** 0.5)


def probability_jaccard(ea: np.ndarray, wa: np.ndarray, eb: np.ndarray, wb: np.ndarray) -> float:
    """Exact probability Jaccard of two weighted sets (sorted elements):
    the sum over common i of 1 / sum_j max(a_j / a_i, b_j / b_i)."""
    common_e, ia, ib = np.intersect1d(ea, eb, assume_unique=True, return_indices=True)
    if not len(common_e):
        return 0.0
    x, y = wa[ia].astype(np.float64), wb[ib].astype(np.float64)
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    below = np.searchsorted(ratio, ratio, side="right")           # elements whose ratio is not larger
    cx, cy = np.concatenate([[0.0], np.cumsum(x)]), np.concatenate([[0.0], np.cumsum(y)])
    total = only_a + cx[below] + (cy[-1] - cy[below] + only_b) / ratio
    return float((x / total).sum())


def _signature(bands: int, rows: int, width: int, m: int):
    def run(batches):
        hashes = WordHash()
        for b in batches:
            keys, ids = b.column(0), b.column(1)
            part, size, lo = [], 0, 0
            bodies = b.column(2).to_pylist()
            for i, body in enumerate(bodies):
                part.append(shingles(body, hashes, width))
                size += len(part[-1][0])
                if size > PASS_SHINGLES or i == len(bodies) - 1:
                    lens = np.array([len(p[0]) for p in part])
                    won = registers(np.concatenate([p[0] for p in part]), np.concatenate([p[1] for p in part]),
                                    np.repeat(np.arange(len(part)), lens), len(part), m)
                    got = band_hashes(won, bands, rows)
                    sk = sketches(won)
                    sk = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * sk.shape[1], pa.int32()), pa.array(sk.reshape(-1)))
                    flat = pa.array(got[lens > 0].reshape(-1), pa.int64())
                    ends = np.concatenate([[0], np.cumsum(np.where(lens > 0, bands, 0))]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(lo, len(part)), ids.slice(lo, len(part)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), sk],
                        names=["key", "id", "bands", "sketch"])
                    part, size, lo = [], 0, i + 1
    return run


VECTORS = "key binary, e binary, w binary, n long, total long, marks array<long>"


def _vectors(width: int):
    def run(batches):
        hashes = WordHash()
        for b in batches:
            got = [shingles(x, hashes, width) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([e.tobytes() for e, _ in got], pa.binary()),
                                              pa.array([w.astype(np.int32).tobytes() for _, w in got], pa.binary()),
                                              pa.array([len(e) for e, _ in got], pa.int64()),
                                              pa.array([int(w.sum()) for _, w in got], pa.int64()),
                                              pa.array([marks(e) for e, _ in got], pa.list_(pa.int64()))],
                                             names=["key", "e", "w", "n", "total", "marks"])
    return run


def _shares():
    """(key, element, share of the set's weight) of every shingle."""
    def run(batches):
        for b in batches:
            for k, e, w in zip(*(b.column(i).to_pylist() for i in range(3))):
                w = np.frombuffer(w, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(w), pa.binary()), pa.array(np.frombuffer(e, np.int64)),
                                                  pa.array(w / w.sum())], names=["key", "element", "share"])
    return run


#: Columns of a set that the bound reads.
SIZES = ["own", "n", "total", "others", "marks"]


def own_shares(vectors: DataFrame) -> DataFrame:
    """(key, own, n, total, others, marks): the share of a set's weight in elements that no
    other set holds, its elements, its weight, its elements that others hold too, its map."""
    e = vectors.mapInArrow(_shares(), "key binary, element long, share double")
    once = e.groupBy("element").agg(F.count(F.lit(1)).alias("sets"), F.min("key").alias("key"), F.min("share").alias("share")).where("sets = 1")
    own = once.groupBy("key").agg(F.sum("share").alias("own"), F.count(F.lit(1)).alias("alone"))
    return (vectors.select("key", "n", "total", "marks").join(own, "key", "left")
            .select("key", F.coalesce("own", F.lit(0.0)).alias("own"), "n", "total",
                    (F.col("n") - F.coalesce("alone", F.lit(0))).alias("others"), "marks"))


def may_link(a: str, b: str, threshold: float):
    """Whether the bound lets two sets reach the threshold.  ``a`` and ``b`` end the names
    of their SIZES columns.  A set shares at most the other's ``others`` elements with it,
    lacks an element for every bit of the other's map that its own lacks, and every
    element weighs 1 or more."""
    def lacking(x, y):
        bits = sum((F.bit_count(F.get(f"marks{x}", i).bitwiseAND(F.bitwise_not(F.get(f"marks{y}", i)))) for i in range(MARK_BITS // 64)), F.lit(0))
        return F.greatest(F.col(f"own{x}"), F.greatest(F.col(f"n{x}") - F.col(f"others{y}"), bits) / F.col(f"total{x}"))

    def reach(s):
        u, v = s["u"], s["v"]
        none = 1 - 1e-9                                       # sets without a common element: the bound is 0 / 0
        return (u < none) & (v < none) & ((1 - u) * (1 - v) >= (threshold - 1e-9) * (1 - u * v))

    # bound to a name, so that the maps of a pair are compared once and not at each use of u and v
    return F.exists(F.array(F.struct(lacking(a, b).alias("u"), lacking(b, a).alias("v"))), reach)


def _verify(threshold: float):
    def run(batches):
        for b in batches:
            ok = []
            for ea, wa, eb, wb in zip(*(b.column(i).to_pylist() for i in range(2, 6))):
                s = probability_jaccard(np.frombuffer(ea, np.uint64), np.frombuffer(wa, np.int32),
                                        np.frombuffer(eb, np.uint64), np.frombuffer(wb, np.int32))
                ok.append(s >= threshold - 1e-12)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"]).filter(pa.array(ok, pa.bool_()))
    return run


def components(edges: DataFrame) -> DataFrame:
    """(key, root) for every key of the links (a, b): root is the smallest key
    of its connected component.  Alternates large-star and small-star steps,
    whose messages stay proportional to the links; each round is written to
    the shared folder, and the loop ends when the links are stars."""
    e = common.materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    if e.isEmpty():
        return e.select(F.col("a").alias("key"), F.col("b").alias("root"))

    while True:
        # large star: every larger neighbour links to the smallest neighbour (or the node itself)
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: smaller neighbours and the node itself link to the smallest neighbour
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        e = common.materialize(small, "links")
        # done when every node has one link, to a node that has none itself
        ends = e.select("a", F.lit(1).alias("out")).union(e.select("b", F.lit(0)).distinct()).groupBy("a")
        if ends.agg(F.sum("out").alias("out"), F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            break
    return e.select(F.col("a").alias("key"), F.col("b").alias("root")).union(e.select(F.col("b").alias("key"), F.col("b").alias("root")).distinct())


def _mixed(rooted: DataFrame, group: str) -> DataFrame:
    """The groups that hold more than one root."""
    return rooted.groupBy(group).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select(group)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
            threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, m: int = REGISTERS) -> DataFrame:
    """(doc_id, text_key, class_key, class_id) per row: class_id is the smallest
    doc_id of the row's class, text_key the digest of its text and class_key
    the smallest text_key of the class (both null for a null text)."""
    common.prepare(docs.sparkSession)
    base = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("body")).withColumn("key", F.unhex(F.md5("body")))
    texts = base.where("body is not null")
    signed = texts.select("key", "id", "body").mapInArrow(_signature(bands, rows, width, max(m, bands * rows)), T.StructType(
        [T.StructField("key", T.BinaryType()), base.schema["id"], T.StructField("bands", T.ArrayType(T.LongType())),
         T.StructField("sketch", T.ArrayType(T.LongType()))]))
    reps = common.materialize(signed.groupBy("key").agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "signatures")

    banded = reps.select("key", F.explode("bands").alias("hash"))
    shared = banded.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("rep")).where("n > 1")
    members = common.materialize(banded.join(shared.select("hash", "rep"), "hash"), "buckets")
    wanted = members.select("key").distinct()
    vectors = common.materialize(
        texts.select("key", "body").join(wanted, "key", "left_semi").dropDuplicates(["key"]).select("key", "body")
        .mapInArrow(_vectors(width), VECTORS), "shingles")

    def verified(pairs: DataFrame) -> DataFrame:
        """The links (x, y) of those pairs (a, b) that are similar enough."""
        va = vectors.select(F.col("key").alias("a"), F.col("e").alias("ea"), F.col("w").alias("wa"))
        vb = vectors.select(F.col("key").alias("b"), F.col("e").alias("eb"), F.col("w").alias("wb"))
        return (pairs.join(vb, "b").join(va, "a").select("x", "y", "ea", "wa", "eb", "wb")
                .mapInArrow(_verify(threshold), "a binary, b binary, ok boolean").select("a", "b"))

    first = members.where("key <> rep").select(F.col("rep").alias("a"), F.col("key").alias("b")).distinct().select("a", "b", F.col("a").alias("x"), F.col("b").alias("y"))
    roots = components(verified(first))
    alive = members.where("key <> rep").select("hash", "key")
    k, facts = FIRST_MEMBERS, None
    m = max(m, bands * rows)
    while True:
        # members still in more than one class of their bucket
        rooted = alive.drop("root").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
        alive = common.materialize(rooted.join(_mixed(rooted, "hash"), "hash"), "open")
        if alive.isEmpty():
            break
        if facts is None:
            facts = own_shares(vectors.join(alive.select("key").distinct(), "key", "left_semi")).join(reps.select("key", "sketch", "bands"), "key")
            alive = common.materialize(alive.join(facts, "key"), "open")
        rank = F.row_number().over(Window.partitionBy("hash").orderBy("own", "key"))
        p = common.materialize(alive.withColumn("rank", rank).where(F.col("rank") <= k)
                               .select("hash", F.col("key").alias("a"), F.col("root").alias("ra"), F.col("sketch").alias("sa"), F.col("bands").alias("ba"),
                                       *[F.col(c).alias(f"{c}_a") for c in SIZES]), "picked")
        bound = may_link("", "_a", threshold)
        differ = sum((F.bit_count(F.get("sketch", i).bitwiseXOR(F.get("sa", i))) for i in range(-(-m * SKETCH_BITS // 64))), F.lit(0))
        # of the buckets that a pair shares, that of the least hash compares it
        once = F.col("hash") == F.array_min(F.array_intersect("bands", "ba"))
        pairs = (alive.join(p, "hash").where((F.col("root") != F.col("ra")) & (differ <= sketch_limit(m, threshold)) & once & bound)
                 .select(F.least("a", "key").alias("a"), F.greatest("a", "key").alias("b"),
                         F.least("ra", "root").alias("x"), F.greatest("ra", "root").alias("y")).distinct())
        # only the roots of similar members are joined anew
        merged = components(verified(pairs)).withColumnsRenamed({"key": "old", "root": "new"})
        moved = roots.join(merged, F.col("root") == F.col("old"), "left").select("key", F.coalesce("new", "root").alias("root"))
        single = merged.join(roots, F.col("old") == F.col("key"), "left_anti").select(F.col("old").alias("key"), F.col("new").alias("root"))
        roots = common.materialize(moved.union(single), "roots")
        alive = alive.join(p.select("hash", F.col("a").alias("key")), ["hash", "key"], "left_anti")
        k = min(32 * k, GROUP_LIMIT)

    named = reps.select("key", "id").join(roots, "key", "left").select("key", "id", F.coalesce("root", "key").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("class_id"))
    out = common.materialize(named.join(least, "root").select("key", "root", "class_id"), "classes")
    return (base.select("id", "key").join(out, "key", "left")
            .select(F.col("id").alias(key), F.col("key").alias("text_key"), F.col("root").alias("class_key"),
                    F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id")))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """One row of each class (that of the smallest doc_id; of repeated rows one),
    with the input's columns.  Every row without a text stays."""
    def row_key(i, k):
        return F.unhex(F.md5(F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("null")), F.hex(k))))

    best = F.min(F.struct(F.col(key).isNull().alias("no"), F.col(key).alias("id"), "text_key"))
    kept = (classes(docs, key, text, **params).where("text_key is not null").groupBy("class_key").agg(best.alias("x"))
            .select(row_key(F.col("x.id"), F.col("x.text_key")).alias("row_key")))
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("body"),
                      row_key(F.col(key), F.unhex(F.md5(F.col(text).cast("binary")))).alias("row_key"))
    one = src.where("body is not null").select("row", "row_key").join(kept, "row_key").dropDuplicates(["row_key"])
    return one.select("row.*").union(src.where("body is null").select("row.*"))

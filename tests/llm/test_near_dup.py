"""Near-duplicate classes against all pairs of a small table."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from streamtab.llm import near_dup as nd
from tests.llm.helpers import EDGE, SCHEMA, documents, with_clashes, words


def bags(texts):
    h = nd.WordHash()
    return [nd.shingles(None if t is None else t.encode(), h) for t in texts]


def naive_jp(a: Counter, b: Counter) -> float:
    keys = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in keys) for i in set(a) & set(b))


def brute_classes(rows, threshold=nd.THRESHOLD):
    """doc_id -> set of doc_ids by exact similarity of every pair."""
    vec = bags([t for _, t in rows])
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] is None or rows[j][1] is None:
                continue
            if rows[i][1] == rows[j][1] or nd.probability_jaccard(*vec[i], *vec[j]) >= threshold:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(rows))]


def corpus(seed=5):
    rng = random.Random(seed)
    texts = [" ".join(words(rng, rng.randint(3, 150))) for _ in range(60)]
    for t in texts[:30]:
        for _ in range(rng.randint(1, 4)):
            w = t.split()
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = "changed" + str(rng.randrange(9))
            texts.append(" ".join(w))
    shared = " ".join(words(rng, 40))                       # a passage that many texts share
    texts += [shared + " " + " ".join(words(rng, rng.randint(1, 60))) for _ in range(40)]
    return texts


def test_probability_jaccard_equals_definition():
    rng = random.Random(3)
    for _ in range(50):
        a = Counter(rng.choices(range(12), k=rng.randint(1, 25)))
        b = Counter(rng.choices(range(12), k=rng.randint(1, 25)))
        ea, eb = np.array(sorted(a), np.uint64), np.array(sorted(b), np.uint64)
        wa, wb = np.array([a[int(k)] for k in ea]), np.array([b[int(k)] for k in eb])
        assert abs(nd.probability_jaccard(ea, wa, eb, wb) - naive_jp(a, b)) < 1e-9


def test_registers_estimate_the_similarity():
    vec = bags(["a b c d e f g h i j k l m n o p q r s t u v w x y z"] * 2 + ["a b c d e f g h i j k l m n o p q r s X u v w x y z"])
    m = 4000
    won = nd.registers(np.concatenate([v[0] for v in vec]), np.concatenate([v[1] for v in vec]),
                       np.repeat([0, 1, 2], [len(v[0]) for v in vec]), 3, m)
    assert (won[0] == won[1]).all()
    exact = nd.probability_jaccard(*vec[0], *vec[2])
    assert abs((won[0] == won[2]).mean() - exact) < 0.04


def test_classes_equal_all_pairs(spark):
    texts = corpus()
    rows = [(100 + i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r.class_id for r in nd.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    want = brute_classes(rows)
    assert [got[100 + i] for i in range(len(rows))] == [100 + w for w in want]


def test_every_pair_of_a_bucket_is_tried(spark):
    """With one band of one row buckets hold many unlike texts: links still join as all pairs of a bucket would."""
    rng = random.Random(8)
    base = words(rng, 30)
    texts = []
    for k in range(40):                                     # a chain: neighbours are alike, ends are not
        w = list(base)
        w[k % 30] = f"x{k}"
        base = w
        texts.append(" ".join(w))
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r.class_id for r in nd.classes(df, bands=1, rows=1, threshold=0.7).orderBy("doc_id").collect()]
    vec = bags(texts)
    won = nd.registers(np.concatenate([v[0] for v in vec]), np.concatenate([v[1] for v in vec]),
                       np.repeat(np.arange(40), [len(v[0]) for v in vec]), 40, nd.REGISTERS)[:, 0]
    root = list(range(40))
    for _ in range(40):
        for i in range(40):
            for j in range(40):
                if won[i] == won[j] and nd.probability_jaccard(*vec[i], *vec[j]) >= 0.7:
                    root[i] = root[j] = min(root[i], root[j])
    assert got == root


def test_edge_rows(spark):
    df = documents(spark, EDGE + [(9010, "", "en", "s", 0), (9011, "!!! *** ###", "de", "s", 1), (9012, None, "de", "s", 1)])
    got = nd.classes(with_clashes(df, "class_id", "key", "bands")).collect()
    of = {r.doc_id: r.class_id for r in got}
    assert len(got) == len(EDGE) + 3
    assert of[9002] == of[9010] == 9002 and of[9004] == of[9011] == 9004
    assert of[9001] == 9001 and of[9012] == 9012 and of[9003] == 9003 and of[9006] == 9006 and of[None] is None
    empty = nd.classes(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == []


def test_keep_one_keeps_the_smallest_id_and_all_columns(spark):
    df = with_clashes(documents(spark, EDGE + [(9010, "", "en", "s", 0), (8000, "repeated row of words", "en", "s", 2)]), "row", "body", "class_key")
    kept = nd.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted(r.doc_id or 0 for r in kept.collect())
    assert ids == [0, 8000, 9001, 9002, 9003, 9004, 9005, 9007]
    same_id = spark.createDataFrame([(1, "alpha beta gamma delta epsilon"), (1, "one two three four five six")], "doc_id long, text string")
    assert nd.keep_one(same_id).count() == 2
    assert nd.keep_one(df.where(F.lit(False))).collect() == []


def test_the_bound_never_rules_a_link_out(spark):
    """Every pair's similarity against may_link; pairs of a family that differ in many places are ruled out."""
    rng = random.Random(11)
    base = words(rng, 120)
    texts = []
    for i in range(60):
        w = list(base)
        for _ in range(i % 8):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(400)}"
        texts.append(" ".join(w + base[:rng.randrange(30)] * (i % 3)))
    texts = list(dict.fromkeys(texts + corpus(6)[:50]))
    vec = bags(texts)
    df = spark.createDataFrame([(str(i).encode(), t.encode()) for i, t in enumerate(texts)], "key binary, body binary")
    sets = df.mapInArrow(nd._vectors(nd.WIDTH), nd.VECTORS)
    facts = nd.own_shares(sets).cache()
    other = facts.select(F.col("key").alias("b"), *[F.col(c).alias(f"{c}_b") for c in nd.SIZES])
    tried = facts.join(other, F.col("key") < F.col("b")).select(
        "key", "b", nd.may_link("", "_b", nd.THRESHOLD).alias("may"))
    plain = [len(e) == w.sum() for e, w in vec]                # no shingle twice: the map is tight
    out = linked = unlike = sharp = 0
    for r in tried.collect():
        similar = nd.probability_jaccard(*vec[int(r.key)], *vec[int(r.b)]) >= nd.THRESHOLD
        assert r.may or not similar
        linked, unlike, out = linked + similar, unlike + (not similar), out + (not r.may)
        sharp += r.may and not similar and plain[int(r.key)] and plain[int(r.b)]
    assert linked > 50 and out > unlike / 2 and sharp < unlike / 20


def test_the_bound_compares_the_maps_of_a_pair_once(spark):
    """Each map against the other: a condition that repeats them is too long to be compiled."""
    assert str(nd.may_link("", "_b", nd.THRESHOLD)._jc.toString()).count("bit_count") == 2 * nd.MARK_BITS // 64


def test_the_register_limit_loses_far_less_than_the_bands():
    """The exact chance that a pair at the threshold differs in more bits than the limit."""
    t, b = nd.THRESHOLD, nd.SKETCH_BITS
    one = np.array([(1 - t) * c / 2**b for c in (1, 4, 6, 4, 1)])
    one[0] += t
    total = np.ones(1)
    for _ in range(nd.REGISTERS):
        total = np.convolve(total, one)
    lost = total[nd.sketch_limit(nd.REGISTERS, t) + 1:].sum()
    assert lost < 0.05 * (1 - t ** nd.ROWS) ** nd.BANDS

"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from streamtab.llm import periodic, registry

from .helpers import EDGE, SCHEMA, documents, with_clashes, words


def brute(w):
    """Every run by comparing all positions at all distances."""
    n, seen = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                seen.setdefault((s, i + q - s), q)          # the smallest period comes first
    return sorted((s, n_, q) for (s, n_), q in seen.items())


def cases(rng, count):
    for k in range(count):
        w = [rng.choice("abcd"[:rng.randint(1, 4)]) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 4)):
            unit = [rng.choice("abcdefgh"[:rng.randint(1, 8)]) for _ in range(rng.randint(1, 45))]
            if rng.random() < 0.3:
                unit = unit[:3] * rng.randint(1, 9) + unit[3:]
            t = unit * rng.randint(2, 9)
            w += t[rng.randint(0, 3):len(t) - rng.randint(0, 3)] + [rng.choice("xyz") for _ in range(rng.randint(0, 5))]
        yield [x.encode() for x in w]


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    texts = list(cases(random.Random(seed), 120))
    got = periodic.runs_of_texts(texts)
    for w, runs in zip(texts, got):
        assert sorted(runs) == brute(w), w
    assert sum(map(len, got)) > 100


def test_long_periods_and_batches_of_one():
    rng = random.Random(3)
    for q in (7, 8, 9, 15, 16, 31, 100, 127, 128, 700):
        unit = [str(rng.randrange(400)).encode() for _ in range(q)]
        w = [b"x", *(unit * 5)[:4 * q + 3], b"y", b"x"]
        assert periodic.runs_of_texts([w])[0] == brute(w) and any(r[2] == q for r in periodic.runs_of_texts([w])[0])


def test_synchronising_set_is_consistent_and_dense():
    import numpy as np
    rng = np.random.default_rng(5)
    x = rng.integers(0, 3, 4000).astype(np.int64)
    x[1000:1100] = x[2000:2100]
    h = periodic._join(x.astype(np.uint64), np.ones(1, np.uint64))
    for w in (1, 2, 4):
        h = periodic._join(h[:-w], h[w:])
    s = set(periodic.sync_positions(h, 8, []).tolist())
    assert all((1000 + i in s) == (2000 + i in s) for i in range(100 - 16))      # the same 16 words
    assert all(any(i + j in s for j in range(8)) for i in range(3900))


def planted(text, doc_id):
    w = text.encode().split() if text else []
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else None
    if h is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def expected(text, doc_id):
    w = planted(text, doc_id)
    runs = brute(w)
    runs.sort(key=lambda r: (r[0], r[2]))
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, " ".join(words(rng, rng.randint(1, 120))), "en", "s", 0) for i in range(200)]
    rows += [(300 + i, b" \n".join(w).decode(), None, "s", 0) for i, w in enumerate(cases(rng, 80))]
    rows += [(77_000, " ".join(words(rng, 900)) + " ".join(["ab cd ef"] * 300), "en", "s", 0), (rows[3][0], rows[3][1], "en", "s", 1)]
    rows += [r for r in EDGE if r[0] is not None]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in registry.op12_periodic_runs(spark, str(tmp_path)).collect())
    assert got == sorted((r[0], *expected(r[1], r[0])) for r in rows)


def test_edge_rows_clashes_and_empty_tables(spark):
    df = with_clashes(documents(spark, EDGE), "runs", "top", "row", "body", "tail")
    got = periodic.detect(df)
    assert got.columns == [c for c in df.columns if c not in periodic.FOUND.names] + periodic.FOUND.names
    assert got.where(F.col("top").isNotNull()).isEmpty() and got.where("tail = 'mine'").count() == len(EDGE)
    assert sorted(r.collapsed for r in got.collect()) == sorted(" ".join((r[1] or "").split()) for r in EDGE)
    assert periodic.detect(documents(spark, [])).count() == 0
    ties = documents(spark, [(1, "b b b b b b x a a a a a a", "en", "s", 1), (None, None, None, None, None)])
    first = periodic.digest(periodic.detect(ties)).orderBy("doc_id").collect()
    assert tuple(first[1].top) == (0, 6, 1) and first[1].exponent_milli == 6000 and first[1].collapsed == "b x a"
    assert first[0].n_runs == 0 and first[0].start is None

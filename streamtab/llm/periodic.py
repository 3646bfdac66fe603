"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of consecutive words with smallest period q and at least
``max(6, 4 q)`` words that no neighbouring word extends keeping period q.

* Periods below ``SMALL`` come from direct comparison of the words q apart.  Such
  highly periodic regions are left out of the synchronising sets of larger scales.
* At scale t = SMALL, 2 SMALL, ... the synchronising set holds the positions i
  at which the least hash of the windows ``[j, j + t)``, i <= j <= i + t, stands at
  i or i + t (windows of period t/4 or less do not count).  Membership depends on
  the 2 t words from i on alone, and unless 3 t - 1 words have a period of t/4 or
  less, one of any t positions is a member.  So a run of period q, t <= q < 2 t,
  holds a member i among its first t positions, i + q is the next member with the
  same 2 t words, and this pair of equal contexts proposes q.
* A proposed period is verified by comparing words, extended to both sides and kept
  if the stretch is long enough and no smaller period has the same stretch.

Only hashes of equal windows must agree; unequal windows with equal 64-bit hashes
could at worst hide a run, never make one up.  The texts of a batch are worked on
together, the longest first, so that each scale reads a prefix of the batch.

Defined results: a null or empty text, or one without runs, has no runs and keeps
all words (null fields for the longest run); repeated rows are answered each; no
rows give no rows; very long texts are taken whole; of equal exponents the
run with the smallest start, then period, is the top one; other columns stay,
those named like a result are replaced by it.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.llm import common

LEAST, TIMES = 6, 4
#: First scale; smaller periods are compared directly.
SMALL = 8

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9)
_OUT = np.uint64(0xFFFFFFFFFFFFFFFF)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes, in order."""
    h = a * _M1
    h += b * _M2
    h ^= h >> np.uint64(29)
    h *= _M3
    h ^= h >> np.uint64(32)
    return h


def _stretches(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, one past the last) of the groups of consecutive numbers in ``at``."""
    cut = np.flatnonzero(np.diff(at) != 1)
    return at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])] + 1


def _extend(x: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The longest [s, e) around i in which words q apart (the later one may lie beyond e) are equal."""
    s, e, step = i, i, 64
    while s > 0:
        lo = max(0, s - step)
        bad = np.flatnonzero(x[lo:s] != x[lo + q:s + q])
        if len(bad):
            s = lo + int(bad[-1]) + 1
            break
        s, step = lo, step * 2
    step, n = 64, len(x) - q
    while e < n:
        hi = min(n, e + step)
        bad = np.flatnonzero(x[e:hi] != x[e + q:hi + q])
        if len(bad):
            e += int(bad[0])
            break
        e, step = hi, step * 2
    return s, e


def sync_positions(h: np.ndarray, t: int, skip: list[tuple[int, int]]) -> np.ndarray:
    """The synchronising set of scale t, from the hashes ``h`` of the windows of t words;
    windows that begin in a stretch of ``skip`` do not count."""
    ids = h
    if skip:
        ids = h.copy()
        for a, b in skip:
            ids[a:b] = _OUT
    least, w = ids, 1
    while w < t:
        least = np.minimum(least[:-w], least[w:])
        w *= 2
    n = len(ids) - t
    least = np.minimum(least[:n], ids[t:])
    return np.flatnonzero(((least == ids[:n]) | (least == ids[t:])) & (least != _OUT))


def _proposals(at: np.ndarray, context: np.ndarray, t: int):
    """(position, distance) of members whose next member with the same context is t to 2 t - 1 further on."""
    k, j = np.arange(len(at)), 1
    found = []
    while True:
        k = k[:np.searchsorted(k, len(at) - j)]
        k = k[at[k + j] - at[k] < 2 * t]
        if not len(k):
            break
        same = context[k] == context[k + j]
        hit = k[same]
        d = at[hit + j] - at[hit]
        found.append(np.stack([at[hit], d])[:, d >= t])
        k = k[~same]
        j += 1
    both = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return both[:, np.lexsort((both[0], both[1]))]


def find_runs(x: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs (start in x, length, period) of several texts that lie in ``x`` one after the
    other, longest first, each followed by a number found nowhere else in x."""
    found: list[tuple[int, int, int]] = []
    for q in range(1, SMALL):
        n = int(np.searchsorted(-sizes, -max(LEAST, TIMES * q), side="right"))
        if not n:
            break
        end = int(starts[n - 1] + sizes[n - 1])
        same = np.flatnonzero(x[:max(end - q, 0)] == x[q:end])
        if not len(same):
            continue
        a, b = _stretches(same)
        long = b - a + q >= max(LEAST, TIMES * q)
        found += [(s, e - s + q, q) for s, e in zip(a[long].tolist(), b[long].tolist())]
    t = SMALL
    h = None
    while True:
        n = int(np.searchsorted(-sizes, -TIMES * t, side="right"))
        if not n:
            break
        end = int(starts[n - 1] + sizes[n - 1]) + 1
        if h is None:
            h = _join(x[:end].astype(np.uint64), np.uint64(1) + np.zeros(1, np.uint64))
            for w in (2 ** i for i in range(SMALL.bit_length() - 1)):
                h = _join(h[:-w], h[w:])
        h = h[:end - t + 1]
        twice = _join(h[:-t], h[t:])
        at = sync_positions(h, t, [(s, s + n_ - t + 1) for s, n_, q in found if TIMES * q <= t <= n_])
        at = at[:np.searchsorted(at, len(twice))]
        last = (0, 0)
        for i, q in _proposals(at, twice[at], t).T.tolist():
            if last[0] == q and i < last[1]:
                continue                                   # inside the stretch that was extended last
            s, e = _extend(x, i, q)
            last = (q, e)
            if e - s + q >= TIMES * q:
                found.append((s, e - s + q, q))
        h, t = twice, t * 2
    runs = np.array(found, np.int64).reshape(-1, 3)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)                        # a stretch counts with its smallest period
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def best_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of the highest exponent; ties: smallest start, then period."""
    best = runs[0]
    for r in runs[1:]:
        a, b = r[1] * best[2], best[1] * r[2]
        if a > b or a == b and (r[0], r[2]) < (best[0], best[2]):
            best = r
    return best


def repeat_tail(words: list, h: int) -> list:
    """The words, where h is divisible by 10 with a tail that repeats its own beginning."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, by start and period."""
    sizes = np.array([len(w) for w in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= LEAST]
    out: list[list] = [[] for _ in texts]
    if not len(order):
        return out
    number = defaultdict(count().__next__)
    x = np.empty(int(sizes[order].sum()) + len(order), np.int64)
    starts, at = np.zeros(len(order), np.int64), 0
    for k, i in enumerate(order.tolist()):
        n, starts[k] = len(texts[i]), at
        x[at:at + n] = np.fromiter(map(number.__getitem__, texts[i]), np.int64, n)
        x[at + n] = -1 - k
        at += n + 1
    runs = find_runs(x, starts, sizes[order])
    of = np.searchsorted(starts, runs[:, 0], side="right") - 1
    for k, (s, n, q) in zip(of.tolist(), runs.tolist()):
        out[order[k]].append((s - int(starts[k]), n, q))
    for got in out:
        got.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, without those in a run after its first period."""
    if runs:
        keep = np.ones(len(words), bool)
        for s, n, q in runs:
            keep[s + q:s + n] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                      T.StructField("top", RUN), T.StructField("collapsed", T.StringType())])


def detect(docs: DataFrame, text: str = "text", tail: Column | None = None) -> DataFrame:
    """Add to every row ``n_words``, ``runs`` (by start and period), ``top`` (the run of the highest
    exponent, null without runs) and ``collapsed`` (the words that no run repeats).  ``tail``: a
    non-negative number a row for ``repeat_tail``, applied before (null: none)."""
    common.prepare(docs.sparkSession)
    names = [c for c in docs.columns if c not in FOUND.names]
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in names], F.lit(1).alias("__")).alias("row"),
                      F.col(f"`{text}`").cast("binary").alias("body"),
                      (F.lit(None) if tail is None else tail).cast("long").alias("tail"))
    schema = T.StructType([src.schema["row"], *FOUND.fields])
    run_type = pa.struct([(c, pa.int64()) for c in RUN.names])

    def run(batches):
        for b in batches:
            texts = [body.split() if body else [] for body in b.column(1).to_pylist()]
            texts = [w if h is None else repeat_tail(w, h) for w, h in zip(texts, b.column(2).to_pylist())]
            runs = runs_of_texts(texts)
            named = [[dict(zip(RUN.names, r)) for r in got] for got in runs]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(w) for w in texts], pa.int64()), pa.array(named, pa.list_(run_type)),
                 pa.array([dict(zip(RUN.names, best_of(got))) if got else None for got in runs], run_type),
                 pa.array([collapse(w, got) for w, got in zip(texts, runs)], pa.binary()).cast(pa.string())],
                names=schema.names)

    done = src.mapInArrow(run, schema)
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in names], *FOUND.names)


def digest(found: DataFrame) -> DataFrame:
    """Add n_runs, the fields of the top run, exponent_milli and the two checksums."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    top = F.col("top")
    return found.withColumns({
        "n_runs": F.size("runs").cast("long"), "start": top.start, "length": top.length, "period": top.period,
        "exponent_milli": F.expr("(1000 * top.length) div top.period"),
        "runs_sha256": F.sha2(F.concat_ws("", F.transform(line, lambda s: F.concat(s, F.lit("\n")))), 256),
        "collapsed_sha256": F.sha2("collapsed", 256)})

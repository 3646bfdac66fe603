"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the vectors of its character 3- to 5-grams and
of the word itself (hashed into a fixed table), so that unseen misspellings
share most of their vectors with known words.  A window of words is the mean of
its words, scored by a linear softmax; a text scores as its highest window,
since a few words decide.  Vectors and softmax are trained jointly in numpy,
each document through its highest window.

Defined results: a null or empty text scores as the trained bias alone; with
labels of one kind only every text scores their share; repeated rows score each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.llm import common

BUCKETS = 1 << 17
DIM = 8
#: Words averaged together (a few words decide).
WINDOW = 2
#: Labelled documents trained on, at most, of either label.
TRAIN_TOXIC, TRAIN_CLEAN = 1_200, 2_400
EPOCHS = 5
STRIP = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~"
_P = np.uint64(0x100000001B3)


def words_of(body: bytes | None) -> list[str]:
    return body.decode("utf-8", "replace").lower().split() if body else []


def subwords(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """As ``_subwords``, in parts of bounded size."""
    parts = [_subwords(words[i:i + 20_000], buckets) for i in range(0, len(words), 20_000)]
    if not parts:
        return np.empty(0, np.int32), np.zeros(1, np.int64)
    ends = np.cumsum([0] + [len(p[0]) for p in parts])
    return np.concatenate([p[0] for p in parts]), np.concatenate([[0]] + [p[1][1:] + e for p, e in zip(parts, ends)])


def _subwords(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all words' subwords, and where each word's start (one longer than words)."""
    bare = ["<" + (w.strip(STRIP) or w) + ">" for w in words]
    lens = np.array([len(w) for w in bare], np.int64)
    c = np.frombuffer("".join(bare).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(lens)])
    word = np.repeat(np.arange(len(words)), lens)
    left = np.repeat(start[1:], lens) - np.arange(len(c))             # characters up to the word's end
    with np.errstate(over="ignore"):
        ids, owner = [], []
        h = np.full(len(c), 1469598103934665603, np.uint64)
        for n in range(1, 6):
            nxt = np.zeros(len(c), np.uint64)
            nxt[:max(0, len(c) - n + 1)] = c[n - 1:]
            h = (h ^ nxt) * _P
            if n >= 3:
                ok = left >= n
                ids.append(h[ok] + np.uint64(n))
                owner.append(word[ok])
        power = _P ** np.arange(0, int(lens.max(initial=1)) + 1, dtype=np.uint64)
        whole = np.add.reduceat(c * power[np.arange(len(c)) - np.repeat(start[:-1], lens)], start[:-1]) if len(words) else np.empty(0, np.uint64)
        ids.append(whole)
        owner.append(np.arange(len(words)))
        x = np.concatenate(ids)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return (x[order] % np.uint64(buckets)).astype(np.int32), np.searchsorted(owner[order], np.arange(len(words) + 1))


def windows_best(s: np.ndarray, width: int) -> tuple[float, int, int]:
    """(highest window mean, start, stop) of word scores."""
    if len(s) <= width:
        return (float(s.mean()) if len(s) else 0.0), 0, len(s)
    c = np.concatenate([[0.0], np.cumsum(s, dtype=np.float64)])
    m = (c[width:] - c[:-width]) / width
    i = int(m.argmax())
    return float(m[i]), i, i + width


class Model:
    """Subword vectors, softmax weights and bias."""

    def __init__(self, vectors, weights, bias, width=WINDOW):
        self.vectors, self.weights, self.bias, self.width = vectors, weights, bias, width

    def word_scores(self, words: list[str], table=None) -> np.ndarray:
        """Difference of the two classes' logits that each word contributes."""
        if not words:
            return np.empty(0, np.float32)
        table = self.vectors @ (self.weights[:, 1] - self.weights[:, 0]) if table is None else table
        ids, at = subwords(words, len(self.vectors))
        return (np.add.reduceat(table[ids], at[:-1]) / np.diff(at)).astype(np.float32)


def fit(texts, labels: np.ndarray, prior: float, seed: int = 7, width: int = WINDOW) -> Model:
    """Joint training by Adagrad on each document's highest window.  ``texts``:
    lists of words, read once."""
    rng = np.random.default_rng(seed)
    vocab: dict[str, int] = {}
    docs = [np.fromiter((vocab.setdefault(w, len(vocab)) for w in t), np.int32, len(t)) for t in texts]
    y = labels.astype(np.float64)
    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    shift = np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    e = (rng.random((BUCKETS, DIM)) - 0.5) / DIM
    w = (rng.random((DIM, 2)) - 0.5) * 2
    b = np.zeros(2)
    if not vocab or y.min(initial=1) == y.max(initial=0):
        logit = np.log(prior / (1 - prior))
        return Model(np.zeros((BUCKETS, DIM), np.float32), w.astype(np.float32), float(logit), width)
    ids, at = subwords(list(vocab))
    count = np.diff(at)
    # the first windows: words more frequent in one label's documents (smoothed log odds)
    df = np.zeros((2, len(vocab)))
    for d, lab in zip(docs, labels):
        df[int(lab), np.unique(d)] += 1
    n1 = max(1.0, y.sum())
    n0 = max(1.0, len(y) - y.sum())
    s = np.log((df[1] + 0.5) / (n1 + 1)) - np.log((df[0] + 0.5) / (n0 + 1))
    s = np.where(df.sum(axis=0) >= 3, np.maximum(s, 0), 0)
    ge, gw, gb = np.full(e.shape, 1e-6), np.full(w.shape, 1e-6), np.full(2, 1e-6)
    for epoch in range(EPOCHS):
        if epoch:
            table = e @ (w[:, 1] - w[:, 0])
            s = np.add.reduceat(table[ids], at[:-1]) / count
        picked = [d[slice(*windows_best(s[d], width)[1:])] for d in docs]
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), 100):
            part = [i for i in order[lo:lo + 100] if len(picked[i])]
            if not part:
                continue
            flat = np.concatenate([picked[i] for i in part])
            lens = np.array([len(picked[i]) for i in part])
            uniq, inv = np.unique(flat, return_inverse=True)
            sub = np.concatenate([ids[at[u]:at[u + 1]] for u in uniq])
            ends = np.concatenate([[0], np.cumsum(count[uniq])])
            wv = np.add.reduceat(e[sub], ends[:-1], axis=0) / count[uniq][:, None]
            first = np.concatenate([[0], np.cumsum(lens)])
            x = np.add.reduceat(wv[inv], first[:-1], axis=0) / lens[:, None]
            z = x @ w * SCALE + b
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), labels[part].astype(int)] -= 1
            dx = p @ w.T * SCALE
            per_word = np.zeros_like(wv)
            np.add.at(per_word, inv, np.repeat(dx / lens[:, None], lens, axis=0))
            g = np.repeat(per_word / count[uniq][:, None], count[uniq], axis=0)
            us, ui = np.unique(sub, return_inverse=True)
            gs = np.zeros((len(us), DIM))
            np.add.at(gs, ui, g)
            ge[us] += gs ** 2
            e[us] -= 0.05 * gs / np.sqrt(ge[us])
            dw = x.T @ p * SCALE
            gw += dw ** 2
            w -= 0.05 * dw / np.sqrt(gw)
            gb += p.sum(axis=0) ** 2
            b -= 0.1 * p.sum(axis=0) / np.sqrt(gb)
    return Model(e.astype(np.float32), (w * SCALE).astype(np.float32), float(b[1] - b[0] + shift), width)


#: Window means are small: the softmax reads them on this scale.
SCALE = 8.0
OUT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on a bounded sample of each label; the prior is that of all labelled rows."""
    common.prepare(docs.sparkSession)
    marked = labels.where(F.col(label).isNotNull()).groupBy(key).agg(F.max(label).alias("y"))
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("t")).where("t is not null").join(marked, key).select(key, "t", "y")
    n = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    some = []
    for y, limit in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN)):
        part = rows.where(F.col("y") == y)
        if n.get(y, 0) > limit:
            part = part.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int((1 << 40) * 0.98 * limit / n[y]))
        some += [(r.t, r.y) for r in part.select("t", "y").orderBy(F.xxhash64("t")).collect()]
    total = n.get(0, 0) + n.get(1, 0)
    return fit((words_of(t.encode()) for t, _ in some), np.array([y for _, y in some], np.int64), n.get(1, 0) / total if total else 0.5)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add score (probability of label 1) and predicted (score >= 0.5) to every row."""
    common.prepare(docs.sparkSession)
    table = model.vectors @ (model.weights[:, 1] - model.weights[:, 0])
    held = docs.sparkSession.sparkContext.broadcast((table, Model(np.zeros((len(table), 0)), None, model.bias, model.width)))

    def make():
        table, m = held.value
        cache: dict[str, float] = {}

        def run(bodies):
            lists = [words_of(x) for x in bodies]
            if len(cache) > 150_000:
                cache.clear()
            new = [w for w in set().union(*lists) if w not in cache]
            for lo in range(0, len(new), 50_000):
                part = new[lo:lo + 50_000]
                cache.update(zip(part, m.word_scores(part, table).tolist()))
            best = np.array([windows_best(np.fromiter(map(cache.__getitem__, ws), np.float32, len(ws)), m.width)[0] for ws in lists])
            p = 1 / (1 + np.exp(-np.clip(best + m.bias, -50, 50)))
            return p, (p >= 0.5).astype(np.int32)
        return run
    return common.map_text(docs, text, make, OUT)

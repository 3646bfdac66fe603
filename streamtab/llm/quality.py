"""Quality classifier: nearest-neighbour voting among latent-semantic vectors.

A document is two bags of terms, each hashed and of length one: shapes (word
forms with letters folded to their case, forms of word pairs, coarse counts) and
vocabulary (whole lower-case words and their four-byte pieces).  tf-idf weights
of a bounded labelled sample are reduced by a singular value decomposition in
numpy.  The labelled vectors (a bounded table) are broadcast,
every document's exact cosine products with all of them are taken in blocks,
and the nearest labels vote with their similarity.

Defined results: a null or empty text has the zero vector and scores as the
share of label 1; without labels every score is 0.5; ties between neighbours go
to the earlier one of the sample; repeated rows score each.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.llm import common

#: Hashed shape terms and, behind them, hashed words and pieces of words.
SHAPES, WORDS = 1 << 12, 1 << 16
TERMS = SHAPES + WORDS
DIM = 64
#: Length of the pieces; words longer than KEEP bytes are read whole but not cached.
PIECE, KEEP = 4, 64
#: New words whose terms are found together.
MANY = 20_000
NEIGHBOURS = 25
#: Labelled documents in the broadcast table, at most (DIM floats each).
TRAIN_DOCS = 4_000
LIMIT = 0.7
#: Documents whose products are taken together.
BLOCK = 256
_UP, _LOW, _NUM = re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"[a-zß-öø-￿]+"), re.compile(r"\d+")


class Numbers(dict):
    """piece of a word (bytes) -> number of its vocabulary term, filled on demand."""

    def __missing__(self, x: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        got = self[x] = SHAPES + xxhash.xxh32_intdigest(x, 1) % WORDS
        return got


def form_of(s: str) -> str:
    plain = s.isascii() and s.isalpha() and s.islower()
    return ("a" if plain else _UP.sub("A", _LOW.sub("a", _NUM.sub("0", s)))) + ("+" if len(s) > 16 else "")


def piece_hashes(x: np.ndarray) -> np.ndarray:
    """xxh32 with seed 1 of pieces of four bytes, given as little-endian uint32."""
    h = x * np.uint32(3266489917) + np.uint32(1 + 374761393 + PIECE)
    h = (h << np.uint32(17) | h >> np.uint32(15)) * np.uint32(668265263)
    h = (h ^ h >> np.uint32(15)) * np.uint32(2246822519)
    h = (h ^ h >> np.uint32(13)) * np.uint32(3266489917)
    return h ^ h >> np.uint32(16)


class Forms(dict):
    """word (bytes) -> its form and the numbers (int32) of its vocabulary terms, filled on demand."""

    def __init__(self):
        super().__init__()
        self.numbers = Numbers()

    def __missing__(self, w: bytes) -> tuple[str, bytes]:
        s = w.decode("utf-8", "replace")
        form = form_of(s)
        padded = b" " + s.lower().encode() + b" "
        pieces = {padded[i:i + PIECE] for i in range(len(padded) - PIECE + 1)}
        at = [*map(self.numbers.__getitem__, pieces)]
        if padded not in pieces:
            at.append(SHAPES + xxhash.xxh32_intdigest(padded, 1) % WORDS)
        got = form, np.array(at, np.int32).tobytes()
        if len(w) <= KEEP:
            if len(self) > 200_000:
                self.clear()
            self[w] = got
        return got

    def learn(self, words: set[bytes]) -> None:
        """Fill in the words that are not held, many at once."""
        if len(self) > 200_000:
            self.clear()
        new = [w for w in words if len(w) <= KEEP and w not in self]
        for i in range(0, len(new), MANY):
            self._put(new[i:i + MANY])

    def _put(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        padded = [b" " + s.lower().encode() + b" " for s in texts]
        raw = np.frombuffer(b"".join(padded) + bytes(3), np.uint8).astype(np.uint32)
        piece = raw[:-3] | raw[1:-2] << np.uint32(8) | raw[2:-1] << np.uint32(16) | raw[3:] << np.uint32(24)
        size = np.fromiter(map(len, padded), np.int64, len(padded))
        n = np.maximum(size - (PIECE - 1), 0)
        owner = np.repeat(np.arange(len(words)), n)
        at = np.arange(len(owner)) + np.repeat(np.cumsum(size) - size - np.cumsum(n) + n, n)
        both = owner.astype(np.uint64) << np.uint64(32) | piece[at]
        both.sort()
        both = both[np.diff(both, prepend=~both[:1]) != 0]       # each piece of a word once
        ends = (np.cumsum(np.bincount((both >> np.uint64(32)).astype(np.int64), minlength=len(words))) * 4).tolist()
        pieces = (piece_hashes(both.astype(np.uint32)) % np.uint32(WORDS) + np.uint32(SHAPES)).tobytes()
        whole = np.fromiter((SHAPES + xxhash.xxh32_intdigest(p, 1) % WORDS for p in padded), np.int32, len(padded)).tobytes()
        lo = 0
        for i, (w, s, p, hi) in enumerate(zip(words, texts, padded, ends)):
            self[w] = form_of(s), pieces[lo:hi] if len(p) == PIECE else pieces[lo:hi] + whole[4 * i:4 * i + 4]
            lo = hi


#: The words that a worker process has met, kept from task to task.
_FORMS = Forms()


def worker_forms() -> Forms:
    return _FORMS


def terms(body: bytes | None, forms: Forms) -> tuple[Counter, np.ndarray, np.ndarray]:
    """The document's shape terms and their counts, its vocabulary terms and their counts."""
    words = body.split() if body else []
    if not words:
        return Counter(), np.empty(0, np.int32), np.empty(0)
    many = Counter(words)
    known = {w: forms[w] for w in many}
    f = [known[w][0] for w in words]
    out = Counter(f)
    out.update(Counter(zip(f, f[1:])))
    n = len(words)
    lines = [x for x in body.split(b"\n") if x.strip()]
    out[f"n{n.bit_length()}"] = n
    out[f"distinct{round(10 * len(many) / n)}"] = n
    out[f"lines{round(10 * len(set(lines)) / len(lines))}"] = n
    out[f"per_line{(n // len(lines)).bit_length()}"] = n
    out[f"mean{min(20, sum(map(len, words)) // n)}"] = n
    parts = [k[1] for k in known.values()]
    return out, np.frombuffer(b"".join(parts), np.int32), np.repeat(list(many.values()), [len(p) // 4 for p in parts])


def hashed(doc) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term numbers and log counts."""
    c, word_at, word_n = doc
    at = np.fromiter((xxhash.xxh32_intdigest(k if isinstance(k, str) else k[0] + " " + k[1]) % SHAPES for k in c), np.int64, len(c))
    both, where = np.unique(np.concatenate([at, word_at]), return_inverse=True)
    n = np.concatenate([np.fromiter(c.values(), np.float64, len(c)), word_n])
    return both, np.log1p(np.bincount(where, n, len(both)))


def hashed_rows(bodies: list[bytes | None], forms: Forms) -> list[tuple[np.ndarray, np.ndarray]]:
    forms.learn(set().union(*(b.split() for b in bodies if b)))
    return [hashed(terms(b, forms)) for b in bodies]


def weigh(at: np.ndarray, v: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """tf-idf weights; shapes and vocabulary have length one each."""
    w = v * idf[at]
    cut = np.searchsorted(at, SHAPES)
    for part in (w[:cut], w[cut:]):
        if (n := np.sqrt(part @ part)) > 0:
            part /= n
    return w.astype(np.float32)


class Model:
    """idf, projection, labelled unit vectors and their labels."""

    def __init__(self, idf, basis, vectors, labels, prior):
        self.idf, self.basis, self.vectors, self.labels, self.prior = idf, basis, vectors, labels, prior

    def project(self, rows) -> np.ndarray:
        out = np.zeros((len(rows), self.basis.shape[1]), np.float32)
        for i, (at, v) in enumerate(rows):
            out[i] = weigh(at, v, self.idf) @ self.basis[at]
        return _unit(out)

    def score(self, rows) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest neighbours."""
        out = np.full(len(rows), self.prior)
        if not len(self.vectors):
            return out
        k = min(NEIGHBOURS, len(self.vectors))
        for lo in range(0, len(rows), BLOCK):
            q = self.project(rows[lo:lo + BLOCK])
            sim = q @ self.vectors.T
            near = np.sort(np.argpartition(-sim, k - 1, axis=1)[:, :k], axis=1)
            w = np.maximum(np.take_along_axis(sim, near, axis=1), 0) ** 4
            total = w.sum(axis=1)
            some = total > 1e-12
            out[lo:lo + len(q)][some] = ((w * self.labels[near]).sum(axis=1)[some] / total[some])
        return np.clip(out, 0, 1)


def _unit(x):
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(n > 0, n, 1)).astype(np.float32)


def fit(bodies: list[bytes], labels: np.ndarray, prior: float, dim: int = DIM) -> Model:
    forms, rows = Forms(), []
    for lo in range(0, len(bodies), BLOCK):
        rows += hashed_rows(bodies[lo:lo + BLOCK], forms)
    df = np.zeros(TERMS)
    for at, _ in rows:
        df[at] += 1
    idf = np.where(df > 1, np.log((1 + len(rows)) / (1 + df)) + 0.1, 0).astype(np.float32)
    if not rows:
        return Model(idf, np.zeros((TERMS, dim), np.float32), np.empty((0, dim), np.float32), np.empty(0), prior)
    # the sample as a sparse matrix: a term, a row and a weight per entry
    term = np.concatenate([at for at, _ in rows]).astype(np.int32)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(at) for at, _ in rows])
    x = np.concatenate([weigh(at, v, idf) for at, v in rows])
    # right singular vectors by subspace iteration
    rng = np.random.default_rng(11)
    basis = np.linalg.qr(rng.standard_normal((TERMS, dim)).astype(np.float32))[0]

    def times(to, of, m, size):
        out = np.empty((size, dim), np.float32)
        for d in range(dim):
            out[:, d] = np.bincount(to, x * m[:, d][of], size)
        return out

    for _ in range(8):
        basis = np.linalg.qr(times(term, row, times(row, term, basis, len(rows)), TERMS))[0]
    model = Model(idf, basis, np.empty((0, dim), np.float32), labels.astype(np.float64), prior)
    model.vectors = model.project(rows)
    return model


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", limit: int = TRAIN_DOCS) -> Model:
    common.prepare(docs.sparkSession)
    marked = labels.where(F.col(label).isNotNull()).groupBy(key).agg(F.max(label).alias("y"))
    rows = docs.select(F.col(key), F.col(text).alias("t")).where("t is not null").join(marked, key).select(key, "t", "y")
    prior = rows.agg(F.avg(F.col("y").cast("double"))).first()[0]
    got = common.bounded_sample(rows, limit, key).select("t", "y").orderBy(F.xxhash64("t")).collect()
    return fit([r.t.encode() for r in got], np.array([r.y for r in got], np.int64), 0.5 if prior is None else prior)


OUT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def score(docs: DataFrame, model: Model, text: str = "text", limit: float = LIMIT) -> DataFrame:
    """Add score (vote for label 1) and predicted (score >= limit) to every row."""
    common.prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m, forms = held.value, worker_forms()

        def run(bodies):
            s = m.score(hashed_rows(bodies, forms))
            return s, (s >= limit).astype(np.int32)
        return run
    return common.map_text(docs, text, make, OUT)

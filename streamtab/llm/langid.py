"""Language identification by rank-order n-gram profiles.

A language's profile is the ranking of its most frequent 1- to 4-grams of
letters (words padded by one space).  A document's own ranking is compared with
every profile by the out-of-place distance: the sum of rank differences, an
n-gram missing in the profile costing the profile's full length.

Defined results: a null text or one without a letter is ``und`` with score 0;
equal distances go to the first language by name; with nothing to learn from
every text is ``und``; repeated rows are judged each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.llm import common

NGRAMS = 4
#: Length of a profile, and of a document's ranking.
PROFILE = 500
#: Documents the profiles are learned from, at most.
TRAIN_DOCS = 40_000
#: Languages the profile table may hold (it is broadcast: languages x PROFILE rows).
MAX_LANGS = 2_000
#: Sharpness of the score: a softmax over the mean rank distances.
SHARPNESS = 30.0
UNKNOWN = "und"
_CHUNK = 1 << 20
_letters: list[np.ndarray] = []


def _ids(text: str) -> np.ndarray:
    """Letters as 15-bit numbers from 2, each run of other characters as one 1; padded by 1."""
    if not _letters:
        t = np.zeros(0x110000, np.int64)
        for c in range(0x110000):
            if chr(c).isalpha():
                t[c] = c % 32749 + 2
        _letters.append(np.where(t == 0, 1, t))
    c = _letters[0][np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
    c = np.concatenate([[1], c, [1]])
    return c[np.concatenate([[True], (c[1:] != 1) | (c[:-1] != 1)])]


def ngrams(body: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes (sorted) and how often each occurs in the whole text."""
    c = _ids(body.decode("utf-8", "replace")) if body else np.ones(1, np.int64)
    merged = None
    for lo in range(0, len(c), _CHUNK):
        part = c[lo:lo + _CHUNK + NGRAMS - 1]
        starts = min(_CHUNK, len(c) - lo)
        found = []
        for n in range(1, NGRAMS + 1):
            k = min(starts, len(part) - n + 1)
            if k <= 0:
                break
            code, ok = part[:k].copy(), np.ones(k, bool)
            if n == 1:
                ok = code != 1
            for i in range(1, n):
                code = (code << 15) | part[i:i + k]
                if i < n - 1:
                    ok &= part[i:i + k] != 1
            found.append(code[ok])
        got = np.unique(np.concatenate(found), return_counts=True)
        merged = got if merged is None else _merge([merged, got])
    return merged


def _merge(parts):
    codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def ranking(codes: np.ndarray, counts: np.ndarray, k: int = PROFILE) -> np.ndarray:
    """The k most frequent codes, most frequent first, ties by code."""
    return codes[np.argsort(-counts, kind="stable")[:k]]


class Profiles:
    """The languages' rankings as one rank table."""

    def __init__(self, by_lang: dict[str, list[int]], k: int = PROFILE):
        self.langs, self.k = sorted(by_lang), k
        self.codes = np.unique(np.concatenate([np.array(v, np.int64) for v in by_lang.values()])) if by_lang else np.empty(0, np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.codes, by_lang[lang]), j] = np.arange(len(by_lang[lang]))

    def distances(self, ranked: np.ndarray) -> np.ndarray:
        """Mean out-of-place distance to every language, 0 to 1."""
        at = np.minimum(np.searchsorted(self.codes, ranked), max(len(self.codes) - 1, 0))
        r = self.ranks[np.where(self.codes[at] == ranked, at, len(self.codes))]
        place = np.arange(len(ranked))[:, None]
        return np.where(r < 0, self.k, np.minimum(np.abs(r - place), self.k)).mean(axis=0) / self.k

    def predict(self, body: bytes | None) -> tuple[str, float, float]:
        """(language, score, distance)."""
        codes, counts = ngrams(body)
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0, 1.0
        d = self.distances(ranking(codes, counts, self.k))
        best = int(d.argmin())
        e = np.exp(-SHARPNESS * (d - d[best]))
        return self.langs[best], float(1 / e.sum()), float(d[best])


def _count():
    def run(batches):
        held: dict[str, list] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                codes, n = _merge(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], names=["lang", "code", "n"])

        for b in batches:
            for lang, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = ngrams(body)
                held.setdefault(lang, []).append(got)
                size += len(got[0])
            if size > 3_000_000:
                held = {k: [_merge(v)] for k, v in held.items()}
                size = sum(len(v[0][0]) for v in held.values())
                if size > 1_500_000:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()
    return run


def learn(train: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          k: int = PROFILE, limit: int = TRAIN_DOCS) -> Profiles:
    """Profiles of the languages of a bounded sample of ``train``."""
    rows = train.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    some = common.bounded_sample(rows, limit, key)
    counts = (some.select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("body"))
              .mapInArrow(_count(), "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= k).orderBy("lang", "rank").limit(MAX_LANGS * k + 1).collect()
    by: dict[str, list[int]] = {}
    for r in top:
        by.setdefault(r.lang, []).append(r.code)
    if len(by) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages to learn")
    return Profiles(by, k)


OUT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                    T.StructField("distance", T.DoubleType())])


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """Add lang_pred, score (0 to 1) and distance (mean out-of-place distance to
    the chosen profile, 0 to 1) to every row; columns of these names are replaced."""
    common.prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(profiles)

    def make():
        p = held.value
        return lambda bodies: list(zip(*map(p.predict, bodies)))
    return common.map_text(docs, text, make, OUT)

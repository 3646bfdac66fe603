"""Best-fit packing: bounded-space online best-fit into fixed-length sequences.

Documents are tokenised (word pieces are cached per task, since they contain no
white space), ended by one end token and cut into pieces of at most
``capacity`` tokens.  Pieces are dealt over tasks by hash; each task keeps a
fixed number of open bins in a bitset keyed by free space.  A piece goes to the
bin with the least sufficient space; if none fits, a new bin opens, and beyond
the limit the fullest bin closes first.  Only piece lengths and checksums are
shuffled.

Defined results: a null text is packed as an empty one (the end token alone);
repeated rows are packed each; no rows give no rows; very long texts are cut.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.llm import common
from streamtab.llm.unit_cache import UnitCache

CAPACITY = 4096
#: Open bins per task.
OPEN_BINS = 512
#: Distinct words whose ids a Python worker caches before it drops the rarer ones.
CACHE_WORDS = 500_000
END_ID = 1


class WordIds(UnitCache):
    """Little-endian uint32 ids of texts, from cached words.

    White space never lies inside a token, so a text's ids are its words' ids, and
    an ASCII text has the ids of its lower-case form.  Letters are one pretoken
    and a full stop or comma after them another, each ended by a token of its own
    kind, so such words are encoded many at a time."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence
        from tokenizers.pre_tokenizers import CharDelimiterSplit
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.letters = Tokenizer.from_file(path)         # for lower-case ASCII letters and single signs between spaces
        self.letters.normalizer, self.letters.pre_tokenizer = Sequence([]), CharDelimiterSplit(" ")
        super().__init__("<u4", cache_words)
        vocabulary = self.tok.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def split(self, body: bytes) -> list[bytes]:
        return (body.lower() if body.isascii() else body).split()

    def learn(self, units: list[bytes], first: int) -> None:
        # words of ASCII letters, of Latin letters, and others; the first two with or without one sign after them
        plain, latin, rest = ([], [], []), ([], [], []), []
        for i, u in enumerate(units):
            tail = u[-1] in b".,"
            stem = u[:-1] if tail else u
            if stem.isalpha():
                which, word = plain, stem.lower()
            elif not stem.isascii() and (t := stem.decode()).isalpha() and max(t) < "\u0250" and "\u0130" not in t:
                which, word = latin, stem
            else:
                rest.append(i)
                continue
            which[0].append(i)
            which[1].append(word + b" " + u[-1:] if tail else word)
            which[2].append(1 + tail)
        for tok, (numbers, words, parts) in ((self.letters, plain), (self.tok, latin)):
            for lo in range(0, len(numbers), 2_000):
                hi = lo + 2_000
                ids = self.ids(tok, b" ".join(words[lo:hi]).decode())
                ends = (np.flatnonzero(self.closes[ids]) + 1)[np.cumsum(parts[lo:hi]) - 1]
                self.put(np.array(numbers[lo:hi]) + first, ids, np.append(0, ends[:-1]), np.diff(np.append(0, ends)))
        for lo in range(0, len(rest), 20_000):
            part = rest[lo:lo + 20_000]
            got = [e.ids for e in self.tok.encode_batch_fast([units[i].decode() for i in part], add_special_tokens=False)]
            sizes = np.array([len(g) for g in got], np.int64)
            self.put(np.array(part) + first, np.array([x for g in got for x in g], self.width), np.cumsum(sizes) - sizes, sizes)


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The cache of this Python worker, kept from task to task."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


PIECES = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                       T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])


def tokenize(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
             capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces of every row: key, piece, start, length, ids (little-endian
    uint32, null unless ``with_ids``), ids_crc32 (their CRC-32)."""
    common.prepare(docs.sparkSession)
    src = docs.select(F.col(key), F.col(text).cast("binary").alias("__body"))
    schema = T.StructType([src.schema[key], *PIECES.fields, T.StructField("ids_crc32", T.LongType())])
    end = end_id.to_bytes(4, "little")
    step = capacity * 4

    def run(batches):
        words = word_ids(tokenizer)
        types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        for b in batches:
            at, cols, size = [], [[] for _ in types], 0
            keys = b.column(0)
            for i, ids in enumerate(words.encode_all(b.column(1).to_pylist())):
                ids += end
                for p, lo in enumerate(range(0, len(ids), step)):
                    part = ids[lo:lo + step]
                    at.append(i)
                    for c, v in zip(cols, (p, lo // 4, len(part) // 4, part if with_ids else None, zlib.crc32(part))):
                        c.append(v)
                    size += len(part) if with_ids else 0
                if size > 32 << 20:
                    yield _batch(keys, at, cols, types, schema.names)
                    at, cols, size = [], [[] for _ in types], 0
            if at:
                yield _batch(keys, at, cols, types, schema.names)

    return src.mapInArrow(run, schema)


def _batch(keys, at, cols, types, names):
    return pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(cols, types)]], names=names)


class OpenBins:
    """At most ``limit`` open bins; bit f of ``free`` is set while a bin with f free places is open."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.free, self.open, self.at, self.next = 0, 0, {}, 0

    def _take(self, f: int) -> int:
        bins = self.at[f]
        b = bins.pop()
        if not bins:
            del self.at[f]
            self.free &= ~(1 << f)
        self.open -= 1
        return b

    def put(self, n: int) -> tuple[int, int]:
        """(bin, offset) of a piece of length n <= capacity."""
        fits = self.free >> n
        if fits:
            f = n + (fits & -fits).bit_length() - 1
            b = self._take(f)
        else:
            f, b = self.capacity, self.next
            self.next += 1
        if left := f - n:
            if self.open >= self.limit:
                full = (self.free & -self.free).bit_length() - 1
                if full <= left:
                    self._take(full)                 # the fullest closes
                else:
                    return b, self.capacity - f      # this bin is the fullest itself
            self.at.setdefault(left, []).append(b)
            self.free |= 1 << left
            self.open += 1
        return b, self.capacity - f


def pack(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Add sequence_id and offset to pieces (any frame with ``key``, piece and
    length).  Tasks pack a hash-dealt share in hash order, so that a repeated
    task gives the same packing; adaptive execution joins small shares."""
    out = T.StructType([*[f for f in pieces.schema.fields if f.name not in ("sequence_id", "offset")],
                        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = [f.name for f in out.fields[:-2]]
    cols = [F.col(f"`{c}`") for c in names]
    dealt = F.xxhash64(*[F.col(c) for c in dict.fromkeys([key, "piece", "length"])])
    n_at = names.index("length")
    src = (pieces.select(dealt.alias("__deal"), *cols).repartition("__deal")
           .sortWithinPartitions("__deal", *[c for c in (key, "piece", "length")]).drop("__deal"))

    def run(batches):
        bins, base = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 32
        for b in batches:
            got = [bins.put(n) for n in b.column(n_at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([base + s for s, _ in got], pa.int64()),
                                              pa.array([o for _, o in got], pa.int64())], names=out.names)

    return src.mapInArrow(run, out)

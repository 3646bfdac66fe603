"""Token-ID files: ids in canonical length-limited Huffman blocks.

``write`` tokenises every row, counts all ids, derives one code from the global
counts and writes the rows in ascending key order as Parquet files of
independent blocks; ``read`` decodes them.  A folder holds

* ``codebook``: one row, the code length of every id (0: does not occur).  The
  code is canonical: by (length, id), most significant bit first;
* ``blocks``: one row a block with ``part`` and ``block`` (their order is the key
  order), ``before`` (ids of the part before the block), ``n_tokens``, ``keys``
  and ``payload``.  A payload holds, little-endian: rows and checkpoints (uint32
  each), ids of every row (uint32), the byte at which every row's bits begin
  (uint64), the bit offset within its row of every ``STEP``-th id (uint64) and the
  bits, each row from a byte boundary on.

A block closes at ``BLOCK_TOKENS`` ids, so tasks hold one block, or one longer
row.  Decoding looks ``MAX_BITS`` bits up in a table, from all checkpoints of a
block side by side.  Only the counts of distinct ids (bounded by the vocabulary)
and one number a file come to the driver.

Rows of one key lie in the order of their number of ids, checksum and place in
the input, and range partitioning may cut between them, so a key with most of
the rows is spread as well.

Defined results: a null text is written as an empty one (the end id alone);
repeated rows are written each; a null key comes first; no rows give no rows;
very long texts are one row of a block of their own; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.llm import common
from streamtab.llm.unit_cache import UnitCache

END_ID = 2
MAX_BITS = 18
#: Ids after which a block closes, and between two checkpoints.
BLOCK_TOKENS, STEP = 1 << 19, 256
#: Ids that are written at a time.
PART_TOKENS = 1 << 16
#: Distinct units whose ids a Python worker caches before it starts again.
CACHE_UNITS = 1_000_000

#: Runs of white space in which the pretokeniser does not cut at every character.
_RUNS = (b"  ", b" \n", b"\n ", b"\n\n\n", b"\t", b"\r", b"\x0b", b"\x0c")
_WIDE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_WIDE_E280 = re.compile(rb"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]")


def _units(body: bytes) -> list[bytes] | None:
    """The units of a text (see ``UnitIds``); None where white space runs."""
    if body[0] == 32 or body[-1] in b" \n" or any(r in body for r in _RUNS):
        return None
    if not body.isascii() and (any(r in body for r in _WIDE) or b"\xe2\x80" in body and _WIDE_E280.search(body)):
        return None
    units = body.replace(b"\n", b" \n").split(b" ")
    units[0] = b"\r" + units[0]
    return units


class UnitIds(UnitCache):
    """Ids of texts under a byte-level tokenizer, by cached units.

    Its pretokeniser always cuts before a single space and around a single line
    end between other characters, so the ids of a text without runs of white space
    are those of its units one after the other: the first word, then words with
    the space or line end before them.  A unit is written without its space, with
    its line end, and the first one with a carriage return, which no such text
    holds.  All other texts are encoded whole."""

    def __init__(self, path: str, cache_units: int = CACHE_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit
        self.tok, self.letters = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.tok.encode_special_tokens = self.letters.encode_special_tokens = True     # ordinary text
        self.letters.pre_tokenizer = CharDelimiterSplit(" ")        # for a space (as its symbol Ġ) with ASCII letters, and signs
        vocabulary = self.tok.get_vocab()
        super().__init__("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4", cache_units)
        self.opens, self.breaks = (np.zeros(max(vocabulary.values()) + 1, bool) for _ in range(2))
        self.opens[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.breaks[vocabulary["Ċ"]] = True

    def learn(self, units: list[bytes], first: int) -> None:
        kinds: list[list[int]] = [[], [], [], []]
        texts: list[list[bytes]] = [[], [], [], []]
        for i, u in enumerate(units):
            if u.isalpha():
                kind = 0
            elif u[-1] in b".,;:!?" and u[:-1].isalpha():           # one sign is a pretoken of its own
                kind, u = 0, u[:-1] + b" " + u[-1:]
            else:
                kind, u = (2, u[1:]) if u[0] == 13 else (3, u[1:]) if u[0] == 10 else (1, u)
            kinds[kind].append(i)
            texts[kind].append(u)
        for kind, which in enumerate(kinds):
            for lo in range(0, len(which), 2_000):
                part, text = which[lo:lo + 2_000], texts[kind][lo:lo + 2_000]
                # joined by what the units begin with; each one's ids begin with that of the sign before it
                if kind == 0:
                    ids = self.ids(self.letters, (b"\xc4\xa0" + b" \xc4\xa0".join(text)).decode())
                else:
                    sep = b" " if kind == 1 else b"\n"
                    ids = self.ids(self.tok, (sep + sep.join(text)).decode())
                at = np.flatnonzero((self.opens if kind < 2 else self.breaks)[ids])
                size = np.diff(np.append(at, len(ids)))
                if kind == 2:
                    at, size = at + 1, size - 1
                self.put(np.array(part) + first, ids, at, size)

    def split(self, body: bytes) -> list[bytes] | bytes:
        units = _units(body)
        return self.ids(self.tok, body.decode()).tobytes() if units is None else units


_UNITS: dict[str, UnitIds] = {}


def unit_ids(path: str) -> UnitIds:
    """The cache of this Python worker, kept from task to task."""
    if path not in _UNITS:
        _UNITS[path] = UnitIds(path)
    return _UNITS[path]


# ---- the code --------------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Code lengths of a best prefix code with no length above ``limit``, by
    package-merge; 0 where the count is 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need more than {limit} bits")
    if len(used) < 2:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    weights, levels = counts[order].astype(np.float64), []
    level = weights
    for _ in range(limit - 1):
        packages = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, packages])
        at = np.argsort(both, kind="stable")
        levels.append(at < len(weights))
        level = both[at]
    bits, take = np.zeros(len(order), np.int64), 2 * len(order) - 2
    for is_symbol in reversed(levels):                   # chosen symbols are always the lightest ones
        n = int(is_symbol[:take].sum())
        bits[:n] += 1
        take = 2 * (take - n)
    bits[:take] += 1
    out[order] = bits
    return out


class Code:
    """Canonical code of given lengths: codes for writing, a table for reading."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int32)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        self.bits = max(int(lengths.max(initial=0)), 1)
        spans = np.left_shift(1, self.bits - self.lengths[order])
        first = np.concatenate([[0], np.cumsum(spans)])[:-1]
        self.codes = np.zeros(len(lengths), np.uint64)            # at the top of 64 bits
        self.codes[order] = first.astype(np.uint64) << np.uint64(64 - self.bits)
        self.table = np.ones(1 << self.bits, np.uint64)           # id * 32 + code length, by the next bits
        self.table[:spans.sum()] = np.repeat(order * 32 + self.lengths[order], spans)

    def encode(self, rows: list[np.ndarray]) -> bytes:
        """Payload of one block, written in parts that stay in the processor's cache."""
        parts, held, size, at = [], [], 0, 0
        for r in rows:
            held.append(r)
            size += len(r)
            if size >= PART_TOKENS:
                parts.append(self._part(held, at))
                held, size, at = [], 0, at + len(parts[-1][3])
        if held:
            parts.append(self._part(held, at))
        sizes, row_at, marks = (np.concatenate(c) for c in list(zip(*parts))[:3])
        return b"".join((np.array([len(sizes), len(marks)], "<u4").tobytes(), sizes.astype("<u4").tobytes(),
                         row_at.astype("<u8").tobytes(), marks.astype("<u8").tobytes(), *[p[3] for p in parts]))

    def _part(self, rows: list[np.ndarray], base: int):
        """Sizes of rows, the byte each begins at (from ``base`` on), checkpoints and bits."""
        sizes = np.array([len(r) for r in rows], np.int64)
        ids = np.concatenate(rows)
        # bit places within a part, or one longer row, in 32 bits where they fit
        before = np.cumsum(self.lengths[ids], dtype=np.int32 if len(ids) * self.bits < 1 << 30 else np.int64)
        ends = np.concatenate([[0], before[np.cumsum(sizes) - 1]])
        row_at = np.concatenate([[0], np.cumsum((np.diff(ends) + 7) >> 3)])
        row_bit = row_at[:-1] * 8
        at = np.empty_like(before)
        at[0], at[1:] = 0, before[:-1]
        at += np.repeat((row_bit - ends[:-1]).astype(at.dtype), sizes)
        word = at >> 5
        value = self.codes[ids] >> (at & 31).astype(np.uint64)    # the bits of a 32-bit word and of the next
        start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        value, word = np.bitwise_or.reduceat(value, start), word[start]
        words = np.zeros((int(row_at[-1]) >> 2) + 2, np.uint64)
        words[word] = value >> np.uint64(32)
        words[word + 1] |= value & np.uint64(0xFFFFFFFF)
        row, nth = _lanes(sizes)
        marks = at[(np.cumsum(sizes) - sizes)[row] + nth * STEP] - row_bit[row]
        return sizes, row_at[:-1] + base, marks, words.astype(">u4").tobytes()[:int(row_at[-1])]

    def decode(self, payload: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a block, one after the other, and the number of each row."""
        n, n_marks = np.frombuffer(payload, "<u4", 2).tolist()
        sizes = np.frombuffer(payload, "<u4", n, 8).astype(np.int64)
        row_at = np.frombuffer(payload, "<u8", n, 8 + 4 * n)
        marks = np.frombuffer(payload, "<u8", n_marks, 8 + 12 * n)
        stream = payload[8 + 12 * n + 8 * n_marks:]
        words = np.frombuffer(stream + bytes(12 - len(stream) % 4), ">u4").astype(np.uint64)
        windows = (words[:-1] << np.uint64(32)) | words[1:]
        row, nth = _lanes(sizes)
        left = np.minimum(sizes[row] - nth * STEP, STEP)
        order = np.argsort(-left, kind="stable")
        at = (marks + row_at[row] * np.uint64(8))[order]
        active = np.searchsorted(-left[order], -np.arange(STEP), side="left").tolist()      # lanes with more than t ids
        out = np.empty((STEP, len(row)), np.uint32)
        five, low, down, mask = np.uint64(5), np.uint64(31), np.uint64(64 - self.bits), np.uint64((1 << self.bits) - 1)
        for t in range(int(left.max(initial=0))):
            o = at[:active[t]]
            entry = self.table[(windows[o >> five] >> (down - (o & low))) & mask]
            out[t, :active[t]] = entry >> five
            o += entry & low
        lanes = np.empty((len(row), STEP), np.uint32)
        lanes[order] = out.T
        return lanes[np.arange(STEP) < left[:, None]], sizes


def _lanes(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of every checkpoint and its number within the row."""
    n = (sizes + STEP - 1) // STEP
    return np.repeat(np.arange(len(sizes)), n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


# ---- files -----------------------------------------------------------------------

def _tokenise(docs: DataFrame, tokenizer: str, key: str, text: str, end_id: int) -> DataFrame:
    src = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("body"))
    schema = T.StructType([src.schema["key"], T.StructField("n", T.LongType()), T.StructField("crc", T.LongType()),
                           T.StructField("row", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        units = unit_ids(tokenizer)
        end = np.array([end_id], units.width).tobytes()
        size, row = len(end), TaskContext.get().partitionId() << 40
        for b in batches:
            at, cols, held = 0, [[], [], [], []], 0

            def part(upto):
                return pa.RecordBatch.from_arrays([b.column(0).slice(at, upto - at), *[
                    pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]],
                    names=schema.names)
            for i, ids in enumerate(units.encode_all(b.column(1).to_pylist())):
                ids += end
                for c, v in zip(cols, (len(ids) // size, zlib.crc32(ids), row, ids)):
                    c.append(v)
                row, held = row + 1, held + len(ids)
                if held > 16 << 20:
                    yield part(i + 1)
                    at, cols, held = i + 1, [[], [], [], []], 0
            if cols[0]:
                yield part(b.num_rows)

    return src.mapInArrow(run, schema)


def _counts(ids: DataFrame, width: str) -> np.ndarray:
    """How often every id occurs in all rows."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            got = np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), width))
            if len(got) > len(total):
                total = np.concatenate([total, np.zeros(len(got) - len(total), np.int64)])
            total[:len(got)] += got
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], names=["id", "n"])

    found = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(found.id.max()) + 1 if len(found) else 1, np.int64)
    counts[found.id] = found.n
    return counts


def _blocks(ids: DataFrame, lengths: np.ndarray, width: str, key_type: T.DataType) -> DataFrame:
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("block", T.LongType()),
                           T.StructField("before", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("keys", T.ArrayType(key_type)), T.StructField("payload", T.BinaryType())])
    order = ["key", "n", "crc", "row"]
    src = ids.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "ids")

    def run(batches):
        code, part = Code(lengths), TaskContext.get().partitionId()
        block = before = 0

        def flush(keys, rows):
            n = sum(map(len, rows))
            keys = pa.concat_arrays(keys)
            return n, pa.RecordBatch.from_arrays(
                [pa.array([x], pa.int64()) for x in (part, block, before, n)]
                + [pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                   pa.array([code.encode(rows)], pa.binary())], names=schema.names)

        keys, rows, held = [], [], 0
        for b in batches:
            from_row = 0
            for i, raw in enumerate(b.column(1)):
                rows.append(np.frombuffer(raw.as_py(), width))
                held += len(rows[-1])
                if held >= BLOCK_TOKENS:
                    n, out = flush([*keys, b.column(0).slice(from_row, i + 1 - from_row)], rows)
                    yield out
                    block, before, keys, rows, held, from_row = block + 1, before + n, [], [], 0, i + 1
            if from_row < b.num_rows:
                keys.append(b.column(0).slice(from_row))
        if rows:
            yield flush(keys, rows)[1]

    return src.mapInArrow(run, schema)


def write(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text",
          end_id: int = END_ID) -> str:
    """Write the ids of every row below ``path`` (on storage that all executors share)."""
    spark = docs.sparkSession
    common.prepare(spark)
    raw, width = f"{path}/ids", unit_ids(tokenizer).width
    tokens = _tokenise(docs, tokenizer, key, text, end_id)
    tokens.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1").parquet(raw)
    ids = spark.read.schema(tokens.schema).parquet(raw)
    lengths = code_lengths(_counts(ids, width))
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/codebook")
    key_type = tokens.schema["key"].dataType
    _blocks(ids, lengths, width, key_type).write.option("compression", "none").parquet(f"{path}/blocks")
    return path


def read(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Every row of the files: key, start (ids of all rows before it), n_tokens,
    ids_crc32 (of its ids as little-endian uint32) and, with ``with_ids``, ids."""
    common.prepare(spark)
    lengths = np.frombuffer(spark.read.parquet(f"{path}/codebook").first()[0], np.uint8)
    blocks = spark.read.parquet(f"{path}/blocks")
    # one row a file: bounded by the number of partitions
    totals = blocks.groupBy(F.col("part").alias("of")).agg(F.sum("n_tokens").alias("n"))
    starts = totals.select("of", F.coalesce(F.sum("n").over(Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    placed = blocks.join(F.broadcast(starts), F.col("part") == F.col("of")).select(
        (F.col("first") + F.col("before")).alias("start"), "keys", "payload")
    schema = T.StructType([T.StructField(key, blocks.schema["keys"].dataType.elementType), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
                          + [T.StructField("ids", T.BinaryType())] * with_ids)

    def run(batches):
        code = Code(lengths)
        for b in batches:
            for r in range(b.num_rows):
                ids, sizes = code.decode(b.column(2)[r].as_py())
                ends = np.cumsum(sizes)
                raws = np.split(ids, ends[:-1])
                cols = [b.column(1)[r].values, pa.array(ends - sizes + b.column(0)[r].as_py()), pa.array(sizes),
                        pa.array([zlib.crc32(x) for x in raws], pa.int64())]
                if with_ids:
                    cols.append(pa.array([x.tobytes() for x in raws], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return placed.mapInArrow(run, schema)

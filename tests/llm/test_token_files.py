"""Token files: the code, round trips of blocks and the whole query."""

import heapq
import random
import zlib

import numpy as np
import pytest

from streamtab.llm import common, registry, token_files

from .helpers import EDGE, documents, words

PATH = registry.tokenizer_path("byte_bpe_50k.json")


def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


def best_limited(counts, limit):
    """The cheapest code of lengths up to ``limit`` that satisfies Kraft's inequality, by trying all."""
    import itertools
    used = [c for c in counts if c]
    return min(sum(c * b for c, b in zip(used, bits)) for bits in itertools.product(range(1, limit + 1), repeat=len(used))
               if sum(2.0 ** -b for b in bits) <= 1)


def test_lengths_are_best_under_the_limit():
    rng = random.Random(1)
    for n in (2, 3, 5, 6):
        counts = np.array([0] + [int(10 ** (rng.random() * 4)) for _ in range(n)])
        for limit in (3, 4):
            bits = token_files.code_lengths(counts, limit)
            assert bits[0] == 0 and bits.max() <= limit
            assert (counts * bits).sum() == best_limited(counts.tolist(), limit)
    counts = np.random.default_rng(2).integers(1, 10_000, 3_000)
    assert (counts * token_files.code_lengths(counts, 30)).sum() == huffman_cost(counts.tolist())
    tight = token_files.code_lengths(2 ** np.arange(40, dtype=np.int64), 7)
    assert tight.max() == 7 and (0.5 ** tight.astype(float)).sum() <= 1
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(9), 3)


def test_blocks_round_trip():
    rng = np.random.default_rng(4)
    p = 1.0 / np.arange(1, 50_001)
    rows = [rng.choice(50_000, n, p=p / p.sum()).astype("<u2") for n in (1, 255, 256, 257, 7_000, 2, 513, 100_000)]
    counts = np.bincount(np.concatenate(rows), minlength=50_258)
    code = token_files.Code(token_files.code_lengths(counts))
    ids, sizes = code.decode(code.encode(rows))
    assert sizes.tolist() == [len(r) for r in rows] and np.array_equal(ids, np.concatenate(rows))
    one = token_files.Code(token_files.code_lengths(np.array([0, 0, 5])))
    assert one.decode(one.encode([np.array([2, 2, 2], "<u2")]))[0].tolist() == [2, 2, 2]


ODD = ["a  b", " lead", "trail ", "tab\tx y", "x\n\ny z", "x \ny", "nbsp x y", "y  z w", "it's we'll I'M", "<|endoftext|> x <|endoftext|>",
       "​zero width", "line sep a", "“quoted” text — dash", "é combining \U0001f600 face", "\x1c ctl\x1fx y", "12345 6,789.0 a.b,c", "\x00 nul",
       "CRLF\r\nline two", "a\nb\nc d\ne", "　wide 　two", "\x85 nel a", "…dots… ...", "x\n", "\n", " ", "\xa0", "a \xa0 b"]


def test_units_equal_whole_texts():
    units = token_files.UnitIds(PATH, cache_units=50)
    rng = random.Random(8)
    texts = ODD + [" ".join(rng.choice(ODD + words(rng, 5)) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    want = [units.tok.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        got = [np.frombuffer(x, units.width).tolist() for x in units.encode_all([t.encode() for t in texts])]
        assert got == want


def expected(rows):
    units = token_files.UnitIds(PATH)
    out, start = [], 0
    coded = [(r[0], np.array(units.tok.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4")) for r in rows]
    for k, ids in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0, len(x[1]), zlib.crc32(x[1].astype("<u2").tobytes()))):
        out.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_equals_whole_encoding(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i * 7919 % 1009, " ".join(words(rng, rng.randint(0, 60))), "en", "s", 0) for i in range(300)]
    rows += [(2_000 + i, t, None, None, None) for i, t in enumerate(ODD)] + [(5_000, "very long " * 200_000, "en", "s", 1)] + EDGE
    documents(spark, rows).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.op13_token_files(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected(rows)


def test_hot_key_many_blocks_and_ids(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 300)
    rng = random.Random(2)
    rows = [(5, "the same copy of a text", "en", "s", 0)] * 400 + [(i, " ".join(words(rng, 40)), "en", "s", 0) for i in range(200)]
    path = token_files.write(documents(spark, rows).repartition(6), common.scratch_path(spark, "t"), PATH)
    assert spark.read.parquet(f"{path}/blocks").count() > 40
    got = token_files.read(spark, path, with_ids=True).collect()
    assert sorted(((r[0], r[1], r[2], r[3]) for r in got), key=lambda r: r[1]) == expected(rows)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in got)


def test_empty_table(spark):
    path = token_files.write(documents(spark, []), common.scratch_path(spark, "t"), PATH)
    assert token_files.read(spark, path).count() == 0

"""Packing against the tokenizer applied text by text, and the rules of a packing."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamtab.llm import packing
from tests.llm.helpers import EDGE, SCHEMA, documents, with_clashes

P = pytest.importorskip("public_tokenizers")


def whole_ids(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    return t.encode(text or "", add_special_tokens=False).ids + [1]


def check_packing(rows, capacity):
    seqs = {}
    for r in rows:
        assert 0 <= r.offset and r.offset + r.length <= capacity
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
    return len(seqs)


def test_word_cache_equals_whole_text_encoding():
    texts = ["It's  they'll WE'VE don't", "A\u0301 e\u0301te\u0301 \u00c9T\u00c9 \u0130stanbul \u03a3\u03a3", "x\u00a0y\u2003z 12,345.67 a1b2", "don 't I 'm",
             "\u4f60\u597d \u4e16\u754c \U0001f600\U0001f600 ok\u0000zero", "", " \n\t", "Word, word. WORD., a,. (x). 3. 4, \u00e9. \u00c9, n\u0303., it's. l'll,", "\u0915\u094d\u0937 \u0301alone tail\u200bword"]
    w = packing.WordIds(P.path("word_bpe_49k.json"))
    for t in texts:
        assert np.frombuffer(w.encode(t.encode()), "<u4").tolist() + [1] == whole_ids(t), t
    small = packing.WordIds(P.path("word_bpe_49k.json"), cache_words=2)
    for t in texts:
        assert small.encode(t.encode()) == w.encode(t.encode())


def test_pieces_and_packing(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma's", "\u00e9t\u00e9"]) for _ in range(rng.randint(0, 120)))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack(packing.tokenize(df, P.path("word_bpe_49k.json"), capacity=64), capacity=64, open_bins=16).collect()
    check_packing(got, 64)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i, text in rows:
        want = whole_ids(text)
        parts = sorted(by[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(-(-len(want) // 64)))
        assert [r.start for r in parts] == [64 * k for k in range(len(parts))]
        assert np.frombuffer(b"".join(bytes(r.ids) for r in parts), "<u4").tolist() == want
        assert [r.ids_crc32 for r in parts] == [zlib.crc32(np.array(want[r.start:r.start + r.length], "<u4").tobytes()) for r in parts]


def test_open_bins_follow_best_fit_and_close_the_fullest():
    rng = random.Random(4)
    for limit in (1, 3, 50):
        bins, free, n = packing.OpenBins(20, limit), [], 0
        for _ in range(600):
            need = rng.randint(1, 20)
            fit = [f for f in free if f >= need]
            b, off = bins.put(need)
            if fit:
                f = min(fit)
                assert off == 20 - f and b < n
                free.remove(f)
            else:
                f = 20
                assert (b, off) == (n, 0)
                n += 1
            if f > need:
                free.append(f - need)
                if len(free) > limit:
                    free.remove(min(free))
            assert sorted(free) == sorted(k for k, v in bins.at.items() for _ in v)
            assert bins.free == sum(1 << k for k in bins.at)


def test_edges_and_close_to_the_least(spark):
    df = with_clashes(documents(spark, EDGE), "piece", "length", "offset", "ids")
    got = packing.pack(packing.tokenize(df, P.path("word_bpe_49k.json"))).collect()
    assert len(got) == len(EDGE) and check_packing(got, 4096) == 1
    assert sorted(r.length for r in got if r.doc_id in (9001, 9002, 9003)) == [1, 1, 1]
    empty = packing.pack(packing.tokenize(spark.createDataFrame([], SCHEMA), P.path("word_bpe_49k.json")))
    assert empty.collect() == []
    rng = random.Random(1)
    lens = [(i, 0, int(min(4096, rng.lognormvariate(6.5, 1.2) + 1))) for i in range(6000)]
    rows = packing.pack(spark.createDataFrame(lens, "doc_id long, piece int, length long").coalesce(1)).collect()
    assert check_packing(rows, 4096) <= 1.03 * sum(n for _, _, n in lens) / 4096
    again = packing.pack(spark.createDataFrame(lens, "doc_id long, piece int, length long").repartition(7)).agg(F.sum(F.xxhash64("doc_id", "sequence_id", "offset") % 1000)).first()
    first = packing.pack(spark.createDataFrame(lens, "doc_id long, piece int, length long").repartition(3)).agg(F.sum(F.xxhash64("doc_id", "sequence_id", "offset") % 1000)).first()
    assert again == first                                          # the dealing depends on the rows alone


def test_words_of_many_kinds_equal_whole_text_encoding():
    import random

    import numpy as np
    import public_tokenizers as P
    rng = random.Random(6)
    odd = ["\u0130stanbul", "J\u030c", "Stra\u00dfe,", "\u00c9t\u00e9.", "na\u00efve", "\u01c5ep", "\u0149a", "e\u0301a.", "\u212b", "\u03a3\u03c3\u03c2", "it's", "We'LL", "a1b2", "...",
           ".", ",", "a..", "x,.", "(y)", "\u4f60\u597d", "\U0001f600", "<|endoftext|>", "\u00aa", "\u00b5m", "I\u0307", "\u00a0", "a\u00a0b", "\x00", "\u1e9e"]
    w = packing.WordIds(P.path("word_bpe_49k.json"), cache_words=20)
    texts = [" ".join(rng.choice(odd) if rng.random() < 0.6 else "".join(rng.choice("abcXYZ\u00e9\u00dc.,") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 9)))
             for _ in range(600)]
    want = [w.tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in w.encode_all([t.encode() for t in texts])] == want

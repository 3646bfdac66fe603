"""Language ID, HTML extraction, toxicity, quality rules, LM scores and quality
neighbours: brute force where results are exact, held-out accuracy elsewhere."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from streamtab.llm import html_extract, langid, lm_score, quality, quality_rules, registry, toxicity
from tests.llm.helpers import EDGE, SCHEMA, documents, with_clashes

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_language_ngrams_and_distance():
    codes, counts = langid.ngrams("Aba, ab".encode())
    want = Counter()
    for w in (" aba ", " ab "):
        for n in range(1, 5):
            want.update(g for i in range(len(w) - n + 1) if (g := w[i:i + n]).strip() and " " not in g[1:-1] and g != " ")
    # the space between two words belongs to both
    assert sorted(counts.tolist()) == sorted(want.values())
    p = langid.Profiles({"x": [5, 6, 7], "y": [7, 9]}, 3)
    assert np.allclose(p.distances(np.array([7, 5, 8])), [(2 + 1 + 3) / 9, (0 + 3 + 3) / 9])
    langid._CHUNK, old = 7, langid._CHUNK
    try:
        a = langid.ngrams("the quick brown fox jumps".encode())
    finally:
        langid._CHUNK = old
    b = langid.ngrams("the quick brown fox jumps".encode())
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all()


def test_language_held_out_accuracy_and_edges(spark):
    got = registry.op1_language_id(spark, SF)
    j = got.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    assert j.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
    p = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = langid.identify(with_clashes(documents(spark, EDGE), "lang_pred", "distance"), p).collect()
    assert len(rows) == len(EDGE)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (9001, 9002, 9003, 9004))
    none = langid.learn(documents(spark, EDGE).where("false"))
    assert {r.lang_pred for r in langid.identify(documents(spark, EDGE), none).collect()} == {"und"}
    assert langid.identify(spark.createDataFrame([], SCHEMA), p).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu one</a></ul>
<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>First <b>par</b>agraph of the text
is <i>long</i> enough to be decided at once, &eacute;t&eacute; and all the rest.<br>next<p>Second.
<aside>Aside words</aside><form><input value="x"><p>Subscribe</p></form><div class="ad">Buy now</div>
<section class="comments"><article><p>I am a reader and this is my comment, long enough to be a block of text.</p></article></section></article>
<div id="sidebar"><p>The side of the page and of the text, which is long enough to be decided by its stop words.</p></div>
<footer>&copy; 2020</footer></body></html>"""


def test_html_main_text(spark):
    want = "Head & line First paragraph of the text is long enough to be decided at once, été and all the rest. next Second."
    assert html_extract.main_text(PAGE) == want
    plain = "<div><a href=x>Home</a> <a href=y>About</a></div><p>" + "This is the text of the page and it is for all of us. " * 6 + "</p><p>Short end.</p><div><a>More</a></div>"
    assert html_extract.main_text(plain).startswith("This is the text") and "Home" not in html_extract.main_text(plain)
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", "<script>x"), (6, "u", PAGE)], "page_id long, url string, html string")
    got = html_extract.extract(with_clashes(pages, "text", "n_chars")).orderBy("page_id").collect()
    assert [r.n_chars for r in got] == [len(want), 0, 0, 2 if got[3].text else 0, 0, len(want)] and got[5].text == want


def test_toxicity_held_out_and_misspellings(spark):
    rng = random.Random(1)
    clean = ["lorem", "ipsum", "dolor", "amet", "sit", "elit", "magna", "aliqua"]
    rows, labels = [], []
    for i in range(400):
        w = rng.choices(clean, k=rng.randint(3, 60))
        y = int(i % 5 == 0)
        if y:
            w[rng.randrange(len(w))] = rng.choice(["wretchful", "vilenessy"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, y))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    m = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    test = spark.createDataFrame([(1, "lorem ipsum wretchfull dolor"), (2, "lorem ipsum dolor"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(with_clashes(test, "score"), m).collect()}
    assert got[1].predicted == 1 and got[2].predicted == 0 and got[3].score == got[4].score
    assert toxicity.score(test.where("false"), m).collect() == []
    one_kind = toxicity.learn(docs, spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"))
    assert toxicity.score(test, one_kind).where("predicted = 1").count() == 0


def brute_base(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for k in range(len(w) - 7):
        at[tuple(w[k:k + 8])].append(k)
    rep = {p for v in at.values() if len(v) > 1 for k in v for p in range(k, k + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep)


def test_quality_rules_base_equals_brute_force(spark):
    rng = random.Random(6)
    rows = [(r[0], r[1]) for r in EDGE]
    for i in range(120):
        w = rng.choices(["a", "b#", "café", "the", "X|", " z"], k=rng.randint(0, 60))
        rows.append((i, "".join(x + rng.choice([" ", "\n", "\t", "  "]) for x in w) + " ".join(w[:20])))
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    have = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert have == Counter((i, *brute_base(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed)
    assert quality_rules.judge(spark.createDataFrame([], SCHEMA)).collect() == []


def test_em_learns_from_votes():
    share, tables = quality_rules.em([((1, 1, 1), 800), ((-1, -1, 1), 150), ((1, -1, 0), 20), ((0, 0, 0), 30)])
    assert 0.7 < share < 0.95 and tables[0][-1][1] > tables[0][-1][0]
    assert quality_rules.log_odds((-1, -1, 1), share, tables) < 0 < quality_rules.log_odds((1, 1, 1), share, tables)


def test_lm_base_equals_brute_force_and_model_is_a_distribution(spark):
    path = registry.tokenizer_path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).union(
        documents(spark, EDGE).select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = F.coalesce(F.col("doc_id") % 7 == 2, F.lit(False))
    toks = [[*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")), None] for _, t in rows]
    c = Counter(w for (i, t), ws in zip(rows, toks) if not (i is not None and i % 7 == 2) for w in ws)
    n, v = sum(c.values()), len(c)
    want = Counter((i, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for (i, _), ws in zip(rows, toks))
    for head in (lm_score.HEAD_WORDS, 40):
        got = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string"), path, held, head_words=head).collect()
        assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    sub = lm_score.Subwords(path)
    texts = [lm_score.words_of((t or "").encode()) for _, t in rows]
    sub.learn({w for t in texts for w in t})
    seqs = [sub.ids(t) for t in texts]
    m = lm_score.Model(seqs, np.bincount(np.concatenate(seqs).astype(np.int64), minlength=lm_score.VOCAB))
    start = np.array([seqs[0][0], seqs[0][1]], np.uint32)
    nxt = [m.score([np.array([*start, i], np.uint32) for i in range(lo, min(lo + 5000, lm_score.VOCAB))]) for lo in range(0, lm_score.VOCAB, 5000)]
    assert abs((10 ** (np.concatenate(nxt) - m.score([start])[0])).sum() - 1) < 1e-2
    one = m.score([seqs[5]])[0]                                   # windows and batches do not change a score
    assert abs(one - m.score(seqs, block=3)[5]) < 1e-3
    assert xxhash.xxh64_intdigest(b"word", 42) % 2**64 == spark.range(1).select(F.xxhash64(F.lit(b"word"))).first()[0] % 2**64


def test_quality_neighbours_equal_exact_cosine(spark):
    got = registry.op9_quality_neighbours(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] > 0.85
    m = quality.fit([b"plain words here", b"Junk### junk### junk###", b"more plain words"], np.array([1, 0, 1]), 0.66)
    rows = [quality.hashed(quality.terms(x, quality.Forms())) for x in (b"other plain words", b"", b"Bad### worse###")]
    s = m.score(rows)
    q = m.project(rows)
    sim = np.maximum(q @ m.vectors.T, 0) ** 4
    assert np.allclose(s[[0, 2]], ((sim * m.labels).sum(axis=1) / sim.sum(axis=1))[[0, 2]]) and s[1] == 0.66
    assert quality.score(documents(spark, EDGE), m).count() == len(EDGE)


def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    pytest.importorskip("public_tokenizers")
    d = "/root/testdata/sf0.001"
    docs = with_clashes(spark.read.parquet(f"{d}/documents.parquet"), "row", "score", "predicted")
    for name, stage in cp.STAGES[:-1]:
        kept = stage(spark, docs, d)
        assert kept.columns == docs.columns, name
        n = kept.count()
        assert 0 < n <= docs.count() and kept.exceptAll(docs).isEmpty(), name
    assert cp.run(spark, d).select("sequence_id").distinct().count() > 0
    assert cp.packed(spark, docs.where("false"), d).collect() == []

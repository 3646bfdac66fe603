"""Wu-Manber search against a plain search of every window."""

import random
import re

from streamtab.llm import decontaminate as dc
from tests.llm.helpers import EDGE, SCHEMA, documents, with_clashes, words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, width):
    out = []
    for _, t in docs:
        w, hit, found = plain_words(t), set(), set()
        for iid, it in items:
            b = plain_words(it)
            for s in range(max(1, len(b) - width + 1)) if b else ():
                win = b[s:s + width]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit.update(range(p, p + len(win)))
                        if iid is not None:
                            found.add(str(iid))
        out.append((len(w), len(hit), sorted(found)))
    return out


def data(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(words(rng, rng.randint(1, 25), ("a", "b", "cd")))) for i in range(25)] + [(77, None), (78, "?!"), (None, "alpha beta alpha")]
    docs = []
    for i in range(60):
        w = words(rng, rng.randint(0, 60), ("a", "b", "cd"))
        if i % 2:
            b = (rng.choice(items[:25])[1]).split()
            s = rng.randrange(len(b))
            w[len(w) // 2:len(w) // 2] = b[s:s + 14]
        docs.append((i, " ".join(x.upper() if rng.random() < .1 else x for x in w)))
    return docs + [(900, None), (901, ""), (902, "alpha beta ALPHA beta-alpha")], items


def test_search_equals_brute_force_also_in_blocks(spark):
    for seed, width, block in ((1, 10, 10**6), (2, 3, 10**6), (3, 4, 40), (4, 10, 25)):
        docs, items = data(seed)
        d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        b = spark.createDataFrame(items, "item_id long, text string")
        got = dc.search(d, b, width=width, block_windows=block).orderBy("doc_id").collect()
        assert [(r.n_words, r.n_hit, r.items) for r in got] == brute(sorted(docs), items, width), (seed, width, block)
        for r in got:
            assert sum(b - a for a, b in zip(r.hit_spans[::2], r.hit_spans[1::2])) == r.n_hit


def test_edges(spark):
    b = spark.createDataFrame([(1, "repeated row of words")], "item_id long, text string")
    df = with_clashes(documents(spark, EDGE), "n_hit", "items", "item")
    got = dc.digest(dc.search(df, b)).collect()
    assert len(got) == len(EDGE) and [r.n_hit for r in got if r.doc_id == 9006] == [4, 4]
    assert all(r.n_words == 0 for r in got if r.doc_id in (9001, 9002, 9003, 9004))
    assert dc.search(spark.createDataFrame([], SCHEMA), b).collect() == []
    none = dc.digest(dc.search(df, b.where("false"))).collect()
    assert not any(r.contaminated for r in none) and {r.items_sha256[:8] for r in none} == {"e3b0c442"}
    long = documents(spark, [(1, "filler " * 200_000 + "repeated row of words", "en", "s", 1)])
    assert dc.search(long, b).first().n_hit == 4

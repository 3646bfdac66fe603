"""The language model's counts cover every training text, not only the sample of the gradient steps."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from streamtab.llm import lm_score, registry


def test_counts_cover_texts_outside_the_sample(spark):
    path = registry.tokenizer_path("byte_bpe_50k.tiktoken")
    phrase = "the quick brown fox jumps over a lazy dog"
    back = " ".join(reversed(phrase.split()))
    rows = [(i, phrase if i % 4 else f"other words of text {i} and more of them") for i in range(400)] + [(-1, phrase), (-2, back), (500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_score.score(docs, path, F.col("doc_id") < 0, limit=0).collect()}
    assert got[-1] > got[-2] + 3


def test_pair_counts_equal_brute_force(spark):
    path = registry.tokenizer_path("byte_bpe_50k.tiktoken")
    texts = ["one two three", "", None, "two three one two", "Three  one\n"] * 30
    train = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    words, ids = lm_score.read_train(train, "text", path)
    assert {bytes(r.word): r.c for r in words.collect()} == Counter(w for t in texts for w in lm_score.words_of((t or "").encode()))
    sub = lm_score.subwords(path)
    lists = [lm_score.words_of((t or "").encode()) for t in texts]
    sub.learn(set().union(*lists))
    seqs = [sub.ids(ws) for ws in lists]
    counts = np.bincount(np.concatenate(seqs).astype(np.int64), minlength=lm_score.VOCAB)
    order = lm_score._ranks(counts)
    n = lm_score.VOCAB
    want = Counter((int(a), int(b)) for s in seqs for a, b in zip([lm_score.END, *s[:-1]], s))
    rank = {int(v): i for i, v in enumerate(order)}
    size, cells = lm_score.neighbour_cells(order)
    got, near = lm_score.count_pairs(ids, size, cells), np.zeros(size)
    for (a, b), m in want.items():
        near[rank[b] * 2 * lm_score.TOP_IDS + rank[a]] += m
        near[rank[a] * 2 * lm_score.TOP_IDS + lm_score.TOP_IDS + rank[b]] += m
    assert (got == near).all()
    classes = np.zeros(n, np.int64)
    classes[order] = np.arange(len(order))
    symbol = lm_score.OWN_IDS + classes
    size, cells = lm_score.pair_cells(classes, symbol)
    both, table = lm_score.count_pairs(ids, size, cells), np.zeros(size)
    for (a, b), m in want.items():
        table[classes[a] * n + b] += m
        table[lm_score.CLASSES * n + symbol[a] * lm_score.CLASSES + classes[b]] += m
    assert (both == table).all()


def test_class_counts_are_those_of_the_whole_model():
    assert (lm_score.CLASSES, lm_score.SHARED_CLASSES) == (128, 64)


def test_gradient_steps_read_every_training_text(spark):
    path = registry.tokenizer_path("byte_bpe_50k.tiktoken")
    texts = [f"text {i} of many " + "with some more words " * (i % 30) for i in range(2_100)]
    train = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    _, ids = lm_score.read_train(train, "text", path)
    sub = lm_score.subwords(path)
    lists = [lm_score.words_of(t.encode()) for t in texts]
    sub.learn(set().union(*lists))
    seqs = [sub.ids(ws) for ws in lists]
    counts = np.bincount(np.concatenate(seqs).astype(np.int64), minlength=lm_score.VOCAB)
    model = lm_score.Model([], counts, lambda size, cells: lm_score.count_pairs(ids, size, cells))
    before = model.score(seqs).sum()
    windows = sum(-(-len(x) // lm_score.STRIDE) for x in seqs)
    assert lm_score.train_all(model, ids, int(counts.sum()), 4) == windows
    assert model.score(seqs).sum() > before                   # few texts, gone over again
    # many texts: shares of rounds, each window once
    assert lm_score.train_all(model, ids, lm_score.LEAST_WINDOWS * lm_score.STRIDE, 4) == windows
    assert np.isfinite(model.score(seqs)).all()


def test_texts_are_read_once_and_counts_leave_out_held_texts(spark, monkeypatch):
    path = registry.tokenizer_path("byte_bpe_50k.tiktoken")
    rows = [(i, ["One two three", None, "", "two three two 50%\x1c off"][i % 4], [False, True, None][i % 3]) for i in range(48)]
    src = spark.createDataFrame(rows, "key long, text string, held_out boolean").repartition(3)
    words, texts = lm_score.read(src.withColumn("body", F.col("text").cast("binary")), path)
    want = Counter(w for _, t, h in rows if h is False for w in lm_score.words_of((t or "").encode()))
    assert {bytes(r.word): r.c for r in words.collect()} == want
    sub = lm_score.Subwords(path)
    lists = {i: lm_score.words_of((t or "").encode()) for i, t, _ in rows}
    sub.learn(set().union(*lists.values()))
    assert {r.key: np.frombuffer(r.ids, "<u2").tolist() for r in texts.collect()} == {i: sub.ids(ws).tolist() for i, ws in lists.items()}
    # a task that holds few words passes them on in parts, with the same sums
    monkeypatch.setattr(lm_score, "COUNT_WORDS", 2)
    few = lm_score._Words(path)
    got = Counter()
    for ws in lists.values():
        assert np.frombuffer(few.read([ws], np.ones(1, bool))[0], "<u2").tolist() == sub.ids(ws).tolist()
        if len(few.numbers) > lm_score.COUNT_WORDS:
            got.update(dict(zip(*(x if isinstance(x, list) else x.tolist() for x in few.counted()))))
            few._start()
    got.update(dict(zip(*(x if isinstance(x, list) else x.tolist() for x in few.counted()))))
    assert got == Counter(w for ws in lists.values() for w in ws)


def test_step_follows_the_numeric_gradient():
    rng = np.random.default_rng(3)
    net = lm_score.Attention(40, lm_score.CLASSES)
    net.direct[:] = rng.standard_normal(net.direct.shape) * 0.3
    win, before = rng.integers(0, 40, (70, lm_score.STRIDE)), rng.integers(0, 41, (70, lm_score.CONTEXT))
    target = rng.integers(-1, lm_score.CLASSES, win.shape)
    adam = lm_score.Adam(net)
    moved = {}
    adam._move = lambda rate: moved.update({n: adam.g[n].copy() for n in net.names()})
    adam.step(win, before, target, 1.0)

    def loss():
        return -net.log_probs(win, before, target)[target >= 0].mean(dtype=np.float64)

    for name in net.names():
        x, g = getattr(net, name), moved[name]
        at = np.unravel_index(np.argmax(abs(g)), g.shape)
        old = float(x[at])
        x[at] = old + 0.02
        up = loss()
        x[at] = old - 0.02
        assert abs((up - loss()) / 0.04 - g[at]) < 0.05 * abs(g[at]) + 1e-6, name
        x[at] = old

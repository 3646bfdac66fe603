"""The quality vectors hold the words: texts of one shape differ by their vocabulary."""

import random

import numpy as np

from streamtab.llm import quality

GOOD = ["water", "light", "stone", "green", "river", "cloud", "plant", "earth"]
BAD = ["cheap", "viagr", "casin", "poker", "lotto", "loans", "bonus", "click"]


def rows(words, seed, n=60):
    rng = random.Random(seed)
    return [" ".join(rng.choices(words, k=40)).encode() for _ in range(n)]


def test_texts_of_one_shape_are_told_apart():
    m = quality.fit(rows(GOOD, 1) + rows(BAD, 2), np.array([1] * 60 + [0] * 60), 0.5)
    f = quality.Forms()
    s = m.score([quality.hashed(quality.terms(b, f)) for b in rows(GOOD, 3, 10) + rows(BAD, 4, 10)])
    assert s[:10].min() > 0.9 and s[10:].max() < 0.1


def test_the_ends_of_long_words_are_read():
    f = quality.Forms()
    a, b = (quality.hashed(quality.terms(b"x" * 80 + end, f)) for end in (b"first", b"other"))
    assert a[0].tolist() != b[0].tolist()
    assert f[b"-a" * 10][0] != f[b"-a" * 10 + b"#"][0]


def test_forms_and_terms_equal_their_definition_and_outlive_a_task():
    f = quality.Forms()
    for w in (b"a", b"ab", b"abab", b"word", b"Word", b"w0rd", "größe".encode(), "ÉTÉ".encode(), b"x" * 17, b"!!!", b"\xff\xfe", b""):
        s = w.decode("utf-8", "replace")
        padded = b" " + s.lower().encode() + b" "
        pieces = {padded, *(padded[i:i + quality.PIECE] for i in range(len(padded) - quality.PIECE + 1))}
        form = quality._UP.sub("A", quality._LOW.sub("a", quality._NUM.sub("0", s))) + ("+" if len(s) > 16 else "")
        at = sorted(quality.SHAPES + quality.xxhash.xxh32_intdigest(x, 1) % quality.WORDS for x in pieces)
        assert f[w][0] == form and sorted(np.frombuffer(f[w][1], np.int32).tolist()) == at
    assert quality.worker_forms() is quality.worker_forms()


def test_words_learned_together_equal_words_learned_alone():
    words = {b"a", b"ab", b"abab", b"aaaaaaa", b"Word", b"w0rd!", "größe".encode(), "ÉTÉ".encode(), "İ".encode(), b"x" * 17, b"x" * 64,
             b"y" * 65, b"\xff\xfe", b"", *(f"w{i}".encode() * (i % 5 + 1) for i in range(50))}
    alone, together, again = quality.Forms(), quality.Forms(), quality.Forms()
    together.learn(words)
    again.learn(set())
    assert len(again) == 0 and set(together) == {w for w in words if len(w) <= quality.KEEP}
    for w, (form, at) in together.items():
        assert alone[w][0] == form and sorted(np.frombuffer(alone[w][1], np.int32)) == sorted(np.frombuffer(at, np.int32))
    bodies = [b"some words and\nsome words", None, b"", b"y" * 65 + b" a"]
    got = quality.hashed_rows(bodies, together)
    for (a, n), b in zip(got, bodies):
        want = quality.hashed(quality.terms(b, quality.Forms()))
        assert (a == want[0]).all() and (n == want[1]).all()

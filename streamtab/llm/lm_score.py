"""Language-model scores: a causal self-attention model on subword ids.

Words (white-space separated, A-Z lower-cased) become ids of a public byte-level
tokenizer.  One self-attention layer reads the ids before a token and predicts
the class of the next id; an id's share of its class comes from counts.  All
counts cover every training document: ids, their neighbours (which make the
classes), ids after each class, and the classes after each symbol from which the
training starts.  The gradient steps go over every training document as well: tasks
step over their own documents, in numpy, and their parameters are averaged between
rounds.  A text is scored in overlapping context windows: each window
scores STRIDE new tokens, all windows of a batch at once, with the CONTEXT
tokens before them as keys, so that every token is scored once.

The base score is an add-one word unigram.  Counts of the most frequent words
(a bounded table) are broadcast, all other words are looked up by a join.

Defined results: a null text is scored as an empty one (the end token alone);
an empty training set gives uniform probabilities; repeated rows are scored
each.  Words outside the broadcast table are matched by a 64-bit hash.
"""

from __future__ import annotations

import base64
import copy
import math
from collections import Counter
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.llm import common
from streamtab.llm.unit_cache import UnitCache

VOCAB, END = 50_257, 50_256
#: Tokens scored per window and tokens of context before them.
STRIDE, CONTEXT = 32, 16
#: Width of the attention, classes predicted, ids with vectors of their own.
DIM, CLASSES, OWN_IDS = 16, 128, 3_000
#: Of the classes, those that infrequent ids share.
SHARED_CLASSES = 64
#: Most frequent ids whose counts before and after an id place it in a class.
TOP_IDS = 256
#: Training steps over texts at hand, windows of a step, there and over all training texts.
STEPS, BATCH, LARGE_BATCH = 500, 64, 512
#: Rounds of the training over all texts, each over its own share of them.
ROUNDS = 4
#: Windows that the training reads at least (fewer texts are gone over again), windows a task holds.
LEAST_WINDOWS, HELD_WINDOWS = 32_000, 4_096
#: Windows, tokens and parameters of a step that are worked on at once.
PART_WINDOWS, PART_TOKENS, PART_CELLS = 32, 1_024, 1 << 15
#: Parameters passed on in one row.
BLOCK_CELLS = 1 << 13
#: Words whose counts are broadcast, at most.
HEAD_WORDS = 300_000
#: Distinct words a counting task holds before it passes them on.
COUNT_WORDS = 400_000
CACHE_WORDS = 400_000
#: Weight of an id's share in all documents against its counts after one class.
SHRINK = 20.0
#: Step size of the training.
RATE = 0.03


class Subwords:
    """Ids (little-endian uint32) of a white-space separated word, cached in two generations."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.starts = np.zeros(VOCAB, bool)                # ids that begin with a space, as every word's first one
        self.starts[[i for t, i in ranks.items() if t[:1] == b" "]] = True
        self.cache: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        if len(self.cache) > CACHE_WORDS:
            self.old, self.cache = self.cache, {}
        new = []
        for w in words:
            if w in self.cache:
                continue
            if (got := self.old.get(w)) is not None:
                self.cache[w] = got
            else:
                new.append(w)
        texts = [w.decode("utf-8", "replace") for w in new]
        plain = list(zip(new, texts))
        if " ".join(texts).split() != texts:               # other white space inside: encoded alone
            plain = []
            for w, text in zip(new, texts):
                if text.split() == [text]:
                    plain.append((w, text))
                else:
                    self.cache[w] = np.array(self.enc.encode_ordinary(" " + text), "<u4").tobytes()
        for i in range(0, len(plain), 2_000):
            part = plain[i:i + 2_000]
            ids = np.array(self.enc.encode_ordinary(" " + " ".join(t for _, t in part)), "<u4")
            cut, raw = (np.flatnonzero(self.starts[ids]) * 4).tolist(), ids.tobytes()
            self.cache.update(zip((w for w, _ in part), (raw[a:b] for a, b in zip(cut, [*cut[1:], len(raw)]))))

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Ids of known words, then the end token."""
        return np.frombuffer(b"".join(map(self.cache.__getitem__, words)) + END.to_bytes(4, "little"), "<u4")


_SUBWORDS: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    if path not in _SUBWORDS:
        _SUBWORDS[path] = Subwords(path)
    return _SUBWORDS[path]


def words_of(body: bytes | None) -> list[bytes]:
    return body.lower().split() if body else []


def _ranks(counts: np.ndarray) -> np.ndarray:
    """Ids that occur, the most frequent first."""
    seen = np.flatnonzero(counts)
    return seen[np.argsort(-counts[seen], kind="stable")]


def neighbour_cells(order: np.ndarray):
    """Size of the table (id, TOP_IDS before it and TOP_IDS after it) and the function from
    predecessors, ids and how often they occur to cells of the table and their counts."""
    col, row = np.full(VOCAB, -1, np.int64), np.full(VOCAB, -1, np.int64)
    col[order[:TOP_IDS]] = np.arange(min(TOP_IDS, len(order)))
    row[order] = np.arange(len(order))
    wide = 2 * TOP_IDS

    def cells(a, b, n):
        parts, many = [], []
        for who, other, shift in ((b, a, 0), (a, b, TOP_IDS)):
            ok = np.flatnonzero((row[who] >= 0) & (col[other] >= 0))
            parts.append(row[who[ok]] * wide + col[other[ok]] + shift)
            many.append(n[ok])
        return np.concatenate(parts), np.concatenate(many)
    return len(order) * wide, cells


def pair_cells(classes: np.ndarray, symbol: np.ndarray):
    """Size of the table (class, id after it) followed by (symbol, class after it), and
    the function from predecessors, ids and how often they occur to cells of the table and their counts."""
    first = CLASSES * VOCAB

    def cells(a, b, n):
        return np.concatenate([classes[a] * VOCAB + b, first + symbol[a] * CLASSES + classes[b]]), np.concatenate([n, n])
    return first + (OWN_IDS + CLASSES) * CLASSES, cells


def tally(out: np.ndarray, cells, seq: np.ndarray) -> None:
    """Add the pairs of ids that follow each other in ``seq`` (texts with their end
    tokens, the first text's id follows an end token as well)."""
    pairs = np.empty(len(seq), np.uint32)                  # sorted, so that each pair is looked up once
    pairs[:1], pairs[1:] = END, seq[:-1]
    pairs *= np.uint32(VOCAB)
    pairs += seq
    pairs.sort()
    at = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    a, b = np.divmod(pairs[at].astype(np.int64), VOCAB)
    cell, n = cells(a, b, np.diff(np.append(at, len(pairs))).astype(out.dtype))
    np.add.at(out, cell, n)


def id_classes(order: np.ndarray, counts: np.ndarray, near: np.ndarray, n: int, shared: int) -> np.ndarray:
    """Class of every id: the most frequent ids have one each, the rest share
    ``shared`` classes by k-means over the square roots of their neighbours' shares."""
    out = np.full(VOCAB, n - 1, np.int64)
    if len(order) <= n:
        out[order] = np.arange(len(order))
        return out
    own = n - shared
    out[order[:own]] = np.arange(own)
    order = order[own:]
    x = near.reshape(-1, 2 * TOP_IDS)[own:].astype(np.float32)
    x /= np.maximum(x.sum(axis=1, keepdims=True), 1)
    np.sqrt(x, out=x)
    weight = counts[order].astype(np.float32) ** 0.5
    centre = x[:shared].copy()
    for _ in range(12):
        best = (x @ centre.T - 0.5 * (centre ** 2).sum(axis=1)).argmax(axis=1)
        total = np.bincount(best, weight, shared)
        onehot = np.zeros((len(order), shared), np.float32)
        onehot[np.arange(len(order)), best] = weight
        centre = np.where(total[:, None] > 0, (onehot.T @ x) / np.maximum(total, 1e-9)[:, None], centre).astype(np.float32)
    out[order] = own + best
    return out


def lay_out(seqs: list[np.ndarray], symbol: np.ndarray, pad: int):
    """Windows of input symbols (n, STRIDE), the CONTEXT symbols before each, targets
    (-1 in the padding) and the number of windows of each sequence."""
    many = np.array([-(-len(s) // STRIDE) for s in seqs], np.int64)
    size = int(many.sum()) * STRIDE
    inputs, targets = np.full(size, pad, np.int64), np.full(size, -1, np.int64)
    at = 0
    for s, m in zip(seqs, many):
        targets[at:at + len(s)] = s
        inputs[at] = symbol[END]
        inputs[at + 1:at + len(s)] = symbol[s[:-1]]
        at += m * STRIDE
    win = inputs.reshape(-1, STRIDE)
    before = np.full((len(win), CONTEXT), pad, np.int64)
    first = np.zeros(len(win), bool)
    first[np.concatenate([[0], np.cumsum(many)[:-1]])] = True
    later = np.flatnonzero(~first)
    before[later] = win[later - 1][:, STRIDE - CONTEXT:]
    return win, before, targets.reshape(-1, STRIDE), many


class Attention:
    """Tables of queries, keys with values, direct logits by symbol, relative position bias, output matrix."""

    def __init__(self, n_symbols: int, classes: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        shape = (n_symbols + 1, DIM)                       # the last symbol is the padding
        self.q, k, v = (rng.standard_normal(shape).astype(np.float32) * 0.3 for _ in range(3))
        self.kv = np.concatenate([k, v], axis=1)
        self.kv[-1] = 0
        self.direct = np.zeros((n_symbols + 1, classes), np.float32)
        self.out = rng.standard_normal((DIM, classes)).astype(np.float32) * 0.1
        self.bias = np.zeros(STRIDE + CONTEXT, np.float32)
        i, j = np.arange(STRIDE)[:, None], np.arange(CONTEXT + STRIDE)[None, :]
        self.back = np.maximum(CONTEXT + i - j, 0)         # how far a key lies behind its query
        self.mask = np.where(j > CONTEXT + i, -1e9, 0).astype(np.float32)

    def attend(self, win, keys):
        """Scaled queries, keys with values, weights and (by token) their sums and the weighted means of the values."""
        q, kv = self.q.take(win, axis=0), self.kv.take(keys, axis=0)
        q *= DIM ** -0.5
        e = np.matmul(q, kv[:, :, :DIM].transpose(0, 2, 1))
        e += self.bias[self.back] + self.mask
        if e.max(initial=0) > 40:
            np.minimum(e, 40, out=e)
        np.exp(e, out=e)
        total = e.reshape(-1, STRIDE + CONTEXT) @ np.ones(STRIDE + CONTEXT, np.float32)
        h = np.matmul(e, kv[:, :, DIM:]).reshape(-1, DIM)
        h /= total[:, None]
        return q, kv, e, total, h

    def logits(self, h, symbols):
        z = h @ self.out
        z += self.direct.take(symbols, axis=0)
        return z

    def log_probs(self, win, before, target) -> np.ndarray:
        """Natural log of each target class's probability (any value where target is -1)."""
        z = self.logits(self.attend(win, np.concatenate([before, win], axis=1))[-1], win.ravel())
        if z.max(initial=0) > 60:
            np.minimum(z, 60, out=z)
        classes = z.shape[1]
        picked = z.ravel()[np.arange(0, z.size, classes) + np.maximum(target, 0).ravel()]
        np.exp(z, out=z)
        return (picked - np.log(z @ np.ones(classes, np.float32))).reshape(target.shape)

    def names(self) -> tuple[str, ...]:
        return ("q", "kv", "direct", "out", "bias")

    def train(self, win, before, target, steps: int, seed: int = 9) -> None:
        rng, adam = np.random.default_rng(seed), Adam(self)
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(win), BATCH)
            adam.step(win[pick], before[pick], target[pick], 1 - 0.9 * step / steps)


def _starts(at: np.ndarray) -> np.ndarray:
    """Where the runs of equal values in the sorted ``at`` start."""
    return np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))


def _sum_rows(out: np.ndarray, at: np.ndarray, order: np.ndarray, rows: np.ndarray) -> None:
    """Set ``out`` at every index in ``at`` to the sum of its ``rows``; ``order`` sorts ``at``."""
    at = at[order]
    first = _starts(at)
    # pairs of columns are added as one complex number: half the work of reduceat
    out[at[first]] = np.add.reduceat(rows.take(order, axis=0).view(np.complex64), first, axis=0).view(np.float32)


class Adam:
    """Gradient steps on an :class:`Attention`, in place.  Parameters, gradients and moments
    lie in one array each; windows and tokens are gone through in parts that fit the caches."""

    def __init__(self, net: Attention):
        self.net, self.done = net, 0
        self.flat = np.concatenate([getattr(net, n).ravel() for n in net.names()])
        self.grad, self.m1, self.m2 = (np.zeros_like(self.flat) for _ in range(3))
        self.g, lo = {}, 0
        for n in net.names():
            old = getattr(net, n)
            setattr(net, n, self.flat[lo:lo + old.size].reshape(old.shape))
            self.g[n] = self.grad[lo:lo + old.size].reshape(old.shape)
            lo += old.size

    def step(self, w, before, t, share: float) -> None:
        """One step on the windows ``w``, at ``share`` of the full rate."""
        net, g = self.net, self.g
        self.done += 1
        self.grad[:] = 0
        small = np.int16 if len(net.q) < 1 << 15 else np.int64   # short numbers are sorted by radix
        keys = np.concatenate([before, w], axis=1)
        held = [net.attend(w[lo:lo + PART_WINDOWS], keys[lo:lo + PART_WINDOWS]) for lo in range(0, len(w), PART_WINDOWS)]
        h = np.concatenate([x[-1] for x in held])
        symbols, t = w.ravel(), t.ravel()
        by_symbol = np.argsort(symbols.astype(small), kind="stable")
        dh = self._classes(h, symbols, t, by_symbol[t[by_symbol] >= 0])
        dq, dkv = np.empty((w.size, DIM), np.float32), np.empty((*keys.shape, 2 * DIM), np.float32)
        by_bias = np.zeros(net.back.shape, np.float32)
        for lo, (q, kv, e, total, hp) in zip(range(0, len(w), PART_WINDOWS), held):
            rows = slice(lo * STRIDE, lo * STRIDE + len(total))
            d = dh[rows]
            mean = np.einsum("ij,ij->i", d, hp)            # of the weights' gradients, by the weights
            mean /= total
            d /= total[:, None]
            d = d.reshape(-1, STRIDE, DIM)
            ds = np.matmul(d, kv[:, :, DIM:].transpose(0, 2, 1))
            ds -= mean.reshape(-1, STRIDE, 1)
            ds *= e
            part = dkv[lo:lo + len(q)]
            part[:, :, :DIM] = np.matmul(ds.transpose(0, 2, 1), q)
            part[:, :, DIM:] = np.matmul(e.transpose(0, 2, 1), d)
            dq[rows] = np.matmul(ds, kv[:, :, :DIM]).reshape(-1, DIM)
            by_bias += ds.sum(axis=0)
        dq *= DIM ** -0.5
        _sum_rows(g["q"], symbols, by_symbol, dq)
        keys = keys.ravel()
        _sum_rows(g["kv"], keys, np.argsort(keys.astype(small), kind="stable"), dkv.reshape(-1, 2 * DIM))
        g["kv"][-1] = 0
        g["bias"][:] = np.bincount(net.back.ravel(), by_bias.ravel(), len(net.bias))
        self._move(RATE * min(1.0, self.done / 20) * share)

    def _classes(self, h, symbols, t, order) -> np.ndarray:
        """Gradients of ``h``; those of the output matrix and of the direct logits are added.
        The tokens ``order`` have a target; they are sorted by symbol."""
        net, g = self.net, self.g
        dh = np.zeros_like(h)
        ones = np.ones(net.out.shape[1], np.float32)
        for lo in range(0, len(order), PART_TOKENS):
            at = order[lo:lo + PART_TOKENS]
            symbol, hp = symbols[at], h[at]
            z = net.logits(hp, symbol)
            if z.max() > 60:
                z -= z.max(axis=1, keepdims=True)
            np.exp(z, out=z)
            total = np.maximum(z @ ones, 1e-30)
            z.ravel()[np.arange(0, z.size, len(ones)) + t[at]] -= total
            scale = 1 / (total * len(order))               # z * scale: the gradients of the logits
            dh[at] = (z @ net.out.T) * scale[:, None]
            g["out"] += (z.T @ (hp * scale[:, None])).T
            first = _starts(symbol)
            last = np.append(first[1:], len(symbol))
            sums = z[first] * scale[first, None]
            more = np.flatnonzero(last - first > 1)
            for i, a, b in zip(more.tolist(), first[more].tolist(), last[more].tolist()):
                np.dot(scale[a:b], z[a:b], out=sums[i])
            g["direct"][symbol[first]] += sums
        return dh

    def _move(self, rate: float) -> None:
        # moments without their factors 0.1 and 0.01, which are part of the rate and of the least divisor
        c1, c2 = 0.1 * rate / (1 - 0.9 ** self.done), 0.1 / math.sqrt(1 - 0.99 ** self.done)
        for lo in range(0, len(self.flat), PART_CELLS):
            d, a1, a2 = (x[lo:lo + PART_CELLS] for x in (self.grad, self.m1, self.m2))
            a1 *= 0.9
            a1 += d
            a2 *= 0.99
            np.multiply(d, d, out=d)
            a2 += d
            np.sqrt(a2, out=d)
            d += 1e-8 / c2
            np.divide(a1, d, out=d)
            d *= c1 / c2
            self.flat[lo:lo + PART_CELLS] -= d


class Model:
    """Attention over symbols, classes of ids, log share of every id in its class."""

    def __init__(self, seqs: list[np.ndarray], id_counts: np.ndarray, count=None):
        """``seqs`` are texts for gradient steps at once (none: see :func:`train_all`); ``count(size, cells)`` counts the
        pairs of all training texts (of ``seqs`` where it is not given)."""
        def of_seqs(size, cells):
            out = np.zeros(size, np.int32)
            for x in seqs:
                tally(out, cells, x)
            return out
        count = count or of_seqs
        order = _ranks(id_counts)
        near = count(*neighbour_cells(order)) if len(order) > CLASSES else None
        self.classes = id_classes(order, id_counts, near, CLASSES, SHARED_CLASSES)
        del near
        frequent = order[:OWN_IDS]
        self.symbol = OWN_IDS + self.classes
        self.symbol[frequent] = np.arange(len(frequent))
        n_symbols = OWN_IDS + CLASSES
        smooth = id_counts.astype(np.float64) + 1
        self.share = (np.log(smooth) - np.log(np.bincount(self.classes, smooth, CLASSES))[self.classes]).astype(np.float32)
        self.pad = n_symbols
        # the id's share of its class after each class, shrunk towards its share in all training documents
        self.seen = np.sort(order)
        self.row = np.full(VOCAB, -1, np.int64)
        self.row[self.seen] = np.arange(len(self.seen))
        both = count(*pair_cells(self.classes, self.symbol))
        pair = both[:CLASSES * VOCAB].reshape(CLASSES, VOCAB)[:, self.seen].astype(np.float32)
        follow = both[CLASSES * VOCAB:].reshape(n_symbols, CLASSES).astype(np.float64)
        del both
        mine = self.classes[self.seen]
        whole = np.zeros((CLASSES, CLASSES), np.float32)
        np.add.at(whole.T, mine, pair.T)
        self.after = np.zeros((CLASSES, len(self.seen)), np.float32)
        for c in range(CLASSES):
            self.after[c] = np.log((pair[c] + SHRINK * np.exp(self.share[self.seen])) / (whole[c, mine] + SHRINK))
        # an unseen id keeps its shrunk share of what is left
        self.rest = -np.log1p(whole / SHRINK).astype(np.float32)
        self.net = Attention(n_symbols, CLASSES)
        # start from the classes after each symbol, shrunk towards those after its class, shrunk towards all
        start = np.bincount(self.classes, id_counts + 1e-3, CLASSES) + 1e-3
        start /= start.sum()
        group = np.concatenate([self.classes[frequent], np.zeros(OWN_IDS - len(frequent), np.int64), np.arange(CLASSES)])
        by_class = whole + SHRINK * start
        by_class /= by_class.sum(axis=1, keepdims=True)
        follow += SHRINK * by_class[group]
        self.net.direct[:-1] = np.log(follow / follow.sum(axis=1, keepdims=True))
        self.net.direct[-1] = np.log(start)
        if seqs:
            win, before, target, _ = lay_out(seqs, self.symbol, self.pad)
            self.net.train(win, before, np.where(target < 0, -1, self.classes[target]), STEPS)

    def _share(self, t: np.ndarray, previous: np.ndarray) -> np.ndarray:
        """Natural log of each id's share of its class, given the class before it."""
        row = self.row[t]
        out = self.after[previous, np.maximum(row, 0)] if len(self.seen) else np.zeros(t.shape, np.float32)
        new = np.flatnonzero((row < 0).ravel() & (t >= 0).ravel())
        if len(new):
            ids = t.ravel()[new]
            out.ravel()[new] = self.share[ids] + self.rest[previous.ravel()[new], self.classes[ids]]
        return out

    def score(self, seqs: list[np.ndarray], block: int = 128) -> np.ndarray:
        """log10 probability of every id sequence."""
        win, before, target, many = lay_out(seqs, self.symbol, self.pad)
        first = np.concatenate([[0], np.cumsum(many)[:-1]])
        classes = np.where(target < 0, -1, self.classes[target])
        # the class of the id before each target
        previous = np.empty(target.shape, np.int64)
        previous[:, 1:] = self.classes[target[:, :-1]]
        previous[1:, 0] = self.classes[target[:-1, -1]]
        previous[first, 0] = self.classes[END]
        got = self._share(target, previous)
        for lo in range(0, len(win), block):
            got[lo:lo + block] += self.net.log_probs(win[lo:lo + block], before[lo:lo + block], classes[lo:lo + block])
        got[target < 0] = 0
        return np.add.reduceat(got.sum(axis=1, dtype=np.float64), first) / math.log(10)


def _parts(bodies: list[bytes | None]):
    """Ranges of rows with about a megabyte of text each."""
    lo = 0
    while lo < len(bodies):
        hi, size = lo, 0
        while hi < len(bodies) and (hi == lo or size < 1 << 20):
            size += len(bodies[hi] or b"")
            hi += 1
        yield lo, hi
        lo = hi


class _Words(UnitCache):
    """Numbers of words and their ids; the end token is the unit None."""

    def __init__(self, tokenizer: str):
        self.sub = subwords(tokenizer)
        super().__init__("<u2", COUNT_WORDS)

    def _start(self) -> None:
        super()._start()
        self.counts = np.zeros(0, np.int64)
        self.put(np.array([self.numbers[None]]), np.array([END]), np.zeros(1, np.int64), np.ones(1, np.int64))
        self.numbers.new.clear()

    def learn(self, units: list[bytes], first: int) -> None:
        self.sub.learn(set(units))
        parts = [self.sub.cache[w] for w in units]
        sizes = np.array([len(x) // 4 for x in parts], np.int64)
        self.put(np.arange(first, first + len(units)), np.frombuffer(b"".join(parts), "<u4"), np.cumsum(sizes) - sizes, sizes)

    def read(self, lists: list[list[bytes]], counted: np.ndarray) -> list[bytes]:
        """The ids of every list of words and the end token; words of the lists ``counted`` are counted."""
        n = np.array([len(ws) + 1 for ws in lists], np.int64)
        end, get = (None,), self.numbers.__getitem__
        index = np.fromiter(map(get, chain.from_iterable(chain(ws, end) for ws in lists)), np.int64, int(n.sum()))
        new, self.numbers.new = self.numbers.new, []
        self._grow(len(self.numbers), self.used)
        self.learn(new, len(self.numbers) - len(new))
        more = np.bincount(index[np.repeat(counted, n)], minlength=len(self.numbers))
        more[:len(self.counts)] += self.counts
        self.counts = more
        sizes = self.sizes[index]
        ends = np.cumsum(sizes)
        place = np.repeat(self.at[index] - ends + sizes, sizes)
        place += np.arange(len(place))
        raw, cut = self.flat[place].tobytes(), (2 * ends[np.cumsum(n) - 1]).tolist()
        return [raw[a:b] for a, b in zip([0, *cut], cut)]

    def counted(self) -> tuple[list[bytes], np.ndarray]:
        """Words counted since the start, and their counts."""
        self.counts[:1] = 0
        at = np.flatnonzero(self.counts).tolist()
        words = list(self.numbers)
        return [words[i] for i in at], self.counts[at]


def _read(tokenizer: str):
    names = ["key", "held_out", "body", "ids", "word", "n"]

    def run(batches):
        words, key = _Words(tokenizer), None

        def flush():
            found, n = words.counted()
            none = [pa.nulls(len(found), t) for t in (key, pa.bool_(), pa.binary(), pa.binary())]
            return pa.RecordBatch.from_arrays([*none, pa.array(found, pa.binary()), pa.array(n, pa.int64())], names=names)

        for b in batches:
            key = b.schema.types[0]
            bodies = b.column(2).to_pylist()
            train = np.array([x is False for x in b.column(1).to_pylist()], bool)
            for lo, hi in _parts(bodies):
                ids = words.read([words_of(x) for x in bodies[lo:hi]], train[lo:hi])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(bodies[lo:hi], pa.binary()), pa.array(ids, pa.binary()),
                                                  pa.nulls(hi - lo, pa.binary()), pa.nulls(hi - lo, pa.int64())], names=names)
                if len(words.numbers) > COUNT_WORDS:
                    yield flush()
                    words._start()
        if key is not None:
            yield flush()
    return run


def read(src: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """(word, c): how often every word occurs in the texts not ``held_out``; (key, held_out,
    body, ids): all of ``src`` with every text's ids and its end token, 16 bits each.  The
    texts are read and encoded once."""
    schema = T.StructType([*(T.StructField(x, src.schema[x].dataType) for x in ("key", "held_out")), T.StructField("body", T.BinaryType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    got = common.materialize(src.select("key", "held_out", "body").mapInArrow(_read(tokenizer), schema), "texts_read")
    words = got.where("word is not null").groupBy("word").agg(F.sum("n").alias("c"))
    return common.materialize(words, "word_counts"), got.where("ids is not null").drop("word", "n")


def read_train(train: DataFrame, text: str, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """(word, c): how often every word occurs in all training texts; (ids): the ids of every one."""
    words, texts = read(train.select(F.lit(0).alias("key"), F.lit(False).alias("held_out"), F.col(text).cast("binary").alias("body")), tokenizer)
    return words, texts.select("ids")


def count_pairs(ids: DataFrame, size: int, cells) -> np.ndarray:
    """Counts of ``cells`` over the pairs of all texts: a table per task, summed by cell."""
    def run(batches):
        out = np.zeros(size, np.int32)
        for b in batches:
            tally(out, cells, np.frombuffer(b"".join(b.column(0).to_pylist()), "<u2"))
        at = np.flatnonzero(out)
        for lo in range(0, len(at), 1 << 18):
            part = at[lo:lo + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(out[part].astype(np.int64))], names=["cell", "n"])

    got = ids.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").cast("float").alias("n")).toArrow()
    out = np.zeros(size, np.float32)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out


def train_all(model: Model, ids: DataFrame, n_tokens: int, rounds: int) -> int:
    """Gradient steps of ``model`` over all training texts ``ids``; returns the windows read.
    Each round takes its own share of the texts: every task starts from the present
    parameters and steps over its windows, and the means of the tasks' parameters, by
    windows, are the next ones.  Few texts are gone over again until LEAST_WINDOWS were read."""
    again = max(1, -(-LEAST_WINDOWS * STRIDE // max(1, n_tokens)))
    rounds, seen = min(rounds, 1 if again > 1 else ROUNDS), 0
    size = BATCH if again > 1 else LARGE_BATCH
    sc, net = ids.sparkSession.sparkContext, model.net
    for r in range(rounds):
        held = sc.broadcast((net, model.symbol, model.classes, model.pad))
        share = 1 - 0.9 * r / rounds

        def run(batches):
            net, symbol, classes, pad = held.value
            net = copy.deepcopy(net)                       # worker processes serve several tasks
            adam, rng, n = Adam(net), np.random.default_rng(TaskContext.get().partitionId()), 0
            seqs, many = [], 0

            def learn():
                win, before, target, _ = lay_out(seqs, symbol, pad)
                target = np.where(target < 0, -1, classes[target])
                for _ in range(again):
                    order = rng.permutation(len(win))
                    for lo in range(0, len(win), size):
                        pick = order[lo:lo + size]
                        adam.step(win[pick], before[pick], target[pick], share)
                return len(win)

            for b in batches:
                for x in b.column(0).to_pylist():
                    seqs.append(np.frombuffer(x, "<u2"))
                    many += -(-len(seqs[-1]) // STRIDE)
                    if many >= HELD_WINDOWS:
                        n += learn()
                        seqs, many = [], 0
            if seqs:
                n += learn()
            if n:
                flat = np.concatenate([getattr(net, x).ravel() for x in net.names()]).astype(np.float64) * n
                parts = [flat[lo:lo + BLOCK_CELLS].tobytes() for lo in range(0, len(flat), BLOCK_CELLS)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([n] * len(parts), pa.int64()), pa.array(parts, pa.binary())],
                                                 names=["block", "n", "sums"])

        mine = ids.where(F.pmod(F.xxhash64("ids"), F.lit(rounds)) == r)
        got = mine.mapInArrow(run, "block int, n long, sums binary").groupBy("block").applyInArrow(_add_blocks, "block int, n long, sums binary").collect()
        held.unpersist()
        if got:
            flat = np.concatenate([np.frombuffer(x.sums) / x.n for x in sorted(got, key=lambda x: x.block)])
            for x in net.names():
                old = getattr(net, x)
                old[...] = flat[:old.size].reshape(old.shape)
                flat = flat[old.size:]
            seen += got[0].n
    return seen


def _add_blocks(rows: pa.Table) -> pa.Table:
    """The tasks' sums of one block of parameters, added up."""
    total = np.sum([np.frombuffer(x) for x in rows.column("sums").to_pylist()], axis=0)
    n = sum(rows.column("n").to_pylist())
    return pa.table({"block": rows.column("block")[:1].combine_chunks(), "n": pa.array([n], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})


def _id_counts(tokenizer: str):
    def run(batches):
        sub, total = subwords(tokenizer), np.zeros(VOCAB, np.int64)
        for b in batches:
            words, n = b.column(0).to_pylist(), b.column(1).to_numpy()
            sub.learn(set(words))
            parts = [sub.cache[w] for w in words]
            ids = np.frombuffer(b"".join(parts), "<u4").astype(np.int64)
            total += np.bincount(ids, np.repeat(n, [len(p) // 4 for p in parts]), VOCAB).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])
    return run


def score(docs: DataFrame, tokenizer: str, held_out, key: str = "doc_id", text: str = "text", limit: int = ROUNDS, head_words: int = HEAD_WORDS) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score and
    score (log10 probabilities).  ``held_out`` is a boolean column over ``docs``;
    the other rows are learned from, by ``limit`` rounds of gradient steps at most (0: the
    model of the counts alone)."""
    spark = docs.sparkSession
    common.prepare(spark)
    src = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("body"), held_out.alias("held_out"))
    counts, texts = read(src, tokenizer)
    ids = texts.where(~F.col("held_out")).select("ids")
    ends = ids.count()
    total = counts.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    n_train, v = total.n + ends, total.v + (1 if ends else 0)
    # the least count of which at most head_words words are, by counts' logarithms
    level = F.floor(F.log2("c") * 8)
    least, room = math.inf, head_words
    for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).orderBy(F.desc("level")).collect():
        room -= r.n
        if room < 0:
            break
        least = r.c
    head = {bytes(r.word): r.c for r in counts.where(F.col("c") >= least).collect()} if least < math.inf else {}

    id_counts = np.zeros(VOCAB, np.int64)
    for r in counts.mapInArrow(_id_counts(tokenizer), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        id_counts[r.id] = r.n
    id_counts[END] = ends
    model = Model([], id_counts, lambda size, cells: count_pairs(ids, size, cells))
    train_all(model, ids, int(id_counts.sum()), limit)
    logs = np.log10(np.array([*head.values(), 0], np.float64) + 1)
    held = spark.sparkContext.broadcast((model, dict(zip(head, range(len(head)))), logs))

    schema = T.StructType([T.StructField("rid", T.LongType()), src.schema["key"], src.schema["held_out"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType()),
                           T.StructField("tail", T.ArrayType(T.LongType())), T.StructField("tail_n", T.ArrayType(T.IntegerType()))])

    def run(batches):
        model, head, logs = held.value
        rid = TaskContext.get().partitionId() << 33
        for b in batches:
            bodies = b.column(2).to_pylist()
            for lo, hi in _parts(bodies):
                n = hi - lo
                scores = model.score([np.frombuffer(x, "<u2") for x in b.column(3).slice(lo, n).to_pylist()])
                cols = [[], [], [], [], []]
                for body in bodies[lo:hi]:
                    ws = words_of(body)
                    at = np.fromiter(map(head.get, ws, repeat(-1)), np.int64, len(ws))
                    rare = np.flatnonzero(at < 0)          # the last of logs is theirs, 0
                    tail = Counter(ws[i] for i in rare.tolist())
                    hashes = [xxhash.xxh64_intdigest(w, 42) for w in tail]
                    for c, x in zip(cols, (len(ws) + 1, len(ws) - len(rare), logs[at].sum(), [h - (1 << 64) if h >> 63 else h for h in hashes], list(tail.values()))):
                        c.append(x)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(rid, rid + n)), b.column(0).slice(lo, n), b.column(1).slice(lo, n), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                    pa.array(cols[2], pa.float64()), pa.array(scores), pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.list_(pa.int32()))], names=schema.names)
                rid += n

    scored = common.materialize(texts.mapInArrow(run, schema), "scored")
    tails = scored.select("rid", F.explode(F.arrays_zip("tail", "tail_n")).alias("x")).select("rid", F.col("x.tail").alias("h"), F.col("x.tail_n").alias("n"))
    rare = counts.where(F.col("c") < least) if least < math.inf else counts
    rare = rare.select(F.xxhash64("word").alias("h"), "c").groupBy("h").agg(F.sum("c").alias("c"))
    found = (tails.join(rare, "h").groupBy("rid")
             .agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("gain")))
    end = (math.log10(ends + 1), 1 if ends else 0)
    zero = F.lit(0).cast("long")
    return (scored.drop("tail", "tail_n").join(found, "rid", "left")
            .select(F.col("key").alias(key), "held_out", "n_tokens", (F.col("known") + F.coalesce("more", zero) + end[1]).alias("n_known"),
                    F.lit(n_train).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("gain", F.lit(0.0)) + end[0] - F.col("n_tokens") * math.log10(n_train + v + 1)).alias("base_score"), "score"))

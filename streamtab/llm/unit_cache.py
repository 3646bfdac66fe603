"""Token ids of texts from cached units (words or the like) that a text is made of."""

from __future__ import annotations

import numpy as np


class _Numbers(dict):
    """Numbers of units; a new unit gets the next one and is noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, unit: bytes) -> int:
        n = self[unit] = len(self)
        self.new.append(unit)
        return n


class UnitCache:
    """Numbers the units it meets and keeps their ids end to end in one array, so that a
    text's ids are one gather.  When more than ``limit`` units are held it keeps those
    used again, at most half.  Subclasses say how a text splits into units (``split``, or
    its ids as bytes) and how to find the ids of new ones (``learn``, which calls ``put``)."""

    def __init__(self, width: str, limit: int):
        self.width, self.limit = width, limit
        self._start()

    def split(self, body: bytes) -> list[bytes] | bytes:
        raise NotImplementedError

    def learn(self, units: list[bytes], first: int) -> None:
        """Find the ids of ``units``, whose numbers are ``first`` and the following."""
        raise NotImplementedError

    def ids(self, tok, text: str) -> np.ndarray:
        return np.array(tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.width)

    def put(self, numbers: np.ndarray, ids: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> None:
        """Unit ``numbers[i]`` has ``sizes[i]`` of ``ids`` from ``at[i]`` on."""
        self._grow(0, self.used + len(ids))
        self.flat[self.used:self.used + len(ids)] = ids
        self.at[numbers], self.sizes[numbers] = at + self.used, sizes
        self.used += len(ids)

    def _start(self) -> None:
        self.numbers, self.used = _Numbers(), 0
        self.flat = np.zeros(1 << 16, self.width)
        self.at, self.sizes, self.uses = (np.zeros(1 << 16, np.int64) for _ in range(3))

    def _shrink(self) -> None:
        numbers, n = self.numbers, len(self.numbers)
        uses = self.uses[:n]
        keep = np.flatnonzero(uses >= max(2, np.partition(uses, n // 2)[n // 2] + 1))
        at, sizes, flat, units = self.at[keep], self.sizes[keep], self.flat, np.array(list(numbers), object)[keep]
        self._start()
        self.numbers.update(zip(units.tolist(), range(len(keep))))
        ends = np.cumsum(sizes)
        place = np.repeat(at - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        self._grow(len(keep), len(place))
        self.flat[:len(place)], self.used = flat[place], len(place)
        self.at[:len(keep)], self.sizes[:len(keep)] = ends - sizes, sizes

    def _grow(self, units: int, ids: int) -> None:
        while units > len(self.at):
            self.at, self.sizes, self.uses = (np.append(x, np.zeros_like(x)) for x in (self.at, self.sizes, self.uses))
        while ids > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))

    def encode_all(self, bodies: list[bytes | None]):
        """The ids of every body, in order, as bytes of ``width`` (none for a null)."""
        held, size = [], 0
        for body in bodies:
            held.append(self.split(body) if body else [])
            size += len(body or b"")
            if size > 4 << 20:
                yield from self._flush(held)
                held, size = [], 0
        yield from self._flush(held)

    def encode(self, body: bytes | None) -> bytes:
        return next(iter(self.encode_all([body])))

    def _flush(self, held: list):
        if len(self.numbers) > self.limit:
            self._shrink()
        get = self.numbers.__getitem__
        index = [np.fromiter(map(get, h), np.int64, len(h)) for h in held if isinstance(h, list)]
        new, self.numbers.new = self.numbers.new, []
        self._grow(len(self.numbers), self.used)
        self.learn(new, len(self.numbers) - len(new))
        if index:
            used = np.bincount(np.concatenate(index))
            self.uses[:len(used)] += used
        index = iter(index)
        for h in held:
            if isinstance(h, bytes):
                yield h
                continue
            at = next(index)
            n = self.sizes[at]
            place = np.repeat(self.at[at] - np.cumsum(n) + n, n)
            place += np.arange(len(place))
            yield self.flat[place].tobytes()


__all__ = ["UnitCache"]

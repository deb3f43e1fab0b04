"""64-bit hashes of all words of a batch of texts at once, with numpy.

A word's hash is a polynomial of its bytes (upper case A-Z as lower case) in
64-bit arithmetic, taken from running sums over the whole buffer, then mixed
with its length."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_Q = pow(_P, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = (np.arange(256, dtype=np.uint64) + np.uint64(1))
_VALUE[0x41:0x5B] += np.uint64(0x20)

GROUP = 1 << 20      # bytes of text hashed at a time (a longer text alone)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """P^i and P^-i for i below a length, kept and grown as texts need it."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            def powers(base):
                out = np.full(n, base, dtype=np.uint64)
                out[0] = 1
                return np.cumprod(out, dtype=np.uint64)
            self.up, self.down = powers(_P), powers(_Q)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def grouped(texts: list[bytes], size: int = GROUP) -> Iterator[tuple[int, int]]:
    """Index ranges of texts of about ``size`` bytes together."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def word_hashes(texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, number of words of each text)."""
    texts = list(texts)
    buffer = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    gap = _SPACE[buffer]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    up, down = _powers.upto(len(buffer))
    total = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[buffer] * up, dtype=np.uint64, out=total[1:])
    raw = (total[end] - total[start]) * down[start]
    hashes = mix(raw + mix((end - start).astype(np.uint64)))
    text_end = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(start, text_end)
    return hashes, np.diff(upto, prepend=0)

"""Hashes of spans of words in constant time, from rolling (prefix) hashes over the bytes of many texts at once."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at once; bounds the memory that a long text takes besides its words.
BLOCK = 1 << 16
_SMALL = 1 << 12
_MASK = (1 << 64) - 1


def scramble(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser; each seed gives independent bits."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        out[done : 2 * done] = out[: min(done, n - done)] * np.uint64(pow(base, done, 1 << 64))
        done *= 2
    return out


class Family:
    """Polynomial hash modulo 2^64 over random values of the bytes."""

    def __init__(self, seed: int):
        self.value = scramble(np.arange(256, dtype=np.uint64), 9000 + seed)
        self.base = int(scramble(np.array([seed], dtype=np.uint64), 9500)[0]) | 1
        self.up = _powers(self.base, BLOCK)
        inverse = pow(self.base, -1, 1 << 64)
        self.down, self.inverse = _powers(inverse, _SMALL), inverse
        self.far = _powers(pow(inverse, _SMALL, 1 << 64), 64)

    def prefixes(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hash of the first ``at`` bytes, for each of rising places."""
        out = np.zeros(len(at), dtype=np.uint64)
        carry, shift, k = np.uint64(0), 1, 0
        for start in range(0, len(raw), BLOCK):
            part = raw[start : start + BLOCK]
            total = np.cumsum(self.value[part] * self.up[: len(part)])
            end = int(np.searchsorted(at, start + len(part), side="right"))
            here = at[k:end] - start
            out[k:end] = carry + np.where(here > 0, total[np.maximum(here, 1) - 1], np.uint64(0)) * np.uint64(shift)
            carry = carry + total[-1] * np.uint64(shift)
            shift = shift * pow(self.base, BLOCK, 1 << 64) & _MASK
            k = end
        return out

    def back(self, start: np.ndarray) -> np.ndarray:
        """What takes a span from its place to the front."""
        high = start // _SMALL
        top = int(high.max(initial=0)) + 1
        if top > len(self.far):
            self.far = _powers(pow(self.inverse, _SMALL, 1 << 64), 2 * top)
        return self.down[start % _SMALL] * self.far[high]


_FAMILIES = [Family(k) for k in range(2)]


class Words:
    """Words of several texts, one after the other; hashes of spans of them are differences of prefix hashes.

    Words stand between white space, whatever and however much it is.
    """

    def __init__(self, texts: list[str | None]):
        lists = [t.split() if t else [] for t in texts]
        #: Number of words of each text, and the first word of each.
        self.count = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        raw = np.frombuffer(" ".join(" ".join(x) for x in lists if x).encode("utf-8", "surrogatepass"), dtype=np.uint8)
        space = np.flatnonzero(raw == 32)
        n = int(self.first[-1])
        self.raw, self.start, self.end = raw, np.concatenate(([0], space + 1))[:n], np.concatenate((space, [len(raw)]))[:n]
        self._sums: dict[int, tuple] = {}

    def _family(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if k not in self._sums:
            f = _FAMILIES[k]
            with np.errstate(over="ignore"):
                self._sums[k] = f.prefixes(self.raw, self.start), f.prefixes(self.raw, self.end), f.back(self.start)
        return self._sums[k]

    def span(self, a: np.ndarray | slice, last: np.ndarray | slice, family: int = 0) -> np.ndarray:
        """Hash of the words a to last (both included), as they stand with one space between."""
        at_start, at_end, back = self._family(family)
        with np.errstate(over="ignore"):
            return scramble((at_end[last] - at_start[a]) * back[a], 77)

    def runs(self, size: int, family: int = 0) -> np.ndarray:
        """Hash of the ``size`` words from each word on; runs over the end of a text are there too, but of no use."""
        n = max(0, len(self.start) - size + 1)
        return self.span(slice(0, n), slice(size - 1, size - 1 + n), family)


def least_places(x: np.ndarray, size: int) -> np.ndarray:
    """Place of the leftmost least element of every run of ``size`` elements; elements count by their upper 40 bits."""
    n = len(x) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    low = np.uint64((1 << 24) - 1)
    if len(x) > int(low):
        half = len(x) // 2
        return np.concatenate((least_places(x[: half + size - 1], size), least_places(x[half:], size) + half))
    now, width = (x & ~low) | np.arange(len(x), dtype=np.uint64), 1
    while 2 * width <= size:
        now, width = np.minimum(now[:-width], now[width:]), 2 * width
    return (np.minimum(now[:n], now[size - width : size - width + n]) & low).astype(np.int64)

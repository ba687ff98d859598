"""Wavelet matrix over non-negative integers: bit planes with rank and select, all queries on arrays.

A plane holds one bit of every value, in the order in which the planes before it have dealt the values (zeros first, each
half in order). Bits lie in 64-bit words with a running count of ones per word, so a rank is one lookup and one population
count, and a select one binary search over the counts.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
_BITS = np.arange(64, dtype=np.uint64)


def places(ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the zeros and of the ones: found and taken without a branch per bit, unlike an index of bits."""
    return np.flatnonzero(~ones), np.flatnonzero(ones)


class Plane:
    """One bit plane of ``size`` bits in little-endian words."""

    def __init__(self, words: np.ndarray, size: int):
        self.size, self.words = size, np.append(words, np.uint64(0))
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        self.ones = int(self.before[-1])

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        packed = np.packbits(bits, bitorder="little")
        return cls(np.pad(packed, (0, -len(packed) % 8)).view("<u8"), len(bits))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), bitorder="little")[: self.size]

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & _ONE

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word = at >> 6
        return self.before[word] + np.bitwise_count(self.words[word] & ((_ONE << (at & 63).astype(np.uint64)) - _ONE))

    def select(self, bit: int, k: np.ndarray) -> np.ndarray:
        """Place of the ``k``-th (from 0) one or zero."""
        count = self.before if bit else np.arange(len(self.before), dtype=np.int64) * 64 - self.before
        word = np.searchsorted(count, k, side="right") - 1
        inside = np.bitwise_and(self.words[word][:, None] >> _BITS, _ONE) == bit
        return word * 64 + (np.cumsum(inside, axis=1) == (k - count[word] + 1)[:, None]).argmax(axis=1)


class WaveletMatrix:
    """Planes from the highest bit down, and the zeros of each."""

    def __init__(self, planes: list[Plane], size: int):
        self.planes, self.size = planes, size
        self.zeros = [size - p.ones for p in planes]

    @classmethod
    def of(cls, values: np.ndarray, bits: int | None = None) -> WaveletMatrix:
        """The matrix of an array; ``bits`` as many as its largest value needs, unless given."""
        bits = bits or max(1, int(values.max(initial=0)).bit_length())
        planes, now = [], values.astype(np.uint16 if bits <= 16 else np.uint32 if bits <= 32 else np.uint64)
        for b in reversed(range(bits)):
            ones = now & now.dtype.type(1 << b) != 0
            planes.append(Plane.of(ones))
            now = np.concatenate([now.take(at) for at in places(ones)])
        return cls(planes, len(values))

    def values(self) -> np.ndarray:
        """All values in order: the planes are dealt back from the lowest bit."""
        out = np.zeros(self.size, np.uint16 if len(self.planes) <= 16 else np.uint32 if len(self.planes) <= 32 else np.uint64)
        for depth in reversed(range(len(self.planes))):
            ones = self.planes[depth].bits().view(bool)
            dealt = np.empty_like(out)
            zero, one = places(ones)
            dealt[zero], dealt[one] = out[: self.zeros[depth]], out[self.zeros[depth]:]
            out = dealt | ones.astype(out.dtype) << out.dtype.type(len(self.planes) - 1 - depth)
        return out

    def access(self, at: np.ndarray) -> np.ndarray:
        """Values at these places."""
        at, out = at.astype(np.int64), np.zeros(len(at), np.int64)
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            one = plane.get(at).astype(np.int64)
            ones = plane.rank(at)
            at = np.where(one == 1, zeros + ones, at - ones)
            out = 2 * out + one
        return out

    def spans(self, values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends in the last plane's order of each value's occurrences within [lo, hi)."""
        lo, hi = lo.astype(np.int64), hi.astype(np.int64)
        for depth, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            one = (values >> (len(self.planes) - 1 - depth)) & 1 == 1
            a, b = plane.rank(lo), plane.rank(hi)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return lo, hi

    def count(self, values: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
        """How often each value occurs, in [lo, hi) or everywhere; values beyond the planes never do."""
        n = len(values)
        known = (values >= 0) & (values < 1 << len(self.planes))
        a, b = self.spans(np.where(known, values, 0), np.zeros(n, np.int64) if lo is None else lo, np.full(n, self.size) if hi is None else hi)
        return np.where(known, b - a, 0)

    def occurrences(self, value: int) -> np.ndarray:
        """All places of one value, ascending: a span of the last plane, selected back up plane by plane."""
        if not 0 <= value < 1 << len(self.planes):
            return np.zeros(0, np.int64)
        a, b = self.spans(np.array([value]), np.array([0]), np.array([self.size]))
        at = np.arange(a[0], b[0])
        for depth in reversed(range(len(self.planes))):
            bit = (value >> (len(self.planes) - 1 - depth)) & 1
            at = self.planes[depth].select(bit, at - self.zeros[depth] if bit else at)
        return at

    def below(self, limit: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Values under each limit (at most 2 ** planes) in [lo, hi)."""
        all_ = limit >= 1 << len(self.planes)
        whole, out = hi - lo, np.zeros(len(limit), np.int64)
        for depth, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            one = (limit >> (len(self.planes) - 1 - depth)) & 1 == 1
            a, b = plane.rank(lo), plane.rank(hi)
            out += np.where(one, (hi - b) - (lo - a), 0)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return np.where(all_, whole, out)

    def kth(self, k: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) in [lo, hi)."""
        out = np.zeros(len(k), np.int64)
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            a, b = plane.rank(lo), plane.rank(hi)
            small = (hi - b) - (lo - a)
            one = k >= small
            k = np.where(one, k - small, k)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
            out = 2 * out + one
        return out

    def successor(self, least: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The smallest value of at least ``least`` in [lo, hi), or -1."""
        k = self.below(least, lo, hi)
        found = k < hi - lo
        out = np.full(len(least), -1, np.int64)
        out[found] = self.kth(k[found], lo[found], hi[found])
        return out

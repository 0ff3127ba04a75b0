"""A compressed full-text index over word codes: suffix order, BWT, wavelet matrix, and backward search for many patterns at once."""

from __future__ import annotations

import numpy as np


def suffix_order(codes: np.ndarray, longest: int) -> np.ndarray:
    """Suffixes in order, by prefix doubling up to longest symbols; beyond that no two may be equal."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    rank = np.zeros(n, np.int64)
    rank[order[1:]] = np.cumsum(codes[order[1:]] != codes[order[:-1]])
    k = 1
    while k < longest and rank[order[-1]] < n - 1:
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] + 1 if k < n else 0
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        rank = np.zeros(n, np.int64)
        rank[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        k *= 2
    return order


class Bits:
    """A bit vector with ranks. Its 64-bit words are stored once each, with a code at each place, where that is shorter,
    as in the long runs that a BWT has; counts stand at every eighth word, and from there in 16 bits."""

    def __init__(self, bit: np.ndarray):
        words = np.packbits(np.append(bit, np.zeros(128 - len(bit) % 64, bool)), bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        self.far = ones[:-1:8].copy()
        self.near = (ones[:-1] - np.repeat(self.far, 8)[: len(words)]).astype(np.uint16)
        some, code = np.unique(words, return_inverse=True)
        kind = np.uint8 if len(some) <= 1 << 8 else np.uint16 if len(some) <= 1 << 16 else np.uint32
        self.code = None
        if 8 * len(some) + np.dtype(kind).itemsize * len(words) < 8 * len(words):
            words, self.code = some, code.astype(kind)
        self.words = words

    def nbytes(self) -> int:
        return self.words.nbytes + self.far.nbytes + self.near.nbytes + (0 if self.code is None else self.code.nbytes)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        own = self.words[word if self.code is None else self.code[word]]
        return self.far[word >> 3] + self.near[word] + np.bitwise_count(own & low)


class WaveletMatrix:
    """Ranks of symbols in a sequence: a bit vector for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.zeros = [], []
        s = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = ((s >> level) & 1).astype(bool)
            self.bits.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            s = np.concatenate([s[~bit], s[bit]])

    def descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Place of i after all levels on the way of symbol c; descend(c, i) - descend(c, 0) is the rank of c before i."""
        for k in range(self.levels):
            one = (c >> (self.levels - 1 - k)) & 1 == 1
            ones = self.bits[k].ones(i)
            i = np.where(one, self.zeros[k] + ones, i - ones)
        return i


class FmIndex:
    """Index of several runs of codes (1 to sigma - 1), each ended by a symbol of its own that no pattern holds.

    weights: how often each run is there; it is indexed once and counted so often.
    """

    def __init__(self, codes: np.ndarray, bounds: np.ndarray, sigma: int | None = None, weights: np.ndarray | None = None):
        runs = len(bounds) - 1
        sizes = np.diff(bounds)
        text = np.insert(codes.astype(np.int64) + runs, bounds[1:], np.arange(runs))
        order = suffix_order(text, int(sizes.max(initial=0)) + 1)
        bwt = text[order - 1]
        bwt = np.where(bwt < runs, 0, bwt - runs)
        self.sigma = sigma or int(codes.max(initial=0)) + 1
        self.wavelet = WaveletMatrix(bwt, self.sigma)
        n = np.bincount(bwt, minlength=self.sigma)
        self.starts = np.concatenate([[0], np.cumsum(n)])
        self.n = len(text)
        run = np.repeat(np.arange(runs), sizes + 1)[order]
        self.times = np.concatenate([[0], np.cumsum(np.ones(runs, np.int64)[run] if weights is None else weights[run])])
        every = np.arange(self.sigma)
        self.zero = self.wavelet.descend(every, np.zeros(self.sigma, np.int64))

    def count(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """How often the patterns of these suffix ranges occur."""
        return self.times[hi] - self.times[lo]

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the patterns with symbol c put before them."""
        base = self.starts[c] - self.zero[c]
        return base + self.wavelet.descend(c, lo), base + self.wavelet.descend(c, hi)


def repeated_windows(index: FmIndex, codes: np.ndarray, bounds: np.ndarray, size: int, least: int) -> np.ndarray:
    """For each place of the runs, whether the window of size codes that begins there occurs at least least times.

    Backward search from the right end of a run's open windows gives the longest match that ends there: windows inside
    it are repeated. Backward search over the leftmost open window gives the place where it fails: all windows that
    hold the failed piece are not. The two take turns until no window is open; all runs go a step at a time together.
    """
    out = np.zeros(len(codes), bool)
    base = bounds[:-1].astype(np.int64)
    a, b = np.zeros(len(base), np.int64), np.diff(bounds).astype(np.int64) - size
    right = np.ones(len(base), bool)
    live = np.flatnonzero(b >= a)
    pos, lo, hi = b + size, np.zeros(len(base), np.int64), np.full(len(base), index.n)
    starts, ends = [], []
    while len(live):
        l1, h1 = index.extend(codes[base[live] + pos[live] - 1].astype(np.int64), lo[live], hi[live])
        ok = index.count(l1, h1) >= least
        on = live[ok]
        lo[on], hi[on] = l1[ok], h1[ok]
        pos[on] -= 1
        won = on[pos[on] == a[on]]
        lost = live[~ok]
        r, w = won[right[won]], won[~right[won]]
        starts += [base[r] + a[r], base[w] + a[w]]
        ends += [base[r] + b[r], base[w] + a[w]]
        a[r] = b[r] + 1
        a[w] += 1
        q = pos[lost] - 1
        r, qr = lost[right[lost]], q[right[lost]]
        inside = qr < b[r]
        starts.append(base[r[inside]] + qr[inside] + 1)
        ends.append(base[r[inside]] + b[r[inside]])
        b[r] = np.where(inside, qr, b[r] - 1)
        w, qw = lost[~right[lost]], q[~right[lost]]
        a[w] = qw + 1
        turned = np.concatenate([won, lost])
        right[turned] = ~right[turned]
        pos[turned] = np.where(right[turned], b[turned], a[turned]) + size
        lo[turned], hi[turned] = 0, index.n
        live = live[a[live] <= b[live]]
    if starts:
        s, e = np.concatenate(starts), np.concatenate(ends)
        edge = np.zeros(len(codes) + 1, np.int64)
        np.add.at(edge, s, 1)
        np.add.at(edge, e + 1, -1)
        out = np.cumsum(edge[:-1]) > 0
    return out

"""A compressed FM-index over word ids: a wavelet matrix of the Burrows-Wheeler transform, searched backward for many patterns at once."""

from __future__ import annotations

import numpy as np

#: Places of the suffix array whose least owner is found one by one; beyond, by tables.
RUN = 16


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` in the order of their first ``depth`` symbols or more, by doubling; suffixes alike to that depth in any order."""
    n, k = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank)
    while k < depth and int(rank.max(initial=0)) < n - 1:
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
        k *= 2
    return order


class WaveletMatrix:
    """Bits of the symbols, level by level from the highest, packed into 64-bit words with a count per word."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        s, n = symbols, len(symbols)
        for level in range(self.levels - 1, -1, -1):
            bit = (s >> level & 1).astype(bool)
            packed = np.zeros(-(-(n + 1) // 64) * 8, np.uint8)
            raw = np.packbits(bit, bitorder="little")
            packed[: len(raw)] = raw
            words = packed.view(np.uint64)
            self.bits.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype(np.int32))
            self.zeros.append(n - int(bit.sum()))
            s = np.concatenate([s[~bit], s[bit]])
        self.base = self._descend(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            word = at >> 6
            ones = self.counts[k][word] + np.bitwise_count(self.bits[k][word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where(symbol >> level & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        return self._descend(symbol, at) - self.base[symbol]


class FMIndex:
    """Over sequences joined by separators; symbols from 1 on. Each sequence has an owner, and owners ascend along the text."""

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray, n_symbols: int):
        sizes = np.array([len(s) + 1 for s in sequences])
        text = np.zeros(int(sizes.sum()), np.int64)
        begin = np.cumsum(sizes) - sizes
        for b, s in zip(begin.tolist(), sequences, strict=True):
            text[b : b + len(s)] = s
        sa = suffix_array(text, int(sizes.max(initial=1)))
        self.n = len(text)
        self.wavelet = WaveletMatrix(text[sa - 1], n_symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        # the least owner in any range of the suffix array: runs of RUN from both ends, and a table of powers of two over whole runs
        self.owner = np.repeat(np.asarray(owners), sizes)[sa]
        runs = np.full((-(-self.n // RUN), RUN), np.iinfo(self.owner.dtype).max, self.owner.dtype)
        runs.ravel()[: self.n] = self.owner
        self.to_here = np.minimum.accumulate(runs, axis=1).ravel()
        self.from_here = np.minimum.accumulate(runs[:, ::-1], axis=1)[:, ::-1].ravel()
        self.least = [runs.min(axis=1)]
        while 2 << (len(self.least) - 1) <= len(runs):
            a, half = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(a[: len(a) - half], a[half:]))

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the ranges of (symbol, pattern) from those of the patterns."""
        both = np.tile(self.first[symbol], 2) + self.wavelet.rank(np.tile(symbol, 2), np.concatenate([low, high]))
        return both[: len(low)], both[len(low) :]

    def least_owner(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Of nonempty ranges."""
        last = high - 1
        out = np.minimum(self.from_here[low], self.to_here[last])
        first_run, last_run = low // RUN, last // RUN
        inside = np.flatnonzero(first_run == last_run)
        if len(inside):
            a, b = low[inside], last[inside]
            own = self.owner[a]
            for k in range(1, int((b - a).max()) + 1):
                own = np.minimum(own, self.owner[np.minimum(a + k, b)])
            out[inside] = own
        between = np.flatnonzero(last_run - first_run > 1)
        if len(between):
            a, b = first_run[between] + 1, last_run[between]
            k = np.frexp((b - a).astype(np.float64))[1] - 1
            for level in np.unique(k).tolist():
                i = np.flatnonzero(k == level)
                of, table = between[i], self.least[level]
                out[of] = np.minimum(out[of], np.minimum(table[a[i]], table[b[i] - (1 << level)]))
        return out

    def held_earlier(self, flat: np.ndarray, begin: np.ndarray, end: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """For ranges of symbols in ``flat``: the leftmost position from which the range's rest stands in a sequence of a smaller owner; ``end`` if none."""
        at, low, high = end.copy(), np.zeros(len(end), np.int64), np.full(len(end), self.n, np.int64)
        live = np.flatnonzero(begin < end)
        while len(live):
            a, b = self.extend(flat[at[live] - 1], low[live], high[live])
            ok = a < b
            ok[ok] = self.least_owner(a[ok], b[ok]) < owner[live[ok]]
            live, a, b = live[ok], a[ok], b[ok]
            low[live], high[live] = a, b
            at[live] -= 1
            live = live[at[live] > begin[live]]
        return at

    def windows_held_earlier(self, flat: np.ndarray, begin: np.ndarray, end: np.ndarray, owner: np.ndarray, window: int, at_once: int = 300_000) -> list[np.ndarray]:
        """For each range the starts (from 0) of its windows that stand in a sequence of a smaller owner: matching statistics against
        the threshold ``window``. Whole ranges first, since one that is held holds all its windows; then all windows of the others
        side by side, each from its last word on until it is found in no smaller owner's sequence, mostly after a few words."""
        found = [np.zeros(0, np.int64)] * len(begin)
        n_windows = np.maximum(end - begin - window + 1, 0)
        whole = (self.held_earlier(flat, begin, end, owner) == begin) & (n_windows > 0)
        for i in np.flatnonzero(whole).tolist():
            found[i] = np.arange(n_windows[i])
        n_windows[whole] = 0
        of = np.repeat(np.arange(len(begin)), n_windows)
        start = np.arange(len(of)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        for k in range(0, len(of), at_once):
            i, s = of[k : k + at_once], start[k : k + at_once]
            held = self.held_earlier(flat, begin[i] + s, begin[i] + s + window, owner[i]) == begin[i] + s
            i, s = i[held], s[held]
            edge = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else []
            for own, part in zip(i[edge].tolist() if len(i) else [], np.split(s, edge[1:]) if len(i) else [], strict=True):
                found[own] = np.concatenate([found[own], part])
        return found

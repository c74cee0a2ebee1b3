"""Suffix arrays by induced sorting, and permuted common prefixes, on NumPy arrays.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. The leftmost S
suffixes of each run (LMS) are sorted: their substrings by one round of induction, equal ones by
recursion on the string of their names. From them all suffixes are induced in two scans. A scan goes
through the buckets of first symbols; within a bucket, whole runs of entries are placed at once.
The recursion ends at strings of at most DIRECT names, which are sorted by doubling: below that size
the many small steps of a scan cost more than a few sorts of whole arrays.
"""

from __future__ import annotations

import numpy as np

#: Names of a reduced string are written with this many symbols a digit at most.
DIGIT = 2048
#: Strings of so many names are sorted without further recursion.
DIRECT = 1 << 17


def _classify(text: np.ndarray) -> np.ndarray:
    """True for S suffixes. The last symbol is the unique smallest one, and S."""
    n = len(text)
    rising = np.empty(n, bool)
    rising[-1] = True
    rising[:-1] = text[:-1] < text[1:]
    fixed = np.empty(n, bool)
    fixed[-1] = True
    fixed[:-1] = text[:-1] != text[1:]
    at = np.where(fixed, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]  # the next place where neighbours differ
    return rising[at]


class _Buckets:
    def __init__(self, text: np.ndarray, symbols: int, is_s: np.ndarray) -> None:
        self.text, self.symbols, self.is_s = text, symbols, is_s
        self.counts = np.bincount(text, minlength=symbols)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        self.present = np.flatnonzero(self.counts)
        self.narrow = symbols <= 1 << 16

    def _by_symbol(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        symbols = self.text[at]
        order = np.argsort(symbols.astype(np.uint16) if self.narrow else symbols, kind="stable")
        symbols = symbols[order]
        first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        sizes = np.diff(np.append(first, len(symbols)))
        return at[order], symbols[first], sizes, np.arange(len(symbols)) - np.repeat(first, sizes)

    def induce(self, lms: np.ndarray) -> np.ndarray:
        """All suffixes in the order induced from LMS suffixes in this order."""
        text, is_s = self.text, self.is_s
        out = np.full(len(text), -1, np.int32)
        heads = self.starts.copy()

        def place_l(entries: np.ndarray) -> None:
            before = entries[entries > 0] - 1
            before = before[~is_s[before]]
            if len(before):
                sorted_, symbols, sizes, rank = self._by_symbol(before)
                out[np.repeat(heads[symbols], sizes) + rank] = sorted_
                heads[symbols] += sizes

        by = text[lms]
        lms = lms[np.argsort(by.astype(np.uint16) if self.narrow else by, kind="stable")]
        edges = np.concatenate([[0], np.cumsum(np.bincount(by, minlength=self.symbols))])
        for c in self.present.tolist():
            at = int(self.starts[c])
            while at < heads[c]:
                end = int(heads[c])
                place_l(out[at:end])
                at = end
            if edges[c] < edges[c + 1]:
                place_l(lms[edges[c] : edges[c + 1]])
        tails = self.ends.copy()
        out[0] = len(text) - 1

        def place_s(entries: np.ndarray) -> None:
            before = entries[entries > 0] - 1
            before = before[is_s[before]]
            if len(before):
                sorted_, symbols, sizes, rank = self._by_symbol(before)
                out[np.repeat(tails[symbols], sizes) - 1 - rank] = sorted_
                tails[symbols] -= sizes

        for c in self.present[::-1].tolist():
            at = int(self.ends[c])
            while at > tails[c]:
                end = int(tails[c])
                place_s(out[end:at][::-1])
                at = end
            if self.starts[c] < heads[c]:
                place_s(out[self.starts[c] : heads[c]][::-1])
        return out


def _names(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the LMS substrings, in text order, so that their order is that of the substrings."""
    lengths = np.diff(np.append(lms, len(text) - 1)) + 1
    sizes = lengths[np.searchsorted(lms, order)]
    same = sizes[1:] == sizes[:-1]
    active = np.flatnonzero(same)
    offset = 0
    while len(active):
        equal = text[order[active] + offset] == text[order[active + 1] + offset]
        same[active[~equal]] = False
        offset += 1
        active = active[equal]
        active = active[sizes[active] > offset]
    rank = np.concatenate([[0], np.cumsum(~same)])
    names = np.empty(len(lms), np.int64)
    names[np.searchsorted(lms, order)] = rank
    return names, int(rank[-1]) + 1


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Suffixes in ascending order. text: integers below `symbols`; the last is 0 and the only 0."""
    n = len(text)
    if n < 3:
        return np.arange(n - 1, -1, -1, dtype=np.int32)
    is_s = _classify(text)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]).astype(np.int32) + 1
    buckets = _Buckets(text, symbols, is_s)
    if len(lms) > 1:
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        induced = buckets.induce(lms)
        order = induced[is_lms[induced]]
        names, distinct = _names(text, lms, order)
        if distinct < len(lms):
            order = lms[_reduced(names, distinct)]
    else:
        order = lms
    return buckets.induce(order)


def _reduced(names: np.ndarray, distinct: int) -> np.ndarray:
    """Suffixes of the string of names in order. Many names are written with two digits each."""
    if len(names) <= DIRECT:
        return _by_doubling(names)
    if distinct <= DIGIT:
        return suffix_array(names.astype(np.int32), distinct)
    base = int(np.ceil(np.sqrt(distinct)))
    digits = np.zeros(2 * len(names) + 1, np.int32)
    digits[:-1:2], digits[1:-1:2] = names // base + 1, names % base + 1
    order = suffix_array(digits, base + 2)
    order = order[(order % 2 == 0) & (order < 2 * len(names))]
    return order // 2


def _by_doubling(names: np.ndarray) -> np.ndarray:
    rank, width, n = names.astype(np.int64), 1, len(names)
    while True:
        key = rank * (n + 1)
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        change = np.flatnonzero(np.diff(key[order])) + 1
        if len(change) == n - 1:
            return order
        rank = np.zeros(n, np.int64)
        rank[order[change]] = 1
        rank[order] = np.cumsum(rank[order])
        width *= 2


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, data.dtype)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for j in range(8):
        out = out << np.uint64(8) | padded[j : j + len(data)]
    return out


def permuted_common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place, in text order, the common prefix of its suffix and the one before it, up to `most`."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    words = np.append(words_at(data), np.zeros(1, np.uint64))
    found = np.zeros(n, np.int64)
    active = np.flatnonzero(before >= 0)
    for offset in range(0, most, 8):
        a, b = np.minimum(active + offset, n), np.minimum(before[active] + offset, n)
        differ = words[a] ^ words[b]
        equal = differ == 0
        odd = differ[~equal]
        zeros = np.zeros(len(odd), np.int64)
        for shift in range(8, 64, 8):
            zeros += (odd >> np.uint64(64 - shift)) == 0
        found[active[~equal]] = offset + zeros
        active = active[equal]
        found[active] = offset + 8
    room = n - np.maximum(np.arange(n), before)
    return np.minimum(np.minimum(found, most), room)

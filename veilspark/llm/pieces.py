"""Byte-level BPE of Arrow batches: texts are cut into parts that encode alone, each distinct part once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: White space as the split pattern means it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A space before white space or the end: in such a text not every space begins a part.
RUN = f" (?:[{SPACE}]|$)"
_CUT = regex.compile(f"(?= [^{SPACE}])")
#: Text bytes handled at once.
SLICE_BYTES = 3 << 20


def split_pattern(pattern: str) -> regex.Pattern:
    """The split pattern with its white space spelt out, so that it doesn't depend on this library's."""
    return regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows with at most so many bytes of text, or of one row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start, before = 0, 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield batch.slice(start, end - start)
        start, before = end, int(sizes[end - 1])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all the ranges, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


class BatchEncoder:
    """Remembers the ids of parts, `most` of them at most; when full, it keeps those used again since it met them."""

    def __init__(self, compute: Callable[[list[str]], tuple[list[int], list[int]]], most: int = 250_000) -> None:
        self.compute, self.most = compute, most
        self.known: dict[str, int] = {}
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)
        self.uses = np.zeros(1 << 16, np.int64)  # slices that had the part
        self.flat = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _thin_out(self) -> None:
        n = len(self.known)
        uses = self.uses[:n]
        least = 2
        while np.count_nonzero(uses >= least) > self.most // 2:
            least *= 2
        stays = uses >= least
        self.known = dict(zip([x for x, s in zip(self.known, stays.tolist(), strict=True) if s], range(n), strict=False))
        starts, lengths = self.starts[:n][stays], self.lengths[:n][stays]
        self.used = int(lengths.sum())
        self.flat[: self.used] = self.flat[ragged(starts, lengths)]
        k = len(lengths)
        self.starts[:k], self.lengths[:k], self.uses[:k] = np.cumsum(lengths) - lengths, lengths, uses[stays] // 2
        self.uses[k:] = 0

    def _places(self, parts: list[str]) -> np.ndarray:
        known = self.known
        missing = [x for x in parts if x not in known]
        if missing:
            if len(known) + len(missing) > self.most:
                self._thin_out()
                known = self.known
                missing = [x for x in parts if x not in known]
            missing = list(dict.fromkeys(missing))
            ids, counts = self.compute(missing)
            first = len(known)
            sizes = np.array(counts, np.int64)
            total = len(ids)
            while first + len(sizes) > len(self.starts):
                self.starts, self.lengths, self.uses = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths, self.uses))
            while self.used + total > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.starts[first : first + len(sizes)] = self.used + np.cumsum(sizes) - sizes
            self.lengths[first : first + len(sizes)] = sizes
            self.flat[self.used : self.used + total] = ids
            self.used += total
            known.update(zip(missing, range(first, first + len(missing)), strict=True))
        places = np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))
        self.uses[places] += 1
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: none), and each text's end among them after a leading 0."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, RUN)
        split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        counts = np.diff(split.offsets.to_numpy()) if len(texts) else np.zeros(0, np.int64)
        firsts = split.offsets.to_numpy()[:-1]
        seen = split.flatten().dictionary_encode()
        # What begins a text has no space before it; odd texts are cut one by one.
        lead = [_CUT.split(t) if o else [t.partition(" ")[0]] for t, o in zip(texts.to_pylist(), odd.to_pylist(), strict=True)]
        lead = [[x for x in parts if x] for parts in lead]
        own_counts = np.fromiter(map(len, lead), np.int64, len(lead))
        rest = [" " + x for x in seen.dictionary.to_pylist()]
        placed = self._places(rest + [x for parts in lead for x in parts])
        place, own = placed[: len(rest)][seen.indices.to_numpy()], placed[len(rest) :]
        starts, lengths = self.starts[place], self.lengths[place]
        order_counts = own_counts + counts - 1
        total = np.concatenate([[0], np.cumsum(order_counts)])
        all_starts, all_lengths = np.empty(int(total[-1]), np.int64), np.empty(int(total[-1]), np.int64)
        to_own = ragged(total[:-1], own_counts)
        to_rest = ragged(total[:-1] + own_counts, counts - 1)
        from_rest = ragged(firsts + 1, counts - 1)
        all_starts[to_own], all_lengths[to_own] = self.starts[own], self.lengths[own]
        all_starts[to_rest], all_lengths[to_rest] = starts[from_rest], lengths[from_rest]
        ids = self.flat[ragged(all_starts, all_lengths)]
        ends = np.concatenate([[0], np.cumsum(all_lengths)])[total]
        return ids, ends

"""Best-fit packing of token sequences, planned on the counts of each length.

1. Tokens: every document is encoded and followed by the end id; longer ones than the capacity are cut into
   pieces of the capacity, the last one shorter.
2. Counts: how many pieces there are of each length. There are at most `capacity` lengths whatever the
   size of the data, and only these counts reach the driver.
3. Plan. Large items are those above a third of the capacity, so at most two of them share a sequence. They are
   matched greedily: from the longest down, each with the longest one that still fits, which leaves the
   fewest sequences that any matching of them leaves. Smaller items go from the longest down into the
   tightest gap that takes them, and only then into new sequences. Equal lengths are placed in one step: "n
   items of this length, k for each sequence from number b on, behind t tokens". A gap more than halves whenever
   it is used, so the plan has at most about 12 steps for each of its groups of sequences.
4. Places: a piece's rank among those of its length comes from its number in its task and the counts of the
   tasks before, and the plan tells its sequence and its offset. Nothing is sorted.

So the packing is one global best fit over all pieces, not one for each task, at any size.

Defined cases: a null or empty text is the end id alone; rows with equal or null ids are documents of their
own; an empty table gives an empty result; special tokens in a text get the ids that the library gives
them; other columns are left out, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilspark.llm.arrow import held, small_batches
from veilspark.llm.pieces import ragged, slices
from veilspark.llm.token_files import read_tokenizer
from veilspark.plans.frames import cut, read_table

CAPACITY = 4096
END_ID = 1
#: Parts joined in one text for the library, and what stands between them; bytes of text handled at once.
JOINED, SLICE_BYTES = 64, 8 << 20
_MARK = "\x00"
#: How tokenizers of this family make words of a text, as their files state it.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
_END = "</w>"
#: Parts of these characters only have one lower case and one normal form; the same words in this smaller alphabet.
_PLAIN = "^[!-~\u00c0-\u00ff]*$"
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PLAIN_WORDS = f"('s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+)"


class WordEncoder:
    """Ids of whole texts by a tokenizer whose tokens never hold or look across white space.

    Texts are cut at ASCII white space and each distinct part of a slice is encoded once, many in one
    call with a mark between them that is a token of its own. Where the tokenizer is of the family above, parts of
    plain characters are lowered and cut into words here, and the library gets each distinct word.
    """

    def __init__(self, content: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        probe = self._ids([f"a\tb\nc \x0b {_MARK}\x0c\rA", f"a b c {_MARK} a", _MARK])
        if len(probe[2]) != 1 or not np.array_equal(probe[0], probe[1]):
            raise ValueError("this tokenizer doesn't drop white space")
        self.mark = int(probe[2][0])
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        spec = json.loads(content)
        cutter = {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}
        self.words: Tokenizer | None = None
        if (
            spec["normalizer"] == {"type": "Sequence", "normalizers": _NORMALIZER}
            and spec["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [cutter, _BYTES]}
            and spec["model"]["end_of_word_suffix"] == _END
        ):
            words = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, _BYTES]}
            self.words = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": words, "added_tokens": []}))
            vocabulary = self.words.get_vocab()
            self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends_word[[i for x, i in vocabulary.items() if x.endswith(_END)]] = True

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain parts, one after another, and how many each has."""
        spaced = pc.replace_substring_regex(pc.utf8_lower(parts), _PLAIN_WORDS, r"\1 ")
        split = pc.split_pattern(spaced, " ")
        flat, edges = split.flatten(), split.offsets.to_numpy().astype(np.int64)
        full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        seen = flat.filter(pa.array(full)).dictionary_encode()
        words = seen.dictionary.to_pylist()
        joined = [" ".join(words[k : k + JOINED]) for k in range(0, len(words), JOINED)]
        found = [np.array(x.ids, np.uint32) for x in self.words.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.uint32), *found])
        stops = np.flatnonzero(self.ends_word[ids]) + 1
        if len(stops) != len(words):
            raise ValueError("the tokenizer's words don't end in a token of their own")
        sizes, place = np.diff(stops, prepend=0), seen.indices.to_numpy()
        tokens = np.concatenate([[0], np.cumsum(sizes[place])])[np.concatenate([[0], np.cumsum(full)])[edges]]
        return ids[ragged(stops[place] - sizes[place], sizes[place])], np.diff(tokens)

    def _marked_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any parts, one after another, and how many each has."""
        listed = parts.to_pylist()
        odd = [k for k, x in enumerate(listed) if _MARK in x]
        own = dict(zip(odd, self._ids([listed[k] for k in odd]), strict=True))
        for k in odd:
            listed[k] = ""
        joined = [f" {_MARK} ".join(listed[k : k + JOINED]) for k in range(0, len(listed), JOINED)]
        found = [np.zeros(0, np.uint32)]
        for ids in self._ids(joined):
            found += [ids, np.array([self.mark], np.uint32)]
        ids = np.concatenate(found)
        stops = np.flatnonzero(ids == self.mark)
        if len(stops) != len(listed):
            raise ValueError("the tokenizer joins parts with the mark between them")
        sizes = np.diff(stops, prepend=-1) - 1
        if odd:
            each = np.split(ids, stops + 1)[:-1]
            each = [own.get(k, x[:-1]) for k, x in enumerate(each)]
            return np.concatenate(each), np.array([len(x) for x in each])
        return ids[ids != self.mark], sizes

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of parts, and where each one's begin and how many they are."""
        plain = pa.array(np.zeros(len(parts), bool))
        if self.words is not None:
            plain = pc.match_substring_regex(parts, _PLAIN)
            for token in self.special:
                plain = pc.and_not(plain, pc.match_substring(parts, token))
        some = plain.to_numpy(zero_copy_only=False)
        lengths, starts, ids, before = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64), [], 0
        for chosen, encode in ((some, self._plain_parts if self.words is not None else self._marked_parts), (~some, self._marked_parts)):
            here, sizes = encode(parts.filter(pa.array(chosen)))
            lengths[chosen], starts[chosen] = sizes, before + np.cumsum(sizes) - sizes
            ids.append(here)
            before += len(here)
        return np.concatenate(ids), starts, lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: none), and each text's end among them after a leading 0."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        seen = split.flatten().dictionary_encode()
        ids, starts, lengths = self._parts(seen.dictionary)
        place = seen.indices.to_numpy()
        found = ids[ragged(starts[place], lengths[place])]
        return found, np.concatenate([[0], np.cumsum(lengths[place])])[split.offsets.to_numpy()]


def encoder(content: str) -> WordEncoder:
    """This worker's encoder, made once for each tokenizer."""
    return held(("words", hashlib.sha256(content.encode()).digest()), lambda: WordEncoder(content))


def pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """A table with a row per piece: id, piece, start, length, ids_crc32, ids (if kept), part (the task) and nth (of its length there)."""
    content = read_tokenizer(tokenizer_path)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = dict(slim.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, use, seen = TaskContext.get().partitionId(), encoder(content), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for some in slices(batch, 1, SLICE_BYTES):
                ids, ends = use.encode(some.column(1))
                ids = np.insert(ids, ends[1:], end_id).astype("<u4")
                ends = ends + np.arange(len(ends))
                sizes = np.diff(ends)
                counts = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), counts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * capacity
                length = np.minimum(capacity, sizes[doc] - start)
                order = np.argsort(length, kind="stable")
                among = np.empty(len(doc), np.int64)
                same = np.bincount(length, minlength=capacity + 1)
                among[order] = np.arange(len(doc)) - np.repeat(np.cumsum(same) - same, same)
                nth, seen = seen[length] + among, seen + same
                raw, low = ids.tobytes(), 4 * (ends[doc] + start)
                bodies = [raw[a:b] for a, b in zip(low.tolist(), (low + 4 * length).tolist(), strict=True)]
                columns = [some.column(0).take(pa.array(doc)), *map(pa.array, (piece.astype(np.int32), start, length))]
                columns += [pa.array([zlib.crc32(x) for x in bodies], pa.int64()), pa.array(bodies if keep_ids else [None] * len(doc), pa.binary())]
                columns += [pa.array(np.full(len(doc), part, np.int32)), pa.array(nth)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32", "ids", "part", "nth"])

    schema = f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, part int, nth bigint"
    return cut(small_batches(slim).mapInArrow(run, schema))


class _Gaps:
    """Groups of sequences (first number, how many) by their free tokens."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.groups: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def add(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if not self.groups[gap]:
                insort(self.sizes, gap)
            self.groups[gap].append((first, n))

    def tightest(self, size: int) -> tuple[int, int, int] | None:
        k = bisect_left(self.sizes, size)
        if k == len(self.sizes):
            return None
        gap = self.sizes[k]
        first, n = self.groups[gap].pop()
        if not self.groups[gap]:
            self.sizes.pop(k)
        return gap, first, n


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Steps of the packing as rows (length, first, per, sequence, behind), by length and first, and the number of sequences.

    The items of a length from rank `first` on go `per` to a sequence, from number `sequence` on, behind so many tokens.
    """
    steps: list[tuple[int, int, int, int, int]] = []
    placed: dict[int, int] = defaultdict(int)
    gaps, sequences = _Gaps(), 0

    def put(length: int, n: int, per: int, sequence: int, behind: int) -> None:
        steps.append((length, placed[length], per, sequence, behind))
        placed[length] += n

    left = {x: n for x, n in counts.items() if 3 * x > capacity and n}
    waiting = sorted(left)
    while waiting:
        a = waiting[-1]
        k = bisect_right(waiting, min(a, capacity - a)) - 1
        if k >= 0 and waiting[k] == a and left[a] == 1:
            k -= 1
        b = waiting[k] if k >= 0 else None
        n = left[a] if b is None else left[a] // 2 if a == b else min(left[a], left[b])
        put(a, n, 1, sequences, 0)
        left[a] -= n
        if b is not None:
            put(b, n, 1, sequences, a)
            left[b] -= n
        gaps.add(capacity - a - (b or 0), sequences, n)
        sequences += n
        waiting = [x for x in waiting if left[x]] if not left[a] or b is not None and not left[b] else waiting
    for size in sorted((x for x, n in counts.items() if 3 * x <= capacity and n), reverse=True):
        n = counts[size]
        while n:
            found = gaps.tightest(size)
            if found is None:
                per = capacity // size
                found = capacity, sequences, -(-n // per)
                sequences += found[2]
            gap, first, bins = found
            per = gap // size
            full = min(bins, n // per)
            if full:
                put(size, full * per, per, first, capacity - gap)
                gaps.add(gap - per * size, first, full)
                n -= full * per
            if full < bins and n:  # fewer than `per` are left
                put(size, n, n, first + full, capacity - gap)
                gaps.add(gap - n * size, first + full, 1)
                n, full = 0, full + 1
            gaps.add(gap, first + full, bins - full)
    return np.array(sorted(steps), np.int64).reshape(-1, 5), sequences


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The table of `pieces` with sequence_id and offset in place of part and nth."""
    here = found.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    here = cut(here.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    # At most `capacity` rows.
    counts = {r.length: r.n for r in here.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps, _ = plan(counts, capacity)
    key = steps[:, 0] << 48 | steps[:, 1]
    per, sequence, behind = steps[:, 2], steps[:, 3], steps[:, 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(key, length << 48 | rank, side="right") - 1
            k = rank - steps[at, 1]
            columns = [batch.column(c) for c in names] + [pa.array(sequence[at] + k // per[at]), pa.array(behind[at] + k % per[at] * length)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    names = [c for c in found.columns if c not in ("part", "nth")]
    ranked = found.join(here.select("part", "length", "before"), ["part", "length"])
    ranked = ranked.select(*names, (F.col("before") + F.col("nth")).alias("rank"))
    schema = ranked.drop("rank").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    return small_batches(ranked).mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """Of pieces packed with their ids: a row per sequence with sequence_id, n_tokens and ids (little-endian, 32 bits each)."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # a sequence has `capacity` pieces at most
    whole = F.aggregate(F.col("inside"), F.lit(b"").cast("binary"), lambda all_, x: F.concat(all_, x.ids))
    grouped = packed.groupBy("sequence_id").agg(inside.alias("inside"), F.sum("length").alias("n_tokens"))
    return grouped.select("sequence_id", "n_tokens", whole.alias("ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    packed = pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
    return packed.drop("ids").withColumnRenamed("id", "doc_id")

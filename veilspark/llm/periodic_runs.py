"""Periodic runs of words, by an enhanced suffix array and its branching tandem test.

A run is a stretch of words with smallest period q that no neighbouring word extends keeping q, at least
`least` words and `times` periods long. For each batch of documents:

1. Symbols are ranks of (document, word), so the suffixes of one document stand together in the suffix array
   of the whole batch, and common prefixes end where a document ends.
2. The suffix array comes from prefix doubling over groups that still hold several suffixes; common
   prefixes from the permuted array: only irreducible ones are compared, the others follow from them.
3. Every entry of the common-prefix array, of value d, parts its interval in two. The suffixes i of the smaller
   side are tested: if ISA[i + d] or ISA[i - d] lies on the other side, i and that suffix share exactly d
   words, so a square of period d stands there that can't be moved right. Intervals are two bounds, found
   with a stack in one pass; there are no tree nodes.
4. Squares are rotated left while the words d apart are equal. Of squares with the same end the shortest
   period is rotated first, and those that its run covers with a multiple of the period are part of it.

What a task holds is one slice of documents (SLICE_WORDS words, or one longer document) and arrays over it.

Defined cases: a null or empty text, or one of white space only, has no words and no runs and collapses to
an empty text; rows with equal or null ids are rows of their own; an empty table gives an empty result; other
columns are left out, so their names can't clash.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm.arrow import small_batches
from veilspark.llm.pieces import ragged
from veilspark.plans.frames import read_table

#: A run has at least so many words, and so many periods.
LEAST, TIMES = 24, 3
#: Words handled at once; a longer document is a slice of its own.
SLICE_WORDS = 1 << 18
#: Steps that are taken for all comparisons at once, before those that go on are taken one by one.
STEPS = 24

RUNS_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in ascending order, by prefix doubling over the groups that are not told apart yet."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    fresh = np.concatenate([[True], symbols[order[1:]] != symbols[order[:-1]]])
    slots = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(fresh, slots, 0))
    width = 1
    while True:
        last = np.append(fresh[1:], True)
        slots = slots[~(fresh & last)]  # slots of groups with several suffixes
        if not len(slots):
            return order
        members = order[slots]
        after = members + width
        key = rank[members] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        members, key = members[by], key[by]
        order[slots] = members
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        rank[members] = np.maximum.accumulate(np.where(fresh, slots, 0))
        width *= 2


def _common(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many symbols are equal from a and b on, going right (step 1) or left (step -1)."""
    n = len(symbols)
    room = (n - np.maximum(a, b)) if step > 0 else np.minimum(a, b) + 1
    found = np.minimum(room, STEPS)
    active = np.arange(len(a))
    for offset in range(STEPS):
        inside = active[room[active] > offset]
        differ = symbols[a[inside] + step * offset] != symbols[b[inside] + step * offset]
        found[inside[differ]] = offset
        active = inside[~differ]
        if not len(active):
            break
    for k in active.tolist():
        x, y, most, done, size = int(a[k]), int(b[k]), int(room[k]), STEPS, 64
        while done < most:
            size = min(size, most - done)
            if step > 0:
                differ = symbols[x + done : x + done + size] != symbols[y + done : y + done + size]
            else:
                differ = symbols[x - done - size + 1 : x - done + 1][::-1] != symbols[y - done - size + 1 : y - done + 1][::-1]
            at = int(differ.argmax())
            if differ[at]:
                done += at
                break
            done, size = done + size, size * 2
        found[k] = done
    return found


def common_prefixes(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """By place in the suffix array: the common prefix of a suffix and the one before it (0 for the first)."""
    n = len(symbols)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    follows = np.zeros(n, bool)  # its common prefix is that of the suffix to its left, less one
    follows[1:] = (before[1:] > 0) & (symbols[:-1] == symbols[before[1:] - 1])
    own = np.flatnonzero(~follows)
    known = np.zeros(n, np.int64)
    some = own[before[own] >= 0]
    known[some] = _common(symbols, some, before[some], 1)
    at = np.maximum.accumulate(np.where(follows, 0, np.arange(n)))
    return (known[at] - (np.arange(n) - at))[order]


def _sides(prefixes: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each entry above 0: the entry, its value, where its interval begins, and where it ends."""
    at = np.flatnonzero(prefixes)
    values = prefixes[at].tolist()
    places = at.tolist()
    begins, ends = [0] * len(values), [0] * len(values)
    stack: list[int] = []
    previous = -2
    for k, (place, value) in enumerate(zip(places, values, strict=True)):
        if place != previous + 1:  # an entry of 0 stands between
            for x in stack:
                ends[x] = previous + 1
            stack = []
        low = place - 1
        while stack and values[stack[-1]] >= value:
            x = stack.pop()
            ends[x] = place
            low = begins[x]
        begins[k] = low
        stack.append(k)
        previous = place
    for x in stack:
        ends[x] = previous + 1
    return at, prefixes[at], np.array(begins, np.int64), np.array(ends, np.int64)


def _squares(order: np.ndarray, prefixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of squares that can't be moved right."""
    n = len(order)
    at, depth, begin, end = _sides(prefixes)
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    left = at - begin <= end - at  # the smaller side
    low, high = np.where(left, begin, at), np.where(left, at, end)
    other_low, other_high = np.where(left, at, begin), np.where(left, end, at)
    size = high - low
    node = np.repeat(np.arange(len(at)), size)
    suffix = order[ragged(low, size)]
    period, other_low, other_high = depth[node], other_low[node], other_high[node]
    starts, periods = [], []
    for step in (1, -1):
        mate = suffix + step * period
        place = inverse[np.clip(mate, 0, n - 1)]
        found = (mate >= 0) & (mate < n) & (place >= other_low) & (place < other_high)
        starts.append(np.minimum(suffix, mate)[found])
        periods.append(period[found])
    return np.concatenate(starts), np.concatenate(periods)


def runs(symbols: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """All runs as rows (start, length, period), by start, then period."""
    if len(symbols) < 2:
        return np.zeros((0, 3), np.int64)
    order = suffix_order(symbols)
    start, period = _squares(order, common_prefixes(symbols, order))
    end = start + 2 * period
    by = np.lexsort((period, end))
    start, period, end = start[by], period[by], end[by]
    kept = []
    while len(end):
        first = np.concatenate([[True], end[1:] != end[:-1]])
        s, p, e = start[first], period[first], end[first]
        inside = np.flatnonzero(s > 0)
        moved = np.zeros(len(s), np.int64)
        moved[inside] = _common(symbols, s[inside] - 1, s[inside] - 1 + p[inside], -1)
        s = s - moved
        kept.append(np.column_stack([s, e - s, p]))
        group = np.cumsum(first) - 1
        rest = ~first & ~((period % p[group] == 0) & (start >= s[group]))
        start, period, end = start[rest], period[rest], end[rest]
    found = np.concatenate(kept) if kept else np.zeros((0, 3), np.int64)
    found = found[(found[:, 1] >= least) & (found[:, 1] >= times * found[:, 2])]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and each text's end among them after a leading 0."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, ends = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    return flat.filter(pa.array(full)), np.concatenate([[0], np.cumsum(full)])[ends]


def _slices(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    start, n = 0, len(ends) - 1
    while start < n:
        stop = max(start + 1, bisect_right(ends, ends[start] + most) - 1)
        yield start, stop
        start = stop


def _of_documents(texts: pa.Array, least: int, times: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """By text: how many words, its runs, its words without those that repeat a period."""
    words, ends = _words(texts)
    runs_of, collapsed = [], []
    for a, b in _slices(ends, SLICE_WORDS):
        some, stops = words.slice(ends[a], ends[b] - ends[a]), ends[a : b + 1] - ends[a]
        coded = some.dictionary_encode()
        doc = np.repeat(np.arange(b - a), np.diff(stops))
        codes = coded.indices.to_numpy().astype(np.int64)
        _, symbols = np.unique(doc * (len(coded.dictionary) + 1) + codes, return_inverse=True)
        found = runs(symbols, least, times)
        of = doc[found[:, 0]]
        edges = np.searchsorted(of, np.arange(b - a + 1))
        columns = [pa.array(found[:, 0] - stops[of]), pa.array(found[:, 1]), pa.array(found[:, 2])]
        listed = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
        runs_of.append(listed.cast(RUNS_TYPE))
        depth = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(depth, found[:, 0] + found[:, 2], 1)
        np.add.at(depth, found[:, 0] + found[:, 1], -1)
        stays = np.cumsum(depth[:-1]) == 0
        kept = np.concatenate([[0], np.cumsum(stays)])[stops]
        rest = pa.LargeListArray.from_arrays(pa.array(kept), some.filter(pa.array(stays)))
        collapsed.append(pc.binary_join(rest, pa.scalar(" ", some.type)))
    return np.diff(ends), pa.chunked_array(runs_of, RUNS_TYPE).combine_chunks(), pa.chunked_array(collapsed, pa.large_string()).combine_chunks()


def find(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """One row per document: id, n_words, runs (start, length, period; by start, then period), collapsed."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = dict(slim.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, found, rest = _of_documents(batch.column(1), least, times)
                columns = [batch.column(0), pa.array(n), found, rest.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])

    schema = f"id {id_type}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return small_batches(slim).mapInArrow(run, schema)


def strongest(found: Column) -> Column:
    """The run with the greatest length / period, compared as fractions; ties: smallest start, then period."""

    def better(best: Column, x: Column) -> Column:
        more = x.length * best.period > best.length * x.period
        return F.when(best.isNull() | more, x).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(found, none, better)  # by start, then period, so the first of equals stays


def with_repeats(docs: DataFrame) -> DataFrame:
    """The texts of the query: those whose id's checksum ends in 0 are made periodic, from one of their words on.

    A row without an id keeps its text.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    rewritten = F.expr(
        "concat_ws(' ', transform(words, (w, i) -> "
        "CASE WHEN i < a THEN w ELSE words[CAST(a + pmod(i - a, 1 + (n - a) div (3 + pmod(g, 8))) AS INT)] END))"
    )
    some = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.pmod("h", F.lit(10)) == 0, words))
    some = some.withColumns({"n": F.size("words").cast("long"), "g": F.expr("h div 10")}).withColumn("a", F.when(F.col("n") > 0, F.pmod("g", "n")))
    return some.select("doc_id", F.when(F.col("n") > 0, rewritten).otherwise(F.col("text")).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(with_repeats(read_table(spark, sf_dir, "documents", "doc_id", "text")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("best", strongest(F.col("runs"))).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.encode(lines, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode(F.col("collapsed"), "UTF-8"), 256).alias("collapsed_sha256"),
    )

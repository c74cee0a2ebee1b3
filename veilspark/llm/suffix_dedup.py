"""Removal of byte strings that also start in an earlier document, by suffix arrays of shards.

A shard holds the suffixes that may match each other: every `length`-byte window is dealt by its
minimizer, the least hash among the PART-byte strings in it, which equal windows share. Runs of
windows with one minimizer travel as one piece of text. Minimizers that occur in one document only
are settled by counting (packets.py) and their windows go nowhere. A minimizer of very many
documents is dealt by the hash of each whole window instead, so no shard grows with its documents.

Within a shard each distinct piece of text occurs once, with the smallest id of its documents; a piece
whose minimizer no other piece has can meet none and is left out. The shard's suffix array is built by induced sorting; equal windows are neighbours there whose permuted common
prefix reaches `length`, and the smallest id among them decides. Batches send each distinct piece
once, and get back for it one bit for each window: whether a smaller id than its own has it.

Defined cases: a null text is empty; null ids are smaller than all others; rows with equal ids are
not earlier than each other; matches are of bytes and may begin or end within a character; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm import packets
from veilspark.llm.arrow import forget
from veilspark.llm.suffix_array import permuted_common_prefixes, suffix_array
from veilspark.plans.frames import read_table

LENGTH = 50
#: Bytes of a minimizer. Shorter ones make longer runs, so less text is sent twice; the bits of a run's windows must fit 32.
PART = 20
#: A minimizer of more documents is dealt by whole windows.
HOT = 5_000
#: Bytes of text handled at once, and bits that tell places within them.
CHUNK, PLACE_BITS = 1 << 20, 24
#: Bytes of text for each shard, which gets about as many of pieces: sorting them in one array takes less time than in many.
SHARD_BYTES = 6 << 20
WINDOWS = LENGTH - PART + 1
WIDE = LENGTH + WINDOWS + 7 & ~7  # bytes of the longest piece, rounded up to whole words
_NULL_ID = np.iinfo(np.int64).min


class Batch:
    """The documents of a batch as one array of bytes."""

    def __init__(self, table: pa.Table) -> None:
        rows = [(i, t.encode()) for i, t in packets.texts(table)]
        self.ids = [i for i, _ in rows]
        self.order = np.array([_NULL_ID if i is None else i for i in self.ids], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for _, t in rows], dtype=np.int64)]).astype(np.int64)
        self.data = np.frombuffer(b"".join(t for _, t in rows) + bytes(WIDE), np.uint8)

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, places, side="right") - 1

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows and minimizer of each run."""
        parts = list(self._chunks())
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _chunks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        size = int(self.bounds[-1])
        at = 0
        while size - at >= LENGTH:
            end = min(size, at + CHUNK)
            yield self._chunk(at, end)
            at = end - LENGTH + 1

    def _chunk(self, at: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = string_hashes(self.data[at:end], PART)
        low = h & ~np.uint64((1 << PLACE_BITS) - 1) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= WINDOWS:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: len(low) - (WINDOWS - width)], low[WINDOWS - width :])
        place = (low & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        crossing = np.zeros(len(place) + 1, np.int32)  # windows that reach into the next document
        first, last = np.searchsorted(self.bounds, at, side="right"), np.searchsorted(self.bounds, end)
        ends = self.bounds[first : last + 1] - at
        starts = np.maximum(ends - LENGTH + 1, self.bounds[first - 1 : last] - at)
        np.add.at(crossing, np.clip(starts, 0, len(place)), 1)
        np.add.at(crossing, np.clip(ends, 0, len(place)), -1)
        whole = np.cumsum(crossing[:-1]) == 0
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (whole[1:] != whole[:-1])]))
        sizes = np.diff(np.append(new, len(place)))
        good = whole[new]
        new, sizes = new[good], sizes[good]
        return at + new, sizes, h[place[new]]

    def hashes(self) -> np.ndarray:
        """Minimizers, distinct within each document."""
        first, _, h = self.runs()
        doc = self.document(first)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        return h[np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])] if len(h) else h

    def pieces(self, known: packets.Shared, shards: int) -> Pieces:
        """Distinct pieces of text that other documents may have, and where they occur."""
        first, sizes, h = self.runs()
        count = known.count(h)
        some, hot = (count > 1) & (count <= HOT), count > HOT
        # Windows of hot minimizers go alone.
        alone = np.repeat(first[hot], sizes[hot]) + _ranks(sizes[hot])
        first = np.concatenate([first[some], alone])
        windows = np.concatenate([sizes[some], np.ones(len(alone), np.int64)])
        own = packets.mixed(h[some] ^ np.uint64(0x5851F42D4C957F2D))
        records = records_at(self.data, first, windows + LENGTH - 1)
        content = hash_records(records, windows)
        key = np.concatenate([own, packets.mixed(content[len(own) :])])
        shard = packets.bucket_of(key, shards).astype(np.int64)
        kept, which = distinct(records, content)
        least = np.full(len(kept), np.iinfo(np.int64).max)
        np.minimum.at(least, which, self.order[self.document(first)])
        return Pieces(first, windows, which, records[kept], windows[kept], least, shard[kept], key[kept].astype(np.uint32))


class Pieces:
    def __init__(self, first, windows, which, records, record_windows, least, shard, key) -> None:  # noqa: ANN001
        self.first, self.windows, self.which = first, windows, which  # of each occurrence
        self.records, self.record_windows, self.least, self.shard = records, record_windows, least, shard  # of each piece
        self.key = key  # of what the piece was dealt by
        self.order = np.argsort(shard, kind="stable")
        ordered = shard[self.order]
        self.edges = np.flatnonzero(np.diff(ordered, prepend=-1, append=-2)) if len(shard) else np.zeros(1, np.int64)

    def send(self, batch: int) -> pa.Table:
        rows, shards = [], []
        for a, z in zip(self.edges, self.edges[1:], strict=False):
            mine = self.order[a:z]
            lengths = self.record_windows[mine] + LENGTH - 1
            text = self.records[mine][np.arange(WIDE) < lengths[:, None]]
            rows.append(lengths.astype(np.uint8).tobytes() + self.least[mine].tobytes() + self.key[mine].tobytes() + text.tobytes())
            shards.append(int(self.shard[mine[0]]))
        sizes = np.diff(self.edges).tolist()
        heads = [n.to_bytes(4, "little") for n in sizes]
        return pa.table({
            "b": pa.array([batch] * len(rows), pa.int64()), "bucket": pa.array(shards, pa.int64()),
            "payload": pa.array([h + r for h, r in zip(heads, rows, strict=True)], pa.binary()),
        })

    def bits(self, answers: dict[int, bytes]) -> np.ndarray:
        """Of each piece, the windows that a smaller id than its own has."""
        found = np.zeros(len(self.order), np.uint32)
        for a, z in zip(self.edges, self.edges[1:], strict=False):
            mine = self.order[a:z]
            found[mine] = np.frombuffer(answers[int(self.shard[mine[0]])], np.uint32)
        return found


def string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """The hash of the `length` bytes at each place, put together from strings of powers of two."""
    power = data.astype(np.uint64) + np.uint64(1)  # of `width` bytes
    factor, width = 0x9E3779B97F4A7C15, 1
    found, done = None, 0
    while True:
        if length & width:
            if found is None:
                found = power
            else:
                n = min(len(found), len(power) - done)
                found = found[:n] * np.uint64(factor) + power[done : done + n]
            done += width
        if 2 * width > length:
            return packets.mixed(found[: len(data) - length + 1])
        power = power[:-width] * np.uint64(factor) + power[width:]
        factor, width = factor * factor % (1 << 64), 2 * width


def _ranks(sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def records_at(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A row of WIDE bytes for each piece, zeros after its end."""
    rows = np.lib.stride_tricks.sliding_window_view(data, WIDE)[starts]
    rows[np.arange(WIDE) >= lengths[:, None]] = 0
    return rows


def hash_records(records: np.ndarray, windows: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(records).view(np.uint64)
    h = windows.astype(np.uint64)
    for j in range(words.shape[1]):
        h = packets.mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[:, j])
    return h


def distinct(records: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that stand for equal ones, and for each row which of them. Rows of equal hash but other bytes stand alone."""
    _, kept, which = np.unique(content, return_index=True, return_inverse=True)
    odd = np.flatnonzero((records != records[kept[which]]).any(axis=1)) if len(records) else np.zeros(0, np.int64)
    which[odd] = len(kept) + np.arange(len(odd))
    return np.concatenate([kept, odd]), which


def _settle(table: pa.Table) -> pa.Table:
    """One shard: for each packet of pieces, the bits of their windows."""
    lengths, least, keys, texts, sizes = [], [], [], [], []
    for payload in table.column("payload").to_pylist():
        n = int.from_bytes(payload[:4], "little")
        lengths.append(np.frombuffer(payload, np.uint8, n, 4))
        least.append(np.frombuffer(payload, np.int64, n, 4 + n))
        keys.append(np.frombuffer(payload, np.uint32, n, 4 + 9 * n))
        texts.append(np.frombuffer(payload, np.uint8, offset=4 + 13 * n))
        sizes.append(n)
    length, own = np.concatenate(lengths).astype(np.int64), np.concatenate(least)
    text = np.concatenate([*texts, np.zeros(WIDE, np.uint8)])
    windows = length - LENGTH + 1
    records = records_at(text, np.cumsum(length) - length, length)
    kept, which = distinct(records, hash_records(records, windows))
    least_ = np.full(len(kept), np.iinfo(np.int64).max)
    np.minimum.at(least_, which, own)
    best = np.repeat(least_[:, None], WINDOWS, axis=1)
    # A piece dealt by a minimizer that no other piece has holds no other piece's window.
    _, mate, mates = np.unique(np.concatenate(keys)[kept], return_inverse=True, return_counts=True)
    some = np.flatnonzero(mates[mate] > 1)
    if len(some):
        best[some] = least_of_windows(records[kept[some]], length[kept[some]], least_[some])
    best[np.arange(WINDOWS) >= windows[kept][:, None]] = np.iinfo(np.int64).max
    smaller = best[which] < own[:, None]
    bits = (smaller.astype(np.uint32) << np.arange(WINDOWS, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)
    rows, at = [], 0
    for n in sizes:
        rows.append(bits[at : at + n].tobytes())
        at += n
    return pa.table({"b": table.column("b"), "bucket": table.column("bucket"), "payload": pa.array(rows, pa.binary())})


def least_of_windows(records: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """(piece, window): the smallest id among all pieces of the shard that hold the same window."""
    # UTF-8 has no byte 255: pieces end with one, and bytes are raised by 1 so that 0 can end all.
    ended = np.concatenate([records + np.uint8(1), np.zeros((len(records), 1), np.uint8)], axis=1)
    ended[np.arange(len(records)), lengths] = 255
    text = np.append(ended[np.arange(WIDE + 1) <= lengths[:, None]], np.uint8(0))
    starts = np.cumsum(lengths + 1) - lengths - 1
    windows = lengths - LENGTH + 1
    order = suffix_array(text, 256)
    prefixes = permuted_common_prefixes(text, order, LENGTH)
    group = np.cumsum(prefixes[order] < LENGTH)
    piece = np.repeat(np.arange(len(records)), windows)
    offset = _ranks(windows)
    of_place = np.full(len(text), -1, np.int64)
    of_place[starts[piece] + offset] = np.arange(len(piece))
    here = of_place[order]
    group, here = group[here >= 0], here[here >= 0]
    least = np.full(int(group[-1]) + 1 if len(group) else 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, ids[piece[here]])
    best = np.full((len(records), WINDOWS), np.iinfo(np.int64).max)
    best[piece[here], offset[here]] = least[group]
    return best


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's id, n_bytes, removed spans (start, end in bytes) and the bytes kept. Ids are of type long."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = packets.layout(texts, "text", 10.0)
    shards = size.batches * packets.BATCH_BYTES // SHARD_BYTES
    base = texts.withColumn("b", packets.batch_of(F.col("id"), size.batches))
    grouped = base.groupBy("b")

    def batch_id(table: pa.Table) -> int:
        return table.column("b")[0].as_py()

    def send(table: pa.Table) -> pa.Table:
        forget()
        return packets.packets(batch_id(table), Batch(table).hashes(), size.buckets)

    def split(answers: pa.Table) -> tuple[packets.Shared, dict[int, bytes]]:
        late = pa.compute.less(answers.column("bucket"), 0)
        settled = answers.filter(late)
        found = zip(settled.column("bucket").to_pylist(), settled.column("payload").to_pylist(), strict=True)
        return packets.Shared(answers.filter(pa.compute.invert(late)), size.buckets), {-1 - k: v for k, v in found}

    def send_pieces(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"b": pa.array([], pa.int64()), "bucket": pa.array([], pa.int64()), "payload": pa.array([], pa.binary())})
        return Batch(table).pieces(split(answers)[0], shards).send(batch_id(table))

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        batch = Batch(table)
        known, settled = split(answers)
        pieces = batch.pieces(known, shards)
        doc = batch.document(pieces.first)
        later = batch.order[doc] > pieces.least[pieces.which]
        bits = pieces.bits(settled)[pieces.which]
        change = np.zeros(len(batch.data) + 1, np.int32)
        np.add.at(change, pieces.first[later], 1)
        np.add.at(change, pieces.first[later] + pieces.windows[later] + LENGTH - 1, -1)
        some = np.flatnonzero(~later & (bits > 0))
        piece, offset = np.nonzero(np.unpackbits(bits[some].astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little"))
        at = pieces.first[some[piece]] + offset
        change[: len(batch.data)] += np.bincount(at, minlength=len(batch.data)).astype(np.int32)
        change[: len(batch.data)] -= np.bincount(at + LENGTH, minlength=len(batch.data)).astype(np.int32)
        removed = np.cumsum(change[:-1]) > 0
        spans, kept = [], []
        for a, z in zip(batch.bounds, batch.bounds[1:], strict=False):
            edges = np.flatnonzero(np.diff(removed[a:z].astype(np.int8), prepend=0, append=0))
            spans.append([{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()])
            kept.append(batch.data[a:z][~removed[a:z]].tobytes() if len(edges) else batch.data[a:z].tobytes())
        span = pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()}))
        return pa.table({
            "id": pa.array(batch.ids, pa.int64()), "n_bytes": pa.array(np.diff(batch.bounds)),
            "spans": pa.array(spans, span), "kept": pa.array(kept, pa.binary()),
        })

    known = packets.shared(grouped.applyInArrow(send, packets.PACKET))
    sent = grouped.cogroup(known.groupBy("b")).applyInArrow(send_pieces, packets.PACKET)
    settled = sent.groupBy("bucket").applyInArrow(_settle, packets.PACKET)
    answers = known.unionByName(settled.withColumn("bucket", -1 - F.col("bucket")))
    schema = "id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
    return grouped.cogroup(answers.groupBy("b")).applyInArrow(finish, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )

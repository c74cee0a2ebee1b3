"""Counting hashed features of all documents, packed: which occur in several documents, and in how many.

Documents are dealt by a hash of their id to batches of about BATCH_BYTES. A batch sends each of its
distinct hashes once, with the number of its documents that have it, in packets: one for each bucket
of the hash space. So a hash that occurs in a third of all documents comes to its bucket once from
each batch. The bucket adds the numbers up and answers each batch with those of its hashes that
occur twice or more. Within a bucket a hash is told by 32 further bits; a rare clash of these makes
a number too large, never too small, and is the same for all batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20
#: Hashes of a bucket, about.
BUCKET_HASHES = 1_000_000
PACKET = "b bigint, bucket bigint, payload binary"


@dataclass(frozen=True)
class Layout:
    batches: int
    buckets: int


def layout(docs: DataFrame, text_col: str, bytes_a_hash: float) -> Layout:
    """Numbers of batches and buckets in proportion to the bytes of all texts."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    return Layout(int(total // BATCH_BYTES) + 1, int(total / bytes_a_hash // BUCKET_HASHES) + 1)


def batch_of(id_: Column, batches: int) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(batches))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def key_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and the 32 bits by which a hash is told within it."""
    return bucket_of(hashes, buckets) << np.uint64(32) | (hashes & np.uint64(0xFFFFFFFF))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packets(batch: int, hashes: np.ndarray, buckets: int) -> pa.Table:
    """hashes: of all documents of the batch, distinct within each document."""
    keys, counts = np.unique(key_of(hashes, buckets), return_counts=True)
    bucket = (keys >> np.uint64(32)).astype(np.int64)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)) if len(keys) else np.zeros(1, np.int64)
    low, counts = keys.astype(np.uint32), np.minimum(counts, 255).astype(np.uint8)
    rows = [low[a:z].tobytes() + counts[a:z].tobytes() for a, z in zip(edges, edges[1:], strict=False)]
    return pa.table({"b": pa.array([batch] * len(rows), pa.int64()), "bucket": pa.array(bucket[edges[:-1]]), "payload": pa.array(rows, pa.binary())})


def _add_up(table: pa.Table) -> pa.Table:
    lows, counts, sizes = [], [], []
    for payload in table.column("payload").to_pylist():
        n = len(payload) // 5
        lows.append(np.frombuffer(payload, np.uint32, n))
        counts.append(np.frombuffer(payload, np.uint8, n, 4 * n))
        sizes.append(n)
    low, count = np.concatenate(lows), np.concatenate(counts).astype(np.int64)
    order = np.argsort(low, kind="stable")
    first = np.flatnonzero(np.diff(low[order], prepend=np.uint32(~low[order[0]])))
    sums = np.add.reduceat(count[order], first)
    total = np.empty(len(low), np.int64)
    total[order] = np.repeat(sums, np.diff(first, append=len(low)))
    rows, at = [], 0
    for n in sizes:
        several = total[at : at + n] > 1
        rows.append(low[at : at + n][several].tobytes() + np.minimum(total[at : at + n][several], 2**32 - 1).astype(np.uint32).tobytes())
        at += n
    return pa.table({"b": table.column("b"), "bucket": table.column("bucket"), "payload": pa.array(rows, pa.binary())})


def shared(sent: DataFrame) -> DataFrame:
    """Answers to the packets, of the same columns."""
    return sent.groupBy("bucket").applyInArrow(_add_up, PACKET)


class Shared:
    """A batch's hashes that occur in several documents, from the answers to it."""

    def __init__(self, answers: pa.Table, buckets: int) -> None:
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        for bucket, payload in zip(answers.column("bucket").to_pylist(), answers.column("payload").to_pylist(), strict=True):
            n = len(payload) // 8
            keys.append(np.uint64(bucket) << np.uint64(32) | np.frombuffer(payload, np.uint32, n).astype(np.uint64))
            counts.append(np.frombuffer(payload, np.uint32, n, 4 * n))
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key)
        self.keys, self.counts, self.buckets = key[order], count[order].astype(np.int64), buckets

    def count(self, hashes: np.ndarray) -> np.ndarray:
        """In how many documents each hash occurs."""
        if not len(self.keys):
            return np.ones(len(hashes), np.int64)
        key = key_of(hashes, self.buckets)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.counts[at], 1)


def texts(table: pa.Table) -> Iterator[tuple[object, str]]:
    """(id, text) of a batch in a fixed order, null texts as empty ones."""
    rows = zip(table.column("id").to_pylist(), table.column("text").to_pylist(), strict=True)
    return iter(sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])))


Function = Callable[[pa.Table, pa.Table], pa.Table]

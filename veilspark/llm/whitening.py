"""Whitening of embeddings, fitted on distinct vectors with their multiplicities.

1. Every entry c becomes the integer x = floor(1024 c) + 100000. A vector of them travels as bytes (`pack`), in
   the narrowest width that holds it, so equal vectors have equal bytes.
2. Distinct: equal vectors are grouped, with partial counts before the shuffle, so a vector in a third of all rows
   brings one row from each task. The fit weight of a distinct vector is its count, or one.
3. Fit: exact integer sums give the means. Then each task multiplies its centred vectors, weighted, with
   themselves; the products of all tasks are added up row by row of the matrix. The driver gets one d x d matrix
   and takes its eigenvectors, signed so that their largest entry is positive.
4. Whitening: each distinct vector once. The covariance of what comes out, about its own mean, is
   measured, not derived.
5. Join back: vectors that hold more than a thousandth of all rows are fewer than a thousand, so these
   are broadcast; the others meet their rows by the bytes themselves.

Defined cases: rows whose vector is null, or holds a null, an entry that is not finite, or one beyond LARGEST in
size, are left out; so are vectors of another length than the most frequent one (of equally frequent ones,
the longest), and empty ones; rows with equal or null ids are rows of their own; a component whose
variance is nothing but rounding has null `whitened` and no part in `identity_error`, which is null when there is
no other; without rows there is no result. Other columns are left out, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm.arrow import small_batches
from veilspark.plans.frames import cut, read_table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries beyond this have no exact place among doubles once scaled.
LARGEST = 2.0**40
#: A vector is broadcast with its results if more than one row in so many is of it.
HOT_SHARE = 1000
#: Vectors handled at once.
BLOCK = 8192
_WIDTHS = (np.int16, np.int32, np.int64)


def pack(x: np.ndarray) -> list[bytes]:
    """Each row of integers as bytes: the width, then the entries, little-endian, in the narrowest of 2, 4 or 8 bytes."""
    most = np.maximum(x.max(axis=1, initial=0), -1 - x.min(axis=1, initial=0))
    out: list[bytes] = [b""] * len(x)
    for k, kind in enumerate(_WIDTHS):
        low = np.iinfo(_WIDTHS[k - 1]).max if k else -1
        some = np.flatnonzero((most <= np.iinfo(kind).max) & (most > low))
        size = np.dtype(kind).itemsize
        raw = x[some].astype(f"<i{size}").tobytes()
        step = size * x.shape[1]
        for j, row in enumerate(some.tolist()):
            out[row] = bytes([size]) + raw[j * step : (j + 1) * step]
    return out


def unpack(packed: pa.Array, dims: int) -> np.ndarray:
    """Rows of `pack` as int64."""
    rows = packed.to_pylist()
    out = np.empty((len(rows), dims), np.int64)
    sizes = np.array([r[0] for r in rows], np.int64)
    for size in np.unique(sizes).tolist():
        some = np.flatnonzero(sizes == size)
        out[some] = np.frombuffer(b"".join(rows[k][1:] for k in some.tolist()), f"<i{size}").reshape(len(some), dims)
    return out


def packed_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, dims and x (packed, less SHIFT) of the rows that count."""
    slim = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("v IS NOT NULL AND size(v) > 0")
    id_type = dict(slim.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            values = pc.fill_null(lists.flatten(), float("nan")).to_numpy(zero_copy_only=False)
            ends = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
            good = np.logical_and.reduceat(np.abs(values) <= LARGEST, ends[:-1]) if len(values) else np.zeros(0, bool)
            sizes = np.diff(ends)
            for dims in np.unique(sizes[good]).tolist():
                some = np.flatnonzero(good & (sizes == dims))
                x = np.floor(SCALE * values[ends[some][:, None] + np.arange(dims)]).astype(np.int64)
                columns = [batch.column(0).take(pa.array(some)), pa.array(np.full(len(some), dims, np.int32)), pa.array(pack(x), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "dims", "x"])

    return small_batches(slim).mapInArrow(run, f"id {id_type}, dims int, x binary")


@dataclass(frozen=True)
class Fit:
    """n: weight of all vectors; sums: of their entries less SHIFT, exact; components: by falling variance, as rows."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def means(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def solid(self) -> np.ndarray:
        """Which components have a variance beyond rounding."""
        return self.variances > 1e-13 * max(self.trace, 0.0)


def _blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for k in range(0, batch.num_rows, BLOCK):
        some = batch.slice(k, BLOCK)
        yield some, unpack(some.column("x"), dims), some.column("weight").to_numpy()


def fit(distinct: DataFrame, dims: int, components: int = COMPONENTS) -> Fit:
    """From distinct vectors with their weights."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            for _, x, w in _blocks(batch, dims):
                n += int(w.sum())
                high += w @ (x >> 25)
                low += w @ (x & ((1 << 25) - 1))
        cells = {"j": pa.array(np.arange(dims)), "n": pa.array(np.full(dims, n)), "high": pa.array(high), "low": pa.array(low)}
        yield pa.RecordBatch.from_pydict(cells)

    sums = distinct.select("x", "weight").mapInArrow(add, "j bigint, n bigint, high bigint, low bigint")
    sums = sums.groupBy("j").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]).orderBy("j").collect()
    n = int(sums[0].n)
    total = tuple(int(r.high) * (1 << 25) + int(r.low) for r in sums)
    means = np.array([s / n for s in total])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product = np.zeros((dims, dims))
        for batch in batches:
            for _, x, w in _blocks(batch, dims):
                centred = x - means
                product += (centred * w[:, None]).T @ centred
        yield pa.RecordBatch.from_pydict({"j": pa.array(np.arange(dims)), "cells": pa.array(list(product), pa.list_(pa.float64()))})

    def add_up(group: pa.Table) -> pa.Table:
        cells = group.column("cells").combine_chunks().flatten().to_numpy().reshape(-1, dims)
        return pa.table({"j": group.column("j").slice(0, 1), "cells": pa.array([np.sort(cells, axis=0).sum(axis=0)], pa.list_(pa.float64()))})

    # One row of the matrix for each task in a group.
    rows = distinct.select("x", "weight").mapInArrow(multiply, "j bigint, cells array<double>")
    rows = rows.groupBy("j").applyInArrow(add_up, "j bigint, cells array<double>").orderBy("j").collect()
    covariance = np.array([r.cells for r in rows]) / n
    variances, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    chosen = vectors.T[::-1][:components]
    largest = np.abs(chosen).argmax(axis=1)
    chosen = chosen * np.sign(chosen[np.arange(len(chosen)), largest])[:, None]
    return Fit(n, total, chosen, variances[::-1][:components], float(np.trace(covariance)))


def _deviations(x: np.ndarray, fitted: Fit) -> pa.Array:
    """Exact sums over the dimensions of (n x - S)^2."""
    most = fitted.n * int(np.abs(x).max(initial=0)) + max(map(abs, fitted.sums))
    kind = np.int64 if most * most * x.shape[1] < 1 << 63 else object
    difference = x.astype(kind) * fitted.n - np.array(fitted.sums, kind)
    exact = (difference * difference).sum(axis=1)
    if kind is object:
        from decimal import Decimal

        return pa.array([Decimal(int(v)) for v in exact], pa.decimal128(38, 0))
    return pa.array(exact).cast(pa.decimal128(38, 0))


def whitened_distinct(distinct: DataFrame, dims: int, fitted: Fit) -> DataFrame:
    """x, weight, n_rows, deviation and whitened (an array, null where a component has no variance) of each distinct vector."""
    solid, means = fitted.solid, fitted.means
    base = (fitted.components[solid] / np.sqrt(fitted.variances[solid])[:, None]).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, x, _ in _blocks(batch, dims):
                values = np.zeros((len(x), len(solid)))
                values[:, solid] = (x - means) @ base
                flat = pa.array(values.ravel(), mask=np.tile(~solid, len(x)))
                listed = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(solid)), pa.int32()), flat)
                columns = [some.column("x"), some.column("weight"), some.column("n_rows"), _deviations(x, fitted), listed]
                yield pa.RecordBatch.from_arrays(columns, ["x", "weight", "n_rows", "deviation", "whitened"])

    schema = "x binary, weight bigint, n_rows bigint, deviation decimal(38,0), whitened array<double>"
    return cut(distinct.select("x", "weight", "n_rows").mapInArrow(run, schema))


def identity_error(whitened: DataFrame, fitted: Fit) -> float | None:
    """The largest entry, in size, of the whitened vectors' covariance less the identity."""
    solid = np.flatnonzero(fitted.solid).tolist()
    if not solid:
        return None
    w = F.col("weight")
    mean = whitened.agg(*[(F.sum(w * F.col("whitened")[k]) / F.sum(w)).alias(f"m{k}") for k in solid]).first()
    cells = [(i, j) for i in solid for j in solid if i <= j]

    def off(k: int) -> F.Column:
        return F.col("whitened")[k] - F.lit(mean[f"m{k}"])

    found = whitened.agg(*[(F.sum(w * off(i) * off(j)) / F.sum(w)).alias(f"c{i}_{j}") for i, j in cells]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in cells)


RESULT = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, weights: str = "counts"
) -> DataFrame:
    """A row for each remaining row and component. weights: "counts" fits on all rows, "one" on distinct vectors."""
    if weights not in ("counts", "one"):
        raise ValueError("weights: counts or one")
    spark = rows.sparkSession
    vectors = packed_vectors(rows, id_col, vector_col)
    distinct = cut(vectors.groupBy("dims", "x").agg(F.count(F.lit(1)).alias("n_rows")))
    # A row for each length that vectors have.
    lengths = distinct.groupBy("dims").agg(F.sum("n_rows").alias("n_rows")).orderBy(F.desc("n_rows"), F.desc("dims")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], f"id {dict(vectors.dtypes)['id']}, {RESULT}")
    dims, n_rows = lengths[0]
    weight = F.col("n_rows") if weights == "counts" else F.lit(1).cast("long")
    distinct = distinct.where(F.col("dims") == dims).select("x", "n_rows", weight.alias("weight"))
    fitted = fit(distinct, dims, components)
    whitened = whitened_distinct(distinct, dims, fitted)
    error = identity_error(whitened, fitted)

    vectors = vectors.where(F.col("dims") == dims).select("id", "x")
    results = whitened.select("x", "n_rows", "deviation", "whitened")
    hot = results.where(F.col("n_rows") * HOT_SHARE > n_rows).drop("n_rows")  # fewer than HOT_SHARE rows
    cold = results.where(F.col("n_rows") * HOT_SHARE <= n_rows).drop("n_rows")
    back = vectors.join(F.broadcast(hot), "x").unionByName(vectors.join(F.broadcast(hot.select("x")), "x", "left_anti").join(cold, "x"))
    explained = F.array(*[F.lit(float(v / fitted.trace) if fitted.trace > 0 else None) for v in fitted.variances])
    return back.select("id", "deviation", F.posexplode("whitened").alias("k", "whitened")).select(
        "id", (F.col("k") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("k")].alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `whiten`, with deviation as a long: null where a table is so large that it doesn't fit in one."""
    found = whiten(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return found.withColumnRenamed("id", "vec_id").withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veilspark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component int, x string"


def plain(rows, components=8):
    """By id and vector: the exact deviation and whitened values; and the explained shares. All rows at once."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept])
    n, sums = len(x), [sum(c) for c in zip(*x.tolist())]
    centred = (x.astype(object) * n - np.array(sums, object)).astype(float) / n
    covariance = centred.T @ centred / n
    e, vectors = np.linalg.eigh(covariance)
    e, vectors = e[::-1][:components], vectors.T[::-1][:components]
    out = [(i, sum((n * a - s) ** 2 for a, s in zip(v, sums)), vectors @ c / np.sqrt(np.where(e > 1e-13 * covariance.trace(), e, np.nan))) for (i, v), c in zip(kept, centred)]
    return n, out, e / covariance.trace()


def check(got, rows, components=8):
    n, want, explained = plain(rows, components)
    assert len(got) == len(want) * len(explained)
    by_id = defaultdict(lambda: defaultdict(list))
    for r in got:
        assert r.n == n
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-4, abs=1e-15)
        by_id[r.id][r.component].append((int(r.deviation), r.whitened))
    sign = {}
    want_by = defaultdict(list)
    for i, deviation, values in want:
        want_by[i].append((deviation, values))
    for i, listed in want_by.items():
        for k in range(1, len(explained) + 1):
            found = sorted(by_id[i][k], key=lambda p: (p[0], abs(p[1] or 0)))
            expected = sorted(((d, v[k - 1]) for d, v in listed), key=lambda p: (p[0], abs(p[1])))
            assert [d for d, _ in found] == [d for d, _ in expected]
            for (_, a), (_, b) in zip(found, expected):
                if math.isnan(b):
                    assert a is None
                    continue
                if abs(b) > 1e-3:
                    sign.setdefault(k, math.copysign(1, a * b))
                assert a == pytest.approx(sign.get(k, 1) * b, rel=1e-6, abs=1e-6)


def test_packed_vectors_come_back():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.integers(-200, 200, (5, 4)), rng.integers(-(2**30), 2**30, (5, 4)), rng.integers(-(2**50), 2**50, (5, 4)), [[-32768] * 4, [32767] * 4, [32768] * 4, [-32769] * 4]])
    packed = whitening.pack(x)
    assert (whitening.unpack(pa.array(packed), 4) == x).all()
    assert sorted({len(p) for p in packed}) == [9, 17, 33]


def test_odd_rows_and_a_hot_vector(spark, monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(whitening, "HOT_SHARE", 10)
    rows = [(i, (rng.normal(size=9) * np.arange(1, 10)).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(70)] + [(5, rows[7][1]), (5, rows[7][1]), (None, rows[9][1])]
    odd = [(900, None), (901, []), (902, [None] * 9), (903, [1.0] * 8 + [float("nan")]), (904, [float("inf")] * 9), (905, [1.0, 2.0]), (906, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "k") for i, v in rows + odd], SCHEMA).repartition(3)
    got = whitening.whiten(df).collect()
    check(got, rows)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-4
    ones = whitening.whiten(df, weights="one").collect()
    assert len(ones) == len(got) and {r.n for r in ones} == {120}


def test_large_entries_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=3) * 2.0**33).astype(np.float32).tolist()) for i in range(50)]
    check(whitening.whiten(spark.createDataFrame([(i, v, 1, "k") for i, v in rows], SCHEMA)).collect(), rows)
    far = spark.createDataFrame([(i, v, 1, "k") for i, v in [*rows, (99, [1e30, 0.0, 0.0])]], SCHEMA)
    assert whitening.whiten(far).where("id = 99").count() == 0


def test_few_dimensions_no_variance_no_rows(spark):
    rows = [(i, [float(i), 0.5]) for i in range(6)]  # the second component is constant
    got = whitening.whiten(spark.createDataFrame([(i, v, 1, "k") for i, v in rows], SCHEMA)).collect()
    check(got, rows)
    assert sorted((r.component, r.whitened is None) for r in got) == [(1, False)] * 6 + [(2, True)] * 6
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 1, "k") for i in range(3)], SCHEMA)).collect()
    assert [(r.whitened, r.explained, r.identity_error, r.deviation) for r in same] == [(None, None, None, 0)] * 6
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 1, "k")], SCHEMA)).columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_query_against_plain(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = whitening.query(spark, sf_dir)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(got.select(F.col("vec_id").alias("id"), *got.columns[1:]).collect(), rows)
    assert got.agg(F.max("identity_error")).first()[0] < 1e-4

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from veilspark.llm import exact_dedup, sharding

ODD = [(5, "a"), (9, "a"), (None, "a"), (1, None), (2, ""), (7, "b"), (7, "b"), (3, "x" * 50_000), (None, "n"), (None, "n")]
SCHEMA = "doc_id long, text string, keep_id string, size int, salt int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, 2) for i, t in rows], SCHEMA).repartition(3)


def weak(text):
    return F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 1)


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, weak])
@pytest.mark.parametrize("salts", [1, 4])
def test_members(spark, digest, salts):
    rows = ODD + [(100 + i, f"text {i % 37}") for i in range(200)]
    got = exact_dedup.members(table(spark, rows), digest=digest, salts=salts).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    by_id = {i: g for g in groups.values() for i in g}
    for r in got:
        g = by_id[r.id] if r.id is not None else None
        if g:
            assert (r.keep_id, r.group_size) == (max((i for i in g if i is not None), default=None), len(g))
    assert sum(r.kept for r in got) == len(groups)


def test_keep_one_keeps_all_columns(spark):
    df = table(spark, ODD)
    got = exact_dedup.keep_one(df, salts=3)
    assert got.columns == df.columns
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in got.collect()) == sorted(
        [(9, "a"), (2, ""), (7, "b"), (3, "x" * 50_000), (-1, "n")]
    )
    assert exact_dedup.keep_one(df.limit(0)).count() == exact_dedup.members(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 30, 500])
def test_shards_are_contiguous_and_even(spark, n):
    rows = [(i * 7 % 501, "é" * (i * i % 97)) for i in range(n)] + ([(None, None), (3, "t"), (3, "t")] if n else [])
    got = sharding.assign(table(spark, rows), shards=5).collect()
    assert sorted((r.id is not None, r.id, r.size, r.text_crc32) for r in got) == sorted(
        (i is not None, i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows
    )
    ordered = sorted(got, key=lambda r: (r.shard, r.slot))
    ids = [-1 if r.id is None else r.id for r in ordered]
    assert ids == sorted(ids)
    total, largest = sum(r.size for r in got), max((r.size for r in got), default=0)
    for shard in {r.shard for r in got}:
        mine = [r for r in ordered if r.shard == shard]
        assert [r.slot for r in mine] == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - total / 5) <= largest


def test_written_shards(spark, tmp_path):
    rows = [(i, "w" * i, "k") for i in range(40)] + [(None, "n", "k"), (None, None, None), (1, "w", "k"), (1, "other", "l"), (2, "z" * 200_000, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, size string").repartition(3)
    sharding.write_shards(df, str(tmp_path / "s"), shards=4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(str, back.select("doc_id", "text", "size").collect())) == sorted(map(str, df.collect()))
    places = sorted((r.shard, r.slot) for r in back.collect())
    assert places == [(s, k) for s in sorted({s for s, _ in places}) for k in range(sum(x == s for x, _ in places))]
    with pytest.raises(ValueError):
        sharding.write_shards(df.withColumn("slot", F.lit(1)), str(tmp_path / "t"))


def test_shards_query_against_plain_prefix_sums(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = sharding.query(spark, sf_dir).collect()
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    total, at, slots, want = sum(len(t) + 8 for _, t in rows), 0, defaultdict(int), []
    for i, raw in rows:
        size = len(raw) + 8
        shard = min(23, (2 * at + size) * 24 // (2 * total))
        want.append((i, size, zlib.crc32(raw), "bytes", shard, slots[shard], None))
        slots[shard] += 1
        at += size
    assert sorted(map(tuple, got)) == want


def test_digest_is_of_utf8(spark):
    got = spark.createDataFrame([("é",)], "t string").select(exact_dedup.sha256_hex(F.col("t")).alias("x")).first().x
    assert got == hashlib.sha256("é".encode()).hexdigest()

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from veilspark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    None, "", " \t\n", "one", "x" * 30_000, "Ünïcode İstanbul ŁÓDŹ 'S it's I'LL 12345  x　y", "a\x00b \x00 \x00\x00 c", "no\x1cbreak \x85 x",
    "<|startoftext|> a<|endoftext|>b < | endoftext|>", "́x é 한 !́", "힣ᆨ 中文字 العربية 🙂🙂", "a\x0bb\x0cc\rd",
]


def plain_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def plain_pieces(doc_id, text, capacity):
    ids = plain_ids(text)
    for k in range(0, len(ids), capacity):
        some = ids[k : k + capacity]
        yield doc_id, k // capacity, k, len(some), zlib.crc32(np.array(some, "<u4").tobytes())


def fewest(lengths, capacity):
    """No packing has fewer sequences: by all tokens, and by a largest matching of items above a third."""
    large, pairs, used = sorted(x for x in lengths if 3 * x > capacity), 0, 0
    # The boats' rule: the longest with the shortest if they fit.
    i, j = 0, len(large) - 1
    while i < j:
        if large[i] + large[j] <= capacity:
            i, pairs = i + 1, pairs + 1
        j -= 1
        used += 1
    return max(-(-sum(lengths) // capacity), len(large) - pairs)


def test_encoder_is_the_library():
    rng = random.Random(3)
    letters = "aZé́ß1 \t\n'sS.\x00\x1cİ<|>"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for plain in (True, False):
        encoder = packing.WordEncoder(packing.read_tokenizer(PATH))
        assert encoder.words is not None
        encoder.words = encoder.words if plain else None
        ids, ends = encoder.encode(pa.array(texts, pa.string()))
        for k, text in enumerate(texts):
            assert ids[ends[k] : ends[k + 1]].tolist() == plain_ids(text)[:-1], text


def laid_out(counts, capacity):
    steps, n = packing.plan(counts, capacity)
    bins = defaultdict(list)
    for length, count in counts.items():
        mine = steps[steps[:, 0] == length]
        for rank in range(count):
            _, first, per, sequence, behind = mine[np.searchsorted(mine[:, 1], rank, side="right") - 1].tolist()
            bins[sequence + (rank - first) // per].append((behind + (rank - first) % per * length, length))
    return bins, n


@pytest.mark.parametrize("seed", range(6))
def test_plan_has_no_gaps_and_few_sequences(seed):
    rng = random.Random(seed)
    for _ in range(60):
        capacity = rng.choice([1, 2, 3, 7, 30, 100])
        top = rng.choice([capacity, max(1, capacity // 2), max(1, capacity // 3)])
        counts = {rng.randint(1, top): rng.choice([0, 1, 2, 5, 40]) for _ in range(rng.randint(0, 12))}
        bins, n = laid_out(counts, capacity)
        lengths = [x for x, c in counts.items() for _ in range(c)]
        assert sorted(bins) == list(range(n))
        assert sorted(x for b in bins.values() for _, x in b) == sorted(lengths)
        for b in bins.values():
            at = 0
            for offset, length in sorted(b):
                assert offset == at
                at += length
            assert at <= capacity
            assert sum(3 * x > capacity for _, x in b) <= 2
        assert n <= 1.25 * fewest(lengths, capacity) + 1
        large = [x for x in lengths if 3 * x > capacity]
        if len(large) == len(lengths):
            assert n == fewest(large, capacity)


def test_plan_of_huge_counts_is_small():
    rng = random.Random(1)
    counts = {x: rng.randint(1, 10**9) for x in range(1, 4097)}
    steps, n = packing.plan(counts)
    total = sum(x * c for x, c in counts.items())
    assert len(steps) < 100_000
    assert n * 4096 >= total and n <= 1.12 * fewest_by_tokens_or_halves(counts)


def fewest_by_tokens_or_halves(counts):
    return max(-(-sum(x * c for x, c in counts.items()) // 4096), sum(c for x, c in counts.items() if 2 * x > 4096))


def test_documents_with_odd_rows(spark):
    rng = random.Random(4)
    rows = list(enumerate(ODD)) + [(None, "x y"), (None, "x y"), (5, "x y"), (5, "x y")]
    rows += [(100 + i, " ".join(rng.choice(["red", "Blue", "unbelievable"]) for _ in range(rng.randint(0, 300)))) for i in range(150)]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, length int, part string").repartition(3)
    got = packing.pack(packing.pieces(docs, PATH, capacity=64, keep_ids=True), 64).cache()
    plain = [p for i, t in rows for p in plain_pieces(i, t, 64)]
    key = ["id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(*key).collect()), key=str) == sorted(plain, key=str)
    bins = defaultdict(list)
    for r in got.collect():
        bins[r.sequence_id].append((r.offset, bytes(r.ids)))
    whole = {r.sequence_id: (r.n_tokens, bytes(r.ids)) for r in packing.sequences(got).collect()}
    assert len(whole) == len(bins) and len(bins) <= 1.05 * fewest([p[3] for p in plain], 64) + 1
    for k, b in bins.items():
        assert b"".join(x for _, x in sorted(b)) == whole[k][1]
        assert 4 * whole[k][0] == len(whole[k][1]) <= 256
    assert packing.pack(packing.pieces(docs.limit(0), PATH)).count() == 0
    got.unpersist()


def test_query_against_plain(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = packing.query(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    plain = sorted(p for r in docs for p in plain_pieces(r.doc_id, r.text, 4096))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == plain
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        ends = np.cumsum([x for _, x in sorted(b)])
        assert [o for o, _ in sorted(b)] == [0, *ends[:-1].tolist()] and ends[-1] <= 4096
    assert len(bins) <= fewest([p[3] for p in plain], 4096) + 1

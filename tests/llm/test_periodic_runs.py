import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from veilspark.llm import periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=24, times=3):
    """Every stretch of every period that can't be longer, without those whose stretch has a smaller period."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= 2 * q:
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, m, q) for (s, m), q in found.items() if m >= max(least, times * q))


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    rest = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = None if best is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *(best or (None,) * 3), milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, rest)))


def texts(rng, n):
    """Words of a small alphabet with stretches that repeat, some inside others, some side by side."""
    out = []
    while len(out) < n:
        part = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.4:
            part = part * rng.randint(2, 4) + part[: rng.randint(0, len(part))]
        out += part * rng.choice([1, 1, 2, 3, 5, 9])
    return out[:n]


@pytest.mark.parametrize("seed", range(8))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    for _ in range(40):
        words = texts(rng, rng.randint(0, 250))
        _, symbols = np.unique(np.array(words, object).astype(str), return_inverse=True) if words else (0, np.zeros(0, np.int64))
        assert [tuple(r) for r in periodic_runs.runs(symbols).tolist()] == plain_runs(words)
        assert [tuple(r) for r in periodic_runs.runs(symbols, 2, 2).tolist()] == plain_runs(words, 2, 2)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 400):
        symbols = rng.integers(0, 3, n)
        symbols[n // 2 :] = np.resize(symbols[:7], n - n // 2)
        order = periodic_runs.suffix_order(symbols)
        plain = sorted(range(n), key=lambda i: symbols[i:].tolist())
        assert order.tolist() == plain
        shared = [0]
        for x, y in zip(plain, plain[1:]):
            k = 0
            while max(x, y) + k < n and symbols[x + k] == symbols[y + k]:
                k += 1
            shared.append(k)
        assert periodic_runs.common_prefixes(symbols, order).tolist() == shared


def test_long_texts():
    """One period over 60,000 words, and a text twice over; neither may take time with the square of its length."""
    assert periodic_runs.runs(np.zeros(60_000, np.int64)).tolist() == [[0, 60_000, 1]]
    rng = np.random.default_rng(2)
    once = rng.integers(0, 50_000, 40_000)
    assert len(periodic_runs.runs(np.concatenate([once, once]))) == 0
    assert periodic_runs.runs(np.concatenate([once, once, once])).tolist() == [[0, 120_000, 40_000]]


def test_documents_with_odd_rows(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(None, "a " * 30), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "x\x0bx\x0c" * 30), (4, "x\x0bx\x0c" * 30), (5, "ä\x00 " * 40 + "é")]
    rows += [(6, " ".join(texts(rng, 3000))), (7, "one"), (8, "a\x1cb \x85 " * 12)]
    rows += [(100 + i, " ".join(texts(rng, rng.randint(0, 90)))) for i in range(60)]
    monkeypatch.setattr(periodic_runs, "SLICE_WORDS", 100)
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, runs string, id int").repartition(3)
    got = sorted(((r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find(docs).collect()), key=str)
    want = []
    for i, t in rows:
        words = WORD.findall(t or "")
        found = plain_runs(words)
        gone = {k for s, m, q in found for k in range(s + q, s + m)}
        want.append((i, len(words), found, " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert got == sorted(want, key=str)
    assert periodic_runs.find(docs.limit(0)).count() == 0


def test_query_against_plain(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = periodic_runs.query(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == sorted(plain_row(r.doc_id, r.text) for r in docs)
    assert sum(r.n_runs > 0 for r in got) > 5


def test_rewritten_texts_with_odd_rows(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    rows = [(i, t) for i in ids for t in (None, "", "  ", "one", "a b\tc\nd" * 20, "\x0b x y " * 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = periodic_runs.find(periodic_runs.with_repeats(docs)).select("id", "collapsed").collect()
    assert sorted((r.id, hashlib.sha256(r.collapsed.encode()).hexdigest()) for r in found) == sorted((plain_row(*x)[0], plain_row(*x)[-1]) for x in rows)
    assert docs.count() == len(found)

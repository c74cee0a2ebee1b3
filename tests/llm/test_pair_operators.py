import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from veilspark.llm import jaccard_join, packets, suffix_array, suffix_dedup


def plain_links(rows, percent=90, n=3):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    top = {i: i for i in sets}

    def find(a):
        while top[a] != a:
            a = top[a]
        return a

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                top[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(n, words=60, edits=2, vocabulary=400, base=None):
    base = base or [f"w{random.randrange(vocabulary)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(random.randint(0, edits)):
            copy[random.randrange(len(copy))] = f"e{random.randrange(30)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("few", [1, 16])
def test_links_of_groups_of_near_copies(spark, monkeypatch, few):
    random.seed(few)
    monkeypatch.setattr(jaccard_join, "FEW", few)
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    monkeypatch.setattr(jaccard_join, "WIDTH", 50)
    monkeypatch.setattr(packets, "BUCKET_HASHES", 500)
    texts = near_copies(60) + near_copies(60, edits=3) + ["A b C", "a B c", "a b", "a  b", "one", "", None, " \n", "x " * 300]
    texts += [" ".join(f"u{random.randrange(9999)}" for _ in range(50)) + " common line of words in all" for _ in range(60)]
    rows = list(enumerate(texts))
    random.shuffle(rows)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, component_id string, n int").repartition(5)
    got = jaccard_join.components(df)
    assert {r.id: (r.n_shingles, r.component_id) for r in got.collect()} == plain_links(rows)


def test_joins_without_rows_or_ids(spark):
    """Rows without an id have the size of their set and no component, whether or not a row with an id has the same words."""
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (2, "A b c D"), (None, "z y"), (None, None), (None, " "), (None, "k l m n o k l m")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in jaccard_join.components(df).select("id", "n_shingles", "component_id").collect()]
    want = [(4, 2, 2), (4, 2, 2), (2, 2, 2), (None, 2, None), (None, 1, None), (None, 0, None), (None, 0, None), (None, 5, None)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert jaccard_join.components(df.limit(0)).count() == 0


def test_ids_of_several_texts(spark):
    rows = [(3, "a b c d e f"), (5, "a b c d e f"), (5, "p q r s"), (8, "p q r s"), (9, "k l m n o"), (7, "k l m n o"), (9, "u v w")]
    got = jaccard_join.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == [(3, 4, 3), (5, 2, 3), (5, 4, 3), (7, 3, 7), (8, 2, 3), (9, 1, 7), (9, 3, 7)]


def plain_removal(rows, k=50):
    first, out = {}, {}
    for i, raw in sorted(((i, (t or "").encode()) for i, t in rows), key=lambda r: r[0]):
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - k + 1):
            if first.setdefault(raw[p : p + k], i) < i:
                gone[p : p + k] = True
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0, append=0))
        out[i] = (len(raw), edges.reshape(-1, 2).tolist(), bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("hot", [2, 5000])
def test_removed_spans(spark, monkeypatch, hot):
    random.seed(hot)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 300)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 4000)
    monkeypatch.setattr(packets, "BATCH_BYTES", 3000)
    passage = "".join(random.choices("abcdé \n", k=170))
    texts = ["".join(random.choices("abé ", k=random.randint(0, 300))) + passage[random.randint(0, 60) : random.randint(90, 170)] + "z" * random.randint(0, 90) for _ in range(80)]
    texts += [passage, passage, "", None, "a" * 49, "a" * 50, "a" * 51, "a" * 400, passage * 3, "\x00" * 60, "\x00" * 60]
    rows = list(enumerate(texts))
    random.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, spans int").repartition(4)
    got = {r.id: (r.n_bytes, [[s.start, s.end] for s in r.spans], bytes(r.kept)) for r in suffix_dedup.find(df).collect()}
    assert got == plain_removal(rows)


def test_removal_without_rows_or_ids(spark):
    df = spark.createDataFrame([(None, "q" * 60), (1, "q" * 60), (1, "q" * 60)], "doc_id long, text string")
    assert sorted((str(r.id), len(r.kept)) for r in suffix_dedup.find(df).collect()) == [("1", 0), ("1", 0), ("None", 60)]
    assert suffix_dedup.find(df.limit(0)).count() == 0


def test_induced_sorting_and_prefixes(monkeypatch):
    random.seed(3)
    for digit, direct in ((3, 0), (2048, 0), (2048, 6), (3, 1 << 17)):
        monkeypatch.setattr(suffix_array, "DIGIT", digit)
        monkeypatch.setattr(suffix_array, "DIRECT", direct)
        for _ in range(300):
            k, n = random.choice([1, 2, 3, 40]), random.randint(1, 120)
            text = np.array([random.randint(1, k) for _ in range(n)] + [0], np.int32)
            order = suffix_array.suffix_array(text, k + 1)
            assert order.tolist() == sorted(range(n + 1), key=lambda i, t=text: t[i:].tolist())
            found = suffix_array.permuted_common_prefixes(text, order, 20)
            for a, b in zip(order, order[1:], strict=False):
                same = 0
                while same < 20 and max(a, b) + same <= n and text[a + same] == text[b + same]:
                    same += 1
                assert found[b] == same


def test_counts_of_packets():
    sent = [packets.packets(b, np.concatenate([np.unique(np.array(d, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for d in docs]), 7) for b, docs in enumerate([[[1, 2, 3], [2]], [[3, 4]], [[5]]])]
    by_bucket = defaultdict(list)
    for table in sent:
        for row in table.to_pylist():
            by_bucket[row["bucket"]].append(row)
    import pyarrow as pa

    answers = [packets._add_up(pa.Table.from_pylist(rows, sent[0].schema)) for rows in by_bucket.values()]
    answers = pa.concat_tables(answers)
    want = Counter({1: 1, 2: 2, 3: 2, 4: 1, 5: 1})
    for batch, numbers in enumerate([[1, 2, 3], [3, 4], [5]]):
        known = packets.Shared(answers.filter(pa.compute.equal(answers.column("b"), batch)), 7)
        assert known.count(np.array(numbers, np.uint64) * np.uint64(0x9E3779B97F4A7C15)).tolist() == [want[n] for n in numbers]

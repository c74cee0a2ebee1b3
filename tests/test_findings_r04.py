"""Findings of round 4: the words of a line are neither written nor shuffled again to find phrases in them."""

import difflib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veilspark.functions.scalars import compact_text
from veilspark.operators import lines
from veilspark.plans.linkage_queries import QUERIES

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def shuffled(spark):
    """Bytes that stages of this session have written for shuffles so far."""
    context = spark.sparkContext
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store, jvm = context._jsc.sc().statusStore(), context._jvm
    none = context._gateway.new_array(jvm.double, 0)
    stages = store.stageList(None, False, False, none, jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_phrase_match_shuffles_less_than_its_texts_and_writes_no_words(spark, monkeypatch):
    folder, written = "/root/testdata/sf0.01", []
    for module in (lines, __import__("veilspark.plans.linkage_queries", fromlist=["cut"])):
        if hasattr(module, "cut"):
            monkeypatch.setattr(module, "cut", lambda df, real=module.cut: (written.append(df.dtypes), real(df))[1])
    texts = spark.read.parquet(f"{folder}/documents.parquet").agg(F.sum(F.octet_length("text"))).first()[0]
    before, limit = shuffled(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        assert QUERIES["phrase_match"](spark, folder).count() == 6645
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert 0 < shuffled(spark) - before < texts
    assert written and not any("words" in dict(d) or "texts" in dict(d) for d in written)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_texts_of_lines_are_those_of_lines(spark):
    texts = [("a", "Ann  Lee\n\n \t\nann@x.org, été \U0001f600 x"), ("b", ""), ("c", None), ("d", "\n".join(f" w{i}  v" for i in range(130))), ("e", "one\r\n\x0b\f two\r three \t"), ("f", "   x\u0085 y　")]
    docs = spark.createDataFrame(texts, "document_id string, text string")
    want = lines.printed(docs).select(*lines.LINE, F.transform("words", lambda w: w["text"]).alias("texts"), "box")
    got = lines.printed_texts(docs)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_phrases_without_boxes_of_words_are_the_same(spark, monkeypatch):
    rng = random.Random(2)
    some = ["Ann", "Lee", "Kelvin", "İstanbul", "ÅÅ", "St.", "—", "a" * 300, "of", "\U0001f600"]
    docs = spark.createDataFrame([(d, "\n".join(" ".join(rng.choice(some) for _ in range(rng.randint(0, 12))) for _ in range(80))) for d in "ab"], "document_id string, text string")
    wanted = [(i, rng.choice("ab"), rng.randint(0, 1), " ".join(rng.choice(some) for _ in range(rng.randint(1, 9))), (0.0, y := rng.choice([0.0, 100.0, 9000.0]), 60.0, y + 30.0), rng.choice([2, 8])) for i in range(40)]
    wanted += [(90, "a", 0, "Ann Lee", None, 8), (91, None, 0, "Ann Lee", (0.0, 0.0, 9.0, 9.0), 8), (92, "a", 0, "Ann Lee of St. Lee Ann", (0.0, 0.0, 9.0, 9.0), 2)]
    df = spark.createDataFrame(wanted, f"wanted_id int, document_id string, page int, value string, box {BOX}, max_words int")
    table = lines.printed(docs)
    got = [{tuple(r[c] for c in ("wanted_id", "phrase", "score", "line")): r.box for r in lines.phrases(df, t).collect()} for t in (table, lines.printed_texts(docs))]
    assert got[0].keys() == got[1].keys() and len(got[0]) > 30 and 90 in {k[0] for k in got[0]}
    assert all(b is not None for b in got[0].values()) and not any(got[1].values())


@pytest.mark.parametrize(("at_once", "most"), [(3, 1), (5, 20), (8192, 1 << 18)])
def test_many_lines_at_once_have_the_best_of_all_runs(monkeypatch, at_once, most):
    monkeypatch.setattr(lines, "AT_ONCE", at_once)
    monkeypatch.setattr(lines, "MOST_AT_ONCE", most)
    rng = random.Random(at_once)
    texts = [None if i % 9 == 4 else ["".join(rng.choice("abe1") for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(0, 14))] for i in range(50)]
    values = ["" if i == 0 else "".join(rng.choice("abe1") for _ in range(rng.randint(1, 12))) for i in range(50)]
    low = [rng.randint(1, 4) for _ in texts]
    high = [min(len(t), n + rng.randint(-1, 5)) if t is not None else 8 for t, n in zip(texts, low, strict=True)]
    want = []
    for a, t, i, j in zip(values, texts, low, high, strict=True):
        runs = [(difflib.SequenceMatcher(None, a, "".join(t[s : s + n])).ratio(), -n, -s) for n in range(i, j + 1) for s in range(len(t) - n + 1)] if t else []
        score, size, start = max((r for r in runs if r[0] >= 0.5), default=(None, 0, 0))
        want.append({"score": score, "size": score and -size, "start": score and -start})
    ints = [pa.array(x, pa.int32()) for x in (low, high)]
    got = lines.most_similar.func(pa.array(["-", *values]).slice(1), pa.array([["-"], *texts]).slice(1), *ints, pa.array([0.5] * 50))
    assert got.to_pylist() == want and sum(w["score"] is not None for w in want) > 10


def test_words_are_made_compact_as_in_spark(spark):
    some = [chr(c) for c in [*range(1, 0x250), 0x3A3, 0x1E9E, 0x212A, 0x212B, 0xFF21, 0x1F600]]
    words = ["".join(some[i : i + 3]) for i in range(0, len(some), 3)] + ["", "K", "K", "İxİ"]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", compact_text(F.col("w")).alias("c")).collect()
    data = [r.w.encode() for r in rows]
    ends = lines.np.cumsum([0, *map(len, data)])
    codes, places = lines._compact(lines.np.frombuffer(b"".join(data), dtype="uint8"), ends)
    text = bytes(lines.LETTERS[c] for c in codes).decode()
    assert [text[a:b] for a, b in zip(places, places[1:], strict=False)] == [r.c for r in rows]
    assert lines._letters(codes, places)[-1].sum() == len(text)

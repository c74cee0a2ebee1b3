from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilspark.llm import language_id, quality, toxicity

DATA = "/root/testdata/sf0.01"


def test_language_id_held_out(spark):
    got = language_id.query(spark, DATA)
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    held = got.join(truth, "doc_id").where("held_out")
    right, n, gone = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*"), F.avg(F.col("rejected").cast("double"))).first()
    assert n > 200 and right > 0.97 and gone < 0.02
    assert got.where("score < 0 OR score > 1").count() == 0


def test_language_id_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !?", "de"), (4, "the house and the garden " * 9, "en"), (5, "das Haus und der Garten " * 9, "de"), (6, "x", None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    learned = language_id.learn(docs, F.lit(True))
    assert sorted(learned) == ["de", "en"]
    got = {r.doc_id: r.language_id for r in language_id.classify(docs, learned).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5)] == ["und", "und", "und", "en", "de"]
    assert [got[i].rejected for i in (1, 3, 4)] == [True, True, False]
    assert language_id.learn(docs.limit(0), F.lit(True)) == {}
    assert {r.language_id.lang_pred for r in language_id.classify(docs, {}).collect()} == {"und"}


def test_quality_measures():
    assert quality.measure(None) == (0,) * 9
    text = "a b c a b c\n#x |\n#x |\n\x1c\n \n \n"
    n_words, chars, symbols, dups, repeats = quality.measure(text)[:5]
    words = text.encode().split()
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    assert (n_words, chars, symbols, dups, repeats) == (len(words), sum(map(len, words)), 4, 1, len(covered))


@pytest.mark.parametrize(("k", "n"), [(0, 100), (3, 500), (30, 400)])
def test_exact_bound(k, n):
    p = 0.02
    tail = sum(np.prod([(n - j) / (j + 1) for j in range(i)] or [1.0]) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert quality.binomial_cdf(k, n, p) == pytest.approx(float(tail), rel=1e-6)
    assert quality.certified(k, n, p, 0.05) == (k < n * p and tail <= 0.05)


def test_risk_is_limited_and_small_strata_are_left_alone(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w" + str(i) + " x" * 0 + " ".join(f"{w}{'#' if rng.random() < (0.5 if i % 5 == 0 else 0.01) else ''}" for w in rng.integers(0, 9**6, 60)), "t" if i % 50 in (0, 1) else "s") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(4000)] + [(1, 0), (2, None)], "id long, good int")
    measured = quality.measured(docs, "doc_id", "text", F.col("lang")).cache()
    got = quality.judge(measured, quality.cutoffs(measured, labels)).where("NOT base_failed")
    kept = {(r.stratum, r.good): (r.kept, r.n) for r in got.groupBy("stratum", (F.col("id") % 5 > 0).alias("good")).agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    assert kept["s", True][0] >= 1 - quality.RISK and kept["s", False][0] < 0.05
    assert kept["t", True][0] == kept["t", False][0] == 1.0  # too few labels to be certified
    none = quality.judge(measured, quality.cutoffs(measured, labels.limit(0)))
    assert none.where("NOT base_failed AND NOT kept").count() == 0


def test_fold():
    assert toxicity.fold("1D10T, idіot! Сloẃn") == " idiot idiot ciown "
    assert toxicity.fold("123 ;") == " i e "
    assert toxicity.fold(";") == toxicity.fold("") == "  "


def test_toxicity_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(i, f"text {j}") for i in range(20) for j in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1)], "id long, toxic int")
    got = toxicity._sample(docs, labels, F.lit(True), "doc_id", "text", 10).collect()
    assert len(got) == len({r.id for r in got}) == 10
    assert all(r.toxic == r.id % 2 for r in got)


@pytest.mark.parametrize("ranked", [0, 8])
def test_language_texts_are_the_first_by_hash(spark, monkeypatch, ranked):
    """Whether or not a language is ranked as a whole; a text in a third of all rows teaches once."""
    monkeypatch.setattr(language_id, "RANKED", ranked)
    rows = [("a" if i % 3 else "b", i, f"text {i % 200}") for i in range(600)] + [("a", 7, "same")] * 300 + [("b", None, "x")] * 3
    df = spark.createDataFrame(rows, "lang string, id long, text string").repartition(4)
    hashed = {tuple(r) for r in df.select("lang", F.xxhash64("id"), F.xxhash64("text"), "id").collect()}
    got = sorted((r.lang, r.k, r.h, r.th, r.id) for r in language_id._first(df, 20).collect())
    want = []
    for lang in "ab":
        mine = sorted((h, i is not None, i or 0, th, i) for g, h, th, i in hashed if g == lang)[:20]
        want += [(lang, k + 1, h, th, i) for k, (h, _, _, th, i) in enumerate(mine)]
    assert got == want


def test_toxicity_scores_odd_rows():
    model = toxicity.Model((("Xbad".replace("X", " ") + " ", 4.0), (" vii", 3.0)), (" bad hair ",), 2.0, -5.0)
    use = toxicity.Matcher(model)
    assert use.density(None) == use.density("") == (0.0, 0)
    assert use.density("bad")[1] == 1 and use.density("badly")[1] == 0 and use.density("vi1lain")[1] == 1
    assert use.density("a bad hair day")[1] == 0
    assert 0 <= use.score("") < use.score("so bad " * 3) <= 1
    assert toxicity.Matcher(toxicity.Model((), (), 0.0, 0.0)).score("bad") == 0.0


def test_toxicity_held_out(spark):
    got = toxicity.query(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out")
    counts = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] / (counts[1, 1] + counts.get((1, 0), 0)) > 0.85
    assert counts.get((0, 1), 0) / (counts[0, 0] + counts.get((0, 1), 0)) < 0.02

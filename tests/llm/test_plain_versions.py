"""Language ID, toxicity and quality rules against plain versions on whole small tables."""

import math
import re
import zlib
from collections import defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from veilspark.llm import exact_dedup, language_id, quality, toxicity

DATA = "/root/testdata/sf0.001"


def test_language_of_fewest_bytes(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    learned = language_id.learn(docs, language_id.fold(F.col("doc_id"), 4) != 2)
    texts = {r.doc_id: r for r in docs.collect()}
    for lang, content in learned.items():
        whole = [r.text.lower().encode() for r in texts.values() if r.lang == lang and r.text and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
        assert any(content.startswith(t + b"\n") for t in whole) and len(content) <= language_id.DICT_BYTES
    compressors = {}
    for lang, content in learned.items():
        how = zstandard.ZstdCompressionParameters.from_level(language_id.LEVEL, source_size=language_id.BLOCK, dict_size=len(content), min_match=3, write_content_size=False)
        compressors[lang] = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=how)
    for r in language_id.query(spark, DATA).collect():
        text = texts[r.doc_id].text or ""
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        raw = text.lower().encode()
        sizes = {lang: sum(len(c.compress(raw[i : i + language_id.BLOCK])) for i in range(0, len(raw), language_id.BLOCK)) for lang, c in sorted(compressors.items())}
        assert r.lang_pred == min(sizes, key=sizes.get)


def test_scores_of_a_plain_matcher(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select(F.col("doc_id").alias("id"), "toxic")
    model = toxicity.learn(docs, labels, F.lit(True))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-2, "123"), (None, "x " * 300_000)], "doc_id long, text string")
    rows = toxicity.score(docs.select("doc_id", "text").unionByName(odd), model).collect()
    assert len(rows) == docs.count() + 4 and model.terms
    for r in rows:
        folded = toxicity.fold(r.text or "")
        starts = {}
        for term, weight in model.terms:
            for m in re.finditer(f"(?={re.escape(term)})", folded):
                starts[m.start()] = max(weight, starts.get(m.start(), 0.0))
        for phrase in model.phrases:
            for m in re.finditer(f"(?={re.escape(phrase)})", folded):
                for at in [s for s in starts if m.start() <= s < m.start() + len(phrase) - 1]:
                    del starts[at]
        density = sum(starts.values()) / max(1, len(folded.split()))
        x = max(-30.0, min(30.0, model.offset + model.slope * math.log1p(1000 * density)))
        assert r.toxicity.matches == len(starts) and r.toxicity.score == pytest.approx(1 / (1 + math.exp(-x)))
    none = toxicity.learn(docs, labels.limit(0), F.lit(True))
    assert none.terms == () and toxicity.score(docs.limit(0), none).count() == 0


def plain_kept(rows, labels):
    known = defaultdict(set)
    for i, good in labels:
        known[i].add(good)
    good_of = {i: next(iter(g)) for i, g in known.items() if len(g) == 1 and None not in g}

    def steps(r):
        out = {}
        for name, (a, b) in (("symbols", ("n_symbols", "word_chars")), ("repeats", ("n_repeat_words", "n_words")), ("dup_lines", ("n_dup_lines", "n_lines")), ("capitals", ("n_upper", "n_letters")), ("long_words", ("word_chars", "n_words")), ("marks", ("n_marks", "word_chars"))):
            least, most = quality.SIGNALS[name]
            value = r[a] / r[b] if r[b] else 0.0
            out[name] = max(0, min(quality.STEPS, math.ceil((value - least) / ((most - least) / quality.STEPS))))
        return out

    failed = {id(r): r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"] for r in rows}
    taught = [(r, good_of[r["id"]]) for r in rows if not failed[id(r)] and r["id"] in good_of]
    half = {k: [(r, g) for r, g in taught if zlib.crc32(str(r["id"]).encode()) % 2 == k] for k in (0, 1)}
    cuts = {s: {} for s in {r["stratum"] for r, _ in half[0]}}
    for s, found in cuts.items():
        mine = [(steps(r), g) for r, g in half[0] if r["stratum"] == s]
        for name in quality.SIGNALS:
            gain = [sum((1 if g == 0 else -quality.COST) for at, g in mine if at[name] >= t) for t in range(quality.STEPS + 1)]
            best = max(range(quality.STEPS + 1), key=lambda t, gain=gain: (gain[t], t))
            if best and gain[best] > 0:
                found[name] = best

    def severity(r):
        at = steps(r)
        return max([0, *(at[n] - c + 1 for n, c in cuts.get(r["stratum"], {}).items())])

    relaxed = {}
    for s in cuts:
        far = [severity(r) for r, g in half[1] if r["stratum"] == s and g == 1]
        for t in range(quality.STEPS + 1, 0, -1):
            if not quality.certified(sum(x >= t for x in far), len(far), quality.RISK, quality.ERROR / len(cuts)):
                break
            relaxed[s] = t - 1
    return sorted((r["id"], not failed[id(r)] and not (r["stratum"] in relaxed and severity(r) > relaxed[r["stratum"]])) for r in rows)


def test_kept_of_a_plain_search(spark):
    data = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{data}/labels.parquet").collect()]
    rows = [dict(zip(quality.MEASURES, quality.measure(r.text), strict=True), id=r.doc_id, stratum=r.lang) for r in docs.collect()]
    assert sorted((r.doc_id, r.kept) for r in quality.query(spark, data).collect()) == plain_kept(rows, labels)


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, None, 1), (2, "a b", None, 1), (2, "c " * 300_000, "x", 1)], "doc_id long, text string, lang string, kept int")
    labels = spark.createDataFrame([], "id long, good int")
    for some, n in ((docs, 3), (docs.limit(0), 0)):
        rows = quality.measured(some, "doc_id", "text", F.col("lang")).cache()
        got = quality.judge(rows, quality.cutoffs(rows, labels)).collect()
        assert len(got) == n and not any(r.kept for r in got)


def test_salts_are_bounded(spark):
    with pytest.raises(ValueError):
        exact_dedup.members(spark.createDataFrame([(1, "a")], "doc_id long, text string"), salts=64)

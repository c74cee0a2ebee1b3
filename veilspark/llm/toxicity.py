"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

Folding: compatibility forms, lower case, look-alike letters of other scripts, accents and digits
or signs that stand for letters are mapped to one letter each; what is not a letter becomes a space.
Terms are whole words and word beginnings; a beginning matches wherever a word starts with it.
A term inside an exception phrase (a longer phrase in which it is harmless) doesn't count. The sum
of the matched weights is divided by the number of words, and a logistic curve gives the score.

Fitting, on labelled rows of the learning folds: at most DOCS documents, in the order of a hash of
their ids. A term's weight is the log-odds of its document rates among toxic and other documents; at
most TERMS terms that are rare among the others are kept. Exception phrases are word pairs around a
term whose rate is no higher among toxic documents; at most PHRASES. The curve is fitted last.

Defined cases: a null or empty text scores as one without matches; rows without a label, with a null
one, or with labels that differ don't teach; with no labels every score is 0; rows that repeat an id, or
have none, are scored each by its own text; an empty table gives an empty result; a text of any length is
one string in a task. `score` adds the column `toxicity` and replaces one of that name; the query takes
only doc_id and text.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm.arrow import held, small_batches
from veilspark.plans.frames import cut, read_table

DOCS, TERMS, PHRASES = 20_000, 2_000, 500
#: Documents a term must occur in, and its largest rate among those not toxic.
LEAST_DOCS, MOST_RATE = 5, 0.02
BEGINNINGS = (4, 5, 6)

# Look-alikes and substitutes, and the letters they stand for. "l" and "1" fold to "i".
LOOKALIKES = {
    "аɑα@4": "a", "вβ8": "b", "сϲ¢": "c", "ԁ": "d", "еєε3€": "e", "ɡ": "g", "һ": "h", "іιı1l": "i", "ј": "j", "кκ": "k",
    "мμ": "m", "пη": "n", "оοσ0": "o", "рρ": "p", "ԛ": "q", "гг": "r", "ѕ5$": "s", "тτ7": "t", "υս": "u", "ν": "v",
    "ѡω": "w", "хχ": "x", "уγ": "y",
}
_FOLD = str.maketrans({c: to for many, to in LOOKALIKES.items() for c in many})
_OTHER = regex.compile(r"[^\p{L}]+")
_MARKS = regex.compile(r"\p{M}+")


def fold(text: str) -> str:
    """The words of a text, folded, with one space before, between and after them; two spaces if there are none."""
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    return f" {_OTHER.sub(' ', text.lower().translate(_FOLD)).strip()} "


@dataclass(frozen=True)
class Model:
    """Of bounded size: TERMS terms and PHRASES phrases at most. A term is " word " or " begin"."""

    terms: tuple[tuple[str, float], ...]
    phrases: tuple[str, ...]
    slope: float
    offset: float


class Matcher:
    def __init__(self, model: Model) -> None:
        import ahocorasick

        self.model = model
        self.automaton = ahocorasick.Automaton()
        for term, weight in model.terms:
            self.automaton.add_word(term, (len(term), weight, False))
        for phrase in model.phrases:
            self.automaton.add_word(phrase, (len(phrase), 0.0, True))
        self.ready = bool(model.terms)
        if self.ready:
            self.automaton.make_automaton()

    def density(self, text: str | None) -> tuple[float, int]:
        """Weight a word, and the number of counted matches. Of terms that begin at one word, the heaviest counts."""
        if not text or not self.ready:
            return 0.0, 0
        folded = fold(text)
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (length, weight, phrase) in self.automaton.iter(folded):
            start = end - length + 1
            if phrase:
                spared.append((start, end))
            elif weight > found.get(start, 0.0):
                found[start] = weight
        for a, b in spared:
            for start in [s for s in found if a <= s < b]:
                del found[start]
        return sum(found.values()) / max(1, folded.count(" ") - 1), len(found)

    def judge(self, text: str | None) -> tuple[float, int]:
        """Score, and the number of counted matches."""
        density, matches = self.density(text)
        if not self.ready:
            return 0.0, 0
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.model.offset + self.model.slope * signal(density))))), matches

    def score(self, text: str | None) -> float:
        return self.judge(text)[0]


def signal(density: float) -> float:
    return math.log1p(1000 * density)


def matcher(model: Model) -> Matcher:
    return held(("toxicity", model), lambda: Matcher(model))


def features(text: str | None) -> list[str]:
    """Distinct terms of a text: " word " and " begin" for each length of BEGINNINGS."""
    words = set(fold(text or "").split())
    return [f" {w} " for w in words if len(w) > 2] + list({f" {w[:n]}" for w in words for n in BEGINNINGS if len(w) >= n})


def _sample(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, most: int) -> DataFrame:
    """(id, text, toxic) of at most `most` labelled ids of the learning folds, each with one of its texts, the one of the least hash."""
    one = labels.where(F.col("toxic").isNotNull()).groupBy("id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("t"))
    known = one.where("toxic = t").drop("t").where(F.col("id").isNotNull()).withColumn("h", F.xxhash64("id"))
    chosen = cut(known.where(train).orderBy("h", "id").limit(most).drop("h"))  # at most `most` rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    one_text = F.min(F.struct(F.xxhash64("text"), "text"))
    return cut(texts.join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(one_text.alias("t")).select("id", F.col("t.text").alias("text"), "toxic"))


def learn(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", most: int = DOCS) -> Model:
    """labels: (id, toxic); train: of the column `id`."""
    sample = _sample(docs, labels, train, id_col, text_col, most)
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_other = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_other:
        return Model((), (), 0.0, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = features(text.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([toxic] * len(found), pa.int32())], ["term", "toxic"])

    terms = small_batches(sample.select("text", F.col("toxic").cast("int"))).mapInArrow(run, "term string, toxic int")
    rates = terms.groupBy("term").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("o") + 0.5) / (n_other + 1))
    best = (
        rates.where((F.col("t") >= LEAST_DOCS) & (F.col("o") <= MOST_RATE * n_other))
        .withColumn("weight", odds)
        .where(F.col("weight") >= math.log(10))
        .orderBy(F.desc(F.col("weight") * F.sqrt("t")), "term")
        .limit(TERMS)
    )
    lexicon = {r["term"]: round(float(r["weight"]), 4) for r in best.select("term", "weight").collect()}
    # A word or a longer beginning adds nothing to a shorter beginning of at least its weight.
    kept = {
        t: w for t, w in lexicon.items()
        if not any(lexicon.get(t[: n + 1], 0.0) >= w for n in BEGINNINGS if n + 1 < len(t))
    }
    terms_ = tuple(sorted(kept.items()))
    phrases = _phrases(sample, terms_, n_toxic, n_other)
    slope, offset = _curve(sample, Model(terms_, phrases, 1.0, 0.0))
    return Model(terms_, phrases, slope, offset)


def _phrases(sample: DataFrame, terms: tuple[tuple[str, float], ...], n_toxic: int, n_other: int) -> tuple[str, ...]:
    bare = Model(terms, (), 1.0, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = matcher(bare)
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = set()
                folded = fold(text.as_py() or "")
                for end, (length, _, _) in use.automaton.iter(folded) if use.ready else ():
                    start = end - length + 1
                    stop = folded.find(" ", start + 1)
                    before = folded.rfind(" ", 0, start)
                    after = folded.find(" ", stop + 1)
                    found |= {folded[before : stop + 1]} if before >= 0 else set()
                    found |= {folded[start : after + 1]} if after >= 0 else set()
                yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string()), pa.array([toxic] * len(found), pa.int32())], ["phrase", "toxic"])

    seen = small_batches(sample.select("text", F.col("toxic").cast("int"))).mapInArrow(run, "phrase string, toxic int")
    rates = seen.groupBy("phrase").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
    harmless = rates.where((F.col("o") >= LEAST_DOCS) & (F.col("t") * n_other <= F.col("o") * n_toxic))
    return tuple(sorted(r["phrase"] for r in harmless.orderBy(F.desc("o"), "phrase").limit(PHRASES).select("phrase").collect()))


def _curve(sample: DataFrame, model: Model) -> tuple[float, float]:
    """Slope and offset of the logistic curve, from one number for each document of the bounded sample."""

    @F.pandas_udf("double")
    def of(texts):
        import pandas as pd

        use = matcher(model)
        return pd.Series([signal(use.density(t)[0]) for t in texts], dtype="float64")

    rows = small_batches(sample).select(of("text").alias("x"), F.col("toxic").cast("double").alias("y")).collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])
    design = np.stack([x, np.ones_like(x)], 1)
    at = np.zeros(2)
    for _ in range(50):  # Newton's method with a small ridge, so that separable samples have an end
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        gradient = design.T @ (y - p) - 0.05 * at
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.05 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        at += step
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with a struct `toxicity`: score, matches."""

    @F.pandas_udf("score double, matches int")
    def of(texts):
        import pandas as pd

        use = matcher(model)
        return pd.DataFrame([use.judge(t) for t in texts], columns=["score", "matches"])

    return small_batches(docs).withColumn("toxicity", of(F.col(text_col)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "toxic")

    def held_out(name: str) -> Column:
        return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))) % 5 == 0

    model = learn(docs, labels, ~held_out("id"))
    scored = score(docs.withColumn("held_out", held_out("doc_id")), model)
    return scored.select(
        "doc_id", "held_out", "toxicity.score", (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"), "toxicity.matches"
    )

"""Quality rules with risk-controlled thresholds.

Each rule rejects documents whose signal lies beyond a cutoff; cutoffs hold within a stratum. Half of
the labelled documents propose them: for each rule the cutoff that rejects most bad documents beyond
what it costs in good ones. The other half is the holdout: all proposed cutoffs together are relaxed
by t steps, and t is lowered from the most lenient value while the exact (Clopper-Pearson) upper
bound of the stratum's false rejections stays below `risk`. Testing in this fixed order needs no
correction along t and stops at the first failure; over strata the error probability is divided
(Bonferroni), so with probability 1 - `error` the rules cost no stratum more than `risk` of those of its
good documents that pass the base rule. What the base rule rejects is fixed beforehand and not counted.

Defined cases: a null text has no words and fails the base rule; a null stratum is one of its own;
documents with a null or absent label, or with several labels that differ, don't count; without
enough labels no rule of the stratum rejects; documents with equal ids are measured each alone and count
each with the id's label; those without an id teach nothing; empty documents give an empty result and empty
labels reject nothing; the operator makes its own columns, so other names can't clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm.arrow import small_batches
from veilspark.plans.frames import cut, read_table, small_side

#: Share of a stratum's good documents that may be rejected, and the probability that more are.
RISK, ERROR = 0.02, 0.05
#: Cutoffs tried: STEPS over each signal's range.
STEPS = 200
#: What a rejected good document must be worth in rejected bad ones.
COST = 5.0
SYMBOLS = "#*$%&|<>"
_BLANK = " \t\n\x0b\f\r"

#: name: (least, most) of the signal; rejected above the cutoff.
SIGNALS = {
    "symbols": (0.0, 1.0),  # symbols a word character
    "repeats": (0.0, 1.0),  # words in repeated windows
    "dup_lines": (0.0, 1.0),  # lines that repeat an earlier one
    "capitals": (0.0, 1.0),  # upper-case letters among letters
    "long_words": (0.0, 40.0),  # mean word length
    "marks": (0.0, 1.0),  # other signs than letters, digits and white space, a word character
}


def measure(text: str | None) -> tuple[float, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_letters, n_marks."""
    if not text:
        return (0,) * 9
    words = text.encode().split()  # of bytes: splits at just the six ASCII white-space characters
    lines = [x for x in text.split("\n") if x.strip(_BLANK)] if "\n" in text else [text] if words else []
    repeated = 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        last = -1
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + 2 - max(last, i - 1)
                last = i + 2
    blanks = sum(map(text.count, _BLANK))
    upper = sum(map(str.isupper, text))
    letters = sum(map(str.isalpha, text))
    other = len(text) - blanks - sum(map(str.isalnum, text))
    return (
        len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated,
        len(lines), upper, letters, other,
    )


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks"]


def measured(docs: DataFrame, id_col: str, text_col: str, stratum: Column) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py()) for t in batch.column(2)]
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "stratum", *MEASURES])

    slim = docs.select(F.col(id_col).alias("id"), stratum.alias("stratum"), F.col(text_col).alias("text"))
    kinds = dict(slim.dtypes)
    made = ", ".join(f"{m} bigint" for m in MEASURES)
    return small_batches(slim).mapInArrow(run, f"id {kinds['id']}, stratum {kinds['stratum']}, {made}")


def signals() -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))

    return {
        "symbols": share("n_symbols", "word_chars"),
        "repeats": share("n_repeat_words", "n_words"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "capitals": share("n_upper", "n_letters"),
        "long_words": share("word_chars", "n_words"),
        "marks": share("n_marks", "word_chars"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), 0 < p < 1."""
    at = np.arange(k + 1)
    choose = math.lgamma(n + 1) - np.array([math.lgamma(i + 1) + math.lgamma(n - i + 1) for i in at])
    return float(min(1.0, np.exp(choose + at * math.log(p) + (n - at) * math.log1p(-p)).sum()))


def certified(k: int, n: int, risk: float, error: float) -> bool:
    """Whether the exact upper bound at confidence 1 - error of a rate seen k times in n is at most `risk`."""
    return n > 0 and k < n * risk and binomial_cdf(k, n, risk) <= error


def propose(good: np.ndarray, bad: np.ndarray) -> int | None:
    """The step from which a rule should reject; good and bad count documents by the step their signal lies in."""
    gain = np.cumsum(bad[::-1])[::-1] - COST * np.cumsum(good[::-1])[::-1]  # of this step and those beyond
    best = int(len(gain) - 1 - np.argmax(gain[::-1]))
    return best if best > 0 and gain[best] > 0 else None


def relax(good: np.ndarray, risk: float, error: float) -> int | None:
    """By how many steps the proposed cutoffs must be relaxed; good counts documents by how far beyond them they lie."""
    n, found = int(good.sum()), None
    rejected = np.cumsum(good[::-1])[::-1]
    for t in range(len(good) - 1, 0, -1):
        if not certified(int(rejected[t]), n, risk, error):
            break
        found = t - 1
    return found


def step_of(name: str, value: Column) -> Column:
    least, most = SIGNALS[name]
    return F.greatest(F.lit(0), F.least(F.lit(STEPS), F.ceil((value - least) / ((most - least) / STEPS)))).cast("int")


def severity() -> Column:
    """0: within all cutoffs; 1 + the steps by which a signal lies beyond its cutoff, the largest of them."""
    beyond = [F.coalesce(step_of(n, c) - F.col(f"_{n}") + 1, F.lit(0)) for n, c in signals().items()]
    return F.greatest(F.lit(0), *beyond)


def _with_cuts(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    cuts = cuts.withColumnsRenamed({n: f"_{n}" for n in ["stratum", "relaxed", *SIGNALS]})
    return rows.join(small_side(cuts), F.col("stratum").eqNullSafe(F.col("_stratum")), "left")


def cutoffs(rows: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """For each stratum the proposed step of each rule, and by how much they are relaxed (null: no rule rejects).

    labels: (id, good) with good 0 or 1.
    """
    one = labels.where(F.col("good").isNotNull()).groupBy("id").agg(F.min("good").alias("good"), F.max("good").alias("most"))
    known = rows.where(~base_failed()).join(one.where("good = most").drop("most"), "id")
    holdout = F.crc32(F.col("id").cast("string")) % 2 == 1
    steps = F.array(*[F.struct(F.lit(n).alias("rule"), step_of(n, c).alias("step")) for n, c in signals().items()])
    sums = [F.sum((F.col("good") == g).cast("long")).alias(n) for g, n in ((1, "good"), (0, "bad"))]
    counts = known.where(~holdout).select("stratum", "good", F.explode(steps).alias("at")).groupBy("stratum", "at.rule", "at.step").agg(*sums)
    kind = dict(counts.dtypes)["stratum"]

    # Each group below has a row for each step at most, whatever the size of the data.
    def by_rule(rows: pd.DataFrame) -> pd.DataFrame:
        good, bad = np.zeros(STEPS + 1, np.int64), np.zeros(STEPS + 1, np.int64)
        good[rows["step"]], bad[rows["step"]] = rows["good"], rows["bad"]
        return rows[["stratum", "rule"]].iloc[:1].assign(step=propose(good, bad))

    proposed = counts.groupBy("stratum", "rule").applyInPandas(by_rule, f"stratum {kind}, rule string, step int")
    cuts = cut(proposed.groupBy("stratum").pivot("rule", list(SIGNALS)).agg(F.first("step")))
    tests = max(1, cuts.count())

    def by_stratum(rows: pd.DataFrame) -> pd.DataFrame:
        good = np.zeros(STEPS + 2, np.int64)
        good[rows["severity"]] = rows["good"]
        return rows[["stratum"]].iloc[:1].assign(relaxed=relax(good, risk, error / tests))

    tried = _with_cuts(known.where(holdout), cuts).select("stratum", "good", severity().alias("severity"))
    tried = tried.where("good = 1").groupBy("stratum", "severity").agg(F.count("good").alias("good"))
    found = tried.groupBy("stratum").applyInPandas(by_stratum, f"stratum {kind}, relaxed int").withColumnRenamed("stratum", "_s")
    return cut(cuts.join(found, F.col("stratum").eqNullSafe(F.col("_s"))).drop("_s"))


def judge(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """rows with base_failed and kept."""
    rejected = F.coalesce(severity() > F.col("_relaxed"), F.lit(False))
    judged = _with_cuts(rows, cuts).withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & ~rejected).select(*rows.columns, "base_failed", "kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("good"))
    rows = cut(measured(docs, "doc_id", "text", F.col("lang")))
    return judge(rows, cutoffs(rows, labels)).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )

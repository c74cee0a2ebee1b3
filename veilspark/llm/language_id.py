"""Language identification by compression with per-language zstandard dictionaries.

A raw-content dictionary for each language holds lower-cased labelled text. A document is compressed
in blocks with each dictionary, and the language whose dictionary gives the fewest bytes is chosen.
`rejected` marks documents without text or letters and those whose two best sizes differ by less
than `margin` of the best.

Fitting: whole labelled texts of a language, in the order of a hash of their ids, fill its dictionary
until DICT_BYTES of them are there (only the text that crosses this bound is cut) or DOCS texts are used;
equal texts of one id teach once.
Every language is learned; with more than LANGUAGES of them each one's documents and bytes shrink in
proportion, so that all dictionaries stay within LANGUAGES * DICT_BYTES.

Defined cases: a text that is null or has no letter is `und` with score 0; ties go to the first
language by name; without labelled text, or with an empty table, every document is `und`; rows that repeat
an id, or have none, are classified each by its own text; whole texts are compressed, block by block,
however long; `classify` adds one column of the name given and replaces one of that name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilspark.llm.arrow import held, small_batches
from veilspark.plans.frames import cut, read_table

DOCS = 200
#: Texts of a language that are ranked are about so many times those that can be used, whatever their number.
RANKED = 8
DICT_BYTES = 256 << 10
LANGUAGES = 32
BLOCK = 16 << 10
LEVEL = 13
MARGIN = 0.002
#: Of the score: e-folds for each hundredth by which another language is larger.
SHARPNESS = 1.5
_LETTER = regex.compile(r"\p{L}")


def fold(id_: Column, folds: int) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % folds


def _first(labelled: DataFrame, docs_each: int) -> DataFrame:
    """(lang, id, h, th, k): of each language the first docs_each texts in the order of (h, id, th), the hashes of id and text.

    Only ids and hashes are moved. All texts with a hash below a bound are ranked, RANKED * docs_each of them on
    average; only where they turn out too few is the language ranked as a whole.
    """
    keys = labelled.select("lang", "id", F.xxhash64("id").alias("h"), F.xxhash64("text").alias("th"))
    counts = cut(keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))  # a row for each language
    share = F.least(F.lit(1.0), F.lit(float(RANKED * docs_each)) / F.col("n"))
    bound = counts.select("lang", "n", (F.lit(-(2.0**63)) + share * F.lit(2.0**64)).alias("bound"))
    order = Window.partitionBy("lang").orderBy("h", "id", "th")

    def ranked(some: DataFrame) -> DataFrame:
        return some.distinct().withColumn("k", F.row_number().over(order)).where(F.col("k") <= docs_each)

    low = cut(ranked(keys.join(bound, "lang").where(F.col("h") <= F.col("bound")).select(*keys.columns)))
    found = low.groupBy("lang").agg(F.count(F.lit(1)).alias("found"))
    short = bound.where("bound < 9.2e18").join(found, "lang", "left").where(F.coalesce("found", F.lit(0)) < docs_each).select("lang")
    if not short.limit(1).count():
        return low
    return cut(low.join(short, "lang", "left_anti").unionByName(ranked(keys.join(short, "lang", "left_semi"))))


def learn(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """A dictionary for each language; both the documents and the bytes gathered are bounded."""
    labelled = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    labelled = labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    languages = labelled.select("lang").distinct().count()
    docs_each = max(1, DOCS * LANGUAGES // max(LANGUAGES, languages))
    bytes_each = max(1, DICT_BYTES * LANGUAGES // max(LANGUAGES, languages))
    # At most max(DOCS * LANGUAGES, languages) rows of ids and hashes.
    first = F.broadcast(_first(labelled, docs_each)).alias("f")
    hashed = labelled.withColumn("th", F.xxhash64("text")).alias("d")
    same = (F.col("d.lang") == F.col("f.lang")) & F.col("d.id").eqNullSafe(F.col("f.id")) & (F.col("d.th") == F.col("f.th"))
    order = Window.partitionBy("lang").orderBy("k")
    chosen = (
        hashed.join(first, same).select("f.lang", "f.k", F.lower("d.text").alias("text")).dropDuplicates(["lang", "k"])
        .withColumn("before", F.sum(F.octet_length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .where(F.coalesce("before", F.lit(0)) < bytes_each)
    )
    parts: dict[str, list[tuple[int, str]]] = {}
    # Of each language bytes_each and the rest of one text, of which no more than bytes_each is fetched.
    for r in chosen.select("lang", "k", F.substring("text", 1, bytes_each).alias("text")).collect():
        parts.setdefault(r["lang"], []).append((r["k"], r["text"]))
    return {lang: "\n".join(t for _, t in sorted(p)).encode()[:bytes_each] for lang, p in sorted(parts.items())}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        import zstandard

        self.languages = sorted(dictionaries)
        self.compress = []
        for lang in self.languages:
            how = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, source_size=BLOCK, dict_size=len(dictionaries[lang]), min_match=3, write_content_size=False
            )
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=how)
            self.compress.append(zstandard.ZstdCompressor(dict_data=content, compression_params=how).compress)

    def sizes(self, text: str) -> list[int]:
        raw = text.lower().encode()
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        return [sum(len(compress(b)) for b in blocks) for compress in self.compress]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score from 0 to 1, and margin: by how much of the best size the second best is larger."""
        if not text or not self.languages or not _LETTER.search(text):
            return "und", 0.0, 0.0
        sizes = self.sizes(text)
        best = min(sizes)
        score = 1 / sum(math.exp(-SHARPNESS * 100 * (s - best) / best) for s in sizes)
        margin = (sorted(sizes)[1] - best) / best if len(sizes) > 1 else 1.0
        return self.languages[sizes.index(best)], score, margin


def classify(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", margin: float = MARGIN, name: str = "language_id") -> DataFrame:
    """docs with a struct `name`: lang_pred, score, margin, rejected.

    The dictionaries go to the tasks with the function: LANGUAGES * DICT_BYTES at most.
    """
    key = hash(tuple(sorted(dictionaries.items())))

    @F.pandas_udf("lang_pred string, score double, margin double, rejected boolean")
    def predict(texts):
        import pandas as pd

        use = held(("language", key), lambda: Classifier(dictionaries))
        rows = [(*p, p[0] == "und" or p[2] < margin) for p in map(use.predict, texts)]
        return pd.DataFrame(rows, columns=["lang_pred", "score", "margin", "rejected"])

    return small_batches(docs).withColumn(name, predict(F.col(text_col)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    dictionaries = learn(docs, ~held_out)
    return classify(docs.select("doc_id", "text", held_out.alias("held_out")), dictionaries).select(
        "doc_id", "held_out", "language_id.lang_pred", "language_id.score", "language_id.margin", "language_id.rejected"
    )

"""A corpus pipeline of five stages, each one a training-data operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run` writes as Parquet and
reads again as the next stage's docs. All but the last return the columns of documents.

Near copies are taken as five words at a Jaccard similarity of 0.8, the rule for stages on word shingles;
the query op9_jaccard_join has thresholds of its own.

Defined cases, whatever other columns there are and whatever their names: language ID drops texts that
are null or have no letter; exact dedup takes null texts as empty ones and returns them so; the near-copy
stage keeps texts without words, rows without an id, and all rows of a kept id; the mix takes texts
without words as often as its whole copies and its sample say, at no words; encoding returns every row,
repeated ones too; a stage of no rows returns none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm import bpe, exact_dedup, jaccard_join, language_id, mixing
from veilspark.plans.frames import read_table, shared_dir


#: Of a shingle, and the similarity in hundredths, of the near-copy stage.
WORDS, PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters or with a narrow margin go."""
    name = "language_id"
    while name in docs.columns:
        name = f"_{name}"
    classified = language_id.classify(docs, language_id.learn(docs, F.lit(True)), name=name)
    return classified.where(~F.col(f"{name}.rejected")).drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.keep_one(docs).select(*docs.columns)


def drop_near_copies(
    spark: SparkSession, docs: DataFrame, sf_dir: str, n: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id."""
    named = jaccard_join.components(docs, n=n, percent=percent)
    stays = named.where(F.col("id").eqNullSafe(F.col("component_id"))).select("id").distinct()
    return docs.alias("d").join(stays.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.id")), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document's ids and of the text decoded from them."""
    return bpe.round_trip(docs, *bpe.default_vocabulary()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Compression, transduction and learned dictionaries have no SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""More languages than LANGUAGES: each one is learned and told."""

import random

import pytest
from pyspark.sql import functions as F

from veilspark.llm import language_id


@pytest.mark.parametrize("languages", [4, 40])
def test_every_language_is_learned(spark, languages):
    random.seed(languages)
    rows, words = [], {}
    for k in range(languages):
        lang = f"l{k:02}"
        words[lang] = ["".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=random.randint(3, 9))) for _ in range(60)]
        rows += [(100 * k + j, " ".join(random.choices(words[lang], k=80)), lang) for j in range(8 if k else 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language_id.learn(docs, F.lit(True))
    assert sorted(learned) == sorted(words)
    assert sum(map(len, learned.values())) <= language_id.LANGUAGES * language_id.DICT_BYTES
    got = language_id.classify(docs, learned).select("lang", "language_id.lang_pred").collect()
    assert all(r.lang == r.lang_pred for r in got)

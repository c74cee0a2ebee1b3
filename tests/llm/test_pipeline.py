"""The pipeline stage by stage against plain versions, on the smallest data folder."""

import base64
from collections import Counter

import corpus_pipeline as pipeline
import tiktoken
from pyspark.sql import functions as F
from test_pair_operators import plain_links

from veilspark.llm import bpe, language_id, mixing

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    kept = []
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, DATA)
        out.write.parquet(f"{tmp_path}/{k}")
        result = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append((name, docs, result))
        docs = result
    for _, _, result in kept[:-1]:
        assert result.columns == columns
    rows = {name: ([tuple(r) for r in a.select("doc_id", "text", "source").collect()], [r.doc_id for r in z.select("doc_id").collect()]) for name, a, z in kept}

    before, after = rows["language_id"]
    use = language_id.Classifier(language_id.learn(kept[0][1], F.lit(True)))
    told = [use.predict(t) for _, t, _ in before]
    assert sorted(after) == sorted(i for (i, _, _), p in zip(before, told, strict=True) if p[0] != "und" and p[2] >= language_id.MARGIN)

    before, after = rows["exact_dedup"]
    top = {}
    for i, t, _ in before:
        top[t] = max(i, top.get(t, i))
    assert sorted(after) == sorted(top.values())

    before, after = rows["jaccard_join"]
    assert sorted(after) == sorted({c for _, c in plain_links([(i, t) for i, t, _ in before], percent=80, n=5).values()})

    before, after = rows["mixing"]
    sizes = {i: len((t or "").encode().split()) for i, t, _ in before}
    times = Counter(after)
    assert max(times.values()) <= mixing.CAP
    assert abs(sum(sizes[i] * n for i, n in times.items()) - mixing.SHARE * sum(sizes.values())) <= 20 * max(sizes.values()) / 2

    path, pattern = bpe.default_vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    want = Counter((i, len(library.encode_ordinary(t))) for i, t, _ in rows["bpe"][0])
    assert Counter((r.doc_id, r.n_tokens) for r in kept[-1][2].collect()) == want


def test_odd_rows_in_every_stage(spark):
    long = "the quick brown fox and the lazy dog " * 20_000
    texts = [None, "", " ", "the house and the garden", "the house and the garden", "das Haus und der Garten im Licht", long, long, "123"]
    rows = [(i if i != 7 else None, t, ["en", None][i % 2], [None, "a"][i % 3 > 0], "x", "y", 1, 2) for i, t in enumerate(texts)]
    rows.append((3, "the house and the garden", "en", "a", "x", "y", 1, 2))
    schema = "doc_id long, text string, lang string, source string, _id string, language_id string, rank int, copies int"
    docs = spark.createDataFrame(rows, schema)
    for k, (_, stage) in enumerate(pipeline.STAGES):
        out, none = stage(spark, docs, DATA), stage(spark, docs.limit(0), DATA)
        assert out.collect() and none.count() == 0
        if k < len(pipeline.STAGES) - 1:
            assert out.columns == docs.columns
    kept = pipeline.drop_near_copies(spark, docs, DATA)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 3, 5, 6, 8]

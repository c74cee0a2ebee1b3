"""The near-copy stage takes five words at 80 %: it links a copy that three words at 90 % don't."""

import corpus_pipeline as pipeline


def test_copy_between_the_thresholds(spark):
    words = [f"w{k}" for k in range(100)]
    copy = list(words)
    copy[30], copy[70] = "x", "y"
    other = [f"o{k}" for k in range(100)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(copy)), (3, " ".join(other))], "doc_id long, text string")

    def kept(**at):
        return sorted(r.doc_id for r in pipeline.drop_near_copies(spark, docs, "", **at).collect())

    assert kept() == [1, 3]
    assert kept(n=3, percent=90) == [1, 2, 3]

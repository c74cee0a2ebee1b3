from veilspark.operators import mentions


def test_grounded_and_deduplicated(spark):
    docs = spark.createDataFrame([("d", "Ann met Bo, and ann left"), ("e", "")], "document_id string, body string")
    rows = [
        ("d", 0, 3, "name", "odd", "Ann", 1), ("d", 5, 9, "name", "author", "Ann", 2), ("d", 8, 10, "name", "author", "Bo", 3),
        ("d", 8, 10, "name", "referee", "Bo", 4), ("d", 8, 10, "secret", "author", "Bo", 5), ("d", 0, 2, "name", "author", "Zed", 6), ("e", 0, 3, "name", "author", "Ann", 7),
    ]
    proposals = spark.createDataFrame(rows, "document_id string, start int, end int, kind string, role string, text string, ord int")
    found = mentions.grounded(proposals, docs, ["name"], ["author", "referee"])
    got = sorted((r.start, r.end, r.role, r.ord) for r in mentions.deduplicated(found).collect())
    assert got == [(0, 3, "author", 2), (8, 10, "author", 3), (16, 19, "author", 2)]
    assert mentions.deduplicated(mentions.grounded(proposals.limit(0), docs, ["name"], [])).count() == 0

import json

import pytest
from pyspark.sql import functions as F

from veilspark.operators.backends import pattern_backend
from veilspark.operators.gate import leak_report
from veilspark.sources import readers, writers
from veilspark.streaming import ingest


def test_listing_and_checksums(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "cv.pdf").write_bytes(b"x")
    assert [tuple(r) for r in readers.listing(spark, str(tmp_path)).collect()] == [("a/cv.pdf", 1)]
    assert readers.checksums(spark, str(tmp_path)).first().sha256.startswith("2d711642")


def test_json_sources(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps({"k": 1}))
    (tmp_path / "y.json").write_text(json.dumps({"k": 1}))
    assert readers.aggregates(spark, [str(tmp_path / "x.json")], "k int", ["k"]).count() == 1
    with pytest.raises(ValueError, match="duplicate"):
        readers.aggregates(spark, [str(tmp_path / "x.json"), str(tmp_path / "y.json")], "k int", ["k"])
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "good.jsonl").write_text('{"text": "a"}\n{"text": "b"}\n')
    (tmp_path / "l" / "bad.jsonl").write_text('{"text": "a"}\nnot json\n')
    got = sorted(r.text for r in readers.lenient_letters(spark, str(tmp_path / "l")).collect())
    assert got == ["a", "b", '{"text": "a"}\nnot json\n']


def test_decisions(spark, tmp_path):
    (tmp_path / "d.csv").write_text("document_id,decision\na,preserve\nb,\n")
    assert [tuple(r) for r in readers.decisions(spark, str(tmp_path / "d.csv"), ["document_id", "decision"], ["preserve", "withhold"]).collect()] == [("a", "preserve")]
    with pytest.raises(ValueError, match="decision"):
        readers.decisions(spark, str(tmp_path / "d.csv"), ["document_id", "decision"], ["withhold"])


def test_package_is_published_whole_or_not_at_all(spark, tmp_path):
    table = spark.createDataFrame([("=1+1", [1, 2])], "a string, b array<int>")
    values = spark.createDataFrame([("t", "a", "mail x@y.org")], "file string, field string, value string")
    out = str(tmp_path / "package")
    with pytest.raises(ValueError, match="leaks"):
        writers.publish({"t": table}, leak_report(values), out)
    assert not (tmp_path / "package").exists()
    writers.publish({"t": table}, leak_report(values.limit(0)), out)
    assert [tuple(r) for r in spark.read.csv(f"{out}/t", header=True, escape='"').collect()] == [("'=1+1", "[1,2]")]
    listed = spark.read.json(f"{out}/manifest")
    assert writers.changed_files(listed, writers.manifest(spark, f"{out}/t")).count() == 0


def test_stream_gates_each_document_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("d0", "a@b.org"), ("d1", "x")], "document_id string, text string").write.parquet(source)
    for _ in range(2):
        query = ingest.gated(ingest.stream(spark, source, "document_id string, text string"), out, str(tmp_path / "state"))
        query.awaitTermination(120)
    got = spark.read.parquet(out).select("document_id", "redacted", F.col("release_status")).orderBy("document_id").collect()
    assert [r.redacted for r in got] == ["[[EMAIL]]", "x"]
    assert [r.release_status for r in got] == ["review_required", "review_required"]
    named = pattern_backend({"person_name": "x"})
    query = ingest.gated(ingest.stream(spark, source, "document_id string, text string"), f"{out}-named", str(tmp_path / "other"), named)
    query.awaitTermination(120)
    got = spark.read.parquet(f"{out}-named").orderBy("document_id").collect()
    assert [(r.redacted, r.release_status) for r in got] == [("[[EMAIL]]", "validated_candidate"), ("[[PERSON:None]]", "validated_candidate")]

"""The gate with a model's two scans."""

import pytest

from veilspark.operators import backends, gate
from veilspark.plans.queries import QUERIES

NAMES = backends.pattern_backend({"person_name": r"Ann [A-Z]\w+", "date": r"May \d+"})


@pytest.fixture
def texts(spark):
    rows = [("d0", "Ann Lee met Bo. later, Ann Lee wrote to ann@example.com"), ("d1", "seen on May 12"), ("d2", "plain"), ("d3", "")]
    return spark.createDataFrame(rows, "document_id string, text string")


def test_model_spans_are_replaced_or_reviewed(texts):
    got = {r.document_id: r for r in gate.gate(texts, backend=NAMES).collect()}
    assert {k: v.release_status for k, v in got.items()} == {"d0": "validated_candidate", "d1": "review_required", "d2": "validated_candidate", "d3": "validated_candidate"}
    assert "Ann Lee" not in got["d0"].redacted and got["d0"].replacement_count == 3
    assert got["d1"].redacted == "seen on May 12"


def test_model_sees_only_the_first_occurrence(spark):
    once = lambda: lambda t: [(0, 7, "person_name", "Ann Lee", 0.9)] if t.startswith("Ann Lee") else []
    docs = spark.createDataFrame([("d", "Ann Lee and Ann Lee")], "document_id string, text string")
    row = gate.gate(docs, backend=once).first()
    assert "Ann Lee" not in row.redacted and row.release_status == "validated_candidate" and row.replacement_count == 2


def test_null_backend_is_no_scan(texts):
    assert {r.release_status for r in gate.gate(texts, backend=backends.null_backend).collect()} == {"review_required"}


def test_query_does_not_validate_what_no_model_saw(spark):
    got = {r.release_status for r in QUERIES["release_status"](spark, "/root/testdata/sf0.001").select("release_status").collect()}
    assert "validated_candidate" not in got and "review_required" in got

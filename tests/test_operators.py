import itertools
import random

import pytest
from pyspark.sql import functions as F

from veilspark.functions import scalars as C
from veilspark.functions.geometry import box, horizontal_gap, iou
from veilspark.operators import backends, gate, incremental, inventory, merging, resolution, sampling, sets
from veilspark.operators.graph import connected_components


def docs(spark, *texts):
    return spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "document_id string, text string")


def value(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    ("given", "want"),
    [("2022", "2020-2024"), ("May 1999", "1995-1999"), ("Current", "present"), ("", None), (None, None), ("12022", None), ("n.d.", None)],
)
def test_five_year_bucket(spark, given, want):
    assert value(spark, C.five_year_bucket(F.lit(given).cast("string"))) == want


def test_identity_values(spark):
    def norm(kind, v):
        return value(spark, C.identity_value(F.lit(kind), F.lit(v)))

    assert norm("email", " A@B.Org. ") == "a@b.org"
    assert norm("phone_number", "+1 (555) 1") == "15551"
    assert norm("website", "HTTPS://www.Site.org/me/") == "site.org/me"
    assert norm("unique_identifier", "https://orcid.org/0000-x") == "0000-X"
    assert norm("person_name", "Dr. Ann  O'Neil-Smith, Prof") == "ann o'neil-smith"


def test_normalized_key_folds_compatibility_forms(spark):
    assert value(spark, C.normalized_key(F.lit("Ｆull Straße—ÉX"))) == "full strasse éx"


def test_controlled_values_are_suppressed(spark):
    field = C.public_field(F.lit("555-111-2222"), F.lit("found"), F.lit(0.9), F.array(F.lit("z")), "degree_type")
    got = value(spark, field)
    assert (got.value, got.status, got.validation_flags) == (None, "uncertain", ["invalid_controlled_value_suppressed", "z"])


def test_model_json_and_percentiles(spark):
    assert value(spark, C.model_json(F.lit('```json\nSure: {"a": 1}\n```'), "a int")).a == 1
    ten = F.array(*[F.lit(float(i)) for i in range(1, 11)])
    assert value(spark, C.percentile_rank_index(ten, 0.9)) == 10.0


def test_boxes(spark):
    a, b = (box(*[F.lit(float(x)) for x in v]) for v in ((0, 0, 2, 2), (1, 1, 3, 3)))
    assert value(spark, iou(a, b)) == pytest.approx(1 / 7)
    assert value(spark, horizontal_gap(a, box(*[F.lit(float(x)) for x in (5, 0, 6, 1)]))) == 3.0


def test_gate_withholds_what_is_left_and_loses_no_document(spark):
    rows = docs(spark, "write to ann@example.com", "plain", "", None)
    aliases = spark.createDataFrame([("d1", "Plain"), ("d0", "plain"), ("d1", "12")], "document_id string, alias string")
    got = {r.document_id: r for r in gate.gate(rows.fillna(""), aliases, ner_available=True).collect()}
    assert {k: v.release_status for k, v in got.items()} == {"d0": "validated_candidate", "d1": "withheld", "d2": "validated_candidate", "d3": "validated_candidate"}
    assert got["d0"].redacted == "write to [[EMAIL]]"
    assert {r.release_status for r in gate.gate(rows.fillna("")).collect()} == {"review_required"}
    some = gate.gate(rows.fillna(""), ner_available=F.when(F.col("document_id") == "d1", F.lit(True)))
    assert {r.document_id: r.release_status for r in some.collect()} == {"d0": "review_required", "d1": "validated_candidate", "d2": "review_required", "d3": "review_required"}


def test_redactions_restore_the_text(spark):
    text = "a@b.org and (555) 123-4567 or https://x.y/z?q=1 end"
    done = gate.substitute(gate.mentions(docs(spark, text)))
    out, restored, at = done.first().redacted, "", 0
    for r in sorted(gate.redactions(done).collect(), key=lambda r: r.start):
        before = text[at : r.start]
        restored, out, at = restored + before + r.text, out[len(before) :], r.end
        out = out[out.index("]]") + 2 :]
    assert restored + out == text


def test_leak_report(spark):
    ids = "document_947a3682734684b5c57f"
    rows = [("a.csv", "document_id", ids), ("a.csv", "note", "mail a@b.org"), ("b.csv", "entity_id", "5551112222"), ("c.csv", "x", "fine")]
    report = gate.leak_report(spark.createDataFrame(rows, "file string, field string, value string"))
    assert {r.file: r.findings for r in report.collect()} == {"a.csv": ["email", "website"], "b.csv": ["non_opaque_id"]}


def test_review_decisions(spark):
    results = spark.createDataFrame([("a", "review_required"), ("b", "validated_candidate")], "document_id string, release_status string")
    decisions = spark.createDataFrame([("a", "preserve"), ("b", "withhold")], "document_id string, decision string")
    assert {r.document_id: r.release_status for r in gate.apply_review(results, decisions).collect()} == {"a": "validated_candidate", "b": "validated_candidate"}
    assert [r.document_id for r in gate.unmatched_decisions(results, decisions).collect()] == ["b"]


def test_inventory(spark):
    files = ["a/cv.pdf", "a/L2.pdf", "a/l1.PDF", "a/x.txt", "b/recvd.pdf", ".h/cv.pdf", "c/d/cv.pdf", "../e/cv.pdf", "b/cv.pdf", "b/my_cv.pdf"]
    apps, found = inventory.inventory(spark.createDataFrame([(f,) for f in files], "path string"), "root")
    assert {r.folder: (r.status, r.inventory_flags) for r in apps.collect()} == {
        "a": ("inventoried", []), "b": ("inventory_flagged", ["multiple_cv_candidates", "unexpected_recommendation_letter_count"]),
    }
    assert sorted((r.source_relative_path, r.document_type, r.letter_index) for r in found.collect()) == [
        ("a/L2.pdf", "letter", 2), ("a/cv.pdf", "cv", None), ("a/l1.PDF", "letter", 1), ("b/recvd.pdf", "letter", 1),
    ]
    assert inventory.collisions(found, "document_id").count() == 0


def test_components_of_random_graphs(spark):
    random.seed(5)
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7), (None, 3)]
    top = {v: v for e in edges if None not in e for v in e}
    for _, (a, b) in itertools.product(range(60), [e for e in edges if None not in e]):
        top[a] = top[b] = min(top[a], top[b])
    got = connected_components(spark.createDataFrame(edges, "src long, dst long"))
    assert {r.vertex: r.component for r in got.collect()} == top
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_merging_never_joins_disjoint_ids(spark):
    evidence = spark.createDataFrame([(1, 2, 0.9, "n"), (2, 3, 0.8, "n"), (4, 5, 0.8, "n")], "src long, dst long, confidence double, kind string")
    ids = spark.createDataFrame([(1, "A"), (3, "B"), (4, "C")], "party long, normalized_value string")
    got = merging.constrained_components(evidence, ids, "party").collect()
    assert {r.party: r.person for r in got} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}


def test_names_and_strong_edges(spark):
    names = spark.createDataFrame([(1, "anna maria gonzalez"), (2, "anna mariya gonzalez"), (3, "bob gonzalez")], "party long, name string")
    assert [(r.left_name, r.right_name) for r in resolution.name_pairs(names, "party", "name").collect()] == [("anna maria gonzalez", "anna mariya gonzalez")]
    ids = spark.createDataFrame(
        [(1, "email", "A@b.org", True), (2, "email", "a@b.org.", True), (3, "email", "a@b.org", False)], "party long, identifier_type string, value string, verified boolean"
    )
    assert [tuple(r) for r in resolution.strong_edges(resolution.identifiers(ids), "party").collect()] == [(1, 2)]


@pytest.mark.parametrize("n", [0, 5, 20, 137])
def test_review_sample_ranks(spark, n):
    rows = spark.range(n).withColumn("risk", F.col("id") % 7)
    got = sorted(r.id for r in sampling.risk_sample(rows, [F.desc("risk"), F.asc("id")], 0.1, 20).collect())
    ranked = sorted(range(n), key=lambda i: (-(i % 7), i))
    count = min(n, max(20, int(n * 0.1 + 0.999)))
    assert got == sorted(ranked[k] for k in sampling.stride(count, n, max(1, count // 2)))


def test_sets(spark):
    rows = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "c", 1)], "k long, v string, o int")
    assert sorted((r.k, r.v) for r in sets.first_by(rows, ["k"], ["o"]).collect()) == [(1, "b"), (2, "c")]
    assert sorted((r.k, r.v) for r in sets.last_by(rows, ["k"], ["o"]).collect()) == [(1, "a"), (2, "c")]
    page = spark.createDataFrame([(1, 1, "Smith 2001 On things and more of them"), (1, 2, "On things")], "page int, id int, text string")
    assert [r.id for r in sets.contained_citations(page, ["page"], "id", "text").collect()] == [1]


def test_incremental(spark):
    state = spark.createDataFrame([("a", "s", "completed", "f1", 0, None), ("b", "s", "failed", "f1", 1, "x")], "document_id string, stage string, status string, stage_fingerprint string, retry_count int, failure_code string")
    inputs = spark.createDataFrame([("a", "f1"), ("a", "f2"), ("b", "f1")], "document_id string, stage_fingerprint string")
    assert sorted(map(tuple, incremental.pending(inputs, state).collect())) == [("a", "f2"), ("b", "f1")]
    failures = spark.createDataFrame([("b", "s", "y"), ("c", "s", "z")], "document_id string, stage string, failure_code string")
    got = {r.document_id: (r.status, r.retry_count) for r in incremental.record_failures(state, failures).collect()}
    assert got == {"a": ("completed", 0), "b": ("failed", 2), "c": ("failed", 1)}


def test_backend_spans_are_checked(spark):
    good = backends.pattern_backend({"person_name": r"Ann \w+"})
    got = backends.detect(docs(spark, "Ann Lee met [[PERSON:Ann X]]", None), good).collect()
    assert [[(s.start, s.end, s.kind) for s in r.model_spans] for r in got] == [[(0, 7, "person_name")], []]
    assert backends.valid("abc", [(0, 9, "k", "abc", 1.0), (0, 2, "k", "xx", 1.0), (0, 1, "k", "a", 1.0), (0, 1, "k", "a", 1.0)]) == [(0, 1, "k", "a", 1.0)]

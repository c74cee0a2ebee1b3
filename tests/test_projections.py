import random

import pytest
from pyspark.sql import functions as F

from veilspark.operators import incremental, merges, registry


def plain_merge(rows):
    def share(a, b):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        both = max(w, 0) * max(h, 0)
        return both / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both)

    kept = []
    for doc, page, kind, ord_, box, source, role, text in sorted(rows, key=lambda r: r[3]):
        for k in kept:
            same = k[2] == kind or {k[2], kind} <= {"email", "website"}
            if k[:2] == [doc, page] and same and share(k[4], box) >= 0.35:
                k[4] = [min(k[4][0], box[0]), min(k[4][1], box[1]), max(k[4][2], box[2]), max(k[4][3], box[3])]
                k[5] = "+".join(sorted(set(k[5].split("+")) | {source}))
                k[6] = role if k[6] == "unknown" else k[6]
                k[7] = text if source == "pdf_regex" else k[7]
                break
        else:
            kept.append([doc, page, kind, ord_, list(box), source, role, text])
    return sorted(kept)


def test_occurrences_merge_as_in_a_plain_loop(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        x, y = rng.uniform(0, 40), rng.uniform(0, 40)
        box = (x, y, x + rng.uniform(5, 15), y + rng.uniform(5, 15))
        role = rng.choice(["unknown", "applicant"])
        rows.append((i % 2, rng.randint(1, 2), rng.choice(["email", "website", "address"]), i, box, rng.choice(["model", "pdf_regex"]), role, f"t{i}"))
    flat = [(*r[:4], *r[4], *r[5:]) for r in rows]
    names = ["document_id", "page", "category", "ord", *merges.BOX, "source", "role", "text"]
    got = merges.merged_occurrences(spark.createDataFrame(flat, names)).collect()
    assert sorted([list(r[:4]) + [list(r[4:8])] + list(r[8:]) for r in got]) == plain_merge(rows)
    assert merges.merged_occurrences(spark.createDataFrame(flat, names).limit(0)).count() == 0


def test_chunks_without_anything(spark):
    schema = "document_id int, section string, chunk int, status string, model_confidence double, items array<string>"
    rows = [(1, "education", 2, "model_failed", 0.2, []), (1, "education", 1, "not_found", 0.9, []), (2, "education", 1, "found", None, ["a"]), (2, "education", 2, "found", 0.5, ["b"])]
    got = {r.document_id: r for r in merges.merged_sections(spark.createDataFrame(rows, schema)).collect()}
    assert (got[1].status, got[1].model_confidence, got[1].items) == ("model_failed", 0.2, [])
    assert (got[2].status, got[2].model_confidence, got[2].items) == ("found", None, ["a", "b"])
    assert merges.merged_letters(spark.createDataFrame(rows[:1], schema)).first().model_confidence is None


def test_an_import_is_made_once(spark):
    persons = spark.createDataFrame([("person_1", "active"), ("person_2", "merged"), ("group_3", "active"), ("person_4", None)], "person_id string, status string")
    ids = spark.createDataFrame([("person_1", "email", "A@x.org", True), ("person_1", "email", " ", True), ("person_2", "email", "b@x.org", True)], "person_id string, identifier_type string, value string, verified boolean")
    before = spark.createDataFrame([("one",)], "checksum string")
    entities, aliases = registry.imported(persons, ids, before, "two")
    assert sorted(r.entity_id for r in entities.collect()) == ["person_1", "person_4"]
    assert [r.normalized_value for r in aliases.collect()] == ["a@x.org"]
    assert not any(t.count() for t in registry.imported(persons, ids, before, "one"))


def test_a_folder_belongs_to_one_run():
    assert incremental.same_run(None, {"namespace": "a"}) == {"namespace": "a"}
    with pytest.raises(ValueError, match="namespace"):
        incremental.same_run({"namespace": "a"}, {"namespace": "b"})


def test_labels_of_unknown_kinds(spark):
    row = spark.range(1).select(registry.reason_label(F.lit("unknown"), F.lit("signature")).alias("a"), registry.reason_label(F.lit("primary_applicant"), F.lit("address")).alias("b")).first()
    assert tuple(row) == ("Unclassified signature", "Primary Applicant postal address")

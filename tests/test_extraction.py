"""Stored answers against a plain reader and grounder that walks one answer at a time."""

import copy
import hashlib
import json
import random
import re
from pathlib import Path

import pytest

from veilspark.functions.spans import PATTERNS
from veilspark.operators import extraction as E
from veilspark.operators.extraction import DERIVED, FIELDS, MENTION_KINDS, MENTION_ROLES, PROTECTED
from veilspark.plans import linkage_queries
from veilspark.plans.linkage_queries import QUERIES
from veilspark.plans.queries import documents

DATA = "/root/testdata/sf0.001"
SCHEMA = "document_id int, text string, response string"
WORDS = ["Lee", "lee", "State", "University", "Chemistry", "1999", "2001", "a@b.org", "(C++)", "naïve", "😀", "a.b"]


def value(v, status="found", sure=0.5, **places):
    return {"value": v, "status": status, "model_confidence": sure, **places}


def plain_at(text, pages, wanted, start, end, low=None, high=None):
    """(start, end, page, flags)"""

    def fits(a, b):
        return a is not None and b is not None and 0 <= a < b <= len(text)

    flags = []
    if not (fits(start, end) and text[start:end].lower() == wanted.lower()):
        if wanted == "":
            return None, None, None, ["missing_evidence"]
        bounded = fits(low, high)
        a, b = (low, high) if bounded else (0, len(text))
        seen = [m.start() for m in re.finditer("(?i)" + re.escape(wanted), text[a:b])]
        if len(seen) != 1:
            return None, None, None, ["ungrounded_value"]
        start, end = a + seen[0], a + seen[0] + len(wanted)
        flags = [f"offset_recovered_by_{'bounded' if bounded else 'unique'}_exact_match"]
    page = next((p for p, a, b in pages if a <= start and end <= b), None)
    return (None, None, None, ["evidence_crosses_page_boundary"]) if page is None else (start, end, page, flags)


def plain_field(text, pages, name, f, low=None, high=None):
    """(name, value, status, start, end, page, flags)"""
    v = None if f.get("value") is None else str(f["value"])
    if name in DERIVED:
        return name, v, f["status"], None, None, None, ["controlled_or_derived_value"]
    if f["status"] != "found" or v is None:
        return name, v, f["status"], None, None, None, []
    at = plain_at(text, pages, v, f.get("start"), f.get("end"), low, high)
    return name, v, "uncertain" if at[0] is None else "found", *at


def plain_fields(text, pages, answer):
    out = []
    for section, names in FIELDS.items():
        for i, item in enumerate(answer["sections"][section].get("items", [])):
            low, high = item.get("start"), item.get("end")
            fields = [(n, item[n]) for n in names] + [("author", a["name"]) for a in item.get("authors", [])]
            out += [(section, i, place, *plain_field(text, pages, n, f, low, high)) for place, (n, f) in enumerate(fields)]
    for name in ("research_fields", "research_methods"):
        out += [(name, None, place, *plain_field(text, pages, name, f)) for place, f in enumerate(answer.get(name, []))]
    return out


def plain_mentions(text, pages, answer):
    """{(start, end, kind): (role, text, detector)}"""
    out = {}

    def add(start, end, kind, role, words, detector):
        old = out.get((start, end, kind))
        if old is None or (old[0] == "unknown" and role != "unknown"):
            out[start, end, kind] = (role, words, detector)

    def on_page(a, b):
        return any(low <= a and b <= high for _, low, high in pages)

    for m in answer.get("mentions", []):
        if m["identifier_type"] not in MENTION_KINDS:
            continue
        role = m.get("person_role", "unknown") if m.get("person_role") in MENTION_ROLES else "unknown"
        at = plain_at(text, pages, m["text"], m["start"], m["end"])
        places = [at[:2]] if at[0] is not None else [x.span() for x in re.finditer("(?i)" + re.escape(m["text"]), text)] if m["text"] else []
        for a, b in places:
            if on_page(a, b):
                add(a, b, m["identifier_type"], role, m["text"], "model")
    for kind, pattern in PATTERNS:
        for x in re.finditer(pattern, text, re.ASCII):
            if on_page(*x.span()):
                add(*x.span(), kind, "unknown", x.group(), "regex")
    own = [f for f in plain_fields(text, pages, answer) if f[3] in PROTECTED and f[6] is not None]
    applicants = [a.get("is_applicant") for i in answer["sections"]["publications"].get("items", []) for a in i.get("authors", [])]
    authors = iter([f for f in plain_fields(text, pages, answer) if f[3] == "author"])
    is_applicant = {(f[1], f[2]): a for f, a in zip(authors, applicants, strict=True)}
    for section, item, place, name, v, _, start, end, _, _ in own:
        kind, role = PROTECTED[name]
        if name == "author" and section == "publications" and is_applicant[item, place]:
            role = "applicant"
        old = out.get((start, end, kind))
        out[start, end, kind] = (old[0], old[1], "structured") if old else (role, v, "structured")
    return out


def made(rng):
    text = rng.choice(["", "Education\n"]) + " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 14)))

    def place():
        if rng.random() < 0.3:
            return {}
        if rng.random() < 0.4 and text:
            a = rng.randrange(len(text))
            return {"start": a, "end": a + rng.randint(0, 6)}
        return {"start": rng.randint(-2, 8), "end": rng.randint(-2, 40)}

    def field(v=None):
        status = rng.choice(["found", "found", "found", "not_found", "uncertain", "model_failed", "not_applicable"])
        v = rng.choice([*WORDS, 1999, 2001, "state university", "", "zz"]) if v is None else v
        spot = place()
        at = text.lower().find(str(v).lower())
        if rng.random() < 0.4 and at >= 0:
            spot = {"start": at, "end": at + len(str(v))}
        return value(v if status == "found" else rng.choice([None, v]), status, None if status == "model_failed" else 0.5, **spot)

    def section(name):
        items = []
        for _ in range(rng.choice([0, 1, 1, 2])):
            item = {n: field() for n in FIELDS[name]} | {"model_confidence": 0.25} | place()
            if name == "publications":
                item["authors"] = [{"name": field(), "author_position": i + 1, "is_applicant": rng.choice([None, True, False])} for i in range(rng.randint(0, 2))]
            items.append(item)
        return {"status": "found" if items else "not_found", "model_confidence": 0.5, "items": items}

    answer = {"sections": {s: section(s) for s in FIELDS}, "research_fields": [field() for _ in range(rng.randint(0, 2))]}
    answer["mentions"] = [
        {"identifier_type": rng.choice(["person_name", "email", "colour"]), "person_role": rng.choice(["applicant", "unknown", "cook"]), "text": rng.choice(WORDS),
         "start": 0, "end": rng.choice([0, 3]), "model_confidence": 0.5} for _ in range(rng.randint(0, 3))
    ]
    cut = rng.randint(0, len(text))
    return text, [(1, 0, cut), (2, cut, len(text))], answer


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(5)
    return [made(rng) for _ in range(150)]


@pytest.fixture(scope="module")
def parsed(spark, cases):
    rows = [(i, t, p, json.dumps(a)) for i, (t, p, a) in enumerate(cases)]
    df = spark.createDataFrame(rows, "document_id int, text string, pages array<struct<page:int,document_start:int,document_end:int>>, response string")
    return E.parse(E.read(df), pages="pages").cache()


def test_fields_as_the_plain_reader(parsed, cases):
    assert parsed.where("size(faults) > 0").count() == 0
    columns = ["document_id", "section", "item", "place", "name", "value", "status", "start", "end", "page", "flags"]
    got = {(*r[:-1], tuple(r[-1])) for r in E.fields(parsed).select(*columns).collect()}
    want = {(i, *f[:-1], tuple(f[-1])) for i, (t, p, a) in enumerate(cases) for f in plain_fields(t, p, a)}
    assert got == want
    seen = {f for *_, fs in want for f in fs}
    assert seen == {
        "controlled_or_derived_value", "ungrounded_value", "missing_evidence", "evidence_crosses_page_boundary",
        "offset_recovered_by_bounded_exact_match", "offset_recovered_by_unique_exact_match",
    }


def test_mentions_as_the_plain_reader(parsed, cases):
    got = {}
    for r in E.mentions(parsed).collect():
        assert (r.document_id, r.start, r.end, r.kind) not in got
        got[r.document_id, r.start, r.end, r.kind] = (r.role, r.text, r.detector)
        assert r.mention_id == "mention_" + hashlib.sha256(f"{r.document_id}:{r.start}:{r.end}:{r.kind}".encode()).hexdigest()[:20]
        assert r.local_entity_id == "local_" + hashlib.sha256(f"{r.document_id}:{r.role}:{r.text.casefold()}".encode()).hexdigest()[:20]
    want = {(i, *k): v for i, (t, p, a) in enumerate(cases) for k, v in plain_mentions(t, p, a).items()}
    assert got == want
    assert {d for _, _, d in want.values()} == {"model", "regex", "structured"}


GOOD = {
    "sections": {
        "education": {"status": "found", "model_confidence": 0.5, "items": [{n: value("Lee") for n in FIELDS["education"]} | {"model_confidence": 0.5, "start": 3, "end": 9}]},
        "employment": {"status": "model_failed", "model_confidence": None, "not_found_reason": None},
        "publications": {
            "status": "found", "model_confidence": 1,
            "items": [{n: value("Lee") for n in FIELDS["publications"]} | {"model_confidence": 0, "authors": [{"name": value("Lee"), "author_position": 1}]}],
        },
    },
    "mentions": [{"identifier_type": "email", "text": "a@b.org", "start": 0, "end": 0, "model_confidence": 0.5}],
}
EDU, PUB = "sections.education.items[0]", "sections.publications.items[0]"


def changed(path, new):
    answer = copy.deepcopy(GOOD)
    *steps, last = path
    at = answer
    for step in steps:
        at = at[step]
    at[last] = new
    return json.dumps(answer)


ITEM = ("sections", "education", "items", 0)
FAULTS = [
    (changed((*ITEM, "field"), value("x", sure=1.5)), [(f"{EDU}.field", "confidence")]),
    (changed((*ITEM, "field"), value("x", sure="high")), [(f"{EDU}.field", "confidence")]),
    (changed((*ITEM, "field"), value("x", sure=None)), [(f"{EDU}.field", "confidence_and_status")]),
    (changed((*ITEM, "field"), value(None)), [(f"{EDU}.field", "value")]),
    (changed((*ITEM, "field"), value("x", "maybe")), [(f"{EDU}.field", "status")]),
    (changed((*ITEM, "field"), value("x", start="here")), [(f"{EDU}.field", "offsets")]),
    (changed((*ITEM, "field"), None), [(f"{EDU}.field", "missing")]),
    (changed((*ITEM, "field"), value("x", colour=1)), [(f"{EDU}.field", "keys")]),
    (changed((*ITEM, "authors"), []), [(EDU, "keys")]),
    (changed((*ITEM, "model_confidence"), None), [(EDU, "confidence_missing")]),
    (changed(("sections", "education", "items"), "none"), [("sections.education.items", "unreadable")]),
    (changed(("sections", "education", "items"), [None]), [("sections.education.items", "unreadable")]),
    (changed(("sections", "employment", "model_confidence"), 0.5), [("sections.employment", "confidence_and_status")]),
    (changed(("sections", "employment", "status"), "not_applicable"), [("sections.employment", "status")]),
    (changed(("sections", "employment"), None), [("sections.employment", "missing")]),
    (changed(("sections", "publications", "items", 0, "authors", 0, "author_position"), 0), [(f"{PUB}.authors[0]", "author_position")]),
    (changed(("sections", "publications", "items", 0, "authors", 0, "is_applicant"), "perhaps"), [(f"{PUB}.authors[0]", "is_applicant")]),
    (changed(("mentions", 0, "model_confidence"), None), [("mentions[0]", "confidence_missing")]),
    (changed(("mentions", 0, "start"), None), [("mentions[0]", "offsets")]),
    (changed(("extra",), 1), [("answer", "keys")]),
    (changed(("sections", "awards"), {}), [("answer", "section_keys")]),
    (changed(("sections",), []), [("sections", "missing")]),
    (json.dumps(GOOD)[:-9], [("answer", "unreadable")]),
    ("no idea", [("answer", "unreadable")]),
    ("", [("answer", "unreadable")]),
    (None, [("answer", "missing")]),
    (json.dumps(GOOD), []),
    (f"Here it is:\n```json\n{json.dumps(GOOD)}\n```", []),
    (json.dumps(GOOD).replace('"status": "found"', '"status": "found", "status": "found"', 1), []),
]


def test_each_breach_is_named_and_no_answer_is_lost(spark):
    rows = [(i, "Lee and a@b.org", r) for i, (r, _) in enumerate(FAULTS)]
    parsed = E.parse(E.read(spark.createDataFrame(rows, SCHEMA))).cache()
    got = {i: [] for i in range(len(rows))}
    for r in E.faults(parsed).collect():
        got[r.document_id].append((r.path, r.reason))
    assert got == {i: f for i, (_, f) in enumerate(FAULTS)}
    used = {r.document_id for r in E.sections(parsed).collect()}
    assert used == {i for i, (_, f) in enumerate(FAULTS) if not f}
    assert {r.document_id for r in E.fields(parsed).collect()} == used


def test_sections_say_what_headings_promise(spark):
    text = "Education\n- 1999 one\n- 2001 two\n\nPublications\n"
    empty = {s: {"status": "not_found", "model_confidence": 0.5, "not_found_reason": "none"} for s in FIELDS}
    one = copy.deepcopy(empty)
    one["education"] |= {"status": "found", "items": GOOD["sections"]["education"]["items"]}
    rows = [(0, text, json.dumps({"sections": empty})), (1, text, json.dumps({"sections": one})), (2, None, json.dumps({"sections": empty}))]
    got = {(r.document_id, r.section): (r["items"], r.validation_flags) for r in E.sections(E.parse(E.read(spark.createDataFrame(rows, SCHEMA)))).collect()}
    gap, bare = "candidate_entry_coverage_gap", "detected_heading_without_extracted_items"
    assert got == {
        (0, "education"): (0, [bare, gap]), (0, "employment"): (0, []), (0, "publications"): (0, [bare]),
        (1, "education"): (1, [gap]), (1, "employment"): (0, []), (1, "publications"): (0, [bare]),
        (2, "education"): (0, []), (2, "employment"): (0, []), (2, "publications"): (0, []),
    }


def test_replay_of_saved_answers(spark):
    docs = spark.createDataFrame([(0, "Lee"), (1, "Lee"), (2, None)], "document_id int, text string")
    saved = spark.createDataFrame([(0, json.dumps(GOOD)), (2, json.dumps(GOOD)), (9, "{}")], "document_id int, response string")
    parsed = E.parse(E.replayed(docs, saved)).cache()
    assert sorted(r.document_id for r in parsed.collect()) == [0, 1, 2]
    assert [tuple(r) for r in E.faults(parsed).collect()] == [(1, "answer", "missing")]
    found = {(r.document_id, r.name, r.status) for r in E.fields(parsed).where("name = 'institution'").collect()}
    assert found == {(0, "institution", "found"), (2, "institution", "uncertain")}
    ids = {r.item_id for r in E.fields(parsed).where("document_id = 0 AND section = 'education'").collect()}
    assert ids == {"education_" + hashlib.sha256(b"0:0:3").hexdigest()[:20]}
    for table in (E.faults, E.sections, E.fields, E.mentions):
        assert table(E.parse(E.replayed(docs.limit(0), saved))).count() == 0


def test_long_text_and_many_items(spark):
    text = " ".join(f"w{i:05d}x" for i in range(20_000))
    items = [{n: value(f"W{i:05d}X") for n in FIELDS["education"]} | {"model_confidence": 0.5, "start": 8 * i, "end": 8 * i + 40} for i in range(0, 20_000, 1000)]
    answer = copy.deepcopy(GOOD)
    answer["sections"]["education"]["items"] = items
    found = E.fields(E.parse(E.read(spark.createDataFrame([(0, text, json.dumps(answer))], SCHEMA)))).where("name = 'institution'")
    assert [r.start for r in found.orderBy("item").collect()] == [8 * i for i in range(0, 20_000, 1000)]


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
def test_query_of_mentions_as_the_plain_reader(spark):
    answers = linkage_queries._answers(documents(spark, DATA).select("doc_id", "text")).collect()
    faulty = {r.doc_id for r in QUERIES["answer_faults"](spark, DATA).select("doc_id").distinct().collect()}
    assert 0 < len(faulty) < len(answers)
    used = [r for r in answers if r.doc_id not in faulty]
    want = {(r.doc_id, *k): v for r in used for k, v in plain_mentions(r.text, [(1, 0, len(r.text))], json.loads(r.response)).items()}
    got = {(r.doc_id, r.start, r.end, r.kind): (r.role, r.text, r.detector) for r in QUERIES["answer_mentions"](spark, DATA).collect()}
    assert got == want

"""Repair of rejected texts against a plain loop; a second run touches nothing that passed."""

import re

import pytest
from pyspark.sql import functions as F

from veilspark.functions import spans as S
from veilspark.operators import repair

NAMES = ["Ann Lee", "Bo", "Smith", "light"]
TEXTS = {
    "a": "Ann Lee met ann lee and Smith.", "b": "Nothing to see.", "c": "The lightning of Light; Smith", "d": "lightning only", "e": None, "f": "", "g": "Smith " * 2000,
}


def naive(values, most, log=None):
    """A check that reports the first `most` values whose letters stand in the text."""

    def check(rows):
        if log is not None:
            log.append({r.document_id for r in rows.select("document_id").collect()})
        kinds = F.array(*[F.struct(F.lit(v).alias("text"), F.lit("person_name").alias("kind")) for v in values])
        seen = F.filter(kinds, lambda f: F.contains(F.lower("masked"), F.lower(f["text"])))
        return rows.withColumn("flagged", F.slice(seen, 1, most))

    return check


def table(spark, texts):
    rows = spark.createDataFrame(list(texts.items()), "document_id string, text string")
    return rows.withColumn("spans", S.select_spans(S.detect(F.coalesce("text", F.lit(""))), ()))


def plain(text, most):
    """(status, checks, spans) of a text by a loop; the fixture's values never overlap."""
    text, spans, checks = text or "", set(), 0
    while True:
        checks += 1
        left = list(text)
        for a, b in spans:
            left[a:b] = " " * (b - a)
        left = "".join(left)
        flagged = [n for n in NAMES if n.lower() in left.lower()][:most]
        more = set()
        for n in flagged:
            token = rf"(?i)(?<!\w){re.escape(n)}(?!\w)"
            if len(n) > 2 and re.search(token, left):
                more |= {m.span() for m in re.finditer(token, text)}
        if not flagged:
            return "passed", checks, sorted(spans)
        if more <= spans:
            return "review", checks, sorted(spans)
        spans |= more


@pytest.mark.parametrize("most", [1, 10])
def test_as_the_plain_loop(spark, most):
    got = {r.document_id: r for r in repair.repair(table(spark, TEXTS), naive(NAMES, most)).collect()}
    assert set(got) == set(TEXTS)
    for k, text in TEXTS.items():
        r = got[k]
        assert (r.status, r.checks, [(s.start, s.end) for s in r.spans]) == plain(text, most)
        rest = (text or "")
        for a, b in reversed(plain(text, most)[2]):
            rest = rest[:a] + "#" + rest[b:]
        assert re.sub(r"\[\[PERSON:doc_[0-9a-f]+\]\]", "#", r.redacted) == rest


def test_second_run_touches_nothing_that_passed(spark):
    first = repair.repair(table(spark, TEXTS), naive(NAMES, 10))
    log = []
    again = repair.repair(table(spark, TEXTS), naive(NAMES, 10, log), state=first)
    assert log and log[0] == {"c", "d"}  # what was left to a person
    key = ["document_id", "status", "checks", "redacted", "content_sha256"]
    assert sorted(map(tuple, again.select(*key).collect())) == sorted(map(tuple, first.select(*key).collect()))


def test_changed_text_is_checked_again_and_others_stay(spark):
    first = repair.repair(table(spark, TEXTS), naive(NAMES, 10))
    log = []
    again = repair.repair(table(spark, {"a": TEXTS["a"], "b": "Smith now"}), naive(NAMES, 10, log), state=first)
    assert log == [{"b"}, {"b"}]
    got = {r.document_id: (r.status, r.checks) for r in again.collect()}
    assert set(got) == set(TEXTS) and got["b"] == ("passed", 2) and got["a"] == ("passed", 2)


def test_overlap_goes_to_the_span_before(spark):
    """A mail address stays one placeholder when the check reports a word of it and the word stands elsewhere too."""
    [r] = repair.repair(table(spark, {"m": "smith@x.org wrote; Smith"}), naive(["Smith"], 10)).collect()
    assert re.sub(r"doc_[0-9a-f]+", "d", r.redacted) == "[[EMAIL]] wrote; [[PERSON:d]]" and r.status == "passed"


def test_rounds_end(spark):
    """A check that always finds something, in text that always gains spans, ends with review."""
    [r] = repair.repair(table(spark, {"x": "one two three four five"}), naive(["one", "two", "three", "four"], 1), rounds=2).collect()
    assert (r.status, r.checks) == ("review", 2)


def test_empty_table(spark):
    assert repair.repair(table(spark, TEXTS).where("false"), naive(NAMES, 10)).count() == 0

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veilspark.functions import spans as S

PIECES = [
    "Ann", "ann@example.com", "(555) 123-4567", "+1 555.123.4567", "www.site.org/x", "https://a.b/c,d", "orcid: 0000-0002-1825-0097",
    "doi: 10.1000/xyz(1)", "13.149.130.89", "ß", "É", "\n", " ", "[[EMAIL]]", "no", "1", "ab.edu", "x" * 5,
]


def plain_detect(text):
    found = set()
    for kind, p in S.PATTERNS:
        found |= {(m.start(), m.end(), kind, m.group()) for m in re.finditer(p, text, re.ASCII)}
    return sorted(found)


def plain_select(spans):
    chosen = []
    for s in sorted(spans, key=lambda s: (-S.PRIORITY.get(s[2], 0), s[0] - s[1], s[0], s[2])):
        if s[2] != "date" and all(s[1] <= c[0] or s[0] >= c[1] for c in chosen):
            chosen.append(s)
    return sorted(chosen)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map(" ".join), min_size=30, max_size=60))
def test_detect_select_substitute_like_plain_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    df = df.withColumn("spans", S.detect(F.col("text"))).withColumn("chosen", S.select_spans(F.col("spans")))
    df = df.withColumn("out", S.substitute(F.col("text"), F.col("chosen"), lambda s: F.concat(F.lit("<"), s["kind"], F.lit(">"))))
    for r in df.collect():
        want = plain_detect(r.text)
        assert [tuple(s) for s in r.spans] == want
        chosen = plain_select(want)
        assert [tuple(s) for s in r.chosen] == chosen
        out, at = "", 0
        for s, e, kind, _ in chosen:
            out, at = out + r.text[at:s] + f"<{kind}>", e
        assert r.out == out + r.text[at:]


def one(spark, expr, **values):
    kinds = {str: "string", int: "int"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "alias", "n"),
    [("Anderson research", "And", 0), ("Repeated Alias, repeated  alias; REPEATED\nALIAS", "Repeated Alias", 3), ("Ann wrote annually.", "Ann", 1),
     ("ÉAnn Ann", "Ann", 1), ("a.b+c a.b+c", "a.b+c", 2), ("Élan élan", "élan", 2)],
)
def test_aliases_are_complete_tokens(spark, text, alias, n):
    assert len(one(spark, S.alias_occurrences(F.col("t"), F.col("a")), t=text, a=alias)) == n


def test_masks_keep_offsets(spark):
    assert one(spark, S.mask_placeholders(F.col("t")), t="a [[EMAIL]] b [[X:1]]") == "a           b        "


def test_evidence_is_direct_or_unique(spark):
    e = S.ground(F.col("t"), F.col("v"), F.col("s"), F.col("e"))
    assert one(spark, e, t="one two one", v="one", s=8, e=11).start == 8
    assert one(spark, e, t="one two one", v="two", s=999, e=1011).start == 4
    assert one(spark, e, t="one two one", v="one", s=999, e=1011) is None


def test_sections_and_candidates(spark):
    text = "Name\nEducation:\nPhD 2001\nnothing\n- item\nPublications\n1. Title\nother\n"
    found = {s.section: (s.heading_found, s.candidate_entry_count) for s in one(spark, S.sections(F.col("t")), t=text)}
    assert found == {"education": (True, 2), "employment": (False, 0), "publications": (True, 1), "research": (False, 0)}


@pytest.mark.parametrize("text", ["", "short", "a" * 25, "aaaa\nbbbbbbb\ncc" * 5, "\n" * 30, "abcdefgh\nij" * 9])
def test_chunks_join_to_the_text(spark, text):
    chunks = one(spark, S.chunks(F.col("t"), 10), t=text)
    assert "".join(c.text for c in chunks) == text
    assert all(len(c.text) <= 10 for c in chunks)
    assert [c.offset for c in chunks] == [sum(len(x.text) for x in chunks[:i]) for i in range(len(chunks))]
    for c in chunks[:-1]:
        tail = c.text if len(c.text) == 10 else text[c.offset : c.offset + 10]
        if "\n" in tail[5:]:
            assert c.text.endswith("\n")


def test_many_spans_and_long_texts_across_blocks(spark):
    parts = [PIECES[(i * i + 3 * i) % len(PIECES)] for i in range(900)]
    text = " ".join(parts) + " " + "ann@example.com" * 3 + " [[URL]] end"
    df = spark.createDataFrame([(text,)], "text string").withColumn("spans", S.detect(F.col("text")))
    df = df.withColumn("chosen", S.select_spans(F.col("spans"))).withColumn("masked", S.mask_placeholders(F.col("text")))
    r = df.withColumn("out", S.substitute(F.col("text"), F.col("chosen"), lambda s: F.concat(F.lit("<"), s["kind"], F.lit(">")))).first()
    want = plain_detect(text)
    assert len(want) > 5 * S.BLOCK
    assert [tuple(s) for s in r.spans] == want
    chosen = plain_select(want)
    assert [tuple(s) for s in r.chosen] == chosen
    out, at = "", 0
    for s, e, kind, _ in chosen:
        out, at = out + text[at:s] + f"<{kind}>", e
    assert r.out == out + text[at:]
    assert r.masked == re.sub(S.PLACEHOLDER, lambda m: " " * len(m.group()), text)


def test_every_match_has_its_hint():
    assert len(S.HINTS) == len(S.PATTERNS)
    for piece in PIECES:
        for (_, p), hint in zip(S.PATTERNS, S.HINTS, strict=True):
            assert not re.search(p, piece, re.ASCII) or re.search(hint, piece, re.ASCII)


def plain_chunks(text, most):
    out, at = [], 0
    while at < len(text):
        whole = text[at : at + most]
        cut = whole.rfind("\n") + 1 if at + most < len(text) else 0
        part = whole[:cut] if cut > most // 2 else whole
        out.append((at, part))
        at += len(part)
    return out


@pytest.mark.parametrize("most", [10, 37])
def test_chunks_of_more_than_one_window(spark, most):
    text = "".join("ß\n" if i % 11 == 0 else "ab"[i % 2] * (i % 5) for i in range(9000))
    got = one(spark, S.chunks(F.col("t"), most), t=text)
    assert [tuple(c) for c in got] == plain_chunks(text, most)
    assert one(spark, S.chunks(F.col("t"), most), t="") == []

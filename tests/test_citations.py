"""Blocks of citations against a plain walk over the text with a running rule."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veilspark.functions.citations import scholarly_pieces

START = re.compile(r"\b[A-Z][A-Za-z'-]+,\s*(?:[A-Z]\.\s*){1,3}(?=[,;]|\s+(?:19|20)\d{2}|\s*[“\"])")


def plain(block):
    """(start, end, text) of each citation, found author by author."""
    text = block.replace("_", " ")
    at = [m.start() for m in START.finditer(text)]
    thesis = re.match(r"(?i)\s*(thesis|dissertation)", text)
    begin = at[0] if at and not (thesis and len(at) == 1) else 0
    bounds, seen_to = [begin], begin
    for place in at if len(at) > 1 else []:
        if place > begin and re.search(r"[“\"]|\b(19|20)\d\d\b", text[bounds[-1] : place]):
            bounds.append(place)
    out = []
    for a, b in zip(bounds, [*bounds[1:], len(text)], strict=True):
        heading = re.search(r"(?i)\b(teaching experience|awards|references|presentations)\b", text[a:b])
        b = a + heading.start() if heading else b
        while a < b and (text[a].isspace() or text[a] in ",.;"):
            a += 1
        while a < b and (text[b - 1].isspace() or text[b - 1] in ",.;"):
            b -= 1
        words = text[a:b].split()
        if len(words) >= 4 and re.search(r"(?i)[“\"]|\b(publication|presented|journal|thesis|dissertation|abstract|doi|isbn)\b", text[a:b]):
            out.append((a, b, " ".join(words)))
    return out


def found(spark, blocks):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(blocks)], "i int, b string").select("i", scholarly_pieces(F.col("b")).alias("p"))
    return [None if r.p is None else [tuple(x) for x in r.p] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize(
    ("block", "texts"),
    [
        ('Lee, A., Roe, B. C. 1999 "On things" Journal. Kim, D. 2001, Journal of two things', ['Lee, A., Roe, B. C. 1999 "On things" Journal', "Kim, D. 2001, Journal of two things"]),
        ("Papers__Lee, A. 1999, Journal of ones AWARDS Kim, D. 2001, prize", ["Lee, A. 1999, Journal of ones"]),
        ("Thesis of Lee, A. 1999, on three things", ["Thesis of Lee, A. 1999, on three things"]),
        ("O'Brien, A. 1999, Journal of ones; O'Brien, A. 2000, Journal of twos", ["O'Brien, A. 1999, Journal of ones", "O'Brien, A. 2000, Journal of twos"]),
        ("Lee, A. 1999, Journal", ["Lee, A. 1999, Journal"]),
        ("Lee, A. 1999 x", []),
        ("", []),
    ],
)
def test_known_blocks(spark, block, texts):
    [got] = found(spark, [block])
    assert [t for _, _, t in got] == texts
    assert got == plain(block)


def test_null(spark):
    assert found(spark, [None]) == [None]


PARTS = st.sampled_from(["Lee, A.", "O'Roe, B. C.", "Mac-Kim,D.", " 1999", " 2001, ", ' "Title" ', "; ", ", ", "_", "Journal ", "thesis ", " AWARDS ", "\n", "some words of it ", "é😀 "])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(st.lists(PARTS, max_size=14).map("".join), min_size=60, max_size=60))
def test_as_the_plain_walk(spark, blocks):
    assert found(spark, blocks) == [plain(b) for b in blocks]


def test_long_block(spark):
    block = "".join(f"Lee, A. {1950 + k % 50}, Journal of things no {k}; " for k in range(3000))
    [got] = found(spark, [block])
    assert len(got) == 3000 and got == plain(block)

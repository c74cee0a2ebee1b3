"""Similar names against all pairs, and the work that finding them takes."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from veilspark.functions.scalars import name_parts
from veilspark.operators import resolution


def parts(name):
    tokens = [t for t in name.replace(",", " ").split(" ") if t]
    return (tokens[-1], tokens[0][0]) if tokens else ("", "")


def all_pairs(names):
    found = {}
    names = sorted(set(names) - {""})
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if parts(a) != parts(b) or parts(a) == ("", ""):
                continue
            both = difflib.SequenceMatcher(None, a, b)
            # The quick ratios are upper bounds.
            if both.real_quick_ratio() >= 0.94 and both.quick_ratio() >= 0.94 and both.ratio() >= 0.94:
                found[a, b] = both.ratio()
    return found


def edited(rng, name, edits):
    letters = list(name)
    for _ in range(edits):
        at = rng.randrange(len(letters) + 1)
        if rng.random() < 0.5 and at < len(letters):
            del letters[at]
        else:
            letters.insert(at, rng.choice("abé😀 ,"))
    return "".join(letters)


@pytest.mark.parametrize("seed", range(2))
def test_all_similar_names_are_found(spark, seed):
    rng = random.Random(seed)
    names = ["", ",", " , ", "a smith", "smith", "a abcdefghijklmnopqr", "abcdefghijklmnopqr", "anna abcdefghijklmnopqr", "anna  abcdefghijklmnopqr,"]
    for length in [*range(2, 30), 34, 36, 40, 51, 68, 90, 120, 205, 260]:
        for surname in ("", " bo", " abcdefghijklmnop"):
            base = "".join(rng.choice("abcé") for _ in range(length)) + surname
            names += [base, *(edited(rng, base, rng.randint(1, 2 + len(base) // 12)) for _ in range(8))]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names * 2)], "p long, name string")
    got = resolution.name_pairs(rows, "p", "name").collect()
    assert len(got) == len({(r.left_name, r.right_name) for r in got})
    want = all_pairs(names)
    assert {(r.left_name, r.right_name): r.ratio for r in got} == want
    assert len(want) > 100 and {(r.surname, r.initial) for r in got} == {parts(a) for a, _ in want}
    assert any(abs(len(a) - len(b)) >= 3 for a, b in want) and any("," in a for a, _ in want)


def test_a_frequent_surname_costs_no_comparison_of_all_its_names(spark):
    """4,000 names of one surname and initial are 8 million pairs; few of them share a key."""
    rng = random.Random(5)
    names = sorted({"t" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 24))) + " the" for _ in range(4000)})
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    keyed = rows.select("name", *(name_parts(F.col("name"))[k].alias(k) for k in ("surname", "initial")))
    longer, other = resolution._keyed(keyed.withColumn("inner", F.expr("substring(name, 2, length(name) - 5)")))
    assert longer.count() + other.count() < 60 * len(names)
    assert longer.withColumnRenamed("name", "long").join(other, "key").where("long <> name").count() < 20 * len(names)


def test_parties_without_support_tie_nobody(spark):
    ids = [(1, "person_name", "alexandra whitmore"), (2, "person_name", "alexandrea whitmore"), (3, "person_name", "alexandrea whitmore"), (4, "person_name", "alexandraa whitmore")]
    ids += [(1, "website", "a.org/x"), (2, "website", "a.org/x"), (3, "website", "b.org/x"), (2, "phone_number", "0123456789")]
    rows = spark.createDataFrame(ids, "p long, identifier_type string, normalized_value string")
    assert [(r.src, r.dst) for r in resolution.fuzzy_evidence(rows, "p").collect()] == [(1, 2)]

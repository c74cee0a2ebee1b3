"""Similar names count as evidence only where a phone number or a site is shared."""

import difflib

from veilspark.operators import resolution


def test_stars_connect_what_pairs_would(spark):
    people = ["alexandra whitmore", "alexandrea whitmore", "alexandra whitmores", "bo whitmore"]
    ids = []
    for i in range(60):
        ids.append((i, "person_name", people[i % 4]))
        ids.append((i, ["phone_number", "website", "email"][i % 3], f"v{i % 5}"))
    rows = spark.createDataFrame(ids, "p long, identifier_type string, normalized_value string")
    got = {(r.src, r.dst) for r in resolution.fuzzy_evidence(rows, "p").collect()}

    def linked(a, b):
        x, y = people[a % 4], people[b % 4]
        similar = x != y and x.split()[-1] == y.split()[-1] and x[0] == y[0] and difflib.SequenceMatcher(None, *sorted((x, y))).ratio() >= 0.94
        return similar and a % 3 == b % 3 != 2 and a % 5 == b % 5

    want = {(a, b) for a in range(60) for b in range(a + 1, 60) if linked(a, b)}
    assert want and got and got <= want

    def parts(edges):
        top = list(range(60))
        for _ in range(60):
            for a, b in edges:
                top[a] = top[b] = min(top[a], top[b])
        return top

    assert parts(got) == parts(want)
    both = resolution.balanced_evidence(rows, "p")
    assert {r.confidence for r in both.where("kind = 'fuzzy_name'").collect()} == {resolution.FUZZY_CONFIDENCE}


def test_no_rows_give_no_evidence(spark):
    none = spark.createDataFrame([], "p long, identifier_type string, normalized_value string")
    assert resolution.fuzzy_evidence(none, "p").count() == 0

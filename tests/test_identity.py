"""Resolution in parts gives what it gives at once, and what a plain loop gives."""

import random

import pytest

from veilspark.operators import identity

SCHEMA = "p long, identifier_type string, normalized_value string, verified boolean"


def identifiers(seed, n=70):
    rng, rows = random.Random(seed), []
    for i in range(n):
        for _ in range(rng.randint(0, 3)):
            kind = rng.choice(["email", "phone_number", "website", "person_name", "unique_identifier"])
            value = {"phone_number": f"55512300{rng.randint(10, 40)}", "person_name": rng.choice(["alexandra whitmore", "alexandrea whitmore", "bo", "cara lund", "dan ohara"])}
            rows.append((i, kind, value.get(kind, f"{kind[0]}{rng.randint(0, 40)}.org/x"), rng.random() < 0.7))
    return rows


def tops(pairs, members):
    top = {v: v for v in members}

    def find(v):
        while top[v] != v:
            v = top[v]
        return v

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {v: find(v) for v in members}


def plain(rows, balanced):
    members = {r[0] for r in rows}
    by_key = {}
    for i, kind, value, verified in rows:
        if verified and kind in ("email", "unique_identifier"):
            by_key.setdefault((kind, value), []).append(i)
    strong = [(g[0], x) for g in by_key.values() for x in g]
    sure = tops(strong, members)
    known = {}
    for i, kind, value, verified in rows:
        if verified and kind == "unique_identifier":
            known.setdefault(sure[i], set()).add(value)
    top = {v: v for v in members}

    def find(v):
        while top[v] != v:
            v = top[v]
        return v

    for _, a, b in sorted({(-c, sure[a], sure[b]) for a, b, c in balanced}):
        a, b = sorted((find(a), find(b)))
        x, y = known.get(a, set()), known.get(b, set())
        if a != b and not (x and y and x.isdisjoint(y)):
            top[b], known[a] = a, x | y
    whole = tops([*strong, *[(a, b) for a, b, _ in balanced]], members)
    return {v: (whole[v], find(sure[v])) for v in members}


@pytest.mark.parametrize("seed", [1])
def test_two_half_runs_are_a_whole_one(spark, seed):
    rows = identifiers(seed)
    ids = spark.createDataFrame(rows, SCHEMA)
    balanced = [tuple(r) for r in identity.balanced_evidence(ids, "p").select("src", "dst", "confidence").collect()]
    want = plain(rows, balanced)
    assert {r.party: (r.component, r.person) for r in identity.resolve(ids, "p").collect()} == want
    random.Random(seed).shuffle(rows)  # so identifiers of a party come in both halves
    half = spark.createDataFrame(rows[: len(rows) // 2], SCHEMA).distinct()
    rest = spark.createDataFrame(rows[len(rows) // 2 :], SCHEMA)
    whole, got = identity.resolve_more(half, identity.resolve(half, "p"), rest, "p")
    assert {r.party: (r.component, r.person) for r in got.collect()} == want and got.count() == len(want)
    assert sorted(map(tuple, whole.collect())) == sorted(set(rows))
    edges = spark.createDataFrame([(1, 2), (1, 2), (3, 3)], "source_id long, target_id long")
    found = identity.person_relationships(edges, got, "knows").collect()
    person = {v: want[v][1] if v in want else v for v in (1, 2)}
    assert [(r.source_id, r.target_id) for r in found] == ([(person[1], person[2])] if person[1] != person[2] else [])


def test_what_is_not_reached_is_taken_over(spark):
    old = spark.createDataFrame([(1, "email", "a", True), (2, "email", "a", True), (5, "phone_number", "5551230010", True)], SCHEMA)
    marked = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (5, 5, 77)], "party long, component long, person long")
    fresh = spark.createDataFrame([(9, "email", "a", True)], SCHEMA)
    _, got = identity.resolve_more(old, marked, fresh, "p")
    assert {r.party: r.person for r in got.collect()} == {1: 1, 2: 1, 9: 1, 5: 77}


def test_keys_of_several_known_persons_merge_nobody(spark):
    ids = spark.createDataFrame([(1, "email", "a", True), (2, "email", "a", True), (3, "email", "b", True), (4, "email", "b", True)], SCHEMA)
    known = spark.createDataFrame([(1, "person_x"), (2, "person_y"), (3, "person_z")], "p long, person_id string")
    assert {r.party: r.person for r in identity.resolve(ids, "p", known).collect()} == {1: 1, 2: 2, 3: 3, 4: 3}

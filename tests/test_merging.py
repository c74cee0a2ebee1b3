"""Constrained merging, chains of merged persons and merged rows, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from veilspark.operators import graph, merging


def plain_merge(evidence, ids):
    known, top = {}, {}
    for v, x in ids:
        known.setdefault(v, set()).add(x)

    def find(v):
        while top.setdefault(v, v) != v:
            v = top[v]
        return v

    for a, b, _ in evidence:
        find(a), find(b)
    for _, a, b in sorted({(-c, a, b) for a, b, c in evidence}):
        a, b = find(a), find(b)
        x, y = known.get(a, set()), known.get(b, set())
        if a != b and not (x and y and x.isdisjoint(y)):
            low, high = min(a, b), max(a, b)
            top[high], known[low] = low, x | y
    return {v: find(v) for v in top}


def graphs(seed):
    """Random graphs, hubs with leaves of their own, hubs whose leaves are tied elsewhere, and a long path."""
    rng, evidence, ids, base = random.Random(seed), [], [], 0
    for size, edges, hubs in ((12, 14, 0), (20, 40, 0), (40, 15, 2), (40, 30, 1), (5, 0, 0)):
        v = list(range(base, base + size))
        base += size
        evidence += [(rng.choice(v), rng.choice(v), rng.choice([0.9, 0.8, 0.72])) for _ in range(edges)]
        for h in rng.sample(v, hubs):
            evidence += [(h, x, rng.choice([0.9, 0.8])) for x in v]
        if not edges:
            evidence += [(a, a + 1, 0.8) for a in v[:-1]]
        for x in v:
            ids += [(x, rng.choice("abcd")) for _ in range(rng.choice([0, 0, 0, 1, 1, 2]))]
    return evidence, ids


@pytest.mark.parametrize(("seed", "small"), [(1, 0), (4, 25), (5, 10_000)])
def test_rounds_give_what_the_loop_gives(spark, seed, small):
    evidence, ids = graphs(seed)
    got = merging.constrained_components(
        spark.createDataFrame(evidence, "src long, dst long, confidence double").repartition(3),
        spark.createDataFrame(ids, "party long, normalized_value string"), "party", small,
    )
    assert {r.party: r.person for r in got.collect()} == plain_merge(evidence, ids)


def test_large_hub_is_settled_in_few_rounds(spark, monkeypatch):
    """A key of 100,000 parties, a third of them with unique ids that differ, in rounds of partial aggregates."""
    n, calls = 100_000, []
    real = merging._round
    monkeypatch.setattr(merging, "_round", lambda *a: calls.append(1) or real(*a))
    edges = spark.range(1, n).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"), F.lit(0.8).alias("confidence"))
    ids = spark.range(n).where("id % 3 = 1").select(F.col("id").alias("party"), F.concat(F.lit("u"), F.col("id") % 5).alias("normalized_value"))
    got = merging.constrained_components(edges, ids, "party", small=1000)  # so one task may not settle it
    apart = got.where("party = person AND party > 0")
    # The first of them, party 1 with u1, gives the hub its id; those of other ids stay apart.
    assert got.count() == n and apart.where("party % 3 <> 1 OR party % 5 = 1").count() == 0
    assert apart.count() == len([i for i in range(n) if i % 3 == 1 and i % 5 != 1])
    assert len(calls) <= 6


def test_evidence_of_text_ids_loops_and_none(spark):
    rows = [("b", "a", 0.8), ("c", "c", 0.8), ("d", None, 0.8), ("e", "f", None), ("b", "a", 0.8)]
    evidence = spark.createDataFrame(rows, "src string, dst string, confidence double")
    none = spark.createDataFrame([], "p string, normalized_value string")
    got = merging.constrained_components(evidence, none, "p").collect()
    assert {r.party: r.person for r in got} == {"a": "a", "b": "a", "c": "c", "d": "d", "e": "e", "f": "f"}
    assert merging.constrained_components(evidence.limit(0), none, "p").count() == 0


def test_components_of_paths_hubs_and_loops(spark):
    rng = random.Random(7)
    edges = [(a, a + 1) for a in range(3000)] + [(9000 - a, 9001 - a) for a in range(1000)] + [(20_000, 20_001 + a) for a in range(2000)]
    edges += [(rng.randint(30_000, 30_900), rng.randint(30_000, 30_900)) for _ in range(600)] + [(50_000, 50_000), (None, 4), (5, None)]
    top = {}

    def find(v):
        while top.setdefault(v, v) != v:
            top[v] = v = top[top[v]]
        return v

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    got = graph.connected_components(spark.createDataFrame(edges, "src long, dst long").repartition(5)).collect()
    assert {r.vertex: r.component for r in got} == {v: find(v) for v in top} and len(got) == len(top)


def test_chains_end_in_few_rounds(spark):
    n = 100_000
    links = spark.range(n).select(F.col("id"), F.when(F.col("id") % 1000 > 0, F.col("id") - 1).alias("into"))
    got = graph.chain_ends(links, "id", "into")
    assert got.count() == n and got.where(F.col("end") != F.col("id") - F.col("id") % 1000).count() == 0
    one = spark.range(1, 40_000).select(F.col("id"), (F.col("id") - 1).alias("into"))  # 0 has no row of its own
    assert {tuple(r) for r in graph.chain_ends(one, "id", "into").groupBy("end").count().collect()} == {(0, 39_999)}


@pytest.mark.parametrize("rows", [[(1, 1)], [(1, 2), (2, 1)], [(1, 2), (2, 3), (3, 1), (4, 1)], [(1, 2), (1, 3)]])
def test_chains_in_a_circle_are_refused(spark, rows):
    with pytest.raises(ValueError):
        graph.chain_ends(spark.createDataFrame([*rows, (9, None)], "id long, into long"), "id", "into")


def test_merged_people(spark):
    people = [("p3", 1, None, 0.9, ["x"]), ("p1", 2, None, 1.0, ["a", "x"]), ("p2", 1, None, 0.8, ["b"]), ("p4", 5, "p1", 1.0, ["q"]), ("p5", 5, None, 1.0, ["z"])]
    persons = spark.createDataFrame(people, "person_id string, created_at int, merged_into string, linkage_confidence double, local_ids array<string>")
    groups = spark.createDataFrame([("p1", 7, 0.85), ("p2", 7, 0.85), ("p3", 7, 0.85), ("p4", 7, 0.85), ("p5", 8, 0.9)], "person_id string, component long, confidence double")
    after, log = merging.merge_people(persons, groups, "by_hand", ["local_ids"])
    assert sorted(map(tuple, after.collect())) == [
        ("p1", 2, "p2", 1.0, ["a", "x"]), ("p2", 1, None, 0.8, ["a", "b", "x"]), ("p3", 1, "p2", 0.9, ["x"]), ("p4", 5, "p1", 1.0, ["q"]), ("p5", 5, None, 1.0, ["z"]),
    ]
    assert sorted(map(tuple, log.collect())) == [("p1", "p2", "by_hand", 0.85), ("p3", "p2", "by_hand", 0.85)]

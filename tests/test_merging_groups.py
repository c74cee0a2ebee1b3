"""Small components are settled many in a call."""

import random

from veilspark.operators import merging


def test_many_small_components_make_few_calls(spark):
    rng, far = random.Random(3), 2**60 + 1
    edges, ids = [], []
    for c in range(300):
        for _ in range(6):
            a, b = rng.sample(range(5), 2)
            edges.append((far + c * 5 + a, far + c * 5 + b, rng.choice([0.8, 0.9])))
        ids += [(far + c * 5 + k, str(rng.randint(0, 2))) for k in range(5) if rng.random() < 0.7]
    evidence = spark.createDataFrame(edges, "src long, dst long, confidence double")
    unique = spark.createDataFrame(ids, "party long, normalized_value string")
    got = {r.party: r.person for r in merging.constrained_components(evidence, unique, "party").collect()}
    top, known = {p: p for e in edges for p in e[:2]}, {}
    for p, v in ids:
        known.setdefault(p, set()).add(v)
    for a, b, _ in sorted(set(edges), key=lambda e: (-e[2], e[0], e[1])):
        a, b = top[a], top[b]
        x, y = known.get(a, set()), known.get(b, set())
        if a != b and not (x and y and not x & y):
            top = {p: min(a, b) if t in (a, b) else t for p, t in top.items()}
            known[min(a, b)] = x | y
    assert got == top

"""Rank percentiles of all rows: no window holds all values."""

import random
import re

from veilspark.operators import rollups


def test_ranks_from_ranges(spark):
    random.seed(5)
    values = [random.random() for _ in range(3000)] + [0.5] * 500 + [None] * 7
    rows = spark.createDataFrame([(v,) for v in values], "value double").repartition(6)
    out = rollups.run_summary(rows, "value")
    some = sorted(v for v in values if v is not None)
    got = out.first()
    assert got.n == len(some)
    for p, found in ((0.9, got.p90_rank), (0.95, got.p95_rank)):
        assert found == some[min(len(some) - 1, int((len(some) - 1) * p + 0.999))]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"windowspecdefinition\(value#", plan)
    assert rollups.run_summary(rows.limit(0), "value").count() == 1

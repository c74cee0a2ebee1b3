"""Ranking, top-k and review samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, by: list[str], order: list, name: str) -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))


def top_k(rows: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each group; Spark keeps k a partition before it shuffles."""
    return numbered(rows, by, order, "_rank").where(F.col("_rank") <= k).drop("_rank")


def stride(count: int, total: int, head: int) -> list[int]:
    """0-based ranks of a sample: the first `head`, then an even stride over the rest."""
    if count >= total:
        return list(range(total))
    rest, step = total - head, (total - head) / max(1, count - head)
    return list(range(head)) + [head + min(int(i * step), rest - 1) for i in range(count - head)]


def risk_sample(rows: DataFrame, order: list, fraction: float, least: int, head_half: bool = True) -> DataFrame:
    """A review sample: the riskiest half, and an even stride over the others.

    The sample's ranks follow from the number of rows; only rows that can be in it need a rank, and
    the rank is global, so rows are range-partitioned by the order and numbered from partition totals.
    """
    total = rows.count()
    count = min(total, max(least, math.floor(total * fraction + 0.999)))
    head = max(1, count // 2) if head_half else 0
    ranked = ranked_globally(rows, order)
    rest = total - head
    step = rest / max(1, count - head)
    at = F.col("_rank") - head
    # Rank r is taken when r = int(i * step) for a whole i.
    i = F.ceil(at / F.lit(step))
    taken = F.lit(count >= total) | (F.col("_rank") < head) | ((at >= 0) & (i < count - head) & (F.floor(i * F.lit(step)) == at))
    return ranked.where(taken).drop("_rank")


def ranked_globally(rows: DataFrame, order: list, name: str = "_rank") -> DataFrame:
    """0-based global ranks without one task for all rows: sorted partitions and their totals."""
    from veilspark.plans.frames import cut

    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition
    totals = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(totals), "_part").withColumn(name, rank).drop("_part", "_place", "_before")


def batches(rows: DataFrame, order: list, size: int) -> DataFrame:
    return ranked_globally(rows, order).withColumn("batch", F.floor(F.col("_rank") / size).cast("long")).drop("_rank")


def disambiguated(rows: DataFrame, by: list[str], order: list, id_: Column, name: str) -> DataFrame:
    """The first row of a repeated id keeps it; later ones get a number."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn(name, F.when(n == 1, id_).otherwise(F.concat(id_, F.lit("#"), n.cast("string"))))

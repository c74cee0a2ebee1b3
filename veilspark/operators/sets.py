"""Set operations and deduplication rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_distinct(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.unionByName(b).dropDuplicates(keys)


def first_by(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key: the first in the order. A plain aggregate, so hot keys combine before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)) if order else F.first(F.struct(*rest))
    return rows.groupBy(*keys).agg(best.alias("_row")).select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def last_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows on one side only, with `side`: none means the sets are equal."""
    missing = expected.exceptAll(actual).withColumn("side", F.lit("missing"))
    return missing.unionByName(actual.exceptAll(expected).withColumn("side", F.lit("unexpected")))


def disjoint_conflict(a: Column, b: Column) -> Column:
    """Both known, and nothing in common."""
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)


def without_rejected(candidates: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    return candidates.join(rejected.select(key).distinct(), key, "left_anti")


def furniture(rows: DataFrame, document: str, value: str, page: str, y: str) -> DataFrame:
    """rows with `is_furniture`: a value on several pages at nearly the same height near an edge of the page."""
    w = Window.partitionBy(document, value)
    spread = F.max(y).over(w) - F.min(y).over(w)
    edge = (F.max(y).over(w) <= 0.08) | (F.min(y).over(w) >= 0.92)
    several = F.min(page).over(w) != F.max(page).over(w)
    return rows.withColumn("is_furniture", several & (spread < 0.03) & edge)


def contained_citations(rows: DataFrame, page: list[str], id_: str, text: str) -> DataFrame:
    """Citations that aren't part of a longer one on the same page (under 85 % of its length)."""
    longer = rows.select(*page, F.col(text).alias("_longer"), F.col(id_).alias("_id"))
    inside = rows.join(longer, page).where(
        (F.col(id_) != F.col("_id")) & F.contains("_longer", F.col(text)) & (F.length(text) < 0.85 * F.length("_longer"))
    )
    return rows.join(inside.select(id_).distinct(), id_, "left_anti")

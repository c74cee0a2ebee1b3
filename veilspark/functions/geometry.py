"""Axis-aligned boxes as struct columns with fields x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def union(a: Column, b: Column) -> Column:
    return box(F.least(a.x0, b.x0), F.least(a.y0, b.y0), F.greatest(a.x1, b.x1), F.greatest(a.y1, b.y1))


def intersects(a: Column, b: Column) -> Column:
    return (a.x0 < b.x1) & (b.x0 < a.x1) & (a.y0 < b.y1) & (b.y0 < a.y1)


def area(a: Column) -> Column:
    return F.greatest(a.x1 - a.x0, F.lit(0.0)) * F.greatest(a.y1 - a.y0, F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    return F.greatest(F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0), F.lit(0.0)) * F.greatest(
        F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0), F.lit(0.0)
    )


def iou(a: Column, b: Column) -> Column:
    whole = area(a) + area(b) - overlap(a, b)
    return F.when(whole > 0, overlap(a, b) / whole).otherwise(0.0)


def horizontal_gap(a: Column, b: Column) -> Column:
    meets = (a.x1 >= b.x0) & (b.x1 >= a.x0)
    return F.when(meets, 0.0).otherwise(F.least(F.abs(a.x1 - b.x0), F.abs(b.x1 - a.x0)))


def expand(a: Column, by: float) -> Column:
    return box(a.x0 - by, a.y0 - by, a.x1 + by, a.y1 + by)

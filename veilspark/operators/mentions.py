"""Mentions: proposals of models and detectors become grounded, deduplicated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions import spans as S

KEY = ["document_id", "start", "end", "kind"]


def grounded(proposals: DataFrame, docs: DataFrame, kinds: list[str], roles: list[str]) -> DataFrame:
    """Proposals (document_id, start, end, kind, role, text, ord) that hold in their document (document_id, body).

    Unknown kinds go, unknown roles become `unknown`. A proposal whose offsets don't hold its text stands for
    every exact occurrence of that text; one without any goes.
    """
    known = proposals.where(F.col("kind").isin(kinds)).withColumn("role", F.when(F.col("role").isin(roles), F.col("role")).otherwise("unknown"))
    joined = known.join(docs, "document_id")
    direct = F.coalesce((F.col("end") > F.col("start")) & (F.substring("body", F.col("start") + 1, F.col("end") - F.col("start")) == F.col("text")), F.lit(False))
    here = F.array(F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end")))
    found = F.transform(S.exact_positions(F.col("body"), F.col("text")), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    at = joined.withColumn("at", F.explode(F.when(direct, here).otherwise(found)))
    return at.select("document_id", F.col("at.start").alias("start"), F.col("at.end").alias("end"), "kind", "role", "text", "ord")


def deduplicated(rows: DataFrame, key: list[str] = KEY, role: str = "role", order: str = "ord") -> DataFrame:
    """One row for each key: the first whose role is known, else the first. Combined before the shuffle, so no window is needed."""
    rest = [c for c in rows.columns if c not in key]
    best = F.min_by(F.struct(*rest), F.struct(F.col(role) == "unknown", F.col(order)))
    return rows.groupBy(*key).agg(best.alias("_best")).select(*key, *[F.col(f"_best.{c}").alias(c) for c in rest])


def promoted(mentions: DataFrame, fields: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Mentions (key, detector) and structured fields (key) as one set; what a field names is `structured`."""
    marked = fields.select(*key).distinct().withColumn("_field", F.lit(True))
    return mentions.join(marked, key, "full_outer").withColumn("detector", F.when(F.col("_field"), F.lit("structured")).otherwise(F.col("detector"))).drop("_field")


def counted(fields: DataFrame, by: str, start: str, end: str) -> DataFrame:
    """Distinct places of structured fields in each document."""
    return fields.where(F.col(start).isNotNull() & F.col(end).isNotNull()).groupBy(by).agg(F.count_distinct(start, end).alias("structured_mentions"))


def shifted(spans: Column, offset: Column) -> Column:
    """Spans of a chunk as spans of its document."""
    return F.transform(spans, lambda s: s.withField("start", s["start"] + offset).withField("end", s["end"] + offset))

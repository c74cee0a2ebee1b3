"""Exact deduplication by skew-safe combining.

1. Local: Spark's map-side aggregation folds equal texts of one partition and salt into one row.
2. Salted: those rows meet by (digest, salt, text), so a hot text is spread over `salts` tasks.
3. Global: at most `salts` winners for each text meet by (digest, text).

The text itself is a grouping key in every stage, so texts are equal only when their whole content
is; the digest merely deals rows out. Membership goes back the same way: global winner -> salted
winner -> row, keyed by (digest, salt), and moves ids and digests only.

Defined cases: a null text counts as empty; null ids sort below all others and a group of null ids
only keeps one row with a null `keep_id`; rows that repeat an id and a text count in the group's
size and exactly one of them is kept; an empty table gives an empty result; other columns are
carried in one struct, so their names can't clash with those made here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilspark.plans.frames import cut, read_table

SALTS = 16


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _keyed(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], salts: int) -> DataFrame:
    if not 1 <= salts <= 63:
        raise ValueError("1 to 63 salts: they are kept as bits of a long")
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        text.alias("body"),
        digest(text).alias("digest"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("salt"),
        F.struct(F.lit(0), *[F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]).alias("rest"),
    )


def _winners(keyed: DataFrame) -> DataFrame:
    """One row for each text: digest, body, keep, size, and the salts it occurs under as a bit mask."""
    salted = keyed.groupBy("digest", "salt", "body").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n"))
    return (
        salted.repartition("digest")
        .groupBy("digest", "body")
        .agg(F.max("top").alias("keep"), F.sum("n").alias("size"), F.expr("bit_or(shiftleft(1L, salt))").alias("mask"))
    )


def _spread(groups: DataFrame, salts: int) -> DataFrame:
    used = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda s: F.getbit("mask", s) == 1)
    return groups.withColumn("salt", F.explode(used)).drop("mask")


def members(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256_hex, salts: int = SALTS,
) -> DataFrame:
    """Each row's id, digest, keep_id, group_size and kept flag.

    Only groups of two rows or more go back to the rows, once for each salt they occur under.
    A digest shared by different texts (only a weak `digest` has those) is settled by content.
    """
    keyed = _keyed(docs, id_col, text_col, digest, salts)
    final = _winners(keyed)
    texts = F.count(F.lit(1)).over(Window.partitionBy("digest")).alias("texts")
    groups = cut(final.select("digest", "keep", "size", "mask", texts).where("size > 1 OR texts > 1"))
    found = keyed.select("id", "digest", "salt").join(
        _spread(groups.where("texts = 1").drop("texts"), salts), ["digest", "salt"], "left"
    )
    if groups.where("texts > 1").limit(1).count():
        clashing = groups.where("texts > 1").select("digest").distinct()
        by_text = keyed.drop("rest").join(clashing, "digest", "left_semi")
        settled = by_text.join(_spread(final.join(clashing, "digest", "left_semi"), salts), ["digest", "salt", "body"])
        found = found.join(clashing, "digest", "left_anti").unionByName(settled.select(*found.columns))
    again = F.row_number().over(Window.partitionBy("digest", "salt", "keep", "id").orderBy("size"))
    return found.select(
        "id",
        "digest",
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("size").isNull() | (F.col("id").eqNullSafe(F.col("keep")) & (again == 1))).alias("kept"),
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256_hex, salts: int = SALTS,
) -> DataFrame:
    """The rows that stay, with all their columns: the same three stages, carrying each winner's row along."""
    keyed = _keyed(docs, id_col, text_col, digest, salts)
    order = F.struct(F.col("id").isNotNull(), F.col("id"))
    salted = keyed.groupBy("digest", "salt", "body").agg(F.max_by(F.struct("id", "rest"), order).alias("best"))
    order = F.struct(F.col("best.id").isNotNull(), F.col("best.id"))
    final = salted.repartition("digest").groupBy("digest", "body").agg(F.max_by("best", order).alias("best"))
    made = {id_col: F.col("best.id"), text_col: F.col("body")}
    return final.select(*[made.get(c, F.col(f"best.rest.`{c}`")).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return members(docs).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

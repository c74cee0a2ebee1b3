"""Inventories: applications and their documents, from listed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspark.functions.scalars import is_cv_name, is_pdf, is_safe_path, stable_id


def application_flags(cvs: Column, letters: Column, allowed: tuple[int, ...] = (2, 3)) -> Column:
    return F.array_compact(F.array(
        F.when(cvs == 0, F.lit("missing_cv")), F.when(cvs > 1, F.lit("multiple_cv_candidates")),
        F.when(~letters.isin(*allowed), F.lit("unexpected_recommendation_letter_count")),
    ))


def inventory(files: DataFrame, root: str, loose: bool = False) -> tuple[DataFrame, DataFrame]:
    """files: (path), relative to the root. Returns applications and documents.

    One application for each first-level folder that isn't hidden; only PDF files right inside count.
    With none or several CVs there is no CV document, and the letters stay.
    """
    parts = F.split("path", "/")
    inside = files.where(is_safe_path(F.col("path")) & (F.size(parts) == 2) & is_pdf(F.col("path")) & ~F.col("path").startswith("."))
    rows = inside.select(
        "path", parts[0].alias("folder"), parts[1].alias("name"),
        is_cv_name(F.regexp_replace(parts[1], r"\.[^.]*$", ""), loose).alias("is_cv"),
    ).withColumn("application_id", stable_id("application", F.concat(F.lit(f"{root}/"), "folder")))
    cvs, letters = F.count_if("is_cv"), F.count_if(~F.col("is_cv"))
    apps = rows.groupBy("application_id", "folder").agg(cvs.alias("cv_count"), letters.alias("letter_count"))
    apps = apps.withColumn("inventory_flags", application_flags(F.col("cv_count"), F.col("letter_count")))
    apps = apps.withColumn("status", F.when(F.size("inventory_flags") > 0, "inventory_flagged").otherwise("inventoried"))
    w = Window.partitionBy("application_id", "is_cv").orderBy(F.lower("name"))
    docs = rows.join(apps.select("application_id", "cv_count", "inventory_flags"), "application_id")
    docs = docs.where(~F.col("is_cv") | (F.col("cv_count") == 1)).select(
        "application_id", stable_id("document", F.concat(F.lit(f"{root}/"), "path")).alias("document_id"),
        F.when(F.col("is_cv"), "cv").otherwise("letter").alias("document_type"),
        F.when(~F.col("is_cv"), F.row_number().over(w)).alias("letter_index"), F.col("path").alias("source_relative_path"), "inventory_flags",
    )
    return apps, docs


def collisions(rows: DataFrame, id_: str) -> DataFrame:
    return rows.groupBy(id_).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def limited(apps: DataFrame, docs: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The first n applications by id, and their documents."""
    chosen = apps.orderBy("application_id").limit(n)
    return chosen, docs.join(chosen.select("application_id"), "application_id", "left_semi")


def catalog(left: DataFrame, right: DataFrame, key: str, failed: Column) -> DataFrame:
    """Applications of both sources, with each one's documents and status; an absent side counts as failed."""
    both = left.join(right, key, "full_outer")
    return both.withColumn("status", F.when(F.coalesce(failed, F.lit(True)), "partial_or_failed").otherwise("completed"))


def pages(rows: DataFrame, document: str, page: str, text: str) -> DataFrame:
    """Each page's offsets in its document, whose pages are joined by a marker line and blank lines."""
    header = F.length(F.concat(F.lit("[[PAGE:"), F.col(page).cast("string"), F.lit("]]"))) + 1
    size = header + F.length(text) + 2
    before = Window.partitionBy(document).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(size).over(before), F.lit(0)) + header
    return rows.select(document, page, start.cast("long").alias("document_start"), (start + F.length(text)).cast("long").alias("document_end"))


def assemble(rows: DataFrame, document: str, page: str, text: str) -> DataFrame:
    """Documents from their pages, with markers."""
    marked = F.concat(F.lit("[[PAGE:"), F.col(page).cast("string"), F.lit("]]\n"), F.col(text))
    listed = F.array_sort(F.collect_list(F.struct(F.col(page).alias("page"), marked.alias("text"))))
    return rows.groupBy(document).agg(F.array_join(F.transform(listed, lambda p: p["text"]), "\n\n").alias("text"))

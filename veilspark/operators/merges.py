"""Results of chunks, pages and passes become one result of a document."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_FLAG = "deterministic_page_merge_fallback"  # fixed value
BOX = ["x0", "y0", "x1", "y1"]


def in_order(part: str, items: str) -> Column:
    """Aggregate: the lists of all parts, one after the other. What it holds is one document's."""
    return F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(part).alias("_part"), F.col(items).alias("_items")))), lambda x: x["_items"]))


def merged_sections(chunks: DataFrame, key: str = "document_id", part: str = "chunk") -> DataFrame:
    """(key, section) of all chunks' (status, model_confidence, items): found where any item is, else failed where a chunk failed.

    The confidence is that of the first chunk that found something, else of the first that failed, else of the first.
    """
    rank = F.when(F.col("status") == "found", 0).when(F.col("status") == "model_failed", 1).otherwise(2)
    first = F.min_by(F.struct("model_confidence"), F.struct(rank.alias("_rank"), F.col(part).alias("_part")))
    one = chunks.groupBy(key, "section").agg(
        in_order(part, "items").alias("items"), F.bool_or(F.col("status") == "model_failed").alias("_failed"), first["model_confidence"].alias("model_confidence")
    )
    some = F.size("items") > 0
    status = F.when(some, "found").when(F.col("_failed"), "model_failed").otherwise("not_found")
    reason = F.when(~some, F.concat(F.lit("No "), "section", F.lit(" items found across chunks")))
    return one.select(key, "section", status.alias("status"), "model_confidence", reason.alias("not_found_reason"), "items")


def merged_letters(chunks: DataFrame, key: str = "document_id", part: str = "chunk") -> DataFrame:
    """A letter's chunks as one: the best status of any, and the first confidence unless all failed."""
    status = F.when(F.bool_or(F.col("status") == "found"), "found").when(F.bool_or(F.col("status") == "uncertain"), "uncertain")
    status = status.when(F.bool_or(F.col("status") == "not_found"), "not_found").otherwise("model_failed")
    first = F.min_by("model_confidence", F.when(F.col("model_confidence").isNotNull(), F.col(part)))
    one = chunks.groupBy(key).agg(status.alias("status"), first.alias("model_confidence"))
    return one.withColumn("model_confidence", F.when(F.col("status") != "model_failed", F.col("model_confidence")))


def merged_pages(pages: DataFrame, key: str = "document_id", part: str = "page") -> DataFrame:
    """Page results (status, items) as one section without losing an item; no confidence is made up for it."""
    one = pages.groupBy(key, "section").agg(in_order(part, "items").alias("items"), F.bool_or(F.col("status") == "uncertain").alias("_unsure"))
    some = F.size("items") > 0
    return one.select(
        key, "section", F.when(some, "found").when(F.col("_unsure"), "uncertain").otherwise("not_found").alias("status"), "items",
        F.when(~some, "No page-level items were recovered").alias("not_found_reason"), F.array(F.lit(PAGE_FLAG)).alias("validation_flags"),
    )


def _share(a: list[float], b: list[float]) -> float:
    width, height = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(width, 0.0) * max(height, 0.0)
    whole = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return both / whole if whole > 0 else 0.0


def merged_occurrences(rows: DataFrame, least: float = 0.35) -> DataFrame:
    """Occurrences (document_id, page, category, ord, x0, y0, x1, y1, source, role, text) that overlap, as one.

    In their order each joins the first kept one of its page and category (mail and web addresses count as
    one) with an IoU of at least `least`, which grows to hold it: the order decides, so each page's
    category is settled by one function. Sources add up, a known role replaces an unknown one, and text
    that a pattern found in the file replaces a model's.
    """
    schema = rows.select("document_id", "page", "category", "ord", *BOX, "source", "role", "text").schema

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        kept: list[dict] = []
        for row in group.drop(columns="_class").sort_values("ord").to_dict("records"):
            box = [row[c] for c in BOX]
            old = next((k for k in kept if _share([k[c] for c in BOX], box) >= least), None)
            if old is None:
                kept.append(row)
                continue
            old.update(x0=min(old["x0"], row["x0"]), y0=min(old["y0"], row["y0"]), x1=max(old["x1"], row["x1"]), y1=max(old["y1"], row["y1"]))
            old["source"] = "+".join(sorted({*old["source"].split("+"), *row["source"].split("+")}))
            if old["role"] == "unknown":
                old["role"] = row["role"]
            if row["source"] == "pdf_regex":
                old["text"] = row["text"]
        return pd.DataFrame(kept, columns=schema.names)

    alike = F.when(F.col("category") == "website", "email").otherwise(F.col("category"))
    return rows.select(*schema.names, alike.alias("_class")).groupBy("document_id", "page", "_class").applyInPandas(settle, schema)


def text_in_boxes(words: DataFrame, boxes: DataFrame, by: list[str], cell: float = 50.0) -> DataFrame:
    """Boxes (by, box_id, box) with the words (by, ord, word, box) that meet them, as text and their common box.

    A box reaches 4 points further to the sides and 3 up and down. Both sides are keyed by grid cells, so
    only neighbours meet; a pair that shares several cells is counted once.
    """

    def cells(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / cell), F.floor(high / cell)))

    b, w = F.col("_reach"), F.col("_word")
    reach = F.struct((F.col("box.x0") - 4).alias("x0"), (F.col("box.y0") - 3).alias("y0"), (F.col("box.x1") + 4).alias("x1"), (F.col("box.y1") + 3).alias("y1"))
    left = boxes.select(*by, "box_id", reach.alias("_reach")).withColumn("_c", cells(b.x0, b.x1)).withColumn("_r", cells(b.y0, b.y1))
    right = words.select(*by, "ord", "word", F.col("box").alias("_word")).withColumn("_c", cells(w.x0, w.x1)).withColumn("_r", cells(w.y0, w.y1))
    meets = (b.x0 < w.x1) & (w.x0 < b.x1) & (b.y0 < w.y1) & (w.y0 < b.y1)
    pairs = left.join(right, [*by, "_c", "_r"]).where(meets).dropDuplicates([*by, "box_id", "ord"])
    joined = pairs.groupBy(*by, "box_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "word"))), lambda x: x["word"]), " ").alias("text"),
        F.struct(*[f(f"_word.{c}").alias(c) for c, f in (("x0", F.min), ("y0", F.min), ("x1", F.max), ("y1", F.max))]).alias("snapped"),
    )
    return boxes.join(joined, [*by, "box_id"], "left").withColumn("text", F.coalesce("text", F.lit("")))

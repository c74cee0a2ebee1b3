"""Repair of what a privacy check rejects: a fixed-point job over the failing documents alone.

A check reads a redacted text and reports values that still identify somebody. What stands as complete
tokens in the redacted text and in its source becomes further spans of the source, the text is written anew
from all spans, and the check runs again, until it reports nothing or nothing that can be placed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions import spans as S
from veilspark.operators.incremental import upserted
from veilspark.plans.frames import cut

#: Adds `flagged` array<struct<text,kind>> to documents (document_id, masked): values seen outside placeholders.
Check = Callable[[DataFrame], DataFrame]

#: Rounds after which what still gains spans is left to a person.
ROUNDS = 8


def redact(text: Column, spans: Column, document_id: Column) -> Column:
    """text with the placeholders of its disjoint spans, in one pass."""
    return S.substitute(text, spans, lambda s: S.repair_placeholder(s["kind"], document_id, s["start"]))


def additions(text: Column, masked: Column, flagged: Column) -> tuple[Column, Column]:
    """The spans in text of what was flagged and can be placed, and how many flagged values can't be.

    A value must stand as complete tokens, in any case, in the masked text and in the source; every place in
    the source counts. Blank values, those under three characters and mere numbers can't be placed.
    """

    def placed(f: Column) -> Column:
        usable = S.usable_alias(f["text"]) & (F.size(S.alias_occurrences(masked, f["text"])) > 0)
        found = F.when(usable, S.alias_occurrences(text, f["text"], f["kind"]))
        return F.coalesce(found, F.array().cast(S.SPAN))

    each = F.transform(F.array_distinct(flagged), placed)
    return S.in_order(F.flatten(each)), F.size(F.filter(each, lambda p: F.size(p) == 0))


def checked(open_: DataFrame, check: Check) -> DataFrame:
    """One round of open documents (document_id, text, spans, checks): their spans, status and counts after it."""
    masked = S.mask_placeholders(redact(F.col("text"), F.col("spans"), F.col("document_id")))
    seen = check(open_.withColumn("masked", masked))
    seen = seen.withColumn("flagged", F.coalesce("flagged", F.array().cast("array<struct<text:string,kind:string>>")))
    new, unplaced = additions(F.col("text"), F.col("masked"), F.col("flagged"))
    found = seen.withColumns({"_new": new, "unplaced_count": unplaced.cast("long")})
    merged = S.select_spans(S.in_order(F.concat("spans", "_new")), ())
    # What loses to a span of higher priority adds nothing: the check would see it again for ever.
    status = F.when(F.size("flagged") == 0, "passed").when(F.col("_merged") == F.col("spans"), "review").otherwise("open")
    found = found.withColumn("_merged", merged).withColumn("status", status)
    return found.select("document_id", "text", F.col("_merged").alias("spans"), (F.col("checks") + 1).cast("int").alias("checks"), "status", "unplaced_count")


def repair(docs: DataFrame, check: Check, state: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """The state table after repair: (document_id, content_sha256, status, checks, unplaced_count, spans, redacted).

    docs: (document_id unique and not null, text, spans the disjoint spans found so far); a null text is empty.
    status: passed, or review where the check reports what can't be placed or goes on reporting. With a state of
    an earlier run, documents that passed with the same text and spans are neither checked nor written anew, nor are
    documents that are not in docs. Every round reads only what the one before left open.
    """
    given = docs.select("document_id", F.coalesce("text", F.lit("")).alias("text"), "spans")
    digest = F.sha2(F.concat_ws("\n", F.sha2("text", 256), F.to_json("spans")), 256)
    rows = given.withColumn("content_sha256", digest)
    if state is not None:
        done = state.where("status = 'passed'").select("document_id", "content_sha256")
        rows = rows.join(done, ["document_id", "content_sha256"], "left_anti")
    rows = cut(rows)
    open_, settled = rows.select("document_id", "text", "spans", F.lit(0).alias("checks")), None
    for k in range(rounds):
        now = cut(checked(open_, check))
        last = k == rounds - 1
        ended = now.withColumn("status", F.when(F.col("status") == "open", "review").otherwise(F.col("status"))) if last else now.where("status <> 'open'")
        settled = ended if settled is None else settled.unionByName(ended)
        open_ = now.where("status = 'open'").select("document_id", "text", "spans", "checks")
        if last or open_.isEmpty():
            break
    redacted = redact(F.col("text"), F.col("spans"), F.col("document_id"))
    fresh = settled.join(rows.select("document_id", "content_sha256"), "document_id")
    fresh = fresh.select("document_id", "content_sha256", "status", "checks", "unplaced_count", "spans", redacted.alias("redacted"))
    return cut(fresh) if state is None else cut(upserted(state, fresh, ["document_id"]))

"""The privacy gate: detect, resolve overlaps, substitute, scan what is left, decide.

A gate is a finite plan of projections over one table of documents; only aliases come by a join, on
the document. A document that has no row downstream is withheld, never dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions import spans as S
from veilspark.functions.scalars import placeholder, stable_id
from veilspark.operators import backends

#: What a model finds of these kinds is replaced; anything else it finds, a person must see.
ACCEPTED = ["person_name", "organization", "work_title"]


def mentions(docs: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """(document_id, text, spans): all detected spans of each document."""
    return docs.withColumn("spans", S.detect(F.col("text"), kinds))


def substitute(found: DataFrame) -> DataFrame:
    """Adds `selected` and `redacted`: the spans that win, and the text with their placeholders."""
    null = F.lit(None).cast("string")

    def replacement(span: Column) -> Column:
        return placeholder(span["kind"], F.lit("unknown"), null, null)

    chosen = found.withColumn("selected", S.select_spans(F.col("spans")))
    return chosen.withColumn("redacted", S.substitute(F.col("text"), F.col("selected"), replacement))


def redactions(substituted: DataFrame) -> DataFrame:
    """A row for each replaced span."""
    each = substituted.select("document_id", F.explode("selected").alias("span"))
    id_ = F.concat_ws(":", "document_id", "span.kind", F.col("span.start").cast("string"))
    return each.select(
        stable_id("redaction", id_).alias("redaction_id"), "document_id", F.col("span.kind").alias("identifier_type"),
        F.col("span.text").alias("text"), F.col("span.start").alias("start"), F.col("span.end").alias("end"),
    )


def residual(substituted: DataFrame, aliases: DataFrame | None = None, kinds: list[str] | None = None) -> DataFrame:
    """Adds `findings`: what detectors, and aliases of the same document, still find outside placeholders."""
    masked = substituted.withColumn("masked", S.mask_placeholders(F.col("redacted")))
    scanned = masked.withColumn("findings", S.detect(F.col("masked"), kinds))
    if aliases is not None:
        usable = aliases.where(S.usable_alias(F.col("alias"))).select("document_id", F.trim("alias").alias("alias")).distinct()
        by_document = usable.groupBy("document_id").agg(F.collect_set("alias").alias("aliases"))
        found = F.flatten(F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: S.alias_occurrences(F.col("masked"), a)))
        scanned = scanned.join(by_document, "document_id", "left")
        scanned = scanned.withColumn("findings", S.in_order(F.concat("findings", found))).drop("aliases")
    return scanned.drop("masked")


def release_status(confirmed: Column, review: Column, ner_available: Column) -> Column:
    """Precedence: what is still there withholds; then what a person must see; then a missing check."""
    return (
        F.when(confirmed > 0, "withheld").when(review > 0, "review_required")
        .when(~ner_available, "review_required").otherwise("validated_candidate")
    )


def model_mentions(found: DataFrame, backend: backends.Backend) -> DataFrame:
    """Adds to `spans` what the model finds, and `accepted`, `review`: its accepted texts and the number of spans to review.

    The model scans each text twice, as it is and with the detectors' spans masked. An accepted text is
    replaced wherever it stands as complete tokens.
    """
    masked = found.withColumn("_masked", S.mask_spans(F.col("text"), F.col("spans")))
    both = backends.detect_twice(masked, backend, "text", "_masked").drop("_masked")
    plain = F.transform("model_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["text"].alias("text")))
    seen = both.withColumn("_seen", plain).drop("model_spans")
    taken = F.filter("_seen", lambda s: s["kind"].isin(ACCEPTED))
    again = F.flatten(F.transform("_taken", lambda s: F.when(S.usable_alias(s["text"]), S.alias_occurrences(F.col("text"), s["text"], s["kind"])).otherwise(F.array().cast(S.SPAN))))
    out = seen.withColumn("_taken", taken).withColumn("spans", S.in_order(F.concat("spans", "_taken", again)))
    review = F.size("_seen") - F.size("_taken")
    return out.withColumns({"accepted": F.array_distinct(F.transform("_taken", lambda s: s["text"])), "review": review}).drop("_seen", "_taken")


def gate(docs: DataFrame, aliases: DataFrame | None = None, ner_available: bool | Column = False, backend: backends.Backend | None = None, kinds: list[str] | None = None) -> DataFrame:
    """Every document with its counts and status.

    With a backend its two scans are part of the gate. Without one, `ner_available` says whether the
    texts, or which of them, were scanned for names elsewhere; by default none was, so none is validated. The
    null backend is no scan. With `kinds` only those detectors run.
    """
    found = mentions(docs, kinds)
    scans = backend is not None and backend is not backends.null_backend
    if scans:
        found = model_mentions(found, backend)
    scanned = residual(substitute(found), aliases, kinds)
    if scans:
        masked = S.mask_placeholders(F.col("redacted"))
        left = F.flatten(F.transform(F.filter("accepted", S.usable_alias), lambda a: S.alias_occurrences(masked, a)))
        scanned = scanned.withColumn("findings", S.in_order(F.concat("findings", left)))
    review = F.col("review") if scans else F.lit(0)
    elsewhere = F.lit(ner_available) if isinstance(ner_available, bool) else F.coalesce(ner_available, F.lit(False))
    ran = F.lit(True) if scans else elsewhere if backend is None else F.lit(False)
    confirmed = F.size("findings")
    return scanned.select(
        "document_id", F.size("spans").cast("long").alias("detected_count"), F.size("selected").cast("long").alias("replacement_count"),
        confirmed.cast("long").alias("confirmed_finding_count"), F.sha2("redacted", 256).alias("content_sha256"),
        release_status(confirmed, review, ran).alias("release_status"), "redacted",
    )


def release_rule_v1(passed: Column, number: Column, flags: Column, findings: Column, transcription: Column) -> Column:
    """The first generation's rule: every condition must hold."""
    good = passed & (number >= 0.90) & (F.size(flags) == 0) & (F.size(findings) == 0) & (F.coalesce(transcription, F.lit(1.0)) >= 0.85)
    return F.when(good, "released").otherwise("withheld")


def apply_review(results: DataFrame, decisions: DataFrame) -> DataFrame:
    """A person's decisions (document_id, decision preserve or withhold) on documents that await one."""
    joined = results.join(decisions, "document_id", "left")
    decided = F.when(
        (F.col("release_status") == "review_required") & F.col("decision").isNotNull(),
        F.when(F.col("decision") == "preserve", "validated_candidate").otherwise("withheld"),
    ).otherwise(F.col("release_status"))
    return joined.withColumn("release_status", decided).drop("decision")


def unmatched_decisions(results: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decisions on documents that await none: a review with any is rejected."""
    return decisions.join(results.where("release_status = 'review_required'"), "document_id", "left_anti")


def leak_report(values: DataFrame, id_pattern: str = r"^[a-z]+_[0-9a-f]{16,20}$") -> DataFrame:
    """(file, findings) from (file, field, value): id fields must be opaque, other strings free of identifiers."""
    is_id = F.col("field").rlike("_id$")
    opaque = F.when(is_id & ~F.col("value").rlike(id_pattern), F.array(F.lit("non_opaque_id"))).otherwise(F.array().cast("array<string>"))
    seen = F.array_distinct(F.transform(S.detect(F.col("value")), lambda s: s["kind"]))
    findings = values.where("value IS NOT NULL").select("file", F.explode(F.when(is_id, opaque).otherwise(seen)).alias("finding"))
    return findings.groupBy("file").agg(F.sort_array(F.collect_set("finding")).alias("findings"))


def audit(scanned: DataFrame, context: int = 80, structured: DataFrame | None = None) -> DataFrame:
    """A row for each finding, with the text around it on one line.

    With the values extracted from each document (document_id, value) also whether the finding is one of
    those, in any case; values under three characters don't count.
    """
    each = scanned.select("document_id", "redacted", F.explode("findings").alias("f"))
    start = F.greatest(F.col("f.start") - context, F.lit(0))
    around = F.translate(F.substring("redacted", start + 1, F.col("f.end") + context - start), "\n", " ")
    place = [F.col("f.kind").alias("finding_type"), F.col("f.start").alias("start"), F.col("f.end").alias("end"), around.alias("context")]
    if structured is None:
        return each.select("document_id", *place)
    value = F.lower(F.trim("value"))
    known = structured.where(F.length(F.trim("value")) >= 3).select("document_id", value.alias("_value")).distinct()
    found = each.select("document_id", *place, F.lower("f.text").alias("_value")).join(known.withColumn("_known", F.lit(True)), ["document_id", "_value"], "left")
    return found.withColumn("matches_structured_extraction", F.coalesce("_known", F.lit(False))).drop("_value", "_known")

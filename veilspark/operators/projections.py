"""Public tables: raw values go, what they name stays as ids, years as buckets, categories as a vocabulary.

A field is struct(value, status, model_confidence, validation_flags). Item tables have one row for each item
with its document's columns; sections and profiles are put together from them only at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions import scalars as C
from veilspark.operators import joins
from veilspark.operators.sampling import disambiguated

ITEM = ["application_id", "document_id", "person_id"]
FIELD = "struct<value:string,status:string,model_confidence:double,validation_flags:array<string>>"


def raw_value(field: str | Column) -> Column:
    return (F.col(field) if isinstance(field, str) else field)["value"]


def field(value: Column, status: str = "found", number: Column | None = None) -> Column:
    """A field as a model gives it, without flags."""
    number = F.lit(None) if number is None else number
    parts = (value.cast("string").alias("value"), F.lit(status).alias("status"), number.alias("model_confidence"), F.array().alias("validation_flags"))
    return F.struct(*parts).cast(FIELD)


def shown(name: str, kind: str | None = None, bucket: bool = False) -> Column:
    """The published form of a field column, checked against a vocabulary or as a period of five years."""
    f = F.col(name)
    value = C.five_year_bucket(f["value"]) if bucket else f["value"]
    return C.public_field(value, f["status"], f["model_confidence"], f["validation_flags"], kind)


def with_entity(rows: DataFrame, value: Column, aliases: DataFrame, kinds: list[str], name: str) -> DataFrame:
    """rows with the entity whose alias of one of the kinds equals the value: verified first, then the oldest, else null."""
    best = aliases.where(F.col("alias_type").isin(kinds)).groupBy("normalized_value").agg(
        F.min_by("entity_id", F.struct((~F.col("verified")).alias("unverified"), "alias_id")).alias(name)
    )
    keyed = rows.withColumn("normalized_value", C.normalized_key(value))
    return keyed.join(best, "normalized_value", "left").drop("normalized_value")


def public_education(items: DataFrame, aliases: DataFrame) -> DataFrame:
    found = with_entity(items, raw_value("institution"), aliases, ["organization_name"], "organization_id")
    return found.select(
        F.col("item_id").alias("education_id"), *ITEM, "organization_id", shown("degree_type", "degree_type").alias("degree_type"),
        shown("field").alias("academic_field"), *[shown(f"{c}_year", bucket=True).alias(f"{c}_period") for c in ("start", "end", "graduation")],
        "item_model_confidence",
    )


def public_employment(items: DataFrame, aliases: DataFrame) -> DataFrame:
    found = with_entity(items, raw_value("organization"), aliases, ["organization_name"], "organization_id")
    return found.select(
        F.col("item_id").alias("employment_id"), *ITEM, "organization_id", *[shown(c, c).alias(c) for c in ("job_category", "position_type")],
        *[shown(f"{c}_date", bucket=True).alias(f"{c}_period") for c in ("start", "end")], "item_model_confidence",
    )


def work_key(doi: Column, title: Column, year: Column, item_id: Column) -> Column:
    """What tells works apart: the DOI, else title and year, else the item itself."""
    titled = F.when(title != "", F.concat_ws("|", title, F.coalesce(year, F.lit("None"))))
    return F.coalesce(F.when(doi != "", doi), titled, item_id.cast("string"))


def public_publications(items: DataFrame, aliases: DataFrame) -> DataFrame:
    key = work_key(raw_value("doi"), raw_value("title"), raw_value("year"), F.col("item_id"))
    found = with_entity(items, key, aliases, ["work_key"], "work_id")
    found = with_entity(found, raw_value("venue"), aliases, ["venue_name", "organization_name"], "venue_organization_id")
    return found.select(
        F.col("item_id").alias("publication_id"), *ITEM, "work_id", "venue_organization_id",
        shown("publication_type", "publication_type").alias("publication_type"), shown("year").alias("publication_year"), "item_model_confidence",
    )


def named_people(mentions: DataFrame, last: bool = False) -> DataFrame:
    """(document_id, name_key, person_id): whom a name stands for in a document, by its first or last resolved mention."""
    people = mentions.where("kind = 'person_name' AND entity_id IS NOT NULL").withColumn("name_key", C.normalized_key(F.col("text")))
    best = (F.max_by if last else F.min_by)("entity_id", "ord")
    return people.groupBy("document_id", "name_key").agg(best.alias("person_id"))


def public_authors(authors: DataFrame, publications: DataFrame, mentions: DataFrame, last: bool = True) -> DataFrame:
    """Authors (publication_id, document_id, name, author_position, is_applicant) with their work and person.

    An author who is the applicant is the document's person; others are found by name among its mentions.
    """
    names = named_people(mentions, last).withColumnRenamed("person_id", "_named")
    works = publications.select("publication_id", "work_id", F.col("person_id").alias("_applicant"))
    found = authors.withColumn("name_key", C.normalized_key(raw_value("name"))).join(names, ["document_id", "name_key"], "left")
    person = F.when(F.col("is_applicant"), F.col("_applicant")).otherwise(F.col("_named"))
    return found.join(works, "publication_id").select(
        "publication_id", "work_id", person.alias("person_id"), "author_position", "is_applicant", F.col("name.model_confidence").alias("model_confidence")
    )


def section_shell(status: Column, number: Column, items: Column, reason: Column, flags: Column) -> Column:
    """A section as it is published, whatever its items are."""
    return F.struct(
        F.coalesce(status, F.lit("model_failed")).alias("status"), number.alias("model_confidence"),
        F.when(reason != "", reason).alias("not_found_reason"), flags.alias("validation_flags"), items.alias("items"),
    )


def profiles(documents: DataFrame, sections: DataFrame, tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row a document (ITEM) with a shell for each section; tables: section to (public items, their id).

    sections: (document_id, section, status, model_confidence, not_found_reason, validation_flags). A document's
    items are those of one text, so its row holds what the text held.
    """
    out = documents
    for name, (items, id_) in tables.items():
        row = F.struct(*[c for c in items.columns if c not in ITEM])
        listed = items.groupBy("document_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(id_).alias("_id"), row.alias("_row")))), lambda x: x["_row"]).alias("_items"))
        told = sections.where(F.col("section") == name).join(listed, "document_id", "left")
        shell = section_shell(F.col("status"), F.col("model_confidence"), F.col("_items"), F.col("not_found_reason"), F.col("validation_flags"))
        out = out.join(told.select("document_id", shell.alias(name)), "document_id", "left")
    return out


def public_relationships(edges: DataFrame) -> DataFrame:
    """The columns of relationships that hold no raw value."""
    return edges.select("relationship_id", "relationship_type", "subject_person_id", "object_person_id", "application_id", "document_id", "confidence", "review_status")


def cv_relationships(items: DataFrame, id_: str, kind: str, target: str) -> DataFrame:
    """Edges of the first generation from a document's person to what its items name: both must be known."""
    key = F.concat_ws("|", F.lit(kind), F.col(id_).cast("string"))
    known = items.where(F.col("person_id").isNotNull() & F.col(target).isNotNull())
    return known.select(
        C.stable_id("rel", key).alias("relationship_id"), F.lit(kind).alias("relationship_type"), F.col("person_id").alias("source_id"),
        F.col(target).alias("target_id"), "document_id", F.col("item_model_confidence").alias("model_confidence"),
    )


def redaction_export(occurrences: DataFrame, entities: DataFrame, people: DataFrame) -> DataFrame:
    """Accepted occurrences (document_id, mention_id, ord, accepted, entity_id), a row each, with their link to entity and
    person; mention ids that a document uses more than once are numbered from the second on."""
    linked = joins.link_status(occurrences.where("accepted").drop("accepted"), entities, people)
    return disambiguated(linked, ["document_id", "mention_id"], ["ord"], F.col("mention_id"), "redaction_id")

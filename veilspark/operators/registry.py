"""Registry tables: opaque entities and their aliases, parties, imports from an older registry.

Entities, aliases, evidence and members are rows, so none of them is bounded by what one row can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions import scalars as C

PARTY_IDENTIFIER = ["party", "identifier_type", "normalized_value", "document_id", "entity_id"]


def resolved_values(rows: DataFrame, kind: str, value: str = "value", strong_key: str | None = None) -> DataFrame:
    """rows with a known value and its `entity_id`: the same for equal strong keys, or equal values where there is none."""
    compact = C.single_spaced(F.col(value))
    key = C.normalized_key(F.coalesce(F.col(strong_key), compact) if strong_key else compact)
    return rows.withColumn(value, compact).where(F.col(value) != "").withColumn("entity_id", C.stable_id(kind, key))


def opaque_entities(resolved: DataFrame, entity_type: str, order: str, evidence: str) -> DataFrame:
    """(entity_id, entity_type, occurrence_count): typed by its first row, counted by distinct evidence."""
    return resolved.groupBy("entity_id").agg(F.min_by(entity_type, order).alias("entity_type"), F.count_distinct(evidence).alias("occurrence_count"))


def opaque_aliases(resolved: DataFrame, value: str = "value") -> DataFrame:
    return resolved.select("entity_id", F.col(value).alias("alias")).distinct()


def public_rows(entities: DataFrame, used: DataFrame) -> DataFrame:
    """Of entities that are used somewhere, what may be shown."""
    return entities.join(used.select("entity_id").distinct(), "entity_id", "left_semi").select(
        "entity_id", F.coalesce("entity_type", F.lit("unknown")).alias("entity_type"), "occurrence_count", F.lit("resolved").alias("resolution_status")
    )


def importable(persons: DataFrame) -> DataFrame:
    """Persons of an older registry (person_id, status) that are active and named as persons are."""
    return persons.where((F.coalesce("status", F.lit("active")) == "active") & F.col("person_id").startswith("person_"))


def imported(persons: DataFrame, identifiers: DataFrame, imports: DataFrame, checksum: str) -> tuple[DataFrame, DataFrame]:
    """(entities, aliases) that an older registry adds: nothing if a source of this checksum was imported before."""
    before = imports.where(F.col("checksum") == checksum).select("checksum").limit(1)
    # One row at most, so that telling it to every task is bounded.
    fresh = importable(persons).withColumn("checksum", F.lit(checksum)).join(F.broadcast(before), "checksum", "left_anti")
    entities = fresh.select(F.col("person_id").alias("entity_id"), F.lit("person").alias("entity_type"), F.lit("active").alias("status"))
    usable = identifiers.where("trim(value) <> '' AND identifier_type IS NOT NULL").join(fresh.select("person_id"), "person_id", "left_semi")
    aliases = usable.select(
        F.col("person_id").alias("entity_id"), F.col("identifier_type").alias("alias_type"),
        C.identity_value(F.col("identifier_type"), F.col("value")).alias("normalized_value"), F.coalesce("verified", F.lit(False)).alias("verified"),
    )
    return entities, aliases.distinct()


def parties(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows (party, role, application_id, document_id, entity_id) of several sources as one table with their `source`."""
    out = None
    for source, rows in tables.items():
        named = rows.select("party", "role", "application_id", "document_id", "entity_id", F.lit(source).alias("source")).where("party IS NOT NULL")
        out = named if out is None else out.unionByName(named)
    return out.distinct()


def party_identifiers(rows: DataFrame) -> DataFrame:
    """Evidence of parties, each identifier once for a document and entity."""
    normal = rows.withColumn("normalized_value", C.identity_value(F.col("identifier_type"), F.col("value"))).where("normalized_value <> ''")
    return normal.groupBy(*PARTY_IDENTIFIER).agg(F.bool_or("verified").alias("verified"), F.count(F.lit(1)).alias("seen"))


def serialized(rows: DataFrame, persons: DataFrame) -> DataFrame:
    """One row a party, its values in order, with its person. A party is local to an application, which bounds it."""
    sets = {f"{c}s": F.sort_array(F.collect_set(f"{c}")) for c in ("role", "application_id", "document_id", "entity_id")}
    return rows.groupBy("party").agg(*[c.alias(n) for n, c in sets.items()], F.min("source").alias("source")).join(persons, "party", "left")


def active_persons(members: DataFrame, retired: DataFrame) -> DataFrame:
    """Members (party, person_id) under the person theirs was merged into; retired: (person_id, survivor), with paths compressed."""
    return members.join(retired, "person_id", "left").select("party", F.coalesce("survivor", "person_id").alias("person_id"))


def representatives(members: DataFrame) -> DataFrame:
    """For each person the least of its parties, which stands for it."""
    return members.groupBy("person_id").agg(F.min("party").alias("party"), F.count(F.lit(1)).alias("parties"))


def reason_label(role: Column, kind: Column) -> Column:
    """What a reviewer reads: the role and kind of an occurrence in words."""
    who = F.when(role == "unknown", "Unclassified").otherwise(F.initcap(F.replace(role, F.lit("_"), F.lit(" "))))
    return F.concat(who, F.lit(" "), F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair]), kind), kind))


# Kinds of identifying text in words.
LABELS = {
    "phone_number": "phone or fax number",
    "email": "email address",
    "website": "website",
    "applicant_name": "name",
    "address": "postal address",
    "coauthor_identity": "co-author identity",
    "reference_identity": "reference identity",
    "publication_information": "publication information",
    "other_identifying_data": "identifying information",
}

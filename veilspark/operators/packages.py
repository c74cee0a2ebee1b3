"""Three audiences of one graph: what each of them may see, as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.operators.projections import public_relationships
from veilspark.plans.frames import cut

# The columns that leave the restricted part, and those of its own lists.
PUBLIC = {
    "applications": ["application_id", "has_cv", "recommendation_letter_count", "status"],
    "documents": ["document_id", "application_id", "document_type", "letter_index", "status"],
    "people": [
        "person_id", "roles", "application_count", "document_count", "resolution_status", "identity_linkage_confidence",
        "recommendation_letter_count", "distinct_applicants_recommended", "is_repeat_recommender",
    ],
    "repeat_recommenders": [
        "person_id", "distinct_applicants_recommended", "recommendation_letter_count", "application_count", "document_count",
        "identity_linkage_confidence", "resolution_status",
    ],
}
REDACTIONS = [
    "redaction_id", "entity_id", "application_id", "document_id", "document_type", "letter_index", "category", "identifier_type",
    "person_role", "person_id", "identity_link_status", "text", "page", "reason", "match_confidence", "value_verified_against_pdf",
]
RESTRICTED = ["parties", "people", "relationships", "review_queue", "automatic_matches"]


def counted(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of a package, empty tables too."""
    return reduce(DataFrame.unionByName, [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, t in tables.items()])


def audiences(graph: dict[str, DataFrame]) -> dict[str, dict[str, DataFrame]]:
    """The packages `restricted`, `researcher` and `researcher_p4` of a graph's tables, each with its counts.

    The graph's tables are computed once (`cut`), since several packages show them. The restricted package has the
    evidence, whole; researchers get the columns above and nothing else, whatever the tables hold beyond them, with
    roles joined by a bar; the third package adds what was redacted. A table or column that lacks is an error.
    """
    lacking = sorted({*PUBLIC, *RESTRICTED, "redactions"} - set(graph))
    if lacking:
        raise ValueError(f"the graph lacks {', '.join(lacking)}")
    held = {name: cut(table) for name, table in graph.items()}
    shown = {name: held[name].select(*columns) for name, columns in PUBLIC.items()}
    shown["people"] = shown["people"].withColumn("roles", F.array_join("roles", "|"))
    shown["relationships"] = public_relationships(held["relationships"])
    packages = {
        "restricted": {name: held[name] for name in RESTRICTED},
        "researcher": shown,
        "researcher_p4": {**shown, "redactions": held["redactions"].select(*REDACTIONS)},
    }
    return {name: {**tables, "counts": counted(tables)} for name, tables in packages.items()}

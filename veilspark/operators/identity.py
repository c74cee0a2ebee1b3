"""Resolution of identities as one job that can go on from where an earlier run ended.

Verified strong identifiers tie parties first, whatever their unique ids. What they tie is one cluster with all of its
unique ids, and balanced evidence joins clusters under the constraint. Both are functions of the identifiers alone, and a
component of evidence never depends on another one, so new identifiers need only the components that they can reach.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.operators.graph import connected_components, renamed
from veilspark.operators.merging import constrained_components
from veilspark.operators.resolution import balanced_evidence, blocked_keys, relationships, strong_edges
from veilspark.plans.frames import cut

#: Columns of identifiers besides the party.
KEY = ["identifier_type", "normalized_value"]


def resolve(ids: DataFrame, party: str, known: DataFrame | None = None) -> DataFrame:
    """(party, component, person) of all parties of identifiers (party, identifier_type, normalized_value, verified).

    component: what evidence connects, named by its least party; person: what may be one, named likewise. known:
    (party, person_id) of persons before; strong keys that tie several of those merge nobody.
    """
    strong = ids
    if known is not None:
        strong = ids.join(blocked_keys(ids, party, known), KEY, "left_anti")
    sure = cut(strong_edges(strong, party))
    first = cut(connected_components(sure).select(F.col("vertex").alias("old"), F.col("component").alias("new")))
    balanced = cut(balanced_evidence(ids, party).select("src", "dst", "confidence"))
    unique = ids.where("verified AND identifier_type = 'unique_identifier'").select(party, "normalized_value").distinct()
    persons = constrained_components(renamed(balanced, ["src", "dst"], first), renamed(unique, [party], first), party)
    persons = cut(persons.select(F.col("party").alias("old"), F.col("person").alias("new")))
    whole = connected_components(sure.unionByName(balanced.select("src", "dst"))).select(F.col("vertex").alias("old"), F.col("component").alias("new"))
    parties = ids.select(party).distinct().select(F.col(party).alias("party"), F.col(party).alias("component"), F.col(party).alias("person"))
    found = renamed(renamed(parties, ["person"], first), ["person"], persons)
    return cut(renamed(found, ["component"], cut(whole)).select("party", "component", "person"))


def resolve_more(ids: DataFrame, assigned: DataFrame, fresh: DataFrame, party: str) -> tuple[DataFrame, DataFrame]:
    """All identifiers, and (party, component, person) as `resolve` gives them for all, after fresh ones came.

    ids, assigned: what was there before and its resolution. Only components that share a value with a party of fresh
    identifiers are resolved again; the rows of all others are taken over as they are.
    """
    whole = cut(ids.unionByName(fresh).distinct())
    theirs = whole.join(fresh.select(party).distinct(), party, "left_semi").select(*KEY).distinct()
    reached = whole.join(theirs, KEY, "left_semi").select(F.col(party).alias("party")).distinct()
    reached = cut(reached.unionByName(fresh.select(F.col(party).alias("party"))).distinct())
    components = assigned.join(reached, "party", "left_semi").select("component").distinct()
    again = cut(assigned.join(components, "component", "left_semi").select("party").unionByName(reached).distinct())
    redone = resolve(whole.join(again.withColumnRenamed("party", party), party, "left_semi"), party)
    return whole, cut(assigned.join(again, "party", "left_anti").unionByName(redone))


def person_relationships(edges: DataFrame, assigned: DataFrame, kind: str) -> DataFrame:
    """Edges between parties (source_id, target_id) as relationships between persons, each once, loops left out."""
    names = assigned.where("party <> person").select(F.col("party").alias("old"), F.col("person").alias("new"))
    return relationships(renamed(edges, ["source_id", "target_id"], names).where("source_id <> target_id"), kind)

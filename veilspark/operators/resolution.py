"""Entity resolution as evidence edges and their components.

Ids are names of components: the digest of a component's least member under a salt, so they don't
depend on the order of documents or partitions.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.functions.scalars import identity_value, is_full_name, is_personal_url, name_parts, stable_id
from veilspark.operators.sets import disjoint_conflict
from veilspark.plans.frames import cut

# Confidence of exact evidence, and what fuzzy names need.
CONFIDENCE = {"person_name": 0.80, "phone_number": 0.90, "website": 0.88}
STRONG = ["email", "unique_identifier"]
FUZZY_RATIO, FUZZY_CONFIDENCE = 0.94, 0.72


def identifiers(rows: DataFrame, kind: str = "identifier_type", value: str = "value") -> DataFrame:
    return rows.withColumn("normalized_value", identity_value(F.col(kind), F.col(value))).where("normalized_value <> ''")


def exact_entities(rows: DataFrame, kind: str, key: Column, salt: str = "") -> DataFrame:
    """rows with `entity_id`: the same for equal keys of a kind, made from the key."""
    return rows.withColumn("entity_id", stable_id(F.col(kind), F.concat(F.lit(salt), key)))


def strong_edges(ids: DataFrame, party: str) -> DataFrame:
    """(src, dst): each verified strong identifier ties its parties to the least of them: a star, not all pairs."""
    strong = ids.where(F.col("verified") & F.col("identifier_type").isin(STRONG))
    least = strong.groupBy("identifier_type", "normalized_value").agg(F.min(party).alias("src"), F.max(party).alias("most"))
    stars = strong.join(least.where("src <> most").drop("most"), ["identifier_type", "normalized_value"])
    return stars.where(F.col("src") != F.col(party)).select("src", F.col(party).alias("dst")).distinct()


def blocked_keys(ids: DataFrame, party: str, known: DataFrame) -> DataFrame:
    """Strong keys that tie a current party to several persons known before: they merge nobody."""
    tied = ids.where(F.col("verified") & F.col("identifier_type").isin(STRONG)).join(known, party, "left")
    by_key = tied.groupBy("identifier_type", "normalized_value").agg(F.count_distinct("person_id").alias("known_persons"))
    return by_key.where("known_persons > 1").drop("known_persons")


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of matching characters in order, of pairs that blocking has left."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def _allowed(total: Column) -> Column:
    """Characters of two names that may be left unmatched, by the sum of their lengths."""
    return F.floor((1 - FUZZY_RATIO) * total + 1e-9).cast("int")


def _edits(size: Column) -> Column:
    """The most that may be left unmatched in a pair of a name of this length and one that is not shorter."""
    share = 1 - FUZZY_RATIO
    return _allowed(2 * size + F.floor(2 * share / (1 - share) * size + 1e-9))


def _keyed(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, name) of names (name, surname, initial, inner) as the longer of a pair, and as the other one; inner is the
    name without what all names of its surname and initial begin and end with.

    Each similar pair has a key in common. Where the longer name loses one character, that is its inner part without
    it: the other one's inner part, or that with one character left out too. Where it loses more, the shorter inner part
    is cut into more pieces than there can be edits, so one of them stands whole somewhere in the longer one.
    """
    size, width = F.length("name"), F.length("inner")

    def key(kind: str, text: Column) -> Column:
        return F.xxhash64("surname", "initial", F.lit(kind), text)

    def each(count: Column, f) -> Column:
        return F.transform(F.slice(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), F.lit(1), F.greatest(count, F.lit(0))), f)

    def where(test: Column, keys: Column) -> Column:
        return F.when(test, keys).otherwise(F.array().cast("array<bigint>"))

    whole = F.array(key("whole", F.col("inner")))
    without = each(width, lambda i: key("whole", F.concat(F.substring("inner", F.lit(1), i), F.substring("inner", i + 2, width))))
    share = 1 - FUZZY_RATIO
    least = size - F.floor(2 * share / (1 + share) * size + 1e-9).cast("int")  # of the shortest name that may be similar
    pieces = F.array_distinct(F.transform(F.sequence(least, size), lambda n: _piece(n, n - size + width)))
    inside = F.flatten(F.transform(pieces, lambda q: each(width - q + 1, lambda i: key("piece", F.substring("inner", i + 1, q)))))
    piece = _piece(size, width)
    cut_up = each(F.when(piece > 0, _edits(size) + 1).otherwise(1), lambda i: key("piece", F.substring("inner", i * piece + 1, piece)))
    longer = F.concat(where(_allowed(2 * size - 1) >= 1, without), where(_allowed(2 * size - 2) >= 2, inside))
    other = F.concat(where(_allowed(2 * size + 1) >= 1, whole), where(_allowed(2 * size) >= 2, without), where(_allowed(2 * size + 2) >= 2, cut_up))
    return tuple(names.select(F.explode(F.array_distinct(keys)).alias("key"), "name") for keys in (longer, other))


def _piece(size: Column, width: Column) -> Column:
    """Length of each piece of an inner part of this width, of a name of this length; 0 where there are more edits than characters."""
    return F.floor(F.greatest(width, F.lit(0)) / (_edits(size) + 1)).cast("int")


def _candidates(names: DataFrame) -> DataFrame:
    """Pairs (left_name, right_name) of names (name, surname, initial, inner) that share a key and have few enough edits."""
    longer, other = _keyed(names)
    long_, short = F.length("long"), F.length("short")
    pairs = longer.withColumnRenamed("name", "long").join(other.withColumnRenamed("name", "short"), "key")
    # A ratio of at least FUZZY_RATIO bounds how far lengths may differ.
    pairs = pairs.where((F.col("long") != F.col("short")) & (long_ >= short) & (long_ - short <= _allowed(long_ + short)))
    # As many edits as characters may be left unmatched: what has more cannot reach the ratio.
    # Long names share many keys; they are compared once, by their ratio, and not for each key.
    pairs = pairs.where((long_ > 64) | (F.levenshtein("long", "short") <= _allowed(long_ + short)))
    return pairs.select(F.least("long", "short").alias("left_name"), F.greatest("long", "short").alias("right_name"))


def name_pairs(names: DataFrame, party: str, name: str) -> DataFrame:
    """Pairs of distinct names of parties that are similar and have surname and initial in common.

    Only names that share a key of `_keyed` are compared, so a frequent surname costs no comparison of all its names.
    """
    parts = {k: name_parts(F.col("name"))[k] for k in ("surname", "initial")}
    distinct = cut(names.select(F.col(name).alias("name")).where("name <> ''").distinct().withColumns(parts).where("surname <> ''"))
    plain = F.startswith("name", "initial") & F.endswith("name", F.concat(F.lit(" "), "surname")) & (F.length("name") >= F.length("surname") + 2)
    inner = F.substring("name", F.lit(2), F.length("name") - F.length("surname") - 2)
    pairs = _candidates(distinct.where(plain).withColumn("inner", inner))
    odd = distinct.where(~plain)
    if not odd.isEmpty():  # names of one word, or with commas: theirs and others of such blocks meet as they stand
        blocks = odd.select("surname", "initial").distinct()
        pairs = pairs.unionByName(_candidates(distinct.join(blocks, ["surname", "initial"], "left_semi").withColumn("inner", F.col("name"))))
    left, right = name_parts(F.col("left_name")), name_parts(F.col("right_name"))
    pairs = pairs.where(left == right).distinct()  # keys are digests
    found = pairs.withColumn("ratio", similarity("left_name", "right_name")).where(F.col("ratio") >= FUZZY_RATIO)
    return found.select(left["surname"].alias("surname"), left["initial"].alias("initial"), "left_name", "right_name", "ratio")


def auto_eligible(kind: Column, value: Column) -> Column:
    return (
        F.when(kind == "person_name", is_full_name(value)).when(kind == "phone_number", F.length(value) >= 10)
        .when(kind == "website", is_personal_url(value)).otherwise(F.lit(False))
    )


def exact_evidence(ids: DataFrame, party: str) -> DataFrame:
    """(src, dst, confidence, kind): parties with an equal name, phone or site, tied to the least of each value."""
    kinds = F.create_map(*[F.lit(x) for pair in CONFIDENCE.items() for x in pair])
    usable = ids.where(F.col("identifier_type").isin(*CONFIDENCE) & auto_eligible(F.col("identifier_type"), F.col("normalized_value")))
    least = usable.groupBy("identifier_type", "normalized_value").agg(F.min(party).alias("src"))
    tied = usable.join(least, ["identifier_type", "normalized_value"]).where(F.col("src") != F.col(party))
    return tied.select("src", F.col(party).alias("dst"), F.element_at(kinds, F.col("identifier_type")).alias("confidence"), F.col("identifier_type").alias("kind")).distinct()


def fuzzy_evidence(ids: DataFrame, party: str) -> DataFrame:
    """(src, dst, confidence, kind): parties of similar names that also share a phone number or a site.

    Of the parties that hold one shared value, each with one of two similar names is tied to the least with the
    other: two stars, which connect them all, and not each with each.
    """
    names = ids.where("identifier_type = 'person_name'").select(party, F.col("normalized_value").alias("name")).distinct()
    support = ids.where("identifier_type IN ('phone_number', 'website')").select(party, "identifier_type", "normalized_value").distinct()
    held = cut(names.join(support, party))
    shared = ["identifier_type", "normalized_value"]
    pairs = cut(name_pairs(held, party, "name").select("left_name", "right_name"))
    both = pairs.unionByName(pairs.select(F.col("right_name").alias("left_name"), F.col("left_name").alias("right_name")))
    least = held.groupBy(*shared, "name").agg(F.min(party).alias("least"))
    # Before they meet the parties: the least party of the similar name, for each value that holds one.
    targets = least.join(both, F.col("name") == F.col("right_name")).select(*shared, F.col("left_name").alias("name"), "least")
    tied = held.join(targets, [*shared, "name"]).where(F.col(party) != F.col("least"))
    return tied.select(
        F.least(party, "least").alias("src"), F.greatest(party, "least").alias("dst"),
        F.lit(FUZZY_CONFIDENCE).alias("confidence"), F.lit("fuzzy_name").alias("kind"),
    ).distinct()


def balanced_evidence(ids: DataFrame, party: str) -> DataFrame:
    """What constrained_components merges by: equal names, phones and sites, and similar names with support."""
    return exact_evidence(ids, party).unionByName(fuzzy_evidence(ids, party))


def conflicts(pairs: DataFrame, sets: DataFrame, party: str, ids: str) -> DataFrame:
    """pairs (left, right) with `conflict`: both have unique ids, and none in common."""
    left = sets.select(F.col(party).alias("left"), F.col(ids).alias("left_ids"))
    right = sets.select(F.col(party).alias("right"), F.col(ids).alias("right_ids"))
    return pairs.join(left, "left").join(right, "right").withColumn("conflict", disjoint_conflict(F.col("left_ids"), F.col("right_ids")))


def relationships(edges: DataFrame, kind: str) -> DataFrame:
    """(relationship_id, relationship_type, source_id, target_id): each edge once."""
    id_ = stable_id("relationship", F.concat_ws("|", F.lit(kind), "source_id", "target_id"))
    return edges.select("source_id", "target_id").distinct().select(id_.alias("relationship_id"), F.lit(kind).alias("relationship_type"), "source_id", "target_id")


def candidate_id(a: Column, b: Column) -> Column:
    """The same whichever party is named first."""
    return stable_id("candidate", F.concat_ws(":", F.least(a, b).cast("string"), F.greatest(a, b).cast("string")))


def review_candidates(proposed: list[DataFrame], rejected: DataFrame, merged: DataFrame) -> DataFrame:
    """Pairs (a, b, reason) for a person to decide: all reasons of a pair, without those rejected before and
    those whose parties are of one person already (merged: party, person_id)."""
    pairs = proposed[0]
    for more in proposed[1:]:
        pairs = pairs.unionByName(more)
    ordered = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "reason")
    one = ordered.groupBy("a", "b").agg(F.sort_array(F.collect_set("reason")).alias("reasons")).withColumn("candidate_id", candidate_id(F.col("a"), F.col("b")))
    left = one.join(rejected.select("candidate_id").distinct(), "candidate_id", "left_anti")
    person = merged.select("party", "person_id")
    of_a, of_b = person.toDF("a", "_of_a"), person.toDF("b", "_of_b")
    return left.join(of_a, "a", "left").join(of_b, "b", "left").where("_of_a IS NULL OR _of_b IS NULL OR _of_a <> _of_b").drop("_of_a", "_of_b")


def decided(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decisions (candidate_id, decision) on candidates (a, b, conflict, candidate_id), each with its outcome.

    An id that its parties don't give again is `invalid`, accepting against a conflict is `conflict`; what is
    accepted else is `merge`, what is rejected is `rejected` and stays so.
    """
    both = decisions.join(candidates, "candidate_id", "left")
    genuine = F.coalesce(F.col("candidate_id") == candidate_id(F.col("a"), F.col("b")), F.lit(False))
    outcome = (
        F.when(~genuine, "invalid").when(F.col("decision") == "reject", "rejected")
        .when(F.col("decision") != "accept", "invalid").when(F.col("conflict"), "conflict").otherwise("merge")
    )
    return both.withColumn("outcome", outcome)


def review_rows(candidates: DataFrame, lists: list[str]) -> DataFrame:
    """Candidates with each list as one field, its values in order with a bar between."""
    return candidates.withColumns({c: F.array_join(F.sort_array(c), " | ") for c in lists})

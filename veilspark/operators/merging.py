"""Merging under constraints: clusters are joined by evidence, best first, unless their unique ids are disjoint.

The result is that of one loop over all edges in the order of (confidence falling, src, dst): an edge joins the clusters
of its ends unless both have unique ids and none in common; a refused edge is not tried again. No task holds a
large component. Of each component of the open edges:

* If no two of its sets of ids can ever be disjoint (at most one cluster has any, or all of them share an id), it
  is one cluster.
* If it has at most SMALL edges, one task settles it by that loop, together with others, about AT_ONCE edges in all.
* Else edges are settled in rounds. An edge can be settled once no earlier edge can still change either of its
  clusters. For a cluster c, its edges are settled in one round, in order, as long as each is the first
  open edge of its other end, no merged end has an earlier edge elsewhere, and the ids of c stay as
  they are; the edge that adds ids to c is the last one. All three bounds are minima over the edges of c, so a
  hub costs a partial aggregate in each task and not a sorted list in one.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.operators.graph import composed, connected_components, renamed
from veilspark.plans.frames import cut

#: Edges of a component that one task may settle.
SMALL = 20_000
#: Edges of small components, on average, that one call settles.
AT_ONCE = 50_000
#: Rounds before what is left is split into components again.
ROUNDS = 6


def _none(ids: Column) -> Column:
    return ids.isNull() | (F.size(ids) == 0)


def _loop(rows: pd.DataFrame) -> pd.DataFrame:
    """The plain loop over whole components: rows are edges (worse, src, dst, a, b), without ids, and clusters a with their ids.

    Components never touch one another, so one loop in the order of all edges does each as a loop of its own would.
    """
    is_edge = rows["ids"].isna()
    known = {a: set(ids) for a, ids in zip(rows["a"][~is_edge].tolist(), rows["ids"][~is_edge], strict=True)}
    edges = rows[is_edge].sort_values(["worse", "src", "dst"], kind="stable")
    top: dict = {}

    def find(v):  # noqa: ANN001, ANN202
        while (up := top.get(v, v)) != v:
            top[v] = v = top.get(up, up)
        return v

    for a, b in zip(edges["a"].tolist(), edges["b"].tolist(), strict=True):
        a, b = find(a), find(b)
        x, y = known.get(a), known.get(b)
        if a != b and not (x and y and x.isdisjoint(y)):
            low, high = min(a, b), max(a, b)
            top[high] = low
            if x or y:
                known[low] = (x or set()) | (y or set())
    moved = [(v, find(v)) for v in list(top)]
    return pd.DataFrame({"old": [v for v, _ in moved], "new": [v for _, v in moved]}, dtype=rows["a"].dtype)


def _settled(placed: DataFrame, sets: DataFrame, members: DataFrame, tasks: int) -> DataFrame:
    """(old, new) of small components: placed edges (component, o, a, b), all members (component, vertex).

    Components are dealt to as many groups as given: a call for each would cost far more than its few edges.
    """
    kind = dict(placed.dtypes)["a"]
    nothing = F.lit(None).cast("array<string>")
    edges = placed.select("component", "o", "a", "b", nothing.alias("ids"))
    known = members.join(sets, members["vertex"] == sets["cluster"])
    known = known.select("component", F.lit(None).cast(placed.schema["o"].dataType).alias("o"), F.col("vertex").alias("a"), F.col("vertex").alias("b"), "ids")
    dealt = edges.unionByName(known).withColumn("group", F.pmod(F.xxhash64("component"), F.lit(tasks)))
    # A cluster's row has no edge; its id stands in for src and dst, as a null would turn whole numbers into floats.
    flat = dealt.select("group", "o.worse", F.coalesce("o.src", "a").alias("src"), F.coalesce("o.dst", "a").alias("dst"), "a", "b", "ids")
    return flat.groupBy("group").applyInPandas(_loop, f"old {kind}, new {kind}")


def _round(edges: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges (o, a, b) and sets (cluster, ids) after a round, and its renamings (old, new)."""
    ends = cut(edges.select("o", F.col("a").alias("hub"), F.col("b").alias("leaf")).unionByName(edges.select("o", F.col("b").alias("hub"), F.col("a").alias("leaf"))))
    first = cut(ends.groupBy("hub").agg(F.min("o").alias("first")))
    second = ends.join(first, "hub").where(F.col("o") > F.col("first")).groupBy("hub").agg(F.min("o").alias("second"))
    about = cut(first.join(second, "hub", "left").join(sets.withColumnRenamed("cluster", "hub"), "hub", "left"))
    rows = ends.join(about.withColumnRenamed("hub", "leaf"), "leaf").join(about.select("hub", F.col("ids").alias("hub_ids")), "hub")
    joins = _none(F.col("ids")) | _none(F.col("hub_ids")) | F.arrays_overlap("ids", "hub_ids")
    more = ~_none(F.col("ids")) & (_none(F.col("hub_ids")) | (F.size(F.array_except("ids", "hub_ids")) > 0))
    rows = rows.select("o", "hub", "leaf", "ids", "second", (F.col("o") == F.col("first")).alias("ready"), joins.alias("joins"), (joins & more).alias("grows"))
    rows = cut(rows)
    bounds = rows.groupBy("hub").agg(
        F.min(F.when(~F.col("ready"), F.col("o"))).alias("unready"),
        F.min(F.when(F.col("ready") & F.col("joins"), F.col("second"))).alias("elsewhere"),
        F.min(F.when(F.col("ready") & F.col("grows"), F.col("o"))).alias("growth"),
    )
    before = [F.col(c).isNull() | (F.col("o") < F.col(c)) for c in ("unready", "elsewhere")]
    within = rows.where("ready").join(bounds, "hub").where(before[0] & before[1] & (F.col("growth").isNull() | (F.col("o") <= F.col("growth"))))
    within = cut(within.select("o", "hub", "leaf", "ids", "joins", "grows"))
    # An edge that both of its ends settle is settled alike; it counts for the end that settles more edges.
    many = within.groupBy("hub").agg(F.count(F.lit(1)).alias("many"))
    one = within.join(many, "hub").groupBy("o").agg(F.max_by(F.struct("hub", "leaf", "ids", "joins", "grows"), F.struct("many", "leaf")).alias("e"))
    one = cut(one.select("o", "e.*"))
    merged = one.where("joins")
    names = cut(merged.groupBy("hub").agg(F.least(F.col("hub"), F.min("leaf")).alias("new")))
    leaves = merged.join(names, "hub").select(F.col("leaf").alias("old"), "new")
    touched = cut(leaves.unionByName(names.select(F.col("hub").alias("old"), "new")))
    grown = merged.where("grows").select("hub", F.col("ids").alias("more"))  # one row for each hub at most
    empty = F.array().cast("array<string>")
    joined = names.join(about.select("hub", "ids"), "hub").join(grown, "hub", "left")
    joined = joined.select(F.col("new").alias("cluster"), F.array_union(F.coalesce("ids", empty), F.coalesce("more", empty)).alias("ids"))
    sets = cut(sets.join(touched.select(F.col("old").alias("cluster")), "cluster", "left_anti").unionByName(joined.where(F.size("ids") > 0)))
    moves = cut(touched.where("old <> new"))
    edges = cut(renamed(edges.join(one.select("o"), "o", "left_anti"), ["a", "b"], moves).where("a <> b"))
    return edges, sets, moves


def constrained_components(evidence: DataFrame, unique_ids: DataFrame, party: str, small: int = SMALL) -> DataFrame:
    """(party, person) of every party of evidence (src, dst, confidence); a person is named by its least party.

    unique_ids: (party, normalized_value). Edges with a null end or confidence don't count; a loop's party does.
    """
    ends = evidence.select(F.col("src").alias("party")).unionByName(evidence.select(F.col("dst").alias("party"))).where("party IS NOT NULL").distinct()
    order = F.struct((-F.col("confidence")).alias("worse"), "src", "dst").alias("o")
    edges = evidence.where("src <> dst AND confidence IS NOT NULL").select(order, F.col("src").alias("a"), F.col("dst").alias("b")).distinct()
    edges = cut(edges)
    ids = unique_ids.where("normalized_value IS NOT NULL").groupBy(F.col(party).alias("cluster"))
    sets = cut(ids.agg(F.sort_array(F.collect_set("normalized_value")).alias("ids")))
    steps: list[DataFrame] = []
    while edges.limit(1).count():
        members = cut(connected_components(edges, "a", "b"))
        placed = cut(edges.join(members.withColumnRenamed("vertex", "a"), "a"))
        named = cut(members.join(sets, members["vertex"] == sets["cluster"]).select("component", "ids"))
        shared = named.select("component", F.explode("ids").alias("id")).groupBy("component", "id").agg(F.count(F.lit(1)).alias("n"))
        kinds = placed.groupBy("component").agg(F.count(F.lit(1)).alias("edges"))
        kinds = kinds.join(named.groupBy("component").agg(F.count(F.lit(1)).alias("named")), "component", "left")
        kinds = kinds.join(shared.groupBy("component").agg(F.max("n").alias("shared")), "component", "left")
        free = (F.coalesce("named", F.lit(0)) <= 1) | (F.col("named") == F.col("shared"))
        kinds = cut(kinds.select("component", "edges", F.when(free, "free").when(F.col("edges") <= small, "small").otherwise("large").alias("kind")))
        n = kinds.where("kind = 'small'").agg(F.sum("edges")).first()[0] or 0
        kinds = kinds.drop("edges")
        placed, members = placed.join(kinds, "component"), members.join(kinds, "component")
        whole = members.where("kind = 'free'").select(F.col("vertex").alias("old"), F.col("component").alias("new"))
        settled = _settled(placed.where("kind = 'small'"), sets, members.where("kind = 'small'").select("component", "vertex"), n // AT_ONCE + 1)
        steps.append(cut(whole.where("old <> new").unionByName(settled)))
        edges = cut(placed.where("kind = 'large'").select("o", "a", "b"))
        for _ in range(ROUNDS):
            if not edges.limit(1).count():
                break
            edges, sets, moves = _round(edges, sets)
            steps.append(moves)
    found = ends.withColumn("person", F.col("party"))
    return renamed(found, ["person"], composed(steps)) if steps else found


def merge_people(
    persons: DataFrame, groups: DataFrame, method: str, lists: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Persons after merging, and a row for each that was retired.

    persons: (person_id, created_at, merged_into, linkage_confidence, ...); groups: (person_id, component, confidence). Of the
    active persons of a component the earliest survives, then the least id; it takes over the values of the list
    columns and the least confidence. Others are left as they are.
    """
    active = persons.where("merged_into IS NULL").join(groups, "person_id")
    named = survivors(active, "component", "person_id", "created_at").where("members > 1").drop("members")
    tied = cut(active.join(named, "component"))
    gathered = [F.sort_array(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in lists]
    least = F.least(F.min("linkage_confidence"), F.min("confidence")).alias("linkage_confidence")
    whole = tied.groupBy(F.col("survivor").alias("person_id")).agg(*gathered, least)
    kept = persons.join(whole.select("person_id", *[F.col(c).alias(f"_{c}") for c in [*lists, "linkage_confidence"]]), "person_id", "left")
    kept = kept.withColumns({c: F.coalesce(f"_{c}", c) for c in [*lists, "linkage_confidence"]})
    retired = tied.where("person_id <> survivor")
    gone = retired.select("person_id", F.col("survivor").alias("_into"))
    after = kept.join(gone, "person_id", "left").withColumn("merged_into", F.coalesce("_into", "merged_into"))
    log = retired.select(F.col("person_id").alias("retired_person_id"), F.col("survivor").alias("surviving_person_id"), F.lit(method).alias("method"), "confidence")
    return after.select(*persons.columns), log


def survivors(members: DataFrame, component: str, id_: str, created: str) -> DataFrame:
    """The member that a component is named by: the earliest, then the least id."""
    return members.groupBy(component).agg(F.min_by(id_, F.struct(created, id_)).alias("survivor"), F.count(F.lit(1)).alias("members"))

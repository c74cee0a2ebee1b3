"""Graph operators: connected components, and the ends of chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.plans.frames import cut, small_side


def renamed(rows: DataFrame, columns: list[str], names: DataFrame) -> DataFrame:
    """rows with the ids in the columns replaced where names (old, new) have another for them."""
    names = small_side(names)
    for c in columns:
        rows = rows.join(names.select(F.col("old").alias(c), F.col("new").alias("_new")), c, "left")
        rows = rows.withColumn(c, F.coalesce("_new", c)).drop("_new")
    return rows


def composed(steps: list[DataFrame]) -> DataFrame:
    """(old, new) of renamings (old, new) done one after another."""
    total = steps[-1]
    for step in reversed(steps[:-1]):
        later = total.join(step.select("old"), "old", "left_anti")
        total = cut(renamed(step.select("old", "new"), ["new"], total).unionByName(later))
    return total


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(vertex, component) for each vertex of an edge; a component is named by its smallest vertex.

    In each round every vertex points to the smallest vertex next to it, pointers are doubled until they stand on
    vertices that point to themselves, and the graph is contracted to those: ends are renamed, loops and
    repeated edges go. What is left of a star, a path or a chain is one vertex, and later rounds
    handle few edges; names are composed at the end. Edges with a null end and
    loops at vertices are dropped, but a loop's vertex is kept as a vertex.
    """
    pairs = edges.select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b")).where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    pairs = cut(pairs.distinct())
    live, steps = pairs.where("a <> b"), []
    while not steps or live.limit(1).count():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("new")).withColumnRenamed("a", "old"))
        moving = True
        while moving:
            further = cut(near.withColumn("was", F.col("new")).transform(renamed, ["new"], near.where("old <> new")))
            moving = further.where("new <> was").limit(1).count() > 0
            near = further.drop("was")
        steps.append(near)
        live = cut(renamed(live, ["a", "b"], near.where("old <> new")).where("a <> b").distinct())
    found = composed(steps).select(F.col("old").alias("vertex"), F.col("new").alias("component"))
    alone = pairs.where("a = b").select(F.col("a").alias("vertex")).join(found, "vertex", "left_anti")
    return found.unionByName(alone.withColumn("component", F.col("vertex")))


def chain_ends(links: DataFrame, id_: str, next_: str) -> DataFrame:
    """(id, end): where each id's chain of links ends; an id without a row, or without a next one, is an end.

    Pointers are doubled: a chain of n links takes about log2(n) rounds. A chain that hasn't ended by then runs in
    a circle, which is an error. An id of several rows is one too.
    """
    rows = cut(links.select(F.col(id_).alias("id"), F.col(next_).alias("end")).where(F.col(id_).isNotNull()).distinct())
    n = rows.count()
    if n != rows.select("id").distinct().count():
        raise ValueError("an id has several rows")
    done = rows.where("end IS NULL").withColumn("end", F.col("id"))
    open_ = rows.where("end IS NOT NULL")
    for _ in range(max(1, n).bit_length() + 1):
        on = open_.select(F.col("id").alias("end"), F.col("end").alias("further"))
        stepped = cut(open_.join(on, "end", "left"))
        done = done.unionByName(stepped.where("further IS NULL").select("id", "end"))
        # A finished row still answers those that point to it, so it stays among the open ones until none does.
        moving = stepped.where("further IS NOT NULL")
        if not moving.limit(1).count():
            return done.distinct()
        if moving.where("id = further").limit(1).count():
            break
        open_ = stepped.select("id", F.coalesce("further", "end").alias("end"))
    raise ValueError("the links run in a circle")

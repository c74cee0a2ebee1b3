"""Mixing sources to target weights by Pareto order sampling.

Targets: each source's weight gives its share of the words to take; no target exceeds `cap` times
its source's size, and what that leaves over is shared again by weight (water filling, in closed
form). Copies: with r = target / source size, each document has floor(r) certain ones. What is left
of the target goes to documents by weight: the inclusion probability is p = min(1, rate * weight),
with the rate at which the expected words are those left, so that what is cut at 1 is shared again;
p = 1 is one more certain copy. The others are ranked by (u / (1 - u)) / (p / (1 - p)) with u a hash
of seed and id, and taken in that order until the words come nearest to what the certain copies leave
of the target: a sample of fixed size, measured in words. Unless a weight is given, it is the number of
binary digits of a document's words: longer documents are repeated, or kept, somewhat more often.

The cut through each source's ranking is found by two histograms of the ranks and an exact order
within one cell of 1 / 2^24 of the ranks, so a source with a third of all rows needs no task of its
own. The result is a threshold for each source: a document's copies follow from its own row.

Defined cases: a given weight counts to the nearest sixteenth of an octave, null as 1, and must be
positive; a null text has no words; a null source is a source, last in order; rows that repeat
an id are ranked alike; an empty table gives an empty result; other columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilspark.plans.frames import cut, read_table, small_side

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a rank, and of each histogram over them.
RANK_BITS, CELL_BITS = 48, 12


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(id_: Column, seed: str = SEED) -> Column:
    """In (0, 1), from 52 bits of a hash."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def length_weight(size: Column) -> Column:
    """The binary digits of a number of words."""
    return F.length(F.bin(size)).cast("double")


def _stepped(weight: Column) -> Column:
    """weight in sixteenths of an octave, so that a source has few different ones."""
    return F.pow(F.lit(2.0), F.round(F.log2(F.coalesce(weight.cast("double"), F.lit(1.0))) * 16) / 16)


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """From (source, source_size), a row for each source: the same with `target`."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sizes.select(
        "source", "source_size", place.alias("place"),
        F.element_at(F.array(*map(F.lit, weights)), F.pmod(place - 1, F.lit(len(weights))) + 1).alias("w"),
        (F.col("source_size") * F.lit(cap)).alias("most"),
        (F.sum("source_size").over(Window.partitionBy()) * F.lit(share)).alias("budget"),
    )
    up = Window.orderBy(F.col("most") / F.col("w"), "place")
    levels = weighed.select(
        "*",
        F.coalesce(F.sum("most").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("full"),
        F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing)).alias("w_left"),
    ).withColumn("level", (F.col("budget") - F.col("full")) / F.col("w_left"))
    fits = F.when(F.col("level") <= F.col("most") / F.col("w"), F.struct(F.col("most") / F.col("w"), "place", "level"))
    level = F.min(fits).over(Window.partitionBy())["level"]
    return levels.select(
        "source", "source_size", F.coalesce(F.least("most", level * F.col("w")), F.col("most")).alias("target")
    )


def _rates(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """goals with `base`, the copies of every document, and `rate`, of inclusion by weight for what they leave."""
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    based = goals.withColumns({"base": F.floor(ratio), "wanted": (ratio - F.floor(ratio)) * F.col("source_size")})
    by_step = rows.where("size > 0").groupBy(F.col("source").alias("_source"), "step").agg(F.sum("size").alias("words"))
    down = Window.partitionBy("source").orderBy(F.desc("step"))
    levels = based.join(by_step, F.col("source").eqNullSafe(F.col("_source"))).select(
        "source", "step", "wanted",
        F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("sure"),
        F.sum(F.col("words") * F.col("step")).over(down.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
    ).withColumn("rate", (F.col("wanted") - F.col("sure")) / F.col("open"))
    fits = levels.where(F.col("rate") * F.col("step") <= 1 + 1e-9).groupBy(F.col("source").alias("_source"))
    rates = fits.agg(F.max(F.struct("step", "rate"))["rate"].alias("rate"))
    found = based.join(rates, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source", "wanted")
    return found.withColumn("rate", F.coalesce("rate", F.lit(0.0)))


def _ranked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows (with source, u, step) and each one's whole copies and rank; plan has base and rate."""
    p = F.col("rate") * F.col("step")
    odds = (F.col("u") / (1 - F.col("u"))) * (1 - p) / p
    place = plan.withColumnRenamed("source", "_source")
    return (
        rows.join(small_side(place), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("whole", F.col("base") + F.when(p >= 1, 1).otherwise(0))
        .withColumn("rank", F.when((p > 1e-12) & (p < 1), F.floor(odds / (1 + odds) * F.lit(float(2**RANK_BITS))).cast("long")))
    )


def _cut_cell(rows: DataFrame, left: DataFrame, bits: int) -> DataFrame:
    """The cell of each source's ranking in which its words reach `left`: source, cell, words still left there."""
    cells = rows.groupBy("source", F.shiftright("rank", bits).alias("cell")).agg(F.sum("size").alias("words"))
    up = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    wants = left.select(F.col("source").alias("_source"), "left")
    return (
        cells.withColumn("upto", F.sum("words").over(up))
        .join(wants, F.col("source").eqNullSafe(F.col("_source")))
        .where("upto - words < left AND left <= upto")
        .groupBy("source").agg(F.min(F.struct("cell", (F.col("left") - F.col("upto") + F.col("words")).alias("left"))).alias("at"))
        .select("source", "at.cell", "at.left")
    )


def plan(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weight: Column | None = None, seed: str = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Each document (id, source, size, u, weight, step: the weight as it counts), and for each source its target and rank threshold."""
    size = words(F.col(text_col))
    rows = cut(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"),
            uniform(F.col(id_col), seed).alias("u"), (length_weight(size) if weight is None else weight).alias("weight"),
            (length_weight(size) if weight is None else _stepped(weight)).alias("step"),
        )
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = cut(_rates(rows, targets(sizes, weights, share, cap)))
    ranked = _ranked(rows, goals)
    certain = ranked.groupBy("source", "target").agg(F.sum(F.col("whole") * F.col("size")).alias("sure"))
    left = certain.select("source", (F.col("target") - F.col("sure")).alias("left"))
    open_rows = ranked.where("rank IS NOT NULL").select("id", "source", "size", "rank")
    first = cut(_cut_cell(open_rows, left, RANK_BITS - CELL_BITS))
    inside = _within(open_rows, first, RANK_BITS - CELL_BITS)
    second = cut(_cut_cell(inside, first, RANK_BITS - 2 * CELL_BITS))
    last = _within(inside, second, RANK_BITS - 2 * CELL_BITS)
    up = Window.partitionBy("source").orderBy("rank", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    wants = second.select(F.col("source").alias("_source"), "left")
    taken = (
        last.withColumn("upto", F.sum("size").over(up))
        .join(small_side(wants), F.col("source").eqNullSafe(F.col("_source")))
        .where("2 * upto - size < 2 * left")
        .groupBy("source").agg(F.max(F.struct("rank", "id", "size")).alias("last"))
    )
    # Sources whose words never reach what is left take every ranked row; those with nothing left take none.
    ends = (
        left.join(second.select(F.col("source").alias("_s2"), "cell"), F.col("source").eqNullSafe(F.col("_s2")), "left")
        .join(taken.select(F.col("source").alias("_s3"), "last"), F.col("source").eqNullSafe(F.col("_s3")), "left")
        .select(
            F.col("source").alias("_source"),
            F.when(F.col("left") <= 0, F.lit(0))
            .when(F.col("cell").isNull(), F.lit(2**RANK_BITS))
            .otherwise(F.coalesce("last.rank", F.shiftleft("cell", RANK_BITS - 2 * CELL_BITS))).cast("long").alias("end_rank"),
            F.col("last.id").alias("end_id"), F.coalesce("last.size", F.lit(-1)).cast("long").alias("end_size"),
        )
    )
    found = goals.join(ends, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    return rows, cut(found)


def _within(rows: DataFrame, cells: DataFrame, bits: int) -> DataFrame:
    only = small_side(cells.select(F.col("source").alias("_source"), "cell"))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.shiftright("rank", bits) == F.col("cell"))
    return rows.join(only, same, "left_semi")


def copies(rows: DataFrame, plan_: DataFrame) -> DataFrame:
    """rows (id, source, size, u, step, ...) with each one's copies, from the thresholds of its source."""
    here, end = F.struct("rank", "id", "size"), F.struct("end_rank", "end_id", "end_size")
    before = (F.col("rank") < F.col("end_rank")) | ((F.col("end_size") >= 0) & (here <= end))
    extra = F.col("rank").isNotNull() & before
    ranked = _ranked(rows, plan_)
    return ranked.withColumn("copies", (F.col("whole") + F.when(extra, 1).otherwise(0)).cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """The mixed documents: each row as often as it is taken, with its columns unchanged."""
    size = words(F.col(text_col))
    _, thresholds = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed)
    carried = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"),
        uniform(F.col(id_col), seed).alias("u"), length_weight(size).alias("step"), F.struct("*").alias("row"),
    )
    taken = copies(carried, thresholds).where("copies > 0")
    each = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return each.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, thresholds = plan(read_table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return copies(rows, thresholds).select(
        F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"),
        (F.col("copies") * F.col("size")).alias("taken"),
    )


ORACLE = rf"""
WITH rows AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE)
           / {2**52}::DOUBLE AS u
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
weighed AS (
  SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
         source_size * 2.0::DOUBLE AS most, sum(source_size) OVER () * 1.5::DOUBLE AS budget
  FROM sizes),
levels AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY most / w, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
goals AS (
  SELECT source, source_size,
         least(most, w * (SELECT coalesce(arg_min(level, most / w), 1e300) FROM levels WHERE level <= most / w)) AS target
  FROM levels),
based AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS base,
         CASE WHEN source_size = 0 THEN 0 ELSE (target / source_size - floor(target / source_size)) * source_size END AS wanted
  FROM goals),
weights AS (
  SELECT source, length(bin(size))::DOUBLE AS weight, sum(size)::DOUBLE AS words FROM rows WHERE size > 0 GROUP BY ALL),
rates AS (
  SELECT weights.source, weight,
         (wanted - coalesce(sum(words) OVER (PARTITION BY weights.source ORDER BY weight DESC
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(words * weight) OVER (PARTITION BY weights.source ORDER BY weight DESC
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM weights JOIN based ON weights.source IS NOT DISTINCT FROM based.source),
rated AS (
  SELECT source, arg_max(rate, weight) AS rate FROM rates WHERE rate * weight <= 1 + 1e-9::DOUBLE GROUP BY source),
chances AS (
  SELECT doc_id, rows.source, size, u, source_size, target, base, coalesce(rate, 0) * length(bin(size))::DOUBLE AS p
  FROM rows JOIN based ON rows.source IS NOT DISTINCT FROM based.source
       LEFT JOIN rated ON rows.source IS NOT DISTINCT FROM rated.source),
copied AS (
  SELECT *, base + CASE WHEN p >= 1 THEN 1 ELSE 0 END AS whole, p > 1e-12 AND p < 1 AS open,
         CASE WHEN p > 1e-12 AND p < 1 THEN (u / (1 - u)) * (1 - p) / p END AS odds
  FROM chances),
summed AS (
  SELECT *, sum(CASE WHEN open THEN size ELSE 0 END) OVER (PARTITION BY source
              ORDER BY floor(odds / (1 + odds) * {2**RANK_BITS}::DOUBLE) NULLS LAST, doc_id, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         target - sum(whole * size) OVER (PARTITION BY source) AS words_left
  FROM copied)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (size * (whole + CASE WHEN open AND 2 * upto - size < 2 * words_left THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""

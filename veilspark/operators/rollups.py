"""Aggregations: summaries, rollups, k-anonymity, precision and recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspark.functions.scalars import percentile_linear, percentile_rank_index

MINIMUM_COHORT = 20


def run_summary(rows: DataFrame, seconds: str, by: list[str] | None = None) -> DataFrame:
    """Count, total, mean, median and both kinds of p90 and p95.

    The rank-index percentiles need the values of a group in order; a group's values are counted
    first, so a list holds distinct values only. Without groups the values are dealt by range, and what
    comes before a range is taken from the ranges' totals.
    """
    by = by or []
    exact = rows.groupBy(*by).agg(
        F.count(seconds).alias("n"), F.round(F.sum(seconds), 6).alias("total"), F.round(F.avg(seconds), 6).alias("mean"),
        F.round(F.median(seconds), 6).alias("median"),
        *[F.round(percentile_linear(seconds, p), 6).alias(f"p{round(100 * p)}_linear") for p in (0.9, 0.95)],
    )
    counts = rows.where(F.col(seconds).isNotNull()).groupBy(*by, F.col(seconds).alias("value")).agg(F.count(F.lit(1)).alias("c"))
    if by:
        upto = counts.withColumn("upto", F.sum("c").over(Window.partitionBy(*by).orderBy("value")))
        upto = upto.withColumn("all", F.sum("c").over(Window.partitionBy(*by)))
    else:
        upto = _upto_by_range(counts)
    n = F.col("all")

    def at(p: float) -> Column:
        place = F.floor((n - 1) * F.lit(p) + F.lit(0.999)) + 1
        return F.col("upto") >= F.least(place, n)

    ranked = upto.select(*by, "value", at(0.9).alias("in90"), at(0.95).alias("in95"))
    ranked = ranked.groupBy(*by).agg(
        F.min(F.when(F.col("in90"), F.col("value"))).alias("p90_rank"), F.min(F.when(F.col("in95"), F.col("value"))).alias("p95_rank")
    )
    if not by:
        return exact.crossJoin(ranked)  # one row each
    on = F.lit(True)
    for c in by:
        on &= exact[c].eqNullSafe(ranked[c])
    return exact.join(ranked, on, "left").select(exact["*"], "p90_rank", "p95_rank")


def _upto_by_range(counts: DataFrame) -> DataFrame:
    """(value, c) with `upto`, the sum of c up to the value, and `all`, the whole sum; no task holds all values."""
    from veilspark.plans.frames import cut

    placed = cut(counts.repartitionByRange("value").withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(F.sum("c").alias("_n"))  # a row for each partition
    totals = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    whole = placed.agg(F.sum("c").alias("all"))
    within = F.sum("c").over(Window.partitionBy("_part").orderBy("value"))
    ranged = placed.join(F.broadcast(totals), "_part").withColumn("upto", F.col("_before") + within)
    return ranged.drop("_part", "_before").crossJoin(F.broadcast(whole))  # whole: one row


def rank_percentile(rows: DataFrame, value: str, p: float, by: str) -> DataFrame:
    """The rank-index percentile of small groups, by a sorted list."""
    values = rows.groupBy(by).agg(F.array_sort(F.collect_list(value)).alias("values"))
    return values.select(by, percentile_rank_index(F.col("values"), p).alias("value"))


def k_anonymity(rows: DataFrame, key: str, attributes: list[str], least_cohort: int = MINIMUM_COHORT) -> DataFrame:
    """Each key's signature of retained attributes, how many keys share it, and whether that is a risk.

    The number of keys is joined back by signature, not by a window, so a common signature is counted
    by partial sums.
    """
    found = F.array_sort(F.array_distinct(F.filter(F.array(*[F.lower(F.trim(c)) for c in attributes]), lambda v: v.isNotNull() & (v != ""))))
    signed = rows.select(key, F.when(F.size(found) > 0, F.sha2(F.array_join(found, "␟"), 256)).alias("signature"))
    counts = signed.where("signature IS NOT NULL").groupBy("signature").agg(F.count(F.lit(1)).alias("matching"))
    cohort = signed.agg(F.count(F.lit(1)).alias("cohort"))
    risk = (
        F.when(F.col("cohort") < least_cohort, "not_evaluated_insufficient_cohort")
        .when(F.col("matching") == 1, "advisory").otherwise("clear")
    )
    return signed.join(counts, "signature", "left").crossJoin(F.broadcast(cohort)).select(  # cohort: one row
        key, "signature", F.coalesce("matching", F.lit(0)).cast("long").alias("matching_count"), risk.alias("status")
    )


def repeat_subjects(edges: DataFrame, subject: str, object_: str, letters: Column) -> DataFrame:
    """For each subject its edges, distinct objects, and whether it returns."""
    out = edges.groupBy(subject).agg(F.sum(letters).cast("long").alias("letter_count"), F.count_distinct(object_).alias("object_count"))
    return out.withColumn("is_repeat", F.col("object_count") >= 2)


def precision_recall(expected: Column, actual: Column) -> list[Column]:
    """Sums of matched, surplus and missing items, and their ratios; an empty denominator counts as 1."""
    tp, fp, fn = F.sum(F.least(expected, actual)), F.sum(F.greatest(actual - expected, F.lit(0))), F.sum(F.greatest(expected - actual, F.lit(0)))
    return [
        tp.cast("long").alias("true_positive"), fp.cast("long").alias("false_positive"), fn.cast("long").alias("false_negative"),
        F.round(F.coalesce(F.try_divide(tp, tp + fp), F.lit(1.0)), 6).alias("precision"),
        F.round(F.coalesce(F.try_divide(tp, tp + fn), F.lit(1.0)), 6).alias("recall"),
    ]


def entity_groups(rows: DataFrame, keys: list[str], alias: str, number: str, verified: str) -> DataFrame:
    """One row per entity: least confidence, whether all is verified, its distinct aliases in order, and how often it occurs."""
    return rows.groupBy(*keys).agg(
        F.min(number).alias("confidence"), F.bool_and(verified).alias("verified"),
        F.sort_array(F.collect_set(alias)).alias("aliases"), F.count(F.lit(1)).alias("occurrence_count"),
    )


def status_rollup(rows: DataFrame, key: str, failed: Column) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("documents"), F.when(F.bool_or(failed), "partial_or_failed").otherwise("completed").alias("status"))


def sections_long(rows: DataFrame, key: str, sections: str) -> DataFrame:
    return rows.select(key, F.inline(sections))


def coverage(rows: DataFrame, kinds: list[str], kind: str, key: str) -> DataFrame:
    """Every kind, also those nobody found, with its count and the number of keys that have it."""
    spark = rows.sparkSession
    all_kinds = spark.createDataFrame([(k,) for k in kinds], f"{kind} string")
    counts = rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("keys"))
    return all_kinds.join(counts, kind, "left").select(
        kind, F.coalesce("n", F.lit(0)).alias("entity_count"), F.coalesce("keys", F.lit(0)).alias("covered_keys"), (F.coalesce("n", F.lit(0)) > 0).alias("covered")
    )


# States of a document that was read, and application counts of a projection.
SUCCESS = ["completed", "json_completed"]
APPLICATIONS = [100, 500, 1000]


def successful(rows: DataFrame, status: str = "status") -> DataFrame:
    return rows.where(F.col(status).isin(SUCCESS))


def public_entities(entities: DataFrame, mentions: DataFrame, document: str, application: str) -> DataFrame:
    """Active entities (entity_id, entity_type, status) with the documents and applications that mention them."""
    seen = mentions.groupBy("entity_id").agg(F.count_distinct(document).alias("document_count"), F.count_distinct(application).alias("application_count"))
    return entities.where("status = 'active'").join(seen, "entity_id", "left").select(
        "entity_id", "entity_type", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("document_count", "application_count")]
    )


def package_counts(rows: DataFrame, status: str) -> DataFrame:
    """One row: how many documents are released, await review, or are withheld."""
    kinds = {"released": "validated_candidate", "review": "review_required", "withheld": "withheld"}
    return rows.agg(*[F.count_if(F.col(status) == k).alias(n) for n, k in kinds.items()], F.count(F.lit(1)).alias("documents"))


def redaction_quality(rows: DataFrame, status: str = "link_status") -> DataFrame:
    return rows.groupBy(status).agg(F.count(F.lit(1)).alias("redactions"))


def wall_hours(rows: DataFrame, key: str, seconds: str, workers: int = 4) -> DataFrame:
    """For each key the hours that APPLICATIONS, and as many as were seen, take 1 to `workers` workers, in a straight line."""
    mean = rows.groupBy(key).agg(F.avg(seconds).alias("_mean"), F.count(seconds).alias("_n"))
    each = mean.select(key, "_mean", F.explode(F.array_union(F.array(*[F.lit(a).cast("long") for a in APPLICATIONS]), F.array("_n"))).alias("applications"))
    each = each.select(key, "_mean", "applications", F.explode(F.sequence(F.lit(1), F.lit(workers))).alias("workers"))
    return each.select(key, "applications", "workers", F.round(F.col("applications") * F.col("_mean") / 3600 / F.col("workers"), 6).alias("projected_hours"))


def compared(first: DataFrame, second: DataFrame, metric: str, value: str) -> DataFrame:
    """Metrics of two runs side by side; which is better is left open."""
    a, b = first.select(metric, F.col(value).alias("first")), second.select(metric, F.col(value).alias("second"))
    return a.join(b, metric, "full_outer")


def seeded_recall(expected: DataFrame, redactions: DataFrame, key: str = "application_id", value: str = "value") -> DataFrame:
    """One row: how many of the expected identifiers (key, value) were redacted under their key, in any case; 1 if none is expected."""
    done = redactions.select(key, F.lower(value).alias("_value")).distinct().withColumn("_hit", F.lit(1))
    met = expected.select(key, F.lower(value).alias("_value")).join(done, [key, "_value"], "left")
    hits = F.count("_hit").alias("hits")
    counted = met.agg(F.count(F.lit(1)).alias("expected_identifier_count"), hits)
    recall = F.when(F.col("expected_identifier_count") > 0, F.col("hits") / F.col("expected_identifier_count")).otherwise(1.0)
    return counted.withColumn("seeded_identifier_recall", recall)

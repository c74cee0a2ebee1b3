"""Stage tables: what is done already is told by fingerprints and left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pending(inputs: DataFrame, state: DataFrame, keys: tuple[str, ...] = ("document_id", "stage_fingerprint")) -> DataFrame:
    """Inputs that no completed row of the state covers under the same fingerprint."""
    done = state.where("status = 'completed'").select(*keys).distinct()
    return inputs.join(done, list(keys), "left_anti")


def retryable(state: DataFrame, stage: Column, status: Column) -> DataFrame:
    """Rows a resume tries again: failed early stages, and withheld privacy results only."""
    return state.where(F.when(stage.isin("canonical", "semantic"), status == "failed").otherwise((stage == "privacy") & (status == "withheld")))


def record_failures(state: DataFrame, failures: DataFrame) -> DataFrame:
    """The state with each failed (document_id, stage, failure_code) counted once more."""
    again = failures.groupBy("document_id", "stage").agg(F.count(F.lit(1)).alias("more"), F.max("failure_code").alias("code"))
    joined = state.join(again, ["document_id", "stage"], "full_outer")
    return joined.select(
        "document_id", "stage", F.when(F.col("more").isNotNull(), "failed").otherwise(F.col("status")).alias("status"),
        (F.coalesce("retry_count", F.lit(0)) + F.coalesce("more", F.lit(0))).cast("int").alias("retry_count"),
        F.coalesce("code", "failure_code").alias("failure_code"),
    )


def upserted(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows, and those of the table they don't replace."""
    return table.join(rows.select(*keys).distinct(), keys, "left_anti").unionByName(rows)


def restamped(state: DataFrame, expected: DataFrame) -> DataFrame:
    """The state of a stage with older artifacts under the fingerprint expected now, where they still serve.

    state: (document_id, stage_fingerprint, extraction_status, failed_pages); expected: (document_id, expected). An
    artifact serves if its text was found and no page failed; nothing is computed again for it.
    """
    serves = (F.col("extraction_status") == "found") & (F.col("failed_pages") == 0) & F.col("expected").isNotNull()
    now = F.when(serves, F.col("expected")).otherwise(F.col("stage_fingerprint"))
    return state.join(expected, "document_id", "left").withColumn("stage_fingerprint", now).drop("expected")


def loaded(documents: DataFrame, canonical: DataFrame, semantic: DataFrame, privacy: DataFrame) -> DataFrame:
    """Every document with what its stages left (document_id each; privacy: release_status too): what lacks a stage is withheld."""
    flags = [t.select("document_id", F.lit(True).alias(n)).distinct() for t, n in ((canonical, "_text"), (semantic, "_meaning"))]
    out = documents
    for t in (*flags, privacy.select("document_id", F.col("release_status").alias("_status"))):
        out = out.join(t, "document_id", "left")
    done = F.coalesce(F.col("_text") & F.col("_meaning"), F.lit(False))
    status = F.when(done, F.coalesce("_status", F.lit("withheld"))).otherwise("withheld")
    reason = F.when(~done, "processing_failed").when(F.col("_status").isNull(), "privacy_not_completed")
    return out.select(*documents.columns, F.when(done, "completed").otherwise("failed").alias("processing_status"), status.alias("release_status"), reason.alias("reason_code"))


def same_run(bound: dict[str, object] | None, current: dict[str, object]) -> dict[str, object]:
    """What an output folder is bound to: an error if another run's roots or namespace wrote it."""
    if bound is not None and bound != current:
        raise ValueError("the output folder belongs to another run: " + ", ".join(sorted(k for k in {*bound, *current} if bound.get(k) != current.get(k))))
    return current

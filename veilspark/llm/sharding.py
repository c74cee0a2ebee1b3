"""Balanced contiguous shards from global byte-size prefix sums.

Rows are range-partitioned and sorted by id; each partition's total gives its offset in the global
order, and a row goes to the shard in which its middle byte lies. `assign` moves (id, size, checksum)
only; `write_shards` takes the rows themselves along, so each is written once whatever its id.

Law `bytes`: every shard's bytes differ from total / shards by less than the largest row. A group of
equal texts is not moved into one shard: shards are contiguous in the order of ids and near equal in
bytes, and a group that holds a third of all rows can't be in one of 24 near equal shards. `text_crc32`
tells which rows may be of one group.

Defined cases: a null text has no bytes; null ids come first; rows with equal ids are ordered by
checksum, size and place of reading; an empty table gives an empty result; the operator takes ids and
texts only, so other columns' names can't clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilspark.plans.frames import cut, read_table

SHARDS = 24
ROW_OVERHEAD = 8


def assign(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", overhead: int = ROW_OVERHEAD, whole: bool = False
) -> DataFrame:
    """One row per document: id, size, text_crc32, shard, slot (its place in the shard, from 0); with `whole` also `row`, all its columns."""
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    slim = docs.select(
        F.col(id_col).alias("id"),
        (F.length(raw) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.monotonically_increasing_id().alias("read_at"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole else []),
    )
    keys = ["id", "text_crc32", "size", "read_at"]
    # The id of a row in its sorted partition is fixed by the checkpoint: partition number and place.
    placed = cut(
        slim.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("read_at")
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("place", 33))
    )
    # A row for each partition: their number is the session's number of shuffle partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
    everything = Window.partitionBy()
    totals = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    carried = ["id", "size", "text_crc32", *(["row"] if whole else [])]
    ranked = placed.join(F.broadcast(totals), "part").select(
        *carried, "all_bytes",
        (F.col("bytes_before") + F.sum("size").over(inside) - F.col("size")).alias("start"),
        (F.col("rows_before") + F.row_number().over(Window.partitionBy("part").orderBy("place")) - 1).alias("rank"),
    )
    middle = F.expr("CAST(2 * start + size AS DECIMAL(38, 0))")
    ranked = ranked.withColumn(
        "shard",
        F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards) / F.expr("CAST(2 * all_bytes AS DECIMAL(20, 0))")))
        .cast("int"),
    )
    first = ranked.groupBy("shard").agg(F.min("rank").alias("first"))  # at most `shards` rows
    return ranked.join(F.broadcast(first), "shard").select(
        *carried, "shard", (F.col("rank") - F.col("first")).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the documents, with all their columns, as one folder per shard, in slot order.

    `shard` and `slot` are added; a table that has columns of these names is refused.
    """
    if {"shard", "slot"} & set(docs.columns):
        raise ValueError("shard and slot are names of columns made here")
    placed = assign(docs, shards, id_col, text_col, whole=True).select("row.*", "shard", "slot")
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return assign(docs).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

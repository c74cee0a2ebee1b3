"""Small helpers shared by every job: reading tables, cutting lineage, guarded broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join may be broadcast up to this many rows; beyond it the join shuffles.
BROADCAST_ROWS = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One Parquet table of a data folder, by any path Spark can read."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset, a temporary one on this machine; on a cluster, an error."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not (context.master or "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-checkpoint-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read from a table in the shared folder: computed once, and safe when an executor is lost.

    Unlike a checkpointed plan, a table brings no estimates and constraints of what made it; in loops
    those multiply from round to round until planning takes longer than running.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it is shown to hold at most `rows` rows, else unchanged.

    The caller passes an already materialised frame, so the count is cheap.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

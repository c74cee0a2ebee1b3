"""Streaming ingest of documents into stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from veilspark.operators.backends import Backend
from veilspark.operators.gate import gate


def stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def gated(docs: DataFrame, out: str, checkpoint: str, backend: Backend | None = None) -> StreamingQuery:
    """Every new document goes through the gate and is appended; a batch is written once.

    Without a backend that scans for names, no document is validated. A batch that is run again overwrites its own folder, so restarts don't repeat rows. Stop when all
    that is there has been read.
    """

    def write(batch: DataFrame, number: int) -> None:
        gate(batch, backend=backend).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Answers that arrive as files: each batch holds whole pages, so the batch plans apply to it as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from veilframe.operators.decode import findings
from veilframe.plans.pages import analyse
from veilframe.sources.config import Settings


def stream_findings(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str) -> StreamingQuery:
    """Findings of Parquet answers that arrive in source, appended to target. A batch that is repeated overwrites its own part."""

    def write(batch: DataFrame, number: int) -> None:
        findings(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_regions(spark: SparkSession, source: str, schema: str, tight: str, wide: str, target: str, checkpoint: str, settings: Settings | None = None) -> StreamingQuery:
    """Regions of Parquet answers that arrive in source, with the OCR boxes that lie in tight and wide when a batch is read."""

    def write(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        analyse(batch, own.read.parquet(tight), own.read.parquet(wide), settings).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""The steps that look at one row at a time, over manifests as they arrive; barriers run per batch.

The batch engine that this follows has no streaming: this is an extension.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..config import Settings
from ..operators.rate import with_rate


def arriving(spark: SparkSession, path: str, schema: StructType | str, kind: str = "json") -> DataFrame:
    return spark.readStream.schema(schema).format(kind).load(path)


def rates(stream: DataFrame, s: Settings) -> DataFrame:
    """Rate metrics of utterances with their characters: stateless, so the batch expressions serve as they are."""
    return with_rate(stream, "chars", "duration", s)


def reasons_by_window(stream: DataFrame, time: str, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Reject reasons counted per window of event time; rows later than the watermark are dropped by it."""
    rows = stream.withWatermark(time, late).select(time, F.explode("reject_reasons").alias("reject_reason"))
    return rows.groupBy(F.window(time, width), "reject_reason").agg(F.count("*").alias("count"))


def per_batch(stream: DataFrame, checkpoint: str, path: str, steps: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Each micro-batch through steps with barriers, written under its number: a batch that runs again replaces itself."""

    def write(df: DataFrame, number: int) -> None:
        steps(df).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).start()

"""Assign a stream of specimens against a frozen consensus table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.assign import assign


def stream_specimens(spark: SparkSession, folder: str, schema: StructType, kind: str = "parquet", max_files: int = 100) -> DataFrame:
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", max_files).load(folder)


def assign_stream(stream: DataFrame, consensus: DataFrame, sink: str, checkpoint: str, **settings) -> StreamingQuery:
    """Each micro-batch runs the batch operator and is written under its number,
    so a batch that is repeated after a failure replaces itself."""

    def batch(df: DataFrame, number: int) -> None:
        assign(df, consensus, **settings).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Stages over streams of batch records: what needs no other row, and first occurrences under a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.operators.parse_errors import judge_raw
from corundum.schema import BATCH


def stream_batches(spark: SparkSession, directory: str, schema=BATCH, files: int = 100) -> DataFrame:  # noqa: ANN001
    """New batch files of a directory as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(directory)


def stream_first(df: DataFrame, key: str, time: str, lateness: str = "1 day") -> DataFrame:
    """The first record of each key within the watermark; null keys are left out. State is dropped as the watermark passes."""
    return df.filter(F.col(key).isNotNull()).withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])


def stream_status_counts(df: DataFrame, status: str, time: str, window: str = "1 day", lateness: str = "1 day") -> DataFrame:
    """Rows by status and window of time, each window once it is complete."""
    return df.withWatermark(time, lateness).groupBy(F.window(time, window), status).agg(F.count(F.lit(1)).alias("rows"))


def stream_judged(raw: DataFrame) -> DataFrame:
    """Delivered lines, typed, with the reasons for failure: the batch operator needs no other row, so it streams as it is."""
    return judge_raw(raw)

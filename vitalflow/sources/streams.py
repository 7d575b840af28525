"""Streaming readers of sensor records: the message log where its package is present, else files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalflow import schemas as S


def read_topic(
    spark: SparkSession,
    brokers: str,
    topics: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
    min_offsets: int | None = None,
    max_delay: str | None = None,
) -> DataFrame:
    """Topic source with the binary value and its partition and offset."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topics)
        .option("startingOffsets", starting)
    )
    limits = {
        "maxOffsetsPerTrigger": max_offsets,
        "minOffsetsPerTrigger": min_offsets,
        "maxTriggerDelay": max_delay,
    }
    for name, value in limits.items():
        if value is not None:
            reader = reader.option(name, value)
    return reader.load().select("value", "partition", "offset")


def write_topic(encoded: DataFrame, brokers: str, topic: str) -> None:
    """Publish rows (key, value), as `encode_sensor_values` gives them."""
    encoded.select("key", "value").write.format("kafka").option(
        "kafka.bootstrap.servers", brokers
    ).option("topic", topic).save()


def count_or_time_trigger(
    records: int = S.BATCH_RECORDS, seconds: int = S.BATCH_SECONDS
) -> dict[str, int | str]:
    """`read_topic` arguments that close a micro-batch at `records` rows or after `seconds`."""
    return {"max_offsets": records, "min_offsets": records, "max_delay": f"{seconds}s"}


def read_stream_earliest(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Files at `path` (a folder or a glob), from the first one on, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_stream_latest_bounded(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    started_ms: int,
    files_per_batch: int = 1,
    there: Sequence[str] = (),
) -> DataFrame:
    """A second reader that sees only files that arrive after it was started, a few per batch.

    Stores may keep times to the second only: `there` names the files that were there at the start
    with just that time, and all others of that time are read. Its progress is its own: give the
    query its own checkpoint folder.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    arrived = F.unix_millis(F.col("_metadata.file_modification_time"))
    fresh = reader.parquet(path).filter(arrived >= started_ms)
    return fresh.filter(~F.col("_metadata.file_path").isin(*there)) if there else fresh

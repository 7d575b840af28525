"""The streaming jobs: window averages, scoring and points; fallback batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitalflow import schemas as S
from vitalflow.functions import scalars as fn
from vitalflow.models.scoring import Model, with_default
from vitalflow.operators.aggregates import batch_average, window_average
from vitalflow.session import KEYED_STATE, session_settings
from vitalflow.sources.points import fallback_points, primary_points, write_points
from vitalflow.streaming.stateful import collect_batches


def assign_event_time(
    df: DataFrame, text: str = "datetime", now: Column | None = None
) -> DataFrame:
    """Add `ts`, the event time in the record's text."""
    return df.withColumn("ts", fn.parse_event_time(text, now))


def bounded_watermark(df: DataFrame, delay: str = S.ALLOWED_DELAY) -> DataFrame:
    return df.withWatermark("ts", delay)


def tumbling_average_stream(records: DataFrame, delay: str = S.ALLOWED_DELAY) -> DataFrame:
    """One row per person and window, when the watermark passes the window's end."""
    return window_average(bounded_watermark(assign_event_time(records), delay))


def score_stream(averages: DataFrame, model: Model) -> DataFrame:
    """Class of each window average, inside the stream's own plan."""
    return model.score(averages, "stress_level")


def start_files(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None, keyed: bool = False
) -> StreamingQuery:
    """Write a stream to Parquet, all data that is there now. Streams with keyed state (`stateful`)
    are `keyed`: they get the state store that it needs, whatever the session's."""
    writer = df.writeStream.format("parquet").option("path", path)
    if name:
        writer = writer.queryName(name)
    with session_settings(df.sparkSession, **(KEYED_STATE if keyed else {})):
        return (
            writer.option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start()
        )


def start_batches(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    keyed: bool = False,
) -> StreamingQuery:
    """Hand each micro-batch to `handle`; progress is committed after it returns. `keyed` is as in
    `start_files`."""
    with session_settings(df.sparkSession, **(KEYED_STATE if keyed else {})):
        return (
            df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start()
        )


def start_primary(
    records: DataFrame, model: Model, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Records to scored window points."""
    scored = score_stream(tumbling_average_stream(records), model)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_points(primary_points(batch), path, batch_id, S.PRIMARY)

    return start_batches(scored, write, checkpoint, trigger)


def fallback_batch(
    records: DataFrame, model: Model, batch: tuple[str, ...] = ("batch",), now: Column | None = None
) -> DataFrame:
    """Points of one or more collected batches: skip-missing means, scored, with a default."""
    averaged = batch_average(records, batch)
    return fallback_points(with_default(model.score(averaged, "stress_level")), now=now)


def start_fallback(
    records: DataFrame,
    model: Model,
    path: str,
    checkpoint: str,
    batch: Column | None = None,
    trigger: dict | None = None,
    open_path: str | None = None,
) -> StreamingQuery:
    """Records to scored batch points.

    Live, each micro-batch is one batch (see `count_or_time_trigger`). For replays, `batch`
    numbers the batches, which may end inside a micro-batch: the records of the highest number
    seen are then kept in `open_path` until a higher one arrives, so that every batch is averaged
    once and whole. Numbers must not go down from one micro-batch to the next. The last batch is
    written by `finish_fallback`.
    """
    if batch is not None and open_path is None:
        raise ValueError("numbered batches need a folder for the records of the open one")

    def write(rows: DataFrame, batch_id: int) -> None:
        if batch is None:
            write_points(fallback_batch(rows.withColumn("batch", F.lit(0)), model), path, batch_id, S.FALLBACK)
            return
        spark = rows.sparkSession
        numbered = rows.withColumn("batch", batch)
        if batch_id > 0:
            kept = spark.read.schema(numbered.schema).parquet(f"{open_path}/{batch_id - 1}")
            numbered = numbered.unionByName(kept)
        highest = numbered.agg(F.max("batch")).scalar()
        still_open = numbered.filter(F.col("batch") == highest)
        still_open.write.mode("overwrite").parquet(f"{open_path}/{batch_id}")
        closed = numbered.filter(F.col("batch") < highest)
        write_points(fallback_batch(closed, model), path, batch_id, S.FALLBACK)

    return start_batches(records, write, checkpoint, trigger)


def finish_fallback(spark: SparkSession, model: Model, path: str, open_path: str, last: int) -> None:
    """Write the batch that was open after micro-batch `last`, when no records will follow."""
    rows = spark.read.parquet(f"{open_path}/{last}")
    write_points(fallback_batch(rows, model), path, last + 1, S.FALLBACK)


def start_collected_fallback(
    records: DataFrame,
    model: Model,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    trigger: dict | None = None,
    **limits,
) -> StreamingQuery:
    """Records to scored points of live batches, which close by count or time (`collect_batches`).

    A batch is whole in the micro-batch that closes it, so it is averaged once.
    """
    collected = collect_batches(records, keys, order, **limits)

    def write(rows: DataFrame, batch_id: int) -> None:
        points = fallback_batch(rows, model, (*keys, "batch"))
        write_points(points, path, batch_id, S.FALLBACK)

    return start_batches(collected, write, checkpoint, trigger, keyed=True)

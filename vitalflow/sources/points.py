"""The points table: time-series rows, partitioned by measurement and day.

Writers only append; a rewrite of the same identity is resolved when read (`upsert_points`). Every
attempt to write a batch marks its rows, and the attempt that came through is noted in the table's
list of batches; rows of other attempts are never read. So a batch that is written again replaces
itself, wherever its rows fall, and the number of folders does not grow with that of batches.
`compact_points` rewrites days that are over into one row per identity and few files.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalflow import schemas as S
from vitalflow.functions import scalars as fn
from vitalflow.operators.filters import Moment, epoch_ms, time_range
from vitalflow.operators.ordered import top_per_key
from vitalflow.session import staged

IDENTITY = ("measurement", "id", "source", "time_ms")
FOLDERS = ("measurement", "date")
#: The list of batches lies beside the folders; Spark passes over names with an underscore.
BATCHES = "_batches"

TABLE = T.StructType(
    [f for f in S.POINT.fields if f.name not in FOLDERS]
    + [
        T.StructField("measurement", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("writer", T.StringType()),
        T.StructField("attempt", T.StringType()),
    ]
)
_LISTED = "writer string, batch_id long, attempt string, written_us long"


def primary_points(scored: DataFrame, measurement: str = S.POINT_MEASUREMENT) -> DataFrame:
    """Scored window averages as points."""
    return _points(scored, measurement, S.PRIMARY, F.col("datetime"))


def fallback_points(
    scored: DataFrame, measurement: str = S.POINT_MEASUREMENT, now: Column | None = None
) -> DataFrame:
    """Scored batch averages as points; the time is the latest text, cut to the second."""
    time = fn.parse_event_time_seconds("datetime", now)
    return _points(scored, measurement, S.FALLBACK, time)


def _points(scored: DataFrame, measurement: str, source: str, time_ms: Column) -> DataFrame:
    return scored.select(
        F.lit(measurement).alias("measurement"),
        "id",
        F.lit(source).alias("source"),
        time_ms.cast("bigint").alias("time_ms"),
        *[F.col(c).cast("double").alias(c) for c in S.SENSORS],
        F.col("stress_level").cast("int").alias("stress_level"),
    )


def write_points(points: DataFrame, path: str, batch_id: int = 0, writer: str = "") -> None:
    """Append one batch of a writer. Repeating a batch replaces it, so a retry leaves no copies.

    Rows are rebalanced by folder, which keeps files large and splits a folder that holds most
    of the rows. The batch counts from when it is listed, which is one small write at the end.
    """
    attempt = uuid.uuid4().hex
    rows = points.withColumns(
        {
            "date": _day(F.col("time_ms")),
            "batch_id": F.lit(batch_id).cast("bigint"),
            "writer": F.lit(writer),
            "attempt": F.lit(attempt),
        }
    )
    rows.hint("rebalance", *[F.col(c) for c in FOLDERS]).write.mode("append").partitionBy(
        *FOLDERS
    ).parquet(path)
    listed = [(writer, batch_id, attempt, time.time_ns() // 1_000)]
    spark = points.sparkSession
    spark.createDataFrame(listed, _LISTED).coalesce(1).write.mode("append").parquet(f"{path}/{BATCHES}")


def _day(time_ms: Column) -> Column:
    return F.date_from_unix_date(F.floor(time_ms / 86_400_000).cast("int"))


def _counting(spark: SparkSession, path: str) -> DataFrame:
    """All columns of the rows whose attempt is the last one listed for their batch."""
    listed = spark.read.schema(_LISTED).parquet(f"{path}/{BATCHES}")
    newest = listed.groupBy("writer", "batch_id").agg(F.max_by("attempt", "written_us").alias("_counts"))
    rows = spark.read.schema(TABLE).parquet(path).join(newest, ["writer", "batch_id"])
    return rows.filter(F.col("attempt") == F.col("_counts")).select(*TABLE.names)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Points of the attempts that count, with `batch_id` and `date`."""
    return _counting(spark, path).drop("writer", "attempt")


def compact_points(spark: SparkSession, path: str, before_ms: int) -> None:
    """Rewrite the days that end by `before_ms`: the row that counts of each identity, in few files.

    Rows keep the batch and attempt that they came from, so a batch that is written once more
    afterwards still replaces its rows. They are first written to the shared folder, then each
    day's folder is replaced. Days that a broken run did not reach stay as they were; running it
    again is safe. No batch may be written to these days meanwhile.
    """
    end = F.date_from_unix_date(F.lit(before_ms // 86_400_000).cast("int"))
    closed = upsert_points(_counting(spark, path).filter(F.col("date") < end))
    rows = staged(closed, "compacted")
    rows.hint("rebalance", *[F.col(c) for c in FOLDERS]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*FOLDERS).parquet(path)


def scan_points(
    spark: SparkSession,
    path: str,
    measurement: str,
    lookback_ms: int | None = None,
    as_of: Moment = None,
) -> DataFrame:
    """Points of a measurement, optionally of a time range; only matching folders are read."""
    points = read_points(spark, path).filter(F.col("measurement") == measurement)
    if lookback_ms is None:
        return points
    end = epoch_ms(as_of)
    return time_range(points, end - F.lit(lookback_ms).cast("bigint"), end)


def upsert_points(points: DataFrame) -> DataFrame:
    """Keep the row of the latest batch for each identity; inside a batch, the one with the highest
    class, then the highest readings."""
    fields = ["batch_id", "stress_level", *S.SENSORS]
    return top_per_key(points, list(IDENTITY), [F.col(c).desc() for c in fields], 1)


def to_line_protocol(scored: DataFrame, measurement: str = S.LINE_MEASUREMENT) -> DataFrame:
    """One text line per scored window: tag id, four fields with six decimals, nanoseconds."""
    line = F.format_string(
        f"{measurement},id=%s EDA=%f,HR=%f,TEMP=%f,stressLevel=%d %d",
        F.col("id"),
        F.col("EDA"),
        F.col("HR"),
        F.col("TEMP"),
        F.col("stress_level"),
        fn.to_epoch_nanos("datetime"),
    )
    return scored.select(line.alias("line"))


def write_lines(scored: DataFrame, path: str, measurement: str = S.LINE_MEASUREMENT) -> None:
    to_line_protocol(scored, measurement).withColumnRenamed("line", "value").write.mode(
        "append"
    ).text(path)


def send_lines(
    scored: DataFrame,
    send: Callable[[str], int],
    measurement: str = S.LINE_MEASUREMENT,
    lines_per_call: int = 5_000,
) -> DataFrame:
    """Hand the lines to `send`, which returns a status code, from every partition.

    The result has one row per call: lines sent, status, and whether it failed (400 and above).
    A failure does not stop the others. `send` must bear repeats, as a lost task runs again; a
    store that keeps one point per identity does.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first in range(0, len(frame), lines_per_call):
                group = frame["line"].iloc[first : first + lines_per_call]
                status = send("\n".join(group))
                yield pd.DataFrame(
                    {"lines": [len(group)], "status": [status], "failed": [status >= 400]}
                )

    return to_line_protocol(scored, measurement).mapInPandas(
        run, "lines long, status int, failed boolean"
    )

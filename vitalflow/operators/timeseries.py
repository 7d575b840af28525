"""Time-bucket queries on the points table.

`as_of`, the range and the bucket width are plain arguments. Buckets are aligned to the epoch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalflow import schemas as S
from vitalflow.operators.filters import Moment, epoch_ms, filter_source, time_range

MINUTE_MS = 60_000
#: Buckets of a gap are laid out in steps of so many, so that no array grows with the range.
GAP_STEP = 1_024


def auto_interval(range_ms: int, max_points: int = 5) -> int:
    """Bucket width that gives about `max_points` buckets over the range, in ms."""
    return max(1, range_ms // max_points)


def bucket_start(time_ms: str | Column, step_ms: int) -> Column:
    c = F.col(time_ms) if isinstance(time_ms, str) else time_ms
    return c - F.pmod(c, F.lit(step_ms).cast("bigint"))


def last_value(field: str) -> Column:
    """Newest non-null value; between points of the same time the fallback one counts.

    Time and tie-break share one number, so the aggregate keeps fixed-width state.
    """
    order = F.col("time_ms") * 2 + F.when(F.col("source") == S.FALLBACK, 1).otherwise(0)
    return F.max_by(field, F.when(F.col(field).isNotNull(), order))


def by_bucket(
    points: DataFrame,
    value: Column,
    series: Sequence[str],
    range_ms: int,
    step_ms: int,
    as_of: Moment = None,
    fill: str | int | None = "null",
) -> DataFrame:
    """Aggregate `value` per series and bucket over the range ending at `as_of`.

    `fill` is "null" (every bucket, null where empty), a number (every bucket, that number
    where empty) or None (only buckets with points).
    """
    end = epoch_ms(as_of)
    start = end - F.lit(range_ms).cast("bigint")
    grouped = time_range(points, start, end).groupBy(
        *series, bucket_start("time_ms", step_ms).alias("bucket_ms")
    )
    found = grouped.agg(value.alias("value"))
    if fill is None:
        return found
    return fill_buckets(found, series, range_ms, step_ms, as_of, None if fill == "null" else fill)


def fill_buckets(
    found: DataFrame,
    series: Sequence[str],
    range_ms: int,
    step_ms: int,
    as_of: Moment = None,
    fill: int | float | None = None,
) -> DataFrame:
    """Emit every bucket of the range for each series that has one.

    Each row also emits the empty buckets up to the next row of its series, and the first row
    those before it. That needs the aggregated rows once and no join. A gap of any length is cut
    into stretches, and those into buckets, as many times as the range needs.
    """
    end, step = epoch_ms(as_of), F.lit(step_ms).cast("bigint")
    first = bucket_start(end - F.lit(range_ms).cast("bigint"), step_ms)
    last = bucket_start(end, step_ms)
    along = Window.partitionBy(*series).orderBy("bucket_ms")
    placed = found.withColumns(
        {
            "_from": F.when(F.row_number().over(along) == 1, first).otherwise(F.col("bucket_ms")),
            "_until": F.coalesce(F.lead("bucket_ms").over(along) - step, last),
        }
    )
    width, spread = step_ms, placed
    while range_ms // width >= GAP_STEP:
        width *= GAP_STEP
    while width > step_ms:
        wide = F.lit(width).cast("bigint")
        spread = spread.withColumn("_from", F.explode(F.sequence("_from", "_until", wide)))
        spread = spread.withColumn("_until", F.least("_until", F.col("_from") + wide - step))
        width //= GAP_STEP
    spread = spread.withColumn("_at", F.explode(F.sequence("_from", "_until", step)))
    empty = F.lit(fill).cast(found.schema["value"].dataType)
    value = F.when(F.col("_at") == F.col("bucket_ms"), F.col("value")).otherwise(empty)
    if fill is not None:
        value = F.coalesce(value, empty)
    return spread.select(*series, F.col("_at").alias("bucket_ms"), value.alias("value"))


def last_by_bucket(
    points: DataFrame,
    field: str,
    range_ms: int = 300_000,
    step_ms: int | None = None,
    as_of: Moment = None,
) -> DataFrame:
    """Newest value per person and bucket; the width follows from the range."""
    step = step_ms or auto_interval(range_ms)
    return by_bucket(points, last_value(field), ["id"], range_ms, step, as_of)


def mean_by_bucket(
    points: DataFrame,
    field: str,
    series: Sequence[str],
    range_ms: int = 900_000,
    step_ms: int = MINUTE_MS,
    as_of: Moment = None,
    fill: str | int | None = "null",
) -> DataFrame:
    return by_bucket(points, F.avg(field), series, range_ms, step_ms, as_of, fill)


def count_by_bucket(
    points: DataFrame,
    field: str = "stress_level",
    series: Sequence[str] = ("source",),
    range_ms: int = 900_000,
    step_ms: int = MINUTE_MS,
    as_of: Moment = None,
    fill: str | int | None = 0,
) -> DataFrame:
    return by_bucket(points, F.count(field), series, range_ms, step_ms, as_of, fill)


def mean_by_id_source(
    points: DataFrame,
    field: str = "stress_level",
    sources: Sequence[str] = (S.PRIMARY, S.FALLBACK),
    step_ms: int = MINUTE_MS,
) -> DataFrame:
    """Mean per bucket, person and source over all time, only buckets with points."""
    grouped = filter_source(points, *sources).groupBy(
        "id", "source", bucket_start("time_ms", step_ms).alias("bucket_ms")
    )
    return grouped.agg(F.avg(field).alias("value"))

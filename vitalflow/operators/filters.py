"""Projections, filters and limits on readings, points and requests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalflow import schemas as S
from vitalflow.functions import scalars as fn

Moment = int | datetime | Column | None


def project_sensor_columns(df: DataFrame) -> DataFrame:
    return df.select(*S.RECORD_COLUMNS)


def filter_by_id(df: DataFrame, person: str) -> DataFrame:
    return df.filter(F.col("id") == person)


def drop_incomplete(df: DataFrame, columns: Sequence[str] = (*S.FEATURES, "label")) -> DataFrame:
    return df.dropna(subset=list(columns))


def split_rejects(df: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Rows that can be grouped by `key`, and the rows without one."""
    return df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())


def epoch_ms(moment: Moment) -> Column:
    """Epoch milliseconds of a moment: a number, a datetime, a column, or now."""
    if moment is None:
        return F.unix_millis(F.current_timestamp())
    if isinstance(moment, datetime):
        aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
        return F.lit(int(aware.timestamp() * 1000)).cast("bigint")
    if isinstance(moment, int):
        return F.lit(moment).cast("bigint")
    return moment.cast("bigint")


def time_range(
    points: DataFrame, start_ms: Column, end_ms: Column | None = None, closed: bool = True
) -> DataFrame:
    """Points from `start_ms` (included if `closed`) to `end_ms`.

    A table partitioned by date also gets the bound on `date`, so old folders are not read.
    """
    time = F.col("time_ms")
    keep = (time >= start_ms) if closed else (time > start_ms)
    if end_ms is not None:
        keep &= time <= end_ms
    if "date" in points.columns:
        keep &= F.col("date") >= _day(start_ms)
        if end_ms is not None:
            keep &= F.col("date") <= _day(end_ms)
    return points.filter(keep)


def _day(ms: Column) -> Column:
    return F.date_from_unix_date(F.floor(ms / F.lit(86_400_000)).cast("int"))


def recent_range(points: DataFrame, lookback_ms: int, as_of: Moment = None) -> DataFrame:
    """Points younger than `lookback_ms` at `as_of`."""
    return time_range(points, epoch_ms(as_of) - F.lit(lookback_ms), closed=False)


def filter_source(points: DataFrame, *sources: str) -> DataFrame:
    return points.filter(F.col("source").isin(*sources))


def latest_points(
    points: DataFrame,
    source: str,
    n: int = 3,
    columns: Sequence[str] = ("id", "HR", "TEMP", "stress_level", "source"),
) -> DataFrame:
    """Newest `n` points of a source."""
    return (
        filter_source(points, source)
        .select("time_ms", *columns)
        .orderBy(F.col("time_ms").desc(), F.col("id"))
        .limit(n)
    )


def sample_points(points: DataFrame, n: int = 10) -> DataFrame:
    """First `n` points in time order, all columns."""
    return points.orderBy("time_ms", "id", "source").limit(n)


def select_by_id_grouped(points: DataFrame, person: str) -> DataFrame:
    """All points of one person, one series per source."""
    return filter_by_id(points, person).orderBy("source", "time_ms")


def validate_inputs(requests: DataFrame) -> DataFrame:
    """Add the parsed parameters, the model key and the `error` of each score request.

    Parameters arrive as text columns x, y, z, eda, hr, temp and model.
    """
    names = [c.lower() for c in S.SENSORS]
    return requests.select(
        *[c for c in requests.columns if c not in (*names, "model")],
        *[fn.request_number(c).alias(c) for c in names],
        fn.model_key("model").alias("model"),
        fn.request_error({c: F.col(c) for c in names}, F.col("model")).alias("error"),
    )

"""Averages, counts and summaries of readings and points.

All of them are declarative aggregates, so Spark combines rows before the shuffle and one
person or source with most of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalflow import schemas as S
from vitalflow.functions import scalars as fn
from vitalflow.operators.filters import Moment, filter_source, recent_range, split_rejects
from vitalflow.operators.windows import latest_per_id


def window_average(df: DataFrame, ts: str = "ts", width: str = S.WINDOW) -> DataFrame:
    """Average per person and tumbling window; a missing reading counts as 0.

    The same plan serves tables and streams (the stream needs a watermark on `ts`).
    """
    valid, _ = split_rejects(df)
    rows = F.count(F.lit(1))
    averaged = valid.groupBy("id", F.window(ts, width)).agg(
        *[(F.sum(fn.null_as_zero(c)) / rows).cast("float").alias(c) for c in S.SENSORS]
    )
    return averaged.select("id", *S.SENSORS, *window_metadata())


def window_metadata() -> list[Column]:
    """Last millisecond, start and end of the window, epoch ms."""
    start, end = F.unix_millis("window.start"), F.unix_millis("window.end")
    return [
        (end - F.lit(1)).alias("datetime"),
        start.alias("windowStart"),
        end.alias("windowEnd"),
    ]


def batch_average(df: DataFrame, batch: Sequence[str] = ("batch",)) -> DataFrame:
    """Average per micro-batch and person over the readings present, with the latest time text."""
    valid, _ = split_rejects(df)
    return valid.groupBy(*batch, "id").agg(
        *[F.avg(fn.nan_as_null(c)).alias(c) for c in S.SENSORS],
        F.max("datetime").alias("datetime"),
    )


def count_points(
    points: DataFrame,
    fields: Sequence[str] = (*S.SENSORS, "stress_level"),
    by: Sequence[str] = (),
) -> DataFrame:
    """Non-null values of each field, overall or per tag."""
    return points.groupBy(*by).agg(*[F.count(c).alias(f"count_{c}") for c in fields])


def count_by_source(points: DataFrame, field: str = "stress_level") -> DataFrame:
    return points.groupBy("source").agg(F.count(field).alias("n"))


def fallback_activity(
    points: DataFrame, as_of: Moment = None, lookback_ms: int = 300_000
) -> DataFrame:
    """Recent fallback points, the panel text for that count, and whether to alert."""
    recent = recent_range(filter_source(points, S.FALLBACK), lookback_ms, as_of)
    counted = recent.agg(F.count("stress_level").alias("n"))
    return counted.select(
        "n", fn.fallback_status("n").alias("status"), (F.col("n") > 0).alias("alert")
    )


def value_counts(df: DataFrame, column: str = "id") -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column)
    return counted.agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), column)


def describe_series(
    points: DataFrame,
    tags: Sequence[str] = ("id", "source"),
    fields: Sequence[str] = (*S.SENSORS, "stress_level"),
) -> DataFrame:
    """Tag and field keys that hold data, with type, values present and distinct tag values.

    Counted per series first, so the distinct counts see a row per series only.
    """
    types = dict(points.dtypes)
    series = points.groupBy(*tags).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"n_{c}") for c in fields]
    )
    counts = series.agg(
        *[F.sum(F.when(F.col(c).isNotNull(), F.col("_n")).otherwise(0)).alias(f"n_{c}") for c in tags],
        *[F.sum(f"n_{c}").alias(f"n_{c}") for c in fields],
        *[F.count_distinct(c).alias(f"d_{c}") for c in tags],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("key"),
                F.lit("tag" if c in tags else "field").alias("kind"),
                F.lit(types[c]).alias("type"),
                F.col(f"n_{c}").alias("n_values"),
                (F.col(f"d_{c}") if c in tags else F.lit(None).cast("bigint")).alias("n_distinct"),
            )
            for c in (*tags, *fields)
        ]
    )
    return counts.select(F.inline(rows)).filter(F.col("n_values") > 0)


def class_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Add balanced weights rows / (classes * rows of the class).

    The joined side has one row per class in `CLASSES`, which is what allows the broadcast.
    """
    known = df.filter(F.col(label).isin(*S.CLASSES))
    return df.join(F.broadcast(weight_table(known, label, out)), label, "left")


def weight_table(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    counts = df.filter(F.col(label).isin(*S.CLASSES)).groupBy(label)
    one_row = counts.agg(F.count(F.lit(1)).alias("n")).agg(
        F.collect_list(F.struct(label, "n")).alias("classes"), F.sum("n").alias("total")
    )
    return one_row.select(
        F.explode("classes").alias("c"), "total", F.size("classes").alias("k")
    ).select(f"c.{label}", (F.col("total") / (F.col("k") * F.col("c.n"))).alias(out))


def source_overlap(points: DataFrame, bucket_ms: int = 60_000) -> DataFrame:
    """Which sources cover each person and time bucket."""
    bucket = (F.col("time_ms") - F.pmod("time_ms", F.lit(bucket_ms))).alias("bucket_ms")
    hits = points.groupBy("id", bucket).agg(
        F.count_if(F.col("source") == S.PRIMARY).alias("n_primary"),
        F.count_if(F.col("source") == S.FALLBACK).alias("n_fallback"),
    )
    both = (F.col("n_primary") > 0) & (F.col("n_fallback") > 0)
    return hits.withColumn(
        "coverage",
        F.when(both, "both").when(F.col("n_primary") > 0, S.PRIMARY).otherwise(S.FALLBACK),
    )


def fleet_summary(
    history: DataFrame,
    order: Sequence[str] = ("time_ms",),
    models: tuple[str, str] = ("pred_lgbm", "pred_gb"),
) -> DataFrame:
    """Over the latest row per person: people, high-stress counts, and models that agree.

    Two missing predictions count as agreeing.
    """
    a, b = models
    return latest_per_id(history, order).agg(
        F.count(F.lit(1)).alias("active"),
        F.count_if(F.col(a) == 2).alias(f"high_{a}"),
        F.count_if(F.col(b) == 2).alias(f"high_{b}"),
        F.count_if(F.col(a).eqNullSafe(F.col(b))).alias("agree"),
    )


def legend_stats(
    series: DataFrame, by: Sequence[str] = ("id",), time: str = "bucket_ms", value: str = "value"
) -> DataFrame:
    """Last non-null value and mean of each series."""
    present = F.when(F.col(value).isNotNull(), F.col(time))
    return series.groupBy(*by).agg(
        F.max_by(value, present).alias("last_not_null"), F.avg(value).alias("mean")
    )

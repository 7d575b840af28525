"""The tables the registered queries run on, derived by Spark from the `events` table.

Thirty days of events are laid on one hour of sensor time, so that windows hold several rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalflow import schemas as S
from vitalflow.functions import scalars as fn
from vitalflow.models.scoring import RuleModel
from vitalflow.operators.aggregates import batch_average, window_average
from vitalflow.session import fresh_path
from vitalflow.sources.points import (
    fallback_points,
    primary_points,
    read_points,
    write_points,
)
from vitalflow.sources.streams import read_stream_earliest

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
EPOCH_US = 1_704_067_200_000_000
SQUEEZE = 720

_WRITTEN: dict[tuple[str, str], str] = {}


def rule_a() -> Column:
    return F.when((F.col("HR") >= 110) | (F.col("EDA") >= 8), 2).when(F.col("HR") >= 80, 1).otherwise(0)


def rule_b() -> Column:
    return (
        F.when(F.col("HR") >= 100, 2)
        .when((F.col("HR") >= 75) | (F.col("TEMP") >= 36), 1)
        .otherwise(0)
    )


RULE_A = RuleModel(rule_a)
RULE_B = RuleModel(rule_b)
RULES = {"lgbm": RULE_A, "gb": RULE_B}
# the same rules for readings: no class without the feature the rule looks at
STRICT_RULES = {
    "lgbm": RuleModel(lambda: F.when(F.col("EDA").isNotNull(), rule_a())),
    "gb": RuleModel(lambda: F.when(F.col("Z").isNotNull(), rule_b())),
}


def use_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a stream; the glob lets `events.parquet` be a file or a folder."""
    use_utc(spark)
    return read_stream_earliest(spark, f"{sf_dir}/events[.]parquet", EVENTS)


def one_number(text: str) -> Column:
    """The number in text of the form {"k": n}, by position rather than by parsing."""
    return F.substring_index(F.substring_index(text, ": ", -1), "}", 1).cast("double")


def to_sensors(rows: DataFrame) -> DataFrame:
    """Sensor readings of events; for tables and streams."""
    seq, value = F.col("event_id"), F.col("value")
    squeezed = F.expr(f"(unix_micros(ts) - {EPOCH_US}) div {SQUEEZE}") + F.lit(EPOCH_US)

    def axis(factor: int) -> Column:
        return (seq * factor % 257 - 128).cast("double")

    return rows.select(
        seq.alias("seq"),
        F.concat(F.lit("N"), F.lpad((F.col("user_id") % 8).cast("string"), 2, "0")).alias("id"),
        squeezed.alias("us"),
        axis(37).alias("X"),
        axis(53).alias("Y"),
        F.when(seq % 17 != 0, axis(71)).alias("Z"),
        F.when(seq % 13 != 0, value / 10).alias("EDA"),
        (F.lit(55) + value % 100).alias("HR"),
        (F.lit(27) + one_number("props") / 10).alias("TEMP"),
        "event_type",
    )


def with_text_time(sensors: DataFrame) -> DataFrame:
    return sensors.withColumn("datetime", fn.format_event_time(F.timestamp_micros("us")))


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_sensors(events(spark, sf_dir))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings with the event time as text."""
    return with_text_time(sensors(spark, sf_dir))


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings with the event time as timestamp."""
    return sensors(spark, sf_dir).withColumn("ts", F.timestamp_micros("us"))


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = (
        F.when(F.col("seq") % 11 == 0, (F.col("seq") % 3).cast("int"))
        .when((F.col("HR") >= 110) | (F.col("EDA") >= 12), 2)
        .when(F.col("HR") >= 80, 1)
        .otherwise(0)
    )
    return sensors(spark, sf_dir).withColumn("label", label)


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_checks(events(spark, sf_dir))


def to_checks(rows: DataFrame) -> DataFrame:
    seq = F.col("event_id")
    lag = F.when(seq % 9 != 0, F.when(seq % 50 == 0, 0.0).otherwise(F.col("value") * 10))
    squeezed = F.expr(f"(unix_micros(ts) - {EPOCH_US}) div {SQUEEZE}") + F.lit(EPOCH_US)
    return rows.select(
        F.col("event_type").alias("pipeline"),
        seq.alias("seq"),
        squeezed.alias("check_us"),
        (F.col("value") >= 5).alias("healthy"),
        lag.alias("latency_s"),
    )


def batched_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = F.floor(F.col("seq") / S.BATCH_RECORDS).cast("bigint")
    return records(spark, sf_dir).withColumn("batch", batch)


def points_path(spark: SparkSession, sf_dir: str) -> str:
    """The written points table of both paths; written once per application and data folder."""
    use_utc(spark)
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _WRITTEN:
        path = fresh_path(spark, "points")
        primary = RULE_A.score(window_average(timed(spark, sf_dir)))
        fallback = RULE_A.score(batch_average(batched_records(spark, sf_dir)))
        both = primary_points(primary).unionByName(fallback_points(fallback))
        write_points(both, path)
        newest = read_points(spark, path).agg(F.max("time_ms")).first()[0]
        _WRITTEN[slot] = (path, newest)
    return _WRITTEN[slot][0]


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_points(spark, points_path(spark, sf_dir))


def now(spark: SparkSession, sf_dir: str) -> Column:
    """The newest time in the points table, taken when it was written: the moment its queries look
    back from."""
    path = points_path(spark, sf_dir)
    (newest,) = [n for p, n in _WRITTEN.values() if p == path]
    return F.lit(newest).cast("bigint")

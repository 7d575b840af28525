"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Values that depend on the order of floating-point sums are shown with four decimals.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalflow import schemas as S
from vitalflow.functions import scalars as fn
from vitalflow.models import boosted, scoring
from vitalflow.operators import aggregates as agg
from vitalflow.operators import batching, control, filters, metrics, timeseries, windows
from vitalflow.operators.ordered import position
from vitalflow.plans import datasets as data
from vitalflow.session import fresh_path, staged
from vitalflow.sources import files, points as pts, streams
from vitalflow.streaming import jobs, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HALF_US = 1_704_069_000_000_000
FIVE, QUARTER = 300_000, 900_000
#: Micro-batches of the streams that arrive in parts, and files of each.
PARTS, FILES_PER_PART = 6, 2  # files at least
#: Heart rate from which a call does not answer in time.
STUCK_HR = 154.9


def query(name: str) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return add


def r4(value: Column | str, name: str | None = None) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    shown = F.floor(c.cast("double") * 10000 + 0.500001) / 10000
    return shown.alias(name or value)


def r4s(names: Iterable[str]) -> list[Column]:
    return [r4(c) for c in names]


def point_columns() -> list[Column | str]:
    return ["id", "source", "time_ms", *r4s(S.SENSORS), "stress_level"]


def fixed_now() -> Column:
    return F.timestamp_millis(F.lit(1_704_067_200_123))


@query("flagship")
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Window averages per person with class and label."""
    scored = data.RULE_A.score(agg.window_average(data.timed(spark, sf)))
    return scored.select(
        "id",
        "windowStart",
        "windowEnd",
        *r4s(S.SENSORS),
        "stress_level",
        fn.stress_label("stress_level").alias("stress_label"),
    )


# ---- sources -----------------------------------------------------------------------------


def finished(stream_query) -> None:
    stream_query.awaitTermination()


def run_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over all data that is there and read what it wrote."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    finished(jobs.start_files(df, f"{path}/rows", f"{path}/progress"))
    return spark.read.schema(df.schema).parquet(f"{path}/rows")


@query("read_stream_earliest")
def read_stream_earliest(spark: SparkSession, sf: str) -> DataFrame:
    rows = run_to_table(data.to_sensors(data.events_stream(spark, sf)), "earliest")
    return rows.select("seq", "id", "us", *r4s(S.SENSORS))


def write_part(spark: SparkSession, sf: str, path: str, first: bool) -> None:
    """Write the sensor records of the first or second half hour as files of a growing folder."""
    early = F.col("us") < HALF_US
    rows = data.records(spark, sf).filter(early if first else ~early)
    rows.write.mode("append").parquet(path)


@query("read_stream_latest_bounded")
def read_stream_latest_bounded(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "log")
    write_part(spark, sf, path, first=True)
    schema = data.records(spark, sf).schema
    there = spark.read.schema(schema).parquet(path).select("_metadata.file_modification_time")
    started = there.agg(F.max(F.unix_millis("file_modification_time"))).first()[0]
    files_there = spark.read.schema(schema).parquet(path).select("_metadata.*")
    just_then = F.unix_millis("file_modification_time") == started
    # only files of the very last moment cannot be told from later ones by their time
    older = [r.file_path for r in files_there.filter(just_then).select("file_path").distinct().collect()]
    write_part(spark, sf, path, first=False)
    reader = streams.read_stream_latest_bounded(
        spark, path, schema, started, files_per_batch=100, there=older
    )
    return run_to_table(reader, "latest").select("seq", "id", "us", *r4s(S.SENSORS))


@query("read_sensor_csv")
def read_sensor_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    data.records(spark, sf).select(*S.RECORD_COLUMNS).write.option("header", True).csv(path)
    return files.read_sensor_csv(spark, path).select("id", "datetime", *r4s(S.SENSORS))


@query("read_zipped_csv")
def read_zipped_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Archives of one person and stretch of readings each, packed and read back."""
    rows = data.records(spark, sf).withColumn("block", F.floor(F.col("seq") / 20_000))
    archives = files.pack_csv(rows, ["id", "block"], "seq")
    return files.read_zipped_csv(archives).select("id", "datetime", *r4s(S.SENSORS))


@query("scan_points")
def scan_points(spark: SparkSession, sf: str) -> DataFrame:
    now = data.now(spark, sf)
    path = data.points_path(spark, sf)
    rows = pts.scan_points(spark, path, S.POINT_MEASUREMENT, QUARTER, now)
    return rows.select("measurement", *point_columns())


@query("normalize_headers")
def normalize_headers(spark: SparkSession, sf: str) -> DataFrame:
    raw = data.labeled(spark, sf).select(
        F.col("id").alias("@ id"),
        F.floor(F.col("us") / 1_000_000).alias(" Timestamp"),
        *[F.col(c).alias(f"# {c}") for c in ("X", "Y", "Z")],
        *[r4(c, f"# {c}") for c in ("HR", "TEMP", "EDA")],
        F.col("label").alias("# label "),
    )
    return files.normalize_headers(raw)


# ---- sinks -------------------------------------------------------------------------------


def scored_windows(spark: SparkSession, sf: str) -> DataFrame:
    return data.RULE_A.score(agg.window_average(data.timed(spark, sf)))


@query("to_line_protocol")
def to_line_protocol(spark: SparkSession, sf: str) -> DataFrame:
    return pts.to_line_protocol(scored_windows(spark, sf))


@query("write_points")
def write_points(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "primary")
    stream = data.with_text_time(data.to_sensors(data.events_stream(spark, sf)))
    finished(jobs.start_primary(stream, data.RULE_A, f"{path}/points", f"{path}/progress"))
    return pts.read_points(spark, f"{path}/points").select("measurement", *point_columns())


@query("write_points_batch")
def write_points_batch(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "fallback")
    pts.write_points(jobs.fallback_batch(data.batched_records(spark, sf), data.RULE_A), path)
    return pts.read_points(spark, path).select("measurement", *point_columns())


@query("upsert_points")
def upsert_points(spark: SparkSession, sf: str) -> DataFrame:
    """Every point written twice; the second writing counts."""
    path = fresh_path(spark, "rewritten")
    first = data.points(spark, sf).select(*S.POINT.names)
    pts.write_points(first, path, 0)
    pts.write_points(first.withColumn("stress_level", F.col("stress_level") + 1), path, 1)
    kept = pts.upsert_points(pts.read_points(spark, path))
    return kept.select("measurement", *point_columns(), "batch_id")


@query("write_csv_per_id")
def write_csv_per_id(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "per-id")
    files.write_csv_per_id(data.records(spark, sf), path)
    back = files.read_sensor_csv(spark, path)
    folder = F.regexp_extract(F.input_file_name(), "person=([^/]*)/", 1).alias("person")
    return back.select(folder, "id", "datetime", *r4s(S.SENSORS))


def run_in_two_parts(
    spark: SparkSession, sf: str, name: str, plan: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Run a stream, stop it, let more files arrive, and start it again from its progress."""
    path = fresh_path(spark, name)
    schema = data.records(spark, sf).schema
    for first in (True, False):
        write_part(spark, sf, f"{path}/log", first)
        out = plan(streams.read_stream_earliest(spark, f"{path}/log", schema))
        finished(jobs.start_files(out, f"{path}/rows", f"{path}/progress"))
    return spark.read.schema(out.schema).parquet(f"{path}/rows")


@query("progress_commit")
def progress_commit(spark: SparkSession, sf: str) -> DataFrame:
    return run_in_two_parts(spark, sf, "commit", lambda s: s.select("seq", "id", "us"))


# ---- projections and filters -------------------------------------------------------------


@query("project_sensor_columns")
def project_sensor_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.project_sensor_columns(data.records(spark, sf))
    return rows.select(*r4s(S.SENSORS), "id", "datetime")


@query("filter_by_id")
def filter_by_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.filter_by_id(filters.project_sensor_columns(data.records(spark, sf)), "N03")
    return rows.select(*r4s(S.SENSORS), "id", "datetime")


def complete(spark: SparkSession, sf: str) -> DataFrame:
    return filters.drop_incomplete(data.labeled(spark, sf))


@query("drop_incomplete")
def drop_incomplete(spark: SparkSession, sf: str) -> DataFrame:
    return complete(spark, sf).select("seq", "id", *r4s(S.SENSORS), "label")


@query("recent_range")
def recent_range(spark: SparkSession, sf: str) -> DataFrame:
    points = data.points(spark, sf)
    return filters.recent_range(points, FIVE, data.now(spark, sf)).select(*point_columns())


@query("filter_source")
def filter_source(spark: SparkSession, sf: str) -> DataFrame:
    both = filters.filter_source(data.points(spark, sf), S.PRIMARY, S.FALLBACK)
    return both.select(*point_columns())


@query("latest_points")
def latest_points(spark: SparkSession, sf: str) -> DataFrame:
    points = data.points(spark, sf)
    newest = filters.latest_points(points, S.PRIMARY, 3).unionByName(
        filters.latest_points(points, S.FALLBACK, 5)
    )
    return newest.select("time_ms", "id", *r4s(("HR", "TEMP")), "stress_level", "source")


@query("sample_points")
def sample_points(spark: SparkSession, sf: str) -> DataFrame:
    return filters.sample_points(data.points(spark, sf)).select(*point_columns())


@query("select_by_id_grouped")
def select_by_id_grouped(spark: SparkSession, sf: str) -> DataFrame:
    return filters.select_by_id_grouped(data.points(spark, sf), "N06").select(*point_columns())


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Score requests as text, some without a number or with an unknown model."""
    kind = F.col("event_type")
    return data.sensors(spark, sf).select(
        "seq",
        F.when(kind == "error", "abc").otherwise(F.col("X").cast("string")).alias("x"),
        F.col("Y").cast("string").alias("y"),
        F.coalesce("Z", F.lit(0.0)).cast("string").alias("z"),
        F.coalesce("EDA", F.lit(0.0)).cast("string").alias("eda"),
        F.when(kind != "signup", F.col("HR").cast("string")).alias("hr"),
        F.col("TEMP").cast("string").alias("temp"),
        F.when(kind == "view", " GB ").when(kind == "click", "foo").alias("model"),
    )


@query("validate_inputs")
def validate_inputs(spark: SparkSession, sf: str) -> DataFrame:
    checked = filters.validate_inputs(requests(spark, sf))
    return checked.select("seq", "x", "y", "z", *r4s(("eda", "hr", "temp")), "model", "error")


# ---- scalar functions --------------------------------------------------------------------


def time_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Event times as text of several precisions, some missing or unreadable."""
    kind = F.col("event_type")
    micros = F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = (
        F.when(kind == "error", F.lit(None))
        .when(kind == "signup", "n/a")
        .when(kind == "view", F.substring(micros, 1, 19))
        .when(kind == "click", F.concat(micros, F.lit("789")))
        .otherwise(micros)
    )
    return data.sensors(spark, sf).select("seq", text.alias("text"))


@query("parse_event_time")
def parse_event_time(spark: SparkSession, sf: str) -> DataFrame:
    parsed = fn.parse_event_time("text", fixed_now())
    return time_texts(spark, sf).select("seq", F.unix_millis(parsed).alias("event_ms"))


@query("parse_event_time_seconds")
def parse_event_time_seconds(spark: SparkSession, sf: str) -> DataFrame:
    parsed = fn.parse_event_time_seconds("text", fixed_now())
    return time_texts(spark, sf).select("seq", parsed.alias("event_ms"))


@query("format_event_time")
def format_event_time(spark: SparkSession, sf: str) -> DataFrame:
    text = fn.format_event_time(F.timestamp_micros("us"))
    return data.sensors(spark, sf).select("seq", text.alias("datetime"))


@query("to_epoch_nanos")
def to_epoch_nanos(spark: SparkSession, sf: str) -> DataFrame:
    rows = agg.window_average(data.timed(spark, sf))
    return rows.select("id", fn.to_epoch_nanos("datetime").alias("time_ns"))


@query("null_as_zero")
def null_as_zero(spark: SparkSession, sf: str) -> DataFrame:
    return data.sensors(spark, sf).select("seq", *[r4(fn.null_as_zero(c), c) for c in S.SENSORS])


@query("empty_as_null")
def empty_as_null(spark: SparkSession, sf: str) -> DataFrame:
    texts = data.sensors(spark, sf).select(
        "seq", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("Z", "EDA")]
    )
    return texts.select("seq", *[r4(fn.empty_as_null(c), c) for c in ("Z", "EDA")])


@query("stress_label")
def stress_label(spark: SparkSession, sf: str) -> DataFrame:
    level = F.col("seq") % 4
    return data.sensors(spark, sf).select(
        "seq",
        fn.stress_label(level).alias("label"),
        fn.stress_label(level, S.DISPLAY_BLANK).alias("shown"),
    )


@query("threshold_band")
def threshold_band(spark: SparkSession, sf: str) -> DataFrame:
    return data.labeled(spark, sf).select(
        "seq",
        fn.threshold_band("label").alias("level_band"),
        fn.sensor_band("HR").alias("sensor_band"),
    )


@query("fallback_status")
def fallback_status(spark: SparkSession, sf: str) -> DataFrame:
    counted = data.events(spark, sf).groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("n")
    )
    return counted.select("user_id", fn.fallback_status("n").alias("status"))


@query("parse_prediction")
def parse_prediction(spark: SparkSession, sf: str) -> DataFrame:
    kind, level = F.col("event_type"), F.col("label").cast("string")
    body = (
        F.when(kind == "error", '{"error": "model failed"}')
        .when(kind == "view", F.format_string('{"stress_level_prediction": "%s.0"}', level))
        .when(kind == "click", F.format_string('{"stress_level_prediction": %s}', level))
        .otherwise(F.format_string('{"stress_level_prediction": "%s", "model": "gb"}', level))
    )
    return data.labeled(spark, sf).select("seq", fn.parse_prediction(body).alias("prediction"))


@query("feature_text")
def feature_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = agg.window_average(data.timed(spark, sf))
    return rows.select("id", "windowEnd", fn.feature_text().alias("request"))


@query("prediction_response")
def prediction_response(spark: SparkSession, sf: str) -> DataFrame:
    response = fn.prediction_response("stress_level", F.lit(S.DEFAULT_MODEL)).alias("r")
    return scored_windows(spark, sf).select("id", "windowEnd", response).select(
        "id",
        "windowEnd",
        "r.stress_level_prediction",
        "r.stress_label",
        "r.model",
        *[r4(F.col(f"r.inputs.{c.lower()}"), f"in_{c.lower()}") for c in S.SENSORS],
    )


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.compare_models(data.sensors(spark, sf), data.STRICT_RULES)


@query("label_delta")
def label_delta(spark: SparkSession, sf: str) -> DataFrame:
    return predicted(spark, sf).select(
        "seq",
        fn.label_delta("pred_lgbm", "pred_gb").alias("delta"),
        (F.col("pred_lgbm") == F.col("pred_gb")).alias("same"),
    )


@query("assemble_features")
def assemble_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = scoring.assemble_features(complete(spark, sf)).withColumn("f", vector_to_array("features"))
    return rows.select("seq", *[r4(F.col("f")[i], f"f{i}") for i in range(len(S.FEATURES))])


# ---- aggregations ------------------------------------------------------------------------


@query("window_avg_null_zero")
def window_avg_null_zero(spark: SparkSession, sf: str) -> DataFrame:
    rows = agg.window_average(data.timed(spark, sf))
    return rows.select("id", *r4s(S.SENSORS), "datetime", "windowStart", "windowEnd")


@query("batch_avg_skip_null")
def batch_avg_skip_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = agg.batch_average(data.batched_records(spark, sf))
    return rows.select("batch", "id", *r4s(S.SENSORS), "datetime")


@query("count_points")
def count_points(spark: SparkSession, sf: str) -> DataFrame:
    return agg.count_points(data.points(spark, sf))


@query("count_by_source")
def count_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return agg.count_by_source(data.points(spark, sf))


@query("fallback_activity")
def fallback_activity(spark: SparkSession, sf: str) -> DataFrame:
    points = data.points(spark, sf)
    return agg.fallback_activity(points, data.now(spark, sf))


@query("value_counts")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return agg.value_counts(data.sensors(spark, sf))


@query("describe_series")
def describe_series(spark: SparkSession, sf: str) -> DataFrame:
    return agg.describe_series(data.points(spark, sf))


@query("correlation_matrix")
def correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.correlation_matrix(complete(spark, sf)).select("a", "b", r4("corr"))


def judged(spark: SparkSession, sf: str) -> DataFrame:
    return data.RULE_A.score(complete(spark, sf), "prediction")


@query("accuracy")
def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.accuracy(judged(spark, sf)).select(r4("accuracy"))


def shown_report(report: DataFrame) -> DataFrame:
    return report.select("name", *r4s(("precision", "recall", "f1")), "support")


@query("classification_report")
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return shown_report(metrics.classification_report(judged(spark, sf)))


@query("confusion_matrix")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(judged(spark, sf))


@query("multi_logloss")
def multi_logloss(spark: SparkSession, sf: str) -> DataFrame:
    weights = [1 + F.abs("X"), 1 + F.abs("Y"), 1 + F.col("HR")]
    total = weights[0] + weights[1] + weights[2]
    rows = complete(spark, sf).withColumns({f"p{i}": w / total for i, w in enumerate(weights)})
    return metrics.multi_logloss(rows).select(r4("logloss"))


@query("class_weights")
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return agg.class_weights(complete(spark, sf)).select("seq", "label", r4("weight"))


@query("source_overlap")
def source_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return agg.source_overlap(data.points(spark, sf))


@query("fleet_summary")
def fleet_summary(spark: SparkSession, sf: str) -> DataFrame:
    return agg.fleet_summary(predicted(spark, sf), ("seq",))


# ---- time buckets ------------------------------------------------------------------------


def bucket_query(name: str, build: Callable[[DataFrame, Column], DataFrame], rounded: bool = True) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        points = data.points(spark, sf)
        out = build(points, data.now(spark, sf))
        return out.withColumn("value", r4("value")) if rounded else out

    QUERIES[name] = run


def _last(field: str) -> Callable[[DataFrame, Column], DataFrame]:
    return lambda p, now: timeseries.last_by_bucket(
        filters.filter_source(p, S.PRIMARY), field, FIVE, as_of=now
    )


def _mean(field: str, series: str) -> Callable[[DataFrame, Column], DataFrame]:
    return lambda p, now: timeseries.mean_by_bucket(p, field, [series], QUARTER, as_of=now)


bucket_query("last_stress_by_bucket", _last("stress_level"), rounded=False)
bucket_query("last_hr_by_bucket", _last("HR"))
bucket_query("last_temp_by_bucket", _last("TEMP"))
bucket_query("last_eda_by_bucket", _last("EDA"))
bucket_query("mean_stress_by_source_1m", _mean("stress_level", "source"))
bucket_query("mean_stress_by_id_1m", _mean("stress_level", "id"))
bucket_query("mean_hr_by_id_1m", _mean("HR", "id"))
bucket_query("mean_temp_by_id_1m", _mean("TEMP", "id"))
bucket_query(
    "count_by_source_1m",
    lambda p, now: timeseries.count_by_bucket(p, range_ms=QUARTER, as_of=now),
    rounded=False,
)
bucket_query(
    "count_by_source_1m_unfilled",
    lambda p, now: timeseries.count_by_bucket(p, range_ms=QUARTER, as_of=now, fill=None),
    rounded=False,
)
bucket_query("mean_by_id_source_1m", lambda p, now: timeseries.mean_by_id_source(p))
bucket_query(
    "fill_buckets",
    lambda p, now: timeseries.by_bucket(
        p, F.count("HR"), ["id", "source"], 3_600_000, 10_000, now, fill=0
    ),
    rounded=False,
)
bucket_query(
    "auto_interval",
    lambda p, now: timeseries.by_bucket(
        p, F.avg("HR"), ["id"], QUARTER, timeseries.auto_interval(QUARTER, 5), now
    ),
)


@query("legend_stats")
def legend_stats(spark: SparkSession, sf: str) -> DataFrame:
    points = data.points(spark, sf)
    series = timeseries.mean_by_bucket(
        points, "stress_level", ["id"], QUARTER, as_of=data.now(spark, sf)
    )
    return agg.legend_stats(series).select("id", *r4s(("last_not_null", "mean")))


# ---- histories, replay, split ------------------------------------------------------------


def shown_reading(df: DataFrame) -> DataFrame:
    return df.select("seq", "id", *r4s(("HR", "TEMP", "EDA")), "pred_lgbm", "pred_gb")


@query("latest_per_id")
def latest_per_id(spark: SparkSession, sf: str) -> DataFrame:
    return shown_reading(windows.latest_per_id(predicted(spark, sf), ("seq",)))


@query("rolling_history")
def rolling_history(spark: SparkSession, sf: str) -> DataFrame:
    return shown_reading(windows.rolling_history(predicted(spark, sf), ("seq",)))


@query("delta_vs_history_mean")
def delta_vs_history_mean(spark: SparkSession, sf: str) -> DataFrame:
    deltas = windows.delta_vs_history_mean(data.sensors(spark, sf), order=("seq",))
    return deltas.select("id", *[r4(c) for c in deltas.columns if c != "id"])


@query("disagreement_log")
def disagreement_log(spark: SparkSession, sf: str) -> DataFrame:
    history = windows.rolling_history(predicted(spark, sf), ("seq",))
    return shown_reading(windows.disagreement_log(history, ("seq",)))


@query("disagreement_log_carry")
def disagreement_log_carry(spark: SparkSession, sf: str) -> DataFrame:
    history = windows.rolling_history(predicted(spark, sf), ("seq",))
    return shown_reading(windows.disagreement_log(history, ("seq",), carry_over=True))


@query("synthetic_clock")
def synthetic_clock(spark: SparkSession, sf: str) -> DataFrame:
    rows = windows.synthetic_clock(data.sensors(spark, sf), data.EPOCH_US)
    return rows.select("seq", "id", "clock_us", "datetime")


@query("replay_batches")
def replay_batches(spark: SparkSession, sf: str) -> DataFrame:
    rows = windows.replay_batches(data.sensors(spark, sf), data.EPOCH_US)
    return rows.select("seq", "id", "batch", "clock_us", "datetime")


@query("stratified_split")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return windows.stratified_split(complete(spark, sf)).select("seq", "label", "is_test")


@query("violation_runs")
def violation_runs(spark: SparkSession, sf: str) -> DataFrame:
    runs = control.violation_runs(data.checks(spark, sf))
    return runs.select("pipeline", "seq", "breach", "reset", "run_id", "run")


# ---- streaming ---------------------------------------------------------------------------


def record_stream(spark: SparkSession, sf: str) -> DataFrame:
    return data.with_text_time(data.to_sensors(data.events_stream(spark, sf)))


def in_parts(rows: DataFrame, part: Column, name: str) -> DataFrame:
    """A stream of `rows` that reads the parts 0 to PARTS - 1 one per micro-batch.

    Every part is written as so many files as Spark's partitions hold the widest one in, so they grow
    with the input. What a part of few rows lacks is made up by empty files, as a micro-batch takes
    a fixed number.
    """
    path = fresh_path(rows.sparkSession, name)
    files = write_parts(rows, part, path, range(PARTS))
    return streams.read_stream_earliest(rows.sparkSession, path, rows.schema, files)


def write_parts(rows: DataFrame, part: Column, path: str, parts: Iterable[int], files: int = 0) -> int:
    """Write some of the parts in their order; the number of files of each, `files` if given."""
    spark = rows.sparkSession
    numbered = staged(rows.withColumn("_part", part), "parts")
    if not files:
        inside = numbered.filter(F.col("_part").between(0, PARTS - 1))
        held_in = inside.select("_part", F.spark_partition_id().alias("_in")).distinct()
        widths = held_in.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
        files = max(widths.agg(F.max("n")).first()[0] or 0, FILES_PER_PART)
    for k in parts:
        own = numbered.filter(F.col("_part") == k).drop("_part")
        own.repartition(files).write.mode("append").parquet(path)
        there = len(spark.read.schema(rows.schema).parquet(path).inputFiles())
        for _ in range((k + 1) * files - there):
            own.limit(0).write.mode("append").parquet(path)
    return files


def run_restarted(
    rows: DataFrame, part: Column, name: str, plan: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, str]:
    """Run a stream with keyed state on the first half of the parts, one per micro-batch, stop it,
    and start it again for the others. What it wrote, and its progress folder."""
    spark = rows.sparkSession
    path = fresh_path(spark, name)
    files, out = 0, None
    for half in (range(PARTS // 2), range(PARTS // 2, PARTS)):
        files = write_parts(rows, part, f"{path}/log", half, files)
        out = plan(streams.read_stream_earliest(spark, f"{path}/log", rows.schema, files))
        finished(jobs.start_files(out, f"{path}/rows", f"{path}/progress", keyed=True))
    return spark.read.schema(out.schema).parquet(f"{path}/rows"), f"{path}/progress"


def share_of(place: Column, rows: DataFrame) -> Column:
    """Which of PARTS equal stretches of `place`, a number from 0 up, a row lies in."""
    whole = rows.agg(F.max(place)).scalar() + 1
    return F.floor(place * PARTS / whole).cast("int")


def stretch_of(place: Column, rows: DataFrame) -> Column:
    """Which of PARTS equal stretches between the least and the greatest `place` a row lies in; null
    without a place."""
    low, high = (rows.agg(f(place)).scalar() for f in (F.min, F.max))
    return F.floor((place - low) * PARTS / (high - low + 1)).cast("int")


def closed_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Window averages a stream over all events has emitted when its input is used up."""
    return run_to_table(jobs.tumbling_average_stream(record_stream(spark, sf)), "averages")


@query("assign_event_time")
def assign_event_time(spark: SparkSession, sf: str) -> DataFrame:
    timed = jobs.assign_event_time(record_stream(spark, sf))
    rows = run_to_table(timed.select("seq", "ts"), "event-time")
    return rows.select("seq", F.unix_millis("ts").alias("event_ms"))


@query("bounded_watermark")
def bounded_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """Rows up to four seconds late over several micro-batches: all still count."""
    rows = data.records(spark, sf)
    arrival = F.col("us") - data.EPOCH_US + F.when(F.col("seq") % 10 == 0, 4_000_000).otherwise(0)
    stream = in_parts(rows, share_of(arrival, rows), "watermark")
    closed = run_to_table(jobs.tumbling_average_stream(stream), "averages")
    return closed.select("id", *r4s(S.SENSORS), "datetime", "windowStart", "windowEnd")


@query("idle_partition")
def idle_partition(spark: SparkSession, sf: str) -> DataFrame:
    """One person is silent after the first of several micro-batches; the others' windows close."""
    rows = data.records(spark, sf)
    part = share_of(F.col("us") - data.EPOCH_US, rows)
    stream = in_parts(rows.filter((F.col("id") != "N03") | (part == 0)), part, "idle")
    closed = run_to_table(jobs.tumbling_average_stream(stream), "averages")
    return closed.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_closed"), F.max("windowEnd").alias("last_end")
    )


@query("tumbling_avg_stream")
def tumbling_avg_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = closed_windows(spark, sf)
    return rows.select("id", *r4s(S.SENSORS), "datetime", "windowStart", "windowEnd")


@query("window_metadata")
def window_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return closed_windows(spark, sf).select("id", "datetime", "windowStart", "windowEnd")


def scored_stream(spark: SparkSession, sf: str) -> DataFrame:
    averages = jobs.tumbling_average_stream(record_stream(spark, sf))
    return jobs.score_stream(averages, data.RULE_A)


@query("score_stream")
def score_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = run_to_table(scored_stream(spark, sf), "scored")
    return rows.select("id", "windowEnd", *r4s(S.SENSORS), "stress_level")


@query("stress_alert")
def stress_alert(spark: SparkSession, sf: str) -> DataFrame:
    alerts = control.stress_alerts(scored_stream(spark, sf))
    return run_to_table(alerts, "alerts").select("id", "windowEnd", "stress_level")


@query("late_drop")
def late_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth row arrives twenty seconds late; those of closed windows no longer count."""
    rows = data.records(spark, sf)
    arrival = F.col("us") - data.EPOCH_US + F.when(F.col("seq") % 10 == 0, 20_000_000).otherwise(0)
    stream = in_parts(rows, share_of(arrival, rows), "late")
    closed = run_to_table(jobs.tumbling_average_stream(stream), "averages")
    return closed.select("id", "windowStart", *r4s(S.SENSORS))


@query("count_batches")
def count_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of a thousand records, by position in the log."""
    rows = data.sensors(spark, sf)
    placed = position(rows, [], ["seq"], "pos")
    batch = F.floor(F.col("pos") / S.BATCH_RECORDS).cast("bigint")
    return placed.select("seq", "id", batch.alias("batch"))


@query("count_or_time_batches")
def count_or_time_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches that close at a thousand records or after thirty seconds of the log."""
    log = data.sensors(spark, sf).select(
        "seq", "id", F.floor(F.col("us") / 1_000).cast("bigint").alias("arrival_ms")
    )
    return batching.count_or_time_batches(log, [], ["arrival_ms", "seq"], "arrival_ms")


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """A log of two partitions whose first twenty minutes arrive within six seconds."""
    since = F.expr(f"(us - {data.EPOCH_US}) div 1000")
    passed = F.when(since < 1_200_000, F.floor(since / 200)).otherwise(since - 1_194_000)
    arrival = passed + data.EPOCH_US // 1_000
    log = data.sensors(spark, sf).select(
        "seq", "id", (F.col("seq") % 2).alias("partition"), *S.SENSORS, arrival.alias("arrival_ms")
    )
    return log.withColumn("arrival", F.timestamp_millis("arrival_ms"))


@query("count_or_time_stream")
def count_or_time_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Live batches, closed by count and by time, over several files and a restart with open ones."""
    log = arrivals(spark, sf)
    collected, _ = run_restarted(
        log,
        share_of(F.col("arrival_ms") - data.EPOCH_US // 1_000, log),
        "collected",
        lambda s: stateful.collect_batches(s, ["partition"], ["arrival_ms", "seq"], "arrival_ms", "arrival"),
    )
    return collected.select("partition", "seq", "batch", "closed_by")


@query("history_stream")
def history_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Every reading beside the mean of the person's last sixty, over several files and a restart.
    Readings without a time are the last ones."""
    rows = data.sensors(spark, sf).select("seq", "id", "us", "HR", "TEMP", "EDA", "Z")
    rows = rows.withColumn("undated", F.col("us").isNull())
    place = F.coalesce(stretch_of(F.col("us"), rows), F.lit(PARTS - 1))
    order = ("undated", "us", "seq")
    out, _ = run_restarted(rows, place, "history", lambda s: stateful.history_stream(s, order=order))
    shown = [f"{kind}_{c}" for c in ("HR", "TEMP", "EDA", "Z") for kind in ("mean", "delta")]
    return out.select("seq", "id", *r4s(shown), "n_history")


@query("fallback_stream")
def fallback_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered batches that end inside micro-batches; each is averaged once."""
    path = fresh_path(spark, "fallback")
    rows = data.records(spark, sf)
    batch = F.floor(F.col("seq") / S.BATCH_RECORDS).cast("bigint")
    run = jobs.start_fallback(
        in_parts(rows, share_of(F.col("seq"), rows), "numbered"), data.RULE_A, f"{path}/points",
        f"{path}/progress", batch, open_path=f"{path}/open",
    )
    finished(run)
    last = run.lastProgress["batchId"]
    jobs.finish_fallback(spark, data.RULE_A, f"{path}/points", f"{path}/open", last)
    return pts.read_points(spark, f"{path}/points").select("measurement", *point_columns())


@query("score_with_default")
def score_with_default(spark: SparkSession, sf: str) -> DataFrame:
    scored = scoring.complete_only(data.sensors(spark, sf), data.RULE_A)
    return scoring.with_default(scored).select("seq", "stress_level", "was_default")


@query("score_remote")
def score_remote(spark: SparkSession, sf: str) -> DataFrame:
    """Classes from calls, of which some never answer in time: only their rows get the default."""

    def ask(request: str, timeout_s: float) -> str:
        values = dict(part.split("=") for part in request.split("&"))
        if float(values["hr"]) >= STUCK_HR:
            time.sleep(3 * timeout_s)
        level = 2 if float(values["hr"]) >= 110 or float(values["eda"]) >= 8 else 0
        return f'{{"stress_level_prediction": "{level}"}}'

    answered = scoring.score_remote(complete(spark, sf), ask, timeout_s=2.0, default=S.DEFAULT_CLASS)
    return answered.select("seq", "stress_level")


@query("stream_restart")
def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    rows = run_in_two_parts(spark, sf, "restart", jobs.tumbling_average_stream)
    return rows.select("id", *r4s(S.SENSORS), "datetime", "windowStart", "windowEnd")


# ---- control -----------------------------------------------------------------------------


@query("processing_lag")
def processing_lag(spark: SparkSession, sf: str) -> DataFrame:
    points = data.points(spark, sf)
    fallback = filters.filter_source(points, S.FALLBACK)
    lag = control.processing_lag(fallback, data.now(spark, sf))
    return lag.select("last_ms", r4("lag_s"))


@query("lag_by_source")
def lag_by_source(spark: SparkSession, sf: str) -> DataFrame:
    points = data.points(spark, sf)
    lag = control.lag_by_source(points, data.now(spark, sf))
    return lag.select("source", "last_ms", r4("lag_s"))


@query("fallback_state")
def fallback_state(spark: SparkSession, sf: str) -> DataFrame:
    states = control.fallback_state(data.checks(spark, sf))
    return states.select("pipeline", "seq", "was_fallback", "in_fallback", "violation_count")


def by_number(checks: DataFrame) -> Column:
    """Checks go by their number, whatever their time; those without one are the first, as in a table."""
    return F.coalesce(stretch_of(F.col("seq"), checks), F.lit(0))


def monitored(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """Modes after every check of a stream of several files, started from a table, with a restart."""
    checks = data.checks(spark, sf)
    pipelines = checks.select("pipeline").distinct()
    initial = pipelines.select(
        "pipeline", F.lit(False).alias("in_fallback"), F.lit(0).cast("bigint").alias("violation_count")
    )
    return run_restarted(checks, by_number(checks), "modes", lambda s: stateful.fallback_state_stream(s, initial))


@query("fallback_state_stream")
def fallback_state_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The state carried in the state store, over micro-batches and a restart."""
    rows, _ = monitored(spark, sf)
    return rows.select("pipeline", "seq", "was_fallback", "in_fallback", "violation_count")


@query("mode_state")
def mode_state(spark: SparkSession, sf: str) -> DataFrame:
    """The monitor's state, read back from the state store."""
    _, progress = monitored(spark, sf)
    return stateful.mode_state(spark, progress)


@query("dual_path_stream")
def dual_path_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Fallback points of times in fallback mode; the mode becomes known after the points."""
    path = fresh_path(spark, "stretches")
    one = data.checks(spark, sf).withColumn("pipeline", F.lit("all"))
    modes = stateful.mode_intervals_stream(in_parts(one, by_number(one), "checks"))
    finished(jobs.start_files(modes, f"{path}/rows", f"{path}/progress", keyed=True))
    stretches = spark.read.schema(modes.schema).parquet(f"{path}/rows")
    since = F.floor((F.col("until_us") - data.EPOCH_US) / 1_000)
    points = filters.filter_source(data.points(spark, sf).select(*S.POINT.names), S.FALLBACK)
    start = F.col("time_ms") - data.EPOCH_US // 1_000
    # stretches come one micro-batch after the points that lie in them
    late = F.least(stretch_of(since, stretches) + 1, F.lit(PARTS - 1))
    joined = stateful.points_in_fallback(
        in_parts(points, stretch_of(start, points), "points"), in_parts(stretches, late, "stretches")
    )
    return run_to_table(joined, "both").select(*point_columns())


@query("mode_timeline")
def mode_timeline(spark: SparkSession, sf: str) -> DataFrame:
    changes = control.mode_timeline(control.fallback_state(data.checks(spark, sf)))
    return changes.select("pipeline", "seq", "change", "from_us", "until_us", r4("duration_s"))


@query("triggers_by_period")
def triggers_by_period(spark: SparkSession, sf: str) -> DataFrame:
    changes = control.mode_timeline(control.fallback_state(data.checks(spark, sf)))
    return control.triggers_by_period(changes, 600_000)


@query("dual_path_points")
def dual_path_points(spark: SparkSession, sf: str) -> DataFrame:
    """One monitor over all checks decides which fallback points count."""
    points = data.points(spark, sf).select(*S.POINT.names)
    one = data.checks(spark, sf).withColumn("pipeline", F.lit("all"))
    timeline = control.mode_timeline(control.fallback_state(one))
    both = control.dual_path_points(
        filters.filter_source(points, S.PRIMARY), filters.filter_source(points, S.FALLBACK), timeline
    )
    return both.select(*point_columns())


def offsets(spark: SparkSession, sf: str) -> DataFrame:
    return data.events(spark, sf).select(
        F.col("event_type").alias("reader"),
        (F.col("user_id") % 2).alias("partition"),
        F.col("event_id").alias("latest_offset"),
        F.when(F.col("value") >= 5, F.col("event_id")).alias("committed_offset"),
    )


@query("consumer_lag")
def consumer_lag(spark: SparkSession, sf: str) -> DataFrame:
    return control.consumer_lag(offsets(spark, sf))


@query("consumer_lag_totals")
def consumer_lag_totals(spark: SparkSession, sf: str) -> DataFrame:
    return control.consumer_lag_totals(control.consumer_lag(offsets(spark, sf)))


# ---- models ------------------------------------------------------------------------------


def split_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    parts = staged(windows.stratified_split(complete(spark, sf)), "split")
    return parts.filter(~F.col("is_test")), parts.filter("is_test")


#: Where the models of LEAF_BOOSTING lie, by application and tables; two queries share one.
_LEAF_MODELS: dict[tuple[str, str], str] = {}


def fitted(settings: boosted.BoostedTrees, train: DataFrame, sf: str) -> boosted.BoostedModel:
    if settings is not boosted.LEAF_BOOSTING:
        return settings.fit(train, row_key="seq")
    spark = train.sparkSession
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LEAF_MODELS:
        path = fresh_path(spark, "leaf-model")
        settings.fit(train, row_key="seq").save(path)
        _LEAF_MODELS[key] = path
    return boosted.BoostedModel.load(_LEAF_MODELS[key])


def training_query(name: str, settings: boosted.BoostedTrees) -> None:
    """Held-out rows with their class scores after the first round of the trained model."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        train, test = split_parts(spark, sf)
        scored = fitted(settings, train, sf).first(1).scores(test)
        return scored.select("seq", "label", *r4s(("f0", "f1", "f2")))

    QUERIES[name] = run


training_query("train_gb", boosted.GRADIENT_BOOSTING)
training_query("train_hist_gb", boosted.HISTOGRAM_BOOSTING)
training_query("train_lgbm", boosted.LEAF_BOOSTING)


@query("save_model")
def save_model(spark: SparkSession, sf: str) -> DataFrame:
    """Train, save, load, and score the held-out rows with both copies."""
    train, test = split_parts(spark, sf)
    model = boosted.train_gb(train)
    path = fresh_path(spark, "model")
    model.save(path)
    loaded = boosted.load_models({"gb": path})["gb"]
    both = scoring.compare_models(test, {"fitted": model, "loaded": loaded})
    return both.select("seq", "label", "agree")


@query("train_lgbm_logloss")
def train_lgbm_logloss(spark: SparkSession, sf: str) -> DataFrame:
    """After every 50 rounds: the held-out rows, the log loss of always giving the shares that
    classes have among them, and whether the model's is lower."""
    train, test = split_parts(spark, sf)
    losses = boosted.staged_multi_logloss(fitted(boosted.LEAF_BOOSTING, train, sf), test)
    sizes = test.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    whole = sizes.agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") * F.log("n")).alias("s"))
    shares = F.log("n_rows") - F.col("s") / F.col("n_rows")
    joined = losses.join(F.broadcast(whole))  # one row
    return joined.select("trees", "n_rows", r4(shares, "shares_loss"), (F.col("logloss") < shares).alias("lower"))


@query("score_batch")
def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    rows = data.sensors(spark, sf)
    for key in S.MODEL_KEYS:
        rows = scoring.score_batch(rows, data.RULES, key, key)
    return rows.select("seq", *S.MODEL_KEYS)


@query("score_requests")
def score_requests(spark: SparkSession, sf: str) -> DataFrame:
    checked = filters.validate_inputs(requests(spark, sf))
    return scoring.score_requests(checked, data.RULES).select(
        "seq", "model", "error", "response.stress_level_prediction", "response.stress_label"
    )


@query("compare_models")
def compare_models(spark: SparkSession, sf: str) -> DataFrame:
    return predicted(spark, sf).select("seq", "pred_lgbm", "pred_gb", "agree", "delta")


@query("csv_to_report")
def csv_to_report(spark: SparkSession, sf: str) -> DataFrame:
    """From a file with raw headers over renaming, dropping and splitting to the report."""
    path = fresh_path(spark, "raw-csv")
    raw = data.labeled(spark, sf).select(
        F.col("id").alias("@ id"),
        F.col("seq").alias("Timestamp"),
        *[F.col(c).alias(f"# {c}") for c in S.SENSORS],
        F.col("label").alias("# label"),
    )
    raw.write.option("header", True).csv(path)
    types = {"# label": T.IntegerType(), "Timestamp": T.LongType(), "@ id": T.StringType()}
    schema = T.StructType([T.StructField(c, types.get(c, T.DoubleType())) for c in raw.columns])
    back = files.read_sensor_csv(spark, path, schema)
    rows = filters.drop_incomplete(files.normalize_headers(back, S.COLUMN_NAMES))
    held_out = windows.stratified_split(rows).filter("is_test")
    return shown_report(metrics.classification_report(data.RULE_A.score(held_out, "prediction")))


@query("evaluate_model")
def evaluate_model(spark: SparkSession, sf: str) -> DataFrame:
    held_out = windows.stratified_split(complete(spark, sf)).filter("is_test")
    scored = data.RULE_A.score(held_out, "prediction")
    return shown_report(metrics.classification_report(scored))

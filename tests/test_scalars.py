import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitalflow.functions import scalars as fn
from vitalflow.operators import filters

NOW = 1_700_000_000_123
BASE = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
DAY = 86_400_000


def at(*args):
    return int(dt.datetime(*args, tzinfo=dt.timezone.utc).timestamp() * 1000)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_event_time(spark, zone):
    cases = {
        "2024-01-01 00:00:00": BASE,
        "2024-01-01 00:00:00.1": BASE + 100,
        "2024-01-01 00:00:00.123456789": BASE + 123,
        "2024-01-01 00:00:00.": BASE,
        "2024-02-30 01:02:03": at(2024, 2, 29, 1, 2, 3),
        "2023-02-29 01:02:03.5": at(2023, 2, 28, 1, 2, 3) + 500,
        "2024-04-31 00:00:00": at(2024, 4, 30),
        "2024-01-01 24:00:00": BASE + DAY,
        "2024-01-01 24:00:00.000": BASE + DAY,
        "2024-01-01 24:00:01": NOW,
        "2024-01-32 00:00:00": NOW,
        "2024-01-00 00:00:00": NOW,
        "2024-13-01 00:00:00": NOW,
        "2024-01-01 00:60:00": NOW,
        "2024-01-01T00:00:00": NOW,
        "2024-01-01": NOW,
        "2024-03-10 02:30:00": at(2024, 3, 10, 2, 30),
        " 2024-01-01 00:00:00": NOW,
        "garbage": NOW,
        "": NOW,
        None: NOW,
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in cases], "t string")
        now = F.timestamp_millis(F.lit(NOW))
        rows = df.select("t", F.unix_millis(fn.parse_event_time("t", now)).alias("ms")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r.t: r.ms for r in rows} == cases


def test_parse_event_time_seconds(spark):
    cases = {
        "2024-01-01 00:00:00": BASE,
        "2024-01-01 00:00:07.999": BASE + 7_000,
        "2024-1-1 0:0:7": BASE + 7_000,
        "2024-01-01 00:00:00.": BASE,
        "2024-02-30 00:00:00": NOW,
        "2024-01-01 24:00:00": NOW,
        "2024-01-01T00:00:00": NOW,
        None: NOW,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    ms = fn.parse_event_time_seconds("t", F.timestamp_millis(F.lit(NOW)))
    assert {r.t: r.ms for r in df.select("t", ms.alias("ms")).collect()} == cases


def test_missing_time_is_now(spark):
    df = spark.createDataFrame([(None,)], "t string")
    row = df.select(
        F.abs(F.unix_millis(fn.parse_event_time("t")) - F.unix_millis(F.current_timestamp()))
    ).first()
    assert row[0] < 60_000


def test_format_cuts_microseconds(spark):
    df = spark.range(1).select(fn.format_event_time(F.timestamp_micros(F.lit(BASE * 1000 + 1_999))))
    assert df.first()[0] == "2024-01-01 00:00:00.001"


def test_labels_and_status(spark):
    df = spark.createDataFrame([(0,), (2,), (3,), (None,)], "n int")
    got = df.select(
        fn.stress_label("n").alias("a"),
        fn.stress_label("n", "-").alias("b"),
        fn.threshold_band("n").alias("c"),
        fn.fallback_status("n").alias("d"),
    ).collect()
    assert [r.a for r in got] == ["No stress", "High stress", "Unknown", "Unknown"]
    assert [r.b for r in got] == ["No stress", "High stress", "-", "-"]
    assert [r.c for r in got] == ["green", "red", "red", "green"]
    assert [r.d for r in got] == ["Normal", "Fallback Active", "Fallback Active", None]


def test_parse_prediction(spark):
    cases = {
        '{"stress_level_prediction": "2"}': 2,
        '{"stress_level_prediction": "2.0"}': 2,
        '{"stress_level_prediction": 1}': 1,
        '{"stress_level_prediction": 1.9}': 1,
        '{"stress_level_prediction": "x"}': None,
        '{"error": "no"}': None,
        "not json": None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    rows = df.select("t", fn.parse_prediction("t").alias("p")).collect()
    assert {r.t: r.p for r in rows} == cases


def test_six_decimals_round_half_up(spark):
    df = spark.createDataFrame([(0.0000005, 1.0)], "a double, b double")
    row = df.select(F.format_string("%f", "a"), fn.wire_value("a"), fn.feature_text(["a", "b"])).first()
    assert row[0] == "0.000001" and row[1] == 0.000001 and row[2] == "a=0.000001&b=1.000000"


def test_validate_inputs(spark):
    rows = [
        (1, "1", "2", "3", "4", "5", "6", None),
        (2, "abc", "2", "3", "4", "5", "6", "lgbm"),
        (3, "1", "2", "3", "4", None, "6", "gb"),
        (4, "1", "2", "3", "4", "5", "6", " GB "),
        (5, "1", "2", "3", "4", "5", "6", "foo"),
        (6, "1d", "2", "3", "4", "5", "6", "gb"),
        (7, " 1e2 ", "2", "3", "nan", "5", "6", "gb"),
    ]
    df = spark.createDataFrame(
        rows, "n int, x string, y string, z string, eda string, hr string, temp string, model string"
    )
    got = {r.n: r for r in filters.validate_inputs(df).collect()}
    assert got[1].error is None and got[1].model == "lgbm"
    assert got[2].error == "Missing or invalid parameter: x"
    assert got[3].error == "Missing or invalid parameter: hr"
    assert got[4].error is None and got[4].model == "gb"
    assert got[5].error == "Unknown model 'foo'. Choose 'lgbm' or 'gb'."
    assert got[6].error == "Missing or invalid parameter: x"
    assert got[7].error is None and got[7].x == 100.0


def test_stable_hash_of_large_keys(spark):
    keys = [0, 1, 2**31, 2**40 + 7, 2**61]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    hashes = [r.h for r in df.select(fn.stable_hash("k").alias("h")).collect()]
    assert all(0 <= h < 2**32 for h in hashes) and len(set(hashes)) == len(keys)

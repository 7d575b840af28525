import pytest
from pyspark.sql import functions as F

from tests.test_operators import monitor, random_checks
from vitalflow import schemas as S
from vitalflow.models import scoring
from vitalflow.models.scoring import RuleModel
from vitalflow.plans import catalog
from vitalflow.session import session_settings
from vitalflow.sources import points as pts
from vitalflow.sources import streams
from vitalflow.streaming import jobs, stateful

RULE = RuleModel(lambda: F.when(F.col("HR") >= 100, 2).otherwise(0))


def records(spark, rows):
    """Records (id, second, HR)."""
    df = spark.createDataFrame(rows, "id string, s double, HR float")
    ts = F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint"))
    other = [F.lit(None).cast("float").alias(c) for c in S.SENSORS if c != "HR"]
    wide = df.select("id", "HR", F.date_format(ts, S.TIME_FORMAT).alias("datetime"), *other)
    return wide.select(*S.SENSOR_RECORD.names)


class Log:
    """A folder that receives one file per call, read by a stream one file at a time."""

    def __init__(self, spark, path):
        self.spark, self.path, self.count = spark, str(path), 0

    def add(self, rows):
        records(self.spark, rows).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        self.count += 1

    def read(self, files=1):
        return streams.read_stream_earliest(self.spark, f"{self.path}/log", S.SENSOR_RECORD, files)

    def averages(self):
        out = jobs.tumbling_average_stream(self.read())
        query = jobs.start_files(out, f"{self.path}/out", f"{self.path}/progress")
        query.awaitTermination()
        rows = self.spark.read.schema(out.schema).parquet(f"{self.path}/out").collect()
        return {(r.id, r.windowStart): r.HR for r in rows}, query


@pytest.mark.parametrize("last, closed", [(10.0, True), (9.999, False)])
def test_window_closes_at_end_plus_delay(spark, tmp_path, last, closed):
    log = Log(spark, tmp_path)
    log.add([("a", 1.0, 80.0), ("a", last, 90.0)])
    got, _ = log.averages()
    assert got == ({("a", 0): 80.0} if closed else {})


def test_silent_person_does_not_hold_back_others(spark, tmp_path):
    log = Log(spark, tmp_path)
    log.add([("quiet", 1.0, 70.0), ("a", 1.0, 80.0)])
    log.add([("a", 11.0, 90.0)])
    got, _ = log.averages()
    assert got == {("quiet", 0): 70.0, ("a", 0): 80.0}


def test_late_rows_are_dropped_one_batch_later(spark, tmp_path):
    log = Log(spark, tmp_path)
    batches = [[1.0, 10.0], [4.0, 5.5], [4.9, 30.0], [40.0]]
    for times in batches:
        log.add([("a", t, t) for t in times])
    got, query = log.averages()
    assert got[("a", 0)] == 2.5 and got[("a", 5000)] == 5.5 and got[("a", 10000)] == 10.0
    dropped = sum(
        op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators
    )
    assert dropped == 1


def test_numbered_batches_over_micro_batches_are_averaged_once(spark, tmp_path):
    log = Log(spark, tmp_path)
    log.add([("a", 1.0, 80.0), ("a", 2.0, 90.0), ("a", 11.0, 60.0)])
    log.add([("a", 12.0, 70.0), ("a", 21.0, 50.0)])
    log.add([("a", 22.0, 70.0)])
    batch = F.floor(F.unix_seconds(F.to_timestamp("datetime")) / 10).cast("bigint")
    path, open_path = str(tmp_path / "points"), str(tmp_path / "open")
    run = jobs.start_fallback(
        log.read(), RULE, path, str(tmp_path / "progress"), batch, open_path=open_path
    )
    run.awaitTermination()
    jobs.finish_fallback(spark, RULE, path, open_path, run.lastProgress["batchId"])
    got = sorted((r.time_ms, r.HR) for r in pts.read_points(spark, path).collect())
    assert got == [(2_000, 85.0), (12_000, 65.0), (22_000, 60.0)]
    with pytest.raises(ValueError):
        jobs.start_fallback(log.read(), RULE, path, str(tmp_path / "other"), batch)


def test_stop_and_restart_loses_and_repeats_nothing(spark, tmp_path):
    log = Log(spark, tmp_path)
    log.add([("a", 1.0, 80.0), ("a", 2.0, 100.0)])
    first, _ = log.averages()
    assert first == {}
    log.add([("a", 3.0, 60.0), ("a", 20.0, 50.0)])
    second, _ = log.averages()
    assert second == {("a", 0): 80.0}
    log.add([("a", 40.0, 50.0)])
    third, _ = log.averages()
    assert third == {("a", 0): 80.0, ("a", 20000): 50.0}


def test_primary_and_fallback_write_one_table(spark, tmp_path):
    log = Log(spark, tmp_path)
    log.add([("a", 1.0, 120.0), ("b", 2.0, 80.0), (None, 2.0, 80.0), ("a", 20.0, 70.0)])
    path = str(tmp_path / "points")
    jobs.start_primary(log.read(), RULE, path, str(tmp_path / "p1")).awaitTermination()
    jobs.start_fallback(log.read(), RULE, path, str(tmp_path / "p2")).awaitTermination()
    got = {(r.source, r.id): (r.time_ms, r.HR, r.stress_level) for r in pts.read_points(spark, path).collect()}
    assert got == {
        ("primary", "a"): (4_999, 120.0, 2),
        ("primary", "b"): (4_999, 80.0, 0),
        ("fallback", "a"): (20_000, 95.0, 0),
        ("fallback", "b"): (2_000, 80.0, 0),
    }


def test_latest_reader_skips_older_files(spark, tmp_path):
    log = Log(spark, tmp_path)
    log.add([("a", 1.0, 80.0)])
    there = spark.read.parquet(f"{tmp_path}/log").select("_metadata.file_modification_time")
    started = there.agg(F.max(F.unix_millis("file_modification_time"))).first()[0]
    names = spark.read.parquet(f"{tmp_path}/log").select("_metadata.file_path").distinct()
    seen = [r.file_path for r in names.collect()]
    log.add([("a", 2.0, 81.0)])
    stream = streams.read_stream_latest_bounded(
        spark, f"{tmp_path}/log", S.SENSOR_RECORD, started, there=seen
    )
    jobs.start_files(stream, f"{tmp_path}/out", f"{tmp_path}/progress").awaitTermination()
    assert [r.HR for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [81.0]


def test_mode_state_survives_restarts(spark, tmp_path):
    import random

    rng = random.Random(3)
    checks = {k: random_checks(rng, 60) for k in ("p", "q")}
    schema = "pipeline string, seq int, healthy boolean, latency_s double"
    for lo, hi in ((0, 7), (7, 30), (30, 60)):
        rows = [
            (k, i, *checks[k][i]) for k in checks for i in range(lo, hi) if k == "p" or lo != 7
        ]
        df = spark.createDataFrame(rows, schema).coalesce(1)
        df.write.mode("append").parquet(f"{tmp_path}/log")
        stream = streams.read_stream_earliest(spark, f"{tmp_path}/log", df.schema, 1)
        modes = stateful.fallback_state_stream(stream)
        jobs.start_files(modes, f"{tmp_path}/rows", f"{tmp_path}/progress").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/rows").collect()
    kept_q = [c for i, c in enumerate(checks["q"]) if not 7 <= i < 30]
    places_q = [i for i in range(60) if not 7 <= i < 30]
    want = {("p", i): s for i, s in enumerate(monitor(checks["p"]))}
    want.update({("q", i): s for i, s in zip(places_q, monitor(kept_q))})
    assert {(r.pipeline, r.seq): (r.was_fallback, r.in_fallback, r.violation_count) for r in got} == want


def test_remote_scoring_keeps_order_and_defaults(spark):
    def ask(request, timeout_s):
        import time

        hr = float(request.split("hr=")[1].split("&")[0])
        if hr == 3:
            raise ConnectionError("refused")
        if hr == 5:
            time.sleep(1.0)
        return f'{{"stress_level_prediction": "{int(hr) % 3}.0"}}'

    rows = [(float(i), 1.0, 1.0, 1.0, float(i), 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in S.SENSORS)).coalesce(1)
    got = scoring.score_remote(df, ask, timeout_s=0.3, attempts=2, default=1).collect()
    assert [r.X for r in got] == [float(i) for i in range(40)]
    assert [r.stress_level for r in got] == [1 if i in (3, 5) else i % 3 for i in range(40)]
    with pytest.raises(Exception, match="refused"):
        scoring.score_remote(df, ask).collect()


def test_stuck_calls_hold_up_no_others(spark):
    def ask(request, timeout_s):
        import time

        hr = int(float(request.split("hr=")[1].split("&")[0]))
        if hr < 15:  # fewer than there are places
            time.sleep(20)
        return f'{{"stress_level_prediction": "{hr % 2 * 2}"}}'

    rows = [(1.0, 1.0, 1.0, 1.0, float(i), 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in S.SENSORS)).coalesce(1)
    got = scoring.score_remote(df, ask, timeout_s=1.0, in_flight=20, default=1).collect()
    want = {i: 1 if i < 15 else i % 2 * 2 for i in range(60)}
    assert {int(r.HR): r.stress_level for r in got} == want


def test_no_more_calls_live_than_there_are_places():
    import threading
    import time

    alive, most, lock, over = [0], [0], threading.Lock(), threading.Event()

    def ask(request, timeout_s):
        with lock:
            alive[0] += 1
            most[0] = max(most[0], alive[0])
        over.wait(30)
        with lock:
            alive[0] -= 1
        return "late"

    start = time.monotonic()
    told = scoring._ordered_calls(ask, [str(i) for i in range(400)], 0.3, 20, 1, True)
    over.set()
    assert told == [None] * 400 and most[0] == 20 and time.monotonic() - start < 15
    with pytest.raises(TimeoutError):
        over.clear()
        scoring._ordered_calls(ask, ["a", "b"], 0.1, 1, 1, False)
    over.set()


def test_late_calls_do_not_add_up():
    """The calls behind a late one are made while it lasts, so twenty late ones take the time of few."""
    import time

    def ask(request, timeout_s):
        if int(request) % 20 == 0:
            time.sleep(3 * timeout_s)
        return request

    start = time.monotonic()
    told = scoring._ordered_calls(ask, [str(i) for i in range(400)], 0.4, 20, 1, True)
    assert told == [None if i % 20 == 0 else str(i) for i in range(400)]
    assert time.monotonic() - start < 4  # a second or two; 20 x 0.4 one after the other


def test_calls_wait_for_a_place_that_comes_free():
    import time

    def ask(request, timeout_s):
        if int(request) < 8:
            time.sleep(3 * timeout_s)
        return request

    told = scoring._ordered_calls(ask, [str(i) for i in range(40)], 0.3, 4, 1, True)
    assert told == [None] * 8 + [str(i) for i in range(8, 40)]


def test_late_calls_keep_their_places_for_the_next_rows(spark):
    """However few rows come at a time, in their order, and with no more calls than places."""
    rows = [(float(i), 1.0, 1.0, 1.0, float(i), 1.0) for i in range(120)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in S.SENSORS)).coalesce(1)
    alive = []

    def ask(request, timeout_s):
        import time

        hr = int(float(request.split("hr=")[1].split("&")[0]))
        alive.append(hr)
        try:
            if len(alive) > 6:
                raise ConnectionError("too many")
            if hr % 15 == 0:
                time.sleep(3 * timeout_s)
            return f'{{"stress_level_prediction": "{hr % 2 * 2}"}}'
        finally:
            alive.remove(hr)

    with session_settings(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": "10"}):
        got = scoring.score_remote(df, ask, timeout_s=0.5, in_flight=6, default=1).collect()
    assert [r.X for r in got] == [r[0] for r in rows]
    assert [r.stress_level for r in got] == [1 if i % 15 == 0 else i % 2 * 2 for i in range(120)]


def test_count_or_time_trigger():
    assert streams.count_or_time_trigger() == {
        "max_offsets": 1000, "min_offsets": 1000, "max_delay": "30s",
    }


def test_parts_stay_micro_batches_and_widen_with_the_input(spark, tmp_path):
    # parts of 800, 800, 1, no, 800 and 3 rows, and what is in none
    part = F.expr("case when id < 800 then 0 when id < 1600 then 1 when id = 1600 then 2"
                  " when id < 2401 then 4 when id < 2404 then 5 else 9 end")
    rows = spark.range(0, 2_500, 1, 32)
    stream = catalog.in_parts(rows.repartition(32), part, "widths")
    run = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c")
    run = run.trigger(availableNow=True).start()
    run.awaitTermination()
    assert [p["numInputRows"] for p in run.recentProgress][:6] == [800, 800, 1, 0, 800, 3]
    logs = sorted((tmp_path / "c" / "sources" / "0").glob("[0-9]*"))  # one line a file, after the version
    files = [len(log.read_text().splitlines()) - 1 for log in logs]
    assert len(files) == 6 and len(set(files)) == 1 and files[0] > 2

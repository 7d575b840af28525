"""Keyed state on streams: batches, modes, histories, and the join of points and modes."""

import random
import time
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.test_operators import monitor, random_checks
from vitalflow import schemas as S
from vitalflow.models.scoring import RuleModel
from vitalflow.operators import control
from vitalflow.plans import catalog
from vitalflow.plans import datasets as data
from vitalflow.session import session_settings
from vitalflow.sources import points as pts
from vitalflow.sources import streams
from vitalflow.streaming import jobs, stateful

LOG = "part int, seq long, arrival_ms long, HR double, note string"


def batches_by_hand(arrivals, size, wait):
    """(batch, closed_by) of each record in order; None for those of a batch that is still open."""
    out, start, number = [], 0, 0
    while start < len(arrivals):
        end = start
        while end < len(arrivals) and end - start < size and arrivals[end] <= arrivals[start] + wait:
            end += 1
        full = end - start == size
        open_ = not full and end == len(arrivals)
        out += [(number, None if open_ else "count" if full else "time")] * (end - start)
        start, number = end, number + 1
    return out


def run(stream, tmp_path, name="out"):
    query = jobs.start_files(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-progress")
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{tmp_path}/{name}").collect(), query


def test_batches_do_not_depend_on_micro_batches(spark, tmp_path):
    rng, now, rows = random.Random(4), 0, []
    for i in range(400):
        now += rng.choice([0, 1, 5, 40]) if i % 100 < 70 else rng.choice([0, 300])
        rows.append((i % 3, i, now, None if i % 7 == 0 else i / 3, None if i % 5 else "ü"))
    now += 5_000
    rows.append((9, 400, now, 1.0, "end"))
    for lo in range(0, 401, 67):
        part = spark.createDataFrame(rows[lo : lo + 67], LOG)
        part = part.withColumn("at", F.timestamp_millis("arrival_ms")).orderBy(F.rand(lo)).coalesce(1)
        part.write.mode("append").parquet(f"{tmp_path}/log")
        stream = streams.read_stream_earliest(spark, f"{tmp_path}/log", part.schema, 1)
        collected = stateful.collect_batches(
            stream, ["part"], ["arrival_ms", "seq"], "arrival_ms", "at", size=10, wait_ms=250, delay="1 millisecond"
        )
        got, _ = run(collected, tmp_path)  # a restart after every file
    want = {}
    for p in range(3):
        mine = [r for r in rows if r[0] == p]
        for row, told in zip(mine, batches_by_hand([r[2] for r in mine], 10, 250)):
            # the last record of the log lets time pass for the others
            want[row[1]] = (told[0], told[1] or "time", row[3], row[4])
    assert {r.seq: (r.batch, r.closed_by, r.HR, r.note) for r in got} == want
    assert {w[1] for w in want.values()} == {"count", "time"} and len(got) == 400


def test_rows_reach_a_key_in_packs(spark):
    """A row at a time costs some twenty microseconds in Python, and a log may have one partition."""
    rows = [(None if i % 3 == 2 else i % 3, i, i, None if i % 7 == 0 else i / 3, "ü") for i in range(900)]
    log = spark.createDataFrame(rows, LOG).withColumn("at", F.timestamp_millis("arrival_ms")).repartition(2)
    packs = stateful._packed(log, ["part"], "at")
    told = packs.collect()
    assert len(told) <= 6 and {r.part for r in told} == {0, 1, None}
    for r in told:
        inside = stateful._from_packs([r._pack]).to_pylist()
        assert {x["part"] for x in inside} == {r.part} and max(x["arrival_ms"] for x in inside) == r.at.timestamp() * 1000
    back = stateful._unpacked(packs, log.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, log.collect()))


def test_batches_of_one_key_follow_the_rule_for_any_times():
    """Also where times go down along the log, over calls that leave batches open."""

    class Kept:
        def __init__(self):
            self.rows, self.timers = [], set()

        def getListState(self, name, schema):  # noqa: N802
            return self

        def getValueState(self, name, schema):  # noqa: N802
            return Head()

        def appendValue(self, row):  # noqa: N802
            self.rows.append(row)

        def get(self):
            return iter(self.rows)

        def clear(self):
            self.rows = []

        def registerTimer(self, at):  # noqa: N802
            self.timers.add(at)

        def deleteTimer(self, at):  # noqa: N802
            self.timers.discard(at)

    class Head:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    rng = random.Random(5)
    times = [rng.randrange(50) + 10 * (i // 7) for i in range(300)]
    want = batches_by_hand(times, 6, 25)
    collector, kept, got = stateful._Collector(["n"], "at", 6, 25), Kept(), {}
    collector.init(kept)
    for lo in range(0, 300, 17):
        part = [{"n": i, "at": times[i]} for i in range(lo, min(lo + 17, 300))]
        rng.shuffle(part)
        packs = [{"_pack": stateful._as_pack(pa.Table.from_pylist(part[k:k + 5]))} for k in range(0, len(part), 5)]
        for row in collector.handleInputRows((0,), iter(packs), None):
            got |= {r["n"]: (r["batch"], r["closed_by"]) for r in stateful._from_packs([row[0]]).to_pylist()}
        assert len(kept.timers) <= 1
    assert got == {i: w for i, w in enumerate(want) if w[1]} and len(got) > 290
    assert {w[1] for w in want} >= {"count", "time"}


def test_live_batches_close_by_count_or_by_the_clock(spark, tmp_path):
    schema = "part string, seq long, id string, " + ", ".join(f"{c} double" for c in S.SENSORS)
    rows = [("p", i, "N", *[1.0 * i] * 6) for i in range(25)] + [("q", 100, "M", *[2.0] * 6)]
    frame = spark.createDataFrame(rows, schema).coalesce(1)
    frame.write.parquet(f"{tmp_path}/log")
    stream = streams.read_stream_earliest(spark, f"{tmp_path}/log", frame.schema)
    collected = stateful.collect_batches(stream, ["part"], ["seq"], size=10, wait_ms=3_000)
    query = (
        collected.writeStream.format("memory").queryName("live").outputMode("append")
        .option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="500 milliseconds").start()
    )
    try:
        until = time.time() + 60
        while time.time() < until and spark.table("live").count() < 26:
            time.sleep(0.3)
        got = {(r.part, r.batch, r.closed_by): r.n for r in spark.table("live").groupBy("part", "batch", "closed_by").agg(F.count("*").alias("n")).collect()}
    finally:
        query.stop()
    assert got == {("p", 0, "count"): 10, ("p", 1, "count"): 10, ("p", 2, "time"): 5, ("q", 0, "time"): 1}


def test_collected_batches_become_points_once(spark, tmp_path):
    schema = "part int, seq long, id string, arrival_ms long, datetime string, "
    schema += ", ".join(f"{c} double" for c in S.SENSORS)
    rule = RuleModel(lambda: F.when(F.col("HR") >= 100, 2).otherwise(0))
    for k in range(3):
        rows = [(0, i, "N", 5_000 + i * 100, "2024-01-01 00:00:00.000", *[float(i)] * 6) for i in range(k * 8, k * 8 + 8)]
        part = spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_millis("arrival_ms")).coalesce(1)
        part.write.mode("append").parquet(f"{tmp_path}/log")
    stream = streams.read_stream_earliest(spark, f"{tmp_path}/log", part.schema, 1)
    jobs.start_collected_fallback(
        stream, rule, f"{tmp_path}/points", f"{tmp_path}/c", ["part"], ["seq"],
        time_ms="arrival_ms", event_time="at", size=10, wait_ms=60_000,
    ).awaitTermination()
    got = pts.read_points(spark, f"{tmp_path}/points").collect()
    assert sorted(r.HR for r in got) == [4.5, 14.5]  # the third batch is still open


def test_monitor_starts_from_a_table_and_its_state_can_be_read(spark, tmp_path):
    rng = random.Random(8)
    checks = {k: random_checks(rng, 40) for k in ("p", "q", "r")}
    schema = "pipeline string, seq int, healthy boolean, latency_s double"
    rows = [(k, i, *checks[k][i]) for k in checks for i in range(40)]
    df = spark.createDataFrame(rows, schema)
    df.repartition(5).write.parquet(f"{tmp_path}/log")
    initial = spark.createDataFrame(
        [("p", True, 0), ("q", False, 2)], "pipeline string, in_fallback boolean, violation_count long"
    )
    stream = streams.read_stream_earliest(spark, f"{tmp_path}/log", df.schema)
    got, _ = run(stateful.fallback_state_stream(stream, initial), tmp_path, "modes")
    # breaches before the first check bring a machine to where the table starts it
    before = {"p": 3, "q": 2, "r": 0}
    want = {}
    for k, n in before.items():
        told = monitor([(False, None)] * n + checks[k])[n:]
        want |= {(k, i): s for i, s in enumerate(told)}
    assert {(r.pipeline, r.seq): (r.was_fallback, r.in_fallback, r.violation_count) for r in got} == want
    state = {r.pipeline: (r.in_fallback, r.violation_count) for r in stateful.mode_state(spark, f"{tmp_path}/modes-progress").collect()}
    assert state == {k: want[k, 39][1:] for k in checks}


def test_history_keeps_sixty_readings_a_person(spark, tmp_path):
    rows = [("a", i, None if i % 9 == 0 else float(i), float(i), None, 1.0) for i in range(150)]
    rows += [("b", i, None, 1.0, None, 1.0) for i in range(3)]
    schema = "id string, seq long, HR double, TEMP double, EDA double, Z double"
    for lo, hi in ((0, 70), (70, 150)):
        part = spark.createDataFrame([r for r in rows if lo <= r[1] < hi], schema).orderBy(F.rand(1)).coalesce(1)
        part.write.mode("append").parquet(f"{tmp_path}/log")
    stream = streams.read_stream_earliest(spark, f"{tmp_path}/log", part.schema, 1)
    got, query = run(stateful.history_stream(stream), tmp_path, "history")
    told = {(r.id, r.seq): r for r in got}
    for i in range(150):
        ring = [r for r in rows if r[0] == "a" and i - 60 < r[1] <= i and r[2] is not None]
        r = told["a", i]
        assert r.n_history == len(ring)
        if ring:
            assert r.mean_TEMP == pytest.approx(sum(x[3] for x in ring) / len(ring))
            assert r.delta_TEMP == pytest.approx(i - r.mean_TEMP)
        assert (r.delta_HR is None) == (i % 9 == 0 or not ring) and r.mean_EDA is None
    assert told["b", 2].n_history == 0 and told["b", 2].mean_TEMP is None
    state = spark.read.format("statestore").option("stateVarName", "ring").load(f"{tmp_path}/history-progress")
    assert {r.id: r.n for r in state.groupBy(F.col("key.id").alias("id")).agg(F.count("*").alias("n")).collect()} == {"a": 60, "b": 3}


def test_keyed_state_starts_in_a_session_with_another_state_store(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    rows = [("p", i, False, None) for i in range(S.VIOLATIONS)] + [("q", 0, True, 1.0)]
    schema = "pipeline string, seq int, healthy boolean, latency_s double"
    with session_settings(spark, **{provider: other}):
        for k in range(2):
            part = spark.createDataFrame([r for r in rows if r[1] % 2 == k], schema).coalesce(1)
            part.write.mode("append").parquet(f"{tmp_path}/log")
            stream = streams.read_stream_earliest(spark, f"{tmp_path}/log", part.schema, 1)
            modes = stateful.fallback_state_stream(stream)
            jobs.start_files(modes, f"{tmp_path}/m", f"{tmp_path}/c", keyed=True).awaitTermination()
            assert spark.conf.get(provider) == other
        state = {tuple(r) for r in stateful.mode_state(spark, f"{tmp_path}/c").collect()}
    assert state == {("p", True, 0), ("q", False, 0)}


@pytest.fixture(scope="module")
def partly_dated(spark, tmp_path_factory):
    """Events of two persons and pipelines; every fifth has no time, and some of them start a fallback."""
    sf = str(tmp_path_factory.mktemp("partly-dated"))
    start = datetime(2023, 12, 31, 23)  # before the first second of the given tables
    rows = [
        (k, None if k % 5 == 0 else start + timedelta(minutes=3 * k), k % 2, "ab"[k % 2],
         40.0 if k in (6, 8, 10, *range(31, 36)) else 7.0 if k < 70 else 4.0 + k % 7, '{"k": 5}')
        for k in range(140)
    ]
    spark.createDataFrame(rows, data.EVENTS).repartition(3).write.parquet(f"{sf}/events.parquet")
    return sf


def test_history_keeps_readings_without_a_time(spark, partly_dated):
    got = {r.seq: r.n_history for r in catalog.history_stream(spark, partly_dated).collect()}
    readings = data.sensors(spark, partly_dated).select("id", "us", "seq").collect()
    want = {}
    for person in {r.id for r in readings}:
        own = sorted((r for r in readings if r.id == person), key=lambda r: (r.us is None, r.us or 0, r.seq))
        want |= {r.seq: min(k + 1, S.HISTORY) for k, r in enumerate(own)}
    assert got == want and len(want) == 140


def test_monitor_counts_checks_without_a_time(spark, partly_dated):
    table = catalog.fallback_state(spark, partly_dated)
    got = catalog.fallback_state_stream(spark, partly_dated)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, table.collect()))
    assert table.count() == 140 and table.filter("in_fallback").count() > 0
    last = table.groupBy("pipeline").agg(F.max_by("in_fallback", "seq"), F.max_by("violation_count", "seq"))
    state = catalog.mode_state(spark, partly_dated)
    assert sorted(map(tuple, state.collect())) == sorted(map(tuple, last.collect()))


def test_stretches_come_from_all_checks(spark, partly_dated, monkeypatch):
    seen, in_parts = [], catalog.in_parts

    def kept(rows, part, name):
        if name == "stretches":
            seen.extend(rows.collect())
        return in_parts(rows, part, name)

    monkeypatch.setattr(catalog, "in_parts", kept)
    catalog.dual_path_stream(spark, partly_dated)
    one = data.checks(spark, partly_dated).withColumn("pipeline", F.lit("all"))
    rows = sorted(control.fallback_state(one).collect(), key=lambda r: r.seq)
    want = [(a.check_us, b.check_us, a.in_fallback) for a, b in zip(rows, rows[1:], strict=False)]
    assert sorted(((r.from_us, r.until_us, r.in_fallback) for r in seen), key=str) == sorted(want, key=str)


def test_modes_of_many_checks_are_those_of_one_after_the_other():
    rng = random.Random(3)
    for _ in range(200):
        told = monitor(checks := random_checks(rng, 60))
        healthy = np.array([bool(h) for h, _ in checks])
        lag = np.array([np.nan if x is None else x for _, x in checks], dtype=float)
        late = lag > S.LAG_LIMIT_S
        breach, reset = ~healthy | late, healthy & ~late & ~np.isnan(lag)
        stop = healthy & (lag != 0) & (lag < S.LAG_LIMIT_S * S.RESUME_SHARE)
        active, count, got = False, 0, []
        for lo in range(0, 60, 13):
            part = slice(lo, lo + 13)
            modes, count = stateful._modes(breach[part], reset[part], stop[part], active, count, S.VIOLATIONS)
            active = bool(modes[-1])
            got += modes.tolist()
            assert count == told[len(got) - 1][2]
        assert got == [t[1] for t in told]


def test_points_meet_stretches_of_any_length(spark):
    """Each once, and only those of about their time, however many there are in a minute."""
    rng = random.Random(6)
    points = [(n, 5_000_000 + rng.randrange(900_000)) for n in range(400)]
    lengths = (1, 40, 99, 100, 101, 700, 1_999, 2_000, 2_001, 30_000, 60_000, 60_001, 400_000)
    stretches = []
    for length in lengths * 6:
        at = 5_000_000 + rng.randrange(900_000)
        stretches.append((1_000 * at, 1_000 * (at + length), rng.random() < 0.8))
    sides = (
        spark.createDataFrame(points, "n int, time_ms long"),
        spark.createDataFrame(stretches, "from_us long, until_us long, in_fallback boolean"),
    )
    got = sorted(r.n for r in stateful.points_in_fallback(*sides).collect())
    want = sorted(n for n, at in points for a, b, on in stretches if on and a // 1_000 <= at < b // 1_000)
    assert got == want and len(want) > 400
    close = [(1_000 * at, 1_000 * (at + 30), True) for at in range(5_000_000, 5_060_000, 30)]
    many = spark.createDataFrame([(at, at) for at in range(5_000_000, 5_060_000, 30)], "n int, time_ms long")
    joined = stateful.points_in_fallback(many, spark.createDataFrame(close, sides[1].schema))
    assert joined.count() == 2_000
    # of four million pairs of that minute, those of equal buckets are compared
    keys = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_size" in keys and stateful.JOIN_BUCKETS_MS[0] <= 100


def test_points_wait_for_their_stretch_and_are_let_go(spark, tmp_path):
    # a stream takes rows of time 0 for late ones: its watermark starts there
    points = [(i, 1_000 * i) for i in range(10, 2_010, 10)]
    stretches = [(1_000_000 * i, 1_000_000 * (i + 60), i % 240 == 0) for i in range(0, 1_980, 60)]
    for k in range(8):
        lo, hi = 260_000 * k, 260_000 * (k + 1)
        mine = spark.createDataFrame([p for p in points if lo <= p[1] < hi], "n int, time_ms long")
        mine.coalesce(1).write.mode("append").parquet(f"{tmp_path}/points")
        # stretches come 260 seconds after their points
        ended = [s for s in stretches if lo - 260_000 <= s[1] // 1_000 < hi - 260_000 or (k == 7 and s[1] // 1_000 >= lo - 260_000)]
        told = spark.createDataFrame(ended, "from_us long, until_us long, in_fallback boolean")
        told.coalesce(1).write.mode("append").parquet(f"{tmp_path}/stretches")
    joined = stateful.points_in_fallback(
        streams.read_stream_earliest(spark, f"{tmp_path}/points", mine.schema, 1),
        streams.read_stream_earliest(spark, f"{tmp_path}/stretches", told.schema, 1),
        longest_s=60,
    )
    got, query = run(joined, tmp_path, "joined")
    want = [n for n, at in points if any(a // 1_000 <= at < b // 1_000 and on for a, b, on in stretches)]
    assert sorted(r.n for r in got) == want and want
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert held[-1] < 60  # of 200 points

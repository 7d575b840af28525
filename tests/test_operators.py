import random

import pytest
from pyspark.sql import functions as F

from vitalflow import schemas as S
from vitalflow.operators import aggregates, batching, control, filters, metrics, timeseries, windows
from vitalflow.operators.ordered import in_runs, position, running_before, top_per_key


def readings(spark, rows):
    """Rows (id, second, HR) with all other sensors missing."""
    df = spark.createDataFrame(rows, "id string, s double, HR double")
    for c in S.SENSORS:
        if c != "HR":
            df = df.withColumn(c, F.lit(None).cast("double"))
    us = (F.col("s") * 1_000_000).cast("bigint")
    ts = F.timestamp_micros(us)
    return df.withColumn("ts", ts).withColumn("datetime", F.date_format(ts, S.TIME_FORMAT))


def test_two_averages_differ_on_missing(spark):
    df = readings(spark, [("a", 1.0, 80.0), ("a", 2.0, None), ("a", 3.0, 100.0)])
    one = aggregates.window_average(df).first()
    assert one.HR == 60.0 and one.X == 0.0
    assert (one.windowStart, one.windowEnd, one.datetime) == (0, 5000, 4999)
    two = aggregates.batch_average(df.withColumn("batch", F.lit(0))).first()
    assert two.HR == 90.0 and two.X is None


def test_nan_counts_as_missing_in_batches_only(spark):
    df = readings(spark, [("a", 1.0, 80.0), ("a", 2.0, float("nan"))])
    assert aggregates.batch_average(df.withColumn("batch", F.lit(0))).first().HR == 80.0


def test_rows_without_id_are_rejected(spark):
    df = readings(spark, [("a", 1.0, 80.0), (None, 1.0, 70.0)])
    assert [r.id for r in aggregates.window_average(df).collect()] == ["a"]
    assert [r.id for r in aggregates.batch_average(df.withColumn("batch", F.lit(0))).collect()] == ["a"]
    valid, rejects = filters.split_rejects(df)
    assert valid.count() == 1 and rejects.first().HR == 70.0


@pytest.fixture(params=[1, 3, 40])
def parted(spark, request):
    """Shuffles into so many partitions, none of them joined afterwards."""
    wanted = {
        "spark.sql.shuffle.partitions": str(request.param),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def test_running_fold_matches_plain_loop(spark, parted):
    rng = random.Random(parted)
    keys = ["a", "b", None, *"cdefgh"]
    rows = [(rng.choice(keys), i, rng.choice([None, *range(-5, 6)])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, n int, v int").repartition(5)
    got = running_before(
        df, ["k"], ["n"],
        total=("sum", F.col("v")), top=("max", F.col("v")), low=("min", F.col("v")),
    ).collect()
    seen = {k: [] for k in keys}
    want = {}
    for k, n, v in rows:
        past = seen[k]
        want[n] = (sum(past), max(past, default=None), min(past, default=None))
        past += [v] if v is not None else []
    assert {r.n: (r.total, r.top, r.low) for r in got} == want


def test_position_without_keys(spark):
    df = spark.range(1000).withColumn("t", F.col("id") * 3).repartition(4)
    assert position(df, [], ["t"], "pos").filter("pos != id").count() == 0
    assert position(df.limit(0), [], ["t"], "pos").count() == 0


def test_far_off_order_value_leaves_partitions_even(spark):
    t = F.when(F.col("id") == 0, 0).otherwise(1_700_000_000_000 + F.col("id"))
    df = spark.range(20_000).withColumn("t", t)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = in_runs(df, [], ["t"], lambda columns, starts: {}, [])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sizes = [r["count"] for r in rows.groupBy("_part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_top_per_key_keeps_exact_rows(spark):
    rows = [("hot", i) for i in range(3000)] + [("cold", i) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(8)
    got = top_per_key(df, ["k"], [F.col("n").desc()], 60).collect()
    assert sorted(r.n for r in got if r.k == "hot") == list(range(2940, 3000))
    assert sorted(r.n for r in got if r.k == "cold") == list(range(5))


def monitor(checks, limit=300.0, needed=3):
    """The monitor's rules, one check after the other."""
    active, count, out = False, 0, []
    for healthy, lag in checks:
        before = active
        if not active:
            if not healthy:
                count += 1
            elif lag is None:
                out.append((before, active, count))
                continue
            elif lag > limit:
                count += 1
            else:
                count = 0
            if count >= needed:
                active, count = True, 0
        elif healthy and lag and lag < limit * 0.5:
            active = False
        out.append((before, active, count))
    return out


def random_checks(rng, n):
    return [
        (rng.random() < 0.6, rng.choice([None, 0.0, 10.0, 149.0, 150.0, 200.0, 300.0, 301.0, 900.0]))
        for _ in range(n)
    ]


def test_fallback_state_matches_rules(spark, parted):
    rng = random.Random(parted)
    rows, want = [], {}
    for key in ("p", "q", "r"):
        checks = random_checks(rng, 150)
        rows += [(key, i, h, lag) for i, (h, lag) in enumerate(checks)]
        want.update({(key, i): s for i, s in enumerate(monitor(checks))})
    df = spark.createDataFrame(rows, "pipeline string, seq int, healthy boolean, latency_s double")
    got = control.fallback_state(df.repartition(4)).collect()
    assert {
        (r.pipeline, r.seq): (r.was_fallback, r.in_fallback, r.violation_count) for r in got
    } == want


def test_fallback_state_named_cases(spark):
    def final(checks):
        rows = [("p", i, h, lag) for i, (h, lag) in enumerate(checks)]
        df = spark.createDataFrame(rows, "pipeline string, seq int, healthy boolean, latency_s double")
        return control.fallback_state(df).orderBy(F.col("seq").desc()).first()

    down = [(False, None)] * 3
    assert final(down).in_fallback
    assert final([(True, 301.0), (True, None), (False, None), (True, None), (True, 400.0)]).in_fallback
    assert final([(False, None), (False, None), (True, 10.0), (False, None)]).violation_count == 1
    assert final(down + [(True, 0.0)]).in_fallback
    assert final(down + [(True, 150.0)]).in_fallback
    assert not final(down + [(True, 149.0)]).in_fallback
    assert final([(True, 300.0)] * 5).violation_count == 0


def test_violation_runs_and_timeline(spark, parted):
    rng = random.Random(5)
    checks = random_checks(rng, 200)
    rows = [("p", i, i * 60_000_000, h, lag) for i, (h, lag) in enumerate(checks)]
    df = spark.createDataFrame(
        rows, "pipeline string, seq int, check_us long, healthy boolean, latency_s double"
    )
    run, want = 0, {}
    for i, (healthy, lag) in enumerate(checks):
        if not healthy or (lag is not None and lag > 300):
            run += 1
        elif lag is not None:
            run = 0
        want[i] = run
    got = control.violation_runs(df).collect()
    assert {r.seq: r.run for r in got} == want

    states = monitor(checks)
    changes = [i for i, (before, after, _) in enumerate(states) if before != after]
    timeline = control.mode_timeline(control.fallback_state(df))
    lines = sorted(timeline.collect(), key=lambda r: r.seq)
    assert [r.seq for r in lines] == changes
    assert [r.change for r in lines[:2]] == ["TRIGGER", "RESUME"]
    ends = [i * 60_000_000 for i in changes[1:]] + [None]
    assert [r.until_us for r in lines] == ends


def test_dual_path_keeps_fallback_points_of_fallback_time(spark):
    def points(source, times):
        rows = [(S.POINT_MEASUREMENT, "a", source, t, *[1.0] * 6, 1) for t in times]
        return spark.createDataFrame(rows, S.POINT)

    timeline = spark.createDataFrame(
        [("TRIGGER", 10_000_000), ("RESUME", 20_000_000)], "change string, from_us long"
    )
    both = control.dual_path_points(
        points("primary", [1, 15_000]), points("fallback", [9_999, 10_000, 19_999, 20_000]), timeline
    )
    assert sorted((r.source, r.time_ms) for r in both.collect()) == [
        ("fallback", 10_000), ("fallback", 19_999), ("primary", 1), ("primary", 15_000),
    ]


def test_disagreement_log_cap_and_carry(spark):
    rows = [("a", i, 0, 1) for i in range(12)] + [("b", 0, 0, 0), ("b", 1, 0, 2), ("c", 0, 1, 1)]
    df = spark.createDataFrame(rows, "id string, time_ms int, pred_lgbm int, pred_gb int")
    log = windows.disagreement_log(df).collect()
    assert [(r.id, r.time_ms) for r in log] == [("a", i) for i in range(11, 1, -1)]
    carried = windows.disagreement_log(df, carry_over=True).collect()
    assert sorted((r.id, r.time_ms) for r in carried) == sorted(
        [("a", i) for i in range(11, 1, -1)] + [("b", 1)]
    )
    few = df.filter("id != 'a'")
    assert windows.disagreement_log(few, carry_over=True).count() == 1


def test_fleet_summary_counts_missing_as_agreeing(spark):
    rows = [("a", 1, 2, 2), ("a", 2, None, None), ("b", 1, 2, 1), ("c", 1, 0, None)]
    df = spark.createDataFrame(rows, "id string, time_ms int, pred_lgbm int, pred_gb int")
    row = aggregates.fleet_summary(df).first()
    assert row.asDict() == {"active": 3, "high_pred_lgbm": 1, "high_pred_gb": 0, "agree": 1}


@pytest.mark.parametrize(
    "sizes, want", [((1500, 400), (660, 400)), ((1500, 660), (990, 660)), ((100, 5), (100, 5))]
)
def test_replay_stops_with_the_shorter_file(spark, sizes, want):
    rows = [("A", i) for i in range(sizes[0])] + [("B", i) for i in range(sizes[1])]
    df = spark.createDataFrame(rows, "id string, seq int")
    out = windows.replay_batches(df, 0)
    counts = {r.id: r["count"] for r in out.groupBy("id").count().collect()}
    assert counts == {"A": want[0], "B": want[1]}
    assert out.agg(F.max("clock_us")).first()[0] == (want[0] - 1) * 3_000


def test_split_is_exact_per_class(spark):
    df = spark.range(1003).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") < 700, 0).when(F.col("id") < 900, 1).otherwise(2).alias("label"),
    )
    out = windows.stratified_split(df)
    assert out.count() == 1003
    got = {r.label: r.n for r in out.filter("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()}
    # 802 training rows: 559.7 -> 560, 159.9 -> 160, 82.3 -> 82
    assert got == {0: 140, 1: 40, 2: 21}
    again = windows.stratified_split(df.repartition(7), digit_bits=(3, 2, 4))
    assert out.exceptAll(again).count() == 0
    odd = spark.createDataFrame([(2000, None), (2001, 7)], "seq long, label int")
    more = windows.stratified_split(df.unionByName(odd))
    assert more.count() == 1005 and more.filter("is_test is null").count() == 2
    assert more.filter("is_test").exceptAll(out.filter("is_test")).count() == 0
    assert windows.stratified_split(df, test_share=0.0).filter("is_test").count() == 0
    assert windows.stratified_split(df, test_share=1.0).filter("is_test").count() == 1003


def test_report_with_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0), (0, 0)], "label int, prediction int")
    report = {r.name: r for r in metrics.classification_report(df).collect()}
    assert report["1"].precision == 0 and report["1"].f1 == 0 and report["1"].support == 1
    assert report["0"].precision == 0.5 and report["0"].recall == 1.0
    assert report["accuracy"].f1 == 0.5
    assert report["macro avg"].recall == pytest.approx(1 / 3)
    matrix = {r.label: r for r in metrics.confusion_matrix(df).collect()}
    assert matrix[2].predicted_0 == 1 and matrix[2].predicted_2 == 0
    odd = spark.createDataFrame([(0, 2), (None, 1), (9, 0), (1, None)], "label int, prediction int")
    matrix = {r.label: tuple(r)[1:] for r in metrics.confusion_matrix(odd).collect()}
    assert matrix == {0: (0, 0, 1), 1: (0, 0, 0), 2: (0, 0, 0)}


def test_logloss_leaves_out_rows_it_cannot_judge(spark):
    rows = [(0, 0.5, 0.3, 0.2), (None, 0.1, 0.1, 0.8), (7, 0.1, 0.1, 0.8), (1, 0.5, None, 0.5)]
    df = spark.createDataFrame(rows, "label int, p0 double, p1 double, p2 double")
    assert metrics.multi_logloss(df).first().logloss == pytest.approx(0.6931471805599453)
    assert metrics.multi_logloss(df.filter("label = 7")).first().logloss is None


def test_fill_emits_every_bucket_of_known_series(spark):
    rows = [(S.POINT_MEASUREMENT, i, "primary", t, *[v] * 6, 1) for i, t, v in
            [("a", 60_000, 1.0), ("a", 61_000, 3.0), ("a", 200_000, 5.0), ("b", 130_000, 7.0), ("c", 1, 9.0)]]
    points = spark.createDataFrame(rows, S.POINT)
    out = timeseries.mean_by_bucket(points, "HR", ["id"], range_ms=180_000, as_of=240_000)
    got = {(r.id, r.bucket_ms): r.value for r in out.collect()}
    assert set(got) == {(i, b) for i in "ab" for b in range(60_000, 300_000, 60_000)}
    assert got[("a", 60_000)] == 2.0 and got[("a", 120_000)] is None and got[("a", 180_000)] == 5.0
    assert got[("b", 120_000)] == 7.0
    counts = timeseries.count_by_bucket(points, "HR", ["id"], 180_000, as_of=240_000)
    assert {r.value for r in counts.collect()} == {0, 1, 2}
    few = points.filter("id = 'b'")
    wide = timeseries.mean_by_bucket(few, "HR", ["id"], range_ms=1_300_000, step_ms=1, as_of=1_300_000)
    told = wide.agg(F.count("*"), F.count_distinct("bucket_ms"), F.min("bucket_ms"), F.max("bucket_ms"), F.count("value"))
    assert tuple(told.first()) == (1_300_001, 1_300_001, 0, 1_300_000, 1)


def test_processing_lag_without_recent_points(spark):
    points = spark.createDataFrame([("primary", 1_000)], "source string, time_ms long")
    assert control.processing_lag(points, as_of=10_000).first().lag_s == 9.0
    assert control.processing_lag(points, as_of=10_000_000).first().lag_s is None


def test_plans_push_down_and_prune(spark, tmp_path):
    from vitalflow.sources import points as pts

    rows = [(S.POINT_MEASUREMENT, "a", "primary", d * 86_400_000, *[1.0] * 6, 1) for d in range(5)]
    path = str(tmp_path / "points")
    pts.write_points(spark.createDataFrame(rows, S.POINT), path)
    scan = pts.scan_points(spark, path, S.POINT_MEASUREMENT, 86_400_000, as_of=4 * 86_400_000)
    plan = scan.select("id", "HR")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date" in plan.split("PartitionFilters")[1][:300]
    wanted = "id:string,time_ms:bigint,HR:double,batch_id:bigint,writer:string,attempt:string"
    assert f"ReadSchema: struct<{wanted}>" in plan
    assert "GreaterThanOrEqual(time_ms" in plan
    # a file for each of the five days, and the list of batches
    assert len(scan.inputFiles()) <= 6 and scan.count() == 2


def test_latest_uses_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("id"), F.col("id").alias("time_ms"))
    plan = windows.latest_per_id(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("block, group", [(10, 1), (16, 3), (50, 2), (1000, 512)])
def test_count_or_time_batches_match_plain_loop(spark, block, group):
    rng = random.Random(block)
    rows, want = [], {}
    for part, pace in ((0, [0, 1, 2]), (1, [0, 0, 0, 40]), (2, [50]), (3, [0])):
        now, start = 0, None
        for offset in range(170 if part < 3 else 20):
            now += rng.choice(pace)
            rows.append((part, offset, now))
            if start is None or offset - start[0] == 10 or now > start[1] + 30:
                start = (offset, now)
            want[(part, offset)] = start[0]
    df = spark.createDataFrame(rows, "partition int, offset long, arrival_ms long").repartition(3)
    got = batching.count_or_time_batches(
        df, ["partition"], ["offset"], "arrival_ms", size=10, wait_ms=30,
        block_records=block, blocks_per_group=group,
    )
    assert {(r.partition, r.offset): r.batch_start for r in got.collect()} == want
    assert got.count() == len(rows)


def test_judgements_leave_out_rows_without_a_class(spark):
    rows = [(0, 0), (1, 1), (None, 1), (None, 0), (2, None), (7, 7), (1, 9)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    report = {r.name: r for r in metrics.classification_report(df).collect()}
    assert metrics.accuracy(df).first().accuracy == report["accuracy"].f1 == 1.0
    assert report["accuracy"].support == 2 == sum(report[str(c)].support for c in (0, 1, 2))
    matrix = metrics.confusion_matrix(df).collect()
    assert sum(r[f"predicted_{c}"] for r in matrix for c in (0, 1, 2)) == 2

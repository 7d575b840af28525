import zipfile

import pytest
from pyspark.sql import functions as F

from vitalflow import schemas as S
from vitalflow import session
from vitalflow.sources import files, records
from vitalflow.sources import points as pts


ROWS = [
    (1.5, -2.0, None, 0.25, 88.0, 33.5, "BG", "2024-01-01 00:00:00.003"),
    (None,) * 8,
]


def frame(spark, rows):
    return spark.createDataFrame(rows, S.SENSOR_RECORD)


def test_binary_records_need_the_avro_package(spark):
    df = spark.createDataFrame([(None,) * 8], S.SENSOR_RECORD)
    if records.avro_available(spark):
        back = records.decode_sensor_values(records.encode_sensor_values(df), mode="FAILFAST")
        assert back.collect() == df.collect()
    else:
        with pytest.raises(Exception, match="(?i)avro"):
            records.encode_sensor_values(df).collect()


def test_zipped_csv_from_files(spark, tmp_path):
    text = "X,Y,Z,EDA,HR,TEMP,id,datetime\n1,2,,0.5,88.25,33,BG,2024-01-01 00:00:00\n,,,,,,BG,\n"
    for n in range(2):
        with zipfile.ZipFile(tmp_path / f"{n}.zip", "w") as archive:
            archive.writestr("BG.csv", text)
            archive.writestr("other.csv", "a\n1\n")
    archives = spark.read.format("binaryFile").load(str(tmp_path / "*.zip"))
    rows = files.read_zipped_csv(archives, "BG.csv").orderBy("HR").collect()
    assert len(rows) == 4 and rows[0].HR is None and rows[0].datetime is None
    assert (rows[2].X, rows[2].Z, rows[2].HR, rows[2].id) == (1.0, None, 88.25, "BG")
    with pytest.raises(Exception, match="6D.csv not found"):
        files.read_zipped_csv(archives, "6D.csv").collect()
    with pytest.raises(Exception, match="has no column"):
        files.read_zipped_csv(archives, "other.csv").collect()


def test_zipped_csv_with_text_that_is_no_number_fails(spark, tmp_path):
    text = "X,Y,Z,EDA,HR,TEMP,id,datetime\nabc,2,,0.5,88.25,33,BG,2024-01-01 00:00:00\n"
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("BG.csv", text)
    archives = spark.read.format("binaryFile").load(str(tmp_path / "*.zip"))
    with pytest.raises(Exception, match="not a number: abc"):
        files.read_zipped_csv(archives, "BG.csv").collect()


def test_headers():
    names = ["@ id", "Timestamp", "# X", " # Y ", "#z", "HR", "Temp", "# EDA", "# label", "Other One"]
    assert [files.canonical_header(n) for n in names] == [
        "User_ID", "Timestamp", "Orientation_X", "Orientation_Y", "Orientation_Z",
        "Heart_Rate", "Skin_Temp", "EDA", "Stress_Label", "otherone",
    ]


def test_csv_per_id_round_trip(spark, tmp_path):
    df = frame(spark, [ROWS[0], (1.0, None, None, None, 70.0, None, "07", "t"), (2.0,) * 6 + ("07", None)])
    path = str(tmp_path / "out")
    files.write_csv_per_id(df, path)
    assert {p.name for p in (tmp_path / "out").glob("person=*")} == {"person=BG", "person=07"}
    back = files.read_sensor_csv(spark, path + "/person=07")
    assert sorted(r.id for r in back.collect()) == ["07", "07"]


def point(source, time_ms, level, person="a"):
    return (S.POINT_MEASUREMENT, person, source, time_ms, *[1.0] * 6, level)


def test_rewritten_points_and_retried_batches(spark, tmp_path):
    path = str(tmp_path / "points")

    def write(rows, batch):
        pts.write_points(spark.createDataFrame(rows, S.POINT), path, batch)

    write([point("primary", 1, 0), point("primary", 2, 0)], 0)
    write([point("primary", 2, 1), point("fallback", 2, 2)], 1)
    write([point("primary", 2, 1), point("fallback", 2, 2)], 1)
    table = pts.read_points(spark, path)
    assert table.count() == 4
    kept = {(r.source, r.time_ms): r.stress_level for r in pts.upsert_points(table).collect()}
    assert kept == {("primary", 1): 0, ("primary", 2): 1, ("fallback", 2): 2}


def folders(path):
    return sorted(p.parent.name for p in path.glob("measurement=*/date=*/*.parquet"))


def test_folders_do_not_grow_with_batches_and_retries_move_days(spark, tmp_path):
    path, day = tmp_path / "points", 86_400_000

    def write(batch, *points, writer=""):
        pts.write_points(spark.createDataFrame(list(points), S.POINT), str(path), batch, writer)

    for batch in range(6):
        write(batch, point("primary", batch, 0))
    assert len(set(folders(path))) == 1
    write(6, point("fallback", day - 1, 1))
    write(6, point("fallback", day + 1, 1))  # the same batch, tried again after midnight
    write(6, point("fallback", 7, 2), writer="other")
    got = sorted((r.source, r.time_ms) for r in pts.read_points(spark, str(path)).collect())
    assert got == [("fallback", 7), ("fallback", day + 1), *[("primary", i) for i in range(6)]]

    write(7, point("primary", 3, 2))
    before = sorted(tuple(r) for r in pts.upsert_points(pts.read_points(spark, str(path))).collect())
    pts.compact_points(spark, str(path), day)
    after = pts.read_points(spark, str(path))
    assert sorted(tuple(r) for r in after.collect()) == before
    assert folders(path).count("date=1970-01-01") == 1 and len(set(folders(path))) == 2
    write(8, point("primary", 3, 1))
    late = {r.time_ms: r.stress_level for r in pts.upsert_points(pts.read_points(spark, str(path))).collect()}
    assert late[3] == 1


def test_equal_identities_in_one_batch_have_one_winner(spark, tmp_path):
    rows = [point("fallback", 5, level) for level in (0, 2, 1)]
    for n, own in enumerate((rows, rows[::-1])):
        pts.write_points(spark.createDataFrame(own, S.POINT), str(tmp_path / str(n)))
        kept = pts.upsert_points(pts.read_points(spark, str(tmp_path / str(n)))).collect()
        assert [r.stress_level for r in kept] == [2]


def test_staged_tables_are_dropped_but_for_those_to_keep(spark):
    from pathlib import Path

    from vitalflow.session import drop_staged, fresh_path, staged

    kept, gone = fresh_path(spark, "kept"), fresh_path(spark, "gone")
    for path in (kept, gone):
        spark.range(3).write.parquet(path)
    table = staged(spark.range(2), "table")
    others = [p for p in session._STAGED[spark.sparkContext.applicationId] if p not in (kept, gone)]
    assert table.count() == 2
    drop_staged(spark, keep=[kept, *others])
    assert Path(kept).exists() and not Path(gone).exists() and table.count() == 2


def test_line_protocol(spark):
    df = spark.createDataFrame(
        [("BG", 0.5, 88.123456789, 33.0, 4_999, 1)],
        "id string, EDA float, HR float, TEMP float, datetime long, stress_level int",
    )
    line = pts.to_line_protocol(df).first().line
    assert line == "flink_events,id=BG EDA=0.500000,HR=88.123459,TEMP=33.000000,stressLevel=1 4999000000"


def test_fallback_point_time_is_cut_to_the_second(spark):
    df = frame(spark, [ROWS[0]]).withColumn("stress_level", F.lit(1))
    row = pts.fallback_points(df).first()
    assert row.time_ms == 1_704_067_200_000 and row.source == "fallback" and row.stress_level == 1


def test_lines_are_sent_in_calls(spark):
    df = spark.range(25).select(
        F.col("id").cast("string").alias("id"),
        *[F.lit(1.0).alias(c) for c in ("EDA", "HR", "TEMP")],
        F.col("id").alias("datetime"),
        F.lit(1).alias("stress_level"),
    ).coalesce(1)
    calls = pts.send_lines(df, lambda text: 500 if "id=0 " in text else 204, lines_per_call=10)
    assert [(r.lines, r.status, r.failed) for r in calls.collect()] == [
        (10, 500, True), (10, 204, False), (5, 204, False),
    ]


def test_tables_may_be_folders(spark, sf_dir, tmp_path):
    from vitalflow.plans import catalog, datasets

    folder = str(tmp_path)
    datasets.events(spark, sf_dir).repartition(3).write.parquet(f"{folder}/events.parquet")
    for name in ("flagship", "read_stream_earliest"):
        run = catalog.QUERIES[name]
        assert run(spark, folder).count() == run(spark, sf_dir).count()


def test_a_batch_written_again_after_compaction_is_there_once(spark, tmp_path):
    path, day = str(tmp_path / "replayed"), 86_400_000

    def write(batch, level):
        row = ("m", "N", "primary", 1_000, *[1.0] * 6, level)
        pts.write_points(spark.createDataFrame([row], S.POINT), path, batch, "w")

    write(0, 1)
    pts.compact_points(spark, path, day)
    assert [r.stress_level for r in pts.read_points(spark, path).collect()] == [1]
    write(0, 2)
    assert [r.stress_level for r in pts.read_points(spark, path).collect()] == [2]
    pts.compact_points(spark, path, day)
    assert [r.stress_level for r in pts.read_points(spark, path).collect()] == [2]


def test_written_lines_are_the_text_of_the_points(spark, tmp_path):
    rows = [("N", 1.5, 88.0, 33.25, 2, 4_999), ("M", 0.0, 70.0, 30.0, 0, 9_999)]
    scored = spark.createDataFrame(
        rows, "id string, EDA double, HR double, TEMP double, stress_level int, datetime long"
    )
    pts.write_lines(scored, str(tmp_path / "lines"))
    back = sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect())
    assert back == sorted(r.line for r in pts.to_line_protocol(scored).collect())
    assert back[1] == "flink_events,id=N EDA=1.500000,HR=88.000000,TEMP=33.250000,stressLevel=2 4999000000"

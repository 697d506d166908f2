"""Palm angles, roll-ups, pixels, sources, sinks and the incremental mode on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veriframe.functions import pixels
from veriframe.operators import geometry as G
from veriframe.operators import metadata as M
from veriframe.operators import report as R
from veriframe.operators import service
from veriframe.plans import report_queries
from veriframe.sources import media, tables
from veriframe.streaming import incremental


def hand(wrist_z=0.0, thumb_z=0.0, upper_z=0.0, pinky_z=0.0):
    points = [(0.001 * i, 0.002 * i, 0.0) for i in range(21)]
    points[0], points[1], points[5] = (0.0, 0.08, wrist_z), (-0.065, 0.03, thumb_z), (-0.04, 0.0, thumb_z or upper_z)
    points[9], points[13], points[17] = (-0.005, -0.006, upper_z), (0.03, 0.0, pinky_z or upper_z), (0.065, 0.012, pinky_z)
    return points


POINTS = "points array<struct<x: double, y: double, z: double>>, hand string"


@pytest.mark.parametrize(("points", "side", "check"), [
    (hand(thumb_z=0.02, pinky_z=-0.02), "L", lambda a: a.roll < -10), (hand(thumb_z=-0.02, pinky_z=0.02), "L", lambda a: a.roll > 10), (hand(thumb_z=-0.02, pinky_z=0.02), "R", lambda a: a.roll < -10),
    (hand(wrist_z=-0.02, upper_z=0.02), "L", lambda a: a.pitch < -10), (hand(wrist_z=0.02, upper_z=-0.02), "R", lambda a: a.pitch > 10),
    (None, "L", lambda a: a.error), (hand()[:10], "L", lambda a: a.error), ([(0.0, 0.0, z) if i in (1, 5, 13, 17) else (x, y, z) for i, (x, y, z) in enumerate(hand())], "L", lambda a: "degenerate" in a.error),
])
def test_palm_angles(spark, points, side, check):
    assert check(spark.createDataFrame([(points, side)], POINTS).select(G.palm_angles(F.col("points"), F.col("hand")).alias("a")).first().a)


@pytest.mark.parametrize(("pose", "roll", "pitch", "status"), [("N", 3, -4, "PASS"), ("N", -45.5, -3, "FAIL"), ("RR", -30, 2, "PASS"), ("PU", 0, -25, "PASS"), ("PD", 0, 25, "PASS"), ("RL", 6.1, -4.8, "FAIL"), ("RL", 52, 2, "FAIL"), ("RL", 40, 38, "PASS")])
def test_pose_grades(spark, pose, roll, pitch, status):
    df = spark.createDataFrame([((float(roll), float(pitch), None), "L", pose)], "a struct<roll: double, pitch: double, error: string>, hand string, pose string")
    assert df.select(G.pose_verdict(F.col("a"), F.col("hand"), F.col("pose"), neutral=10)).first()[0] == status


def rows(spark, *items):
    return spark.createDataFrame([("1", "face_rgb", f, lvl, c, s, r, None, k) for k, (f, lvl, c, s, r) in enumerate(items)], incremental.ROWS_SCHEMA)


def test_roll_up_edges(spark):
    many = [("f", "video", f"x{k:02}", "FAIL", "") for k in range(11)]
    df = rows(spark, ("a", "frame", "c", "SKIP", "s"), *(("b", "frame", "c", s, "") for s in ["FAIL"] + ["PASS"] * 4), *(("d", "frame", "c", s, "") for s in ["FAIL"] + ["PASS"] * 3), *many, ("e", "video", "c", "PASS", "p"), ("e", "frame", "c", "FAIL", "q"))
    rules = R.Aggregation(per_check={"c": 0.2})
    got = {(r.filename, r.check_name): r for r in R.summarize_by_check(df, rules).collect()}
    assert [got[f, "c"].final_status for f in "abde"] == ["SKIP", "PASS", "FAIL", "FAIL"] and got["d", "c"].reason == " [judged fail-ratio=25% (max 20%)]" and got["e", "c"].reason == "q"
    overall = {r.filename: r for r in R.summarize_overall(R.summarize_by_check(df, rules)).collect()}
    assert overall["f"].reason.endswith("x09, ... (11 total)") and overall["a"].reason == "all checks passed"


def test_incremental_equals_batch(spark, tmp_path):
    first, second = rows(spark, ("a", "video", "c", "FAIL", "old"), ("b", "video", "c", "PASS", "")), rows(spark, ("a", "video", "c", "PASS", "new"), ("z", "video", "c", "FAIL", "bad"))
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        incremental.follow(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = {(r.filename, r.overall_status, r.reason) for r in incremental.version(spark, str(tmp_path / "out"), 1).collect()}
    assert got == {("a", "PASS", ""), ("b", "PASS", ""), ("z", "FAIL", "bad")}


def test_metadata_fails_closed(spark):
    df = spark.createDataFrame([("1", "face_rgb", "f", ".mp4", True, "ok", None, None, None, None, None, None)], "volunteer_id string, data_type string, filename string, extension string, readable boolean, meta_reason string, width int, height int, fps double, duration_sec double, channel_count int, is_color boolean")
    assert {r.status for r in M.metadata_rows(df).collect()} == {"FAIL"}


def test_pixels(spark):
    flat = np.full((40, 40, 3), 90, np.uint8)
    edge = flat.copy()
    edge[:, 20:] = 200
    assert pixels.mean_value(flat) == 90 and pixels.sharpness(flat) is None and pixels.sharpness(edge, equalise=False) > 50 and pixels.sharpness(edge) is not None
    assert not pixels.is_color(flat) and not pixels.channels_differ(flat) and pixels.crop(flat, (10, 10, 20, 20), 0.1).shape == (16, 16, 3)
    skin = np.full((8, 8, 3), (120, 150, 210), np.uint8)
    assert pixels.skin_share(skin) == 1 and pixels.skin_share(flat) == 0 and pixels.channels_differ(skin) and pixels.is_color(skin)
    df = spark.createDataFrame([(flat.tobytes(), 40, 40), (None, 1, 1)], "data binary, height int, width int")
    assert [r[0] for r in df.select(pixels.statistic(pixels.mean_value)("data", "height", "width")).collect()] == [90.0, None]


class Decoder:
    def probe(self, path):
        if "bad" in path:
            raise OSError("cannot  open")
        return {"width": 4, "height": 2, "fps": 10.0, "frame_count": 20, "duration_sec": 2.0, "channel_count": 3, "is_color": True}

    def frames(self, path, indices):
        for i in indices:
            if i != 4:
                yield i, 2, 4, bytes(24)

    def read(self, path):
        for i in range(12):
            if i == 9 and path == "broken":
                raise OSError("cut  off")
            yield i, 2, 4, bytes(24)


def decoder():
    return Decoder()


def test_video_backend(spark):
    meta = {r.filename: r for r in media.probe_videos(spark.createDataFrame([("x/a.MP4",), ("bad.mp4",)], "path string"), Decoder).collect()}
    assert meta["a.MP4"].readable and meta["a.MP4"].extension == ".mp4" and meta["bad.mp4"].meta_reason == "OSError: cannot open"
    grid = M.sample_grid(spark.createDataFrame([("a", 20, 10.0)], "filename string, frame_count int, fps double")).withColumnRenamed("filename", "path")
    assert [r.frame_index for r in media.sampled_frames(grid, Decoder).orderBy("frame_index").collect()] == [0, 2, 6, 8, 10, 12, 14, 16, 18, 19]
    spark.dataSource.register(media.FrameSource)
    assert spark.read.format("frames").option("paths", "a\nb").option("backend", "tests.test_engine:decoder").load().count() == 20  # as the grid: the last frame is read too


def test_files_without_frame_count(spark):
    files = spark.createDataFrame([("a", None, 10.0), ("b", 0, None), ("known", 20, 10.0), ("broken", None, 4.0)], "path string, frame_count int, fps double")
    rows = media.sequential_frames(files, Decoder, sample_fps=5).collect()
    frames = lambda path: [(r.frame_index, round(r.timestamp_sec, 3)) for r in rows if r.path == path and r.reason is None]
    assert frames("a") == [(0, 0.0), (2, 0.2), (4, 0.4), (6, 0.6), (8, 0.8), (10, 1.0)]
    assert frames("b") == [(0, 0.0), (6, 0.2)] and frames("known") == []
    assert [i for i, _ in frames("broken")] == list(range(9)) and [(r.reason, r.data) for r in rows if r.reason] == [("OSError: cut off", None)]
    assert len(media.sequential_frames(files, Decoder, sample_fps=None, max_frames=7).where("path = 'a'").collect()) == 7


@pytest.mark.parametrize(("n", "fps", "rate", "most"), [(20, 10.0, 5, 10000), (1, 30.0, 5, 10000), (301, 29.97, 1, 10000), (1000, 25.0, None, 64), (50, 2.0, 5, 7), (90, 37.5, 15, 10000)])
def test_one_file_has_the_grid_of_the_table(spark, n, fps, rate, most):
    grid = M.sample_grid(spark.createDataFrame([("a", n, fps)], "filename string, frame_count int, fps double"), sample_fps=rate, max_frames=most)
    assert sorted(r.frame_index for r in grid.collect()) == media.sample_indices(n, fps, rate, most)


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("face_rgb", "001", "f", "PASS", "", "a,\"b\"\nc")], tables.SUMMARY_SCHEMA)
    tables.export(df, str(tmp_path / "c"))
    assert tables.read_csv(spark, str(tmp_path / "c")).collect() == df.collect() and tables.read_csv(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad.json").write_text("{nope")
    (tmp_path / "good.json").write_text('[{"data_type": "palm", "filename": "f", "failures": [{"check_name": "c", "reason": "r"}]}]')
    assert tables.read_all_summary(spark, str(tmp_path / "good.json")).first().failures[0].reason == "r"
    assert tables.read_all_summary(spark, str(tmp_path / "bad.json")).count() == tables.read_all_summary(spark, str(tmp_path / "no.json")).count() == 0
    texts = tables.round_texts(spark.createDataFrame([(0.125, None)], "a double, b double"), {"a": 2, "b": 1}).first()
    assert texts == ("0.12", "")


def test_filename_report(spark, tmp_path):
    assert tables.load_filename_report(spark, str(tmp_path)) is None
    (tmp_path / "filenames.csv").write_text('volunteer,missing\n007,"a, b"\n')
    kind, report = tables.load_filename_report(spark, str(tmp_path))
    assert kind == "csv" and report.collect() == [("007", "a, b")]
    (tmp_path / "filenames.json").write_text('[{"volunteer": "007", "missing": ["a", "b"]}]')
    kind, report = tables.load_filename_report(spark, str(tmp_path))
    assert kind == "json" and report.first().missing == ["a", "b"] and report.first().volunteer == "007"


def test_config(tmp_path):
    (tmp_path / "c.yml").write_text("filenames:\n  required:\n    walk_F: '^(?P<volunteer_id>\\d+)_walk_F\\.mp4$'\n")
    assert media.required_patterns(media.load_config(str(tmp_path / "c.yml"))) == {"walk_F": r"^([0-9]+)_walk_F\.mp4$"}
    with pytest.raises(ValueError, match="no required"):
        media.required_patterns({})


def test_file_statuses_are_those_of_the_summary_without_a_sort(spark):
    """Verdicts alone are numbers; a volunteer's files are counted without a copy of the rows for each distinct count."""
    rows = report_queries.rows(spark, "/root/testdata/sf0.001")
    got = R.file_statuses(rows, report_queries.RULES)
    want = R.summarize_overall(R.summarize_by_check(rows, report_queries.RULES)).select(*got.columns)
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 0
    overall = service.volunteer_overall(got.withColumnRenamed("final_status", "overall_status"))
    plan = overall._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Expand" not in plan

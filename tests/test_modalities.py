"""The modality pipelines on small cases: gates, several faces, poses of palms, walks."""

import pytest
from pyspark.sql import functions as F

from veriframe.operators import metadata as M
from veriframe.operators import modalities as X
from veriframe.operators import report as R
from veriframe.operators import sequence as S
from veriframe.operators.checks import Registry, aggregation, graded

MEDIA = "volunteer_id string, data_type string, filename string, extension string, readable boolean, meta_reason string, width int, height int, fps double, duration_sec double, frame_count int, channel_count int, is_color boolean"
FACE = "filename string, frame_index int, timestamp_sec double, face_detected boolean, message string, yaw double, pitch double, head string, face_width int, face_height int, blink_left double, blink_right double, luma double, sharpness double, skin map<string, double>"


def media(spark, *files, kind="face_rgb", seconds=60.0, readable=True):
    return spark.createDataFrame([("1", kind, f, ".mp4", readable, "cannot open", 1920, 1080, 30.0, seconds, 100, 3, True) for f in files], MEDIA)


def face_frames(spark, filename, labels, message="No faces detected"):
    angles = {"F": (0.0, 0.0), "L": (-50.0, 0.0), "R": (50.0, 0.0), "D": (0.0, -40.0), "U": (0.0, 40.0), "M": (-28.0, 0.0)}
    skin = {r: 0.9 for r in X.REGIONS}
    rows = []
    for k, x in enumerate(labels):
        if x == "G":
            rows.append((filename, k, float(k), False, message, None, None, None, None, None, None, None, None, None, None))
        else:
            rows.append((filename, k, float(k), True, "ok", *angles[x], "Head is fully visible", 200, 220, 0.1, 0.2, 100.0, 80.0, skin))
    return spark.createDataFrame(rows, FACE)


def found(rows):
    return sorted((r.check_name, r.status, r.reason, r.frame_index) for r in rows.collect())


def test_short_video_is_stopped(spark):
    rows = found(X.face_rows(media(spark, "a", seconds=2.0), face_frames(spark, "a", "FFFF")))
    assert ("check_duration", "FAIL", "duration=2.0 < 40", None) in rows
    assert ("frame_checks", "SKIP", "fail-fast: check_duration FAILed (duration=2.0 < 40); frame checks skipped", None) in rows
    assert len(rows) == 5  # no frame was judged


def test_unreadable_video(spark):
    rows = found(X.face_rows(media(spark, "a", readable=False), face_frames(spark, "a", "FF")))
    assert ("frame_checks", "SKIP", "video unreadable; frame checks skipped", None) in rows and not any(r[3] is not None for r in rows)


def test_no_frames(spark):
    rows = found(X.face_rows(media(spark, "a"), face_frames(spark, "a", "FF").where("false")))
    assert ("frames_sampled", "FAIL", "video opened but yielded 0 frames (corrupt/empty stream)", None) in rows


def test_several_faces_cut_the_video_off(spark):
    rows = found(X.face_rows(media(spark, "a"), face_frames(spark, "a", "GGGGG", "Multiple faces detected: 2")))
    assert [r for r in rows if r[0] == "check_face_detected"] == [("check_face_detected", "FAIL", "frame=0 Multiple faces detected: 2", 0)]
    assert ("frames_sampled", "PASS", "sampled 1 frames", None) in rows and not any(r[0].startswith("check_turn") for r in rows)


def test_frame_checks_and_gaps(spark):
    rows = found(X.face_rows(media(spark, "a"), face_frames(spark, "a", "FFFLGGFFFG"), X.FacePolicy(turns=S.Protocol())))
    by = {(c, i): (s, t) for c, s, t, i in rows}
    assert by["check_face_size", 0] == ("PASS", "frame=0 face=200x220 >= 180x180")
    assert by["check_eyes_open", 0] == ("PASS", "frame=0 eyes open (blinkL=0.10, blinkR=0.20 < 0.5)")
    assert by["check_brightness", 3] == ("SKIP", "frame=3 non-frontal (label=left); not judged")
    assert by["check_face_detected", 4] == ("SKIP", "frame=4 No faces detected; expected gap (peak of left turn)")
    assert by["check_face_detected", 9] == ("FAIL", "frame=9 No faces detected; unexpected gap (no adjacent turn evidence)")
    assert {c for c, *_ in rows} >= {"check_turn_front", "check_turn_left", "check_turn_sequence"}
    assert len([r for r in rows if r[0] == "check_face_detected"]) == 10


def test_dim_frame_is_not_blamed_twice(spark):
    frames = face_frames(spark, "a", "F").withColumns({"luma": F.lit(20.0), "blink_left": F.lit(0.8), "skin": F.map_concat(F.map_filter("skin", lambda k, _: ~k.isin("nose", "forehead")), F.create_map(F.lit("nose"), F.lit(0.1)))})
    by = {c: (s, t) for c, s, t, i in found(X.face_rows(media(spark, "a"), frames)) if i == 0}
    assert by["check_brightness"] == ("FAIL", "frame=0 brightness=20 < 35; too_dark")
    assert by["check_face_blur"] == ("SKIP", "frame=0 brightness failed; blur not judged: brightness=20 < 35; too_dark")
    assert by["check_eyes_open"][1] == "frame=0 eye(s) closed (blinkL=0.80, blinkR=0.20 >= 0.5)"
    assert by["check_occlusion"] == ("FAIL", "frame=0 occluded: nose(skin=0.10); forehead=NA left_eye=0.90 right_eye=0.90 nose=0.10 mouth=0.90 left_cheek=0.90 right_cheek=0.90; min_skin_ratio=0.40")


@pytest.mark.parametrize(
    ("pose", "roll", "pitch", "status", "reason"),
    [
        ("N", 3.0, -4.0, "PASS", "L/N ok: raw roll=+3.0, pitch=-4.0 within +/-10"), ("N", -45.5, -3.0, "FAIL", "L/N fail (not neutral): roll=-45.5 not within +/-10"),
        ("RR", -30.0, 2.0, "PASS", "L/RR ok: raw roll=-30.0 within [-45,-10], pitch=+2.0"), ("PU", 0.0, -25.0, "PASS", "L/PU ok: raw pitch=-25.0 within [-45,-10], roll=+0.0"),
        ("PD", 0.0, 25.0, "PASS", "L/PD ok: raw pitch=+25.0 within [10,45], roll=+0.0"), ("RL", 6.1, -4.8, "FAIL", "L/RL fail: raw roll=+6.1 not in [10,45], pitch=-4.8"),
        ("RL", 52.0, 2.0, "FAIL", "L/RL fail: raw roll=+52.0 not in [10,45], pitch=+2.0"), ("RL", 40.0, 38.0, "PASS", "L/RL ok: raw roll=+40.0 within [10,45], pitch=+38.0"),
    ],
)
def test_palm_poses(spark, pose, roll, pitch, status, reason):
    a = F.struct(F.lit(roll).alias("roll"), F.lit(pitch).alias("pitch"), F.lit(None).cast("string").alias("error"))
    got = spark.range(1).select(X.pose_said(a, F.lit("L"), F.lit(pose)).alias("v")).first().v
    assert (got.status, got.reason) == (status, reason)


def test_palm_spread(spark):
    gaps = F.struct(F.lit("tip").alias("source"), *(F.lit(x).alias(n) for n, x in (("thumb_index", 25.0), ("index_middle", 4.0), ("middle_ring", 6.0), ("ring_pinky", 7.0))))
    got = spark.range(1).select(X.spread_said(gaps, F.lit("N")).alias("v"), X.spread_said(gaps, F.lit("PU")).alias("w")).first()
    assert (got.v.status, got.v.reason) == ("FAIL", "closed: index-middle(4.0<5); source=tip; thumb-index=25.0 index-middle=4.0 middle-ring=6.0 ring-pinky=7.0 (source=tip min thumb=20 inter=5)")
    assert got.w.status == "SKIP"


WALK = "path string, frame_index int, ok boolean, message string, box struct<x:double,y:double,w:double,h:double>, missing array<string>, outside array<string>, height double, luma double, sharpness double, blur_luma double, contrast double, objects array<struct<cls_id:int,cls_name:string,conf:double,x:double,y:double,w:double,h:double>>, foot_y double, body_scale double, centroid_x double, view string, error string, lacks map<string,string>"
BOX = (100.0, 100.0, 50.0, 200.0)


def walk_frame(path, k, n=15, **other):
    scale = 0.3 + 0.05 * min(k, n - 1 - k)
    row = {"path": path, "frame_index": k, "ok": True, "message": None, "box": BOX, "missing": [], "outside": [], "height": 0.6, "luma": 10.0, "sharpness": 50.0, "blur_luma": 100.0, "contrast": 9.0, "objects": [], "foot_y": None,
           "body_scale": scale, "centroid_x": 0.5, "view": "F", "error": None, "lacks": None} | other
    return tuple(row.values())


def nobody(message="No poses detected"):
    return {"ok": False, "message": message, "box": None, "body_scale": None, "centroid_x": None, "missing": None, "outside": None, "height": None}


def walked(spark, frames, p=X.WalkPolicy(), **kind):
    files = media(spark, *sorted({f[0] for f in frames} or {"w"}), kind="walk_F", **kind)
    return found(X.walk_rows(files, spark.createDataFrame(frames, WALK), p))


def test_walk(spark):
    frames = [walk_frame("w", k, **(nobody() if k == 5 else {}), **({"outside": ["left_foot"]} if k == 2 else {})) for k in range(15)]
    rows = walked(spark, frames)
    by = {(c, i): (s, t) for c, s, t, i in rows}
    assert by["check_body_height", 0] == ("PASS", "frame=0 body_height=0.60 >= 0.50") and by["check_person_detected", 5] == ("FAIL", "frame=5 No poses detected")
    assert by["check_person_fully", 2] == ("FAIL", "frame=2 person not fully visible (out of frame: left_foot)")
    # a frame without a person fails what can't be seen there
    assert by["check_person_fully", 5] == by["check_person_blur", 5] == ("FAIL", "frame=5 No poses detected")
    assert by["check_occlusion", 5] == ("PASS", "frame=5 no objects detected") and by["check_walk_direction", None][0] == "PASS" and not any(c == "check_brightness" for c, _ in by)
    assert by["check_person_blur", 1] == ("PASS", "frame=1 sharpness=50.0 threshold=35.0; luma=100.0; contrast=9.0; method=tenengrad_clahe; bbox=(100, 100, 50, 200)")
    lit = {(c, i): (s, t) for c, s, t, i in walked(spark, frames, X.WalkPolicy(brightness=True))}
    assert lit["check_brightness", 1] == ("PASS", "brightness=10 < 35; walk_pass (dark)") and lit["check_brightness", 5] == ("FAIL", "no pose: No poses detected")


def test_walk_body_height(spark):
    height = lambda rows: [r for r in rows if r[0] == "check_body_height"]
    late = [walk_frame("w", k) for k in range(3, 15)]  # the first frame that decodes isn't number 0
    assert height(walked(spark, late)) == [("check_body_height", "PASS", "frame=3 body_height=0.60 >= 0.50", 3)]
    assert height(walked(spark, [walk_frame("w", 0, **nobody())])) == [("check_body_height", "FAIL", "frame=0 no pose: No poses detected", 0)]
    assert found(X.walk_rows(media(spark, "w", kind="walk_F"), spark.createDataFrame([], WALK)))[:1] == [("check_body_height", "SKIP", "no frames decoded", None)]
    unread = walked(spark, late, readable=False)
    assert {(c, s, t) for c, s, t, _ in unread} == {(c, "SKIP", "video not readable: cannot open") for c in ("check_container", "check_fps", "check_duration", "check_resolution", "check_body_height")}
    short = walked(spark, late, seconds=2.0)
    assert height(short) == [("check_body_height", "SKIP", "fail-fast: check_duration FAILed; height not measured", None)] and len(short) == 6
    lost = walked(spark, [walk_frame("w", 0, error="OSError: gone"), walk_frame("w", 6)])
    assert [r for r in lost if r[3] is None and r[1] == "SKIP"] == [("check_body_height", "SKIP", "could not read first frame: OSError: gone", None)] and len(lost) == 5


def test_walk_stops_before_a_broken_frame(spark):
    rows = walked(spark, [walk_frame("w", k, **({"error": "OSError: gone"} if k == 9 else {})) for k in range(15)])
    assert ("frames_sampled", "PASS", "sampled 9 frames", None) in rows and max(r[3] or 0 for r in rows) == 8


def test_walk_several_people_in_both_modes(spark):
    frames = [walk_frame("w", k, **(nobody("Multiple persons detected: 2") if k in (4, 6) else {})) for k in range(15)]
    fast, slow = walked(spark, frames), walked(spark, frames, X.WalkPolicy(fail_fast=False))
    alone = ("check_single_person", "FAIL", "frame=4 multiple persons in frame: Multiple persons detected: 2; gait films one walker -> video FAIL", 4)
    for rows, n in ((fast, 5), (slow, 15)):
        assert [r for r in rows if r[0] == "check_single_person"] == [alone] and len([r for r in rows if r[0] == "check_person_detected"]) == n
        assert ("frames_sampled", "PASS", f"sampled {n} frames", None) in rows
    assert not any(r[0] == "check_walk_direction" for r in fast) and any(r[0] == "check_walk_direction" for r in slow)


def first_frames(spark, check, **cases):
    """The verdict on one frame of each case, in one run."""
    files = media(spark, *cases, kind="walk_F").withColumn("path", F.col("filename"))
    rows = X.walk_rows(files, spark.createDataFrame([walk_frame(name, 0, **c) for name, c in cases.items()], WALK)).where(F.col("check_name") == check)
    return {r.filename: (r.status, r.reason.removeprefix("frame=0 ")) for r in rows.collect()}


def test_walk_occlusion(spark):
    chair, far, person = (56, "chair", 0.9, 120.0, 250.0, 40.0, 60.0), (58, "plant", 0.8, 400.0, 0.0, 10.0, 10.0), (0, "person", 0.7, 390.0, 0.0, 60.0, 100.0)
    got = first_frames(
        spark, "check_occlusion", over={"objects": [chair, far]}, apart={"objects": [far]}, faint={"objects": [(56, "chair", 0.59, *chair[3:])]}, person={"objects": [person]},
        nobody={"objects": [far], **nobody()}, other={"objects": [far, person], **nobody()}, low={"objects": [chair], "view": "S"}, high={"objects": [chair], "view": "S", "foot_y": 200.0},
        lacking={"objects": [chair], "lacks": {"objects": "occlusion detector inactive"}}, many={"objects": [(k, f"c{k}", 0.61 + k / 100, *chair[3:]) for k in range(1, 8)]})
    assert got == {
        "over": ("FAIL", "obstructing objects: chair (0.90)"), "apart": ("PASS", "1 object(s) present but none overlaps person"), "faint": ("PASS", "only person present"), "person": ("PASS", "only person present"),
        "nobody": ("FAIL", "foreign objects (no person box to clear): plant (0.80)"), "other": ("FAIL", "obstructing objects: plant (0.80)"), "low": ("FAIL", "foot-level objects: chair (0.90)"),
        "high": ("PASS", "1 object(s) present but none at foot level"), "lacking": ("SKIP", "occlusion detector inactive"), "many": ("FAIL", "obstructing objects: c7 (0.68), c6 (0.67), c5 (0.66), c4 (0.65), c3 (0.64), +2 more"),
    }


def test_walk_blur_is_three_valued(spark):
    got = first_frames(spark, "check_person_blur", blurred={"sharpness": 20.0}, dark={"blur_luma": 30.0}, flat={"contrast": 3.0}, none={"sharpness": None})
    assert got["blurred"][0] == "FAIL" and got["dark"] == ("SKIP", "blur not judged: face too dark; luma=30.0 < 35.0")
    assert got["flat"] == ("SKIP", "blur not judged: too little local contrast; contrast=3.0 < 4.0") and got["none"][0] == "SKIP"


def test_files_of_one_name_do_not_mix(spark):
    files = media(spark, "a").withColumn("path", F.lit("/one/a")).union(media(spark, "a").withColumn("path", F.lit("/two/a")))
    frames = face_frames(spark, "a", "FFF").withColumn("path", F.lit("/one/a")).union(face_frames(spark, "a", "FFF").withColumn("path", F.lit("/two/a")))
    rows = X.face_rows(files, frames).groupBy("path", "check_name").count().collect()
    assert {r["count"] for r in rows if r.check_name in X.FACE_FRAME.checks} == {3} and {r["count"] for r in rows if r.check_name in X.FACE_FILE.checks} == {1}
    assert len({r.path for r in rows}) == 2


def test_slow_mode_judges_all_frames(spark):
    """Off-spec files and several faces are recorded, and nothing stops."""
    frames = face_frames(spark, "a", "GGGGG", "Multiple faces detected (2)")
    rows = found(X.face_rows(media(spark, "a", seconds=2.0), frames, X.FacePolicy(fail_fast=False)))
    assert [r[1] for r in rows if r[0] == "check_face_detected"] == ["FAIL"] * 5 and ("check_duration", "FAIL", "duration=2.0 < 40", None) in rows
    assert not any("fail-fast" in r[2] for r in rows) and ("frames_sampled", "PASS", "sampled 5 frames", None) in rows and not any(r[0].startswith("check_turn") for r in rows)


def test_errors_become_rows(spark):
    broken = media(spark, "a").withColumn("error", F.lit("ValueError:\n bad " + "x" * 400))
    rows = found(X.face_rows(broken, face_frames(spark, "a", "FFF")))
    assert [(r[0], r[1]) for r in rows] == [("processing_error", "FAIL")] and rows[0][2].startswith("ValueError: bad xx") and len(rows[0][2]) == 300
    midway = face_frames(spark, "a", "FFF").withColumn("error", F.when(F.col("frame_index") == 2, "RuntimeError: lost"))
    assert found(X.face_rows(media(spark, "a"), midway)) == [("processing_error", "FAIL", "RuntimeError: lost", None)]
    assert {r.final_status for r in R.summarize_overall(R.summarize_by_check(X.face_rows(broken, face_frames(spark, "a", "F")))).collect()} == {"FAIL"}


def test_a_further_check_is_one_entry(spark):
    extra = Registry("frame", framed=True)
    for c in X.FACE_FRAME:
        extra.checks[c.name] = c
    extra.check("check_tilt", needs="pose", fail_ratio=0.1)(lambda p: graded(F.when(F.col("roll").isNotNull(), F.abs("roll") < 10), "roll=", F.col("roll").cast("string")))
    frames = spark.createDataFrame([("a", 0, 5.0, None), ("a", 1, 20.0, None), ("a", 2, 1.0, {"pose": "no model"})], "path string, frame_index int, roll double, lacks map<string,string>")
    only = Registry("frame", framed=True)
    only.checks["check_tilt"] = extra.checks["check_tilt"]
    rows = only.open(frames, None, ["path"], seq=F.lit(0).cast("long"), frame_index=F.col("frame_index")).orderBy("frame_index").collect()
    assert [(r.status, r.reason) for r in rows] == [("PASS", "frame=0 roll=5.0"), ("FAIL", "frame=1 roll=20.0"), ("SKIP", "frame=2 no model")]
    assert aggregation(extra).per_check == {"check_face_detected": 0.0, "check_tilt": 0.1}
    with pytest.raises(ValueError):
        extra.check("check_tilt")(lambda p: None)


def test_plan_of_face_rows(spark, tmp_path):
    """Frames are scanned and shuffled twice at most: for the frame checks and for the timeline."""
    face_frames(spark, "a", "FFF").withColumn("path", F.lit("a")).write.parquet(f"{tmp_path}/frames")
    plan = X.face_rows(media(spark, "a"), spark.read.parquet(f"{tmp_path}/frames"))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") <= 2
    whole = X.face_rows(media(spark, "a"), spark.read.parquet(f"{tmp_path}/frames"))._jdf.queryExecution().executedPlan().toString()
    assert sum("hashpartitioning(path" in line and "frame" in line for line in whole.split("\n")) <= 2 and "CartesianProduct" not in whole


def test_frames_are_dealt_over_tasks_by_their_number(spark):
    """Spark merges small shuffles into few tasks by their bytes, however much memory their rows then need."""
    assert X.tasks_for(0) == 1 and X.tasks_for(X.FRAMES_A_TASK) == 1 and X.tasks_for(X.FRAMES_A_TASK + 1) == 2
    names = [f"v{k}" for k in range(12)]
    of_all = spark.createDataFrame([(n,) for n in names], "filename string")
    frames = face_frames(spark, "v0", "FFLLGFF").drop("filename").crossJoin(of_all)
    files = X.files_of(media(spark, *names), {n: rule(X.FacePolicy().limits) for n, rule in M.RULES.items()}, True)
    assert X.framed(files, frames, tasks=9).rdd.getNumPartitions() == 9
    assert found(X.face_rows(media(spark, *names), frames, tasks=9)) == found(X.face_rows(media(spark, *names), frames))

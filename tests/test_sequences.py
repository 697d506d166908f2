"""Turn protocols: the scripted timelines, gap cases, and bridging against a label-by-label model."""

import random

import pytest

from veriframe.operators import sequence as S

CODES = {"F": (0, 0), "L": (-50, 0), "R": (50, 0), "D": (0, -40), "U": (0, 40), "M": (-28, 0), "G": None}
CASE = S.Protocol(pitch_floor=15, exact=False, order_policy="REVIEW", short_policy="REVIEW", gap_policy="REVIEW")


def timeline(spark, **scripts):
    rows = []
    for name, script in scripts.items():
        frames = [c for part in script.split() for c in part[0] * int(part[1:])]
        rows += [(name, k, float(k), CODES[c] is not None, *(map(float, CODES[c]) if CODES[c] else (None, None))) for k, c in enumerate(frames)]
    return spark.createDataFrame(rows, "filename string, frame_index int, timestamp_sec double, face_detected boolean, yaw double, pitch double")


SCRIPTS = {
    "good": "F5 L2 F2 R2 F2 D2 F2 U2 F2", "via_gap": "F5 M1 G2 M1 F3 R2 F2 D2 F2 U2 F2", "left_twice": "F5 L2 F2 L2 F2 D2 F2 U2 F2",
    "splice": "F5 G4 F5", "wrong_order": "F5 R2 F2 L2 F2 D2 F2 U2 F2", "short_left": "F5 L1 F2 R2 F2 D2 F2 U2 F2", "no_face": "G20",
}


def test_segment_verdicts(spark):
    out = {r.filename: r.status for r in S.turn_verdicts(timeline(spark, **SCRIPTS), CASE).where("check_name = 'check_turn_sequence'").collect()}
    assert out == {"good": "PASS", "via_gap": "REVIEW", "left_twice": "REVIEW", "splice": "REVIEW", "wrong_order": "REVIEW", "short_left": "REVIEW", "no_face": "FAIL"}


def test_turn_reasons(spark):
    out = {(r.filename, r.check_name.removeprefix("check_turn_")): (r.status, r.reason) for r in S.turn_verdicts(timeline(spark, **SCRIPTS, short_front="F2 L2 F1 R2"), CASE).collect()}
    full = "front -> left -> front -> right -> front -> down -> front -> up -> front"
    accepted = f"accepted: spec: {full}; audio_prompt: front -> left -> front -> right -> front -> up -> front -> down -> front; accepted sequence not found as one contiguous window"
    using = f"accepted sequence found: 'spec' using contiguous_subsequence at observed window 0:9; matched: {full}; observed: {full}"
    assert out["good", "sequence"] == ("PASS", using) and out["good", "left"] == ("PASS", "left detected; hold=2.0s >= 2.0s")
    assert out["good", "front"] == ("PASS", "front holds ok in matched 'spec' window: initial=5.0s >= 5.0s; return#1=2.0s >= 2.0s; return#2=2.0s >= 2.0s; return#3=2.0s >= 2.0s; return#4=2.0s >= 2.0s")
    assert out["short_left", "left"] == ("FAIL", "left turn not detected")  # one frame is bridged
    patient = S.Protocol(pitch_floor=15, exact=False, short_policy="REVIEW", hold=2.5, fps=2)
    rows = S.turn_verdicts(timeline(spark, x="F10 L3 F5"), patient).where("check_name = 'check_turn_left'")
    assert rows.first().asDict() == {"filename": "x", "check_name": "check_turn_left", "status": "REVIEW", "reason": "left detected but hold too short: 1.5s < 2.5s"}
    assert out["splice", "sequence"] == ("REVIEW", f"sequence order mismatch in contiguous_subsequence mode; observed: front; {accepted}")
    assert out["splice", "front"] == ("REVIEW", "front hold check failed in observed sequence: expected 5 front holds, found 1")
    assert out["short_front", "front"] == ("REVIEW", "front hold check failed in observed sequence: expected 5 front holds, found 2; initial front too short at segment 0:1: 2.0s < 5.0s; return#1 front too short at segment 4:4: 1.0s < 2.0s")
    assert {out["no_face", k] for k in ("front", "down", "sequence")} == {("FAIL", "front hold cannot be validated; no front-facing frame found"), ("FAIL", "down turn cannot be validated; no front-facing frame found"), ("FAIL", "no front-facing frame anywhere; cannot validate turn sequence")}


def test_unconfirmed_gap(spark):
    frames = timeline(spark, x="F5 G3 F5 L2 F2 G2 F2 R2 F2 G4")
    p = S.Protocol(exact=False, gap_policy="REVIEW", orders={"one": ("front", "left", "front", "right")})
    row = lambda **o: S.turn_verdicts(frames, o.pop("p", p), **o).where("check_name = 'check_turn_sequence'").first()
    found = "accepted sequence found: 'one' using contiguous_subsequence at observed window 0:4; matched: front -> left -> front -> right; "
    assert row().reason == found + "but matched window 0:4 contains an unconfirmed gap" and row().status == "REVIEW"
    assert row(confirm=lambda g: g["n"] < 4).reason == found + "observed: front -> left -> front -> right -> front"
    assert row(confirm=lambda g: g["first"] == 5).status == "REVIEW"
    exact = S.Protocol(gap_policy="REVIEW", orders={"one": ("front", "left", "front", "right", "front")})
    assert row(p=exact).reason.endswith("but whole observed sequence contains an unconfirmed gap")
    spaced = frames.withColumn("frame_index", frames.frame_index * 30)
    assert S.turn_verdicts(spaced, p).exceptAll(S.turn_verdicts(frames, p)).count() == 0  # places count sampled frames
    assert S.turn_verdicts(frames, S.Protocol(orders={})).where("check_name = 'check_turn_sequence'").first().reason == "no accepted_orders configured; cannot validate turn sequence"


def test_spine_of_arrays(spark):
    segs = S.segments(timeline(spark, **SCRIPTS), CASE)
    items = S.spined(segs).selectExpr("filename", "inline(items)")
    assert sorted(map(tuple, items.select("filename", "first", "last", "n", "label").collect())) == sorted(map(tuple, S.spine(segs).select("filename", "first", "last", "n", "label").collect()))


def test_presence_verdicts(spark):
    out = {r.filename: r.status for r in S.presence_verdicts(timeline(spark, **SCRIPTS), CASE).where("check_name = 'check_turn_sequence'").collect()}
    assert out == {"good": "PASS", "via_gap": "REVIEW", "left_twice": "FAIL", "splice": "REVIEW", "wrong_order": "REVIEW", "short_left": "REVIEW", "no_face": "FAIL"}


@pytest.mark.parametrize(("script", "expected", "unexpected"), [
    ("F5 L2 G3 L1 F2", {7, 8, 9}, set()), ("F5 L2 G2 F2", {7, 8}, set()), ("F5 L2 G4", {7, 8, 9, 10}, set()), ("F5 G3 F4", set(), {5, 6, 7}), ("F5 L2 G2 R2 F2", set(), {7, 8}), ("G2 F5", set(), {0, 1}),
])
def test_gap_split(spark, script, expected, unexpected):
    rows = S.gap_frames(timeline(spark, x=script), CASE).collect()
    assert {r.frame_index for r in rows if r.direction} == expected and {r.frame_index for r in rows if not r.direction} == unexpected
    assert {r.direction for r in rows if r.direction} <= {"left"}


def test_restatus_policies(spark):
    frames = timeline(spark, x="F3 L1 G2 F3 G1 F2")
    rows = frames.selectExpr("filename", "frame_index", "if(face_detected, 'PASS', 'SKIP') as status", "'r' as reason")
    for policy, want in (("PASS", "PASS"), ("BANANA", "SKIP")):
        p = S.Protocol(pitch_floor=15, expected_gap=policy, unexpected_gap="x")
        out = {r.frame_index: (r.status, r.reason) for r in S.restatus_detections(rows, S.gap_frames(frames, p), p).collect()}
        assert out[4] == (want, "r; expected gap (peak of left turn)") and out[9] == ("FAIL", "r; unexpected gap (no adjacent turn evidence)") and out[0] == ("PASS", "r")


def slow_bridge(labels, most):
    labels, changed = list(labels), True
    while changed:
        changed, i = False, 0
        while i < len(labels):
            j = i
            while j < len(labels) and labels[j] == labels[i]:
                j += 1
            before, after = (labels[i - 1] if i else None), (labels[j] if j < len(labels) else None)
            if j - i <= most and before == after and before in ("front", *S.TURNS) and labels[i] != before:
                labels[i:j] = [before] * (j - i)
                changed = True
            i = j
    return labels


def test_bridge():
    rng = random.Random(7)
    for _ in range(2000):
        labels = [rng.choice(["front", "left", "gap", "mid"]) for _ in range(rng.randint(0, 14))]
        most = rng.randint(1, 3)
        runs: list[list] = []
        for x in labels:
            if runs and runs[-1][0] == x:
                runs[-1][1] += 1
            else:
                runs.append([x, 1])
        got = S.bridge([r[0] for r in runs], [r[1] for r in runs], most)
        assert [x for x, (_, n) in zip(got, runs, strict=True) for _ in range(n)] == slow_bridge(labels, most)


UP, DOWN = "approach (growing)", "recede (shrinking)"


@pytest.mark.parametrize(("view", "values", "reason"), [
    ("F", [*range(10), *range(10, 0, -1)], f"F: toward-then-away OK (detected: {UP} then {DOWN})"), ("F", [*range(10, 0, -1), *range(10)], f"F: toward-then-away FAIL; reversed order (got {DOWN} then {UP}); spec requires {UP} then {DOWN}"),
    ("S", list(range(20)), "S: left-then-right FAIL; only one phase (move right (=>)); a there-and-back (move left (<=) then move right (=>)) was not completed"), ("F", [1] * 20, "F: toward-then-away FAIL; no sustained direction detected"),
    ("S", list(range(7)), "S: only 7 usable frame(s) < 8; too short to verify left-then-right"), (None, [1] * 20, "unknown view 'None'; cannot judge walk direction"), ("B", [1] * 20, "unknown view 'B'; cannot judge walk direction"),
])
def test_walk_reasons(spark, view, values, reason):
    df = spark.createDataFrame([("w", view, k, v / 10, v / 10) for k, v in enumerate(values)], "filename string, view string, frame_index int, body_scale double, centroid_x double")
    assert S.walk_direction(df).first().reason == reason


@pytest.mark.parametrize(("view", "values", "status"), [
    ("F", [*range(10), *range(10, 0, -1)], "PASS"), ("F", [*range(10, 0, -1), *range(10)], "FAIL"), ("F", [*range(10, 0, -1), *range(10), *range(10, 0, -1)], "PASS"),
    ("S", [*range(10, 0, -1), *range(10)], "PASS"), ("F", list(range(20)), "FAIL"), ("F", [1] * 20, "FAIL"), ("F", list(range(7)), "FAIL"), (None, [*range(10), *range(10, 0, -1)], "FAIL"),
])
def test_walk(spark, view, values, status):
    df = spark.createDataFrame([("w", view, k, v / 10, v / 10) for k, v in enumerate(values)], "filename string, view string, frame_index int, body_scale double, centroid_x double")
    assert S.walk_direction(df).first().status == status

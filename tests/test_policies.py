"""Limits from a configuration."""

from veriframe.operators import modalities as X
from veriframe.operators import policies
from veriframe.operators import sequence as S

CONFIG = {
    "face": {
        "extension": ".mp4", "metadata": {"min_fps": 6, "min_duration_sec": 41}, "size": {"min_head_width_px": 190, "min_head_height_px": 195}, "occlusion": {"skin": {"min_skin_ratio": 0.3}},
        "turn_sequence": {"enabled": True, "sequence_match_mode": "contiguous_subsequence", "order_policy": "REVIEW", "accepted_orders": {"one": ["front", "left"]}, "hold_seconds": {"front_initial": 4, "left": 3}, "tolerance": {"side_yaw_tolerance_deg": 25}},
        "checks": {"blur": {"threshold": 40.0}, "brightness": {"dark_threshold": 30}, "eyes_open": {"blink_threshold": 0.6}, "face_size": {"threshold_px": 200}, "detection": {"unexpected_gap_status": "REVIEW"}},
    },
    "palm": {"size": {"min_width_px": 210, "min_height_px": 220}, "brightness": {"enabled": False}, "hand_pose": {"spread": {"enabled": True, "min_gap_inter_tip_deg": 2.0}}, "angle": {"neutral_tol_deg": 15}, "handedness": {"expected_relation": "opposite", "min_confidence": 0.6}},
    "walk": {"brightness": {"enabled": True, "bright_threshold": 210}, "occlusion": {"conf": 0.5}, "metadata": {"min_width_px": 1280}},
    "report": {"aggregation": {"frame_fail_ratio": 0.3, "per_check_fail_ratio": {"check_eyes_open": 0.1}}},
}


def test_what_a_configuration_names(spark):
    p = policies.from_config(CONFIG, sample_fps=2, fail_fast=False)
    assert (p.face.limits.min_fps, p.face.limits.min_duration, p.face.limits.min_width, p.face.limits.min_height) == (6, 41, 190, 195)
    assert (p.face.sharp, p.face.dark, p.face.bright, p.face.blink, p.face.least_size, p.face.least_skin, p.face.fail_fast) == (40.0, 30, 220, 0.6, 200, 0.3, False)
    t = p.face.turns
    assert (t.exact, t.order_policy, t.orders, t.front_initial, t.hold, t.yaw_floor, t.pitch_floor, t.unexpected_gap, t.fps) == (False, "REVIEW", {"one": ("front", "left")}, 4, 3, 25, 20, "REVIEW", 2)
    assert (p.palm.least_size, p.palm.limits.min_height, p.palm.inter_tip, p.palm.thumb_tip, p.palm.neutral, p.palm.opposite, p.palm.confident) == (210, 220, 2.0, 20, 15, True, 0.6)
    assert p.palm.off == (("check_palm_brightness", "palm.brightness.enabled=false"),)
    assert (p.walk.brightness, p.walk.bright, p.walk.confidence, p.walk.limits.min_width, p.walk.limits.min_height, p.walk.foot_ratio) == (True, 210, 0.5, 1280, 1080, 0.1)
    assert p.rules.fail_ratio == 0.3 and p.rules.per_check == {"check_face_detected": 0.0, "check_single_person": 0.0, "check_eyes_open": 0.1} | dict.fromkeys(("check_person_detected", "check_person_fully", "check_person_blur", "check_brightness", "check_occlusion"), 0.2)


def test_nothing_named(spark):
    p = policies.from_config({})
    assert p.walk == X.WalkPolicy() and p.palm == X.PalmPolicy() and p.face.turns == S.Protocol(fps=5)
    assert policies.from_config({"face": {"turn_sequence": {"enabled": False}}}).face.turns is None

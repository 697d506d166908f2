"""Limits of all three modalities from one configuration, as `sources.media.load_config` reads it. What it doesn't name keeps its default.

These are also the thresholds that charts draw: each is one attribute of a policy.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

from veriframe.operators import metadata as M
from veriframe.operators import modalities as X
from veriframe.operators import sequence as S
from veriframe.operators.checks import aggregation
from veriframe.operators.report import Aggregation

#: What rows of palm checks say that are switched off, and the switches.
SWITCHES = {
    "check_palm_handedness": ("handedness", "enabled"), "check_palm_brightness": ("brightness", "enabled"), "check_palm_spread": ("hand_pose", "spread", "enabled"),
    "check_palm_fully": ("visibility", "check_palm_fully_enabled"),
}


def at(config: dict, *path: str) -> Any:
    """The value at a path, or None."""
    for key in path:
        config = config.get(key) if isinstance(config, dict) else None
    return config


def changed(policy: Any, **values: Any) -> Any:
    """policy with the values that are given."""
    return replace(policy, **{k: v for k, v in values.items() if v is not None})


def limits(config: dict, modality: str, base: M.Limits, sizes: tuple[tuple[str, ...], tuple[str, ...]]) -> M.Limits:
    own = config.get(modality) or {}
    return changed(base, min_fps=at(own, "metadata", "min_fps"), min_duration=at(own, "metadata", "min_duration_sec"), extension=own.get("extension"), min_width=at(own, *sizes[0]), min_height=at(own, *sizes[1]))


def protocol(config: dict, fps: float) -> S.Protocol | None:
    """The turn protocol at a sampling rate; None if turns are switched off."""
    turn = at(config, "face", "turn_sequence") or {}
    if turn.get("enabled") is False:
        return None
    near, hold, gaps = turn.get("tolerance") or {}, turn.get("hold_seconds") or {}, at(config, "face", "checks", "detection") or {}
    mode = turn.get("sequence_match_mode")
    return changed(
        S.Protocol(fps=fps), yaw_floor=near.get("side_yaw_tolerance_deg"), pitch_floor=near.get("tilt_pitch_tolerance_deg"), front_yaw=near.get("front_zone_yaw_deg"), front_pitch=near.get("front_zone_pitch_deg"),
        jitter=near.get("label_jitter_tolerance_sec"), orders=None if turn.get("accepted_orders") is None else {k: tuple(v) for k, v in turn["accepted_orders"].items()}, exact=None if mode is None else mode == "exact",
        order_policy=turn.get("order_policy"), short_policy=turn.get("short_hold_policy"), gap_policy=turn.get("unconfirmed_gap_policy"), front_initial=hold.get("front_initial"),
        hold=hold.get("left"), expected_gap=gaps.get("expected_gap_status"), unexpected_gap=gaps.get("unexpected_gap_status"))


@dataclass(frozen=True)
class Policies:
    face: X.FacePolicy
    palm: X.PalmPolicy
    walk: X.WalkPolicy
    rules: Aggregation


def from_config(config: dict, *, sample_fps: float = 5, fail_fast: bool = True) -> Policies:
    checks, palm, walk = at(config, "face", "checks") or {}, config.get("palm") or {}, config.get("walk") or {}
    face_size, palm_size, walk_size = (("size", "min_head_width_px"), ("size", "min_head_height_px")), (("size", "min_width_px"), ("size", "min_height_px")), (("metadata", "min_width_px"), ("metadata", "min_height_px"))
    face = changed(
        X.FacePolicy(limits=limits(config, "face", M.FACE, face_size), fail_fast=fail_fast), least_size=at(checks, "face_size", "threshold_px"), blink=at(checks, "eyes_open", "blink_threshold"), dark=at(checks, "brightness", "dark_threshold"),
        bright=at(checks, "brightness", "bright_threshold"), sharp=at(checks, "blur", "threshold"), least_skin=at(config, "face", "occlusion", "skin", "min_skin_ratio"))
    gaps, angle = at(palm, "hand_pose", "spread") or {}, palm.get("angle") or {}
    off = tuple((check, f"palm.{'.'.join(path)}=false") for check, path in SWITCHES.items() if at(palm, *path) is False)
    relation = at(palm, "handedness", "expected_relation")
    palms = changed(
        X.PalmPolicy(limits=limits(config, "palm", M.Limits(extension=".jpg"), palm_size), off=off), least_size=at(palm, "size", "min_width_px"), many=at(config, "models", "hands", "multiple_hands_policy"),
        dark=at(palm, "brightness", "dark_threshold"), bright=at(palm, "brightness", "bright_threshold"), thumb_tip=gaps.get("min_gap_thumb_tip_deg"), inter_tip=gaps.get("min_gap_inter_tip_deg"), thumb_pip=gaps.get("min_gap_thumb_pip_deg"),
        inter_pip=gaps.get("min_gap_inter_pip_deg"), margin=gaps.get("frame_margin"), most=angle.get("max_abs_deg"), least=angle.get("min_rotation_deg"), neutral=angle.get("neutral_tol_deg"),
        confident=at(palm, "handedness", "min_confidence"), opposite=None if relation is None else relation == "opposite")
    walks = changed(
        X.WalkPolicy(limits=limits(config, "walk", M.WALK, walk_size), fail_fast=fail_fast), least_height=at(walk, "visibility", "min_person_height_ratio"), sharp=at(walk, "blur", "threshold"), brightness=at(walk, "brightness", "enabled"),
        dark=at(walk, "brightness", "dark_threshold"), bright=at(walk, "brightness", "bright_threshold"), confidence=at(walk, "occlusion", "conf"), foot_ratio=at(walk, "occlusion", "foot_band_ratio"))
    roll_up = at(config, "report", "aggregation") or {}
    rules = aggregation(X.FACE_FILE, X.FACE_FRAME, X.PALM, X.WALK_FILE, X.WALK_FRAME, **{k: roll_up[f"frame_{k}"] for k in ("fail_ratio", "review_ratio") if f"frame_{k}" in roll_up})
    rules = replace(rules, per_check=rules.per_check | (roll_up.get("per_check_fail_ratio") or {}))
    return Policies(replace(face, turns=protocol(config, sample_fps)), palms, walks, rules)

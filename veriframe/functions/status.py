"""Statuses, their ranks and the report's order of checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PASS, FAIL, REVIEW, SKIP = "PASS", "FAIL", "REVIEW", "SKIP"
# Ranks of statuses (the worst is the highest), levels, and the places of checks in reports.
RANK = {"SKIP": 0, "PASS": 1, "REVIEW": 2, "FAIL": 3}
LEVELS = {"video": 0, "sequence": 1, "frame": 2}
FACE_ORDER = {
    "check_container": 10, "check_fps": 20, "check_duration": 30, "check_resolution": 40, "frames_sampled": 50, "frame_checks": 60,
    "check_face_detected": 100, "check_head_fully": 110, "check_face_size": 200, "check_eyes_open": 210, "check_brightness": 220,
    "check_face_blur": 230, "check_occlusion": 240, "check_turn_left": 300, "check_turn_right": 310, "check_turn_down": 320,
    "check_turn_up": 330, "check_turn_front": 340, "check_turn_sequence": 350,
}
WALK_ORDER = {
    "check_container": 10, "check_fps": 20, "check_duration": 30, "check_resolution": 40, "frames_sampled": 50, "frame_checks": 60,
    "check_person_detected": 100, "check_single_person": 105, "check_person_fully": 110, "check_body_height": 200, "check_brightness": 230,
    "check_person_blur": 240, "check_occlusion": 250, "check_walk_direction": 300,
}


def said(status: str | Column, *text: Column | str) -> Column:
    """A verdict with its reason: struct<status, reason>."""
    return F.struct((F.lit(status) if isinstance(status, str) else status).alias("status"), F.concat(*(F.lit(t) if isinstance(t, str) else t for t in text)).alias("reason"))


def lookup(values: dict[str, int], key: Column, default: int | None = None) -> Column:
    found = F.try_element_at(F.create_map(*(F.lit(x) for kv in values.items() for x in kv)), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def rank(status: Column) -> Column:
    return lookup(RANK, status, -1)


def report_order(check: Column, level: Column, data_type: Column) -> Column:
    """A struct to order checks by: known checks by their place, the others after them by level and name."""
    place = F.when(F.coalesce(data_type.startswith("walk"), F.lit(False)), lookup(WALK_ORDER, check)).otherwise(lookup(FACE_ORDER, check))
    return F.struct(place.isNull().cast("int").alias("unknown"), F.coalesce(place, lookup(LEVELS, level, 99)).alias("place"), F.when(place.isNull(), check).otherwise("").alias("name"))

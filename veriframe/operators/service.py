"""What a client of the results can ask: listings, one volunteer, comparisons, dashboards' tables, progress and exports.

Inputs are the tables that the roll-ups write: ``summary`` has a row per failed check or clean file
(data_type, volunteer_id, filename, overall_status, check_name, reason).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from veriframe.functions.status import FAIL, PASS, lookup
from veriframe.operators.filenames import PALM_KEYS, palm_pose_key
from veriframe.sources.store import ResultStore

VIEWS = ("F", "S")


def results(summary: DataFrame, status: str | None = None) -> DataFrame:
    return summary if status is None else summary.where(F.upper("overall_status") == status.upper())


def volunteers(summary: DataFrame) -> DataFrame:
    return summary.where(F.coalesce("volunteer_id", F.lit("")) != "").select("volunteer_id").distinct().orderBy("volunteer_id")


def volunteer_overall(summary: DataFrame) -> DataFrame:
    """Per volunteer: FAIL if any file failed, else PASS; modalities, files, and the files that failed. A file's rows become one first, so that
    nothing is counted as distinct within a volunteer."""
    files = summary.groupBy("volunteer_id", "data_type", "filename").agg(F.max(F.upper("overall_status") == FAIL).alias("bad"))
    return files.groupBy("volunteer_id").agg(
        F.when(F.max("bad"), FAIL).otherwise(PASS).alias("status"), F.array_sort(F.collect_set("data_type")).alias("modalities"),
        F.count("*").alias("n_files"), F.count_if("bad").alias("n_failed"), F.array_sort(F.collect_set(F.when(F.col("bad"), F.col("filename")))).alias("problem_files"),
    )


def volunteer_checks(summary: DataFrame, volunteer_id: str) -> DataFrame:
    return summary.where(F.col("volunteer_id") == volunteer_id).orderBy("data_type", "filename", "check_name")


def headline(summary: DataFrame) -> DataFrame:
    """How many volunteers have which status, by the first row of each."""
    first = W.Window.partitionBy("volunteer_id").orderBy("data_type", "filename", "check_name")
    return summary.withColumn("__n", F.row_number().over(first)).where("__n = 1").groupBy("overall_status").agg(F.count("*").alias("volunteers"))


def failures_headline(summary: DataFrame) -> DataFrame:
    bad = summary.where(F.upper("overall_status").isin("FAIL", "ERROR"))
    return bad.agg(F.count_distinct("data_type", "volunteer_id").alias("deliveries"), F.count_if(F.coalesce("check_name", F.lit("")) != "").alias("failed_checks"))


def combined_verdict(status: Column) -> Column:
    """Of a group: FAIL or ERROR, else REVIEW, else PASS; INCOMPLETE for none."""
    has = lambda *s: F.max(F.upper(status).isin(*s))
    return F.when(has("FAIL", "ERROR"), FAIL).when(has("REVIEW"), "REVIEW").when(F.count(status) > 0, PASS).otherwise("INCOMPLETE")


def slots(ids: DataFrame, names: list[str]) -> DataFrame:
    return ids.select("volunteer_id", F.explode(F.array(*map(F.lit, names))).alias("slot"))


def palm_grid(images: DataFrame, keys: list[str] = PALM_KEYS) -> DataFrame:
    """Each volunteer's expected palm images with their status, MISSING where there is none. images: (volunteer_id, slot, status)."""
    found = images.groupBy("volunteer_id", "slot").agg(F.min("status").alias("status"))
    return slots(images.select("volunteer_id").distinct(), keys).join(found, ["volunteer_id", "slot"], "left").fillna("MISSING", ["status"])


def walk_grid(files: DataFrame) -> DataFrame:
    return palm_grid(files, list(VIEWS))


def grid_verdict(grid: DataFrame) -> DataFrame:
    """Per volunteer: the combined verdict of what is there, and counts of present and missing."""
    there = F.when(F.col("status") != "MISSING", F.col("status"))
    return grid.groupBy("volunteer_id").agg(combined_verdict(there).alias("verdict"), F.count(there).alias("present"), F.count_if(F.col("status") == "MISSING").alias("missing"))


def compare(checks: DataFrame, a: str, b: str) -> DataFrame:
    """Two files' verdicts side by side over all checks of either; a dash where one has none."""
    side = lambda f, n: checks.where(F.col("filename") == f).groupBy("check_name").agg(F.first("final_status").alias(n))
    both = side(a, "a").join(side(b, "b"), "check_name", "full")
    return both.select("check_name", F.coalesce("a", F.lit("—")).alias("a"), F.coalesce("b", F.lit("—")).alias("b"), F.coalesce("a", F.lit("—")).eqNullSafe(F.coalesce("b", F.lit("—"))).alias("same"))


def neutral_deltas(angles: DataFrame) -> DataFrame:
    """Rotated poses against the neutral pose of the same volunteer and hand. angles: (volunteer_id, hand, pose, roll, pitch)."""
    neutral = angles.where("pose = 'N'").select("volunteer_id", "hand", F.col("roll").alias("n_roll"), F.col("pitch").alias("n_pitch"))
    return angles.where("pose <> 'N'").join(neutral, ["volunteer_id", "hand"]).select("volunteer_id", "hand", "pose", (F.col("roll") - F.col("n_roll")).alias("d_roll"), (F.col("pitch") - F.col("n_pitch")).alias("d_pitch"))


def progress(summary: DataFrame, total: int) -> DataFrame:
    """Files done (distinct names by modality) and the share of the expected total, null if that is zero."""
    done = summary.groupBy("data_type").agg(F.count_distinct("filename").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("done"))
    return done.select("done", F.lit(total).cast("long").alias("total"), (F.round(F.col("done") / total, 3) if total else F.lit(None).cast("double")).alias("share"))


def chart_domain(timeline: DataFrame, column: str, threshold: float) -> DataFrame:
    """Per file, half the height of a chart of signed values: at least 10, and room above the largest and the threshold."""
    most = F.greatest(F.max(F.abs(column)), F.lit(float(threshold)))
    return timeline.groupBy("filename").agg(F.greatest(F.lit(10.0), most * 1.15).alias("domain"), F.count_if(F.col(column).isNull()).alias("breaks"))


def short_text(x: Column, most: int) -> Column:
    return F.left(F.trim(F.regexp_replace(x, r"\s+", " ")), F.lit(most))


def duration_text(seconds: Column) -> Column:
    """Seconds below a minute, else minutes and seconds."""
    whole = F.floor(seconds)
    return F.when(seconds < 60, F.concat(F.format_string("%.1f", seconds), F.lit("s"))).otherwise(F.concat(F.floor(whole / 60).cast("string"), F.lit("m "), (whole % 60).cast("string"), F.lit("s")))


# The dashboards' own order of checks; unknown ones come last, by name.
DASHBOARD_ORDER = {
    "check_container": 10, "check_fps": 20, "check_duration": 30, "check_resolution": 40, "frames_sampled": 50, "frame_checks": 60,
    "check_face_detected": 100, "check_head_fully": 110, "check_face_size": 200, "check_eyes_open": 210, "check_brightness": 220, "check_face_blur": 230,
    "check_turn_left": 300, "check_turn_right": 310, "check_turn_down": 320, "check_turn_up": 330, "check_turn_sequence": 340,
}


def dashboard_order(checks: DataFrame) -> DataFrame:
    """The distinct checks with their place on a dashboard."""
    place = lookup(DASHBOARD_ORDER, F.col("check_name"), 9999)
    return checks.select("check_name").distinct().select("check_name", place.alias("place")).orderBy("place", "check_name")


def overlay_spec(det: DataFrame) -> DataFrame:
    """What an overlay shows per box: its label with the confidence, and the colour of its verdict. det: with ``hits``."""
    colour = F.when(F.col("hits").isNull(), "grey").when(F.col("hits"), "red").otherwise("green")
    return det.select("filename", "frame_index", "x", "y", "w", "h", F.concat("cls_name", F.lit(" "), F.bround(F.col("conf") * 100).cast("int").cast("string"), F.lit("%")).alias("label"), colour.alias("colour"))


def palm_detail(rows: DataFrame, keys: list[str], check: str = "check_palm_angle") -> DataFrame:
    """One check's rows of palm stills with ``position``, the place of their pose among the configured keys (those of other files last)."""
    key = palm_pose_key(F.col("filename"))
    place = F.array_position(F.array(*map(F.lit, keys)), key)
    shown = rows.where(F.col("check_name") == check)
    return shown.select("volunteer_id", "data_type", "filename", "check_name", "status", "reason", F.when(place > 0, place - 1).otherwise(len(keys)).cast("int").alias("position"))


def volunteer_results(stores: dict[str, ResultStore], volunteer: str) -> dict[str, DataFrame]:
    """What each store (overall, result, detail, ...) has of a volunteer; each is read by its one bucket."""
    return {name: store.lookup(volunteer) for name, store in stores.items()}

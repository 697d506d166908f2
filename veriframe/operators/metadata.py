"""Checks of media metadata, the gates that stop a file early, and the sampling grid.

Unknown metadata fails (it can't be verified), so each rule has an explicit branch for null. The gates are semi and anti
joins or windows placed before frames are decoded, where dropping a file saves the most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from veriframe.functions.status import FAIL, PASS, SKIP


@dataclass(frozen=True)
class Limits:
    min_fps: float = 5
    min_duration: float = 40
    min_width: int = 180
    min_height: int = 180
    extension: str = ".mp4"
    require_color: bool = True


FACE = Limits()
WALK = Limits(min_fps=30, min_duration=15, min_width=1920, min_height=1080)
CHECKS = ("check_container", "check_fps", "check_duration", "check_resolution")


def verdict(status: str, *text: Column | str) -> Column:
    return F.struct(F.lit(status).alias("status"), F.concat(*(F.lit(t) if isinstance(t, str) else t.cast("string") for t in text)).alias("reason"))


def fixed(x: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", x)


def check_container(m: Limits) -> Column:
    ext, channels = F.col("extension"), F.col("channel_count")
    out = verdict(PASS, "container ok (", ext, ", ", F.coalesce(channels.cast("string"), F.lit("None")), " channels)")
    if m.require_color:
        out = F.when(channels.isNull() | (channels < 3), verdict(FAIL, "channel count unknown (cannot verify RGB)")).when(~F.coalesce("is_color", F.lit(False)), verdict(FAIL, "grayscale content (channels identical; not true RGB)")).otherwise(out)
    bad = F.coalesce(ext, F.lit("None")) != m.extension
    return F.when(~F.coalesce("readable", F.lit(False)), verdict(FAIL, "unreadable: ", F.coalesce("meta_reason", F.lit("")))).when(bad, verdict(FAIL, "extension=", F.coalesce(ext, F.lit("None")), f" != {m.extension}")).otherwise(out)


def at_least(name: str, value: Column, least: float, digits: int) -> Column:
    return (
        F.when(value.isNull() | F.isnan(value), verdict(FAIL, f"{name} unknown (cannot verify against spec)"))
        .when(value >= least, verdict(PASS, f"{name}=", fixed(value, digits), f" >= {least}"))
        .otherwise(verdict(FAIL, f"{name}=", fixed(value, digits), f" < {least}"))
    )


def check_fps(m: Limits) -> Column:
    return at_least("fps", F.col("fps"), m.min_fps, 2)


def check_duration(m: Limits) -> Column:
    return at_least("duration", F.col("duration_sec"), m.min_duration, 1)


def check_resolution(m: Limits) -> Column:
    w, h = F.col("width"), F.col("height")
    size = F.concat(F.lit("resolution="), w.cast("string"), F.lit("x"), h.cast("string"))
    need = f"{m.min_width}x{m.min_height}"
    return F.when(w.isNull() | h.isNull(), verdict(FAIL, "resolution unknown (cannot verify against spec)")).when((w >= m.min_width) & (h >= m.min_height), verdict(PASS, size, f" >= {need}")).otherwise(verdict(FAIL, size, f" < {need}"))


RULES = {"check_container": check_container, "check_fps": check_fps, "check_duration": check_duration, "check_resolution": check_resolution}


def is_walk() -> Column:
    return F.col("data_type").startswith("walk")


def metadata_rows(media: DataFrame, face: Limits = FACE, walk: Limits = WALK) -> DataFrame:
    """A row per file and metadata check. An unreadable walk file skips all four; an unreadable face file is graded."""
    unreadable = is_walk() & ~F.coalesce("readable", F.lit(False))
    skip = verdict(SKIP, "video not readable: ", F.coalesce("meta_reason", F.lit("")))
    each = [F.struct(F.lit(n).alias("check_name"), F.when(unreadable, skip).when(is_walk(), rule(walk)).otherwise(rule(face)).alias("v"), F.lit(k + 1).cast("long").alias("row_seq")) for k, (n, rule) in enumerate(RULES.items())]
    rows = media.select("volunteer_id", "data_type", "filename", F.explode(F.array(*each)).alias("x"))
    return rows.select("volunteer_id", "data_type", "filename", F.lit("video").alias("level"), "x.check_name", "x.v.status", "x.v.reason", F.lit(None).cast("int").alias("frame_index"), "x.row_seq")


def fail_fast_rows(rows: DataFrame) -> DataFrame:
    """The SKIP row of each file that a metadata check fails, naming the first that does."""
    first = F.min_by("check_name", F.when(F.col("status") == FAIL, F.col("row_seq"))).alias("first")
    failed = rows.groupBy("volunteer_id", "data_type", "filename").agg(first).where("first is not null")
    return failed.select("volunteer_id", "data_type", "filename", F.lit("frame_checks").alias("check_name"), F.lit(SKIP).alias("status"), F.concat(F.lit("fail-fast: "), "first", F.lit(" failed; frame checks skipped")).alias("reason"))


def passing_gate(media: DataFrame, rows: DataFrame) -> DataFrame:
    """Files that no metadata check fails: only these are decoded."""
    failed = rows.where(F.col("status") == FAIL).select("filename").distinct()
    return media.where(F.coalesce("readable", F.lit(False))).join(failed, "filename", "left_anti")


def unreadable_rows(media: DataFrame) -> DataFrame:
    return media.where(~F.coalesce("readable", F.lit(False))).select("volunteer_id", "data_type", "filename", F.lit("frame_checks").alias("check_name"), F.lit(SKIP).alias("status"), F.concat(F.lit("unreadable: "), F.coalesce("meta_reason", F.lit(""))).alias("reason"))


def frames_sampled(media: DataFrame, frames: DataFrame) -> DataFrame:
    """FAIL for files of which no frame was read, else PASS with the count."""
    n = F.coalesce("n", F.lit(0))
    counted = media.join(frames.groupBy("filename").agg(F.count("*").alias("n")), "filename", "left")
    return counted.select("filename", F.when(n == 0, FAIL).otherwise(PASS).alias("status"), F.concat(n.cast("string"), F.lit(" frames")).alias("reason"))


def truncate_at_first(frames: DataFrame, bad: Column) -> DataFrame:
    """Frames up to the first bad one of each file, itself included (all, if there is none)."""
    first = F.min(F.when(bad, F.col("frame_index"))).over(W.Window.partitionBy("filename"))
    return frames.withColumn("__first", first).where(F.col("__first").isNull() | (F.col("frame_index") <= F.col("__first"))).drop("__first")


def single_person(frames: DataFrame, multi: Column) -> DataFrame:
    """One FAIL per file with more than one person in a frame, at the first such frame."""
    return frames.where(multi).groupBy("filename").agg(F.min("frame_index").alias("frame_index")).select("filename", F.lit("check_single_person").alias("check_name"), F.lit(FAIL).alias("status"), "frame_index")


def sample_grid(media: DataFrame, *, sample_fps: float | None = 5, first: bool = True, last: bool = True, max_frames: int = 10000) -> DataFrame:
    """(filename, frame_index, timestamp_sec): every step-th frame (without a rate every frame), with the first and last, thinned evenly to the cap.

    The grid of a file is one array expression; files without a frame count or rate have none (`sources.media.sequential_frames` reads them).
    """
    n, fps = F.col("frame_count"), F.col("fps")
    step = F.greatest(F.lit(1), F.bround(fps / sample_fps).cast("int")) if sample_fps and sample_fps > 0 else F.lit(1)
    ends = [F.lit(0)] * first + [n - 1] * last
    grid = F.sequence(F.lit(0), n - 1, step)
    grid = F.array_sort(F.array_distinct(F.concat(grid, F.array(*ends)) if ends else grid))
    stride = F.ceil(F.size("grid") / F.lit(max_frames)).cast("int")
    thinned = F.filter("grid", lambda x, i: i % F.col("stride") == 0)
    known = media.where((n > 0) & (fps > 0)).select("filename", "fps", grid.alias("grid")).withColumn("stride", stride)
    return known.select("filename", "fps", F.explode(thinned).alias("frame_index")).select("filename", "frame_index", (F.col("frame_index") / F.col("fps")).alias("timestamp_sec"))

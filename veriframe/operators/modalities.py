"""The three modalities from observations to check rows: metadata, gates, frame checks with reasons, sequences.

Observations are what decoders and detectors found, a row per file (media), frame or still. Files are told apart by ``path`` (by
``filename`` where there is none), so copies of a file don't mix. Two branches make all rows of videos:

* frames, in one partitioning by file: what ends a file early is a column (windows), and so is the turn that explains a gap; the registry
  of frame checks is opened on what is left;
* files: frames fold into runs in the same partitioning, one row a file is left, joined with the file's metadata, and the registry of
  file checks (metadata, gates, frames sampled, turns or direction) is opened on it.

Gates are columns: ``fail_fast=False`` judges all frames of a file that fails its metadata, or that shows several people, and both modes have
one plan. Errors are columns as well. ``error`` of a file: its processing broke off, and a row ``processing_error`` is all that it
gets. ``error`` of a frame: so it did there; a face file then has that row alone, a walk counts its frames before. ``lacks`` (map<capability,
why>): checks that need the capability are skipped. All three are optional.

The result has the columns of check rows (volunteer_id, data_type, filename, path, level, check_name, status, reason, frame_index, row_seq),
which `operators.report` rolls up.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from veriframe.functions.status import FAIL, PASS, SKIP, said
from veriframe.operators import detections as D
from veriframe.operators import geometry as G
from veriframe.operators import metadata as M
from veriframe.operators import report as R
from veriframe.operators import sequence as S
from veriframe.operators.checks import TAIL, Registry, graded

FILE = ["volunteer_id", "data_type", "filename"]
KEYS = [*FILE, "path"]
ROW = [*KEYS, *TAIL]
#: Places of rows that come after all frames.
AFTER = 1 << 40


# Verdicts with reasons: struct<status, reason>


def judged(ok: Column, good: list[Column | str], bad: list[Column | str]) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), said(PASS, *good)).otherwise(said(FAIL, *bad))


def number(x: Column, digits: int = 0, sign: str = "") -> Column:
    return F.when(x.isNotNull(), F.format_string(f"%{sign}.{digits}f", x))  # a null would be written as text


def size_said(what: str, width: Column, height: Column, least_width: int, least_height: int) -> Column:
    size, need = F.concat(F.lit(f"{what}="), width.cast("string"), F.lit("x"), height.cast("string")), f"{least_width}x{least_height}"
    seen = judged((width >= least_width) & (height >= least_height), [size, f" >= {need}"], [size, f" < {need}"])
    return F.when(width.isNull() | height.isNull(), said(FAIL, "No bounding box provided")).otherwise(seen)


def eyes_said(left: Column, right: Column, limit: float = 0.5) -> Column:
    scores = [F.lit("blinkL="), number(left, 2), F.lit(", blinkR="), number(right, 2)]
    seen = judged((left < limit) & (right < limit), ["eyes open (", *scores, f" < {limit})"], ["eye(s) closed (", *scores, f" >= {limit})"])
    return F.when(left.isNull() | right.isNull(), said(FAIL, "Blink blendshapes missing (eyeBlinkLeft/Right)")).otherwise(seen)


def brightness_said(value: Column, dark: float = 35, bright: float = 220, *, missing: str = "no_face") -> Column:
    b, low, high = F.bround(value).cast("int").cast("string"), str(round(dark)), str(round(bright))
    return (
        F.when(value.isNull(), said(FAIL, missing)).when(value < dark, said(FAIL, "brightness=", b, f" < {low}; too_dark"))
        .when(value > bright, said(FAIL, "brightness=", b, f" > {high}; too_bright")).otherwise(said(PASS, "brightness=", b, f"; normal; {low} <= ", b, f" <= {high}"))
    )


def walk_brightness_said(value: Column, dark: float = 35, bright: float = 220) -> Column:
    """The other way round: passes outside the limits."""
    n, low, high = F.bround(value).cast("int"), round(dark), round(bright)
    b = n.cast("string")
    return (
        F.when(value.isNull(), said(FAIL, "no_body")).when(n < low, said(PASS, "brightness=", b, f" < {low}; walk_pass (dark)"))
        .when(n > high, said(PASS, "brightness=", b, f" > {high}; walk_pass (bright)")).otherwise(said(FAIL, "brightness=", b, f"; walk_fail; {low} <= ", b, f" <= {high} (normal-lit)"))
    )


def blur_said(brightness: Column, sharpness: Column, limit: float = 50) -> Column:
    """brightness: the verdict on it, which comes first, so that one cause isn't reported twice."""
    text = [F.lit("sharpness="), number(sharpness, 1), F.lit(f" threshold={limit:.1f}")]
    seen = F.when(sharpness.isNull(), said(SKIP, "blur not judged: invalid image")).otherwise(judged(sharpness >= limit, text, text))
    return F.when(brightness["status"] == FAIL, said(SKIP, "brightness failed; blur not judged: ", brightness["reason"])).otherwise(seen)


def region_blur_said(sharpness: Column, luma: Column, contrast: Column, box: Column, limit: float = 35, *, least_luma: float = 35, least_contrast: float = 4, method: str = "clahe") -> Column:
    """Three-valued, with what was measured: too dark or too flat a region isn't judged."""
    place = F.concat(F.lit("("), F.concat_ws(", ", *(box[c].cast("int").cast("string") for c in "xywh")), F.lit(")"))
    dark = F.when(luma < least_luma, F.concat(F.lit("blur not judged: face too dark; luma="), number(luma, 1), F.lit(f" < {least_luma:.1f}")))
    flat = F.when(contrast < least_contrast, F.concat(F.lit("blur not judged: too little local contrast; contrast="), number(contrast, 1), F.lit(f" < {least_contrast:.1f}")))
    none = F.when(sharpness.isNull() | luma.isNull() | contrast.isNull(), F.lit("blur not judged: invalid image"))
    unjudged = F.coalesce(none, dark, flat)
    text = F.concat(F.lit("sharpness="), number(sharpness, 1), F.lit(f" threshold={limit:.1f}; luma="), number(luma, 1), F.lit("; contrast="), number(contrast, 1), F.lit(f"; method=tenengrad_{method}; bbox="), place)
    return graded(F.when(unjudged.isNull(), sharpness >= limit), F.coalesce(unjudged, text))


#: The regions of a face, in the order of reports.
REGIONS = ("forehead", "left_eye", "right_eye", "nose", "mouth", "left_cheek", "right_cheek")


def occlusion_said(ratios: Column, required: tuple[str, ...] = ("left_eye", "right_eye", "nose", "mouth"), least: float = 0.4) -> Column:
    """ratios: map<region, share of skin>."""
    ratio = lambda r: F.try_element_at(ratios, F.lit(r))
    text = lambda r: F.coalesce(number(ratio(r), 2), F.lit("NA"))
    covered = F.array_compact(F.array(*(F.when(~F.coalesce(ratio(r) >= least, F.lit(False)), F.concat(F.lit(f"{r}(skin="), text(r), F.lit(")"))) for r in required)))
    every = F.concat_ws(" ", *(F.concat(F.lit(f"{r}="), text(r)) for r in REGIONS))
    limit = f"; min_skin_ratio={least:.2f}"
    return judged(F.size(covered) == 0, ["no occlusion; ", every, limit], ["occluded: ", F.array_join(covered, ", "), "; ", every, limit])


def body_height_said(ratio: Column, least: float = 0.5) -> Column:
    text = [F.lit("body_height="), number(ratio, 2)]
    return F.when(ratio.isNull(), said(FAIL, "too few visible landmarks")).otherwise(judged(ratio >= least, [*text, f" >= {least:.2f}"], [*text, f" < {least:.2f}"]))


def person_fully_said(missing: Column, outside: Column) -> Column:
    part = lambda names, what: F.when(F.size(names) > 0, F.concat(F.lit(what), F.array_join(names, ", ")))
    parts = F.concat_ws("; ", part(missing, "missing: "), part(outside, "out of frame: "))
    return judged(parts == "", ["person fully visible (all 8 key landmarks in frame)"], ["person not fully visible (", parts, ")"])


def handedness_said(label: Column, score: Column, hand: Column, pose: Column, *, opposite: bool = False, least: float = 0.7) -> Column:
    relation = "opposite" if opposite else "same"
    known = F.when(F.upper(hand).isin("L", "LEFT"), "Left").when(F.upper(hand).isin("R", "RIGHT"), "Right")
    expected = F.when((known == "Left") != F.lit(opposite), "Left").otherwise("Right")
    seen = F.when(F.upper(label).isin("L", "LEFT"), "Left").when(F.upper(label).isin("R", "RIGHT"), "Right")
    text = F.coalesce(number(score, 2), F.lit("NA"))
    none = lambda x: F.coalesce(x, F.lit("None"))
    return (
        F.when(pose != "N", said(SKIP, "pose=", pose, " not graded (handedness checked on N only; label unreliable on tilted poses)"))
        .when(known.isNull(), said(SKIP, "handedness not graded: unknown filename hand '", none(hand), "' (label=", none(label), ", score=", text, ")"))
        .when(seen.isNull(), said(SKIP, "handedness not graded: no label (filename=", known, ", label=", none(label), ", score=", text, ")"))
        .when(seen == expected, said(PASS, "handedness ok: filename=", known, " matches label=", seen, " (score=", text, f", relation={relation})"))
        .when(score < least, said(SKIP, "handedness mismatch but low-confidence (skipped): filename=", known, " expects ", expected, ", got ", seen, " score=", text, f" < {least:g} (relation={relation})"))
        .otherwise(said(FAIL, "handedness MISMATCH: filename=", known, " expects ", expected, " but got ", seen, " (score=", text, f" >= {least:g}, relation={relation}) -- likely wrong hand submitted"))
    )


def pose_said(a: Column, hand: Column, pose: Column, *, most: float = 45, least: float = 10, neutral: float = 10) -> Column:
    """Each pose by its own angles; a turned pose's other axis is told but doesn't count. a: struct<roll, pitch, error>."""
    roll, pitch = number(a["roll"], 1, "+"), number(a["pitch"], 1, "+")
    name = F.concat(F.upper(hand), F.lit("/"), pose)
    within = F.lit(f"within +/-{neutral:g}")
    off = F.concat_ws(", ", *(F.when(F.abs(a[c]) > neutral, F.concat(F.lit(f"{c}="), x, F.lit(f" not within +/-{neutral:g}"))) for c, x in (("roll", roll), ("pitch", pitch))))
    flat = judged((F.abs(a["roll"]) <= neutral) & (F.abs(a["pitch"]) <= neutral), [name, " ok: raw roll=", roll, ", pitch=", pitch, " ", within], [name, " fail (not neutral): ", off])
    out = F.when(a.isNull() | a["error"].isNotNull(), said(FAIL, name, ": no hand to measure (likely over-rotation or bad capture)")).when(pose == "N", flat)
    for key in G.POSE_AXIS:
        axis, low, high = G.band(key, most=most, least=least)
        mine, other = (roll, pitch) if axis == "roll" else (pitch, roll)
        text, range_, rest = F.concat(F.lit(f"raw {axis}="), mine), f"[{low:g},{high:g}], ", F.concat(F.lit("pitch=" if axis == "roll" else "roll="), other)
        out = out.when(pose == key, judged((a[axis] >= low) & (a[axis] <= high), [name, " ok: ", text, " within ", range_, rest], [name, " fail: ", text, " not in ", range_, rest]))
    return out.otherwise(said(FAIL, "unknown pose '", F.coalesce(pose, F.lit("None")), "' (expected N/RL/RR/PU/PD)"))


def angle_said(a: Column, most_roll: float = 45, most_pitch: float = 45) -> Column:
    """Both angles within their bounds. a: struct<roll, pitch, error>."""
    roll, pitch = number(a["roll"], 1), number(a["pitch"], 1)
    good = [F.lit("roll="), roll, F.lit(" pitch="), pitch, F.lit(f" within +/-{most_roll:g}/+/-{most_pitch:g}")]
    part = lambda name, x, text, most: F.concat(F.lit(f"{name}="), text, F.when(F.abs(x) <= most, " ok").otherwise(f" > {most:g}"))
    bad = F.concat_ws(" ", part("roll", a["roll"], roll, most_roll), part("pitch", a["pitch"], pitch, most_pitch))
    return F.when(a["error"].isNotNull(), said(FAIL, a["error"])).otherwise(judged((F.abs(a["roll"]) <= most_roll) & (F.abs(a["pitch"]) <= most_pitch), good, [bad]))


def directed_said(a: Column, hand: Column, pose: Column, *, most: float = 45, least: float = 10, neutral: float = 15, off_axis: float = 20) -> Column:
    """Each pose by its own angle, and the other axis within off_axis. a: struct<roll, pitch, error>."""
    roll, pitch = number(a["roll"], 1), number(a["pitch"], 1)
    over = F.concat_ws(", ", *(F.when(F.abs(a[c]) > neutral, F.concat(F.lit(f"{c}="), x, F.lit(f" > +/-{neutral:g}"))) for c, x in (("roll", roll), ("pitch", pitch))))
    flat = (F.abs(a["roll"]) <= neutral) & (F.abs(a["pitch"]) <= neutral)
    out = F.when(pose == "N", judged(flat, [F.lit("N ok: roll="), roll, " pitch=", pitch, f" within +/-{neutral:g}"], [F.lit("N not neutral: "), over]))
    for key in G.POSE_AXIS:
        axis, low, high = G.band(key, most=most, least=least)
        other = "pitch" if axis == "roll" else "roll"
        x, text, rest = a[axis], F.concat(F.lit(f"{axis}="), roll if axis == "roll" else pitch), F.concat(F.lit(f"{other}="), pitch if axis == "roll" else roll)
        wrong, few = F.lit(f" WRONG DIRECTION (expected [{low:g},{high:g}])"), F.lit(f" not rotated enough (need |{axis}|>={least:g})")
        why = F.concat(text, F.when((x > 0) if low < 0 else (x < 0), wrong).when(F.abs(x) < least, few).otherwise(F.lit(f" out of [{low:g},{high:g}]")))
        in_band, near = (x >= low) & (x <= high), F.abs(a[other]) <= off_axis
        faults = F.concat_ws("; ", F.when(~in_band, why), F.when(~near, F.concat(rest, F.lit(f" off-axis > +/-{off_axis:g}"))))
        name = F.coalesce(hand, F.lit("None"))
        out = out.when(pose == key, judged(in_band & near, [name, f"/{key} ok: ", text, f" in [{low:g},{high:g}]; ", rest, f" within +/-{off_axis:g}"], [name, f"/{key} bad: ", faults]))
    return F.when(a["error"].isNotNull(), said(FAIL, a["error"])).otherwise(out.otherwise(said(FAIL, "unknown pose '", F.coalesce(pose, F.lit("None")), "' (expected N/RL/RR/PU/PD)")))


def spread_said(gaps: Column, pose: Column, *, thumb_tip: float = 20, inter_tip: float = 5, thumb_pip: float = 12, inter_pip: float = 3) -> Column:
    """gaps: `geometry.finger_gaps`. N only; what can't be measured is skipped."""
    tip = gaps["source"] == "tip"
    floor = lambda a: F.when(tip, thumb_tip if a == "thumb" else inter_tip).otherwise(thumb_pip if a == "thumb" else inter_pip)
    text = lambda x: F.coalesce(number(x, 1), F.lit("NA"))
    plain = lambda a: F.when(tip, f"{thumb_tip if a == 'thumb' else inter_tip:g}").otherwise(f"{thumb_pip if a == 'thumb' else inter_pip:g}")
    closed = F.array_compact(F.array(*(F.when(~F.coalesce(gaps[f"{a}_{b}"] >= floor(a), F.lit(False)), F.concat(F.lit(f"{a}-{b}("), text(gaps[f"{a}_{b}"]), F.lit("<"), plain(a), F.lit(")"))) for a, b in G.NEIGHBOURS)))
    every = F.concat_ws(" ", *(F.concat(F.lit(f"{a}-{b}="), text(gaps[f"{a}_{b}"])) for a, b in G.NEIGHBOURS))
    tail = [F.lit("source="), gaps["source"], F.lit("; "), every, F.lit(" (source="), gaps["source"], F.lit(" min thumb="), plain("thumb"), F.lit(" inter="), plain("index"), F.lit(")")]
    seen = judged(F.size(closed) == 0, ["spread ok: ", *tail], ["closed: ", F.array_join(closed, ", "), "; ", *tail])
    return F.when(pose != "N", said(SKIP, "pose=", pose, " not in eval_poses=['N'] (spread enforced on neutral only)")).when(gaps["source"].isNull(), said(SKIP, "unmeasurable: joints out of frame")).otherwise(seen)


# Shared by videos


def with_columns(df: DataFrame, **kinds: str) -> DataFrame:
    """df with these columns, null where it hasn't got them."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in df.columns})


def by_path(df: DataFrame) -> DataFrame:
    return df if "path" in df.columns else df.withColumn("path", F.col("filename"))


def files_of(media: DataFrame, rules: dict[str, Column], fail_fast: bool) -> DataFrame:
    """media with the verdicts of its metadata (``meta``: array of struct<check_name, v>), whether it could be read, the first metadata check
    that failed (``gate``: struct or null) and ``blocked``: whether its frames aren't judged. No shuffle."""
    media = with_columns(by_path(media), error="string", lacks="map<string,string>")
    meta = F.array(*(F.struct(F.lit(n).alias("check_name"), v.alias("v")) for n, v in rules.items()))
    media = media.withColumns({"meta": meta, "read": F.coalesce("readable", F.lit(False))})
    gate = F.get(F.filter("meta", lambda m: m["v"]["status"] == FAIL), F.lit(0)) if fail_fast else F.lit(None).cast("struct<check_name:string,v:struct<status:string,reason:string>>")
    media = media.withColumn("gate", F.when(F.col("read"), gate))
    return media.withColumn("blocked", ~F.col("read") | F.col("gate").isNotNull() | F.col("error").isNotNull())


#: All steps of so many frames, sorts and windows among them, fit in under 1 GB of a task's memory.
FRAMES_A_TASK = 100_000


def tasks_for(n_frames: int) -> int:
    """How many tasks to deal so many frames over."""
    return max(1, -(-n_frames // FRAMES_A_TASK))


def framed(files: DataFrame, frames: DataFrame, *columns: str, tasks: int | None = None) -> DataFrame:
    """The frames, or these of their columns, of the files that aren't blocked, with the columns that name the file. tasks: how many the
    files are dealt over at least; without it Spark decides by the bytes of a shuffle, and narrow frames, which need far more memory when
    they are sorted and judged, fill few tasks."""
    frames = with_columns(by_path(frames), error="string", lacks="map<string,string>").drop(*FILE)
    frames = frames.select("path", "frame_index", *columns) if columns else frames
    spark = frames.sparkSession
    if tasks and tasks > spark.sparkContext.defaultParallelism:
        frames = frames.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions", "200"))), "path")  # fewer than Spark's own would be dealt again
    return files.where(~F.col("blocked")).select(*KEYS).join(frames, "path")


def whole_file() -> W.WindowSpec:
    return W.Window.partitionBy("path").orderBy("frame_index")


def so_far() -> W.WindowSpec:
    return whole_file().rowsBetween(W.Window.unboundedPreceding, -1)


def together(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionAll, (p.select(*ROW) for p in parts))


def of_meta(name: str) -> Column:
    return F.get(F.filter("meta", lambda m: m["check_name"] == name), F.lit(0))["v"]


def add_file_checks(registry: Registry) -> None:
    """The metadata checks, and what stands for the rest of a file that is stopped or can't be processed."""
    for name in M.RULES:
        registry.check(name)(lambda p, name=name: F.when(F.col("error").isNull(), of_meta(name)))
    registry.check("processing_error")(lambda p: F.when(F.col("error").isNotNull(), said(FAIL, R.error_text(F.col("error")))))


def gate_said(rest: str, *, told: bool) -> Column:
    told_why = ["FAILed (", F.col("gate.v.reason"), "); "] if told else ["FAILed; "]
    return F.when(F.col("error").isNull() & F.col("gate").isNotNull(), said(SKIP, "fail-fast: ", F.col("gate.check_name"), " ", *told_why, rest))


def sampled_said() -> Column:
    """frames_sampled of a file that isn't blocked."""
    n = F.coalesce("n_frames", F.lit(0))
    seen = F.when(n == 0, said(FAIL, "video opened but yielded 0 frames (corrupt/empty stream)")).otherwise(said(PASS, "sampled ", n.cast("string"), " frames"))
    return F.when(~F.col("blocked"), seen)


# Faces


@dataclass(frozen=True)
class FacePolicy:
    limits: M.Limits = M.FACE
    turns: S.Protocol | None = field(default_factory=S.Protocol)
    least_size: int = 180
    blink: float = 0.5
    dark: float = 35
    bright: float = 220
    sharp: float = 50
    least_skin: float = 0.4
    fail_fast: bool = True


FACE_FILE, FACE_FRAME = Registry("video"), Registry("frame", framed=True)
add_file_checks(FACE_FILE)


@FACE_FILE.check("frame_checks")
def face_stopped(p: FacePolicy) -> Column:
    unread = F.when(F.col("error").isNull() & ~F.col("read"), said(SKIP, "video unreadable; frame checks skipped"))
    return F.coalesce(unread, gate_said("frame checks skipped", told=True))


@FACE_FILE.check("frames_sampled")
def face_sampled(p: FacePolicy) -> Column:
    return sampled_said()


def turns_said(p: FacePolicy) -> dict[str, Column]:
    """Turns need the whole timeline: a file in which several faces were seen has none."""
    whole = ~F.col("blocked") & (F.col("n_frames") > 0) & ~F.col("several")
    if not p.turns:
        return dict.fromkeys(TURN_CHECKS, F.lit(None).cast("struct<status:string,reason:string>"))
    return {n: F.when(whole, v) for n, v in S.turn_checks(p.turns).items()}


TURN_CHECKS = ("check_turn_front", *(f"check_turn_{d}" for d in S.TURNS), "check_turn_sequence")
FACE_FILE.together(TURN_CHECKS, turns_said, level="sequence")


@FACE_FRAME.check("check_face_detected", fail_ratio=0.0)
def face_detected(p: FacePolicy) -> Column:
    message = F.coalesce("message", F.lit(""))
    none = said(SKIP, message)
    if p.turns:  # frames without a face, by whether a turn explains the gap; not in files of several faces
        expected, unexpected = p.turns.status(p.turns.expected_gap, SKIP), p.turns.status(p.turns.unexpected_gap, FAIL)
        split = F.when(F.col("turn").isNotNull(), said(expected, message, "; expected gap (peak of ", F.col("turn"), " turn)")).otherwise(said(unexpected, message, "; unexpected gap (no adjacent turn evidence)"))
        none = F.when(F.col("several"), none).otherwise(split)
    return F.when(F.col("found"), said(PASS, "face detected")).when(message.startswith("No faces"), none).otherwise(said(FAIL, message))


@FACE_FRAME.check("check_head_fully")
def head_fully(p: FacePolicy) -> Column:
    return F.when(F.col("found"), judged(F.col("head") == "Head is fully visible", [F.col("head")], [F.coalesce("head", F.lit(""))]))


def front_only(verdict: Column) -> Column:
    aside = said(SKIP, "non-frontal (label=", F.col("label"), "); not judged")
    return F.when(F.col("found"), F.when(F.col("label") == S.FRONT, verdict).otherwise(aside))


@FACE_FRAME.check("check_face_size")
def face_size(p: FacePolicy) -> Column:
    return front_only(size_said("face", F.col("face_width"), F.col("face_height"), p.least_size, p.least_size))


@FACE_FRAME.check("check_occlusion")
def face_occlusion(p: FacePolicy) -> Column:
    return front_only(occlusion_said(F.col("skin"), least=p.least_skin))


@FACE_FRAME.check("check_eyes_open")
def eyes_open(p: FacePolicy) -> Column:
    return front_only(eyes_said(F.col("blink_left"), F.col("blink_right"), p.blink))


@FACE_FRAME.check("check_brightness", needs="face_region")
def face_brightness(p: FacePolicy) -> Column:
    return front_only(brightness_said(F.col("luma"), p.dark, p.bright))


@FACE_FRAME.check("check_face_blur")
def face_blur(p: FacePolicy) -> Column:
    return front_only(blur_said(brightness_said(F.col("luma"), p.dark, p.bright), F.col("sharpness"), p.sharp))


def face_rows(media: DataFrame, frames: DataFrame, p: FacePolicy = FacePolicy(), *, tasks: int | None = None) -> DataFrame:
    """Check rows of face videos. frames: path or filename, frame_index, timestamp_sec, face_detected, message, yaw, pitch, head (message on
    the head's visibility), face_width, face_height, blink_left, blink_right, luma (null: the second detector, which measures it, found no
    face), sharpness, skin (map<region, ratio>). tasks: see `framed`."""
    files = files_of(media, {n: rule(p.limits) for n, rule in M.RULES.items()}, p.fail_fast)
    many = F.coalesce(F.col("message").startswith("Multiple faces"), F.lit(False)) & ~F.coalesce("face_detected", F.lit(False))
    broken = F.col("error").isNotNull()

    def kept(*columns: str) -> DataFrame:
        """The frames that are judged. several: the file has a frame with more than one face, where it ends if failing is fast."""
        seen = framed(files, frames, *columns, tasks=tasks).withColumns({"many": many, "broken": broken})
        of_file = W.Window.partitionBy("path")
        seen = seen.withColumns({"several": F.max("many").over(of_file), "lost": F.max("broken").over(of_file), "passed": F.coalesce(F.max("many").over(so_far()), F.lit(False))})
        return seen.where(~F.col("passed")) if p.fail_fast else seen

    protocol = p.turns or S.Protocol()
    judged_frames = kept().where(~F.col("lost")).withColumns({"label": S.label(protocol), "found": F.coalesce("face_detected", F.lit(False))})
    judged_frames = judged_frames.withColumn("turn", S.gap_turn(key="path")) if p.turns else judged_frames
    rows = FACE_FRAME.open(judged_frames, p, KEYS, seq=F.lit(1000).cast("long") + F.col("frame_index") * 16, frame_index=F.col("frame_index"))
    timeline = kept("face_detected", "yaw", "pitch", "message", "error").withColumn("why", F.when(broken, F.struct((-F.col("frame_index")).alias("at"), F.col("error").alias("error"))))
    facts = S.turn_facts(timeline.select("path", "frame_index", "face_detected", "yaw", "pitch", "several", "why"), protocol, key="path", carry=("several", "why"))
    found = files.join(facts, "path", "left")
    found = found.withColumn("error", F.coalesce("error", "why.error")).withColumn("blocked", F.col("blocked") | F.col("error").isNotNull())
    return together(FACE_FILE.open(found, p, KEYS, seq=F.lit(0).cast("long")), rows)


# Palms


@dataclass(frozen=True)
class PalmPolicy:
    limits: M.Limits = M.Limits(extension=".jpg")
    least_size: int = 200
    #: The status of a still with several hands.
    many: str = FAIL
    dark: float = 35
    bright: float = 220
    #: Least gaps between fingers, by the joints that are measured; how near the edge a joint may be.
    thumb_tip: float = 20
    inter_tip: float = 5
    thumb_pip: float = 12
    inter_pip: float = 3
    margin: float = 0.02
    #: Of angles: the most, the least that a turned pose must reach, and what counts as neutral.
    most: float = 45
    least: float = 10
    neutral: float = 10
    #: The label's least confidence for a mismatch to fail, and whether the rig mirrors hands.
    confident: float = 0.7
    opposite: bool = False
    #: Checks that are switched off, with what their rows say.
    off: tuple[tuple[str, str], ...] = ()


PALM = Registry("image")


@PALM.check("processing_error")
def palm_error(p: PalmPolicy) -> Column:
    return F.when(F.col("error").isNotNull(), said(FAIL, R.error_text(F.col("error"))))


def unbroken(verdict: Column) -> Column:
    return F.when(F.col("error").isNull(), verdict)


def hand_check(name: str) -> callable:
    """A check on the detected hand: skipped where the hand's model is missing or failed, or where it is switched off."""
    return lambda f: PALM.check(name, needs="hand")(lambda p: unbroken(said(SKIP, dict(p.off)[name]) if name in dict(p.off) else f(p)))


PALM.check("check_container")(lambda p: unbroken(M.check_container(p.limits)))
PALM.check("check_resolution")(lambda p: unbroken(M.check_resolution(p.limits)))
NO_BOX, NO_HAND = "no single hand bbox (see check_palm_present)", "no single hand (see check_palm_present)"


@hand_check("check_palm_present")
def palm_present(p: PalmPolicy) -> Column:
    message = F.coalesce("message", F.lit("No hand detected"))
    return F.when(F.col("found"), said(PASS, message)).when(message.startswith("Multiple hands"), said(p.many, message)).otherwise(said(FAIL, message))


@hand_check("check_palm_handedness")
def palm_handedness(p: PalmPolicy) -> Column:
    return F.when(F.col("found") | (F.col("pose") != "N"), handedness_said(F.col("label"), F.col("score"), F.col("hand"), F.col("pose"), opposite=p.opposite, least=p.confident)).otherwise(said(SKIP, NO_HAND))


@hand_check("check_palm_size")
def palm_size(p: PalmPolicy) -> Column:
    return F.when(F.col("found"), size_said("palm", F.col("box_width"), F.col("box_height"), p.least_size, p.least_size)).otherwise(said(SKIP, NO_BOX))


@hand_check("check_palm_brightness")
def palm_brightness(p: PalmPolicy) -> Column:
    return F.when(F.col("found"), brightness_said(F.col("luma"), p.dark, p.bright, missing="no_hand")).otherwise(said(SKIP, NO_BOX))


@hand_check("check_palm_spread")
def palm_spread(p: PalmPolicy) -> Column:
    least = {"thumb_tip": p.thumb_tip, "inter_tip": p.inter_tip, "thumb_pip": p.thumb_pip, "inter_pip": p.inter_pip}
    return F.when(F.col("found") | (F.col("pose") != "N"), spread_said(F.col("gaps"), F.col("pose"), **least)).otherwise(said(SKIP, "no normalized landmarks (see check_palm_present)"))


@hand_check("check_palm_fully")
def palm_fully(p: PalmPolicy) -> Column:
    return F.when(F.col("found"), judged(F.col("fully") == "Palm is fully visible", [F.col("fully")], [F.col("fully")])).otherwise(said(SKIP, "no pixel landmarks / image dims (see check_palm_present)"))


@hand_check("check_palm_angle")
def palm_angle(p: PalmPolicy) -> Column:
    return F.when(F.col("hand").isNotNull() & F.col("pose").isNotNull(), pose_said(F.col("angles"), F.col("hand"), F.col("pose"), most=p.most, least=p.least, neutral=p.neutral))


def palm_rows(images: DataFrame, p: PalmPolicy = PalmPolicy()) -> DataFrame:
    """Check rows of palm stills. images: FILE, the columns of metadata, hand, pose, ok, message, points (normalised), px (in pixels),
    box_width, box_height, label, score, luma. A still is judged alone, so nothing is shuffled."""
    images = with_columns(by_path(images), error="string", lacks="map<string,string>").withColumn("found", F.coalesce("ok", F.lit(False)))
    measured = {"gaps": G.finger_gaps(F.col("points"), p.margin), "angles": F.when(F.col("found"), G.palm_angles(F.col("points"), F.col("hand"))), "fully": G.palm_fully(F.col("px"), F.col("width"), F.col("height"))}
    return PALM.open(images.withColumns(measured), p, KEYS, seq=F.lit(1).cast("long")).select(*ROW)


# Walks


@dataclass(frozen=True)
class WalkPolicy:
    limits: M.Limits = M.WALK
    least_height: float = 0.5
    sharp: float = 35
    #: Whether brightness is judged at all.
    brightness: bool = False
    dark: float = 35
    bright: float = 220
    confidence: float = 0.6
    #: Of side views: the band around the feet, in heights of the person. None: overlap, as in front views.
    foot_ratio: float | None = 0.1
    fail_fast: bool = True


WALK_FILE, WALK_FRAME = Registry("video"), Registry("frame", framed=True)


@WALK_FILE.check("processing_error")
def walk_error(p: WalkPolicy) -> Column:
    return F.when(F.col("error").isNotNull(), said(FAIL, R.error_text(F.col("error"))))


def unread() -> Column:
    return said(SKIP, "video not readable: ", F.coalesce("meta_reason", F.lit("")))


for rule in M.RULES:
    WALK_FILE.check(rule)(lambda p, rule=rule: unbroken(F.when(F.col("read"), of_meta(rule)).otherwise(unread())))


@WALK_FILE.check("frame_checks")
def walk_stopped(p: WalkPolicy) -> Column:
    return gate_said("frame checks skipped", told=True)


@WALK_FILE.check("check_body_height")
def height_not_measured(p: WalkPolicy) -> Column:
    """Of files whose first frame can't be judged; `body_height` is the check on that frame."""
    none = F.when(F.col("first_error").isNotNull(), said(SKIP, "could not read first frame: ", F.col("first_error"))).when(F.coalesce("n_frames", F.lit(0)) == 0, said(SKIP, "no frames decoded"))
    return unbroken(F.when(~F.col("read"), unread()).when(F.col("gate").isNotNull(), gate_said("height not measured", told=False)).otherwise(none))


@WALK_FILE.check("frames_sampled")
def walk_sampled(p: WalkPolicy) -> Column:
    return F.when(F.coalesce("n_frames", F.lit(0)) > 0, sampled_said())


@WALK_FILE.check("check_walk_direction", level="sequence")
def walk_direction(p: WalkPolicy) -> Column:
    return F.when(~F.col("blocked") & (F.col("n_frames") > 0) & ~(F.col("several") & F.lit(p.fail_fast)), S.direction_said())


def if_found(verdict: Column) -> Column:
    """The verdict on a frame with one person; others fail with what was seen."""
    return F.when(F.col("found"), verdict).otherwise(said(FAIL, F.coalesce("message", F.lit(""))))


@WALK_FRAME.check("check_body_height", level="video")
def body_height(p: WalkPolicy) -> Column:
    return F.when(F.col("is_first"), F.when(F.col("found"), body_height_said(F.col("height"), p.least_height)).otherwise(said(FAIL, "no pose: ", F.coalesce("message", F.lit("")))))


@WALK_FRAME.check("check_person_detected", fail_ratio=0.2)
def person_detected(p: WalkPolicy) -> Column:
    return if_found(said(PASS, "person detected"))


@WALK_FRAME.check("check_single_person", level="video", fail_ratio=0.0)
def single_person(p: WalkPolicy) -> Column:
    return F.when(F.col("many") & ~F.col("passed"), said(FAIL, "multiple persons in frame: ", F.col("message"), "; gait films one walker -> video FAIL"))


@WALK_FRAME.check("check_person_fully", fail_ratio=0.2)
def person_fully(p: WalkPolicy) -> Column:
    return if_found(person_fully_said(F.col("missing"), F.col("outside")))


@WALK_FRAME.check("check_person_blur", fail_ratio=0.2)
def person_blur(p: WalkPolicy) -> Column:
    return F.when(F.col("box").isNotNull(), if_found(region_blur_said(F.col("sharpness"), F.col("blur_luma"), F.col("contrast"), F.col("box"), p.sharp))).otherwise(if_found(said(FAIL, F.coalesce("message", F.lit("")))))


@WALK_FRAME.check("check_brightness", framed=False, fail_ratio=0.2)
def walk_brightness(p: WalkPolicy) -> Column:
    if not p.brightness:
        return F.lit(None).cast("struct<status:string,reason:string>")
    return F.when(F.col("found"), walk_brightness_said(F.col("luma"), p.dark, p.bright)).otherwise(said(FAIL, "no pose: ", F.coalesce("message", F.lit(""))))


@WALK_FRAME.check("check_occlusion", needs="objects", fail_ratio=0.2)
def walk_occlusion(p: WalkPolicy) -> Column:
    seen = F.col("objects")
    box = F.coalesce(F.when(F.col("found"), F.col("box")), D.best_person(seen))
    side = F.coalesce(F.col("view") == "S", F.lit(False)) if p.foot_ratio is not None else F.lit(False)
    return D.occlusion_said(seen, box, side, F.col("foot_y"), conf=p.confidence, foot_ratio=p.foot_ratio or 0.0)


def walk_rows(media: DataFrame, frames: DataFrame, p: WalkPolicy = WalkPolicy(), *, tasks: int | None = None) -> DataFrame:
    """Check rows of walking videos. frames: path or filename, frame_index, ok, message, box (struct<x, y, w, h> in pixels), missing, outside
    (names of key points), height (of the body over the frame's), luma, sharpness, blur_luma, contrast (of the person's region), objects
    (array of struct<cls_id, cls_name, conf, x, y, w, h>), foot_y (pixels), body_scale, centroid_x, view. tasks: see `framed`."""
    files = files_of(media, {n: rule(p.limits) for n, rule in M.RULES.items()}, p.fail_fast)
    many = F.coalesce(F.col("message").startswith("Multiple persons"), F.lit(False)) & ~F.coalesce("ok", F.lit(False))

    def kept(*columns: str) -> DataFrame:
        """The frames that are judged: up to the first with several people, if failing is fast, and before the first that broke off."""
        seen = framed(files, frames, *columns, tasks=tasks).withColumns({"many": many, "broken": F.col("error").isNotNull()})
        seen = seen.withColumns({"passed": F.coalesce(F.max("many").over(so_far()), F.lit(False)), "lost": F.max("broken").over(whole_file().rowsBetween(W.Window.unboundedPreceding, 0)), "is_first": F.row_number().over(whole_file()) == 1})
        return seen.where(~F.col("passed")) if p.fail_fast else seen

    judged_frames = kept().where(~F.col("lost")).withColumn("found", F.coalesce("ok", F.lit(False)))
    rows = WALK_FRAME.open(judged_frames, p, KEYS, seq=F.lit(1000).cast("long") + F.col("frame_index") * 16, frame_index=F.col("frame_index"))
    timeline = kept("ok", "message", "error", "view", "body_scale", "centroid_x").withColumn("value", S.walk_signal())
    timeline = timeline.withColumn("value", F.when(~F.col("lost"), F.col("value")))
    first_error = F.max(F.when(F.col("is_first") & F.col("broken"), F.col("error"))).alias("first_error")
    counted = [F.count_if(~F.col("lost")).alias("n_frames"), F.count("value").alias("n_usable"), F.max("view").alias("view"), F.coalesce(F.max("many"), F.lit(False)).alias("several"), first_error]
    facts = timeline.groupBy("path").agg(*counted).join(S.walk_phases(timeline, key="path"), "path", "left")
    return together(WALK_FILE.open(files.join(facts, "path", "left"), p, KEYS, seq=F.lit(0).cast("long")), rows)

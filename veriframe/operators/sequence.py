"""Sequences: turn protocols of faces and walking directions.

Runs of equal labels are found by gaps and islands (one window per file) and everything after works on runs, of which a
file has few. Only the bridging of short flickers, where each change can enable the next, is a fold; runs longer than a flicker never
change, so it is folded between two such runs at a time.

``key`` names the column that tells files apart. Data that is partitioned by it already stays where it is.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from veriframe.functions.status import FAIL, PASS, REVIEW, SKIP, said

FRONT, LEFT, RIGHT, DOWN, UP, GAP, MID = "front", "left", "right", "down", "up", "gap", "mid"
TURNS = (LEFT, RIGHT, DOWN, UP)


@dataclass(frozen=True)
class Protocol:
    yaw_floor: float = 30
    pitch_floor: float = 20
    front_yaw: float = 15
    front_pitch: float = 15
    orders: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"spec": (FRONT, LEFT, FRONT, RIGHT, FRONT, DOWN, FRONT, UP, FRONT), "audio_prompt": (FRONT, LEFT, FRONT, RIGHT, FRONT, UP, FRONT, DOWN, FRONT)})
    exact: bool = True
    order_policy: str = FAIL
    short_policy: str = FAIL
    gap_policy: str = FAIL
    front_initial: float = 5
    hold: float = 2
    jitter: float = 0.15
    fps: float = 1.0
    expected_gap: str = SKIP
    unexpected_gap: str = FAIL

    def frames(self, seconds: float) -> int:
        return max(1, math.floor(seconds * self.fps))

    @property
    def flicker(self) -> int:
        return max(1, math.ceil(self.jitter * self.fps))

    def status(self, value: str, default: str) -> str:
        return value.upper() if value.upper() in (PASS, FAIL, REVIEW, SKIP) else default


def label(p: Protocol) -> Column:
    """front, a turn (the angle that exceeds its floor more; ties are side turns), gap, or mid (also for NaN angles)."""
    yaw, pitch = F.col("yaw"), F.col("pitch")
    over_yaw, over_pitch = F.abs(yaw) - p.yaw_floor, F.abs(pitch) - p.pitch_floor
    gap = ~F.coalesce("face_detected", F.lit(False)) | yaw.isNull() | pitch.isNull()
    side = (over_yaw >= 0) & ~F.isnan(yaw) & ((over_pitch < 0) | F.isnan(pitch) | (over_yaw >= over_pitch))
    return (
        F.when(gap, GAP)
        .when((F.abs(yaw) < p.front_yaw) & (F.abs(pitch) < p.front_pitch), FRONT)
        .when(side, F.when(yaw < 0, LEFT).otherwise(RIGHT))
        .when((over_pitch >= 0) & ~F.isnan(pitch), F.when(pitch < 0, DOWN).otherwise(UP))
        .otherwise(MID)
    )


def labelled(timeline: DataFrame, p: Protocol = Protocol()) -> DataFrame:
    return timeline.withColumn("label", label(p))


def runs_of(frames: DataFrame, order: str = "frame_index", *, sizes: Column | None = None, key: str = "filename", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, first, last, n, label): maximal runs of equal labels in order. carry: columns of which a run keeps the greatest value."""
    by = W.Window.partitionBy(key).orderBy(order)
    fresh = F.coalesce((F.col("label") != F.lag("label").over(by)).cast("int"), F.lit(1))
    marked = frames.withColumn("__new", fresh).withColumn("__run", F.sum("__new").over(by))
    end = F.col("last") if "last" in frames.columns else F.col(order)
    found = [F.min(order).alias("first"), F.max(end).alias("last"), F.sum(F.lit(1) if sizes is None else sizes).alias("n"), F.first("label").alias("label")]
    return marked.groupBy(key, "__run").agg(*found, *(F.max(c).alias(c) for c in carry)).drop("__run")


def sole_turn(before: Column, after: Column) -> Column:
    """The turn that labels before and after a gap tell of: there must be exactly one, else null."""
    turn = lambda x: F.when(x.isin(*TURNS), x)
    a, b = turn(before), turn(after)
    return F.when(a.isNull(), b).when(b.isNull() | (a == b), a)


def absorbed(runs: DataFrame, *, key: str = "filename") -> DataFrame:
    """Runs with ``own``, their label, and ``label``: a gap takes the turn label if its neighbours have exactly one."""
    by = W.Window.partitionBy(key).orderBy("first")
    near = sole_turn(F.lag("label").over(by), F.lead("label").over(by))
    return runs.withColumn("own", F.col("label")).withColumn("near", near).withColumn("label", F.when((F.col("own") == GAP) & F.col("near").isNotNull(), F.col("near")).otherwise(F.col("own"))).drop("near")


def gap_turn(order: str = "frame_index", *, key: str = "filename") -> Column:
    """Of labelled frames: the turn that explains a frame without a face, or null; as `gap_frames`, in place."""
    seen = F.when(F.col("label") != GAP, F.col("label"))
    last = lambda *o: F.last(seen, ignorenulls=True).over(W.Window.partitionBy(key).orderBy(*o).rowsBetween(W.Window.unboundedPreceding, -1))
    return F.when(F.col("label") == GAP, sole_turn(last(order), last(F.desc(order))))


def bridge(labels: list[str], sizes: list[int], most: int) -> list[str]:
    """Labels of runs after short runs between equal stable labels are taken over, from left to right, until nothing changes."""
    stable = {FRONT, *TURNS}
    labels, sizes = list(labels), list(sizes)
    owner = list(range(len(labels)))  # which merged run each of the given runs is in
    changed = True
    while changed:
        changed = False
        for k in range(1, len(labels) - 1):
            if sizes[k] <= most and labels[k - 1] == labels[k + 1] != labels[k] and labels[k - 1] in stable:
                labels[k], changed = labels[k - 1], True
        merged: list[int] = []
        new_labels: list[str] = []
        new_sizes: list[int] = []
        for x, n in zip(labels, sizes, strict=True):
            if new_labels and new_labels[-1] == x:
                new_sizes[-1] += n
            else:
                new_labels.append(x)
                new_sizes.append(n)
            merged.append(len(new_labels) - 1)
        owner = [merged[o] for o in owner]
        labels, sizes = new_labels, new_sizes
    return [labels[o] for o in owner]


def bridged(runs: DataFrame, most: int, *, key: str = "filename") -> DataFrame:
    """runs with bridged labels. A run of more than ``most`` frames keeps its label and shields what is on either side of it, so a file is
    cut into sections, each from one such run to the next, and each section is a row and is folded for itself."""
    by = W.Window.partitionBy(key).orderBy("first")
    long = F.col("n") > most
    sections = runs.withColumn("section", F.sum(long.cast("int")).over(by)).groupBy(key, "section").agg(F.array_sort(F.collect_list(F.struct(*(c for c in runs.columns if c != key)))).alias("rows"))
    ahead = F.lead(F.col("rows")[0]).over(W.Window.partitionBy(key).orderBy("section"))
    sections = sections.withColumn("all", F.when(ahead.isNull(), F.col("rows")).otherwise(F.concat("rows", F.array(ahead))))

    @F.pandas_udf("array<string>")
    def fold(labels: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([fold_equal(list(a), list(b), most) for a, b in zip(labels, sizes, strict=True)])

    single = F.size("rows") == 1  # nothing to fold
    folded = F.when(single, F.transform("rows", lambda r: r["label"])).otherwise(fold(F.transform("all", lambda r: r["label"]), F.transform("all", lambda r: r["n"])))
    out = sections.select(key, F.explode(F.arrays_zip("rows", F.slice(folded, 1, F.size("rows")).alias("to"))).alias("x"))
    return out.select(*(F.col("x.to").alias(c) if c == "label" else F.col(c) if c == key else F.col(f"x.rows.{c}") for c in runs.columns))


def fold_equal(labels: list[str], sizes: list[int], most: int) -> list[str]:
    """`bridge`, of runs whose neighbours may have equal labels."""
    joined: list[list] = []
    place = []
    for label, n in zip(labels, sizes, strict=True):
        if joined and joined[-1][0] == label:
            joined[-1][1] += n
        else:
            joined.append([label, n])
        place.append(len(joined) - 1)
    out = bridge([x for x, _ in joined], [n for _, n in joined], most)
    return [out[k] for k in place]


def segments(timeline: DataFrame, p: Protocol = Protocol(), *, bridging: bool = True, key: str = "filename", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, first, last, n, label) after gaps are absorbed and flickers bridged."""
    columns = [key, "first", "last", "n", "label", *carry]
    runs = absorbed(runs_of(labelled(timeline, p), key=key, carry=carry), key=key).select(*columns)
    if bridging:
        runs = bridged(runs_of(runs, "first", sizes=F.col("n"), key=key, carry=carry).select(*columns), p.flicker, key=key)
    return runs_of(runs, "first", sizes=F.col("n"), key=key, carry=carry)


def spine(segs: DataFrame) -> DataFrame:
    """The segments without gaps and mids, with equal neighbours joined."""
    return runs_of(segs.where(F.col("label").isin(FRONT, *TURNS)), "first", sizes=F.col("n"))


def gap_frames(timeline: DataFrame, p: Protocol = Protocol()) -> DataFrame:
    """(filename, frame_index, direction): each gap frame, with the turn that explains it or null."""
    frames = labelled(timeline, p)
    explained = absorbed(runs_of(frames)).where(F.col("own") == GAP).select("filename", "first", "last", F.when(F.col("label") != GAP, F.col("label")).alias("direction"))
    grid = explained.select("filename", F.explode(F.sequence("first", "last")).alias("frame_index"), "direction")
    return grid.join(frames.select("filename", "frame_index"), ["filename", "frame_index"])


def restatus_detections(rows: DataFrame, gaps: DataFrame, p: Protocol = Protocol()) -> DataFrame:
    """Detection rows of frames without a face, judged by whether a turn explains the gap; other rows are kept."""
    hit = rows.join(gaps.select("filename", "frame_index", F.lit(True).alias("gap"), "direction"), ["filename", "frame_index"], "left")
    expected, unexpected = p.status(p.expected_gap, SKIP), p.status(p.unexpected_gap, FAIL)
    status = F.when(F.col("gap").isNull(), F.col("status")).when(F.col("direction").isNotNull(), expected).otherwise(unexpected)
    reason = F.when(F.col("gap").isNull(), F.col("reason")).when(F.col("direction").isNotNull(), F.concat("reason", F.lit("; expected gap (peak of "), "direction", F.lit(" turn)"))).otherwise(F.concat("reason", F.lit("; unexpected gap (no adjacent turn evidence)")))
    return hit.withColumns({"status": status, "reason": reason}).drop("gap", "direction")


def collapsed(order: tuple[str, ...]) -> list[str]:
    return [x for k, x in enumerate(order) if k == 0 or order[k - 1] != x]


def fitted(files: DataFrame, p: Protocol) -> DataFrame:
    """files, which have ``labels``, with the first accepted order that fits, the place where it begins and its size."""
    name, at, size = F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit(None).cast("int")
    for key, order in reversed(p.orders.items()):
        want = collapsed(order)
        wanted, n = F.array(*map(F.lit, want)), len(want)
        if p.exact:
            place = F.when(F.col("labels") == wanted, F.lit(0))
        else:
            starts = F.when(F.size("labels") >= n, F.sequence(F.lit(0), F.size("labels") - n))
            place = F.get(F.filter(starts, lambda i: F.slice("labels", i + 1, n) == wanted), F.lit(0))  # noqa: B023
        name, at, size = F.when(place.isNotNull(), key).otherwise(name), F.when(place.isNotNull(), place).otherwise(at), F.when(place.isNotNull(), n).otherwise(size)
    return files.withColumns({"order": name, "start": at, "size": size})


def order_match(spines: DataFrame, p: Protocol = Protocol()) -> DataFrame:
    """Per file: the spine's items and labels, and the first accepted order that fits, with the place where it begins."""
    files = spines.groupBy("filename").agg(F.sort_array(F.collect_list(F.struct("first", "last", "n", "label"))).alias("items"))
    return fitted(files.withColumn("labels", F.transform("items", lambda x: x["label"])), p)


def spined(segs: DataFrame, *, key: str = "filename", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, n_frames, segs, items, labels): a row per file with its segments and its spine (as `spine`) as arrays, from one aggregation."""
    files = segs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("first", "last", "n", "label"))).alias("segs"), F.sum("n").alias("n_frames"), *(F.max(c).alias(c) for c in carry))
    files = files.withColumn("held", F.filter("segs", lambda x: x["label"].isin(FRONT, *TURNS)))
    at = lambda i: F.get("held", i)
    fresh = F.filter(F.sequence(F.lit(0), F.size("held") - 1), lambda i: (i == 0) | (at(i)["label"] != at(i - 1)["label"]))
    files = files.withColumn("starts", F.when(F.size("held") > 0, fresh).otherwise(F.array().cast("array<int>")))

    def joined(i: Column, k: Column) -> Column:
        end = F.coalesce(F.get("starts", k + 1), F.size("held"))
        total = F.aggregate(F.slice("held", i + 1, end - i), F.lit(0).cast("long"), lambda a, x: a + x["n"])
        return F.struct(at(i)["first"].alias("first"), at(end - 1)["last"].alias("last"), total.alias("n"), at(i)["label"].alias("label"))

    files = files.withColumn("items", F.transform("starts", joined))
    return files.select(key, "n_frames", "segs", "items", F.transform("items", lambda x: x["label"]).alias("labels"), *carry)


def turn_facts(timeline: DataFrame, p: Protocol = Protocol(), *, bridging: bool = True, key: str = "filename", carry: tuple[str, ...] = ()) -> DataFrame:
    """A row per file with what `turn_checks` reads. Places count sampled frames from 0."""
    by = W.Window.partitionBy(key).orderBy("frame_index")
    placed = timeline.withColumns({"frame_index": F.row_number().over(by) - 1, "any_front": F.coalesce(label(p) == FRONT, F.lit(False))})
    carry = ("any_front", *carry)
    return fitted(spined(segments(placed, p, bridging=bridging, key=key, carry=carry), key=key, carry=carry), p)


def turn_checks(p: Protocol = Protocol(), *, confirm: Callable[[Column], Column] = lambda gap: F.lit(False)) -> dict[str, Column]:
    """The verdicts (struct<status, reason>) of a row of `turn_facts`: the front, four directions and the sequence.

    confirm: whether a gap (struct<first, last, n, label>) is known to be a turn; the sequence of a file with other gaps in its scope
    isn't confirmed.
    """
    fits, text = F.col("order").isNotNull(), lambda x: x.cast("string")
    fronts = F.filter(F.when(fits, F.slice("items", F.col("start") + 1, F.col("size"))).otherwise(F.col("items")), lambda x: x["label"] == FRONT)
    held = lambda n: F.format_string("%.1fs", F.bround(n / p.fps, 1))
    first_or = lambda i, a, b: F.when(i == 0, a).otherwise(b)
    role = lambda i: F.when(i == 0, "initial").otherwise(F.concat(F.lit("return#"), text(i)))
    least = lambda i: first_or(i, f"{p.front_initial:.1f}s", f"{p.hold:.1f}s")

    counts = {k: collapsed(o).count(FRONT) for k, o in p.orders.items()}
    expected = F.coalesce(*(F.when(F.col("order") == k, n) for k, n in counts.items()), F.lit(max(counts.values(), default=0)))
    few = F.when(F.size(fronts) < expected, F.concat(F.lit("expected "), text(expected), F.lit(" front holds, found "), text(F.size(fronts))))
    too_short = lambda x, i: F.when(
        x["n"] < first_or(i, p.frames(p.front_initial), p.frames(p.hold)),
        F.concat(role(i), F.lit(" front too short at segment "), text(x["first"]), F.lit(":"), text(x["last"]), F.lit(": "), held(x["n"]), F.lit(" < "), least(i)),
    )
    faults = F.concat_ws("; ", few, F.array_compact(F.transform(fronts, too_short)))
    holds = F.array_join(F.transform(fronts, lambda x, i: F.concat(role(i), F.lit("="), held(x["n"]), F.lit(" >= "), least(i))), "; ")
    scope = F.when(fits, F.concat(F.lit("matched '"), "order", F.lit("' window"))).otherwise("observed sequence")
    front = (
        F.when(F.size(fronts) == 0, said(FAIL, "front turn-hold check failed; no front hold segment found"))
        .when(faults != "", said(p.short_policy, "front hold check failed in ", scope, ": ", faults)).otherwise(said(PASS, "front holds ok in ", scope, ": ", holds))
    )

    def direction(d: str) -> Column:
        most = F.array_max(F.transform(F.filter("segs", lambda x: x["label"] == d), lambda x: x["n"]))
        return (
            F.when(most.isNull(), said(FAIL, f"{d} turn not detected")).when(most >= p.frames(p.hold), said(PASS, f"{d} detected; hold=", held(most), f" >= {p.hold:.1f}s"))
            .otherwise(said(p.short_policy, f"{d} detected but hold too short: ", held(most), f" < {p.hold:.1f}s"))
        )

    mode = "exact" if p.exact else "contiguous_subsequence"
    observed = F.when(F.size("labels") == 0, "none").otherwise(F.array_join("labels", " -> "))
    accepted = "; ".join(f"{k}: {' -> '.join(collapsed(o))}" for k, o in p.orders.items())
    why = "no extra prefix/suffix labels allowed" if p.exact else "accepted sequence not found as one contiguous window"
    window = F.concat(text(F.col("start")), F.lit(":"), text(F.col("start") + F.col("size")))
    matched = F.coalesce(*(F.when(F.col("order") == k, " -> ".join(collapsed(o))) for k, o in p.orders.items()), F.lit(""))
    found = F.concat(F.lit("accepted sequence found: '"), "order", F.lit(f"' using {mode} at observed window "), window, F.lit("; matched: "), matched)
    a, b = F.get("items", F.col("start"))["first"], F.get("items", F.col("start") + F.col("size") - 1)["last"]
    in_scope = (lambda g: F.lit(True)) if p.exact else (lambda g: (g["last"] >= a) & (g["first"] <= b))
    open_gap = F.exists("segs", lambda g: (g["label"] == GAP) & in_scope(g) & ~confirm(g))
    where = F.lit("whole observed sequence") if p.exact else F.concat(F.lit("matched window "), window)
    sequence = (
        F.when(F.col("order").isNull(), said(p.order_policy, f"sequence order mismatch in {mode} mode; observed: ", observed, f"; accepted: {accepted}; {why}"))
        .when(open_gap, said(p.gap_policy, found, "; but ", where, " contains an unconfirmed gap")).otherwise(said(PASS, found, "; observed: ", observed))
    ) if p.orders else said(FAIL, "no accepted_orders configured; cannot validate turn sequence")

    unseen = {"check_turn_front": "front hold cannot be validated; no front-facing frame found", **{f"check_turn_{d}": f"{d} turn cannot be validated; no front-facing frame found" for d in TURNS}, "check_turn_sequence": "no front-facing frame anywhere; cannot validate turn sequence"}
    whole = {"check_turn_front": front, **{f"check_turn_{d}": direction(d) for d in TURNS}, "check_turn_sequence": sequence}
    return {k: F.when(F.col("any_front"), v).otherwise(said(FAIL, unseen[k])) for k, v in whole.items()}


def turn_verdicts(timeline: DataFrame, p: Protocol = Protocol(), *, bridging: bool = True, **options) -> DataFrame:
    """(filename, check_name, status, reason): the front, four direction and sequence verdicts of each file."""
    rows = F.array(*(F.struct(F.lit(k).alias("check_name"), v.alias("v")) for k, v in turn_checks(p, **options).items()))
    return turn_facts(timeline, p, bridging=bridging).select("filename", F.explode(rows).alias("x")).select("filename", "x.check_name", "x.v.status", "x.v.reason")


def presence_verdicts(timeline: DataFrame, p: Protocol = Protocol()) -> DataFrame:
    """The presence-first alternative: (filename, check_name, status, reason).

    A direction passes with enough frames and is for review with too few, or with none if a gap between front frames could
    hide it. Passing directions, by their first sighting, must be a subsequence of an accepted order.
    """
    by = W.Window.partitionBy("filename").orderBy("frame_index")
    seen = labelled(timeline, p).withColumn("place", F.row_number().over(by))
    front = F.col("label") == FRONT
    is_front = F.when(front, 1)
    framed = seen.withColumns({"before": F.max(is_front).over(by.rowsBetween(W.Window.unboundedPreceding, -1)), "after": F.max(is_front).over(by.rowsBetween(1, W.Window.unboundedFollowing))})
    hidden = (F.col("label") == GAP) & F.col("before").isNotNull() & F.col("after").isNotNull()
    files = framed.groupBy("filename").agg(
        F.max(front).alias("any_front"), F.max(front & (F.col("place") <= p.frames(p.front_initial))).alias("opening"), F.max(hidden).alias("hidden"),
        *(F.count_if(F.col("label") == d).alias(d) for d in TURNS), *(F.min(F.when(F.col("label") == d, F.col("timestamp_sec"))).alias(f"{d}_at") for d in TURNS),
    )
    status = {d: F.when(F.col(d) >= p.frames(p.hold), PASS).when((F.col(d) > 0) | F.col("hidden"), REVIEW).otherwise(FAIL) for d in TURNS}
    files = files.withColumns({f"{d}_status": s for d, s in status.items()})
    passed = F.array_compact(F.array(*(F.when(F.col(f"{d}_status") == PASS, F.struct(F.col(f"{d}_at").alias("at"), F.lit(k).alias("k"), F.lit(d).alias("d"))) for k, d in enumerate(TURNS))))
    files = files.withColumn("seen", F.transform(F.array_sort(passed), lambda x: x["d"]))
    # each direction is in an order once, so a subsequence has growing places
    fits = F.lit(False)
    for order in p.orders.values():
        turns = F.array(*(F.lit(x) for x in order if x in TURNS))
        place = F.transform("seen", lambda d: F.array_position(turns, d))  # noqa: B023
        fits = fits | ((place == F.array_sort(place)) & ~F.array_contains(place, F.lit(0).cast("long")))
    none, need = F.size("seen") == 0, p.frames(p.hold)
    order = F.when(none, FAIL).when(fits, PASS).otherwise(p.order_policy)
    all_ = F.array(*(F.col(f"{d}_status") for d in TURNS), F.when(fits, PASS).when(none, FAIL).otherwise(p.order_policy))
    overall = F.when(F.array_contains(all_, FAIL), FAIL).when(F.array_contains(all_, REVIEW), REVIEW).otherwise(PASS)
    path = F.array_join("seen", " -> ")

    def found(d: str) -> Column:
        n = F.concat(F.lit(f"{d}: "), F.col(d).cast("string"), F.lit(" detected frames "))
        return (
            F.when(F.col(d) >= need, F.concat(n, F.lit(f">= {need}"))).when((F.col(d) == 0) & F.col("hidden"), f"{d}: only a bracketed gap present; cannot confirm without head-pose model (Phase 2)")
            .when(F.col(d) > 0, F.concat(n, F.lit(f"< {need} (hold too short?)"))).otherwise(f"{d}: not detected (no frames, no bracketed gap)")
        )

    listed = F.array_compact(F.array(*(F.when(F.col(f"{d}_status") == PASS, f"'{d}'") for d in TURNS)))
    present = F.when(F.size(listed) == 0, "none").otherwise(F.concat(F.lit("["), F.array_join(listed, ", "), F.lit("]")))
    ordered = F.when(none, "no turns to order").when(fits, F.concat(F.lit("turn order ok: "), path)).otherwise(F.concat(F.lit("turn order "), path, F.lit(" matches no accepted order")))
    row = lambda name, s, why: F.struct(F.lit(name).alias("check_name"), s.alias("status"), why.alias("reason"))
    rows = F.array(
        row("check_turn_sequence_front_hold", F.when(~F.col("opening"), REVIEW), F.lit("no clear front hold at the start of the video")),
        *(row(f"check_turn_sequence_{d}", F.col(f"{d}_status"), found(d)) for d in TURNS), row("check_turn_sequence_order", order, ordered),
        row("check_turn_sequence", overall, F.concat(F.lit("turns present: "), present, F.lit("; order="), F.when(fits, "ok").otherwise("mismatch"))),
    )
    only = F.array(row("check_turn_sequence", F.lit(FAIL), F.lit("no front-facing frame anywhere; cannot validate turns")))
    return files.select("filename", F.inline(F.when(F.col("any_front"), rows).otherwise(only))).where("status is not null")


# Walking: phases of a signal that rises and falls


def smoothed(signal: DataFrame, window: int = 5, *, key: str = "filename") -> DataFrame:
    """(key, frame_index, value, smooth): the mean over window // 2 rows on each side, cut at the ends."""
    by = W.Window.partitionBy(key).orderBy("frame_index")
    half = window // 2
    count = F.count("*").over(W.Window.partitionBy(key))
    mean = F.avg("value").over(by.rowsBetween(-half, half))
    return signal.withColumn("smooth", F.when((F.lit(window) <= 1) | (count < window), F.col("value")).otherwise(mean))


def polarity(smooth: DataFrame, eps: float = 0.002, *, key: str = "filename") -> DataFrame:
    """(key, frame_index, sign) of each step to the next row: 1 above eps, -1 below -eps, else 0."""
    step = F.lead("smooth").over(W.Window.partitionBy(key).orderBy("frame_index")) - F.col("smooth")
    return smooth.withColumn("step", step).where("step is not null").select(key, "frame_index", F.when(F.col("step") > eps, 1).when(F.col("step") < -eps, -1).otherwise(0).alias("sign"))


def phases(signs: DataFrame, min_run: int = 3, *, key: str = "filename") -> DataFrame:
    """(key, first, last, n, label): sustained rises and falls ("1", "-1"), equal neighbours joined."""
    runs = runs_of(signs.withColumn("label", F.col("sign").cast("string")), key=key)
    return runs_of(runs.where((F.col("label") != "0") & (F.col("n") >= min_run)), "first", sizes=F.col("n"), key=key)


def has_sustained_run(signs: DataFrame, target: int, min_run: int = 3) -> DataFrame:
    runs = runs_of(signs.withColumn("label", F.col("sign").cast("string")))
    return runs.groupBy("filename").agg(F.max(F.coalesce((F.col("label") == str(target)) & (F.col("n") >= min_run), F.lit(False))).alias("sustained"))


def accepts(first: Column, n: Column, required_first: Column) -> Column:
    """Whether alternating phases contain the required two in order: at once, or after one wrong leading phase."""
    return ((n >= 2) & (first == required_first)) | (n >= 3)


def walk_phases(timeline: DataFrame, *, window: int = 5, min_run: int = 3, eps: float = 0.002, key: str = "filename") -> DataFrame:
    """(key, phases: array of struct<first, label>) of the files that have any. timeline: key, frame_index, value (of which some may be null)."""
    signal = timeline.select(key, "frame_index", "value").where("value is not null")
    return phases(polarity(smoothed(signal, window, key=key), eps, key=key), min_run, key=key).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("first", "label"))).alias("phases"))


def walk_signal() -> Column:
    return F.when(F.col("view") == "F", F.col("body_scale")).when(F.col("view") == "S", F.col("centroid_x"))


def n_phases() -> Column:
    return F.when(F.col("phases").isNull(), 0).otherwise(F.size("phases")).cast("long")


def direction_said(min_frames: int = 8) -> Column:
    """The verdict of a row with view, n_usable and phases. Front views must grow, then shrink; side views go left to right, then back."""
    n, front = n_phases(), F.col("view") == "F"
    lead = F.get("phases", F.lit(0))["label"]
    name = lambda x: F.when(front, F.when(x == "1", "approach (growing)").otherwise("recede (shrinking)")).otherwise(F.when(x == "1", "move right (=>)").otherwise("move left (<=)"))
    seen = F.array_join(F.transform("phases", lambda x: name(x["label"])), " then ")
    want = F.when(front, "approach (growing) then recede (shrinking)").otherwise("move left (<=) then move right (=>)")
    course = F.when(front, "toward-then-away").otherwise("left-then-right")
    failed = lambda *why: said(FAIL, F.col("view"), ": ", course, " FAIL; ", *why)
    return (
        F.when(~F.coalesce(F.col("view").isin("F", "S"), F.lit(False)), said(FAIL, "unknown view '", F.coalesce("view", F.lit("None")), "'; cannot judge walk direction"))
        .when(F.col("n_usable") < min_frames, said(FAIL, F.col("view"), ": only ", F.col("n_usable").cast("string"), f" usable frame(s) < {min_frames}; too short to verify ", course))
        .when(n == 0, failed("no sustained direction detected"))
        .when(accepts(lead, n, F.when(front, "1").otherwise("-1")), said(PASS, F.col("view"), ": ", course, " OK (detected: ", seen, ")"))
        .when(n == 1, failed("only one phase (", name(lead), "); a there-and-back (", want, ") was not completed"))
        .otherwise(failed("reversed order (got ", seen, "); spec requires ", want))  # phases alternate, so two that don't fit are reversed
    )


def walk_direction(timeline: DataFrame, *, min_frames: int = 8, **options) -> DataFrame:
    """(filename, n_usable, n_phases, status, reason)."""
    timeline = timeline.withColumn("value", walk_signal())
    files = timeline.groupBy("filename").agg(F.max("view").alias("view"), F.count("value").alias("n_usable")).join(walk_phases(timeline, **options), "filename", "left")
    return files.select("filename", "n_usable", n_phases().alias("n_phases"), direction_said(min_frames).alias("v")).select("filename", "n_usable", "n_phases", "v.status", "v.reason")


def isolated_points(timeline: DataFrame, column: str) -> DataFrame:
    """Rows with a value whose neighbours in order have none (or don't exist)."""
    by = W.Window.partitionBy("filename").orderBy("frame_index")
    x = F.col(column)
    return timeline.withColumns({"__a": F.lag(column).over(by), "__b": F.lead(column).over(by)}).where(x.isNotNull() & F.col("__a").isNull() & F.col("__b").isNull()).drop("__a", "__b")

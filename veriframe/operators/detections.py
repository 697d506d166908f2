"""Detected objects against the person's box: an equi-join on the frame with the overlap as a residual predicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from veriframe.functions.status import FAIL, PASS, said

FRAME = ["filename", "frame_index"]
PERSON = 0


def boxes_overlap(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Whether two boxes (x, y, w, h) share an area; touching edges don't."""
    (ax, ay, aw, ah), (bx, by, bw, bh) = a, b
    return (F.least(ax + aw, bx + bw) > F.greatest(ax, bx)) & (F.least(ay + ah, by + bh) > F.greatest(ay, by))


def in_foot_band(bottom: Column, line: Column, person_height: Column, ratio: float) -> Column:
    return bottom.between(line - person_height * ratio, line + person_height * ratio)


def person_boxes(det: DataFrame) -> DataFrame:
    """The most confident person of each frame, the first on ties."""
    best = F.max_by(F.struct("x", "y", "w", "h"), F.struct("conf", -F.col("det_seq")))
    return det.where(F.col("cls_id") == PERSON).groupBy(*FRAME).agg(best.alias("person"))


def ranked_classes(det: DataFrame, most: int = 5) -> DataFrame:
    """Per frame: the classes by best confidence (first seen on ties), the most confident few and how many more."""
    by_class = det.groupBy(*FRAME, "cls_name").agg(F.max("conf").alias("conf"), F.min("det_seq").alias("seen"))
    place = F.row_number().over(W.Window.partitionBy(*FRAME).orderBy(F.desc("conf"), "seen"))
    shown = by_class.withColumn("place", place).groupBy(*FRAME).agg(F.sort_array(F.collect_list(F.when(F.col("place") <= most, F.struct("place", "cls_name")))).alias("top"), F.greatest(F.count("*") - most, F.lit(0)).alias("more"))
    return shown.select(*FRAME, F.transform("top", lambda x: x["cls_name"]).alias("top"), "more")


def foreign_objects(det: DataFrame, *, conf: float = 0.6, allowed: tuple[int, ...] = (PERSON,), foot_ratio: float | None = None) -> DataFrame:
    """Foreign objects with ``hits``: whether each is in the person's way (null without a person's box)."""
    joined = det.where((F.col("conf") >= conf) & ~F.col("cls_id").isin(*allowed)).join(person_boxes(det), FRAME, "left")
    p = F.col("person")
    if foot_ratio is None:
        hits = boxes_overlap(tuple(F.col(c) for c in "xywh"), tuple(p[c] for c in "xywh"))
    else:
        hits = in_foot_band(F.col("y") + F.col("h"), p["y"] + p["h"], p["h"], foot_ratio)
    return joined.withColumn("hits", F.when(p.isNotNull(), hits)).drop("person")


def occlusion(det: DataFrame, **options) -> DataFrame:
    """(frame, n_foreign, n_hits, status): fails if a foreign object is in the way, or can't be cleared."""
    found = foreign_objects(det, **options).groupBy(*FRAME).agg(F.count("*").alias("n_foreign"), F.count_if("hits").alias("n_hits"), F.max(F.col("hits").isNull()).alias("unclear"))
    frames = det.select(*FRAME).distinct().join(found, FRAME, "left")
    bad = F.coalesce(F.col("unclear") | (F.col("n_hits") > 0), F.lit(False))
    return frames.select(*FRAME, F.coalesce("n_foreign", F.lit(0)).alias("n_foreign"), F.coalesce("n_hits", F.lit(0)).alias("n_hits"), F.when(bad, FAIL).otherwise(PASS).alias("status"))


# The same on one frame's objects as an array, of which a frame has few: no join


def best_person(objects: Column) -> Column:
    """The box (struct<x, y, w, h>) of the most confident person, the first on ties; null without one."""
    people = F.filter(F.transform(objects, lambda o, i: F.struct((-o["conf"]).alias("order"), i.alias("i"), o["cls_id"].alias("cls_id"), F.struct(*(o[c].alias(c) for c in "xywh")).alias("box"))), lambda o: o["cls_id"] == PERSON)
    return F.array_min(people)["box"]


def ranked_said(objects: Column, most: int = 5) -> Column:
    """"name (confidence), ..." of the classes by their best confidence, first seen first on ties, and how many more there are."""
    names = F.array_distinct(F.transform(objects, lambda o: o["cls_name"]))
    best = lambda n: F.array_max(F.transform(F.filter(objects, lambda o: o["cls_name"] == n), lambda o: o["conf"]))
    ranked = F.array_sort(F.transform(names, lambda n, i: F.struct((-best(n)).alias("order"), i.alias("i"), n.alias("name"))))
    shown = F.transform(F.slice(ranked, 1, most), lambda r: F.concat(r["name"], F.lit(" ("), F.format_string("%.2f", -r["order"]), F.lit(")")))
    more = F.when(F.size(names) > most, F.array(F.concat(F.lit("+"), (F.size(names) - most).cast("string"), F.lit(" more")))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(shown, more), ", ")


def occlusion_said(objects: Column, person: Column, side: Column, foot_line: Column, *, conf: float = 0.6, allowed: tuple[int, ...] = (PERSON,), foot_ratio: float = 0.1) -> Column:
    """The verdict on a frame's objects: fails if one is in the person's way (side views: its lower edge near the feet; else: it overlaps the
    person), or if there is no person to clear it of."""
    foreign = F.filter(objects, lambda o: (o["conf"] >= conf) & ~o["cls_id"].isin(*allowed))
    line = F.coalesce(foot_line, person["y"] + person["h"])
    low = F.filter(foreign, lambda o: in_foot_band(o["y"] + o["h"], line, person["h"], foot_ratio))
    over = F.filter(foreign, lambda o: boxes_overlap(tuple(o[c] for c in "xywh"), tuple(person[c] for c in "xywh")))
    n = F.concat(F.size(foreign).cast("string"), F.lit(" object(s) present but none "))
    return (
        F.when(F.coalesce(F.size(objects), F.lit(0)) <= 0, said(PASS, "no objects detected")).when(F.size(foreign) == 0, said(PASS, "only person present"))
        .when(person.isNull(), said(FAIL, "foreign objects (no person box to clear): ", ranked_said(foreign)))
        .when(side, F.when(F.size(low) == 0, said(PASS, n, "at foot level")).otherwise(said(FAIL, "foot-level objects: ", ranked_said(low))))
        .when(F.size(over) == 0, said(PASS, n, "overlaps person")).otherwise(said(FAIL, "obstructing objects: ", ranked_said(over)))
    )

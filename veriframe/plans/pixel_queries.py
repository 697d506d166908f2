"""Registered queries of pixel statistics over small luma tiles, detail tables and overlays."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from veriframe.functions import pixels
from veriframe.operators import detections as D
from veriframe.operators import geometry as G
from veriframe.operators import service as S
from veriframe.plans import report_queries as R
from veriframe.plans.adapters import view, with_views
from veriframe.plans.geometry_queries import BOXES, OVER
from veriframe.sources import tables


def tiles(s, d):
    """8 x 8 luma tiles."""
    return view(s, d, "v_hand").select("vec_id", F.transform("e", lambda x: F.floor((x.cast("double") + 0.6) * 200).cast("double")).alias("t"))


def tile_stats(s, d):
    mean = F.aggregate("t", F.lit(0.0), lambda a, x: a + x) / 64
    out = tiles(s, d).withColumn("mean", mean)
    std = F.sqrt(F.aggregate("t", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean"))) / 64)
    return out.select("vec_id", "mean", std.alias("std"), F.array_max("t").alias("max"), G.brightness_verdict(F.col("mean"), 100, 125).alias("status"))


def gradient(s, d):
    @F.pandas_udf("double")
    def energy(t: pd.Series) -> pd.Series:
        return t.map(lambda x: pixels.gradient_energy(np.asarray(x, float).reshape(8, 8), border=False))

    return tiles(s, d).select("vec_id", energy("t").alias("sharpness"))


def detail(name, walk, columns):
    return lambda s, d: tables.detail_header(view(s, d, name).select("filename", "frame_index", *columns), walk=walk)


FACE, WALK = ("timestamp_sec", "yaw", "pitch", "brightness"), ("brightness", "body_scale", "centroid_x")
QUERIES = {
    "a17_c10_tile_statistics": tile_stats, "c14_gradient_energy": gradient, "k2_detail_header": detail("v_timeline", False, FACE), "k3_walk_detail_header": detail("v_walk", True, WALK),
    "k5_palm_overall": lambda s, d: R.overall(s, d).where("data_type = 'palm'").select("volunteer_id", "filename", "final_status", "reason").orderBy("volunteer_id", "filename"),
    "k12_overlay_spec": lambda s, d: S.overlay_spec(D.foreign_objects(view(s, d, "v_det"))), "o7_dashboard_order": lambda s, d: S.dashboard_order(R.rows(s, d)),
}

TILE = ", tl as (select vec_id, list_transform(e, lambda x: floor((x::double + 0.6::double) * 200)) t from v_hand), ms as (select vec_id, t, list_sum(t) / 64 mean from tl)"
_gx = "(t[i - 7] + 2 * t[i + 1] + t[i + 9]) - (t[i - 9] + 2 * t[i - 1] + t[i + 7])"
_gy = "(t[i + 7] + 2 * t[i + 8] + t[i + 9]) - (t[i - 9] + 2 * t[i - 8] + t[i - 7])"


def printed(column: str, digits: int) -> str:
    return f"coalesce(format('{{:.{digits}f}}', {column}), '') {column}"


ORACLE_SQL = {
    "a17_c10_tile_statistics": with_views(TILE + " select vec_id, mean, sqrt(list_sum(list_transform(t, lambda x: (x - mean) * (x - mean))) / 64) std, list_max(t) as max, case when mean >= 100 and mean <= 125 then 'PASS' else 'FAIL' end status from ms", "v_hand"),
    "c14_gradient_energy": with_views(TILE + f", ix as (select vec_id, t, unnest(list_filter(range(1, 65), lambda k: (k - 1) % 8 between 1 and 6 and (k - 1) // 8 between 1 and 6)) i from tl) select vec_id, sqrt(avg(({_gx}) * ({_gx}) + ({_gy}) * ({_gy}))) sharpness from ix group by 1", "v_hand"),
    "k2_detail_header": with_views("select filename, frame_index, " + ", ".join(printed(c, tables.FACE_DIGITS[c]) for c in FACE) + " from v_timeline", "v_timeline"),
    "k3_walk_detail_header": with_views("select filename, frame_index, " + ", ".join(printed(c, tables.WALK_DIGITS[c]) for c in WALK) + " from v_walk", "v_walk"),
    "k5_palm_overall": R.sql(R.OVERALL + " select volunteer_id, filename, final_status, reason from overall where data_type = 'palm'", "v_rows"),
    "k12_overlay_spec": with_views(BOXES + f" select filename, frame_index, x, y, w, h, cls_name || ' ' || round_even(conf * 100, 0)::int || '%' as label, case when pb is null then 'grey' when {OVER} then 'red' else 'green' end colour from fo", "v_det"),
    "o7_dashboard_order": with_views("select check_name, coalesce(case check_name " + " ".join(f"when '{k}' then {v}" for k, v in S.DASHBOARD_ORDER.items()) + " end, 9999)::int place from (select distinct check_name from v_rows)", "v_rows"),
}

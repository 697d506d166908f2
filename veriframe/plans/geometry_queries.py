"""Registered queries of landmark geometry, per-frame verdicts and detected objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriframe.operators import detections as D
from veriframe.operators import geometry as G
from veriframe.operators import modalities as X
from veriframe.operators import service as V
from veriframe.operators.filenames import PALM_KEYS
from veriframe.plans.adapters import view, with_views


def points(n: int = 21):
    c = lambda i, k: F.get("e", i * 3 + k).cast("double")
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(c(i, 0).alias("x"), c(i, 1).alias("y"), c(i, 2).alias("z"), F.abs(c(i, 0) * 2).alias("visibility")))


def shifted():
    """Points in the unit square."""
    return F.transform("points", lambda p: F.struct((p["x"] + 0.5).alias("x"), (p["y"] + 0.5).alias("y"), p["z"].alias("z"), p["visibility"].alias("visibility")))


def hands(s, d):
    return view(s, d, "v_hand").withColumn("points", points()).withColumn("unit", shifted()).withColumn("px", G.pixels(F.col("unit"), F.lit(640), F.lit(480)))


def det(s, d):
    return view(s, d, "v_det")


def one(**columns):
    return lambda s, d: hands(s, d).select("vec_id", *(f().alias(n) for n, f in columns.items()))


def angles():
    return G.palm_angles(F.col("points"), F.col("hand"))


def told(s, d, verdict):
    """The verdict with its reason on the angles."""
    return hands(s, d).withColumn("a", angles()).select("vec_id", verdict(F.col("a")).alias("v")).select("vec_id", "v.status", "v.reason")


#: Joints that a palm's plane is fitted to.
PLANE = (0, 5, 9, 13, 17)


def plane_patch(s, d):
    """The patch of each palm: its centre, half its diagonal, and that it is a square in the points' plane (their spread beside it is the least)."""
    some = F.array(*(F.element_at("points", i + 1) for i in PLANE))
    c = lambda k: F.get("patch", F.lit(k))
    middle = F.struct(*(((c(0)[x] + c(2)[x]) / 2).alias(x) for x in "xyz"))
    found = hands(s, d).select("vec_id", G.plane_patch(some).alias("patch")).withColumn("m", middle)
    length = F.sqrt(sum(((c(0)[x] - F.col("m")[x]) * (c(0)[x] - F.col("m")[x]) for x in "xyz"), F.lit(0.0)))
    corner = sum(((c(1)[x] - c(0)[x]) * (c(3)[x] - c(0)[x]) for x in "xyz"), F.lit(0.0))
    return found.select("vec_id", "m.x", "m.y", "m.z", length.alias("half_diagonal"), (F.abs(corner) < 1e-9).alias("square"))


def palm_detail(s, d):
    """Of stills whose names tell their poses: the rows on angles, in the order of poses."""
    name = F.concat(F.col("vec_id").cast("string"), F.lit("_palm_"), F.coalesce("hand", F.lit("X")), F.lit("_"), F.col("pose"), F.lit(".jpg"))
    rows = hands(s, d).withColumn("a", angles()).select(F.floor(F.col("vec_id") / 10).cast("string").alias("volunteer_id"), F.lit("palm").alias("data_type"), name.alias("filename"),
        F.when(F.col("vec_id") % 5 < 4, "check_palm_angle").otherwise("check_palm_size").alias("check_name"), X.angle_said(F.col("a")).alias("v")).select("*", "v.status", "v.reason")
    return V.palm_detail(rows, PALM_KEYS[::-1])


def flat(f, *names):
    return lambda s, d: hands(s, d).withColumn("a", f()).select("vec_id", *(F.col(f"a.{n}").alias(n) for n in names))


def head():
    return G.head_angles(F.col("points"), (0, 1, 2, 3, 4, 5, 6, 7))


def label():
    return F.when(F.col("vec_id") % 4 == 0, "Left").when(F.col("vec_id") % 4 < 3, "Right")


def c6(s, d):
    t = view(s, d, "v_timeline").where("face_detected and abs(yaw) >= 15")
    return t.select("filename", "frame_index", F.explode(F.array(*map(F.lit, G.FRONT_ONLY))).alias("check_name"), F.lit("SKIP").alias("status"))


def c26(s, d):
    posed = det(s, d).groupBy(*D.FRAME).agg(F.max(F.when(F.col("cls_id") == 3, F.struct("x", "y", "w", "h"))).alias("pose"))
    return posed.join(D.person_boxes(det(s, d)), D.FRAME, "left").select(*D.FRAME, F.coalesce(F.col("pose.x"), F.col("person.x")).alias("x"), F.coalesce(F.col("pose.h"), F.col("person.h")).alias("h"))


def c41(s, d):
    h = hands(s, d).withColumn("a", angles()).withColumn("volunteer", F.floor(F.col("vec_id") / 10)).where("hand is not null")
    rank = F.array_position(F.array(*(F.lit(f"{a}_{b}") for a in "LR" for b in ("N", "RL", "RR", "PU", "PD"))), F.concat_ws("_", "hand", "pose"))
    return h.select("vec_id", "volunteer", rank.alias("position"), G.pose_verdict(F.col("a"), F.col("hand"), F.col("pose")).alias("status"))


def brightness():
    return F.col("vec_id") % 300


def ratios():
    r = lambda k: F.when((F.col("vec_id") + k) % 9 != 0, ((F.col("vec_id") * (k + 1)) % 10) / 10.0)
    return F.map_from_arrays(F.array(F.lit("left_eye"), F.lit("right_eye"), F.lit("nose"), F.lit("mouth")), F.array(*map(r, range(4))))


def message():
    return F.when(F.col("vec_id") % 3 == 0, "No faces found").when(F.col("vec_id") % 3 == 1, "Multiple hands").otherwise("error")


OK = "vec_id % 5 < 2"
QUERIES = {
    "c1_face_detected": one(status=lambda: G.face_detected(F.expr(OK), message())), "c20_person_detected": one(status=lambda: G.detected(F.expr(OK))), "c29_palm_present": one(status=lambda: G.palm_present(F.expr(OK), message(), "REVIEW")),
    "c2_head_angles": flat(head, "pitch", "yaw", "roll"), "c3_head_direction": one(direction=lambda: G.head_direction(head())), "c5_head_fully": one(message=lambda: G.head_fully(F.col("px"), F.lit(640), F.lit(480), margin=150, top=1, chin=2, left=3, right=4)),
    "c6_front_only": c6, "c7_c31_min_size": lambda s, d: det(s, d).select("filename", "det_seq", "frame_index", G.min_size(F.col("w"), F.col("h"), 30, 60).alias("status")), "c8_eyes_open": one(status=lambda: G.eyes_open(F.abs(F.get("points", F.lit(0))["x"]) * 3, F.abs(F.get("points", F.lit(1))["x"]) * 3)),
    "c9_eye_aspect": one(ratio=lambda: G.eye_aspect(F.col("points"), (0, 1, 2, 3, 4, 5))), "c10_brightness_verdict": one(status=lambda: G.brightness_verdict(brightness())), "c13_walk_brightness": one(status=lambda: G.walk_brightness(brightness() + 0.5)),
    "c14_c15_blur_verdict": one(status=lambda: G.blur_verdict(G.brightness_verdict(brightness()), F.when(F.col("vec_id") % 7 != 0, F.col("vec_id") % 100))), "c16_occlusion_verdict": one(status=lambda: G.occlusion_verdict(ratios())),
    "c17_pixels_box": lambda s, d: hands(s, d).withColumn("b", G.bounding_box(F.col("px"), F.lit(640), F.lit(480))).select("vec_id", "b.x", "b.y", "b.w", "b.h"), "c18_real_person": one(real=lambda: G.real_person(F.col("points"), least_points=5), people=lambda: G.people(F.size(F.filter("points", lambda p: p["visibility"] > 0.8)))),
    "c19_body_height": one(height=lambda: G.body_height(F.col("unit"), least_visibility=0.3)), "c21_person_fully": flat(lambda: G.person_fully(F.col("px"), F.lit(640), F.lit(480), margin=120), "missing", "outside"), "c27_foot_line": one(line=lambda: G.foot_line(F.col("unit"), F.lit(0.9), (10, 11), least_visibility=0.3)),
    "c28_walk_signals": lambda s, d: det(s, d).select("filename", "frame_index", "det_seq", *(x.alias(n) for n, x in zip(("scale", "centroid"), G.walk_signals({"x": F.col("x"), "w": F.col("w"), "h": F.col("h")}, F.lit(640.0), F.lit(480.0)), strict=True))),
    "c22_occlusion_front": lambda s, d: D.occlusion(det(s, d)), "c22_c24_occlusion_side": lambda s, d: D.occlusion(det(s, d), foot_ratio=0.5), "j7_c23_foreign_overlap": lambda s, d: D.foreign_objects(det(s, d)).select("filename", "frame_index", "det_seq", "hits"), "c25_o6_ranked_classes": lambda s, d: D.ranked_classes(det(s, d), 3), "c26_person_box": c26,
    "c30_handedness": one(status=lambda: G.handedness_verdict(label(), F.col("score"), F.col("hand"), F.col("pose"))), "c32_palm_fully": one(message=lambda: G.palm_fully(F.col("px"), F.lit(640), F.lit(480), margin=150)),
    "c33_finger_gaps": flat(lambda: G.finger_gaps(F.col("unit")), "source", *(f"{a}_{b}" for a, b in G.NEIGHBOURS)), "c34_palm_spread": one(status=lambda: G.spread_verdict(G.finger_gaps(F.col("unit")), F.col("pose"))), "c35_palm_angles": flat(angles, "roll", "pitch", "error"), "c36_palm_angle_caps": lambda s, d: told(s, d, X.angle_said),
    "q_palm_detail": palm_detail, "c42_plane_patch": plane_patch, "c37_j9_pose_bands": lambda s, d: hands(s, d).select("vec_id", F.when(F.col("pose") != "N", F.create_map(*(F.lit(x) for k in G.POSE_AXIS for x in (k, G.band(k)[1])))[F.col("pose")]).alias("low")), "c38_palm_pose": lambda s, d: told(s, d, lambda a: X.directed_said(a, F.col("hand"), F.col("pose"))), "c39_palm_pose_absolute": one(status=lambda: G.pose_verdict(angles(), F.col("hand"), F.col("pose"), overrides={"R": {"RL": -1}})),
    "c40_palm_tilts": flat(lambda: G.palm_tilts(F.col("points")), "across", "up"), "c41_participant_angles": c41,
}

# DuckDB: points as p[i] = {x, y, z, v}; u[i] shifted; q[i] in pixels (1-based)
BASE = ", pt as (select *, list_transform(range(0, 21), lambda i: {'x': e[3 * i + 1]::double, 'y': e[3 * i + 2]::double, 'z': e[3 * i + 3]::double, 'v': abs(e[3 * i + 1]::double * 2)}) p from v_hand), hd as (select *, list_transform(p, lambda q: {'x': q.x + 0.5::double, 'y': q.y + 0.5::double, 'v': q.v}) u from pt), hq as (select *, list_transform(u, lambda q: {'x': trunc(q.x * 640)::int, 'y': trunc(q.y * 480)::int}) q from hd)"


def h(columns: str, more: str = "", source: str = "hq") -> str:
    return with_views(BASE + more + f" select vec_id, {columns} from {source}", "v_hand")


def o(tail: str) -> str:
    return with_views(tail, "v_det")


def vec(i: int) -> tuple[str, str, str]:
    return tuple(f"p[{i + 1}].{c}" for c in "xyz")  # type: ignore[return-value]


def sub(a, b):
    return tuple(f"({x} - {y})" for x, y in zip(a, b, strict=True))


def mean(*vs):
    return tuple("((" + " + ".join(v[k] for v in vs) + f") / {len(vs)})" for k in range(3))


def crs(a, b):
    return f"({a[1]} * {b[2]} - {a[2]} * {b[1]})", f"({a[2]} * {b[0]} - {a[0]} * {b[2]})", f"({a[0]} * {b[1]} - {a[1]} * {b[0]})"


def st(ok: str) -> str:
    return f"case when {ok} then 'PASS' else 'FAIL' end"


_left, _right = mean(vec(0), vec(1)), mean(vec(2), vec(3))
_up = sub(vec(7), vec(6))
_ce, _cm = crs(sub(_left, _right), _up), crs(sub(vec(4), vec(5)), _up)
HEAD = ", h1 as (select *, " + ", ".join(f"{v} {n}{k}" for n, c in (("ce", _ce), ("cm", _cm)) for k, v in enumerate(c)) + " from pt), h2 as (select *, " + ", ".join(f"(ce{k} / sqrt(ce0 * ce0 + ce1 * ce1 + ce2 * ce2) + cm{k} / sqrt(cm0 * cm0 + cm1 * cm1 + cm2 * cm2)) / 2 z{k}" for k in range(3)) + f" from h1), h3 as (select vec_id, degrees(atan2(z1, sqrt(z0 * z0 + z2 * z2))) * 1.45::double pitch, degrees(atan2(z0, z2)) * 1.05::double yaw, -((degrees(atan2({_right[1]} - {_left[1]}, {_right[0]} - {_left[0]})) + degrees(atan2(p[6].y - p[5].y, p[6].x - p[5].x))) / 2) * 0.7::double roll from h2)"
_fw, _sd = sub(vec(9), vec(0)), sub(mean(vec(13), vec(17)), vec(5))
_hyp = lambda v: f"sqrt({v[0]} * {v[0]} + {v[1]} * {v[1]})"
PALM = f", pa as (select *, degrees(atan2(-{_fw[2]}, {_hyp(_fw)})) pitch, case when coalesce(hand, '') = 'R' then -1 else 1 end * degrees(atan2({_sd[2]}, {_hyp(_sd)})) roll, null::varchar error from pt)"


def pose_sql(off: str = "", right_rl: int = 1) -> str:
    lo = lambda s: ("10 and 45" if s > 0 else "-45 and -10")
    rows = [f"when pose = 'N' then abs(roll) <= 15 and abs(pitch) <= 15", f"when pose = 'RL' and coalesce(hand, '') = 'R' then roll between {lo(right_rl)}{off.format('pitch')}"]
    rows += [f"when pose = '{k}' then {axis} between {lo(sign)}{off.format('pitch' if axis == 'roll' else 'roll')}" for k, (axis, sign) in G.POSE_AXIS.items()]
    return st("case " + " ".join(rows) + " else false end")


PATCH = f""", pl as (select vec_id, unnest([{", ".join(f"p[{i + 1}]" for i in PLANE)}]) t from pt), pm as (select vec_id, avg(t.x) x, avg(t.y) y, avg(t.z) z from pl group by 1)
 select vec_id, x, y, z, max(sqrt((t.x - x) * (t.x - x) + (t.y - y) * (t.y - y) + (t.z - z) * (t.z - z))) * 1.35::double * sqrt(2.0::double) half_diagonal, true square from pl join pm using (vec_id) group by all"""


def caps_sql() -> str:
    r, p = "printf('%.1f', roll)", "printf('%.1f', pitch)"
    part = lambda name, x: f"'{name}=' || printf('%.1f', {name}) || case when abs({name}) <= 45 then ' ok' else ' > 45' end"
    return f"{st('abs(roll) <= 45 and abs(pitch) <= 45')} status, case when abs(roll) <= 45 and abs(pitch) <= 45 then 'roll=' || {r} || ' pitch=' || {p} || ' within +/-45/+/-45' else {part('roll', r)} || ' ' || {part('pitch', p)} end reason"


def directed_sql() -> str:
    """The reasons of poses by their direction, pose by pose."""
    out = """when pose = 'N' and abs(roll) <= 15 and abs(pitch) <= 15 then 'N ok: roll=' || printf('%.1f', roll) || ' pitch=' || printf('%.1f', pitch) || ' within +/-15'
 when pose = 'N' then 'N not neutral: ' || array_to_string(list_filter([case when abs(roll) > 15 then 'roll=' || printf('%.1f', roll) || ' > +/-15' end, case when abs(pitch) > 15 then 'pitch=' || printf('%.1f', pitch) || ' > +/-15' end], lambda x: x is not null), ', ')"""
    for pose, axis, other, low, high, wrong in (("RL", "roll", "pitch", 10, 45, "< 0"), ("RR", "roll", "pitch", -45, -10, "> 0"), ("PU", "pitch", "roll", -45, -10, "> 0"), ("PD", "pitch", "roll", 10, 45, "< 0")):
        x, y, name = f"'{axis}=' || printf('%.1f', {axis})", f"'{other}=' || printf('%.1f', {other})", f"coalesce(hand, 'None') || '/{pose}"
        why = f"case when {axis} {wrong} then {x} || ' WRONG DIRECTION (expected [{low},{high}])' when abs({axis}) < 10 then {x} || ' not rotated enough (need |{axis}|>=10)' else {x} || ' out of [{low},{high}]' end"
        out += f"""
 when pose = '{pose}' and {axis} between {low} and {high} and abs({other}) <= 20 then {name} ok: ' || {x} || ' in [{low},{high}]; ' || {y} || ' within +/-20'
 when pose = '{pose}' then {name} bad: ' || array_to_string(list_filter([case when not {axis} between {low} and {high} then {why} end, case when abs({other}) > 20 then {y} || ' off-axis > +/-20' end], lambda x: x is not null), '; ')"""
    return pose_sql(" and abs({}) <= 20") + f" status, case {out} end reason"


def gaps_sql() -> str:
    ins = lambda i: f"(u[{i + 1}].x > 0.02::double and u[{i + 1}].x < 0.98::double and u[{i + 1}].y > 0.02::double and u[{i + 1}].y < 0.98::double)"
    alls = lambda j: " and ".join(ins(f[j]) for f in G.FINGERS.values())
    arm = lambda f, c: f"(case when source = 'tip' then u[{G.FINGERS[f][2] + 1}].{c} else u[{G.FINGERS[f][1] + 1}].{c} end - u[{G.FINGERS[f][0] + 1}].{c})"
    out = []
    for a, b in G.NEIGHBOURS:
        ux, uy, vx, vy = arm(a, "x"), arm(a, "y"), arm(b, "x"), arm(b, "y")
        out.append(f"case when source is not null then degrees(acos(greatest(-1.0::double, least(1.0::double, ({ux} * {vx} + {uy} * {vy}) / (sqrt({ux} * {ux} + {uy} * {uy}) * sqrt({vx} * {vx} + {vy} * {vy})))))) end {a}_{b}")
    return f", g1 as (select *, case when not ({alls(0)}) then null when {alls(2)} then 'tip' when {alls(1)} then 'pip' end source from hq), g2 as (select *, {', '.join(out)} from g1)"


_tl = lambda v: f"degrees(atan2({v[2]}, {_hyp(v)}))"
_px = lambda i, c: f"q[{i + 1}].{c}"
MSG = "case vec_id % 3 when 0 then 'No faces found' when 1 then 'Multiple hands' else 'error' end"
PEOPLE = "len(list_filter(p, lambda t: t.v > 0.8::double))"
BOXES = ", ps as (select filename, frame_index, arg_max(row(x, y, w, h), conf * 1000000 - det_seq) pb from v_det where cls_id = 0 group by 1, 2), fo as (select d.*, pb from v_det d left join ps using (filename, frame_index) where conf >= 0.6::double and cls_id <> 0)"


def occl(hit: str) -> str:
    return o(BOXES + f", ht as (select *, case when pb is not null then {hit} end hits from fo), sm as (select filename, frame_index, count(*) n_foreign, count(*) filter (hits) n_hits, bool_or(hits is null) unclear from ht group by 1, 2), fs as (select distinct filename, frame_index from v_det) select filename, frame_index, coalesce(n_foreign, 0) n_foreign, coalesce(n_hits, 0) n_hits, case when coalesce(unclear or n_hits > 0, false) then 'FAIL' else 'PASS' end status from fs left join sm using (filename, frame_index)")


OVER = "least(x + w, pb[1] + pb[3]) > greatest(x, pb[1]) and least(y + h, pb[2] + pb[4]) > greatest(y, pb[2])"
NAMED = "[" + ", ".join(f"{{'i': {i}, 'n': '{n}'}}" for i, n in G.PERSON_POINTS.items()) + "]"
ORACLE_SQL = {
    "c1_face_detected": h(f"case when {OK} then 'PASS' when starts_with({MSG}, 'No faces') then 'SKIP' else 'FAIL' end status"), "c20_person_detected": h(st(OK) + " status"), "c29_palm_present": h(f"case when {OK} then 'PASS' when starts_with({MSG}, 'Multiple') then 'REVIEW' else 'FAIL' end status"),
    "c2_head_angles": with_views(BASE + HEAD + " select * from h3", "v_hand"), "c3_head_direction": with_views(BASE + HEAD + " select vec_id, case when yaw < -10 then 'Looking Left' when yaw > 10 then 'Looking Right' when pitch < -10 then 'Looking Down' when pitch > 15 then 'Looking Up' when roll < -10 then 'Tilting Left' when roll > 10 then 'Tilting Right' else 'Forward' end direction from h3", "v_hand"),
    "c5_head_fully": h(f"case when {_px(1, 'y')} < 150 and {_px(2, 'y')} > 330 then 'Top of head and chin might be cut' when {_px(1, 'y')} < 150 then 'Top of head might be cut' when {_px(2, 'y')} > 330 then 'Chin might be cut' when {_px(3, 'x')} < 150 then 'Left cheek might be cut' when {_px(4, 'x')} > 490 then 'Right cheek might be cut' else 'Head is fully visible' end message"),
    "c6_front_only": with_views("select filename, frame_index, unnest([" + ", ".join(f"'{c}'" for c in G.FRONT_ONLY) + "]) check_name, 'SKIP' status from v_timeline where face_detected and abs(yaw) >= 15", "v_timeline"),
    "c7_c31_min_size": o("select filename, det_seq, frame_index, case when w >= 30 and h >= 60 then 'PASS' else 'FAIL' end status from v_det"), "c8_eyes_open": h(st("abs(p[1].x) * 3 < 0.5::double and abs(p[2].x) * 3 < 0.5::double") + " status"),
    "c9_eye_aspect": h("(" + " + ".join(_hyp(sub(vec(a), vec(b))) for a, b in ((1, 5), (2, 4))) + f") / ({_hyp(sub(vec(0), vec(3)))} * 2) ratio"), "c10_brightness_verdict": h(st("vec_id % 300 >= 35 and vec_id % 300 <= 220") + " status"), "c13_walk_brightness": h(st("round_even(vec_id % 300 + 0.5::double, 0) < 35 or round_even(vec_id % 300 + 0.5::double, 0) > 220") + " status"),
    "c14_c15_blur_verdict": h("case when vec_id % 300 < 35 or vec_id % 300 > 220 or vec_id % 7 = 0 then 'SKIP' when vec_id % 100 < 50 then 'FAIL' else 'PASS' end status"), "c16_occlusion_verdict": h(st(" and ".join(f"coalesce(case when (vec_id + {k}) % 9 <> 0 then (vec_id * {k + 1}) % 10 >= 4 end, false)" for k in range(4))) + " status"),
    "c17_pixels_box": with_views(BASE + ", bx as (select vec_id, list_min(list_transform(q, lambda t: t.x)) x0, list_max(list_transform(q, lambda t: t.x)) x1, list_min(list_transform(q, lambda t: t.y)) y0, list_max(list_transform(q, lambda t: t.y)) y1 from hq), by_ as (select vec_id, greatest(0, x0 - trunc((x1 - x0) * 0.1::double)::int) x, greatest(0, y0 - trunc((y1 - y0) * 0.1::double)::int) y, least(640, x1 + trunc((x1 - x0) * 0.1::double)::int) r, least(480, y1 + trunc((y1 - y0) * 0.1::double)::int) b from bx) select vec_id, x, y, r - x w, b - y h from by_", "v_hand"),
    "c18_real_person": h(f"len(list_filter(p, lambda t: t.v >= 0.5::double)) >= 5 as real, case when {PEOPLE} > 1 then 'Multiple persons detected' when {PEOPLE} = 0 then 'No poses detected' else 'ok' end people"),
    "c19_body_height": h("case when len(list_filter(u, lambda t: t.v >= 0.3::double)) >= 4 then list_max(list_transform(list_filter(u, lambda t: t.v >= 0.3::double), lambda t: t.y)) - list_min(list_transform(list_filter(u, lambda t: t.v >= 0.3::double), lambda t: t.y)) end height"),
    "c21_person_fully": h(f"list_transform(list_filter({NAMED}, lambda r: r.i >= 21), lambda r: r.n) missing, list_transform(list_filter({NAMED}, lambda r: coalesce(q[r.i + 1].x < 120 or q[r.i + 1].x > 520 or q[r.i + 1].y < 120 or q[r.i + 1].y > 360, false)), lambda r: r.n) outside"),
    "c27_foot_line": h("coalesce(greatest(case when u[11].v >= 0.3::double then u[11].y end, case when u[12].v >= 0.3::double then u[12].y end), 0.9::double) as line"), "c28_walk_signals": o("select filename, frame_index, det_seq, h / 480.0::double as scale, (x + w / 2) / 640.0::double centroid from v_det"),
    "c22_occlusion_front": occl(OVER), "c22_c24_occlusion_side": occl("y + h between pb[2] + pb[4] - pb[4] * 0.5::double and pb[2] + pb[4] + pb[4] * 0.5::double"), "j7_c23_foreign_overlap": o(BOXES + f" select filename, frame_index, det_seq, case when pb is not null then {OVER} end hits from fo"),
    "c25_o6_ranked_classes": o(", bc as (select filename, frame_index, cls_name, max(conf) conf, min(det_seq) seen from v_det group by 1, 2, 3), rk as (select *, row_number() over (partition by filename, frame_index order by conf desc, seen) pl from bc) select filename, frame_index, list(cls_name order by pl) filter (pl <= 3) top, greatest(count(*) - 3, 0) more from rk group by 1, 2"),
    "c26_person_box": o(BOXES + ", po as (select filename, frame_index, max(row(x, y, w, h)) filter (cls_id = 3) po from v_det group by 1, 2) select filename, frame_index, coalesce(po[1], pb[1]) x, coalesce(po[4], pb[4]) h from po left join ps using (filename, frame_index)"),
    "c30_handedness": h("case when pose <> 'N' or hand is null or vec_id % 4 >= 3 then 'SKIP' when (vec_id % 4 = 0) = (hand = 'L') then 'PASS' when score < 0.7::double then 'SKIP' else 'FAIL' end status"),
    "c32_palm_fully": h(f"case when {_px(0, 'y')} > 330 and {_px(9, 'y')} < 150 then 'Wrist and upper palm might be cut' when {_px(0, 'y')} > 330 or {_px(0, 'y')} < 150 then 'Wrist might be cut' when {_px(9, 'y')} < 150 or {_px(9, 'y')} > 330 then 'Upper palm might be cut' when {_px(0, 'x')} < 150 or {_px(9, 'x')} < 150 then 'Left side of hand might be cut' when {_px(0, 'x')} > 490 or {_px(9, 'x')} > 490 then 'Right side of hand might be cut' else 'Palm is fully visible' end message"),
    "c33_finger_gaps": h("source, " + ", ".join(f"{a}_{b}" for a, b in G.NEIGHBOURS), gaps_sql(), "g2"), "c34_palm_spread": h("case when pose <> 'N' or source is null then 'SKIP' when " + " and ".join(f"coalesce({a}_{b} >= {15 if a == 'thumb' else 2}, false)" for a, b in G.NEIGHBOURS) + " then 'PASS' else 'FAIL' end status", gaps_sql(), "g2"),
    "c35_palm_angles": h("roll, pitch, error", PALM, "pa"), "c36_palm_angle_caps": h(caps_sql(), PALM, "pa"), "c42_plane_patch": with_views(BASE + PATCH, "v_hand"), "q_palm_detail": with_views(BASE + PALM + f" select floor(vec_id / 10)::bigint::varchar volunteer_id, 'palm' data_type, vec_id || '_palm_' || coalesce(hand, 'X') || '_' || pose || '.jpg' filename, 'check_palm_angle' check_name, {caps_sql()}, coalesce(10 - list_position({list(PALM_KEYS)}, 'palm_' || hand || '_' || pose), 10)::int as position from pa where vec_id % 5 < 4", "v_hand"), "c37_j9_pose_bands": h("case pose when 'RL' then 10 when 'RR' then -45 when 'PU' then -45 when 'PD' then 10 end low"),
    "c38_palm_pose": h(directed_sql(), PALM, "pa"), "c39_palm_pose_absolute": h(pose_sql(right_rl=-1) + " status", PALM, "pa"), "c40_palm_tilts": h(f"{_tl(sub(mean(vec(13), vec(17)), mean(vec(1), vec(5))))} across, {_tl(sub(mean(vec(5), vec(9), vec(13), vec(17)), vec(0)))} up", "", "pt"),
    "c41_participant_angles": with_views(BASE + PALM + f" select vec_id, floor(vec_id / 10)::bigint volunteer, list_position(['L_N', 'L_RL', 'L_RR', 'L_PU', 'L_PD', 'R_N', 'R_RL', 'R_RR', 'R_PU', 'R_PD'], hand || '_' || pose)::bigint as position, {pose_sql()} status from pa where hand is not null", "v_hand"),
}

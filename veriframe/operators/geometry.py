"""Landmark geometry and per-frame verdicts as column expressions; nothing here leaves the JVM or shuffles.

Landmarks are ``array<struct<x, y, z>>`` columns (pose points also have ``visibility``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veriframe.functions.status import FAIL, PASS, SKIP

Vector = tuple[Column, Column, Column]


def at(points: Column, i: int) -> Vector:
    p = F.get(points, F.lit(i))
    return p["x"], p["y"], p["z"]


def minus(a: Vector, b: Vector) -> Vector:
    return a[0] - b[0], a[1] - b[1], a[2] - b[2]


def middle(a: Vector, b: Vector) -> Vector:
    return (a[0] + b[0]) / 2, (a[1] + b[1]) / 2, (a[2] + b[2]) / 2


def cross(a: Vector, b: Vector) -> Vector:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def norm(a: Vector) -> Column:
    return F.sqrt(a[0] * a[0] + a[1] * a[1] + a[2] * a[2])


def unit(a: Vector) -> Vector:
    n = norm(a)
    return F.try_divide(a[0], n), F.try_divide(a[1], n), F.try_divide(a[2], n)


def turn(y: Column, x: Column) -> Column:
    return F.degrees(F.atan2(y, x))


def mean_of(points: Column, ids: list[int]) -> Vector:
    ps = [at(points, i) for i in ids]
    return tuple(sum((p[k] for p in ps[1:]), ps[0][k]) / len(ps) for k in range(3))  # type: ignore[return-value]


# Faces

#: Points of the face mesh: left eye's corners, right eye's corners, mouth's corners, chin, forehead.
FACE_ANCHORS = (33, 133, 362, 263, 61, 291, 152, 10)


def head_angles(points: Column, anchors: tuple[int, ...] = FACE_ANCHORS) -> Column:
    """struct<pitch, yaw, roll> in degrees; null if degenerate."""
    ll, lr, rl, rr, ml, mr, chin, top = (at(points, i) for i in anchors)
    left, right = middle(ll, lr), middle(rl, rr)
    up = minus(top, chin)
    eye, mouth = unit(cross(minus(left, right), up)), unit(cross(minus(ml, mr), up))
    z = middle(eye, mouth)
    yaw = turn(z[0], z[2]) * 1.05
    pitch = turn(z[1], F.sqrt(z[0] * z[0] + z[2] * z[2])) * 1.45
    roll = -((turn(right[1] - left[1], right[0] - left[0]) + turn(mr[1] - ml[1], mr[0] - ml[0])) / 2) * 0.7
    return F.struct(pitch.alias("pitch"), yaw.alias("yaw"), roll.alias("roll"))


def head_direction(a: Column, *, left=-10.0, right=10.0, down=-10.0, up=15.0, tilt_left=-10.0, tilt_right=10.0) -> Column:
    yaw, pitch, roll = a["yaw"], a["pitch"], a["roll"]
    return (
        F.when(yaw < left, "Looking Left").when(yaw > right, "Looking Right").when(pitch < down, "Looking Down").when(pitch > up, "Looking Up")
        .when(roll < tilt_left, "Tilting Left").when(roll > tilt_right, "Tilting Right").otherwise("Forward")
    )


def face_detected(ok: Column, message: Column) -> Column:
    return F.when(ok, PASS).when(message.startswith("No faces"), SKIP).otherwise(FAIL)


def detected(ok: Column) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), PASS).otherwise(FAIL)


def palm_present(ok: Column, message: Column, many: str = FAIL) -> Column:
    return F.when(ok, PASS).when(message.startswith("Multiple"), many).otherwise(FAIL)


def passes(ok: Column) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), PASS).otherwise(FAIL)


def head_fully(points: Column, width: Column, height: Column, *, margin: int = 10, top: int = 10, chin: int = 152, left: int = 234, right: int = 454) -> Column:
    """What is cut, the worst first; points are in pixels."""
    over, under = at(points, top)[1] < margin, at(points, chin)[1] > height - margin
    return (
        F.when(over & under, "Top of head and chin might be cut").when(over, "Top of head might be cut").when(under, "Chin might be cut")
        .when(at(points, left)[0] < margin, "Left cheek might be cut").when(at(points, right)[0] > width - margin, "Right cheek might be cut").otherwise("Head is fully visible")
    )


def min_size(width: Column, height: Column, least_width: float, least_height: float) -> Column:
    return passes((width >= least_width) & (height >= least_height))


def eyes_open(left: Column, right: Column, limit: float = 0.5) -> Column:
    return passes((left < limit) & (right < limit))


def eye_aspect(points: Column, ids: tuple[int, int, int, int, int, int]) -> Column:
    """Lid distances over the eye's width; zero width gives zero."""
    p = [at(points, i) for i in ids]
    gap = lambda a, b: F.hypot(a[0] - b[0], a[1] - b[1])
    wide = gap(p[0], p[3])
    return F.when(wide == 0, 0.0).otherwise((gap(p[1], p[5]) + gap(p[2], p[4])) / (wide * 2))


def brightness_verdict(value: Column, dark: float = 35, bright: float = 220) -> Column:
    return passes((value >= dark) & (value <= bright))


def walk_brightness(value: Column, dark: float = 35, bright: float = 220) -> Column:
    """The other way round: passes if the rounded brightness is outside the rounded limits."""
    b = F.bround(value)
    return passes((b < round(dark)) | (b > round(bright)))


def blur_verdict(brightness_status: Column, sharpness: Column, limit: float = 50) -> Column:
    """SKIP where brightness failed or sharpness couldn't be measured."""
    return F.when((brightness_status == FAIL) | sharpness.isNull(), SKIP).when(sharpness < limit, FAIL).otherwise(PASS)


def occlusion_verdict(ratios: Column, required: tuple[str, ...] = ("left_eye", "right_eye", "nose", "mouth"), least: float = 0.4) -> Column:
    """FAIL if the skin ratio of a required region is missing or too low. ratios: map<region, ratio>."""
    return passes(F.forall(F.array(*map(F.lit, required)), lambda r: F.coalesce(F.try_element_at(ratios, r) >= least, F.lit(False))))


FRONT_ONLY = ("check_face_size", "check_eyes_open", "check_brightness", "check_face_blur", "check_occlusion")


# Boxes and poses


def pixels(points: Column, width: Column, height: Column) -> Column:
    """Normalised points in whole pixels, cut towards zero."""
    return F.transform(points, lambda p: F.struct((p["x"] * width).cast("int").alias("x"), (p["y"] * height).cast("int").alias("y")))


def bounding_box(px: Column, width: Column, height: Column) -> Column:
    """struct<x, y, w, h>: the points' extent and a tenth on each side, within the frame."""
    span = lambda c: (F.array_min(F.transform(px, lambda p: p[c])), F.array_max(F.transform(px, lambda p: p[c])))
    (x0, x1), (y0, y1) = span("x"), span("y")
    dx, dy = ((x1 - x0) * 0.1).cast("int"), ((y1 - y0) * 0.1).cast("int")
    left, top = F.greatest(F.lit(0), x0 - dx), F.greatest(F.lit(0), y0 - dy)
    right, bottom = F.least(width, x1 + dx), F.least(height, y1 + dy)
    return F.struct(left.alias("x"), top.alias("y"), (right - left).alias("w"), (bottom - top).alias("h"))


def real_person(points: Column, *, least_visibility: float = 0.5, least_points: int = 8) -> Column:
    return F.size(F.filter(points, lambda p: F.coalesce(p["visibility"] >= least_visibility, F.lit(False)))) >= least_points


def people(n_real: Column) -> Column:
    return F.when(n_real > 1, "Multiple persons detected").when(n_real == 0, "No poses detected").otherwise("ok")


def body_height(points: Column, *, least_visibility: float = 0.5, least_points: int = 4) -> Column:
    """The height of the visible points (unknown visibility counts as visible); null if there are too few."""
    ys = F.transform(F.filter(points, lambda p: F.coalesce(p["visibility"] >= least_visibility, F.lit(True))), lambda p: p["y"])
    return F.when(F.size(ys) >= least_points, F.array_max(ys) - F.array_min(ys))


# Points of the pose that must be in the frame.
PERSON_POINTS = {2: "left_eye", 5: "right_eye", 7: "left_ear", 8: "right_ear", 19: "left_hand", 20: "right_hand", 31: "left_foot", 32: "right_foot"}


def person_fully(px: Column, width: Column, height: Column, *, margin: int = 0, required: dict[int, str] = PERSON_POINTS) -> Column:
    """struct<missing, outside>: names of required points that don't exist or are out of the frame."""
    named = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(n).alias("n")) for i, n in required.items()))
    point = lambda r: F.get(px, r["i"])
    outside = lambda r: F.coalesce((point(r)["x"] < margin) | (point(r)["x"] > width - margin) | (point(r)["y"] < margin) | (point(r)["y"] > height - margin), F.lit(False))
    names = lambda keep: F.transform(F.filter(named, keep), lambda r: r["n"])
    return F.struct(names(lambda r: r["i"] >= F.size(px)).alias("missing"), names(outside).alias("outside"))


def foot_line(points: Column, box_bottom: Column, feet: tuple[int, int] = (31, 32), *, least_visibility: float = 0.5) -> Column:
    """The lower of the visible feet, else the bottom of the person's box."""
    y = lambda i: F.when(F.get(points, F.lit(i))["visibility"] >= least_visibility, F.get(points, F.lit(i))["y"])
    return F.coalesce(F.greatest(*(y(i) for i in feet)), box_bottom)


def walk_signals(box: Column, width: Column, height: Column) -> tuple[Column, Column]:
    return box["h"] / height, (box["x"] + box["w"] / 2) / width


# Palms


def palm_angles(points: Column, hand: Column) -> Column:
    """struct<roll, pitch, error>: depth angles of the palm's side and forward axes; roll is mirrored for right hands."""
    forward = minus(at(points, 9), at(points, 0))
    side = minus(mean_of(points, [13, 17]), at(points, 5))
    forward_xy, side_xy = F.hypot(forward[0], forward[1]), F.hypot(side[0], side[1])
    error = (
        F.when(points.isNull(), "No landmarks provided").when(F.size(points) < 21, "Expected 21 landmarks")
        .when(forward_xy < 1e-9, "degenerate palm geometry (zero-length wrist-to-middle axis)").when(side_xy < 1e-9, "degenerate palm geometry (zero-width palm side axis)")
    )
    raw = turn(side[2], side_xy)
    roll = F.when(F.coalesce(F.upper(hand), F.lit("")).isin("R", "RIGHT"), -raw).otherwise(raw)
    fine = error.isNull()
    return F.struct(F.when(fine, roll).alias("roll"), F.when(fine, turn(-forward[2], forward_xy)).alias("pitch"), error.alias("error"))


def palm_tilts(points: Column) -> Column:
    side = minus(mean_of(points, [13, 17]), mean_of(points, [1, 5]))
    up = minus(mean_of(points, [5, 9, 13, 17]), at(points, 0))
    tilt = lambda v: turn(v[2], F.hypot(v[0], v[1]))
    return F.struct(tilt(side).alias("across"), tilt(up).alias("up"))


def angle_within(a: Column, most: float = 45) -> Column:
    return passes(a["error"].isNull() & (F.abs(a["roll"]) <= most) & (F.abs(a["pitch"]) <= most))


# The axis that a pose turns about, and the sign that its angle must have.
POSE_AXIS = {"RL": ("roll", 1), "RR": ("roll", -1), "PU": ("pitch", -1), "PD": ("pitch", 1)}


def band(pose: str, *, most: float = 45, least: float = 10, sign: int | None = None) -> tuple[str, float, float]:
    axis, usual = POSE_AXIS[pose]
    return (axis, least, most) if (sign or usual) > 0 else (axis, -most, -least)


def pose_verdict(a: Column, hand: Column, pose: Column, *, most: float = 45, least: float = 10, neutral: float = 15, off_axis: float | None = None, overrides: dict[str, dict[str, int]] | None = None) -> Column:
    """N: both angles near zero. A turned pose: its angle in the band; the other one counts only if off_axis is given."""
    out = F.when(pose == "N", passes((F.abs(a["roll"]) <= neutral) & (F.abs(a["pitch"]) <= neutral)))
    for name in POSE_AXIS:
        for h in [*(overrides or {}), None]:
            axis, lo, hi = band(name, most=most, least=least, sign=(overrides or {}).get(h, {}).get(name) if h else None)
            ok = (a[axis] >= lo) & (a[axis] <= hi)
            if off_axis is not None:
                ok = ok & (F.abs(a["pitch" if axis == "roll" else "roll"]) <= off_axis)
            out = out.when((pose == name) & ((F.upper(hand) == h) if h else F.lit(True)), passes(ok))
    return F.when(a["error"].isNotNull(), FAIL).otherwise(out.otherwise(FAIL))


# Each finger's first, middle and end joint.
FINGERS = {"thumb": (2, 3, 4), "index": (5, 6, 8), "middle": (9, 10, 12), "ring": (13, 14, 16), "pinky": (17, 18, 20)}
NEIGHBOURS = (("thumb", "index"), ("index", "middle"), ("middle", "ring"), ("ring", "pinky"))


def finger_gaps(points: Column, margin: float = 0.02) -> Column:
    """struct<source, gaps>: the joint used for the whole hand (tip, pip or null if unmeasurable) and the four angles."""
    def inside(i: int) -> Column:
        x, y, _ = at(points, i)
        return (x > margin) & (x < 1 - margin) & (y > margin) & (y < 1 - margin)
    def all_inside(joint: int) -> Column:
        out = F.lit(True)
        for f in FINGERS.values():
            out = out & F.coalesce(inside(f[joint]), F.lit(False))
        return out
    source = F.when(~all_inside(0), F.lit(None)).when(all_inside(2), "tip").when(all_inside(1), "pip")
    def arm(finger: str) -> tuple[Column, Column]:
        a, mid, tip = (at(points, i) for i in FINGERS[finger])
        return tuple(F.when(source == "tip", tip[k]).otherwise(mid[k]) - a[k] for k in (0, 1))  # type: ignore[return-value]
    def between(a: str, b: str) -> Column:
        (ux, uy), (vx, vy) = arm(a), arm(b)
        flat = ((ux == 0) & (uy == 0)) | ((vx == 0) & (vy == 0))
        c = (ux * vx + uy * vy) / (F.hypot(ux, uy) * F.hypot(vx, vy))
        return F.when(source.isNotNull() & ~flat, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c)))))
    return F.struct(source.alias("source"), *(between(a, b).alias(f"{a}_{b}") for a, b in NEIGHBOURS))


def spread_verdict(gaps: Column, pose: Column, *, thumb: float = 15, inter: float = 2) -> Column:
    """N only; unmeasurable hands are skipped; a missing or small gap fails."""
    ok = F.lit(True)
    for a, b in NEIGHBOURS:
        ok = ok & F.coalesce(gaps[f"{a}_{b}"] >= (thumb if a == "thumb" else inter), F.lit(False))
    return F.when((pose != "N") | gaps["source"].isNull(), SKIP).otherwise(passes(ok))


def handedness_verdict(label: Column, score: Column, hand: Column, pose: Column, *, opposite: bool = False, least: float = 0.7) -> Column:
    """A match passes; a mismatch fails unless its score is low; N only."""
    full = F.when(F.upper(hand) == "L", "RIGHT" if opposite else "LEFT").when(F.upper(hand) == "R", "LEFT" if opposite else "RIGHT")
    seen = F.upper(label)
    return F.when((pose != "N") | full.isNull() | seen.isNull() | ~seen.isin("LEFT", "RIGHT"), SKIP).when(seen == full, PASS).when(score < least, SKIP).otherwise(FAIL)


def palm_fully(points: Column, width: Column, height: Column, *, margin: int = 10) -> Column:
    (wx, wy, _), (mx, my, _) = at(points, 0), at(points, 9)
    w_top, w_bottom, m_top, m_bottom = wy < margin, wy > height - margin, my < margin, my > height - margin
    return (
        F.when(w_bottom & m_top, "Wrist and upper palm might be cut").when(w_bottom | w_top, "Wrist might be cut").when(m_top | m_bottom, "Upper palm might be cut")
        .when((wx < margin) | (mx < margin), "Left side of hand might be cut").when((wx > width - margin) | (mx > width - margin), "Right side of hand might be cut").otherwise("Palm is fully visible")
    )


# A patch of the plane through points, for drawing


def eigen3(matrix: Column, sweeps: int = 6) -> Column:
    """array of struct<value, x, y, z> of a symmetric 3 x 3 matrix (array of nine numbers, row by row), the largest value first.

    Jacobi rotations of one pair of axes after the other, as a fold over their numbers: two steps each, one that finds the angle and
    one that turns the matrix and the vectors, so that no expression is repeated inside another.
    """
    axes = ((0, 1), (0, 2), (1, 2))
    unit = F.array(*(F.lit(float(i % 4 == 0)) for i in range(9)))

    def angle(state: Column, p: int, q: int) -> Column:
        a = state["a"]
        off, span = F.get(a, F.lit(3 * p + q)), F.get(a, F.lit(4 * q)) - F.get(a, F.lit(4 * p))
        theta = F.try_divide(span, 2 * off)
        t = F.when(theta.isNull(), 0.0).otherwise(F.when(theta < 0, -1.0).otherwise(1.0) / (F.abs(theta) + F.sqrt(theta * theta + 1)))
        return F.struct(state["a"].alias("a"), state["v"].alias("v"), t.alias("t"))

    def turned(state: Column, p: int, q: int) -> Column:
        c = 1 / F.sqrt(1 + state["t"] * state["t"])
        s = state["t"] * c

        def columns(m: Column) -> Column:
            """m times the rotation."""
            at = lambda i, k: F.get(m, F.lit(3 * i + k))
            new = {p: lambda i: c * at(i, p) - s * at(i, q), q: lambda i: s * at(i, p) + c * at(i, q)}
            return F.array(*((new[k](i) if k in new else at(i, k)) for i in range(3) for k in range(3)))

        flipped = lambda m: F.array(*(F.get(m, F.lit(3 * k + i)) for i in range(3) for k in range(3)))
        # of a symmetric matrix: turn the columns, flip, turn the columns again; through arrays of one, so that each is worked out once
        once = F.transform(F.array(state["a"]), lambda m: columns(m))
        twice = F.transform(F.transform(once, flipped), lambda m: columns(m))
        return F.struct(twice[0].alias("a"), columns(state["v"]).alias("v"), state["t"].alias("t"))

    def step(state: Column, k: Column) -> Column:
        out = state
        for n, (p, q) in enumerate(axes):
            out = F.when(k % 6 == 2 * n, angle(state, p, q)).when(k % 6 == 2 * n + 1, turned(state, p, q)).otherwise(out)
        return out

    start = F.struct(matrix.cast("array<double>").alias("a"), unit.alias("v"), F.lit(0.0).alias("t"))
    end = F.aggregate(F.sequence(F.lit(0), F.lit(6 * sweeps - 1)), start, step)
    pair = lambda s, i: F.struct((-F.get(s["a"], F.lit(4 * i))).alias("order"), F.lit(i).alias("i"), *(F.get(s["v"], F.lit(3 * k + i)).alias(n) for k, n in enumerate("xyz")))
    found = F.transform(F.array(end), lambda s: F.array_sort(F.array(*(pair(s, i) for i in range(3)))))[0]
    return F.transform(found, lambda e: F.struct((-e["order"]).alias("value"), e["x"], e["y"], e["z"]))


def plane_patch(points: Column, scale: float = 1.35, least: float = 0.03) -> Column:
    """Four corners (struct<x, y, z>) of a square in the plane that fits the points best: around their mean, along the two directions in which
    they spread most, ``scale`` times as far as the farthest point (``least`` if all are one point). null without points.

    The directions' signs are as the rotations leave them; the square is the same for either.
    """
    n = F.size(points)
    mean = F.struct(*((F.aggregate(points, F.lit(0.0), lambda s, p: s + p[c]) / n).alias(c) for c in "xyz"))
    around = F.transform(F.array(mean), lambda m: F.struct(m.alias("m"), F.transform(points, lambda p: F.struct(*((p[c] - m[c]).alias(c) for c in "xyz"))).alias("d")))

    def with_axes(a: Column) -> Column:
        spread = F.array(*(F.aggregate(a["d"], F.lit(0.0), lambda s, p: s + p[x] * p[y]) for x in "xyz" for y in "xyz"))
        far = F.array_max(F.transform(a["d"], lambda p: F.sqrt(p["x"] * p["x"] + p["y"] * p["y"] + p["z"] * p["z"]))) * scale
        return F.struct(a["m"].alias("m"), F.when(far > 0, far).otherwise(least).alias("r"), eigen3(spread).alias("e"))

    def corners(a: Column) -> Column:
        u, v = a["e"][0], a["e"][1]
        corner = lambda i, k: F.struct(*((a["m"][c] + a["r"] * (i * u[c] + k * v[c])).alias(c) for c in "xyz"))
        return F.array(*(corner(i, k) for i, k in ((-1, -1), (1, -1), (1, 1), (-1, 1))))

    return F.when(n > 0, F.transform(F.transform(around, with_axes), corners)[0])

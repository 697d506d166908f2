"""Registered queries of the three modalities, from observations to check rows and summaries.

The SQL is written from the rules (which rows a file of each kind gets, and with which reasons), file by file and branch by branch, not
from the operators' plan: a union of one select for each check.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veriframe.operators import checks as C
from veriframe.operators import modalities as X
from veriframe.operators import report as R
from veriframe.operators import sequence as S
from veriframe.plans import sequence_queries as Q
from veriframe.plans.adapters import duck, view
from veriframe.plans.geometry_queries import hands

LIGHT = X.WalkPolicy(brightness=True)


def lacks(capability: str, why) -> F.Column:
    return F.when(why.isNotNull(), F.create_map(F.lit(capability), why))


def tasks(s, d):
    """Each event is a frame."""
    return X.tasks_for(s.read.parquet(f"{d}/events.parquet").count())


def face(s, d, p=X.FacePolicy()):
    skin = F.map_from_arrays(F.array(*map(F.lit, X.REGIONS)), F.array(*(F.col(f"skin_{r}") for r in X.REGIONS)))
    frames = view(s, d, "v_face_obs").withColumns({"skin": skin, "lacks": lacks("face_region", F.when(F.col("frame_index") % 17 == 3, "face detection bundle unavailable"))})
    return X.face_rows(view(s, d, "v_face_media"), frames, p, tasks=tasks(s, d))


def palm(s, d):
    k = F.col("vec_id")
    ok = k % 7 != 0
    why = F.when(k % 13 == 0, "hand model bundle unavailable").when(k % 13 == 1, "hand detection error: ValueError: empty image")
    h = hands(s, d).withColumns({
        "volunteer_id": F.floor(k / 10).cast("string"), "data_type": F.lit("palm"), "filename": F.concat(F.lit("p_"), k.cast("string")), "path": F.concat(F.lit("p_"), k.cast("string")),
        "extension": F.lit(".jpg"), "readable": F.lit(True), "meta_reason": F.lit("ok"), "channel_count": F.lit(3), "is_color": F.lit(True), "width": F.lit(640), "height": F.lit(480), "ok": ok,
        "message": F.when(ok, "hand detected").when(k % 2 == 0, "No hands detected").otherwise("Multiple hands detected: 2"), "points": F.col("unit"),
        "box_width": (150 + k % 90).cast("int"), "box_height": (170 + k % 70).cast("int"), "luma": F.when(k % 17 != 0, (k * 7 % 256).cast("double")),
        "label": F.when(k % 4 == 0, "Left").when(k % 4 < 3, "Right"), "lacks": lacks("hand", why), "error": F.when(k % 29 == 2, F.lit("OSError: cannot\n  read")),
    })
    return X.palm_rows(h)


#: Key points that may be missing or outside, and objects, of each frame.
POINTS = ["left_eye", "right_hand", "left_foot"]
OBJECTS = range(3)


def walk(s, d, p=X.WalkPolicy()):
    i = F.col("frame_index")
    some = lambda k: F.filter(F.array(*map(F.lit, POINTS)), lambda x, n: (i + n * 3) % 11 == k)
    each = [F.when((i + k) % 3 != 0, F.struct(((i + 2 * k) % 5).cast("int").alias("cls_id"), F.concat(F.lit("c"), ((i + 2 * k) % 5).cast("string")).alias("cls_name"), ((i * 3 + k * 5) % 11 / 10).alias("conf"),
            ((i * 13 + k * 37) % 300).cast("double").alias("x"), ((i * 7 + k * 91) % 400).cast("double").alias("y"), F.lit(60.0).alias("w"), F.lit(80.0).alias("h"))) for k in OBJECTS]
    box = F.when(F.col("ok"), F.struct(*(F.col(f"box_{c}").alias(c) for c in "xywh")))
    frames = view(s, d, "v_walk_obs").withColumns({"missing": some(1), "outside": some(5), "objects": F.array_compact(F.array(*each)), "box": box, "lacks": lacks("objects", F.when(i % 19 == 4, "occlusion detector inactive"))})
    return X.walk_rows(view(s, d, "v_walk_media"), frames, p, tasks=tasks(s, d))


def all_rows(s, d):
    return X.together(face(s, d), walk(s, d), palm(s, d))


def rules() -> R.Aggregation:
    return C.aggregation(X.FACE_FILE, X.FACE_FRAME, X.PALM, X.WALK_FILE, X.WALK_FRAME)


def summary(s, d):
    """What fails in which file, over the three modalities."""
    return R.expand_to_check_rows(R.summarize_overall(R.summarize_by_check(all_rows(s, d), rules())))


FRAME = ["filename", "frame_index", "check_name", "status", "reason"]
PLAIN = ["volunteer_id", "data_type", "filename", "path", "level", "check_name", "status", "reason", "frame_index"]
SLOW_FACE, SLOW_WALK = X.FacePolicy(fail_fast=False), X.WalkPolicy(fail_fast=False, brightness=True, foot_ratio=None)
QUERIES = {
    "face_frame_rows": lambda s, d: face(s, d, X.FacePolicy(turns=None)).where("level = 'frame'").select(*FRAME),
    "face_file_rows": lambda s, d: face(s, d, X.FacePolicy(turns=None)).where("check_name in ('frame_checks', 'frames_sampled')").select("filename", "check_name", "status", "reason"),
    "walk_frame_rows": lambda s, d: walk(s, d, LIGHT).where("frame_index is not null").select(*FRAME),
    "palm_box_rows": lambda s, d: palm(s, d).where(F.col("check_name").isin(*PALM_CHECKS)).select("filename", "check_name", "status", "reason"), "palm_rows": palm,
    "face_rows": lambda s, d: face(s, d).select(*PLAIN), "face_rows_slow": lambda s, d: face(s, d, SLOW_FACE).select(*PLAIN),
    "walk_rows": lambda s, d: walk(s, d).select(*PLAIN), "walk_rows_slow": lambda s, d: walk(s, d, SLOW_WALK).select(*PLAIN),
    "x8_processing_errors": lambda s, d: all_rows(s, d).where("check_name = 'processing_error'").select(*PLAIN),
    "x3_degraded_rows": lambda s, d: all_rows(s, d).where("status = 'SKIP' and (reason like '%unavailable' or reason like '%inactive' or reason like 'hand detection error%')").select(*PLAIN),
    "modalities_summary": summary,
}


def verdict(ok: str, good: str, bad: str) -> str:
    return f"case when {ok} then ['PASS', {good}] else ['FAIL', {bad}] end"


def bright(value: str, missing: str = "no_face") -> str:
    b = f"round_even({value}, 0)::int"
    return f"""case when {value} is null then ['FAIL', '{missing}'] when {value} < 35 then ['FAIL', 'brightness=' || {b} || ' < 35; too_dark']
 when {value} > 220 then ['FAIL', 'brightness=' || {b} || ' > 220; too_bright'] else ['PASS', 'brightness=' || {b} || '; normal; 35 <= ' || {b} || ' <= 220'] end"""


def opened(checks: dict[str, str], source: str, key: str) -> str:
    """One row per verdict; a verdict is [status, reason], or null for none."""
    return " union all ".join(f"select {key}, '{n}' check_name, v[1] status, v[2] reason from (select *, {v} v from {source}) where v is not null" for n, v in checks.items())


def leveled(checks: dict[str, tuple[str, str]], source: str, frame: str) -> str:
    """The same with levels: name: (level, verdict)."""
    key = f"volunteer_id, data_type, filename, path, '{{}}' level, {frame}::int frame_index"
    return " union all ".join(opened({n: v}, source, key.format(level)) for n, (level, v) in checks.items())


def in_order(sql: str) -> str:
    return f" select {', '.join(PLAIN)} from ({sql})"


# Metadata: what the test media can show of the rules.


def metadata(m, unread: str | None) -> dict[str, str]:
    """unread: the verdict on all checks of a file that can't be read; None: each is graded."""
    rules = {
        "check_container": verdict(f"extension = '{m.extension}'", "'container ok (' || extension || ', ' || channel_count || ' channels)'", f"'extension=' || extension || ' != {m.extension}'"),
        "check_fps": verdict(f"fps >= {m.min_fps}", f"'fps=' || printf('%.2f', fps) || ' >= {m.min_fps}'", f"'fps=' || printf('%.2f', fps) || ' < {m.min_fps}'"),
        "check_duration": verdict(f"duration_sec >= {m.min_duration}", f"'duration=' || printf('%.1f', duration_sec) || ' >= {m.min_duration}'", f"'duration=' || printf('%.1f', duration_sec) || ' < {m.min_duration}'"),
        "check_resolution": verdict(f"width >= {m.min_width} and height >= {m.min_height}", f"'resolution=' || width || 'x' || height || ' >= {m.min_width}x{m.min_height}'", f"'resolution=' || width || 'x' || height || ' < {m.min_width}x{m.min_height}'"),
    }
    if unread:
        return {n: f"case when error is null then case when readable then {v} else {unread} end end" for n, v in rules.items()}
    rules["check_container"] = f"case when not readable then ['FAIL', 'unreadable: ' || meta_reason] else {rules['check_container']} end"
    return {n: f"case when error is null then {v} end" for n, v in rules.items()}


def files(media: str, m, fast: bool) -> str:
    """gated: media with the metadata check that stops a file (gate_name, gate_reason), if that is wanted."""
    gate = {n: f"case when readable and ({v})[1] = 'FAIL' then ({v})[2] end" for n, v in metadata(m, None).items()} if fast else {"none": "null::varchar"}
    names = "case " + " ".join(f"when ({v}) is not null then '{n}'" for n, v in gate.items()) + " end"
    return f"gated as (select *, {names} gate_name, coalesce({', '.join(gate.values())}) gate_reason from {media}), go as (select * from gated where error is null and readable and gate_name is null)"


ERROR_ROW = "case when error is not null then ['FAIL', left(trim(regexp_replace(error, '\\s+', ' ', 'g')), 300)] end"
GATED = "case when error is null and gate_name is not null then ['SKIP', 'fail-fast: ' || gate_name || ' FAILed (' || gate_reason || '); frame checks skipped'] end"

# Faces

LABEL = """case when abs(yaw) < 15 and abs(pitch) < 15 then 'front' when abs(yaw) >= 30 and abs(yaw) - 30 >= abs(pitch) - 20 then case when yaw < 0 then 'left' else 'right' end
 when abs(pitch) >= 20 then case when pitch < 0 then 'down' else 'up' end else 'mid' end"""
REQUIRED = ("left_eye", "right_eye", "nose", "mouth")


def skin(r: str) -> str:
    return f"coalesce(printf('%.2f', skin_{r}), 'NA')"


EVERY = " || ' ' || ".join(f"'{r}=' || {skin(r)}" for r in X.REGIONS) + " || '; min_skin_ratio=0.40'"
COVERED = "array_to_string(list_filter([" + ", ".join(f"case when not coalesce(skin_{r} >= 0.4::double, false) then '{r}(skin=' || {skin(r)} || ')' end" for r in REQUIRED) + "], lambda x: x is not null), ', ')"
BLINK = "'blinkL=' || printf('%.2f', blink_left) || ', blinkR=' || printf('%.2f', blink_right)"
SHARP = "'sharpness=' || printf('%.1f', sharpness) || ' threshold=50.0'"
QUALITY = {
    "check_face_size": verdict("face_width >= 180 and face_height >= 180", "'face=' || face_width || 'x' || face_height || ' >= 180x180'", "'face=' || face_width || 'x' || face_height || ' < 180x180'"),
    "check_occlusion": verdict(f"{COVERED} = ''", f"'no occlusion; ' || {EVERY}", f"'occluded: ' || {COVERED} || '; ' || {EVERY}"),
    "check_eyes_open": verdict("blink_left < 0.5::double and blink_right < 0.5::double", f"'eyes open (' || {BLINK} || ' < 0.5)'", f"'eye(s) closed (' || {BLINK} || ' >= 0.5)'"),
    "check_brightness": bright("luma"),
    "check_face_blur": f"""case when ({bright('luma')})[1] = 'FAIL' then ['SKIP', 'brightness failed; blur not judged: ' || ({bright('luma')})[2]]
 when sharpness is null then ['SKIP', 'blur not judged: invalid image'] else {verdict('sharpness >= 50', SHARP, SHARP)} end""",
}


def face_checks(turns: bool) -> dict[str, str]:
    none = """case when several or direction = '' then ['SKIP', message] when direction is not null then ['SKIP', message || '; expected gap (peak of ' || direction || ' turn)']
 else ['FAIL', message || '; unexpected gap (no adjacent turn evidence)'] end""" if turns else "['SKIP', message]"
    seen = {n: f"case when face_detected then case when lb = 'front' then {v} else ['SKIP', 'non-frontal (label=' || lb || '); not judged'] end end" for n, v in QUALITY.items()}
    seen["check_brightness"] = f"case when face_detected and frame_index % 17 = 3 then ['SKIP', 'face detection bundle unavailable'] else {seen['check_brightness']} end"
    head = verdict("head = 'Head is fully visible'", "head", "head")
    checks = {"check_face_detected": f"case when face_detected then ['PASS', 'face detected'] when starts_with(message, 'No faces') then {none} else ['FAIL', message] end", "check_head_fully": f"case when face_detected then {head} end", **seen}
    return {n: f"list_transform([{v}], lambda v: case when v is not null then [v[1], 'frame=' || frame_index || ' ' || v[2]] end)[1]" for n, v in checks.items()}


def face_base(fast: bool, turns: bool) -> str:
    """Up to fr (the frames that are judged, with what `face_checks` reads) and ff (files with the error that broke them off, their frames
    and whether several faces were seen)."""
    many = "(not face_detected and starts_with(message, 'Multiple faces'))"
    upto = "frame_index <= coalesce(first_many, frame_index)" if fast else "true"
    tail = "" if turns else ", gp as (select null::varchar path, null::int frame_index, ''::varchar direction where false)"
    return f"""with recursive {duck('v_face_media')}, {duck('v_face_obs')}, {files('v_face_media', X.M.FACE, fast)},
own as (select o.* exclude (volunteer_id, filename), g.volunteer_id, g.data_type, g.filename from v_face_obs o join go g using (path)),
cut as (select *, min(case when {many} then frame_index end) over (partition by path) first_many from own),
live as (select *, bool_or({many}) over (partition by path) several from cut where {upto}),
lost as (select path, arg_min(error, frame_index) frame_error from live where error is not null group by 1),
ff as (select f.* replace (coalesce(f.error, frame_error) as error), n, coalesce(several, false) several from gated f left join lost using (path) left join (select path, count(*) n, bool_or(several) several from live group by 1) using (path)),
v_timeline as (select path as filename, frame_index, face_detected, yaw, pitch from live)""" + (Q.GAPS + ", gp as (select filename as path, frame_index, direction from gaps)" if turns else tail) + f""",
fr as (select l.*, case when face_detected then {LABEL} end lb, {'direction' if turns else "''"} direction from live l left join gp using (path, frame_index) where path not in (select path from lost))"""


def face_file_checks(turns: bool) -> dict[str, tuple[str, str]]:
    stopped = f"case when error is null and not readable then ['SKIP', 'video unreadable; frame checks skipped'] else {GATED} end"
    sampled = "case when error is null and readable and gate_name is null then case when coalesce(n, 0) = 0 then ['FAIL', 'video opened but yielded 0 frames (corrupt/empty stream)'] else ['PASS', 'sampled ' || n || ' frames'] end end"
    named = metadata(X.M.FACE, None) | {"processing_error": ERROR_ROW, "frame_checks": stopped, "frames_sampled": sampled}
    return {n: ("video", v) for n, v in named.items()}


def face_sql(fast: bool) -> str:
    """All rows. The timeline of the turn verdicts counts frames from 0 and leaves out files of several faces."""
    frame_rows = leveled({n: ("frame", v) for n, v in face_checks(True).items()}, "fr", "frame_index")
    file_rows = leveled(face_file_checks(True), "ff", "null")
    placed = "(select path as filename, (row_number() over (partition by path order by frame_index) - 1)::int frame_index, face_detected, yaw, pitch from live where path in (select path from ff where error is null and not several))"
    turns = Q.exact_verdicts(Q.BRIDGED.replace("from v_timeline)", f"from {placed})", 1))
    # the turn verdicts have the names of the gap steps before them, so they are a query of their own beside these
    turn_rows = f"select f.volunteer_id, f.data_type, f.filename, f.path, 'sequence' level, null::int frame_index, check_name, status, reason from ({face_base(fast, False)}{turns} select filename as path, check_name, status, reason from vd) t join v_face_media f using (path)"
    return f"{face_base(fast, True)}{in_order(f'{frame_rows} union all {file_rows} union all {turn_rows}')}"


# Walks

NAMED = {k: "array_to_string(list_filter([" + ", ".join(f"case when (frame_index + {3 * n}) % 11 = {k} then '{x}' end" for n, x in enumerate(POINTS)) + "], lambda x: x is not null), ', ')" for k in (1, 5)}
OBJECT = "case when (frame_index + {k}) % 3 <> 0 then struct_pack(cls := (frame_index + 2 * {k}) % 5, conf := ((frame_index * 3 + {k} * 5) % 11) / 10.0::double, x := ((frame_index * 13 + {k} * 37) % 300)::double, y := ((frame_index * 7 + {k} * 91) % 400)::double, n := {k}) end"
FOREIGN = "list_filter(objects, lambda o: o.conf >= 0.6::double and o.cls <> 0)"
BOX_TEXT = "'(' || box_x::int || ', ' || box_y::int || ', ' || box_w::int || ', ' || box_h::int || ')'"


def named_objects(objects: str) -> str:
    """Classes with their best confidence, the most confident first and the first seen of equal ones; five of them."""
    best = f"list_sort(list_transform(list_distinct(list_transform({objects}, lambda o: o.cls)), lambda c: struct_pack(a := -list_max(list_transform(list_filter({objects}, lambda o: o.cls = c), lambda o: o.conf)), b := list_min(list_transform(list_filter({objects}, lambda o: o.cls = c), lambda o: o.n)), c := c)))"
    return f"array_to_string(list_transform({best}, lambda r: 'c' || r.c || ' (' || printf('%.2f', -r.a) || ')'), ', ')"


def walk_occlusion(foot: bool) -> str:
    low = f"list_filter({FOREIGN}, lambda o: o.y + 80 between line - 0.1::double * person.h and line + 0.1::double * person.h)"
    over = f"list_filter({FOREIGN}, lambda o: least(o.x + 60, person.x + person.w) > greatest(o.x, person.x) and least(o.y + 80, person.y + person.h) > greatest(o.y, person.y))"
    in_way = lambda found, clear, bad: f"case when len({found}) = 0 then ['PASS', len({FOREIGN}) || ' object(s) present but none {clear}'] else ['FAIL', '{bad}: ' || {named_objects(found)}] end"
    side = f"when \"view\" = 'S' then {in_way(low, 'at foot level', 'foot-level objects')} " if foot else ""
    return f"""case when frame_index % 19 = 4 then ['SKIP', 'occlusion detector inactive'] when len(objects) = 0 then ['PASS', 'no objects detected']
 when len({FOREIGN}) = 0 then ['PASS', 'only person present'] when person is null then ['FAIL', 'foreign objects (no person box to clear): ' || {named_objects(FOREIGN)}]
 {side} else {in_way(over, 'overlaps person', 'obstructing objects')} end"""


def walk_checks(foot: bool, brightness: bool) -> dict[str, tuple[str, str]]:
    gone = "not ok then ['FAIL', message]"
    body = "'body_height=' || printf('%.2f', height)"
    measured = f"'sharpness=' || printf('%.1f', sharpness) || ' threshold=35.0; luma=' || printf('%.1f', blur_luma) || '; contrast=' || printf('%.1f', contrast) || '; method=tenengrad_clahe; bbox=' || {BOX_TEXT}"
    unclear = "'person not fully visible (' || array_to_string(list_filter([case when missing <> '' then 'missing: ' || missing end, case when outside <> '' then 'out of frame: ' || outside end], lambda x: x is not null), '; ') || ')'"
    b = "round_even(luma, 0)::int"
    checks = {
        "check_body_height": ("video", f"case when is_first then case when not ok then ['FAIL', 'no pose: ' || message] else {verdict('height >= 0.5::double', body + f' || {chr(39)} >= 0.50{chr(39)}', body + f' || {chr(39)} < 0.50{chr(39)}')} end end"),
        "check_person_detected": ("frame", f"case when {gone} else ['PASS', 'person detected'] end"),
        "check_single_person": ("video", "case when frame_index = first_many then ['FAIL', 'multiple persons in frame: ' || message || '; gait films one walker -> video FAIL'] end"),
        "check_person_fully": ("frame", f"case when {gone} when missing = '' and outside = '' then ['PASS', 'person fully visible (all 8 key landmarks in frame)'] else ['FAIL', {unclear}] end"),
        "check_person_blur": ("frame", f"""case when {gone} when sharpness is null then ['SKIP', 'blur not judged: invalid image'] when blur_luma < 35 then ['SKIP', 'blur not judged: face too dark; luma=' || printf('%.1f', blur_luma) || ' < 35.0']
 when contrast < 4 then ['SKIP', 'blur not judged: too little local contrast; contrast=' || printf('%.1f', contrast) || ' < 4.0'] else {verdict('sharpness >= 35', measured, measured)} end"""),
        "check_occlusion": ("frame", walk_occlusion(foot)),
    }
    checks = {n: (level, f"list_transform([{v}], lambda v: case when v is not null then [v[1], 'frame=' || frame_index || ' ' || v[2]] end)[1]") for n, (level, v) in checks.items()}
    if brightness:  # its reasons don't tell the frame
        checks["check_brightness"] = ("frame", f"""case when not ok then ['FAIL', 'no pose: ' || message] when {b} < 35 then ['PASS', 'brightness=' || {b} || ' < 35; walk_pass (dark)']
 when {b} > 220 then ['PASS', 'brightness=' || {b} || ' > 220; walk_pass (bright)'] else ['FAIL', 'brightness=' || {b} || '; walk_fail; 35 <= ' || {b} || ' <= 220 (normal-lit)'] end""")
    return checks


def walk_base(fast: bool) -> str:
    """Up to fr (the frames that are judged) and ff (files with how many these are, and the error of their first frame)."""
    upto = "frame_index <= coalesce(first_many, frame_index)" if fast else "true"
    objects = ", ".join(OBJECT.format(k=k) for k in OBJECTS)
    return f"""with recursive {duck('v_walk_media')}, {duck('v_walk_obs')}, {files('v_walk_media', X.M.WALK, fast)},
own as (select o.* exclude (filename), g.volunteer_id, g.data_type, g.filename from v_walk_obs o join go g using (path)),
cut as (select *, min(case when starts_with(message, 'Multiple persons') then frame_index end) over w first_many, min(case when error is not null then frame_index end) over w first_error, frame_index = min(frame_index) over w is_first,
 list_filter([{objects}], lambda o: o is not null) objects, {NAMED[1]} missing, {NAMED[5]} outside from own window w as (partition by path)),
live as (select * from cut where {upto}), kept as (select * from live where frame_index < coalesce(first_error, frame_index + 1)),
people as (select *, list_sort(list_transform(list_filter(objects, lambda o: o.cls = 0), lambda o: struct_pack(a := -o.conf, b := o.n, x := o.x, y := o.y)))[1] other from kept),
fr as (select *, coalesce(foot_y, person.y + person.h) line from (select *, case when ok then struct_pack(x := box_x, y := box_y, w := box_w, h := box_h)
  when other is not null then struct_pack(x := other.x, y := other.y, w := 60::double, h := 80::double) end person from people)),
ff as (select gated.*, coalesce(n, 0) n, coalesce(several, false) several, first_frame_error from gated left join (select path, count(*) n from kept group by 1) using (path)
  left join (select path, bool_or(starts_with(message, 'Multiple persons')) several, max(case when is_first then error end) first_frame_error from live group by 1) using (path))"""


def walk_sql(fast: bool, foot: bool, brightness: bool) -> str:
    unread = "['SKIP', 'video not readable: ' || meta_reason]"
    height = f"""case when error is null then case when not readable then {unread} when gate_name is not null then ['SKIP', 'fail-fast: ' || gate_name || ' FAILed; height not measured']
 when first_frame_error is not null then ['SKIP', 'could not read first frame: ' || first_frame_error] when n = 0 then ['SKIP', 'no frames decoded'] end end"""
    sampled = "case when error is null and readable and gate_name is null and n > 0 then ['PASS', 'sampled ' || n || ' frames'] end"
    named = metadata(X.M.WALK, unread) | {"processing_error": ERROR_ROW, "frame_checks": GATED, "check_body_height": height, "frames_sampled": sampled}
    file_rows = leveled({n: ("video", v) for n, v in named.items()}, "ff", "null")
    frame_rows = leveled(walk_checks(foot, brightness), "fr", "frame_index")
    whole = "select k.path as filename, \"view\", frame_index, body_scale, centroid_x from kept k" + (" join ff using (path) where not several" if fast else "")
    ways = f", v_walk as ({whole})" + Q.walking(Q.VALUE) + Q.WAYS
    way_rows = f"select f.volunteer_id, f.data_type, f.filename, f.path, 'sequence' level, null::int frame_index, 'check_walk_direction' check_name, t.status, t.reason from ({walk_base(fast)}{ways}) t join v_walk_media f on t.filename = f.path"
    return f"{walk_base(fast)}{in_order(f'{file_rows} union all {frame_rows} union all {way_rows}')}"


WALK_FRAMES = leveled(walk_checks(True, True), "fr", "frame_index")

# Palms

HAND = f"""with recursive {duck('v_hand')}, pm as (select 'p_' || vec_id filename, vec_id, vec_id % 7 <> 0 ok, case when vec_id % 7 <> 0 then 'hand detected' when vec_id % 2 = 0 then 'No hands detected' else 'Multiple hands detected: 2' end message,
 (150 + vec_id % 90)::int w, (170 + vec_id % 70)::int h, case when vec_id % 17 <> 0 then (vec_id * 7 % 256)::double end luma, score, pose, case hand when 'L' then 'Left' when 'R' then 'Right' end known, hand, case when vec_id % 4 = 0 then 'Left' when vec_id % 4 < 3 then 'Right' end seen,
 case vec_id % 13 when 0 then 'hand model bundle unavailable' when 1 then 'hand detection error: ValueError: empty image' end lacking from v_hand where vec_id % 29 <> 2)"""
NO_BOX = "['SKIP', 'no single hand bbox (see check_palm_present)']"
SCORE = "coalesce(printf('%.2f', score), 'NA')"
PALM_CHECKS = {
    "check_palm_present": "case when ok then ['PASS', message] else ['FAIL', message] end",
    "check_palm_handedness": f"""case when pose <> 'N' then ['SKIP', 'pose=' || pose || ' not graded (handedness checked on N only; label unreliable on tilted poses)'] when not ok then ['SKIP', 'no single hand (see check_palm_present)']
  when known is null then ['SKIP', 'handedness not graded: unknown filename hand ''None'' (label=' || coalesce(seen, 'None') || ', score=' || {SCORE} || ')'] when seen is null then ['SKIP', 'handedness not graded: no label (filename=' || known || ', label=None, score=' || {SCORE} || ')']
  when seen = known then ['PASS', 'handedness ok: filename=' || known || ' matches label=' || seen || ' (score=' || {SCORE} || ', relation=same)']
  when score < 0.7::double then ['SKIP', 'handedness mismatch but low-confidence (skipped): filename=' || known || ' expects ' || known || ', got ' || seen || ' score=' || {SCORE} || ' < 0.7 (relation=same)']
  else ['FAIL', 'handedness MISMATCH: filename=' || known || ' expects ' || known || ' but got ' || seen || ' (score=' || {SCORE} || ' >= 0.7, relation=same) -- likely wrong hand submitted'] end""",
    "check_palm_size": f"case when not ok then {NO_BOX} else {verdict('w >= 200 and h >= 200', chr(39) + 'palm=' + chr(39) + ' || w || ' + chr(39) + 'x' + chr(39) + ' || h || ' + chr(39) + ' >= 200x200' + chr(39), chr(39) + 'palm=' + chr(39) + ' || w || ' + chr(39) + 'x' + chr(39) + ' || h || ' + chr(39) + ' < 200x200' + chr(39))} end",
    "check_palm_brightness": f"case when not ok then {NO_BOX} else {bright('luma', 'no_hand')} end",
}
PALM_SEEN = {n: f"case when lacking is not null then ['SKIP', lacking] else {v} end" for n, v in PALM_CHECKS.items()}
#: All checks on the hand, of which those above have their reasons compared.
HAND_CHECKS = [*PALM_CHECKS, "check_palm_spread", "check_palm_fully", "check_palm_angle"]


def errors_sql() -> str:
    """processing_error of all three: two queries' rows and the palms'."""
    palms = "select floor(vec_id / 10)::bigint::varchar volunteer_id, 'palm' data_type, 'p_' || vec_id filename, 'p_' || vec_id path, 'image' level, null::int frame_index, 'processing_error' check_name, 'FAIL' status, 'OSError: cannot read' reason from v_hand where vec_id % 29 = 2"
    parts = [f"select * from ({face_base(True, False)}{in_order(leveled({'processing_error': ('video', ERROR_ROW)}, 'ff', 'null'))})", f"select * from ({walk_base(True)}{in_order(leveled({'processing_error': ('video', ERROR_ROW)}, 'ff', 'null'))})", f"select * from (with {duck('v_hand')} {in_order(palms)})"]
    return " union all ".join(parts)


def degraded_sql() -> str:
    """Rows that a missing or failing detector leaves."""
    where = " where status = 'SKIP' and (reason like '%unavailable' or reason like '%inactive')"
    faces = f"select * from ({face_base(True, True)}{in_order(leveled({'check_brightness': ('frame', face_checks(True)['check_brightness'])}, 'fr', 'frame_index'))}){where}"
    walks = f"select * from ({walk_base(True)}{in_order(leveled({'check_occlusion': walk_checks(True, False)['check_occlusion']}, 'fr', 'frame_index'))}){where}"
    angle = "(hand is not null and pose is not null)"
    hand = " union all ".join(f"select floor(vec_id / 10)::bigint::varchar volunteer_id, 'palm' data_type, filename, filename path, 'image' level, null::int frame_index, '{n}' check_name, 'SKIP' status, lacking reason from pm where lacking is not null" + (f" and {angle}" if n == "check_palm_angle" else "") for n in HAND_CHECKS)
    return f"{faces} union all {walks} union all select * from ({HAND} {in_order(hand)})"


ORACLE_SQL = {
    "palm_box_rows": f"{HAND} {opened(PALM_SEEN, 'pm', 'filename')}",
    "face_frame_rows": f"{face_base(True, False)} {opened(face_checks(False), 'fr', 'filename, frame_index')}",
    "face_file_rows": f"{face_base(True, False)} {opened({n: v for n, (_, v) in face_file_checks(False).items() if n in ('frame_checks', 'frames_sampled')}, 'ff', 'filename')}",
    "walk_frame_rows": f"{walk_base(True)} select filename, frame_index, check_name, status, reason from ({WALK_FRAMES})",
    "face_rows": face_sql(True), "face_rows_slow": face_sql(False), "walk_rows": walk_sql(True, True, False), "walk_rows_slow": walk_sql(False, False, True),
    "x8_processing_errors": errors_sql(), "x3_degraded_rows": degraded_sql(),
}

"""Registered queries of sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriframe.operators import sequence as S
from veriframe.plans.adapters import view, with_views

P = S.Protocol()
LOOSE = S.Protocol(exact=False, order_policy="REVIEW", short_policy="REVIEW", gap_policy="REVIEW", orders={"pair": ("front", "left", "front"), "turns": ("left", "front", "right")})


def timeline(s, d):
    return view(s, d, "v_timeline")


def walk(s, d):
    return view(s, d, "v_walk")


def signal(s, d):
    return walk(s, d).select("filename", "frame_index", F.coalesce("body_scale", F.lit(None)).alias("value")).where("value is not null")


def detections(s, d):
    return timeline(s, d).select("filename", "frame_index", F.when(F.col("face_detected"), "PASS").otherwise("SKIP").alias("status"), F.when(F.col("face_detected"), "ok").otherwise("No faces").alias("reason"))


def segs(s, d):
    return S.segments(timeline(s, d), P, bridging=False)


def matches(p):
    return lambda s, d: S.order_match(S.spine(segs(s, d)), p).select("filename", "labels", "order", "start")


def verdicts(p, checks):
    return lambda s, d: S.turn_verdicts(timeline(s, d), p, bridging=False).where(F.col("check_name").rlike(checks))


def w20(s, d):
    return timeline(s, d).unpivot(["filename", "frame_index"], ["yaw", "pitch", "brightness"], "measure", "value")


def w17(s, d):
    return S.has_sustained_run(S.polarity(S.smoothed(signal(s, d))), 1)


def w16(s, d):
    found = S.phases(S.polarity(S.smoothed(signal(s, d)))).groupBy("filename").agg(F.count("*").alias("n"), F.min_by("label", "first").alias("f"))
    return found.select("filename", "n", S.accepts(F.col("f"), F.col("n"), F.lit("-1")).alias("accepted"))


QUERIES = {
    "c4_classify_frame": lambda s, d: S.labelled(timeline(s, d), P).select("filename", "frame_index", "label"), "w1_absorb_gaps": lambda s, d: S.absorbed(S.runs_of(S.labelled(timeline(s, d), P))), "w2_bridge_flickers": lambda s, d: S.bridged(S.runs_of(S.labelled(timeline(s, d), P)), P.flicker),
    "w3_segments": segs, "w3_segments_bridged": lambda s, d: S.segments(timeline(s, d), P), "w4_gap_split": lambda s, d: S.gap_frames(timeline(s, d), P), "w4_j6_restatus": lambda s, d: S.restatus_detections(detections(s, d), S.gap_frames(timeline(s, d), P), P),
    "w5_spine": lambda s, d: S.spine(segs(s, d)), "w6_order_match_exact": matches(P), "w6_order_match_contiguous": matches(LOOSE), "w7_front_rows": verdicts(LOOSE, "front"), "w8_direction_rows": verdicts(LOOSE, "left|right|down|up"),
    "w9_w10_sequence_row": verdicts(LOOSE, "sequence"), "w9_turn_verdicts": lambda s, d: S.turn_verdicts(timeline(s, d), P), "w11_presence": lambda s, d: S.presence_verdicts(timeline(s, d), S.Protocol(order_policy="REVIEW")),
    "w12_walk_direction": lambda s, d: S.walk_direction(walk(s, d)), "w13_moving_average": lambda s, d: S.smoothed(signal(s, d)), "w14_polarity": lambda s, d: S.polarity(S.smoothed(signal(s, d))), "w15_phases": lambda s, d: S.phases(S.polarity(S.smoothed(signal(s, d)))),
    "w16_phase_automaton": w16, "w17_sustained_run": w17, "w18_isolated_points": lambda s, d: S.isolated_points(walk(s, d), "body_scale").select("filename", "frame_index", "body_scale"), "w20_unpivot": w20,
}

T = "('left', 'right', 'down', 'up')"
LABEL = ", lab as (select *, case when not face_detected or yaw is null or pitch is null then 'gap' when abs(yaw) < 15 and abs(pitch) < 15 then 'front' when abs(yaw) >= 30 and (abs(pitch) < 20 or abs(yaw) - 30 >= abs(pitch) - 20) then case when yaw < 0 then 'left' else 'right' end when abs(pitch) >= 20 then case when pitch < 0 then 'down' else 'up' end else 'mid' end as label from v_timeline)"


def islands(name: str, source: str, start: str = "first", end: str = "last", size: str = "n") -> str:
    return f", {name} as (select filename, min({start}) as first, max({end}) as last, sum({size})::bigint n, any_value(label) as label from (select *, sum(f) over (partition by filename order by {start}) r from (select *, coalesce((label <> lag(label) over (partition by filename order by {start}))::int, 1) f from ({source}))) group by filename, r)"


RUNS = LABEL + islands("runs", "select filename, label, frame_index as first, frame_index as last, 1 n from lab")
ABSORBED = RUNS + f", nb as (select *, lag(label) over w a, lead(label) over w b from runs window w as (partition by filename order by first)), nt as (select *, case when a in {T} then a end ta, case when b in {T} then b end tb from nb), ab as (select filename, first, last, n, label own, case when label = 'gap' then coalesce(case when ta is null then tb when tb is null or ta = tb then ta end, 'gap') else label end as label from nt)"
SEGS = ABSORBED + islands("segs", "select filename, label, first, last, n from ab")
SPINE = SEGS + islands("spine", f"select * from segs where label in ('front', 'left', 'right', 'down', 'up')") + ", files as (select filename, list(struct_pack(first := first, last := last, n := n, label := label) order by first) items, list(label order by first) labels from spine group by 1)"
GAPS = ABSORBED + ", gaps as (select filename, unnest(range(first, last + 1))::int frame_index, direction from (select filename, first, last, case when label <> 'gap' then label end direction from ab where own = 'gap'))"


def folded(name: str, source: str, most: int = 1) -> str:
    """name: the runs of source (filename, first, last, n, label), bridged and joined. Each step of the recursion goes once over a file's runs
    from left to right: a run takes its left neighbour's label, if that is its right neighbour's, too, and joins runs of its label."""
    stable = "('front', 'left', 'right', 'down', 'up')"
    ahead = "list_transform(rs, lambda x, i: [struct_pack(f := x.f, l := x.l, n := x.n, label := x.label, ahead := rs[i + 1].label)])"
    flicker = f"y[1].n <= {most} and acc[-1].label = y[1].ahead and acc[-1].label <> y[1].label and acc[-1].label in {stable}"
    to = f"case when {flicker} then acc[-1].label else y[1].label end"
    joined = "list_concat(acc[:-2], [struct_pack(f := acc[-1].f, l := y[1].l, n := acc[-1].n + y[1].n, label := acc[-1].label, ahead := y[1].ahead)])"
    added = f"list_concat(acc, [struct_pack(f := y[1].f, l := y[1].l, n := y[1].n, label := {to}, ahead := y[1].ahead)])"
    once = f"list_reduce({ahead}, lambda acc, y: case when acc[-1].label = {to} then {joined} else {added} end)"
    bare = "list_transform({}, lambda x: struct_pack(f := x.f, l := x.l, n := x.n, label := x.label))"
    return f""", {name}_steps as (
  select filename, list(struct_pack(f := first, l := last, n := n, label := label) order by first) rs, 0 step, true again from ({source}) group by filename
  union all
  select filename, {bare.format("new")}, step + 1, len(new) < len(rs) from (select *, {once} new from {name}_steps where again)),
{name} as (select filename, r.f as first, r.l as last, r.n::bigint as n, r.label as label from (select filename, unnest(rs) r from {name}_steps where not again))"""


def match(p) -> str:
    out = []
    for k, (name, order) in enumerate(p.orders.items()):
        want = S.collapsed(order)
        lit = "[" + ", ".join(f"'{x}'" for x in want) + "]"
        place = f"case when labels = {lit} then 0 end" if p.exact else f"list_filter(range(0, greatest(len(labels) - {len(want)} + 1, 0)), lambda i: labels[i + 1:i + {len(want)}] = {lit})[1]"
        out.append((name, place, len(want), want.count("front")))
    names = "case " + " ".join(f"when ({p_}) is not null then '{n}'" for n, p_, *_ in out) + " end"
    sizes = "case " + " ".join(f"when ({p_}) is not null then {z}" for _, p_, z, _ in out) + " end"
    counts = "case " + " ".join(f"when ({p_}) is not null then {c}" for _, p_, _, c in out) + f" else {max(c for *_, c in out)} end"
    return f", mt as (select filename, items, labels, {names} as ord, coalesce({', '.join(p_ for _, p_, *_ in out)}) as start, {sizes} as size, {counts} as expected from files)"


JOINED = islands("segs_plain", "select filename, label, first, last, n from ab")
BRIDGED = ABSORBED + JOINED + folded("segs", "select filename, first, last, n, label from segs_plain")
#: The runs as they are, with the label of the bridged run that each is in.
BRIDGED_RUNS = RUNS + folded("whole", "select filename, first, last, n, label from runs") + ", br as (select r.filename, r.first, r.last, r.n, w.label as label from runs r join whole w on r.filename = w.filename and r.first between w.first and w.last)"
#: Reasons count sampled frames, so frames are numbered by their place.
PLACED = SPINE.replace("from v_timeline)", "from (select * replace ((row_number() over (partition by filename order by frame_index) - 1)::int as frame_index) from v_timeline))", 1)
#: At one frame a second, held frames are held seconds.
HELD = "printf('%.1fs', x.n::double)"
ROLE = "case when i = 1 then 'initial' else 'return#' || (i - 1) end"
NEED = "case when i = 1 then '5.0s' else '2.0s' end"
SHORT = f"case when x.n < case when i = 1 then 5 else 2 end then {ROLE} || ' front too short at segment ' || x.first || ':' || x.last || ': ' || {HELD} || ' < ' || {NEED} end"
FAULTS = f"list_filter(list_concat([case when len(fr) < expected then 'expected ' || expected || ' front holds, found ' || len(fr) end], list_transform(fr, lambda x, i: {SHORT})), lambda x: x is not null)"
HOLDS = f"array_to_string(list_transform(fr, lambda x, i: {ROLE} || '=' || {HELD} || ' >= ' || {NEED}), '; ')"
SCOPE = "case when ord is not null then 'matched ''' || ord || ''' window' else 'observed sequence' end"
OBSERVED = "case when len(coalesce(labels, [])) = 0 then 'none' else array_to_string(labels, ' -> ') end"
FOUND = "'accepted sequence found: ''' || ord || ''' using contiguous_subsequence at observed window ' || start || ':' || (start + size) || '; matched: ' || case ord when 'pair' then 'front -> left -> front' else 'left -> front -> right' end"
OPEN = "len(list_filter(gaps, lambda g: g.last >= items[start + 1].first and g.first <= items[start + size].last)) > 0"


def turn(d: str) -> str:
    held = f"printf('%.1fs', {d[0]}::double)"
    seen = f"when {d[0]} >= 2 then ['PASS', '{d} detected; hold=' || {held} || ' >= 2.0s'] else ['REVIEW', '{d} detected but hold too short: ' || {held} || ' < 2.0s']"
    return f"{{'check_name': 'check_turn_{d}', 'v': case when not any_front then ['FAIL', '{d} turn cannot be validated; no front-facing frame found'] when {d[0]} is null then ['FAIL', '{d} turn not detected'] {seen} end}}"


def spine_of(segs: str) -> str:
    return segs + islands("spine", "select * from segs where label in ('front', 'left', 'right', 'down', 'up')") + ", files as (select filename, list(struct_pack(first := first, last := last, n := n, label := label) order by first) items, list(label order by first) labels from spine group by 1)"


def exact_verdicts(placed: str) -> str:
    """vd: the verdicts by the default protocol, which takes whole sequences and fails what doesn't fit. placed: up to `segs` and `lab`."""
    need, role = "case when i = 1 then '5.0s' else '2.0s' end", "case when i = 1 then 'initial' else 'return#' || (i - 1) end"
    spec, other = "front -> left -> front -> right -> front -> down -> front -> up -> front", "front -> left -> front -> right -> front -> up -> front -> down -> front"
    orders = {"spec": spec, "audio_prompt": other}
    name = "case array_to_string(labels, ' -> ') " + " ".join(f"when '{o}' then '{k}'" for k, o in orders.items()) + " end"
    accepted = "; ".join(f"{k}: {o}" for k, o in orders.items())
    scope = "case when ord is null then 'observed sequence' else 'matched ''' || ord || ''' window' end"
    turns = ",\n ".join(
        f"{{'check_name': 'check_turn_{d}', 'v': case when not any_front then ['FAIL', '{d} turn cannot be validated; no front-facing frame found'] when n_{d} is null then ['FAIL', '{d} turn not detected'] "
        f"when n_{d} >= 2 then ['PASS', '{d} detected; hold=' || printf('%.1fs', n_{d}::double) || ' >= 2.0s'] else ['FAIL', '{d} detected but hold too short: ' || printf('%.1fs', n_{d}::double) || ' < 2.0s'] end}}" for d in S.TURNS)
    return spine_of(placed) + f""",
ex_facts as (select filename, {", ".join(f"max(n) filter (label = '{d}') n_{d}" for d in S.TURNS)}, count(*) filter (label = 'gap') n_gaps from segs group by 1),
ex_front as (select filename, bool_or(label = 'front') any_front from lab group by 1),
ex as (select *, {name} ord, list_filter(coalesce(items, []), lambda x: x.label = 'front') fr from ex_front left join ex_facts using (filename) left join files using (filename)),
ex_faults as (select *, list_concat(
  case when len(fr) < 5 then ['expected 5 front holds, found ' || len(fr)] else [] end,
  list_filter(list_transform(fr, lambda x, i: case when x.n < case when i = 1 then 5 else 2 end
    then {role} || ' front too short at segment ' || x.first || ':' || x.last || ': ' || printf('%.1fs', x.n::double) || ' < ' || {need} end), lambda x: x is not null)) faults from ex),
ex_each as (select filename, unnest([
 {{'check_name': 'check_turn_front', 'v': case when not any_front then ['FAIL', 'front hold cannot be validated; no front-facing frame found']
  when len(fr) = 0 then ['FAIL', 'front turn-hold check failed; no front hold segment found']
  when len(faults) > 0 then ['FAIL', 'front hold check failed in ' || {scope} || ': ' || array_to_string(faults, '; ')]
  else ['PASS', 'front holds ok in ' || {scope} || ': ' || array_to_string(list_transform(fr, lambda x, i: {role} || '=' || printf('%.1fs', x.n::double) || ' >= ' || {need}), '; ')] end}},
 {turns},
 {{'check_name': 'check_turn_sequence', 'v': case when not any_front then ['FAIL', 'no front-facing frame anywhere; cannot validate turn sequence']
  when ord is null then ['FAIL', 'sequence order mismatch in exact mode; observed: ' || case when len(coalesce(labels, [])) = 0 then 'none' else array_to_string(labels, ' -> ') end || '; accepted: {accepted}; no extra prefix/suffix labels allowed']
  else [case when n_gaps > 0 then 'FAIL' else 'PASS' end, 'accepted sequence found: ''' || ord || ''' using exact at observed window 0:' || len(labels) || '; matched: ' || array_to_string(labels, ' -> ')
    || case when n_gaps > 0 then '; but whole observed sequence contains an unconfirmed gap' else '; observed: ' || array_to_string(labels, ' -> ') end] end}}], recursive := true) from ex_faults),
vd as (select filename, check_name, v[1] status, v[2] reason from ex_each)"""


FRAMES_PLACED = "from (select * replace ((row_number() over (partition by filename order by frame_index) - 1)::int as frame_index) from v_timeline))"
VERDICTS = PLACED + match(LOOSE) + f""", facts as (select filename, max(n) filter (label = 'left') l, max(n) filter (label = 'right') r, max(n) filter (label = 'down') d, max(n) filter (label = 'up') u, list(struct_pack(first := first, last := last)) filter (label = 'gap') gaps from segs group by 1),
af as (select filename, bool_or(label = 'front') any_front from lab group by 1),
al as (select a.filename, any_front, l, r, d, u, coalesce(gaps, []) gaps, ord, expected, items, labels, start, size, list_filter(case when ord is not null then items[start + 1:start + size] else coalesce(items, []) end, lambda x: x.label = 'front') fr from af a left join facts using (filename) left join mt using (filename)),
fl as (select *, {FAULTS} faults from al),
each as (select filename, unnest([
 {{'check_name': 'check_turn_front', 'v': case when not any_front then ['FAIL', 'front hold cannot be validated; no front-facing frame found'] when len(fr) = 0 then ['FAIL', 'front turn-hold check failed; no front hold segment found']
  when len(faults) > 0 then ['REVIEW', 'front hold check failed in ' || {SCOPE} || ': ' || array_to_string(faults, '; ')] else ['PASS', 'front holds ok in ' || {SCOPE} || ': ' || {HOLDS}] end}},
 {", ".join(map(turn, S.TURNS))},
 {{'check_name': 'check_turn_sequence', 'v': case when not any_front then ['FAIL', 'no front-facing frame anywhere; cannot validate turn sequence']
  when ord is null then ['REVIEW', 'sequence order mismatch in contiguous_subsequence mode; observed: ' || {OBSERVED} || '; accepted: pair: front -> left -> front; turns: left -> front -> right; accepted sequence not found as one contiguous window']
  when {OPEN} then ['REVIEW', {FOUND} || '; but matched window ' || start || ':' || (start + size) || ' contains an unconfirmed gap'] else ['PASS', {FOUND} || '; observed: ' || {OBSERVED}] end}}], recursive := true) from fl),
vd as (select filename, check_name, v[1] status, v[2] reason from each)"""
PRESENCE = LABEL + """, fm as (select *, row_number() over w pl, bool_or(label = 'front') over (partition by filename order by frame_index rows between unbounded preceding and 1 preceding) bf, bool_or(label = 'front') over (partition by filename order by frame_index rows between 1 following and unbounded following) af from lab window w as (partition by filename order by frame_index)),
pf as (select filename, bool_or(label = 'front') any_front, bool_or(label = 'front' and pl <= 5) opening, bool_or(label = 'gap' and coalesce(bf, false) and coalesce(af, false)) hidden, """ + ", ".join(f"count(*) filter (label = '{d}') n_{d}, min(timestamp_sec) filter (label = '{d}') t_{d}" for d in S.TURNS) + """ from fm group by 1),
ps as (select *, """ + ", ".join(f"case when n_{d} >= 2 then 'PASS' when n_{d} > 0 or hidden then 'REVIEW' else 'FAIL' end s_{d}" for d in S.TURNS) + """ from pf),
pd as (select filename, unnest([""" + ", ".join(f"{{'d': '{d}', 'st': s_{d}, 't': t_{d}, 'k': {k}}}" for k, d in enumerate(S.TURNS)) + """], recursive := true) from ps), po as (select filename, coalesce(list(d order by t, k) filter (st = 'PASS'), []) seen from pd group by 1),
pr as (select ps.*, seen, """ + " or ".join("(list_transform(seen, lambda x: list_position([" + ", ".join(f"'{x}'" for x in o if x in S.TURNS) + "], x)) = list_sort(list_transform(seen, lambda x: list_position([" + ", ".join(f"'{x}'" for x in o if x in S.TURNS) + "], x))))" for o in P.orders.values()) + """ fits from ps join po using (filename)),
pw as (select *, [s_left, s_right, s_down, s_up, case when fits then 'PASS' when len(seen) = 0 then 'FAIL' else 'REVIEW' end] al from pr),
px as (select filename, unnest(case when not any_front then [{'check_name': 'check_turn_sequence', 'status': 'FAIL', 'reason': 'no front-facing frame anywhere; cannot validate turns'}] else [
 {'check_name': 'check_turn_sequence_front_hold', 'status': case when not opening then 'REVIEW' end, 'reason': 'no clear front hold at the start of the video'},
 """ + ", ".join(f"{{'check_name': 'check_turn_sequence_{d}', 'status': s_{d}, 'reason': case when n_{d} >= 2 then '{d}: ' || n_{d} || ' detected frames >= 2' when n_{d} = 0 and hidden then '{d}: only a bracketed gap present; cannot confirm without head-pose model (Phase 2)' when n_{d} > 0 then '{d}: ' || n_{d} || ' detected frames < 2 (hold too short?)' else '{d}: not detected (no frames, no bracketed gap)' end}}" for d in S.TURNS) + """,
 {'check_name': 'check_turn_sequence_order', 'status': case when len(seen) = 0 then 'FAIL' when fits then 'PASS' else 'REVIEW' end,
  'reason': case when len(seen) = 0 then 'no turns to order' when fits then 'turn order ok: ' || array_to_string(seen, ' -> ') else 'turn order ' || array_to_string(seen, ' -> ') || ' matches no accepted order' end},
 {'check_name': 'check_turn_sequence', 'status': case when list_contains(al, 'FAIL') then 'FAIL' when list_contains(al, 'REVIEW') then 'REVIEW' else 'PASS' end,
  'reason': 'turns present: ' || case when len(seen) = 0 then 'none' else '[' || array_to_string(list_filter([""" + ", ".join(f"case when s_{d} = 'PASS' then '''{d}''' end" for d in S.TURNS) + """], lambda x: x is not null), ', ') || ']' end || '; order=' || case when fits then 'ok' else 'mismatch' end}] end, recursive := true) from pw)"""


def walking(value: str) -> str:
    return f", sg as (select filename, frame_index, {value} as value from v_walk where ({value}) is not null), sm as (select *, case when count(*) over (partition by filename) < 5 then value else avg(value) over (partition by filename order by frame_index rows between 2 preceding and 2 following) end smooth from sg), st as (select *, lead(smooth) over (partition by filename order by frame_index) - smooth step from sm), sn as (select filename, frame_index, case when step > 0.002::double then 1 when step < -0.002::double then -1 else 0 end sign from st where step is not null)" + islands("wr", "select filename, sign::varchar as label, frame_index as first, frame_index as last, 1 n from sn") + islands("ph", "select * from wr where label <> '0' and n >= 3")


VALUE = "case \"view\" when 'F' then body_scale when 'S' then centroid_x end"
WANT = "case vw when 'F' then 'approach (growing) then recede (shrinking)' else 'move left (<=) then move right (=>)' end"
COURSE = "case vw when 'F' then 'toward-then-away' else 'left-then-right' end"
WAYS = f""", fp as (select filename, list(label order by first) ls from ph group by 1), fl as (select filename, max("view") vw, count({VALUE}) n_usable from v_walk group by 1),
fs as (select filename, vw, n_usable, len(coalesce(ls, []))::bigint n, ls[1] f, list_transform(coalesce(ls, []), lambda x: case when vw = 'F' then case x when '1' then 'approach (growing)' else 'recede (shrinking)' end else case x when '1' then 'move right (=>)' else 'move left (<=)' end end) said from fl left join fp using (filename)),
fv as (select *, array_to_string(said, ' then ') seen, case when vw is null or vw not in ('F', 'S') then ['FAIL', 'unknown view ''' || coalesce(vw, 'None') || '''; cannot judge walk direction']
 when n_usable < 8 then ['FAIL', vw || ': only ' || n_usable || ' usable frame(s) < 8; too short to verify ' || {COURSE}] when n = 0 then ['FAIL', vw || ': ' || {COURSE} || ' FAIL; no sustained direction detected']
 when n >= 3 or (n = 2 and f = case vw when 'F' then '1' else '-1' end) then ['PASS', vw || ': ' || {COURSE} || ' OK (detected: ' || seen || ')'] when n = 1 then ['FAIL', vw || ': ' || {COURSE} || ' FAIL; only one phase (' || said[1] || '); a there-and-back (' || {WANT} || ') was not completed']
 else ['FAIL', vw || ': ' || {COURSE} || ' FAIL; reversed order (got ' || seen || '); spec requires ' || {WANT}] end v from fs)
select filename, n_usable, n n_phases, v[1] status, v[2] reason from fv"""


def t(tail: str) -> str:
    return with_views(tail, "v_timeline")


def w(tail: str) -> str:
    return with_views(walking("body_scale") + tail, "v_walk")


ORACLE_SQL = {
    "c4_classify_frame": t(LABEL + " select filename, frame_index, label from lab"), "w1_absorb_gaps": t(ABSORBED + " select * from ab"), "w3_segments": t(SEGS + " select * from segs"), "w4_gap_split": t(GAPS + " select * from gaps"),
    "w4_j6_restatus": t(GAPS + " select v.filename, v.frame_index, case when g.frame_index is null then case when face_detected then 'PASS' else 'SKIP' end when direction is not null then 'SKIP' else 'FAIL' end status, case when face_detected then 'ok' else 'No faces' end || case when g.frame_index is null then '' when direction is not null then '; expected gap (peak of ' || direction || ' turn)' else '; unexpected gap (no adjacent turn evidence)' end reason from v_timeline v left join gaps g on v.filename = g.filename and v.frame_index = g.frame_index"),
    "w2_bridge_flickers": t(BRIDGED_RUNS + " select * from br"), "w3_segments_bridged": t(BRIDGED + " select * from segs"), "w9_turn_verdicts": t(exact_verdicts(BRIDGED.replace("from v_timeline)", FRAMES_PLACED, 1)) + " select * from vd"),
    "w5_spine": t(SPINE + " select * from spine"), "w6_order_match_exact": t(SPINE + match(P) + ' select filename, labels, ord as "order", start::int start from mt'), "w6_order_match_contiguous": t(SPINE + match(LOOSE) + ' select filename, labels, ord as "order", start::int start from mt'),
    "w7_front_rows": t(VERDICTS + " select * from vd where check_name like '%front'"), "w8_direction_rows": t(VERDICTS + " select * from vd where check_name not like '%front' and check_name not like '%sequence'"), "w9_w10_sequence_row": t(VERDICTS + " select * from vd where check_name like '%sequence'"),
    "w11_presence": t(PRESENCE + " select * from px where status is not null"),
    "w12_walk_direction": with_views(walking(VALUE) + WAYS, "v_walk"),
    "w13_moving_average": w(" select * from sm"), "w14_polarity": w(" select * from sn"), "w15_phases": w(" select * from ph"), "w16_phase_automaton": w(", g as (select filename, count(*) n, arg_min(label, first) f from ph group by 1) select filename, n, (n >= 2 and f = '-1') or n >= 3 accepted from g"),
    "w17_sustained_run": w(" select filename, bool_or(label = '1' and n >= 3) sustained from wr group by 1"), "w18_isolated_points": with_views("select filename, frame_index, body_scale from (select *, lag(body_scale) over w a, lead(body_scale) over w b from v_walk window w as (partition by filename order by frame_index)) where body_scale is not null and a is null and b is null", "v_walk"),
    "w20_unpivot": t(" select filename, frame_index, 'yaw' measure, yaw as value from v_timeline union all select filename, frame_index, 'pitch', pitch from v_timeline union all select filename, frame_index, 'brightness', brightness from v_timeline"),
}

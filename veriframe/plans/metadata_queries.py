"""Registered queries of metadata checks, gates and the sampling grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriframe.operators import metadata as M
from veriframe.plans.adapters import view, with_views


def media(s, d):
    return view(s, d, "v_media")


def rows(s, d):
    return M.metadata_rows(media(s, d))


def one(check):
    return lambda s, d: rows(s, d).where(F.col("check_name") == check).select("filename", "status", "reason")


def frames(s, d):
    return media(s, d).where("n_frames_read > 0").select("filename", F.explode(F.sequence(F.lit(1), F.col("n_frames_read"))).alias("frame_index"))


def multi():
    return (F.substring("filename", 3, 10).cast("int") + F.col("frame_index")) % 7 == 0


QUERIES = {
    "p7_check_container": one("check_container"), "p8_check_fps": one("check_fps"), "p9_check_duration": one("check_duration"), "p10_check_resolution": one("check_resolution"),
    "p13_fail_fast": lambda s, d: M.fail_fast_rows(rows(s, d)), "j5_p13_passing_gate": lambda s, d: M.passing_gate(media(s, d), rows(s, d)).select("filename", "data_type"), "p14_frames_sampled": lambda s, d: M.frames_sampled(media(s, d), frames(s, d)),
    "p15_w19_truncate": lambda s, d: M.truncate_at_first(frames(s, d), multi()), "p16_single_person": lambda s, d: M.single_person(frames(s, d), multi()), "p17_unreadable": lambda s, d: M.unreadable_rows(media(s, d)),
    "p17_metadata_rows": lambda s, d: rows(s, d).drop("frame_index"), "s10_sample_grid": lambda s, d: M.sample_grid(media(s, d), max_frames=40), "o8_even_stride": lambda s, d: M.sample_grid(media(s, d), sample_fps=60, first=False, last=False, max_frames=25),
}


def chosen(name: str) -> str:
    """The check's verdict for the file's modality as (status, reason)."""
    def ge(col, label, digits, least):
        return f"case when {col} is null then row('FAIL', '{label} unknown (cannot verify against spec)') when {col} >= {least} then row('PASS', '{label}=' || format('{{:.{digits}f}}', {col}) || ' >= {least}') else row('FAIL', '{label}=' || format('{{:.{digits}f}}', {col}) || ' < {least}') end"
    def rule(m):
        if name == "check_fps":
            return ge("fps", "fps", 2, m.min_fps)
        if name == "check_duration":
            return ge("duration_sec", "duration", 1, m.min_duration)
        if name == "check_resolution":
            size = "'resolution=' || width || 'x' || height"
            return f"case when width is null or height is null then row('FAIL', 'resolution unknown (cannot verify against spec)') when width >= {m.min_width} and height >= {m.min_height} then row('PASS', {size} || ' >= {m.min_width}x{m.min_height}') else row('FAIL', {size} || ' < {m.min_width}x{m.min_height}') end"
        return f"case when not readable then row('FAIL', 'unreadable: ' || meta_reason) when extension <> '{m.extension}' then row('FAIL', 'extension=' || extension || ' != {m.extension}') when channel_count is null or channel_count < 3 then row('FAIL', 'channel count unknown (cannot verify RGB)') when not is_color then row('FAIL', 'grayscale content (channels identical; not true RGB)') else row('PASS', 'container ok (' || extension || ', ' || channel_count || ' channels)') end"
    return f"select volunteer_id, data_type, filename, '{name}' check_name, v[1] status, v[2] reason, {list(M.RULES).index(name) + 1}::bigint row_seq from (select *, case when data_type like 'walk%' and not readable then row('SKIP', 'video not readable: ' || meta_reason) when data_type like 'walk%' then {rule(M.WALK)} else {rule(M.FACE)} end v from v_media)"


ALL = ", rws as (" + " union all ".join(chosen(n) for n in M.RULES) + ")"
FRAMES = ", fr as (select filename, unnest(range(1, n_frames_read + 1))::int frame_index from v_media), mf as (select *, (substring(filename, 3)::int + frame_index) % 7 = 0 multi from fr)"


def sql(tail: str) -> str:
    return with_views(ALL + FRAMES + tail, "v_media")


def grid(fps: int, ends: str, cap: int) -> str:
    return sql(f", g as (select filename, fps, list_sort(list_distinct(range(0, frame_count, greatest(1, round_even(fps / {fps}, 0)::int)) || {ends})) g from v_media where frame_count > 0 and fps > 0), e as (select filename, fps, unnest(g) frame_index, unnest(range(len(g))) n, ceil(len(g) / {cap}.0)::int stride from g) select filename, frame_index::int frame_index, frame_index / fps timestamp_sec from e where n % stride = 0")


ORACLE_SQL = {
    "p7_check_container": sql(" select filename, status, reason from rws where check_name = 'check_container'"), "p8_check_fps": sql(" select filename, status, reason from rws where check_name = 'check_fps'"),
    "p9_check_duration": sql(" select filename, status, reason from rws where check_name = 'check_duration'"), "p10_check_resolution": sql(" select filename, status, reason from rws where check_name = 'check_resolution'"),
    "p13_fail_fast": sql(" select volunteer_id, data_type, filename, 'frame_checks' check_name, 'SKIP' status, 'fail-fast: ' || arg_min(check_name, row_seq) || ' failed; frame checks skipped' reason from rws where status = 'FAIL' group by 1, 2, 3"),
    "j5_p13_passing_gate": sql(" select filename, data_type from v_media where readable and filename not in (select filename from rws where status = 'FAIL')"),
    "p14_frames_sampled": sql(" select filename, case when n_frames_read = 0 then 'FAIL' else 'PASS' end status, n_frames_read || ' frames' reason from v_media"),
    "p15_w19_truncate": sql(" select filename, frame_index from mf qualify frame_index <= coalesce(min(frame_index) filter (multi) over (partition by filename), 1000000)"),
    "p16_single_person": sql(" select filename, 'check_single_person' check_name, 'FAIL' status, min(frame_index) frame_index from mf where multi group by 1"),
    "p17_unreadable": sql(" select volunteer_id, data_type, filename, 'frame_checks' check_name, 'SKIP' status, 'unreadable: ' || meta_reason reason from v_media where not readable"),
    "p17_metadata_rows": sql(" select volunteer_id, data_type, filename, 'video' as level, check_name, status, reason, row_seq from rws"),
    "s10_sample_grid": grid(5, "[0, frame_count - 1]", 40), "o8_even_stride": grid(60, "[]", 25),
}

"""Registered queries of the roll-ups over check rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriframe.functions.status import FACE_ORDER, LEVELS, WALK_ORDER
from veriframe.operators import report as R
from veriframe.plans.adapters import view, with_views

RULES = R.Aggregation(fail_ratio=0.0, review_ratio=0.5, per_check={"check_brightness": 0.2, "check_custom": 0.5})


def rows(spark, sf_dir):
    return view(spark, sf_dir, "v_rows")


def timeline(spark, sf_dir):
    return view(spark, sf_dir, "v_timeline")


def by_check(spark, sf_dir):
    return R.summarize_by_check(rows(spark, sf_dir), RULES)


def places(order: dict[str, int]) -> str:
    return "case check_name " + " ".join(f"when '{k}' then {v}" for k, v in order.items()) + " end"


PLACE = f"case when data_type like 'walk%' then {places(WALK_ORDER)} else {places(FACE_ORDER)} end"
LEVEL = "case check_level " + " ".join(f"when '{k}' then {v}" for k, v in LEVELS.items()) + " else 99 end"
RANK = "case {} when 'SKIP' then 0 when 'PASS' then 1 when 'REVIEW' then 2 when 'FAIL' then 3 else -1 end"

BY_CHECK = f""", grouped as (
  select volunteer_id, data_type, filename, check_name, arg_min(level, row_seq) check_level, count(*) total,
    count(*) filter (status = 'PASS') pass, count(*) filter (status = 'FAIL') fail, count(*) filter (status = 'REVIEW') review, count(*) filter (status = 'SKIP') skip,
    max({RANK.format("status")}) w,
    coalesce(arg_min(reason, (case status when 'FAIL' then 0 when 'REVIEW' then 1 when 'SKIP' then 2 else 3 end)::bigint * 1000000000 + row_seq) filter (reason <> ''), '') fr,
    case check_name when 'check_brightness' then 0.2::double when 'check_custom' then 0.5::double else 0.0::double end mx
  from v_rows group by all),
judged as (select *, (pass + fail + review)::double j, case when pass + fail + review = 0 then 'SKIP' when fail / (pass + fail + review)::double > mx then 'FAIL'
    when review / (pass + fail + review)::double > 0.5 then 'REVIEW' else 'PASS' end st from grouped),
checks as (select volunteer_id, data_type, filename, check_level, check_name,
  case when check_level = 'frame' then st else ['SKIP', 'PASS', 'REVIEW', 'FAIL'][w + 1] end final_status, total, pass, fail, review, skip,
  fr || case when check_level = 'frame' and j > 0 then ' [judged fail-ratio=' || round_even((case when st = 'REVIEW' then review else fail end) / j * 100, 0)::bigint || '% (max ' || round_even(mx * 100, 0)::bigint || '%)]' else '' end reason
  from judged)"""

OVERALL = BY_CHECK + f""", placed as (select *, {PLACE} p, {LEVEL} lv from checks),
names as (select *, (p is null)::int u, coalesce(p, lv) pl, case when p is null then check_name else '' end nm from placed),
overall0 as (select volunteer_id, data_type, filename, ['SKIP', 'PASS', 'REVIEW', 'FAIL'][max({RANK.format("final_status")}) + 1] final_status, count(*) total,
  count(*) filter (final_status = 'PASS') pass, count(*) filter (final_status = 'FAIL') fail, count(*) filter (final_status = 'REVIEW') review, count(*) filter (final_status = 'SKIP') skip,
  coalesce(list(check_name order by u, pl, nm) filter (final_status = 'FAIL'), []) failed_checks, coalesce(list(check_name order by u, pl, nm) filter (final_status = 'REVIEW'), []) reviewed,
  coalesce(list(struct_pack(check_name := check_name, reason := reason) order by u, pl, nm) filter (final_status = 'FAIL'), []) failed_checks_detail from names group by all),
overall as (select volunteer_id, data_type, filename, final_status, total, pass, fail, review, skip,
  case when len(failed_checks) > 0 then 'failed checks: ' || array_to_string(failed_checks[1:10], ', ') || case when len(failed_checks) > 10 then ', ... (' || len(failed_checks) || ' total)' else '' end
    when len(reviewed) > 0 then 'review checks: ' || array_to_string(reviewed[1:10], ', ') || case when len(reviewed) > 10 then ', ... (' || len(reviewed) || ' total)' else '' end else 'all checks passed' end reason,
  failed_checks, failed_checks_detail from overall0)"""

EXPANDED = OVERALL + """, expanded as (select data_type, volunteer_id, filename, final_status overall_status, unnest(case when final_status = 'FAIL' and len(failed_checks_detail) > 0 then failed_checks_detail else [struct_pack(check_name := '', reason := '')] end) d from overall),
flat as (select data_type, volunteer_id, filename, overall_status, d.check_name check_name, d.reason reason from expanded)"""

TIMELINE = "select filename, count(*) frames_sampled, count(*) filter (not face_detected) detection_gaps, min(yaw) filter (yaw is not null) yaw_min, max(yaw) yaw_max, min(pitch) filter (yaw is not null) pitch_min, max(pitch) filter (yaw is not null) pitch_max from v_timeline group by 1"


def overall(spark, sf_dir):
    return R.summarize_overall(by_check(spark, sf_dir))


def expanded(spark, sf_dir):
    return R.expand_to_check_rows(overall(spark, sf_dir))


def j1(spark, sf_dir):
    times = rows(spark, sf_dir).where("frame_index is not null").select("filename", "frame_index", (F.col("frame_index") / 5.0).alias("timestamp_sec"), F.col("row_seq").alias("seq")).where("frame_index % 3 <> 0")
    return R.detail_rows(rows(spark, sf_dir).select("filename", "check_name", "status", "frame_index", "row_seq"), times)


def a7(spark, sf_dir):
    named = rows(spark, sf_dir).withColumn("filename", F.concat(F.lit("u"), F.expr("substring(filename, 6)")))
    return R.overall_record(named, timeline(spark, sf_dir), RULES).drop("failed_checks_detail")


def k7(spark, sf_dir):
    records = overall(spark, sf_dir).select("data_type", "volunteer_id", "filename", "final_status", F.lit(0).alias("seq"))
    later = records.where("length(filename) % 2 = 0").withColumns({"final_status": F.lit("RERUN"), "seq": F.lit(1)})
    return R.upsert(records, later)


def k4(spark, sf_dir):
    return R.in_report_order(by_check(spark, sf_dir)).select("filename", "check_name", "final_status", "position")


def x8(spark, sf_dir):
    files = rows(spark, sf_dir).where("status = 'FAIL' and level = 'video'").select(*R.FILE, F.concat(F.lit("  boom\n\tat "), "reason").alias("error"))
    return R.error_rows(files)


def a1(spark, sf_dir):
    counts = rows(spark, sf_dir).groupBy("filename").agg(*(R.count_of(s).alias(s.lower()) for s in ("PASS", "FAIL", "REVIEW")))
    return counts.select("filename", R.ratio_status(F.col("pass"), F.col("fail"), F.col("review"), F.lit(0.2), F.lit(0.25)).alias("status"))


def a3(spark, sf_dir):
    return rows(spark, sf_dir).groupBy("filename").agg(R.first_reason().alias("reason"))


def a4(spark, sf_dir):
    return rows(spark, sf_dir).groupBy("filename").agg(R.worst_status(F.col("status")).alias("status"))


def j11(spark, sf_dir):
    return rows(spark, sf_dir).select("check_name").distinct().select("check_name", R.limit_of(F.col("check_name"), RULES).alias("fail_max"))


QUERIES = {
    "a1_ratio_status": a1, "a2_summarize_by_check": by_check, "a3_first_reason": a3, "a4_worst_status": a4, "a5_summarize_overall": lambda s, d: overall(s, d).drop("failed_checks", "failed_checks_detail"),
    "a6_summarize_timeline": lambda s, d: R.summarize_timeline(timeline(s, d)), "a6_summarize_timeline_walk": lambda s, d: R.summarize_timeline(view(s, d, "v_walk"), walk=True),
    "a7_overall_record": a7, "a8_image_record": lambda s, d: overall(s, d).where("data_type = 'palm'").select(F.concat(F.lit("palm_"), F.element_at(F.split("filename", "_"), 2)).alias("data_type"), "volunteer_id", "filename", "final_status", "fail"),
    "a11_verdict_tallies": lambda s, d: overall(s, d).groupBy("final_status").agg(F.count("*").alias("n")),
    "j1_detail_rows": j1, "j11_fail_ratio_lookup": j11, "k4_result_rows": k4, "k6_summary_rows": expanded, "k7_u5_upsert": k7, "k10_tally": lambda s, d: R.tally(rows(s, d)),
    "o1_report_order": lambda s, d: R.in_report_order(by_check(s, d)).select("filename", "check_name", "position"), "x7_expand_to_check_rows": expanded, "x8_error_rows": x8,
    "u4_union_modalities": lambda s, d: expanded(s, d).where("data_type = 'palm'").unionByName(expanded(s, d).where("data_type = 'face_rgb'")),
    "k9_to_json": lambda s, d: overall(s, d).select(F.to_json(F.struct("filename", "final_status", "failed_checks")).alias("record")),
}


def sql(tail: str, *names: str) -> str:
    return with_views(tail, *names)


POSITION = f"row_number() over (partition by volunteer_id, data_type, filename order by ({PLACE}) is null, coalesce({PLACE}, {LEVEL}), case when ({PLACE}) is null then check_name else '' end)"

ORACLE_SQL = {
    "a1_ratio_status": sql("select filename, case when j = 0 then 'SKIP' when f / j > 0.2::double then 'FAIL' when r / j > 0.25::double then 'REVIEW' else 'PASS' end status from (select filename, count(*) filter (status <> 'SKIP')::double j, count(*) filter (status = 'FAIL') f, count(*) filter (status = 'REVIEW') r from v_rows group by 1)", "v_rows"),
    "a2_summarize_by_check": sql(BY_CHECK + " select * from checks", "v_rows"),
    "a3_first_reason": sql("select filename, coalesce(arg_min(reason, (case status when 'FAIL' then 0 when 'REVIEW' then 1 when 'SKIP' then 2 else 3 end)::bigint * 1000000000 + row_seq) filter (reason <> ''), '') reason from v_rows group by 1", "v_rows"),
    "a4_worst_status": sql(f"select filename, ['SKIP', 'PASS', 'REVIEW', 'FAIL'][max({RANK.format('status')}) + 1] status from v_rows group by 1", "v_rows"),
    "a5_summarize_overall": sql(OVERALL + " select * exclude (failed_checks, failed_checks_detail) from overall", "v_rows"),
    "a6_summarize_timeline": sql(TIMELINE, "v_timeline"),
    "a6_summarize_timeline_walk": sql("select filename, count(*) frames_sampled, count(*) filter (body_scale is null) detection_gaps from v_walk group by 1", "v_walk"),
    "a7_overall_record": sql(OVERALL + f", tl as ({TIMELINE}) select o.* exclude (failed_checks_detail, filename), 'u' || substring(o.filename, 6) filename, coalesce(frames_sampled, 0) frames_sampled, coalesce(detection_gaps, 0) detection_gaps, yaw_min, yaw_max, pitch_min, pitch_max from overall o left join tl on 'u' || substring(o.filename, 6) = tl.filename", "v_rows", "v_timeline"),
    "a8_image_record": sql(OVERALL + " select 'palm_' || split_part(filename, '_', 2) data_type, volunteer_id, filename, final_status, fail from overall where data_type = 'palm'", "v_rows"),
    "a11_verdict_tallies": sql(OVERALL + " select final_status, count(*) n from overall group by 1", "v_rows"),
    "j1_detail_rows": sql(", t as (select filename, frame_index, arg_max(frame_index / 5.0::double, row_seq) time_sec from v_rows where frame_index % 3 <> 0 group by all) select r.filename, r.check_name, r.status, r.frame_index, r.row_seq, t.time_sec from v_rows r left join t on r.filename = t.filename and r.frame_index = t.frame_index", "v_rows"),
    "j11_fail_ratio_lookup": sql("select distinct check_name, case check_name when 'check_brightness' then 0.2::double when 'check_custom' then 0.5::double else 0.0::double end fail_max from v_rows", "v_rows"),
    "k4_result_rows": sql(BY_CHECK + f" select filename, check_name, final_status, {POSITION} as position from checks", "v_rows"),
    "k6_summary_rows": sql(EXPANDED + " select * from flat", "v_rows"),
    "k7_u5_upsert": sql(OVERALL + " select data_type, volunteer_id, filename, case when length(filename) % 2 = 0 then 'RERUN' else final_status end final_status, (length(filename) % 2 = 0)::int seq from overall", "v_rows"),
    "k10_tally": sql("select check_name, status, count(*) n from v_rows group by all", "v_rows"),
    "o1_report_order": sql(BY_CHECK + f" select filename, check_name, {POSITION} as position from checks", "v_rows"),
    "x7_expand_to_check_rows": sql(EXPANDED + " select * from flat", "v_rows"),
    "x8_error_rows": sql("select volunteer_id, data_type, filename, 'video' as level, 'processing_error' check_name, 'FAIL' status, trim('boom at ' || reason) reason, null::int frame_index, 1::bigint row_seq from v_rows where status = 'FAIL' and level = 'video'", "v_rows"),
    "u4_union_modalities": sql(EXPANDED + " select * from flat where data_type in ('palm', 'face_rgb')", "v_rows"),
    "k9_to_json": sql(OVERALL + """ select '{"filename":"' || filename || '","final_status":"' || final_status || '","failed_checks":[' || array_to_string(list_transform(failed_checks, lambda x: '"' || x || '"'), ',') || ']}' record from overall""", "v_rows"),
}

"""Registered queries of discovery and naming."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriframe.operators import filenames as N
from veriframe.plans.adapters import view, with_views


def files(spark, sf_dir):
    return view(spark, sf_dir, "v_files")


def name():
    return F.col("name")


def named(spark, sf_dir):
    return files(spark, sf_dir).withColumn("name", N.base_name(F.col("path")))


def p5(s, d):
    hand, pose = N.hand_pose(name())
    return named(s, d).select("path", N.view_of(name()).alias("view"), hand.alias("hand"), pose.alias("pose"), N.leading_id(name()).alias("volunteer_id"))


def ids(s, d):
    return N.classify(files(s, d)).where("volunteer_id is not null")


def j8(s, d):
    return ids(s, d).join(F.broadcast(N.allowed_ids(ids(s, d), 20)), "volunteer_id", "left_semi").select("path", "volunteer_id", "data_key")  # 20 ids at most


def u1(s, d):
    kinds = [ids(s, d).where(F.col("data_key").startswith(k)).select("volunteer_id") for k in ("face", "palm", "walk")]
    return kinds[0].union(kinds[1]).union(kinds[2]).distinct()


def j2(s, d):
    return N.completeness(files(s, d)).select("volunteer_id", F.explode("missing").alias("data_key"))


def a9_total(s, d):
    return N.completeness(files(s, d)).agg(F.count("*").alias("volunteers"), F.count_if(F.col("status") == "COMPLETE").alias("complete"), F.sum(F.size("missing")).alias("missing"), F.sum(F.size("duplicates")).alias("duplicates"))


def j10(s, d):
    odd = N.classify(files(s, d)).where("guessed_id is not null").select(F.col("guessed_id").alias("volunteer_id"), F.col("path").alias("odd"))
    return ids(s, d).select("volunteer_id").distinct().join(odd, "volunteer_id")


def a18(s, d):
    i = N.issues(files(s, d))
    pick = lambda kind, what: F.sort_array(F.collect_list(F.when(F.col("issue") == kind, F.col(what))))
    return i.groupBy("volunteer_id").agg(pick("missing", "item").alias("missing"), F.sort_array(F.collect_set(F.when(F.col("issue") == "duplicate", F.col("item")))).alias("duplicates"), pick("unrecognised", "detail").alias("unrecognised"))


def s18(s, d):
    odd = files(s, d).select(F.when(F.col("walk_seq") % 5 == 0, F.concat(F.lit("../"), "path")).when(F.col("walk_seq") % 7 == 0, F.concat(F.lit("C:\\"), "path")).when(F.col("walk_seq") % 9 == 0, F.concat(F.lit("/"), "path")).otherwise(F.col("path")).alias("member"))
    return odd.select("member", N.safe_member(F.col("member")).alias("safe"))


def s1(s, d):
    return N.classify(files(s, d)).where("volunteer_id is not null").groupBy("volunteer_id", "data_key").agg(F.sort_array(F.collect_list("path")).alias("paths"))


WALK, PALM, FACE = r"\A[0-9]+_walk_[FS]\.mp4\z", r"\A[0-9]+_palm_[LR]_(N|RL|RR|PU|PD)\.jpg\z", r"\A[0-9]+_face_rgb\.mp4\z"
QUERIES = {
    "s1_scan": s1, "s2_find_face_rgb_videos": lambda s, d: N.find_face_videos(files(s, d)), "s3_find_palm_images": lambda s, d: N.find_palm_images(files(s, d)),
    "s4_find_walk_files": lambda s, d: N.find_files(files(s, d), WALK), "s5_find_palm_files": lambda s, d: N.find_files(files(s, d), PALM), "s6_find_face_rgb_files": lambda s, d: N.find_files(files(s, d), FACE), "s18_safe_members": s18,
    "p1_classify": lambda s, d: N.classify(files(s, d)).select("path", "data_key", "volunteer_id"), "p2_guessed_id": lambda s, d: N.classify(files(s, d)).where("data_key is null").select("path", "guessed_id"),
    "p3_route": lambda s, d: named(s, d).select("path", N.route(name()).alias("route")), "p4_organize_plan": lambda s, d: N.organize_plan(files(s, d)), "p5_name_parts": p5, "p6_palm_pose_key": lambda s, d: named(s, d).select("path", N.palm_pose_key(name()).alias("key")),
    "j2_missing_keys": j2, "u3_missing_difference": j2, "j8_u2_allowed_files": j8, "j10_unrecognised_by_guess": j10, "a9_completeness": lambda s, d: N.completeness(files(s, d)), "a9_totals": a9_total, "a16_expected_counts": lambda s, d: N.expected_counts(files(s, d)),
    "a18_issues_of_volunteer": a18, "k8_issues_long": lambda s, d: N.issues(files(s, d)), "o2_allowed_ids": lambda s, d: N.allowed_ids(ids(s, d), 15), "o4_volunteers": lambda s, d: ids(s, d).select("volunteer_id").distinct().orderBy("volunteer_id"), "u1_union_ids": u1,
}

KEY = "case " + " ".join(f"when regexp_full_match(name, '[0-9]+{p}') then '{k}'" for k, p in N.REQUIRED.items()) + " end"
LID = "nullif(regexp_extract(name, '^([0-9]+)_', 1), '')"
BASE = f", named as (select *, string_split(path, '/')[-1] as name from v_files), cls as (select *, {KEY} as data_key, {LID} as lid from named), cl as (select path, walk_seq, name, data_key, case when data_key is not null then lid end as volunteer_id, case when data_key is null then lid end as guessed_id from cls)"
REQ = ", req as (select unnest([" + ", ".join(f"{{'k': '{k}', 'n': {n}}}" for n, k in enumerate(N.REQUIRED)) + "], recursive := true)), vol as (select distinct volunteer_id from cl where volunteer_id is not null), fnd as (select volunteer_id, data_key, count(*) c from cl where volunteer_id is not null group by all), grid as (select v.volunteer_id, r.k, r.n, coalesce(f.c, 0) c from vol v cross join req r left join fnd f on f.volunteer_id = v.volunteer_id and f.data_key = r.k), comp as (select volunteer_id, coalesce(list(k order by n) filter (c = 0), []) missing, coalesce(list(k order by n) filter (c > 1), []) duplicates, count(*) filter (c > 0) found_count, case when bool_and(c = 1) then 'COMPLETE' else 'INCOMPLETE' end status from grid group by 1)"
ISSUES = ", issues as (select volunteer_id, 'missing' issue, k item, '' detail from grid where c = 0 union all select c.volunteer_id, 'duplicate', c.data_key, c.path from cl c join grid g on g.volunteer_id = c.volunteer_id and g.k = c.data_key where g.c > 1 union all select coalesce(guessed_id, 'UNKNOWN'), 'unrecognised', name, path from cl where data_key is null)"


def sql(tail: str) -> str:
    return with_views(BASE + tail, "v_files")


def found(pattern: str) -> str:
    return sql(f" select path, lower(name) as name, walk_seq, regexp_extract(lower(name), '^([0-9]+)_', 1) volunteer_id from named where regexp_full_match(lower(name), lower('{pattern}')) and len(string_split(path, '/')) - 2 <= 5 qualify row_number() over (partition by lower(name) order by walk_seq) = 1")


ALLOWED = "select volunteer_id from vol order by try_cast(volunteer_id as bigint) is null, try_cast(volunteer_id as bigint), volunteer_id limit {}"
ORACLE_SQL = {
    "s1_scan": sql(" select volunteer_id, data_key, list(path order by path) paths from cl where volunteer_id is not null group by all"),
    "s2_find_face_rgb_videos": sql(" select path, lid volunteer_id, b as bucket from (select path, lid, case when regexp_full_match(name, '[0-9]+_face_rgb\\.mp4') then 'matched' when regexp_full_match(lower(name), '[0-9]+_face_rgb\\.mp4') then 'wrong_case' when contains(lower(name), '_face_') then null else 'skipped' end b from cls where ends_with(lower(name), '.mp4')) where b is not null"),
    "s3_find_palm_images": sql(" select path, lid volunteer_id, b as bucket from (select path, lid, case when regexp_full_match(name, '[0-9]+_palm_[LR]_(N|RL|RR|PU|PD)\\.jpg') then 'matched' when regexp_full_match(lower(name), '[0-9]+_palm_[lr]_(n|rl|rr|pu|pd)\\.jpg') then 'wrong_case' end b from cls) where b is not null"),
    "s4_find_walk_files": found("[0-9]+_walk_[FS]\\.mp4"), "s5_find_palm_files": found("[0-9]+_palm_[LR]_(N|RL|RR|PU|PD)\\.jpg"), "s6_find_face_rgb_files": found("[0-9]+_face_rgb\\.mp4"),
    "s18_safe_members": with_views("select case when walk_seq % 5 = 0 then '../' || path when walk_seq % 7 = 0 then 'C:\\' || path when walk_seq % 9 = 0 then '/' || path else path end member, not (walk_seq % 5 = 0 or walk_seq % 7 = 0 or walk_seq % 9 = 0) as safe from v_files", "v_files"),
    "p1_classify": sql(" select path, data_key, volunteer_id from cl"), "p2_guessed_id": sql(" select path, guessed_id from cl where data_key is null"),
    "p3_route": sql(" select path, case when data_key is null then 'unrecognised' when data_key in ('face_rgb', 'walk_F', 'walk_S') then 'runnable' else 'not_implemented' end route from cl"),
    "p4_organize_plan": sql(", r as (select *, coalesce(string_split(path, '/')[-2] = volunteer_id, false) own, count(*) over (partition by volunteer_id, name) copies from cl), r2 as (select *, row_number() over (partition by volunteer_id, name order by own desc, walk_seq) pl from r), r3 as (select *, case when data_key is null then 'unrecognised' when copies = 1 or (pl = 1 and own) then 'keeper' else 'duplicate' end kind from r2) select path, case kind when 'unrecognised' then '_unrecognised/' || path when 'keeper' then volunteer_id || '/' || name else volunteer_id || '_duplicates/' || path end target, kind from r3"),
    "p5_name_parts": sql(" select path, case when contains(name, '_walk_F') then 'F' when contains(name, '_walk_S') then 'S' end as view, nullif(regexp_extract(name, '_palm_([LR])_(N|RL|RR|PU|PD)\\.', 1), '') hand, nullif(regexp_extract(name, '_palm_([LR])_(N|RL|RR|PU|PD)\\.', 2), '') pose, lid volunteer_id from cls"),
    "p6_palm_pose_key": sql(" select path, coalesce(" + ", ".join(f"case when contains(name, '{k}') then '{k}' end" for k in N.PALM_KEYS) + ") as key from named"),
    "j2_missing_keys": sql(REQ + " select volunteer_id, k data_key from grid where c = 0"), "u3_missing_difference": sql(REQ + " select volunteer_id, k data_key from vol cross join req except select volunteer_id, data_key from fnd"),
    "j8_u2_allowed_files": sql(REQ + f" select path, volunteer_id, data_key from cl where volunteer_id in ({ALLOWED.format(20)})"),
    "j10_unrecognised_by_guess": sql(REQ + " select v.volunteer_id, c.path odd from vol v join cl c on c.guessed_id = v.volunteer_id"),
    "a9_completeness": sql(REQ + " select * from comp"), "a9_totals": sql(REQ + " select count(*) volunteers, count(*) filter (status = 'COMPLETE') complete, sum(len(missing))::bigint missing, sum(len(duplicates))::bigint duplicates from comp"),
    "a16_expected_counts": sql(" select count(*) filter (data_key = 'face_rgb') face, count(*) filter (data_key like 'palm%') palm, count(*) filter (data_key like 'walk%') walk from cl"),
    "a18_issues_of_volunteer": sql(REQ + ISSUES + " select volunteer_id, coalesce(list(item order by item) filter (issue = 'missing'), []) missing, coalesce(list_sort(list(distinct item) filter (issue = 'duplicate')), []) duplicates, coalesce(list(detail order by detail) filter (issue = 'unrecognised'), []) unrecognised from issues group by 1"),
    "k8_issues_long": sql(REQ + ISSUES + " select * from issues"), "o2_allowed_ids": sql(REQ + " " + ALLOWED.format(15)), "o4_volunteers": sql(REQ + " select volunteer_id from vol order by 1"),
    "u1_union_ids": sql(REQ + " select volunteer_id from vol"),
}

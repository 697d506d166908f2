"""Views over the TPC-H-like tables in the shapes that the quality-control operators take.

Each view is one SQL text that Spark and DuckDB both run; only integer arithmetic, comparisons and string
operations are used, so both give the same rows. ``{lineitem}`` and so on stand for the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, tuple[str, str]] = {
    # check rows: a file per order, a row per line
    "v_rows": (
        "lineitem",
        """
select cast(l_orderkey % 997 as string) as volunteer_id,
  case l_orderkey % 3 when 0 then 'face_rgb' when 1 then 'palm' else 'walk_F' end as data_type,
  'file_' || cast(l_orderkey as string) as filename,
  case when l_linenumber <= 2 then 'video' when l_linenumber = 3 then 'sequence' else 'frame' end as level,
  case l_linenumber when 1 then 'check_container' when 2 then 'check_fps' when 3 then 'check_turn_sequence' when 4 then 'check_face_detected'
    when 5 then 'check_brightness' when 6 then 'check_custom' else 'check_occlusion' end as check_name,
  case when cast(floor(l_quantity) as int) % 11 = 0 then 'REVIEW' when cast(floor(l_quantity) as int) % 7 = 0 then 'SKIP' when l_returnflag = 'R' then 'FAIL' else 'PASS' end as status,
  case when l_partkey % 4 = 0 then '' else 'r' || cast(l_partkey as string) end as reason,
  case when l_linenumber >= 4 then cast(floor(l_quantity) as int) end as frame_index,
  row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as row_seq
from {lineitem}""",
    ),
    # metadata of a file per order
    "v_media": (
        "orders",
        """
select cast(o_custkey as string) as volunteer_id, cast(o_orderkey as string) as path, 'm_' || cast(o_orderkey as string) as filename,
  case o_orderkey % 3 when 0 then 'face_rgb' when 1 then 'walk_F' else 'walk_S' end as data_type,
  case when o_orderkey % 17 = 0 then '.mov' else '.mp4' end as extension, o_orderkey % 19 <> 0 as readable,
  case when o_orderkey % 19 = 0 then 'cannot open' else 'ok' end as meta_reason,
  case when o_orderkey % 13 <> 0 then cast(160 + (o_orderkey % 37) * 60 as int) end as width,
  case when o_orderkey % 13 <> 0 then cast(120 + (o_orderkey % 29) * 45 as int) end as height,
  case when o_orderkey % 11 <> 0 then cast(o_orderkey % 61 as double) end as fps,
  case when o_orderkey % 7 <> 0 then cast(o_orderkey % 97 as double) end as duration_sec,
  case when o_orderkey % 5 <> 0 then cast(o_orderkey % 300 as int) else 0 end as frame_count,
  case when o_orderkey % 23 <> 0 then cast(1 + o_orderkey % 4 as int) end as channel_count, o_orderkey % 9 <> 0 as is_color,
  cast(o_orderkey % 6 as int) as n_frames_read
from {orders}""",
    ),
    # a face timeline per user: a scripted movement with gaps
    "v_timeline": (
        "events",
        """
select 'u' || cast(user_id as string) as filename, cast(user_id as string) as volunteer_id, idx as frame_index, cast(idx as double) as timestamp_sec,
  case when event_type = 'error' or phase = 9 then false else true end as face_detected,
  case when event_type = 'error' or phase = 9 then null when phase in (1, 2) then -50.0 when phase in (4, 5) then 50.0 when cast(floor(value) as int) % 13 = 0 then -28.0 else cast(cast(floor(value) as int) % 5 as double) end as yaw,
  case when event_type = 'error' or phase = 9 then null when phase = 6 then -40.0 when phase = 8 then 40.0 else cast(cast(floor(value) as int) % 3 as double) end as pitch,
  cast(cast(floor(value) as int) % 4 as double) as brightness
from (select *, cast(floor(idx / 4.0) as int) % 10 as phase from (
  select *, cast(row_number() over (partition by user_id order by ts, event_id) - 1 as int) as idx from {events}))""",
    ),
    # a walk timeline per user
    "v_walk": (
        "events",
        """
select 'u' || cast(user_id as string) as filename, case user_id % 3 when 0 then 'F' when 1 then 'S' end as view, idx as frame_index,
  case when event_type = 'error' then null else cast(300 + (case when idx % 40 < 20 then idx % 40 else 40 - idx % 40 end) * 10 + cast(floor(value) as int) % 3 as double) / 1000 end as body_scale,
  case when event_type = 'error' then null else cast(200 + (case when idx % 30 < 15 then idx % 30 else 30 - idx % 30 end) * 12 + cast(floor(value) as int) % 4 as double) / 1000 end as centroid_x,
  cast(cast(floor(value) as int) % 300 as double) as brightness
from (select *, cast(row_number() over (partition by user_id order by ts, event_id) - 1 as int) as idx from {events})""",
    ),
    # detected objects: a frame per order
    "v_det": (
        "lineitem",
        """
select 'd_' || cast(l_orderkey % 1000 as string) as filename, l_orderkey as frame_index, cast(l_linenumber - 1 as int) as cls_id, 'c' || cast(l_linenumber - 1 as string) as cls_name,
  cast(cast(floor(l_discount * 100 + 0.5) as int) % 11 as double) / 10 as conf,
  cast(l_partkey % 500 as double) as x, cast(l_suppkey % 400 as double) as y, cast(10 + l_quantity as double) as w, cast(20 + l_partkey % 90 as double) as h,
  row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as det_seq
from {lineitem}""",
    ),
    # delivered files: each document is a file of a volunteer, with wrong case, junk, copies and missing ones
    "v_files": (
        "documents",
        """
select doc_id as walk_seq, 'root' || case when doc_id % 6 = 0 then '/a/b' when doc_id % 29 = 0 then '/a/b/c/d/e/f' else '' end || '/' || vid || case when doc_id % 8 = 0 then '_x' else '' end || '/' || name as path from (
select doc_id, vid, case when doc_id % 31 = 0 then 'notes_' || vid || '.txt' when doc_id % 37 = 0 then vid || '_FACE_RGB.mp4' when doc_id % 41 = 0 then vid || '_palm_L_N.JPG' else vid || '_' || case doc_id % 17
  when 0 then 'face_rgb.mp4' when 1 then 'face_depth.mp4' when 2 then 'face_ir1.mp4' when 3 then 'face_ir2.mp4' when 4 then 'face_thermal.mp4' when 5 then 'walk_F.mp4' when 6 then 'walk_S.mp4'
  when 7 then 'palm_L_N.jpg' when 8 then 'palm_L_RL.jpg' when 9 then 'palm_L_RR.jpg' when 10 then 'palm_L_PU.jpg' when 11 then 'palm_L_PD.jpg'
  when 12 then 'palm_R_N.jpg' when 13 then 'palm_R_RL.jpg' when 14 then 'palm_R_RR.jpg' when 15 then 'palm_R_PU.jpg' else 'palm_R_PD.jpg' end end as name
from (select doc_id, case when doc_id % 5 = 0 then '0' else '' end || cast(cast(floor(doc_id / 23.0) as int) as string) as vid from {documents}))""",
    ),
    # landmarks: 21 points a vector
    "v_hand": (
        "embeddings",
        """
select vec_id, case vec_id % 3 when 0 then 'L' when 1 then 'R' end as hand, case vec_id % 5 when 0 then 'N' when 1 then 'RL' when 2 then 'RR' when 3 then 'PU' else 'PD' end as pose,
  embedding as e, case when vec_id % 11 <> 0 then cast(vec_id % 100 as double) / 100 end as score, label
from {embeddings}""",
    ),
}


TIMELINE = VIEWS["v_timeline"][1]
REGIONS = ("forehead", "left_eye", "right_eye", "nose", "mouth", "left_cheek", "right_cheek")
SKIN = ", ".join(f"case when (frame_index + {k}) % 9 <> 0 then cast((frame_index * {k + 1}) % 11 as double) / 10 end as skin_{r}" for k, r in enumerate(REGIONS))
MEDIA = """
select 'u' || cast(user_id as string) || '.mp4' as filename, cast(user_id as string) as volunteer_id, '{kind}' as data_type, 'u' || cast(user_id as string) as path, case when user_id % 17 = 0 then '.mov' else '.mp4' end as extension,
  user_id % 19 <> 0 as readable, case when user_id % 19 = 0 then 'cannot open' else 'ok' end as meta_reason, 1920 as width, 1080 as height, cast(30 as double) as fps, cast({least} - 1 + user_id % 13 as double) as duration_sec,
  cast(100 as int) as frame_count, 3 as channel_count, true as is_color, case when user_id % 23 = 5 then 'ValueError:  bad   header' end as error
from (select distinct user_id from {{events}}) users"""
VIEWS |= {
    # what a face detector finds in each frame of the timeline, and the files that the frames are of; the same for walks
    "v_face_obs": ("events", f"""
select filename, filename as path, volunteer_id, frame_index, timestamp_sec, face_detected, yaw, pitch, case when not face_detected then case when frame_index % 50 = 49 then 'Multiple faces detected: 2' else 'No faces detected' end end as message,
  case when frame_index % 23 = 0 then 'Chin might be cut' else 'Head is fully visible' end as head, 150 + frame_index % 90 as face_width, 170 + frame_index % 70 as face_height, cast(frame_index % 10 as double) / 10 as blink_left,
  cast(frame_index % 7 as double) / 10 as blink_right, case when frame_index % 37 <> 5 then cast(frame_index * 7 % 256 as double) end as luma, case when frame_index % 13 <> 0 then cast(frame_index % 120 as double) end as sharpness,
  case when frame_index = 30 and cast(volunteer_id as int) % 31 = 7 then 'RuntimeError: lost frame' end as error, {SKIN}
from ({TIMELINE}) timeline"""),
    "v_walk_obs": ("events", f"""
select filename, filename as path, view, frame_index, body_scale, centroid_x, brightness as luma, body_scale is not null as ok,
  case when body_scale is null then case when frame_index % 40 = 39 then 'Multiple persons detected: 2' else 'No poses detected' end end as message,
  body_scale as height, cast(100 + frame_index % 50 as double) as box_x, cast(120 as double) as box_y, cast(80 as double) as box_w, cast(200 + frame_index % 30 as double) as box_h,
  case when frame_index % 5 <> 0 and body_scale is not null then cast(310 + frame_index % 30 as double) end as foot_y, case when frame_index % 29 <> 8 then cast(frame_index % 90 as double) end as sharpness,
  cast(20 + frame_index % 100 as double) as blur_luma, cast(frame_index % 31 as double) as contrast,
  case when frame_index = 25 and cast(substring(filename, 2, 10) as int) % 11 = 3 or frame_index = 0 and cast(substring(filename, 2, 10) as int) % 29 = 6 then 'RuntimeError: lost frame' end as error
from ({VIEWS["v_walk"][1]}) walks"""),
    "v_face_media": ("events", MEDIA.format(kind="face_rgb", least=40)),
    "v_walk_media": ("events", MEDIA.format(kind="walk_F", least=15)),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, sql = VIEWS[name]
    return spark.sql(sql, **{source: spark.read.parquet(f"{sf_dir}/{source}.parquet")})


def duck(name: str) -> str:
    """The view as a common table expression for DuckDB."""
    source, sql = VIEWS[name]
    return f"{name} as ({sql.format(**{source: source})})"


def with_views(sql: str, *names: str) -> str:
    """sql with the views in front; sql may go on with further expressions after a leading comma."""
    return "with recursive " + ", ".join(duck(n) for n in names) + (sql if sql.lstrip().startswith(",") else "\n" + sql)

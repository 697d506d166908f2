"""Discovery and naming: which file is what, what each volunteer lacks, has twice, or can't be placed.

Everything is a projection of the path and one aggregation per volunteer; the list of required names is a
constant, so completeness is an array difference and needs no cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

# What each volunteer delivers. Key -> pattern after the volunteer's number, in order.
REQUIRED = {
    "face_rgb": r"_face_rgb\.mp4", "face_depth": r"_face_depth\.mp4", "face_ir1": r"_face_ir1\.mp4", "face_ir2": r"_face_ir2\.mp4", "face_thermal": r"_face_thermal\.mp4",
    "palm_L_N": r"_palm_L_N\.jpg", "palm_L_RL": r"_palm_L_RL\.jpg", "palm_L_RR": r"_palm_L_RR\.jpg", "palm_L_PU": r"_palm_L_PU\.jpg", "palm_L_PD": r"_palm_L_PD\.jpg",
    "palm_R_N": r"_palm_R_N\.jpg", "palm_R_RL": r"_palm_R_RL\.jpg", "palm_R_RR": r"_palm_R_RR\.jpg", "palm_R_PU": r"_palm_R_PU\.jpg", "palm_R_PD": r"_palm_R_PD\.jpg",
    "walk_F": r"_walk_F\.mp4", "walk_S": r"_walk_S\.mp4",
}
PALM_KEYS = [k for k in REQUIRED if k.startswith("palm")]
RUNNABLE = ("face_rgb", "walk_F", "walk_S")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_name(path: Column) -> Column:
    return F.when(F.size(F.split(path, "/")) > 1, F.element_at(F.split(path, "/"), -2)).otherwise("")


def depth(path: Column) -> Column:
    """Folders between the root and the file."""
    return F.size(F.split(path, "/")) - 2


def data_key(name: Column) -> Column:
    """The required pattern that the name fits (case counts), or null: what follows the digits is looked up."""
    suffixes = F.create_map(*(F.lit(x) for k, p in REQUIRED.items() for x in (p.replace("\\", ""), k)))
    return F.try_element_at(suffixes, F.regexp_extract(name, r"\A[0-9]+(_[^\r\n]+)\z", 1))


def leading_id(name: Column) -> Column:
    """The digits before the first underscore, or null."""
    found = F.regexp_extract(name, r"\A([0-9]+)_", 1)
    return F.when(found != "", found)


def classify(files: DataFrame) -> DataFrame:
    """files with name, data_key, volunteer_id (null if unrecognised) and guessed_id (of unrecognised names only)."""
    name = base_name(F.col("path"))
    known = data_key(F.col("name"))
    return files.withColumn("name", name).withColumn("data_key", known).withColumns({"volunteer_id": F.when(F.col("data_key").isNotNull(), leading_id(F.col("name"))), "guessed_id": F.when(F.col("data_key").isNull(), leading_id(F.col("name")))})


def route(name: Column) -> Column:
    """What can be done with a file: runnable, not_implemented (a known kind without content checks) or unrecognised."""
    key = data_key(name)
    return F.when(key.isNull(), "unrecognised").when(key.isin(*RUNNABLE), "runnable").otherwise("not_implemented")


def view_of(name: Column) -> Column:
    return F.when(name.contains("_walk_F"), "F").when(name.contains("_walk_S"), "S")


def hand_pose(name: Column) -> tuple[Column, Column]:
    part = lambda n: F.nullif(F.regexp_extract(name, r"_palm_([LR])_(N|RL|RR|PU|PD)\.", n), F.lit(""))
    return part(1), part(2)


def palm_pose_key(name: Column) -> Column:
    """The first palm key that the name contains."""
    return F.coalesce(*(F.when(name.contains(k), k) for k in PALM_KEYS))


def find_face_videos(files: DataFrame) -> DataFrame:
    """mp4 files with their bucket: matched, wrong_case, or skipped; other face streams are left out."""
    name = base_name(F.col("path"))
    lower = F.lower(name)
    bucket = F.when(name.rlike(r"\A[0-9]+_face_rgb\.mp4\z"), "matched").when(lower.rlike(r"\A[0-9]+_face_rgb\.mp4\z"), "wrong_case").when(lower.contains("_face_"), F.lit(None)).otherwise("skipped")
    return files.where(lower.endswith(".mp4")).select("path", leading_id(name).alias("volunteer_id"), bucket.alias("bucket")).where("bucket is not null")


def find_palm_images(files: DataFrame) -> DataFrame:
    """Palm images with their bucket: matched or wrong_case."""
    name = base_name(F.col("path"))
    pattern = r"\A[0-9]+_palm_[LR]_(N|RL|RR|PU|PD)\.jpg\z"
    bucket = F.when(name.rlike(pattern), "matched").when(name.rlike("(?i)" + pattern), "wrong_case")
    return files.select("path", leading_id(name).alias("volunteer_id"), bucket.alias("bucket")).where("bucket is not null")


def find_files(files: DataFrame, pattern: str, *, max_depth: int = 5) -> DataFrame:
    """Files whose name fits the pattern in any case, down to a depth; of equal names (in any case) the first met."""
    name = base_name(F.col("path"))
    hits = files.where(name.rlike("(?i)" + pattern) & (depth(F.col("path")) <= max_depth)).withColumn("name", F.lower(name))
    first = W.Window.partitionBy("name").orderBy("walk_seq")
    return hits.withColumn("n", F.row_number().over(first)).where("n = 1").select("path", "name", "walk_seq", leading_id(F.col("name")).alias("volunteer_id"))


def completeness(files: DataFrame) -> DataFrame:
    """Per volunteer: found kinds, missing and duplicated keys in the order of the requirements, and whether all is well."""
    counts = classify(files).where("volunteer_id is not null").groupBy("volunteer_id", "data_key").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("path")).alias("paths"))
    grouped = counts.groupBy("volunteer_id").agg(F.map_from_entries(F.collect_list(F.struct("data_key", "n"))).alias("found"))
    keys = F.array(*map(F.lit, REQUIRED))
    missing = F.filter(keys, lambda k: F.try_element_at("found", k).isNull())
    double = F.filter(keys, lambda k: F.coalesce(F.try_element_at("found", k), F.lit(0)) > 1)
    complete = F.when((F.size(missing) == 0) & (F.size(double) == 0), "COMPLETE").otherwise("INCOMPLETE")
    return grouped.select("volunteer_id", missing.alias("missing"), double.alias("duplicates"), F.size("found").cast("long").alias("found_count"), complete.alias("status"))


def issues(files: DataFrame) -> DataFrame:
    """Long form: (volunteer_id, issue, item, detail), a row per missing key, per duplicated path and per unrecognised file."""
    report = completeness(files)
    named = classify(files)
    absent = report.select("volunteer_id", F.lit("missing").alias("issue"), F.explode("missing").alias("item"), F.lit("").alias("detail"))
    many = named.join(report.select("volunteer_id", F.explode("duplicates").alias("data_key")), ["volunteer_id", "data_key"]).select("volunteer_id", F.lit("duplicate").alias("issue"), F.col("data_key").alias("item"), F.col("path").alias("detail"))
    odd = named.where("data_key is null").select(F.coalesce("guessed_id", F.lit("UNKNOWN")).alias("volunteer_id"), F.lit("unrecognised").alias("issue"), F.col("name").alias("item"), F.col("path").alias("detail"))
    return absent.unionByName(many).unionByName(odd)


def organize_plan(files: DataFrame) -> DataFrame:
    """Where each file goes: one keeper per volunteer and name (the only copy, else the first in the volunteer's own folder),
    others among the duplicates, unrecognised ones apart."""
    named = classify(files).withColumn("own", parent_name(F.col("path")) == F.col("volunteer_id"))
    group = W.Window.partitionBy("volunteer_id", "name")
    ranked = named.withColumns({"copies": F.count("*").over(group), "place": F.row_number().over(group.orderBy(F.desc("own"), "walk_seq"))})
    keeper = (F.col("copies") == 1) | ((F.col("place") == 1) & F.col("own"))
    target = F.when(F.col("data_key").isNull(), F.concat(F.lit("_unrecognised/"), "path")).when(keeper, F.concat_ws("/", "volunteer_id", "name")).otherwise(F.concat(F.col("volunteer_id"), F.lit("_duplicates/"), "path"))
    return ranked.select("path", target.alias("target"), F.when(F.col("data_key").isNull(), "unrecognised").when(keeper, "keeper").otherwise("duplicate").alias("kind"))


def expected_counts(files: DataFrame) -> DataFrame:
    """How many files of each kind a batch will process."""
    name = base_name(F.col("path"))
    return files.agg(F.count_if(name.rlike(r"\A[0-9]+_face_rgb\.mp4\z")).alias("face"), F.count_if(name.rlike(r"\A[0-9]+_palm_[LR]_(N|RL|RR|PU|PD)\.jpg\z")).alias("palm"), F.count_if(name.rlike(r"\A[0-9]+_walk_[FS]\.mp4\z")).alias("walk"))


def allowed_ids(volunteers: DataFrame, limit: int) -> DataFrame:
    """The first volunteers: numeric ids by number, then by text."""
    number = F.expr("try_cast(volunteer_id as bigint)")
    return volunteers.select("volunteer_id").distinct().orderBy(number.isNull(), number, "volunteer_id").limit(limit)


def safe_member(path: Column) -> Column:
    """Whether an archive member stays within the folder that it is unpacked to."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    return ~(p.startswith("/") | p.rlike(r"\A[A-Za-z]:") | p.rlike(r"(\A|/)\.\.(/|\z)") | (p == ""))

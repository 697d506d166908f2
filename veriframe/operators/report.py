"""Roll-ups of check rows: per check, per file and over all files.

Every roll-up is one aggregation on the file's key, partial before the shuffle, so that of the rows of a file and check each task sends
one. Row order matters in two places, the level of a check's first row and its first reason; both are `min_by` over ``row_seq``. These carry
texts, so Spark sorts by the key before it aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from veriframe.functions.status import FAIL, PASS, RANK, REVIEW, SKIP, rank, report_order

FILE = ["volunteer_id", "data_type", "filename"]


@dataclass(frozen=True)
class Aggregation:
    fail_ratio: float = 0.0
    review_ratio: float = 0.0
    per_check: dict[str, float] = field(default_factory=dict)


def count_of(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def worst_status(status: Column) -> Column:
    """The worst of a group's non-empty statuses; SKIP if there is none."""
    return F.coalesce(F.max_by(status, F.when(status != "", rank(status))), F.lit(SKIP))


def first_reason() -> Column:
    """The first reason given, of FAIL rows if there is any, else of REVIEW, SKIP, PASS rows."""
    place = F.when(F.col("status") == FAIL, 0).when(F.col("status") == REVIEW, 1).when(F.col("status") == SKIP, 2).when(F.col("status") == PASS, 3)
    return F.coalesce(F.min_by("reason", F.when((F.col("reason") != "") & place.isNotNull(), F.struct(place, "row_seq"))), F.lit(""))


def limit_of(check: Column, rules: Aggregation) -> Column:
    if not rules.per_check:
        return F.lit(rules.fail_ratio)
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in rules.per_check.items() for x in kv)), check), F.lit(rules.fail_ratio))


def ratio_status(n_pass: Column, n_fail: Column, n_review: Column, fail_max: Column, review_max: Column) -> Column:
    judged = n_pass + n_fail + n_review
    return F.when(judged == 0, SKIP).when(n_fail / judged > fail_max, FAIL).when(n_review / judged > review_max, REVIEW).otherwise(PASS)


def summarize_by_check(rows: DataFrame, rules: Aggregation = Aggregation()) -> DataFrame:
    """One row per file and check: level, final status, counts, the first reason and the ratio that decided."""
    grouped = rows.groupBy(*FILE, "check_name").agg(
        F.min_by("level", "row_seq").alias("check_level"),
        F.count("*").alias("total"),
        *(count_of(s).alias(s.lower()) for s in (PASS, FAIL, REVIEW, SKIP)),
        worst_status(F.col("status")).alias("worst"),
        first_reason().alias("first_reason"),
    )
    n_pass, n_fail, n_review = F.col("pass"), F.col("fail"), F.col("review")
    judged = n_pass + n_fail + n_review
    fail_max = limit_of(F.col("check_name"), rules)
    by_ratio = ratio_status(n_pass, n_fail, n_review, fail_max, F.lit(rules.review_ratio))
    is_frame = F.col("check_level") == "frame"
    used = F.when(by_ratio == REVIEW, n_review).otherwise(n_fail)
    percent = lambda x: F.concat(F.bround(x * 100).cast("long").cast("string"), F.lit("%"))
    note = F.when(is_frame & (judged > 0), F.concat(F.lit(" [judged fail-ratio="), percent(F.try_divide(used, judged)), F.lit(" (max "), percent(fail_max), F.lit(")]"))).otherwise("")
    return grouped.select(
        *FILE, "check_level", "check_name",
        F.when(is_frame, by_ratio).otherwise(F.col("worst")).alias("final_status"),
        "total", "pass", "fail", "review", "skip",
        F.concat("first_reason", note).alias("reason"),
    )


def ordered(items: Column) -> Column:
    return F.transform(F.array_sort(items), lambda x: x["name"])


def first_names(names: Column, title: str, most: int = 10) -> Column:
    more = F.when(F.size(names) > most, F.concat(F.lit(", ... ("), F.size(names).cast("string"), F.lit(" total)"))).otherwise("")
    return F.concat(F.lit(title), F.array_join(F.slice(names, 1, most), ", "), more)


def summarize_overall(checks: DataFrame) -> DataFrame:
    """One row per file from its check summaries: verdict, counts of verdicts, the reason, failed checks with reasons."""
    order = report_order(F.col("check_name"), F.col("check_level"), F.col("data_type"))
    status = F.col("final_status")
    pick = lambda s: F.collect_list(F.when(status == s, F.struct(order.alias("o"), F.col("check_name").alias("name"), F.col("reason").alias("reason"))))
    grouped = checks.groupBy(*FILE).agg(
        worst_status(status).alias("final_status"), F.count("*").alias("total"), *(F.count_if(status == s).alias(s.lower()) for s in (PASS, FAIL, REVIEW, SKIP)),
        pick(FAIL).alias("failed"), pick(REVIEW).alias("reviewed"),
    )
    failed, reviewed = ordered(F.col("failed")), ordered(F.col("reviewed"))
    reason = F.when(F.size("failed") > 0, first_names(failed, "failed checks: ")).when(F.size("reviewed") > 0, first_names(reviewed, "review checks: ")).otherwise("all checks passed")
    detail = F.transform(F.array_sort("failed"), lambda x: F.struct(x["name"].alias("check_name"), x["reason"].alias("reason")))
    return grouped.select(*FILE, "final_status", "total", "pass", "fail", "review", "skip", reason.alias("reason"), failed.alias("failed_checks"), detail.alias("failed_checks_detail"))


def file_statuses(rows: DataFrame, rules: Aggregation = Aggregation()) -> DataFrame:
    """The FILE columns and final_status of `summarize_overall`, for those who need no more. What is aggregated is numbers alone, so Spark hashes in
    both steps and doesn't sort by the keys. Statuses other than the four count as none."""
    checks = rows.groupBy(*FILE, "check_name").agg(
        F.min_by(F.col("level") == "frame", "row_seq").alias("is_frame"), F.max(F.when(F.col("status") != "", rank(F.col("status")))).alias("worst"),
        *(count_of(s).alias(s.lower()) for s in (PASS, FAIL, REVIEW)),
    )
    by_ratio = ratio_status(F.col("pass"), F.col("fail"), F.col("review"), limit_of(F.col("check_name"), rules), F.lit(rules.review_ratio))
    judged = checks.select(*FILE, F.when(F.col("is_frame"), rank(by_ratio)).otherwise(F.greatest("worst", F.lit(0))).alias("worst"))
    names = F.array(*map(F.lit, sorted(RANK, key=RANK.get)))
    return judged.groupBy(*FILE).agg(F.max("worst").alias("worst")).select(*FILE, F.get(names, F.col("worst")).alias("final_status"))


def summarize_timeline(timeline: DataFrame, *, walk: bool = False) -> DataFrame:
    """Frames, gaps and the ranges of the angles per file. A gap is a frame without a face, or without a body."""
    gap = F.col("body_scale").isNull() if walk else ~F.coalesce("face_detected", F.lit(False))
    angles = [] if walk else [f(F.when(F.col("yaw").isNotNull(), F.col(c))).alias(f"{c}_{n}") for c in ("yaw", "pitch") for n, f in (("min", F.min), ("max", F.max))]
    return timeline.groupBy("filename").agg(F.count("*").alias("frames_sampled"), F.count_if(gap).alias("detection_gaps"), *angles)


def overall_record(rows: DataFrame, timeline: DataFrame | None = None, rules: Aggregation = Aggregation()) -> DataFrame:
    """A file's verdict with its failed checks and the summary of its timeline (none: zero frames)."""
    overall = summarize_overall(summarize_by_check(rows, rules))
    if timeline is None:
        return overall
    return overall.join(summarize_timeline(timeline), "filename", "left").fillna(0, ["frames_sampled", "detection_gaps"])


def expand_to_check_rows(records: DataFrame) -> DataFrame:
    """A row per failed check of a failed file; one row with blanks for any other file."""
    base = records.select("data_type", "volunteer_id", "filename", F.col("final_status").alias("overall_status"), F.when(F.upper("final_status") == FAIL, F.col("failed_checks_detail")).alias("detail"))
    opened = base.select("data_type", "volunteer_id", "filename", "overall_status", F.explode_outer("detail").alias("d"))
    return opened.select("data_type", "volunteer_id", "filename", "overall_status", F.coalesce("d.check_name", F.lit("")).alias("check_name"), F.coalesce("d.reason", F.lit("")).alias("reason"))


def in_report_order(checks: DataFrame) -> DataFrame:
    """Check summaries with ``position``, their place in the file's report."""
    order = report_order(F.col("check_name"), F.col("check_level"), F.col("data_type"))
    return checks.withColumn("position", F.row_number().over(W.Window.partitionBy(*FILE).orderBy(order)))


def detail_rows(rows: DataFrame, times: DataFrame) -> DataFrame:
    """Check rows with the time of their frame; the last time given for a frame counts, none gives null."""
    last = times.groupBy("filename", "frame_index").agg(F.max_by("timestamp_sec", "seq").alias("time_sec"))
    return rows.join(last, ["filename", "frame_index"], "left")


def upsert(old: DataFrame, new: DataFrame, keys: list[str] = ["data_type", "volunteer_id", "filename"]) -> DataFrame:
    """Rows of both; for a key in new, only the last of new's (by ``seq``)."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    newest = W.Window.partitionBy(*keys).orderBy(F.desc("__new"), F.desc("seq"))
    return both.withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n", "__new")


def tally(rows: DataFrame) -> DataFrame:
    return rows.groupBy("check_name", "status").count().withColumnRenamed("count", "n")


def error_text(error: Column, most: int = 300) -> Column:
    return F.left(F.trim(F.regexp_replace(error, r"\s+", " ")), F.lit(most))


def error_rows(failures: DataFrame, most: int = 300) -> DataFrame:
    """A FAIL row for each file whose processing broke off; failures: FILE columns and ``error``."""
    text = error_text(F.col("error"), most)
    return failures.select(*FILE, F.lit("video").alias("level"), F.lit("processing_error").alias("check_name"), F.lit(FAIL).alias("status"), text.alias("reason"), F.lit(None).cast("int").alias("frame_index"), F.lit(1).cast("long").alias("row_seq"))

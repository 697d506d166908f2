"""Reading and writing result tables: CSV, JSON and Parquet, with append and upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

SUMMARY_SCHEMA = "data_type string, volunteer_id string, filename string, overall_status string, check_name string, reason string"
ALL_SUMMARY_SCHEMA = "data_type string, volunteer_id string, filename string, overall_status string, failures array<struct<check_name:string,reason:string>>, error string"


def read_csv(spark: SparkSession, path: str, schema: str = SUMMARY_SCHEMA) -> DataFrame | None:
    """A CSV with a header; ids stay text, blanks stay blank. A missing file is None."""
    try:
        return spark.read.csv(path, header=True, schema=schema, quote='"', escape='"', multiLine=True).fillna("")
    except AnalysisException:
        return None


def write_csv(df: DataFrame, path: str, *, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").csv(path, header=True, emptyValue="", quote='"', escape='"')


def read_all_summary(spark: SparkSession, path: str) -> DataFrame:
    """The records of a summary; a missing or broken file has none."""
    schema = T.StructType.fromDDL(ALL_SUMMARY_SCHEMA)
    try:
        # a record that can't be read is null in all columns; its text isn't asked for, so nothing has to be cached
        return spark.read.schema(schema).json(path, multiLine=True, mode="PERMISSIVE").where(F.col("filename").isNotNull())
    except AnalysisException:
        return spark.createDataFrame([], schema)


def load_filename_report(spark: SparkSession, folder: str) -> tuple[str, DataFrame] | None:
    """("json" or "csv", the report of file names) in folder: as JSON if there is one, since that keeps lists, else as CSV with all
    columns as text; None without either."""
    try:
        return "json", spark.read.json(f"{folder}/filenames.json", multiLine=True)
    except AnalysisException:
        pass
    try:
        return "csv", spark.read.csv(f"{folder}/filenames.csv", header=True, quote='"', escape='"', multiLine=True)
    except AnalysisException:
        return None


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def round_texts(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Numbers as text with a fixed number of decimals, ties to even as the printed value has them; null is blank."""
    text = lambda c, n: F.when(F.col(c).isNull(), "").otherwise(F.format_string(f"%.{n}f", F.bround(F.col(c).cast("decimal(38,18)"), n).cast("double")))
    return df.select(*(text(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns))


# Decimals of the columns of a face's and a walk's detail tables.
FACE_DIGITS = {"timestamp_sec": 3, "label_width": 0, "label_height": 0, "yaw": 1, "pitch": 1, "roll": 1, "brightness": 1, "sharpness": 1, "blink_left": 3, "blink_right": 3, "occ_forehead": 2, "occ_left_eye": 2, "occ_right_eye": 2, "occ_nose": 2, "occ_mouth": 2, "occ_left_cheek": 2, "occ_right_cheek": 2}
WALK_DIGITS = {"timestamp_sec": 3, "brightness": 1, "body_width": 0, "body_height_px": 0, "body_scale": 3, "centroid_x": 3}


def detail_header(timeline: DataFrame, *, walk: bool = False) -> DataFrame:
    digits = WALK_DIGITS if walk else FACE_DIGITS
    return round_texts(timeline, {c: n for c, n in digits.items() if c in timeline.columns})


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    {"csv": write_csv, "json": write_json, "parquet": lambda d, p: d.write.mode("overwrite").parquet(p)}[fmt](df, path)

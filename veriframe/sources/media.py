"""Media as tables: file listings, stills, sampled frames, and detectors as pluggable backends.

Decoding and detection are interfaces. A backend is opened once per Python worker and fed batches; a real one (a video
decoder, a landmark model) is imported where it runs, and the tables of an earlier run can stand in for it. Errors never
fail a stage: they come back as a ``reason``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from veriframe.functions import pixels

MEDIA_SCHEMA = "path string, filename string, extension string, readable boolean, width int, height int, fps double, frame_count int, duration_sec double, codec_fourcc string, channel_count int, is_color boolean, meta_reason string"
FRAME_SCHEMA = "path string, frame_index int, timestamp_sec double, timestamp_ms bigint, height int, width int, data binary, reason string"


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length, walk_seq) below root. Contents aren't read: the column is pruned."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length", F.xxhash64("path").alias("walk_seq"))


def known_color(good: F.Column) -> F.Column:
    """Whether a still's pixels have colour: null where it wasn't decoded, false for one channel."""

    @F.pandas_udf("boolean")
    def colored(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
        shaped = (np.frombuffer(d, np.uint8).reshape(h, w, c)[..., :3] if c >= 3 else None for h, w, c, d in zip(height, width, channels, data, strict=True))
        return pd.Series([x is not None and bool(pixels.channels_differ(x)) for x in shaped])

    return F.when(good, colored("height", "width", "nChannels", "data"))


def probe_images(spark: SparkSession, root: str) -> DataFrame:
    """Metadata of stills by Spark's image source; files that don't decode are unreadable."""
    images = spark.read.format("image").option("recursiveFileLookup", True).option("dropInvalid", False).load(root).select("image.*")
    name = F.substring_index("origin", "/", -1)
    good = F.col("height") > 0
    known = lambda c: F.when(good, F.col(c))
    return images.select(
        F.col("origin").alias("path"), name.alias("filename"), F.concat(F.lit("."), F.lower(F.substring_index(name, ".", -1))).alias("extension"), good.alias("readable"),
        known("width").alias("width"), known("height").alias("height"), F.lit(None).cast("double").alias("fps"), F.lit(None).cast("int").alias("frame_count"), F.lit(None).cast("double").alias("duration_sec"),
        F.lit(None).cast("string").alias("codec_fourcc"), known("nChannels").alias("channel_count"), known_color(good).alias("is_color"), F.col("data"), F.when(good, "ok").otherwise("cannot decode").alias("meta_reason"),
    )


class Decoder(Protocol):
    """A video backend."""

    def probe(self, path: str) -> dict: ...

    def frames(self, path: str, indices: list[int]) -> Iterator[tuple[int, int, int, bytes]]:
        """(index, height, width, BGR bytes) of the frames that decode."""
        ...

    def read(self, path: str) -> Iterator[tuple[int, int, int, bytes]]:
        """The same for all frames from the first on, for files whose number of frames or rate is unknown."""
        ...


def probe_videos(files: DataFrame, backend: Callable[[], Decoder]) -> DataFrame:
    """Metadata of each path; a file that the backend can't open is unreadable, with the reason."""
    schema = to_arrow_schema(T.StructType.fromDDL(MEDIA_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = backend()
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                name = path.rsplit("/", 1)[-1]
                row = {"path": path, "filename": name, "extension": "." + name.rsplit(".", 1)[-1].lower(), "readable": False}
                try:
                    row |= {"readable": True, "meta_reason": "ok"} | decoder.probe(path)
                except Exception as e:  # noqa: BLE001  a broken file is a finding, not a failure
                    row["meta_reason"] = " ".join(f"{type(e).__name__}: {e}".split())[:300]
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema)

    return files.select("path").mapInArrow(run, MEDIA_SCHEMA)


def clean_float(x: F.Column) -> F.Column:
    """NaN, infinite and non-positive values are unknown."""
    return F.when(F.isnan(x) | (x <= 0) | (x == float("inf")), None).otherwise(x)


def fourcc(code: F.Column) -> F.Column:
    """A codec's number as its four letters, null unless all are printable."""
    letters = F.concat(*(F.char(F.shiftright(code, 8 * k).bitwiseAND(F.lit(255))) for k in range(4)))
    return F.when(letters.rlike(r"\A[\x20-\x7e]{4}\z"), F.trim(letters))


#: Fixed value: the rate that is assumed where a file has none.
ASSUMED_FPS = 30.0
Frame = tuple[int, float, int, int, bytes]


def sample_indices(frame_count: int, fps: float, sample_fps: float | None = 5, max_frames: int = 10000) -> list[int]:
    """One file's grid, as `operators.metadata.sample_grid` makes it; without a sampling rate every frame."""
    step = max(1, round(fps / sample_fps)) if sample_fps and sample_fps > 0 else 1
    grid = sorted({*range(0, frame_count, step), frame_count - 1})
    return grid[:: -(-len(grid) // max_frames)]


def in_sequence(frames: Iterable[tuple[int, int, int, bytes]], fps: float | None, sample_fps: float | None = 5, max_frames: int = 10000) -> Iterator[Frame]:
    """The first frame at or after each sampling time, of frames read one after the other, up to max_frames."""
    rate, taken = fps if fps and fps > 0 else ASSUMED_FPS, 0
    for index, height, width, data in frames:
        t = index / rate
        if sample_fps and sample_fps > 0 and t + 1e-9 < taken / sample_fps:
            continue
        yield index, t, height, width, data
        taken += 1
        if taken >= max_frames:
            return


def rows_of(path: str, frames: Iterable[Frame]) -> Iterator[tuple]:
    """Rows of FRAME_SCHEMA; a file that breaks off ends with a row of its path and the reason alone."""
    try:
        for index, t, height, width, data in frames:
            yield path, index, t, round(t * 1000), height, width, data, None
    except Exception as e:  # noqa: BLE001  the frames so far count; a file without frames fails its own check
        yield path, None, None, None, None, None, None, " ".join(f"{type(e).__name__}: {e}".split())[:300]


def as_frames(files: DataFrame, read: Callable[[Decoder, dict], Iterable[Frame]], backend: Callable[[], Decoder]) -> DataFrame:
    """Rows of FRAME_SCHEMA of each file (a row with ``path``), one frame a batch, by one backend a worker."""
    schema = to_arrow_schema(T.StructType.fromDDL(FRAME_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = backend()
        for batch in batches:
            for file in batch.to_pylist():
                for row in rows_of(file["path"], read(decoder, file)):
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True))], schema)

    return files.mapInArrow(run, FRAME_SCHEMA)


def sampled_frames(grid: DataFrame, backend: Callable[[], Decoder]) -> DataFrame:
    """Frames at the grid's (path, frame_index, timestamp_sec), one task per group of files. Frames that don't decode are left
    out; a file that breaks off has a row with the reason and no frame."""
    files = grid.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("frame_index", "timestamp_sec"))).alias("grid"))

    def read(decoder: Decoder, file: dict) -> Iterator[Frame]:
        times = {p["frame_index"]: p["timestamp_sec"] for p in file["grid"]}
        for index, height, width, data in decoder.frames(file["path"], list(times)):
            yield index, times[index], height, width, data

    return as_frames(files, read, backend)


def sequential_frames(media: DataFrame, backend: Callable[[], Decoder], *, sample_fps: float | None = 5, max_frames: int = 10000) -> DataFrame:
    """Frames of the files that have no grid (no frame count or rate), read one after the other."""
    unknown = ~F.coalesce((F.col("frame_count") > 0) & (F.col("fps") > 0), F.lit(False))
    read = lambda decoder, file: in_sequence(decoder.read(file["path"]), file["fps"], sample_fps, max_frames)
    return as_frames(media.where(unknown).select("path", "fps"), read, backend)


def detect(frames: DataFrame, backend: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """Observations of a detector that is created once per worker and called once per batch of frames; rows without one are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = backend()
        for batch in batches:
            yield detector(batch)

    return (frames.where("data is not null") if "data" in frames.columns else frames).mapInPandas(run, schema)


def observe(frames: DataFrame, backend: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str, capability: str, *, skips: bool = True) -> DataFrame:
    """Observations as `detect` makes them, with an error arm: no frame is lost, and no error ends the job.

    The result has the columns of schema (``path`` and ``frame_index`` among them), ``error`` and ``lacks``:

    * a frame that wasn't decoded (``reason``) keeps its place, with the reason as its error;
    * a detector that can't be made (no model bundle, no library) leaves ``lacks`` = {capability: "<capability> model bundle unavailable"};
    * one that fails on a batch is asked again for ever smaller parts of it, and a single frame that it fails on has
      {capability: "<capability> detection error: ..."}, or, if ``skips`` is false, that text as its error.
    """
    whole = T.StructType([*T.StructType.fromDDL(schema), *T.StructType.fromDDL("error string, lacks map<string,string>")])
    arrow, names = to_arrow_schema(whole), T.StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector, missing = None, None
        try:
            detector = backend()
        except (ImportError, FileNotFoundError):
            missing = f"{capability} model bundle unavailable"

        def bare(rows: pd.DataFrame, **more) -> list[dict]:
            return [{c: r[c] for c in ("path", "frame_index")} | more for r in rows[["path", "frame_index"]].to_dict("records")]

        def seen(rows: pd.DataFrame) -> list[dict]:
            try:
                return detector(rows)[names].to_dict("records")
            except Exception as e:  # noqa: BLE001  what a detector can't do is a finding
                if len(rows) > 1:
                    half = len(rows) // 2
                    return seen(rows.iloc[:half]) + seen(rows.iloc[half:])
                text = " ".join(f"{capability} detection error: {type(e).__name__}: {e}".split())[:300]
                return bare(rows, lacks=[(capability, text)]) if skips else bare(rows, error=text)

        for batch in batches:
            rows = batch.to_pandas()
            undecoded = rows["data"].isna() if "data" in rows else pd.Series(False, rows.index)
            out = [x | {"error": why} for why, x in zip(rows[undecoded].get("reason", []), bare(rows[undecoded]), strict=True)]
            out += bare(rows[~undecoded], lacks=[(capability, missing)]) if missing else seen(rows[~undecoded]) if (~undecoded).any() else []
            clean = [{k: None if isinstance(v, float) and pd.isna(v) else v for k, v in r.items()} for r in out]
            yield pa.RecordBatch.from_pylist(clean, arrow)

    return frames.mapInArrow(run, whole)


class FrameSource(DataSource):
    """``spark.read.format("frames")``: a partition per path of the option ``paths`` (newline-separated), read by the
    backend ``module:function`` in the option ``backend``."""

    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return FRAME_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FrameReader(dict(self.options))


class FrameReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.options["paths"].split("\n")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import importlib

        module, function = self.options["backend"].split(":")
        decoder, path = getattr(importlib.import_module(module), function)(), partition.value
        meta = decoder.probe(path)
        n, fps, sample_fps = meta.get("frame_count"), meta.get("fps"), float(self.options.get("samplefps", "5"))
        if n and n > 0 and fps and fps > 0:
            yield from rows_of(path, ((i, i / fps, *rest) for i, *rest in decoder.frames(path, sample_indices(n, fps, sample_fps))))
        else:
            yield from rows_of(path, in_sequence(decoder.read(path), fps, sample_fps))


def load_config(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def required_patterns(config: dict) -> dict[str, str]:
    """Required file names of a configuration with patterns that Java reads: named groups become plain ones."""
    found = config.get("filenames", {}).get("required") or {}
    if not found:
        raise ValueError("no required file names are configured")
    out = {}
    for key, pattern in found.items():
        if "volunteer_id" not in re.compile(pattern).groupindex:
            raise ValueError(f"{key}: the pattern has no group volunteer_id")
        out[key] = re.sub(r"\(\?P<\w+>", "(", pattern).replace(r"\d", "[0-9]")
    return out

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words are maximal runs of anything but space and TAB..CR (plain ASCII white space).
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ascii_lower(text: str) -> str:
    """Lower-cases A-Z only. (str.lower() also changes other letters, and lengths.)"""
    return text.lower() if text.isascii() else text.translate(LOWER)


def ascii_lower_col(col: Column) -> Column:
    """Lower-cases A-Z only, in the JVM."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``. Only where none is set and everything runs on one machine
    (tests, notebooks) a temporary folder is used; elsewhere executors would write to disks of their own."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = context.getConf().get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """df, computed once and written as a table to the shared folder; its lineage ends there.

    (`checkpoint()` would compute it twice: once to count it and once to write it.)
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """df with its columns named c0, c1 and so on, so that working columns can't clash with them."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns))))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that few texts are held as Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def trim() -> None:
    """Gives freed memory back to the system, which the C library would keep for the worker."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


_held: dict = {}


def held(key: tuple | None, make: Callable | None = None):
    """The one large model of a Python worker: kept for the next tasks that ask for the same, given up, with its memory, when a
    task asks for another one (or, with key None, for none). So models of successive stages don't add up in reused workers."""
    if key not in _held:
        if _held:
            _held.clear()
            gc.collect()
            trim()
        if key is None:
            return None
        _held[key] = make()
    return _held[key]

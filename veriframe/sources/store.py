"""A store of results in hash buckets, with versions.

Rows are kept in ``buckets`` by the hash of one column (the volunteer). A version is a manifest: for each bucket, the folder that holds
it. A merge reads and rewrites the buckets that new rows fall into, and the next manifest names the others' folders as they are; a
lookup of one volunteer reads one bucket. Folders and manifests are written once, under names of their own, and a version counts
when its manifest is whole: a broken merge leaves folders that no manifest names, and is simply run again.

A version that isn't there, or not whole, is an error (`LostVersion`) and never an empty store: only version 0 begins with nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


class LostVersion(RuntimeError):
    pass


@dataclass(frozen=True)
class ResultStore:
    spark: SparkSession
    root: str
    schema: str
    #: What buckets are made by.
    key: str = "volunteer_id"
    buckets: int = 64

    def bucket(self, value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(self.buckets)).cast("int")

    def manifest(self, version: int) -> dict[int, str] | None:
        """The folder of each bucket that has rows; None if there is no such version."""
        try:
            rows = self.spark.read.schema("bucket int, folder string, of int").json(f"{self.root}/manifests/version={version}").collect()  # a row a bucket
        except AnalysisException:
            return None
        if not rows or len(rows) != rows[0].of:
            return None
        return {r.bucket: r.folder for r in rows if r.folder}

    def latest(self) -> int | None:
        """The highest version that is whole."""
        try:
            found = self.spark.read.json(f"{self.root}/manifests").select("version").distinct().collect()  # a row a version
        except AnalysisException:
            return None
        return next((v for v in sorted((r.version for r in found), reverse=True) if self.manifest(v) is not None), None)

    def folders(self, version: int) -> dict[int, str]:
        found = self.manifest(version)
        if found is None:
            raise LostVersion(f"{self.root} has no whole version {version}")
        return found

    def rows(self, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromDDL(self.schema)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        version = self.latest() if version is None else version
        return self.rows([] if version is None else sorted(set(self.folders(version).values())))

    def lookup(self, value: str, version: int | None = None) -> DataFrame:
        """The rows of one key, from its bucket alone."""
        version = self.latest() if version is None else version
        folders = {} if version is None else self.folders(version)
        number = self.spark.range(1).select(self.bucket(F.lit(value)).alias("b")).first().b
        return self.rows([folders[number]] if number in folders else []).where(F.col(self.key) == value)

    def merge(self, new: DataFrame, version: int, keys: list[str]) -> None:
        """Version number ``version``: the one before with new's rows in place of those of equal keys. Done again, it changes nothing."""
        if self.manifest(version) is not None:
            return
        before = self.folders(version - 1) if version else {}
        new = new.select(*T.StructType.fromDDL(self.schema).names)
        touched = sorted(r.b for r in new.select(self.bucket(F.col(self.key)).alias("b")).distinct().collect())  # at most `buckets`
        old = self.rows([before[b] for b in touched if b in before])
        same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
        kept = old.alias("o").join(new.select(*keys).distinct().alias("n"), same, "left_anti")
        merged = kept.unionByName(new).withColumn("bucket", self.bucket(F.col(self.key)))
        folder = f"{self.root}/data/{version}-{uuid.uuid4().hex}"
        # rows of a bucket go to as many tasks as they fill, not to one
        merged.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
        after = before | {b: f"{folder}/bucket={b}" for b in touched}
        rows = [(b, after[b], max(1, len(after))) for b in sorted(after)] or [(None, None, 1)]
        self.spark.createDataFrame(rows, "bucket int, folder string, of int").coalesce(1).write.mode("overwrite").json(f"{self.root}/manifests/version={version}")

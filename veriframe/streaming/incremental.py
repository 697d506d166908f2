"""Incremental mode: check rows arrive as files, each micro-batch is rolled up and merged into the summary by file.

A file's rows arrive together, so no state crosses batches; the merge replaces what an earlier run had for the same file. The summary is a
`sources.store.ResultStore`: a batch rewrites the buckets that its volunteers fall into, a batch that is run again after a failure
changes nothing, and a batch whose predecessor is lost is an error.

`Progress` tells how far a run is, from metrics that Spark observes while it processes: no second pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from veriframe.operators import report as R
from veriframe.sources.store import ResultStore
from veriframe.sources.tables import SUMMARY_SCHEMA

ROWS_SCHEMA = "volunteer_id string, data_type string, filename string, level string, check_name string, status string, reason string, frame_index int, row_seq bigint"


def store(spark: SparkSession, out: str, buckets: int = 64) -> ResultStore:
    return ResultStore(spark, out, SUMMARY_SCHEMA, buckets=buckets)


def version(spark: SparkSession, out: str, number: int) -> DataFrame:
    return store(spark, out).read(number)


def merge_batch(batch: DataFrame, number: int, out: str, rules: R.Aggregation) -> None:
    new = R.expand_to_check_rows(R.summarize_overall(R.summarize_by_check(batch, rules))).persist()  # used more than once, observed once
    try:
        store(batch.sparkSession, out).merge(new, number, R.FILE)
    finally:
        new.unpersist()


@dataclass
class Progress(StreamingQueryListener):
    """Files and failed files so far, of ``total`` (None: unknown), as the batches of the query ``name`` end. ``tell`` is called at each."""

    name: str
    total: int | None = None
    done: int = 0
    failed: int = 0
    tell: object = None

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None and seen.files is not None:
            self.done, self.failed = self.done + seen.files, self.failed + seen.failed
            if self.tell:
                self.tell(self)

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    @property
    def text(self) -> str:
        share = f" ({100 * self.done // self.total}%)" if self.total else ""
        return f"{self.done}/{'?' if self.total is None else self.total} files{share}, {self.failed} failed"


def follow(spark: SparkSession, rows_dir: str, out: str, checkpoint: str, rules: R.Aggregation = R.Aggregation(), *, files_per_batch: int = 1000, name: str = "check_rows") -> StreamingQuery:
    """Merges what has arrived. Observed under ``name``: ``files`` (each has one metadata row of its container, or the row of its error) and
    ``failed`` (those among them with a FAIL)."""
    stream = spark.readStream.schema(ROWS_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(rows_dir)
    opening = F.col("check_name").isin("check_container", "processing_error")
    stream = stream.observe(name, F.count_if(opening).alias("files"), F.count_if(opening & (F.col("status") == "FAIL")).alias("failed"))
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: merge_batch(df, n, out, rules))
    return writer.trigger(availableNow=True).start()


def live_tally(spark: SparkSession, rows_dir: str) -> DataFrame:
    """A running count of statuses per check over a stream of check rows."""
    return spark.readStream.schema(ROWS_SCHEMA).parquet(rows_dir).groupBy("check_name", "status").agg(F.count("*").alias("n"))

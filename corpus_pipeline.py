"""From raw documents to token ids: five stages, each over all that the stage before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
`run` applies them in turn, writing each stage's result to the shared checkpoint folder and reading it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.llm import bpe, decontam, importance, line_dedup, similar, simhash
from veriframe.llm.common import saved, table


def recounted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is such a column, follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the importance weights or the toxicity ratio reject."""
    return importance.scored(docs, importance.fit(docs, table(spark, sf_dir, "labels")), only_kept=True)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that too many of a source's documents share, but for one of them; then drops documents whose clean
    text is similar to another's by 0.8 or more (the next stage drops only what is within 4 bits, as op5 does)."""
    return similar.keep_one(saved(recounted(line_dedup.drop_boilerplate(docs, whole_copies=True))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out passages of test items, and drops documents that are mostly such."""
    return recounted(decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids: packed little-endian unsigned 32-bit integers, decoded: the text that they stand for)."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("BPE encoding and decoding", tokenize),
]

#: SQL can't express the stages; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

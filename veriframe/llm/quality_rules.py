"""Quality rules with an isolation forest over their statistics.

Each text gets rule statistics. Those of length and of repeated lines and word windows feed two plain rules that fail a document
outright. Five others, none of which depends on the text's length, go to an isolation forest, which judges them together: symbols, stuttered words and
marks a word (as logarithms, so that rare large values don't take all splits), characters a word, and the mean share of distinct words in segments of
``SEGMENT`` words. Trees of random splits isolate unusual documents after few steps, so a short mean path means an anomaly. Samples are small
(64 rows a tree), so that bad documents don't hide each other. The forest is grown on, and its
threshold set from, at most ``max_labels`` labelled rows (those with the smallest hashes): the threshold is the
anomaly score that all but ``reject_clean`` of held-out good rows stay under.

Statistics and verdicts of a document depend on it alone, so nothing is shuffled; the forest has a fixed size.
Repeated windows are found exactly, by ranking words, then pairs, fours and eights of them.

Defined cases: a null or empty text has zero statistics and fails the length rule; rows with null ids or labels don't teach;
contradictory labels of a document count as bad; of rows that share a labelled id the smallest statistics teach; ids may be of any type; without good labels the forest rejects nothing; repeated rows
are judged each; extra columns don't matter; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.common import field_type, held, slices, table
from veriframe.llm.importance import Labels, key_of, labelled

SYMBOLS = b"#*$%&|<>"
MARKS = b"!?"
#: Words of a segment; a rest of fewer words has no part in the share of distinct words, unless it is the whole text.
SEGMENT = 20
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(ids: np.ndarray) -> int:
    """How many words lie in windows of 8 words that occur twice or more."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    rank, width = ids.astype(np.int64), 1
    while width < WINDOW:
        _, rank = np.unique(rank[:-width] << 32 | rank[width:], return_inverse=True)
        width *= 2
    many = np.bincount(rank)[rank] > 1
    if not many.any():
        return 0
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[: len(many)] += many
    edges[WINDOW : WINDOW + len(many)] -= many
    return int((np.cumsum(edges)[:-1] > 0).sum())


def distinct_share(ids: np.ndarray) -> float:
    """The mean share of distinct words in whole segments."""
    size = min(SEGMENT, len(ids))
    ordered = np.sort(ids[: len(ids) // size * size].reshape(-1, size), axis=1)
    return 1 - float((ordered[:, 1:] == ordered[:, :-1]).mean(axis=0).sum()) / size if size > 1 else 1.0


def statistics(text: bytes | None) -> tuple[list[int], list[float]]:
    """The counts of COUNTS, and the forest's features."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0, 0, len(text or b"") - len((text or b"").translate(None, SYMBOLS)), 0, 0], [0.0] * 5
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    joined = b"".join(words)
    chars = int(((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80).sum())
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeated = repeated_words(ids)
    least = max(n, 1)
    marks = len(joined) - len(joined.translate(None, MARKS))
    often = [float(np.log1p(20 * x / least)) for x in (symbols, int((ids[1:] == ids[:-1]).sum()), marks)]
    features = [*often, chars / least, distinct_share(ids)]
    return [n, chars, symbols, dup, repeated], features


@dataclass
class Forest:
    """Trees as arrays: feature (-1 in a leaf), split, left child (right is next), path length at a leaf."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    path: np.ndarray
    usual: float
    limit: float = np.inf

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the higher, the more unusual."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, split, child, path in zip(self.feature, self.split, self.child, self.path, strict=True):
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                at = np.where(inner, child[at] + (x[rows, np.maximum(f, 0)] >= split[at]), at)
            total += path[at]
        return 2.0 ** (-total / len(self.feature) / self.usual)


def mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int, sample: int, seed: int) -> Forest:
    rng = np.random.default_rng(seed)
    sample = min(sample, len(x))
    deepest, size = int(np.ceil(np.log2(max(sample, 2)))), 2 * sample + 1
    feature, child = np.full((trees, size), -1), np.zeros((trees, size), np.int64)
    split, path = np.zeros((trees, size)), np.zeros((trees, size))
    for t in range(trees):
        todo, free = [(0, x[rng.choice(len(x), sample, replace=False)], 0)], 1
        while todo:
            at, part, depth = todo.pop()
            if depth >= deepest or len(part) < 2:  # a split between values that nearly agree may leave one side empty
                path[t, at] = depth + mean_path(len(part))
                continue
            low, high = part.min(axis=0), part.max(axis=0)
            open_ = np.flatnonzero(high > low)
            if not len(open_):
                path[t, at] = depth + mean_path(len(part))
                continue
            f = int(rng.choice(open_))
            s = rng.uniform(low[f], high[f])
            right = part[:, f] >= s
            feature[t, at], split[t, at], child[t, at] = f, s, free
            todo += [(free, part[~right], depth + 1), (free + 1, part[right], depth + 1)]
            free += 2
    return Forest(feature, split, child, path, max(mean_path(sample), 1e-9))


def base_failed(counts: list[int]) -> bool:
    return counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED * counts[0]


def labelled_statistics(docs: DataFrame, known: Labels, id_col: str, text_col: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the labelled rows (at most so many as there are labels), in the order of their ids; good; fit."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        known = shared.value
        for batch in slices(batches):
            at = known.find(batch.column(0))
            mine = np.flatnonzero(at >= 0)
            some = [statistics(t) for t in batch.column(1).take(pa.array(mine, pa.int64())).cast(pa.binary()).to_pylist()]
            keep = [k for k, (c, _) in enumerate(some) if not base_failed(c)]
            yield pa.RecordBatch.from_arrays([pa.array(at[mine[keep]], pa.int64()), pa.array([some[k][1] for k in keep], pa.list_(pa.float64()))], names=["at", "x"])

    found = docs.select(key_of(F.col(id_col)), F.col(text_col).cast("string")).mapInArrow(run, "at bigint, x array<double>")
    rows = sorted(found.groupBy("at").agg(F.min("x")).collect())  # of rows that share an id, the smallest statistics
    at = np.array([r[0] for r in rows], np.int64)
    return np.array([r[1] for r in rows], float).reshape(len(rows), len(statistics(None)[1])), known.good[at], known.fit[at]


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_labels: int = 20_000, trees: int = 200, sample: int = 64, reject_clean: float = 0.003, seed: int = 5) -> Forest | None:
    """The forest with its limit, or None if no good row is labelled."""
    x, good, fitting = labelled_statistics(docs, labelled(labels, max_labels), id_col, text_col)
    held = good & ~fitting
    if not fitting.any() or not held.any():
        return None
    forest = grow(x[fitting], trees, sample, seed)
    forest.limit = float(np.quantile(forest.score(x[held]), 1 - reject_clean)) + 1e-9
    return forest


def judge(docs: DataFrame, forest: Forest | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts, base_failed, anomaly, kept) of each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    schema = T.StructType([T.StructField(id_col, field_type(docs, id_col)), *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("base_failed", T.BooleanType()), T.StructField("anomaly", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        forest = shared.value
        for batch in slices(batches, 2000):
            found = [statistics(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            failed = np.array([base_failed(c) for c, _ in found], bool)
            odd = forest.score(np.array([f for _, f in found])) if forest else np.zeros(len(found))
            kept = ~failed & (odd <= forest.limit if forest else True)
            counts = [pa.array([c[k] for c, _ in found], pa.int64()) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(failed), pa.array(odd, pa.float64()), pa.array(kept)], names=names)

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels")))

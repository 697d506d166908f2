"""Periodic runs of words, by a dictionary of basic factors.

The basic factors of a text are its stretches of 1, 2, 4, ... words; equal factors of one length get one name, made from the names of
their halves. A factor can only repeat if both of its halves do, so only such places are sorted at each length, and the
lengths end where nothing repeats.

At each length m the next occurrence of a factor that lies within 2m words, both included, is d <= m words on. Places in a
row with the same d are one arithmetic progression of occurrences: from the first such place s to the last, e, words d apart are
identical, and this proposes the period d for the words from s to e + m + d. In a stretch of 3d words or more with smallest period
d a factor of d words or more recurs at multiples of d only, so d is the smallest period, and the stretch can't be extended, if the
next occurrence is taken; a run of period q is found at every length from q to its own length less q, and kept once.

Texts are taken many at a time, joined by marks that never repeat, so that sorting works on long arrays. No shuffle: a text is one row.

Defined cases: null and empty texts have no words, no runs and the digests of nothing; rows aren't merged, whatever their ids; extra
columns don't matter; a text is held whole by its task (some 60 bytes a word), and nothing else grows with it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.common import slices, table

#: A run has LEAST words and TIMES periods, or more.
LEAST, TIMES = 24, 3
#: Words that are taken at once, more only for one longer text.
WORDS = 200_000


def named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order: places sorted by key and place, name of each of these, whether its key is there twice or more)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    again = ~new
    again[:-1] |= ~new[1:]
    return order, np.cumsum(new) - 1, again


def proposals(names: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(start, length, period) of the stretches that each length of factor proposes. names: of the single words."""
    m, n = 1, len(names)
    at, keys = np.arange(n), names.astype(np.int64)
    while len(at) > 1:
        order, name, again = named(keys)
        order, name = order[again], name[again]
        place = at[order]
        step = place[1:] - place[:-1]
        close = (name[1:] == name[:-1]) & (step <= m)
        start, by = place[:-1][close], step[close]
        if len(start):
            line = np.lexsort((start, by))
            start, by = start[line], by[line]
            ends = np.flatnonzero(np.concatenate([(by[1:] != by[:-1]) | (start[1:] != start[:-1] + 1), [True]]))
            firsts = np.concatenate([[0], ends[:-1] + 1])
            yield start[firsts], start[ends] - start[firsts] + m + by[firsts], by[firsts]
        names = np.full(n + m, -1, np.int64)
        names[place] = name
        at = np.sort(place)
        at = at[names[at + m] >= 0]
        keys = names[at] * n + names[at + m]
        m *= 2


def runs_of(names: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of all runs, by start and period."""
    found = []
    for start, length, period in proposals(names):
        long = length >= np.maximum(least, times * period)
        found.append(np.stack([start[long], length[long], period[long]], axis=1))
    if not found:
        return np.zeros((0, 3), np.int64)
    return np.unique(np.concatenate(found)[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def runs_in(texts: list[list[bytes]]) -> Iterator[np.ndarray]:
    """The runs of each text, taken together."""
    numbers: dict[bytes, int] = {}
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    names = np.empty(int(sizes.sum()), np.int64)
    starts = np.cumsum(sizes) - sizes
    for s, words in zip(starts.tolist(), texts, strict=True):
        names[s : s + len(words)] = [numbers.setdefault(w, len(numbers)) for w in words]
    names[starts + sizes - 1] = len(numbers) + np.arange(len(texts))  # marks
    found = runs_of(names)
    cut = np.searchsorted(found[:, 0], np.append(starts, len(names)))
    for k, s in enumerate(starts.tolist()):
        yield found[cut[k] : cut[k + 1]] - [s, 0, 0]


def kept_words(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without the repetitions: a run's words after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def strongest(runs: np.ndarray) -> list[int]:
    """The run with the greatest length / period, the first of equal ones."""
    best = runs[0].tolist()
    for start, length, period in runs[1:].tolist():
        if length * best[2] > best[1] * period:
            best = [start, length, period]
    return best


def own_words(key, text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def find_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words_of: Callable = own_words) -> DataFrame:
    """(id, runs: array of (start, length, period) in words, strongest: one of them or null, collapsed: the text with each run's first
    period only, its words joined by one space) of each row. words_of: what takes a row's id and its text (UTF-8) to words."""
    run_type = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("runs", T.ArrayType(run_type)), T.StructField("strongest", run_type), T.StructField("collapsed", T.StringType())])
    arrow_run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def records(runs: np.ndarray) -> list[dict]:
        return [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, first, size = [], 0, 0
            column = batch.column(1).cast(pa.binary())
            for k, (key, text) in enumerate(zip(batch.column(0), column, strict=True)):
                words = words_of(key.as_py(), text.as_py())
                if size and size + len(words) > WORDS:
                    yield answers(batch.column(0).slice(first, k - first), texts)
                    texts, first, size = [], k, 0
                texts.append(words)
                size += len(words)
            yield answers(batch.column(0).slice(first, len(texts)), texts)

    def answers(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = list(runs_in(texts))
        best = [records(np.array([strongest(r)]))[0] if len(r) else None for r in found]
        kept = [b" ".join(kept_words(words, r)) for words, r in zip(texts, found, strict=True)]
        columns = [ids, pa.array([records(r) for r in found], pa.list_(arrow_run)), pa.array(best, arrow_run), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def with_tail(key, text: bytes | None) -> list[bytes]:
    """The words of a text; for about every tenth id its last part is made to repeat, by rule, so that runs of many periods exist."""
    words = own_words(key, text)
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's number of runs, its strongest run and the digests of all runs and of the collapsed text."""
    found = find_runs(table(spark, sf_dir, "documents"), words_of=with_tail)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.start.alias("start"), best.length.alias("length"), best.period.alias("period"),
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))

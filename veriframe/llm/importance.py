"""Quality classifier by importance resampling over hashed n-grams.

Two generative models over hashed word unigrams and bigrams are counted: one of target text (documents labelled good
and not toxic) and one of all raw text. A document's log importance weight is the sum over its n-grams of
log(target / raw). Divided by the number of n-grams (and ``PRIOR`` more), and multiplied by the sharpness ``SHARP``, it becomes a
key; Gumbel noise, a fixed function of the document's id, is added, so that the k largest keys are a sample without
replacement, in proportion to the exponentials of the sharpened weights. The labels give k: it is the number of documents whose
normalised weight (without noise) is within the limit that all but ``reject_clean`` of the held-out good documents are within. The
k-th key is found by histograms, without a global sort (`kth_largest`); rows that tie with it stay. Noise decides near the limit only:
its spread is about 1, against keys of some -12 there and of -140 in the middle of bad documents.

Toxicity is a filter of its own, beside the resampling (`not_toxic`). Its score is the sum over a document's distinct words of the
smoothed log-odds of their presence in toxic against other labelled documents. Words count whose log-odds, less ``ERRORS``
standard errors, exceed a gate, so that a word in five toxic documents and in no other can tell as well as a frequent one; of the
``GATES``, the one is taken with which most held-out toxic documents exceed the limit. The limit is set in the same way as
for the weights. (`toxic_recall` gives the share of held-out toxic documents that are rejected.)

Cost: one pass that counts (a vector of ``BUCKETS`` counts per task, added up by slices), one over the labelled sample,
one that scores and writes the keys; for whole rows, one more that scores again. No text is shuffled. The labelled rows used are at most ``max_labels``, those with
the smallest hashes; half of them fit the models, the others set the limits. The raw model counts every document.

Defined cases: null and empty texts have no n-grams and weight 0; ids may be of any type; a null id has the noise of the id
"None"; contradictory labels of one document count as bad, or as toxic; rows with null ids or labels don't teach; without good
labels everything is kept; repeated rows count each; rows that share an id have one label; no rows give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.common import held, numbered, saved, slices, table

BUCKETS, SLICES = 1 << 16, 64
#: Runs of letters and digits, and runs of other characters.
TOKEN = re.compile(rb"[A-Za-z0-9_\x80-\xff]+|[^A-Za-z0-9_\x80-\xff\s]+")
SMOOTH, SEED = 1.0, 17
#: N-grams of weight 0 that each text gets; and the sharpness: what a normalised weight is multiplied by before noise is added.
PRIOR, SHARP = 20.0, 100.0
#: A word tells of toxicity if its log-odds less so many standard errors exceed the gate.
ERRORS, GATES = 2.0, (1.0, 1.5, 2.0, 2.5, 3.0)


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = h = zlib.crc32(word)
        return h


def buckets_of(text: bytes | None, hashes: Hashes) -> np.ndarray:
    """The buckets of a text's unigrams and bigrams."""
    words = TOKEN.findall(text) if text else []
    a = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        one = a * np.uint64(0x9E3779B97F4A7C15)
        two = one[:-1] + a[1:] * np.uint64(0xBF58476D1CE4E5B9)
        two ^= two >> np.uint64(31)
        two *= np.uint64(0x94D049BB133111EB)
    return (np.concatenate([one, two]) >> np.uint64(48)).astype(np.int64)


def words_of(buckets: np.ndarray) -> np.ndarray:
    """The distinct unigrams' buckets of buckets_of's."""
    return np.unique(buckets[: (len(buckets) + 1) // 2])


@dataclass
class Labels:
    """A bounded sample of labelled documents: sorted keys of their ids, and whether good, toxic, and for fitting."""

    keys: np.ndarray
    good: np.ndarray
    toxic: np.ndarray
    fit: np.ndarray
    ids: list[str]

    def find(self, keys: pa.Array) -> np.ndarray:
        """The place of each key, or -1."""
        x = keys.fill_null(0).to_numpy(zero_copy_only=False)
        if not len(self.keys):
            return np.full(len(x), -1)
        at = np.minimum(np.searchsorted(self.keys, x), len(self.keys) - 1)
        return np.where((self.keys[at] == x) & ~np.asarray(keys.is_null()), at, -1)


def key_of(doc_id: Column) -> Column:
    """By what labels and documents find each other, for ids of any type: a 64-bit hash of the id as text; null for null."""
    return F.when(doc_id.isNotNull(), F.xxhash64(doc_id.cast("string")))


def labelled(labels: DataFrame, max_labels: int) -> Labels:
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy(key_of(F.col("doc_id")).alias("key"), F.col("doc_id").cast("string").alias("id"))
    rows = known.agg((F.min("quality") > 0).alias("good"), (F.max("toxic") > 0).alias("toxic")).orderBy("key").limit(max_labels).collect()
    fit = np.array([xxhash.xxh64_intdigest(r.id, SEED) & 1 for r in rows], bool)
    return Labels(np.array([r.key for r in rows], np.int64), np.array([r.good for r in rows], bool), np.array([r.toxic for r in rows], bool), fit, [r.id for r in rows])


@dataclass
class Model:
    """Weights by bucket, and the limits that the labels set: for normalised weights, and for toxicity."""

    ratio: np.ndarray
    toxic: np.ndarray
    least: float = -np.inf
    most_toxic: float = np.inf

    def score(self, text: bytes | None, hashes: Hashes) -> tuple[int, float, float | np.ndarray]:
        f = buckets_of(text, hashes)
        return len(f), float(self.ratio[f].sum()), self.toxic[words_of(f)].sum(axis=0)


def normal(weight: float, n: int) -> float:
    """A log weight for each n-gram; PRIOR n-grams of weight 0 are added, so that short texts don't go far."""
    return weight / (n + PRIOR)


def noise(doc_id) -> float:
    """Gumbel noise, always the same for an id."""
    u = (xxhash.xxh64_intdigest(str(doc_id), SEED + 1) + 0.5) / 2.0**64
    return float(-np.log(-np.log(u)))


def count_ngrams(docs: DataFrame, labels: Labels, id_col: str, text_col: str) -> np.ndarray:
    """5 x BUCKETS: n-grams by bucket of raw and target text; toxic and all labelled documents by bucket of their words; in
    the first two places of the last row, toxic and all labelled documents."""
    shared = docs.sparkSession.sparkContext.broadcast(labels)
    kinds = [pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        known, hashes = shared.value, Hashes()
        counts = np.zeros((5, BUCKETS), np.int64)
        for batch in batches:
            at = known.find(batch.column(0))
            for start in range(0, batch.num_rows, 1000):
                for k, text in enumerate(batch.column(1).slice(start, 1000).cast(pa.binary()).to_pylist(), start):
                    if not text:
                        continue
                    found = buckets_of(text, hashes)
                    c = np.bincount(found, minlength=BUCKETS)
                    counts[0] += c
                    if at[k] >= 0 and known.fit[at[k]]:
                        if known.good[at[k]] and not known.toxic[at[k]]:
                            counts[1] += c
                        words = words_of(found)
                        counts[3, words] += 1
                        counts[4, 1] += 1
                        if known.toxic[at[k]]:
                            counts[2, words] += 1
                            counts[4, 0] += 1
        if counts[0].any():
            parts = counts.reshape(5, SLICES, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), kinds[0]), pa.array([parts[:, s].tobytes() for s in range(SLICES)], kinds[1])], names=["slice", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in group.column("counts").to_pylist())
        return pa.table([group.column("slice")[:1].cast(pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slice", "counts"])

    schema = "slice int, counts binary"
    out = np.zeros((5, SLICES, BUCKETS // SLICES), np.int64)
    for row in docs.select(key_of(F.col(id_col)), F.col(text_col).cast("string")).mapInArrow(run, schema).groupBy("slice").applyInArrow(add, schema).collect():  # SLICES rows
        out[:, row.slice] = np.frombuffer(row.counts, np.int64).reshape(5, -1)
    return out.reshape(5, BUCKETS)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_labels: int = 40_000, reject_clean: float = 0.003) -> Model:
    known = labelled(labels, max_labels)
    raw, target, toxic, both, docs_of = count_ngrams(docs, known, id_col, text_col).astype(float)
    model = Model(np.zeros(BUCKETS), np.zeros(BUCKETS))
    if not target.any():
        return model
    share = lambda c: np.log((c + SMOOTH) / (c.sum() + SMOOTH * BUCKETS))
    model.ratio = share(target) - share(raw)
    n_toxic, other, n_other = docs_of[0], both - toxic, docs_of[1] - docs_of[0]
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
    errors = np.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))
    gated = [np.where((odds - ERRORS * errors > g) & (n_toxic > 0), odds, 0.0) for g in GATES]
    model.toxic = np.stack(gated, axis=1)
    shared = docs.sparkSession.sparkContext.broadcast((known, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        known, model = shared.value
        hashes = Hashes()
        for batch in batches:
            at = known.find(batch.column(0))
            mine = np.flatnonzero(at >= 0)
            mine = mine[(~known.fit & (known.good | known.toxic))[at[mine]]]
            if len(mine):
                found = [model.score(t, hashes) for t in batch.column(1).take(pa.array(mine)).cast(pa.binary()).to_pylist()]
                scores = [pa.array([x[2][k] for x in found]) for k in range(len(GATES))]
                yield pa.RecordBatch.from_arrays([pa.array(known.toxic[at[mine]]), pa.array([normal(w, n) for n, w, _ in found]), *scores], names=names)

    names = ["bad", "weight", *(f"s{k}" for k in range(len(GATES)))]
    marked = saved(docs.select(key_of(F.col(id_col)), F.col(text_col).cast("string")).mapInArrow(run, "bad boolean, " + ", ".join(f"{n} double" for n in names[1:])))
    rows = marked.where("not bad").agg(F.percentile("weight", reject_clean), *(F.percentile(n, 1 - reject_clean) for n in names[2:])).first()
    best = 0
    if rows[0] is not None:
        limits = [x + 1e-9 for x in rows[1:]]
        caught = marked.where("bad").agg(*(F.count_if(F.col(n) > F.lit(x)) for n, x in zip(names[2:], limits, strict=True))).first()
        best = int(np.argmax(caught))
        model.least, model.most_toxic = rows[0] - 1e-9, limits[best]
    model.toxic = gated[best]
    return model


SCORES = "__n_ngrams", "__weight", "__key", "__toxic"
KINDS = [pa.int64(), pa.float64(), pa.float64(), pa.float64()]


def score_batch(batch: pa.RecordBatch, model: Model, hashes: Hashes, id_at: int, text_at: int) -> list[pa.Array]:
    """The columns SCORES."""
    found = [model.score(t, hashes) for t in batch.column(text_at).cast(pa.binary()).to_pylist()]
    keys = [SHARP * normal(w, n) + noise(i) for (n, w, _), i in zip(found, batch.column(id_at).to_pylist(), strict=True)]
    return [pa.array(c, k) for c, k in zip(([x[0] for x in found], [x[1] for x in found], keys, [float(x[2]) for x in found]), KINDS, strict=True)]


def weighed(docs: DataFrame, model: Model, id_col: str, text_col: str) -> DataFrame:
    """docs with the columns SCORES."""
    schema = T.StructType([*docs.schema, *(T.StructField(n, T.LongType() if n == "__n_ngrams" else T.DoubleType()) for n in SCORES)])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_at, text_at, names = docs.columns.index(id_col), docs.columns.index(text_col), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        model, hashes = shared.value, Hashes()
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, *score_batch(batch, model, hashes, id_at, text_at)], names=names)

    return docs.mapInArrow(run, schema)


def least_key(scores: DataFrame, model: Model) -> float:
    """The smallest of the k largest keys, where k documents have a normalised weight within the labels' limit."""
    within = F.col("__weight") / (F.col("__n_ngrams") + F.lit(PRIOR)) >= F.lit(float(model.least))
    k = scores.where(within).count()
    return kth_largest(scores, k) if k else float("inf")


def scored(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", only_kept: bool = False) -> DataFrame:
    """docs with __n_ngrams, __weight (log importance), __key (sharpened normalised weight, with noise), __toxic and __kept; columns
    of docs with these names are replaced. only_kept: just the kept rows, with the columns of docs, whatever their names.

    Kept are the k largest keys, as far as the toxicity filter lets them pass. Numbers are written to find the k-th key, texts
    aren't: a second pass scores again (`kept_numbers` does without)."""
    if only_kept:
        names, docs = docs.columns, numbered(docs)
        id_col, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    else:
        docs = docs.drop(*SCORES, "__kept")
    numbers = saved(weighed(docs.select(id_col, text_col), model, id_col, text_col).drop(text_col))
    kept = (F.col("__key") >= F.lit(least_key(numbers, model))) & not_toxic(model)
    if only_kept:
        return weighed(docs, model, id_col, text_col).where(kept).drop(*SCORES).toDF(*names)
    return weighed(docs, model, id_col, text_col).withColumn("__kept", kept)


def kept_numbers(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, SCORES, __kept) of each row of docs, by one pass."""
    docs = docs.select(id_col, text_col)
    numbers = saved(weighed(docs, model, id_col, text_col).drop(text_col))
    return numbers.withColumn("__kept", (F.col("__key") >= F.lit(least_key(numbers, model))) & not_toxic(model))


def not_toxic(model: Model) -> Column:
    """The toxicity filter, which is apart from the resampling."""
    return F.col("__toxic") <= F.lit(float(model.most_toxic))


def toxic_recall(docs: DataFrame, labels: DataFrame, *by: str, max_labels: int = 40_000, **options) -> DataFrame:
    """(by, toxic, caught, rejected: of any reason) of the toxic documents, and (clean, lost) of the good and clean ones, that the
    fit of these labels holds out."""
    known = labelled(labels, max_labels)
    model = fit(docs, labels, max_labels=max_labels, **options)
    rest = [(int(k), bool(g), bool(t)) for k, g, t, f in zip(known.keys, known.good, known.toxic, known.fit, strict=True) if not f]  # max_labels at most
    marked = scored(docs, model).withColumn("__label", key_of(F.col("doc_id"))).join(docs.sparkSession.createDataFrame(rest, "__label long, __good boolean, __is_toxic boolean"), "__label")
    t, clean, over = F.col("__is_toxic"), F.col("__good") & ~F.col("__is_toxic"), F.col("__toxic") > F.lit(float(model.most_toxic))
    return marked.groupBy(*by).agg(F.count_if(t).alias("toxic"), F.count_if(t & over).alias("caught"), F.count_if(t & ~F.col("__kept")).alias("rejected"), F.count_if(clean).alias("clean"), F.count_if(clean & ~F.col("__kept")).alias("lost"))


def kth_largest(keyed: DataFrame, k: int, *, key_col: str = "__key", bins: int = 4096) -> float:
    """The k-th largest key (of fewer, the smallest). It is found by histograms that close in on it, each one aggregation of
    ``bins`` rows, so nothing is sorted as a whole."""
    low, high, n = keyed.agg(F.min(key_col), F.max(key_col), F.count(key_col)).first()
    if not n or k >= n:
        return float("-inf")
    above = 0
    key = F.col(key_col)
    while low < high:
        width = (high - low) / bins
        here = keyed.where((key >= low) & (key <= high)).groupBy(F.least(F.floor((key - low) / width), F.lit(bins - 1)).alias("bin"))
        found = sorted(here.agg(F.count("*").alias("n"), F.min(key_col).alias("low"), F.max(key_col).alias("high")).collect(), reverse=True)
        for row in found:
            if above + row.n >= k:
                if (row.low, row.high) == (low, high):  # nothing can be split off any more
                    high = low
                low, high = row.low, min(high, row.high)
                break
            above += row.n
    return low


def gumbel_top_k(keyed: DataFrame, k: int, *, key_col: str = "__key", bins: int = 4096) -> DataFrame:
    """The rows with the k largest keys, and any that tie with the k-th."""
    return keyed.where(F.col(key_col) >= F.lit(kth_largest(keyed, k, key_col=key_col, bins=bins)))


def op10_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_ngrams, log_weight, key, toxic_score, kept of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = kept_numbers(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", F.col("__n_ngrams").alias("n_ngrams"), F.col("__weight").alias("log_weight"), F.col("__key").alias("key"), F.col("__toxic").alias("toxic_score"), F.col("__kept").alias("kept"))

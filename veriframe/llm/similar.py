"""Near copies by exact similarity: pairs of documents whose sets of five-word shingles have a Jaccard similarity of ``percent`` % or more.

1. Each text becomes its set of 64-bit shingle hashes, and the set a digest and its band keys (fast similarity sketching). Equal sets
   are collapsed to one row first (partial aggregation) and numbered: the search is over numbers of sets, so ids may be of any type.
2. Under each key shared by two sets or more, the smallest number leads (partial aggregation again, so a crowded key is one row a
   task). Sets and their leaders are the first candidates; their connected components are clusters.
3. Candidates are checked exactly, only sets of clusters being computed again: first each set with its cluster's smallest,
   one pair a set, which settles nearly all; then those still apart with all their leaders.
4. Links join sets into groups. Under a key whose sets are all in one group nothing can be missing. Under the others each
   set is reduced to its differences from the leader's: with m and u the numbers of shingles that only the leader or only the
   set has, p the percentage, w = 100m + pu and L the leader's number of shingles, two sets are similar just if they share
   (w + w' - (100 - p)L) / (100 + p) differences or more. A leader's sets are packed into blocks of bounded size, a large group's into blocks of its
   own, which don't meet each other; the shared differences of blocks that meet are counted by matrix products, so no pair of
   sets is a row. Blocks' pairs grow with the product of the sizes of different groups under one leader.

Defined cases: texts without words are linked with nothing and always stay; fewer words than a shingle make one shingle; rows that share an id
but not a set are documents of their own; a row without an id is linked like others, and its group is named by the smallest id
there is, null if there is none; ids may be of any type; extra columns don't matter; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.common import held, numbered, saved, slices, table
from veriframe.llm.simhash import components, keep_first, spanning
from veriframe.llm.sketching import band_keys

SHINGLE, PERCENT = 5, 80
#: Differences in a block, of which each set counts OWN more; columns of a matrix product.
BLOCK, OWN, COLUMNS = 65536, 64, 2048


def shingles(text: bytes | None) -> np.ndarray:
    """The sorted distinct XXH64 values of a text's shingles."""
    words = text.lower().split() if text else []
    if not words:
        return np.array([], np.uint64)
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return np.array([xxhash.xxh64_intdigest(joined, 43)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-SHINGLE] + 1])
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], 43) for a, b in zip(starts.tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)], np.uint64))


def similar_sets(a: bytes, b: bytes, percent: int) -> bool:
    """Of two sets as packed sorted hashes."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    least, most = sorted((len(x), len(y)))
    if 100 * least < percent * most:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def own_digest(text_col: str):
    """Tells texts apart; rows are found again by their id and this."""
    return F.coalesce(F.xxhash64(F.col(text_col).cast("string")), F.lit(0))


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __digest: of the text, set: digest of its set, size, bands) of each row, as a table; set and bands are null without words."""
    rows = docs.select(F.col(id_col).alias("__id"), own_digest(text_col).alias("__digest"), F.col(text_col).cast("string"))
    more = [T.StructField("set", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))]
    schema = T.StructType([*rows.schema[:2], *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for batch in slices(batches):
            digests, sizes, keys = [], [], []
            for text in batch.column(2).cast(pa.binary()).to_pylist():
                found = shingles(text)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(band_keys(found) if len(found) else None)
            columns = [*batch.columns[:2], pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return saved(rows.mapInArrow(run, schema))


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, broadcast_rows: int = 500_000) -> DataFrame:
    """(node, hashes: packed) of the texts with these (node, __id, __digest), once each. Few (some 16 MB) are sent to the texts, many
    meet them in a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for batch in slices(batches):
            found = [shingles(t).tobytes() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "hashes"])

    rows = docs.select(F.col(id_col).alias("own_id"), own_digest(text_col).alias("own"), F.col(text_col).cast("string").alias("text"))
    wanted = F.broadcast(wanted) if wanted.count() <= broadcast_rows else wanted
    rows = rows.join(wanted, (F.col("own") == F.col("__digest")) & F.col("own_id").eqNullSafe(F.col("__id")))
    return rows.select("node", "text").mapInArrow(run, "node bigint, hashes binary").groupBy("node").agg(F.first("hashes").alias("hashes"))


def checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            near = [similar_sets(x, y, percent) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    one, two = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def differences(led: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (node, leader, group): what only one of the two has, what is asked for (w - (100 - p)L / 2, see above) and what it adds to a block."""
    schema = "node bigint, leader bigint, group bigint, marks binary, asks bigint, load bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            marks, asks = [], []
            for one, led_by in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(led_by, np.uint64)
                new, lost = np.setdiff1d(x, y, assume_unique=True), np.setdiff1d(y, x, assume_unique=True)
                marks.append(np.concatenate([new, lost]).tobytes())
                asks.append(2 * (100 * len(lost) + percent * len(new)) - (100 - percent) * len(y))  # twice, to stay whole
            columns = [*batch.columns[:3], pa.array(marks, pa.binary()), pa.array(asks, pa.int64()), pa.array([len(m) // 8 + OWN for m in marks], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "leader", "group", "marks", "asks", "load"])

    one, two = sets.select("node", F.col("hashes").alias("x")), sets.select(F.col("node").alias("leader"), F.col("hashes").alias("y"))
    return led.join(one, "node").join(two, "leader").select("node", "leader", "group", "x", "y").mapInArrow(run, schema)


def linked_rows(one: list[dict], two: list[dict], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The similar pairs between two blocks of different groups."""
    rows = one + two
    marks = [np.frombuffer(r["marks"], np.uint64) for r in rows]
    found, column, times = np.unique(np.concatenate(marks), return_inverse=True, return_counts=True)
    place = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[column]  # differences of one set alone are left out
    row = np.repeat(np.arange(len(rows)), [len(m) for m in marks])[place >= 0]
    place = place[place >= 0]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    shared = np.zeros((len(one), len(two)), np.float32)
    for at in range(0, int((times > 1).sum()), COLUMNS):
        a, b = np.searchsorted(place, [at, at + COLUMNS])
        has = np.zeros((len(rows), COLUMNS), np.float32)
        has[row[a:b], place[a:b] - at] = 1
        shared += has[: len(one)] @ has[len(one) :].T
    asks, group, nodes = (np.array([r[k] for r in rows]) for k in ("asks", "group", "node"))
    n = len(one)
    i, j = np.nonzero((2 * (100 + percent) * shared >= asks[:n, None] + asks[None, n:]) & (group[:n, None] != group[None, n:]))
    return nodes[:n][i], nodes[n:][j]


def block_links(apart: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between similar sets of one leader and different groups. A block holds sets of one large group (its home) or of
    several small ones; blocks of one home don't meet."""
    sizes = apart.groupBy("leader", "group").agg(F.sum("load").alias("load"))
    sizes = sizes.withColumn("home", F.when(F.col("load") >= BLOCK, F.col("group")))
    homes = sizes.groupBy("leader", "home").agg(F.ceil(F.sum("load") / BLOCK).alias("parts"))
    places = saved(sizes.join(homes.withColumnRenamed("leader", "l").withColumnRenamed("home", "h"), (F.col("leader") == F.col("l")) & F.col("home").eqNullSafe(F.col("h"))).select("leader", "group", "home", "parts"))
    dealt = apart.join(places, ["leader", "group"]).withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    blocks = dealt.groupBy("leader", "home", "part").agg(F.collect_list(F.struct("node", "group", "marks", "asks")).alias("rows"))
    blocks = saved(blocks.withColumn("block", F.monotonically_increasing_id()))
    one, two = (blocks.select("leader", F.col("home").alias(f"h{k}"), F.col("block").alias(f"b{k}")) for k in (1, 2))
    meets = one.join(two, "leader").where((F.col("b1") <= F.col("b2")) & (F.col("h1").isNull() | F.col("h2").isNull() | (F.col("h1") != F.col("h2")))).select("b1", "b2")
    pairs = meets.join(blocks.select(F.col("block").alias("b1"), F.col("rows").alias("one")), "b1").join(blocks.select(F.col("block").alias("b2"), F.col("rows").alias("two")), "b2").select("one", "two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = spanning(*linked_rows(batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), percent))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def in_groups(rows: DataFrame, node_col: str, groups: DataFrame, name: str) -> DataFrame:
    """rows with the group of the node: the smallest node of its component."""
    return rows.join(groups.select(F.col("node").alias(node_col), F.col("component").alias(name)), node_col, "left").withColumn(name, F.coalesce(name, node_col))


def similar_links(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(a, b): links that connect the nodes of reps (node, __id, __digest, bands) that are similar, directly or through others."""
    keyed = reps.select(F.explode("bands").alias("key"), "node")
    leaders = keyed.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    near = saved(keyed.join(leaders, "key"))
    # of each set its BANDS leaders at most; its least leader, joined with the others, connects the same as all of them
    led = saved(near.where("node <> leader").groupBy("node").agg(F.collect_set("leader").alias("leaders")).withColumn("least", F.array_min("leaders")))
    others = led.select(F.explode("leaders").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
    clusters = saved(components(led.select(F.col("node").alias("a"), F.col("least").alias("b")).union(others)))
    clustered = clusters.select("node").union(clusters.select(F.col("component").alias("node"))).distinct()
    sets = saved(sets_of(docs, saved(reps.select("node", "__id", "__digest").join(clustered, "node", "left_semi")), id_col, text_col))
    links = saved(checked(clusters.select(F.col("node").alias("a"), F.col("component").alias("b")), sets, percent))
    # sets unlike their cluster's smallest: with their leaders, and with those whose leaders they are
    unlike = saved(clusters.join(links.select(F.col("a").alias("node")), "node", "left_anti").select("node"))
    asking = led.join(unlike, "node", "left_semi").select(F.col("node").alias("a"), F.explode("leaders").alias("b"))
    asked = near.where("node <> leader").join(unlike.select(F.col("node").alias("leader")), "leader", "left_semi").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    linked = links.toDF("node", "component")
    apart = in_groups(in_groups(asking.union(asked).distinct(), "a", linked, "group"), "b", linked, "group_2")
    links = saved(links.union(checked(apart.where("group <> group_2").select("a", "b"), sets, percent)))
    groups = saved(components(links))
    placed = in_groups(near, "node", groups, "group")
    open_keys = placed.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("key")
    judged = placed.join(open_keys, "key", "left_semi").where("node <> leader").select("node", "leader", "group").distinct()
    several = judged.groupBy("leader").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("leader")
    return links.union(block_links(saved(differences(judged.join(several, "leader", "left_semi"), sets, percent)), percent))


def grouped(docs: DataFrame, id_col: str, text_col: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows of sketches(), the sets with words: set, root: number of its group, rep: its smallest id)."""
    found = sketches(docs, id_col, text_col)
    reps = found.where("size > 0").groupBy("set", "bands").agg(F.min(F.struct(F.col("__id").isNull().alias("no_id"), "__id", "__digest")).alias("first"))
    reps = saved(reps.select("set", "bands", "first.__id", "first.__digest", F.monotonically_increasing_id().alias("node")))
    groups = components(similar_links(docs, reps, id_col, text_col, percent))
    return found, in_groups(reps, "node", groups, "root").select("set", "root", F.col("__id").alias("rep"))


def similar_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id: the smallest id of its group, its own without words) of each row of docs."""
    found, groups = grouped(docs, id_col, text_col, percent)
    groups = saved(groups)
    named = groups.join(groups.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("set", "component_id")
    rows = found.join(named, "set", "left").withColumn("component_id", F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("__id")))
    return rows.select(F.col("__id").alias(id_col), F.col("size").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """docs with one row of each group, chosen as in simhash.keep_first; rows without words all stay."""
    names, docs = docs.columns, numbered(docs)
    id_col, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    found, groups = grouped(docs, id_col, text_col, percent)
    rows = found.groupBy("set", "__id", "__digest").agg(F.count("*").alias("n"))
    rows = saved(rows.join(groups.select("set", "root"), "set"))
    return keep_first(docs, rows, id_col, text_col).toDF(*names)


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's number of shingles and the smallest id of those similar to it by 0.85 or more, directly or through others."""
    found = similar_groups(table(spark, sf_dir, "documents"), percent=85)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

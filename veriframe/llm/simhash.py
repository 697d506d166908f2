"""SimHash near-duplicates by a Gray-order hierarchical index.

Each text becomes a 64-bit fingerprint. Fingerprints within ``DISTANCE`` (4) bits are linked, and documents connected
by links form a group, named by its smallest id. No link between different fingerprints is missed:

1. Equal fingerprints are collapsed to one row first (partial aggregation), so copies cost nothing more.
2. For distribution alone, fingerprints are filed under bits that two within 4 must agree in somewhere: of 64 bits in 5 fields they
   agree in one field, of 6 fields in two. Of these fields the lowest bits are taken, as many as leave about ``SHARE`` fingerprints in a bucket; up
   to 13 bits come from single fields (5 rows a fingerprint), more from pairs (15). A link is taken from the first place that agrees.
3. All filed rows are sorted by (field, bits, Gray rank) over range partitions, so a crowded bucket is spread over tasks. Each bucket is an
   index: in Gray order neighbours share most bits, so consecutive rows form leaf groups, these form upper nodes, and so on up,
   each with the bits that all its fingerprints share (mask and value). The search starts from pairs of the topmost nodes. Two nodes whose shared
   bits already differ in more than 4 places are pruned with everything below them; others are opened, down to the fingerprints.
4. Buckets within one partition are searched there. What may cross a partition's border, or is larger
   than ``CHUNK`` rows, is packed into chunks, which are the top nodes of the index: pairs of chunks of one bucket that
   survive the pruning are joined and searched as tasks of their own. Only spanning links are kept.
5. Links are contracted to stars by repeated minimum steps (joins with partial aggregation, written to
   the shared checkpoint folder each time) until nothing changes.

Defined cases: a null or empty text has the fingerprint zero, which is linked like any other; a row with a null id is linked like
others and named by the smallest id of its group, null if none has one; rows that share an id but not a fingerprint are
documents of their own; ids may be of any type; fewer words than a shingle make one shingle; no rows give no rows; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.common import held, numbered, saved, shuffle_partitions, slices, table

DISTANCE, SHINGLE = 4, 4
#: Widths of the fields, from the lowest bit: of those looked up alone and of those looked up in pairs.
ALONE, PAIRED = (13, 13, 13, 13, 12), (11, 11, 11, 11, 10, 10)
#: Fingerprints that a bucket is meant to hold, rows of a bucket that one task searches, of a leaf group, nodes of an upper node.
SHARE, CHUNK, LEAF, FAN = 2048, 4096, 8, 4
#: Pairs of leaf groups that are compared at once.
AT_ONCE = 1 << 14


def lowest(widths: tuple[int, ...], bits: int) -> list[int]:
    """Masks of the lowest bits of each field."""
    starts = np.cumsum((0, *widths[:-1])).tolist()
    return [((1 << min(w, bits)) - 1) << at for w, at in zip(widths, starts, strict=True)]


def places(bits: int) -> np.ndarray:
    """The masks under which fingerprints are filed, each with so many bits (less where fields are shorter)."""
    if bits <= max(ALONE):
        return np.array(lowest(ALONE, bits), np.uint64)
    return np.array([x | y for x, y in combinations(lowest(PAIRED, -(-bits // 2)), 2)], np.uint64)


def bits_for(fingerprints: int) -> int:
    return max(1, int(fingerprints / SHARE).bit_length())


def fingerprint(text: bytes | None) -> int:
    """A bit is 1 if it is in more than half of the shingles' XXH64 values (seed 42)."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[: -SHINGLE] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):  # so that a very long text needs little memory
        part = np.array(hashes[at : at + 65536], ">u8")
        ones += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def gray_rank(fp: Column) -> Column:
    """The place of a bit pattern in the Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


class Node:
    """One level of the index: for each node, the bits shared by all below it, and where its children are."""

    def __init__(self, masks: np.ndarray, values: np.ndarray, fan: int):
        self.first = np.arange(0, len(values), fan)
        self.end = np.minimum(self.first + fan, len(values))
        lead = values[self.first]
        apart = np.bitwise_or.reduceat(values ^ np.repeat(lead, self.end - self.first), self.first)
        self.masks = np.bitwise_and.reduceat(masks, self.first) & ~apart
        self.values = lead & self.masks


def levels(fps: np.ndarray) -> list[Node]:
    """The index over fingerprints in Gray order, from the leaf groups up."""
    out = [Node(np.full(len(fps), ~np.uint64(0)), fps, LEAF)]
    while len(out[-1].values) > FAN:
        out.append(Node(out[-1].masks, out[-1].values, FAN))
    return out


def expand(i: np.ndarray, j: np.ndarray, a: Node, b: Node, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of the paired nodes; of a node with itself, each pair once."""
    na, nb = a.end[i] - a.first[i], b.end[j] - b.first[j]
    sizes = na * nb
    at = np.repeat(np.arange(len(i)), sizes)
    k = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x, y = a.first[i][at] + k // nb[at], b.first[j][at] + k % nb[at]
    return (x[x <= y], y[x <= y]) if same else (x, y)


def close_pairs(a: np.ndarray, b: np.ndarray | None = None, seen: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of fingerprints within DISTANCE. Without b: pairs in a, each once. seen: gets added how many pairs of
    nodes were pruned and opened, and how many pairs of fingerprints compared."""
    same = b is None
    up, other = levels(a), None
    other = up if same else levels(b)
    depth = max(len(up), len(other))
    for tree in (up, other):
        while len(tree) < depth:
            tree.append(Node(tree[-1].masks, tree[-1].values, FAN))
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(up[-1].values)), np.arange(len(other[-1].values)), indexing="ij"))
    if same:
        i, j = i[i <= j], j[i <= j]
    for x, y in zip(reversed(up), reversed(other), strict=True):
        near = np.bitwise_count((x.values[i] ^ y.values[j]) & x.masks[i] & y.masks[j]) <= DISTANCE
        if seen is not None:
            seen["opened"], seen["pruned"] = seen.get("opened", 0) + int(near.sum()), seen.get("pruned", 0) + int((~near).sum())
        i, j = i[near], j[near]
        if x is not up[0]:
            i, j = expand(i, j, x, y, same)
    one, two, found = grouped(a), None, []
    two = one if same else grouped(b)
    for at in range(0, len(i), AT_ONCE):  # leaf groups that are left: all their fingerprints
        p, q = i[at : at + AT_ONCE], j[at : at + AT_ONCE]
        k, x, y = np.nonzero(np.bitwise_count(one[p][:, :, None] ^ two[q][:, None, :]) <= DISTANCE)
        found.append((p[k] * LEAF + x, q[k] * LEAF + y))
    if seen is not None:
        seen["compared"] = seen.get("compared", 0) + len(i) * LEAF * LEAF
    x, y = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.array([], np.int64),) * 2
    real = (x < y) & (y < len(a)) if same else (x < len(a)) & (y < len(b))
    return x[real], y[real]


def grouped(fps: np.ndarray) -> np.ndarray:
    """The leaf groups as rows, the last one filled up."""
    return np.concatenate([fps, np.zeros(-len(fps) % LEAF, np.uint64)]).reshape(-1, LEAF)


def first_place(differ: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """For XORs of fingerprints: the first place whose bits are equal in both."""
    return ((differ[:, None] & masks[None, :]) == 0).argmax(axis=1)


def spanning(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (id, smallest id of its group here) with the connections of the links x-y."""
    if not len(x):
        return x, y
    ids, place = np.unique(np.concatenate([x, y]), return_inverse=True)
    i, j = place[: len(x)], place[len(x) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    apart = label != np.arange(len(ids))
    return ids[apart], ids[label[apart]]


FOUND = "kind int, a bigint, b bigint, bucket int, fields bigint, fps binary, reps binary, mask bigint, value bigint"


def search(batches: Iterator[pa.RecordBatch], chunk: int, masks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Over rows (bucket, fields, rank, fp, rep) of a sorted partition: links (kind 0) and chunks (kind 1).

    Chunks are made of the first and the last bucket, which may go on in other partitions, and of large ones.
    """
    names = [f.split()[0] for f in FOUND.split(", ")]
    kinds = [pa.int32(), *[pa.int64()] * 2, pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def rows(links: tuple[np.ndarray, np.ndarray], chunks: list[tuple]) -> pa.RecordBatch:
        n, m = len(links[0]), len(chunks)
        none = [None] * n
        columns = [[0] * n + [1] * m, links[0].tolist() + [None] * m, links[1].tolist() + [None] * m]
        columns += [none + [c[k] for c in chunks] for k in range(6)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def packed(part: list[np.ndarray]) -> tuple:
        node = Node(np.full(len(part[2]), ~np.uint64(0)), part[2], len(part[2]))
        return (int(part[0][0]), int(part[1][0]), part[2].tobytes(), part[3].tobytes(), int(node.masks.view(np.int64)[0]), int(node.values.view(np.int64)[0]))

    held: list[np.ndarray] | None = None  # rows of the bucket that may go on
    border = True  # whether that bucket is the partition's first, or partly given out
    for batch in batches:
        part = [batch.column(k).to_numpy() for k in (0, 1, 3, 4)]
        part[2] = part[2].view(np.uint64)
        if held is not None:
            part = [np.concatenate([h, p]) for h, p in zip(held, part, strict=True)]
        n = len(part[0])
        if not n:
            continue
        starts = np.flatnonzero(np.concatenate([[True], (part[0][1:] != part[0][:-1]) | (part[1][1:] != part[1][:-1])]))
        ends = np.append(starts[1:], n)
        links, chunks, close = [], [], []
        for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
            if s == 0 and border or e == n:
                continue
            if e - s > chunk:
                chunks += [packed([p[k : min(k + chunk, e)] for p in part]) for k in range(s, e, chunk)]
            else:
                i, j = close_pairs(part[2][s:e])
                close.append((i + s, j + s))
        if border and len(starts) > 1:  # the first bucket ends here
            chunks += [packed([p[k : min(k + chunk, ends[0])] for p in part]) for k in range(0, ends[0], chunk)]
        if close:
            i, j = (np.concatenate(x) for x in zip(*close, strict=True))
            if len(i):
                own = first_place(part[2][i] ^ part[2][j], masks) == part[0][i]
                links = spanning(part[3][i[own]], part[3][j[own]])
        last = starts[-1]
        if len(starts) > 1:
            border = False
        held = [p[last:] for p in part]
        if len(held[0]) > chunk:  # give out what is full
            full = len(held[0]) // chunk * chunk
            chunks += [packed([p[k : k + chunk] for p in held]) for k in range(0, full, chunk)]
            held, border = [p[full:] for p in held], True
        if len(links) and len(links[0]) or chunks:
            yield rows(links if len(links) else (np.array([], np.int64),) * 2, chunks)
    if held is not None and len(held[0]):
        yield rows((np.array([], np.int64),) * 2, [packed(held)])


def search_chunks(batches: Iterator[pa.RecordBatch], masks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Over rows (bucket, fps, reps, fps of the other chunk or null, its reps): links."""
    for batch in batches:
        links = []
        for bucket, fa, ra, fb, rb in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            fa, ra = np.frombuffer(fa, np.uint64), np.frombuffer(ra, np.int64)
            if fb is None:
                fb, rb = fa, ra
                i, j = close_pairs(fa)
            else:
                fb, rb = np.frombuffer(fb, np.uint64), np.frombuffer(rb, np.int64)
                i, j = close_pairs(fa, fb)
            own = first_place(fa[i] ^ fb[j], masks) == bucket if len(i) else np.array([], bool)
            links.append(spanning(ra[i[own]], rb[j[own]]))
        a, b = (np.concatenate(x) if x else np.array([], np.int64) for x in (zip(*links, strict=True) if links else ([], [])))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def links_between(reps: DataFrame, *, partitions: int | None = None, chunk: int = CHUNK, bits: int | None = None) -> DataFrame:
    """(a, b): links that connect just those rep of (fp, rep) whose fp are connected. fp and rep are distinct longs."""
    n = partitions or shuffle_partitions(reps.sparkSession)
    masks = places(bits or bits_for(reps.count()))
    filed = F.array(*(F.struct(F.lit(k).alias("bucket"), F.col("fp").bitwiseAND(F.lit(int(m)).cast("long")).alias("fields")) for k, m in enumerate(masks.view(np.int64))))
    rows = reps.select("fp", "rep", F.explode(filed).alias("x")).select("x.bucket", "x.fields", gray_rank(F.col("fp")).alias("rank"), "fp", "rep")
    order = ["bucket", "fields", "rank"]
    found = saved(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(lambda b: search(b, chunk, masks), FOUND))
    chunks = found.where("kind = 1").drop("kind", "a", "b").withColumn("chunk", F.xxhash64("fps"))
    other = chunks.select(*(F.col(c).alias(f"{c}_2") for c in chunks.columns))
    shared = F.bit_count(F.col("value").bitwiseXOR(F.col("value_2")).bitwiseAND(F.col("mask")).bitwiseAND(F.col("mask_2")))
    light = ["bucket", "fields", "mask", "value", "chunk"]
    top = chunks.select(*light).join(other.select(*(f"{c}_2" for c in light)), (F.col("bucket") == F.col("bucket_2")) & (F.col("fields") == F.col("fields_2")) & (F.col("chunk") < F.col("chunk_2")) & (shared <= DISTANCE))
    key = ["bucket", "fields", "chunk"]
    pairs = top.select(*key, "chunk_2").join(chunks.select(*key, "fps", "reps"), key).join(
        other.select(F.col("bucket_2").alias("bucket"), F.col("fields_2").alias("fields"), "chunk_2", "fps_2", "reps_2"), ["bucket", "fields", "chunk_2"])
    alone = chunks.select("bucket", "fps", "reps", F.lit(None).cast("binary").alias("fps_2"), F.lit(None).cast("binary").alias("reps_2"))
    return found.where("kind = 0").select("a", "b").union(alone.union(pairs.select("bucket", "fps", "reps", "fps_2", "reps_2")).mapInArrow(lambda b: search_chunks(b, masks), "a bigint, b bigint"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the links but those that are their component's smallest."""
    state = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    low, high = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    edges = saved(links.where("a <> b").select(high, low).distinct())
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.join(least, "a").select(F.col("b").alias("x"), "m").union(least.select(F.col("a").alias("x"), "m"))
        edges = saved(moved.where("x <> m").select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct())
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def prints_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __digest of the text, fp) of each row, as a table in the shared folder."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("__digest"), text)
    schema = T.StructType([*rows.schema[:2], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for batch in slices(batches):
            found = np.array([fingerprint(t) for t in batch.column(2).cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=schema.names)

    return saved(rows.mapInArrow(run, schema))


def groups_of(prints: DataFrame, **options) -> DataFrame:
    """(fp, root: its group's smallest fingerprint, rep: its smallest id). The nodes of the search are fingerprints, so that rows
    without an id connect others too, and ids may be of any type."""
    reps = saved(prints.groupBy("fp").agg(F.min("__id").alias("rep")))
    groups = components(links_between(reps.select("fp", F.col("fp").alias("rep")), **options))
    return reps.join(groups, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("root"), "rep")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """(id, fp, component_id) of each row of docs."""
    prints = prints_of(docs, id_col, text_col)
    groups = saved(groups_of(prints, partitions=partitions, chunk=chunk))
    named = groups.join(groups.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(named, "fp", "left").select(F.col("__id").alias(id_col), "fp", "component_id")


def keep_first(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs (with numbered columns) with one row of each root: the one with the smallest id (rows without one last), of these the one with
    the smallest digest of its text, and of rows equal in both any one. rows: (__id, __digest, n: of such rows, root), as a table; rows
    of docs that aren't there stay."""
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("__id").isNull().alias("no_id"), "__id", "__digest")).alias("first"))
    judged = rows.join(first, "root").withColumn("stays", F.col("__id").eqNullSafe(F.col("first.__id")) & (F.col("__digest") == F.col("first.__digest")))
    judged = saved(judged.where(~F.col("stays") | (F.col("n") > 1)).select("__id", "__digest", "stays"))  # what isn't simply kept
    docs = docs.withColumn("__own", F.coalesce(F.xxhash64(F.col(text_col).cast("string")), F.lit(0)))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__digest"))
    out = docs.join(judged, same, "left_anti")
    again = judged.where("stays").drop("stays")
    if not again.isEmpty():
        out = out.union(docs.join(again, same, "left_semi").dropDuplicates([id_col, "__own"]))
    return out.drop("__own")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with one row of each group, as keep_first chooses it. Columns stay as they are, whatever their names."""
    names, docs = docs.columns, numbered(docs)
    id_col, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    prints = prints_of(docs, id_col, text_col)
    rows = prints.groupBy("fp", "__id", "__digest").agg(F.count("*").alias("n"))
    rows = saved(rows.join(groups_of(prints, **options).select("fp", "root"), "fp"))
    return keep_first(docs, rows, id_col, text_col).toDF(*names)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

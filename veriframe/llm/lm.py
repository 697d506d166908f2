"""Language-model scoring with a weighted backoff automaton, learnt from the corpus itself.

States are contexts (two words, one word or the start, or none: the root), arcs are the n-grams seen in training, and each
state has a failure arc to the state of its context less the first word. Weights, in log10:

* arc u v -> w: (c(u v w) + b3 * p(w | v)) / (c(u v) + b3), Dirichlet-smoothed with strength b3 into
* arc v -> w: p(w | v) = (c(v w) + b2 * p(w)) / (c(v) + b2);
* failure arcs: b3 / (c(u v) + b3) and b2 / (c(v) + b2), then at the root the word's own p(w);
* p(w) = (max(c(w) - d, 0) + d * V / (V + 1)) / N, absolute discounting with the freed mass spread evenly over the V
  known words and one unknown word.

Each state's weights sum to one. A text is traversed once from left to right. The state carried along is the longest context of the
words just read that is a state; the next word's arc is taken if there is one, else failure arcs until there is; weights add up. Since the
state after each word is settled by the last two words, the arrays of `Automaton` hold, for each n-gram of the block's texts, what the
step over it adds, and a text's steps are gathered and added up all at once (a test compares this with a walk, arc by arc).

The automaton grows with the corpus and is never in one place. Documents are dealt into blocks by a hash of the
row (and of the partition that it is read in, so that repeated rows spread out); each block sends the distinct words and n-grams of its
texts, with their training counts, to shards by hash, one packed row per (block, shard). A shard adds up counts over all
blocks (words by their exact bytes, n-grams by a hash of ``KEY_BITS`` bits besides the shard's: of a shard's few million about three in
a million meet another) and answers each block with the totals for just what it asked. So a frequent word is one entry per block,
whatever its share of the text, and each block holds the part of the automaton that its texts can reach. N and V arrive with the
answers. The text is shuffled once. Blocks hold ``BLOCK_BYTES`` of text on average, and at least as many are made as there are shuffle
partitions, so no task's table grows with the corpus; hashes travel as differences and counts in a byte each, most often.

Defined cases: a null or empty text is the end token alone; a null id counts as the empty string for ``held_out``;
repeated rows are scored each, and each counts in training; with no training rows every probability is that of the one
unknown word, 1; extra columns don't matter; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.common import field_type, held, shuffle_partitions, table, trim

#: Local numbers of the start state and the end token in a block; the end token's name can't be a word.
START, END = 0, 1
END_NAME = b" "
BLOCK_BYTES = 12_000_000
#: Bits of an n-gram's hash besides its shard's.
KEY_BITS = 40
ASKED = "shard int, block int, n_words bigint, words binary, word_counts binary, n_grams bigint, grams binary, gram_counts binary"
TOLD = "block int, shard int, n_words bigint, word_counts binary, n_grams bigint, gram_counts binary, n bigint, v bigint"


class Numbers(dict):
    """Numbers keys in the order of their first use."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs of 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte for each; 255 stands for one that is written at the end in full."""
    big = counts >= 255
    return np.where(big, 255, counts).astype(np.uint8).tobytes() + counts[big].astype("<u8").tobytes()


def unpack_counts(packed: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(packed, np.uint8, n).astype(np.int64)
    big = counts == 255
    counts[big] = np.frombuffer(packed, "<u8", offset=n)
    return counts


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted unsigned integers as differences, in so many bytes each as the largest needs; that number comes first."""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(keys) else 1
    return bytes([width]) + np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack_sorted(packed: bytes) -> np.ndarray:
    parts = np.frombuffer(packed, np.uint8, offset=1).reshape(-1, packed[0])
    steps = np.zeros((len(parts), 8), np.uint8)
    steps[:, : packed[0]] = parts
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct values, a place of each, and the number of each element's value."""
    order = np.argsort(x, kind="stable")
    x = x[order]
    fresh = np.ones(len(x), bool)
    fresh[1:] = x[1:] != x[:-1]
    number = np.empty(len(x), np.uint32)
    number[order] = np.cumsum(fresh, dtype=np.uint32) - np.uint32(1)
    return x[fresh], order[fresh], number


class Block:
    """The words and n-grams of a block's texts. Shard s has the n-grams whose hashes are in the s-th of equal ranges."""

    def __init__(self, texts: pa.ChunkedArray, shards: int, order: int = 2):
        numbers = Numbers({b"\n": START, END_NAME: END})
        parts, sizes = [], []
        for chunk in texts.chunks:
            for at in range(0, len(chunk), 500):
                for text in chunk.slice(at, 500).cast(pa.binary()).to_pylist():
                    words = text.lower().split() if text else []
                    parts.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                    sizes.append(len(words) + 1)
        self.sizes = np.array(sizes, np.int64)
        ends = np.cumsum(self.sizes)
        self.tokens = np.full(int(ends[-1]) if len(ends) else 0, END, np.uint32)
        self.starts = ends - self.sizes
        for part, at in zip(parts, self.starts, strict=True):
            self.tokens[at : at + len(part)] = part
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.starts] = START
        self.codes, _, self.place = distinct(before.astype(np.uint64) << np.uint64(32) | self.tokens)
        self.words = list(numbers)
        named = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.words), np.uint64, len(self.words))
        self.left, self.right = (self.codes >> np.uint64(32)).astype(np.int64), (self.codes & np.uint64(0xFFFFFFFF)).astype(np.int64)
        hashes = mix(named[self.left], named[self.right])
        self.n_pairs, self.inside = len(self.codes), None
        if order == 3:  # of all words but each text's first: the bigram before, and the word
            self.inside = np.ones(len(self.tokens), bool)
            self.inside[self.starts] = False
            at = np.flatnonzero(self.inside)
            codes, first, self.place3 = distinct(self.place[at - 1].astype(np.uint64) << np.uint64(32) | self.tokens[at])
            self.context = (codes >> np.uint64(32)).astype(np.int64)  # bigram of the state
            self.shorter = self.place[at[first]]  # bigram that the failure arc leads to
            hashes = np.concatenate([hashes, mix(hashes[self.context] ^ np.uint64(0xA0761D6478BD642F), named[(codes & np.uint64(0xFFFFFFFF)).astype(np.int64)])])
        shard = (named % np.uint64(shards)).astype(np.int64)
        second = np.fromiter((xxhash.xxh64_intdigest(w, 1) for w in self.words), np.uint64, len(self.words))
        order_ = np.lexsort((second, named, shard))
        self.word_order = order_[order_ != START]
        self.word_cuts = np.searchsorted(shard[self.word_order], np.arange(shards + 1))
        self.gram_order = np.argsort(hashes, kind="stable")
        self.grams = hashes[self.gram_order]
        self.lows = [-((-s << 64) // shards) for s in range(shards)]
        self.gram_cuts = np.append(np.searchsorted(self.grams, np.array(self.lows, np.uint64)), len(hashes))
        self.shift = np.uint64(max(0, 64 - KEY_BITS - (shards - 1).bit_length()))

    def keys(self, s: int) -> np.ndarray:
        """The n-grams of a shard: where their hashes are in its range, in KEY_BITS bits."""
        return (self.grams[slice(*self.gram_cuts[s : s + 2])] - np.uint64(self.lows[s])) >> self.shift


def ask(group: pa.Table, shards: int, order: int = 2) -> pa.Table:
    """A block's words and n-grams with their training counts, a row for each shard, even without any, since N and V come with all answers."""
    held(None)
    trim()
    block = Block(group.column("__text"), shards, order)
    train = np.repeat(np.asarray(group.column("__train").combine_chunks().to_numpy(zero_copy_only=False), bool), block.sizes)
    word_counts = np.bincount(block.tokens[train], minlength=len(block.words))[block.word_order]
    gram_counts = np.bincount(block.place[train], minlength=block.n_pairs)
    if order == 3:
        gram_counts = np.concatenate([gram_counts, np.bincount(block.place3[train[block.inside]], minlength=len(block.context))])
    gram_counts = gram_counts[block.gram_order]
    words, number = [block.words[k] for k in block.word_order], group.column("__block")[0].as_py()
    rows = []
    for s in range(shards):
        w, g = slice(*block.word_cuts[s : s + 2]), slice(*block.gram_cuts[s : s + 2])
        rows.append((s, number, w.stop - w.start, b"\n".join(words[w]), pack_counts(word_counts[w]), g.stop - g.start, pack_sorted(block.keys(s)), pack_counts(gram_counts[g])))
    return table_of(rows, ASKED)


KINDS = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def table_of(rows: list[tuple], schema: str) -> pa.Table:
    fields = [x.split() for x in schema.split(", ")]
    return pa.table([pa.array([r[k] for r in rows], KINDS[kind]) for k, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])


def answer(group: pa.Table) -> pa.Table:
    """A shard's totals, for each block in the order in which it asked."""
    held(None)
    trim()
    rows = group.to_pylist()
    totals: dict[bytes, int] = {}
    asked = [r["words"].split(b"\n") if r["n_words"] else [] for r in rows]
    for words, r in zip(asked, rows, strict=True):
        for w, n in zip(words, unpack_counts(r["word_counts"], r["n_words"]).tolist(), strict=True):
            totals[w] = totals.get(w, 0) + n
    _, _, place = distinct(np.concatenate([unpack_sorted(r["grams"]) for r in rows]))
    counts = np.concatenate([unpack_counts(r["gram_counts"], r["n_grams"]) for r in rows])
    sums = np.bincount(place, weights=counts).astype(np.int64) if len(place) else np.zeros(0, np.int64)
    n, v, at, out = sum(totals.values()), sum(1 for x in totals.values() if x), 0, []
    for words, r in zip(asked, rows, strict=True):
        k = r["n_grams"]
        out.append((r["block"], r["shard"], len(words), pack_counts(np.fromiter((totals[w] for w in words), np.int64, len(words))), k, pack_counts(sums[place[at : at + k]]), n, v))
        at += k
    return table_of(out, TOLD)


class Automaton:
    """The part of the backoff automaton that a block's texts can reach."""

    def __init__(self, block: Block, told: pa.Table, shards: int, strength: float, discount: float, strength3: float = 0.0):
        by_shard = {r["shard"]: r for r in told.to_pylist()}
        assert len(by_shard) == shards, "an answer is missing"
        self.n, self.v = (sum(r[name] for r in by_shard.values()) for name in ("n", "v"))
        counts = {"word": np.zeros(len(block.word_order)), "gram": np.zeros(len(block.gram_order))}
        for name, cuts in (("word", block.word_cuts), ("gram", block.gram_cuts)):
            for s in range(shards):
                if cuts[s] < cuts[s + 1]:
                    counts[name][cuts[s] : cuts[s + 1]] = unpack_counts(by_shard[s][f"{name}_counts"], int(cuts[s + 1] - cuts[s]))
        self.seen, grams = np.zeros(len(block.words)), np.zeros(len(block.gram_order))
        self.seen[block.word_order], grams[block.gram_order] = counts["word"], counts["gram"]
        arcs = grams[: block.n_pairs]
        if self.n:
            root = (np.maximum(self.seen - discount, 0) + discount * self.v / (self.v + 1)) / self.n
        else:
            root = np.ones(len(block.words))
        context = self.seen.copy()
        context[START] = self.seen[END]  # each text starts once and ends once
        self.root, self.failure = np.log10(root), np.log10(strength / (context + strength))
        left, right = block.left, block.right
        #: The weight of going from each one-word state by each word that follows it: its arc, or failure and root arc.
        arc = np.log10((arcs + strength * root[right]) / (context[left] + strength))
        self.weight = np.where(arcs > 0, arc, self.failure[left] + self.root[right])
        if block.inside is not None:  # the same from each two-word state; one that isn't in the automaton fails at no cost
            arcs3, context3 = grams[block.n_pairs :], arcs[block.context]
            arc = np.log10((arcs3 + strength3 * 10.0 ** self.weight[block.shorter]) / (context3 + strength3))
            self.weight3 = np.where(arcs3 > 0, arc, np.log10(strength3 / (context3 + strength3)) + self.weight[block.shorter])


def traverse(docs: pa.Table, told: pa.Table, shards: int, strength: float, discount: float, names: list[str], order: int = 2, strength3: float = 0.0) -> pa.Table:
    held(None)
    trim()
    block = Block(docs.column("__text"), shards, order)
    a = Automaton(block, told, shards, strength, discount, strength3)
    total = lambda x: np.add.reduceat(x, block.starts) if len(block.starts) else x
    steps = a.weight[block.place]  # the state before each word is the word before it
    if order == 3:
        steps[block.inside] = a.weight3[block.place3]  # or the two words before it
    base = total(np.log10((a.seen + 1) / (a.n + a.v + 1))[block.tokens])
    known = total((a.seen > 0).astype(np.int64)[block.tokens])
    train = docs.column("__train").combine_chunks()
    n = len(block.sizes)
    columns = [docs.column("__id").combine_chunks(), pa.compute.invert(train), pa.array(block.sizes, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(n, a.n), pa.int64()), pa.array(base, pa.float64()), pa.array(total(steps), pa.float64())]
    return pa.table(columns, names=names)


def score(docs: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text", order: int = 2, strength: float = 500.0, strength3: float = 30.0, discount: float = 0.75, blocks: int | None = None) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of docs.

    train: boolean expression over docs, true for the rows to learn from. order: 2 for bigrams, 3 for trigrams as well.
    blocks: number of blocks and of shards; by default from the size of the texts."""
    n = blocks or number_of_blocks(docs, text_col)
    block = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.spark_partition_id()), F.lit(n)).cast("int")
    dealt = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"), F.coalesce(train, F.lit(False)).alias("__train"), block.alias("__block"))
    asked = dealt.groupBy("__block").applyInArrow(lambda g: ask(g, n, order), ASKED)
    told = asked.groupBy("shard").applyInArrow(answer, TOLD)
    fields = [(id_col, field_type(docs, id_col)), ("held_out", T.BooleanType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()), ("train_tokens", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    names = schema.names
    return dealt.groupBy("__block").cogroup(told.groupBy("block")).applyInArrow(lambda d, t: traverse(d, t, n, strength, discount, names, order, strength3), schema)


def number_of_blocks(docs: DataFrame, text_col: str) -> int:
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(shuffle_partitions(docs.sparkSession), -(-size // BLOCK_BYTES))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learning from those whose crc32(doc_id) mod 7 is not 2."""
    train = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2
    return score(table(spark, sf_dir, "documents"), train, order=3)

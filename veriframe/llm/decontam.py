"""Benchmark decontamination by a generalised suffix automaton over words.

All test items, lower-cased and split into words, go into one generalised suffix automaton. A document's words
are streamed through it: the state is the longest suffix read so far that occurs in some item, with its
length. Where that length reaches the window (10 words) the words of the window are hit; an item shorter
than the window counts as a whole. `scan` gives the hit spans and the items; `decontaminate` removes them.

The items are broadcast, so their size is bounded: they are hashed into blocks of about ``block_words`` words each, in a table of
the shared folder; the driver reads one block at a time, and with several of them the documents pass through one automaton
after another. Documents aren't shuffled, and each is handled alone, however long.

Defined cases: a null or empty text has no words and no hits; null or empty items have no window; a null
item_id is written ``null``; repeated item ids count once; repeated rows give repeated results; without
items nothing is hit; other columns of either table don't matter.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.common import ascii_lower, ascii_lower_col, held, numbered, saved, slices, table

#: Words: digits, a-z and everything beyond ASCII.
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
#: Words of the items of one automaton.
BLOCK_WORDS = 250_000


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self.extend(last, w)
        # states with words of several lengths: the one that holds the suffix of a given length
        self.items_of: dict[int, set[str]] = {}  # state of a full window -> items
        self.short: dict[int, list[tuple[int, str]]] = {}  # state of a whole short item -> (its length, item)
        for item, words in items:
            state = 0
            for k, w in enumerate(words, 1):
                state = self.next[state][w]
                if k >= window:
                    self.items_of.setdefault(self.at(state, window), set()).add(item)
                    state = self.at(state, window)
            if 0 < len(words) < window:
                self.short.setdefault(state, []).append((len(words), item))
        # for each state, the nearest one on its suffix path (itself first) that ends a short item
        self.shorter = [-1] * len(self.link)
        if self.short:
            for s in sorted(range(len(self.link)), key=self.length.__getitem__):
                self.shorter[s] = s if s in self.short else self.shorter[self.link[s]] if s else -1

    def extend(self, last: int, w: bytes) -> int:
        known = self.next[last].get(w)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self.clone(last, w, known)
        state = self.add(self.length[last] + 1, {})
        at = last
        while at >= 0 and w not in self.next[at]:
            self.next[at][w] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            known = self.next[at][w]
            self.link[state] = known if self.length[known] == self.length[at] + 1 else self.clone(at, w, known)
        return state

    def clone(self, at: int, w: bytes, known: int) -> int:
        copy = self.add(self.length[at] + 1, dict(self.next[known]), self.link[known])
        self.link[known] = copy
        while at >= 0 and self.next[at].get(w) == known:
            self.next[at][w] = copy
            at = self.link[at]
        return copy

    def add(self, length: int, arcs: dict[bytes, int], link: int = 0) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def at(self, state: int, n: int) -> int:
        """The state on the suffix path that holds the suffix of n words."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans (first word, end), in order and apart, and the items whose windows occur."""
        arcs, link, length, window, shorter = self.next, self.link, self.length, self.window, self.shorter
        spans: list[list[int]] = []
        items: set[str] = set()
        any_short = bool(self.short)
        state = n = 0
        for k, w in enumerate(words):
            to = arcs[state].get(w)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = arcs[state].get(w)
            if to is None:
                n = 0
                continue
            state = to
            n += 1
            first = -1
            if n >= window:
                if n > window:  # longer matches aren't needed: keep to the window's state
                    state = self.at(state, window)
                    n = window
                elif length[link[state]] >= window:
                    state = self.at(state, window)
                items |= self.items_of[state]
                first = k + 1 - window
            if any_short and shorter[state] >= 0:
                s = shorter[state]
                while s >= 0:
                    for size, item in self.short[s]:
                        if size <= n:
                            items.add(item)
                            first = k + 1 - size if first < 0 else min(first, k + 1 - size)
                    s = shorter[link[s]] if s else -1
            if first >= 0:
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append([first, k + 1])
        return [(a, b) for a, b in spans], items


#: For each byte: itself if it belongs to a word (A-Z as a-z), else a space. Bytes beyond ASCII are letters.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: bytes | str | None) -> list[bytes]:
    """The matches of ITEM_WORD in the lower-cased text, in UTF-8."""
    if not text:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(TO_WORDS).split()


def blocks_of(items: DataFrame, block_words: int, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(item, text, block) of the distinct items, as a table in the shared folder, and the number of blocks: as many as it takes for
    ``block_words`` each, on average. A block is a hash bucket, so Spark makes them all at once."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null").distinct()
    rows = saved(rows)
    size = rows.agg(F.sum(F.regexp_count(ascii_lower_col(F.col("text")), F.lit(ITEM_WORD.pattern)))).first()[0] or 0
    n = max(1, -(-size // block_words))
    return rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int")), n


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
FOUND = "__spans", "__items", "__words"
Rows = list[tuple[list[tuple[int, int]], set[str], int]]


def with_found(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("__spans", SPAN), T.StructField("__items", T.ArrayType(T.StringType())), T.StructField("__words", T.LongType())])


def finds(columns: list[pa.Array], rows: Rows) -> list[pa.Array]:
    """The columns, and those of FOUND."""
    spans = [[{"start": a, "end": b} for a, b in s] for s, _, _ in rows]
    return [*columns, pa.array(spans, SPANS), pa.array([sorted(i) for _, i, _ in rows], pa.list_(pa.string())), pa.array([k for _, _, k in rows], pa.int64())]


def passed(docs: DataFrame, items: DataFrame, last: Callable[[list[pa.Array], Rows], list[pa.Array]], schema: T.StructType, *, window: int, text_col: str, item_id: str, item_text: str, block_words: int) -> DataFrame:
    """What ``last`` makes of each batch's columns and (spans, items, number of words) of its texts, after all blocks of items.

    One block (a quarter of a million words) is read by the driver, broadcast, and made into an automaton once in each
    Python worker. With more blocks, the finds of each pass but the last are written beside the documents before the next."""
    spark, width, text_at = docs.sparkSession, len(docs.columns), docs.columns.index(text_col)
    between = with_found(docs.schema)
    table_, n = blocks_of(items, block_words, item_id, item_text)

    def one_pass(df: DataFrame, k: int) -> DataFrame:
        block = table_.where(F.col("block") == k).select("item", "text").collect()  # about block_words words
        shared, key = spark.sparkContext.broadcast([(r.item, w) for r in sorted(block) if (w := words_of(r.text))]), ("automaton", uuid.uuid4().hex)
        finish, out = (last, schema) if k == n - 1 else (finds, between)
        names = out.names

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = held(key, lambda: SuffixAutomaton(shared.value, window))
            for batch in slices(batches):
                rows = []
                for text in batch.column(text_at).cast(pa.binary()).to_pylist():
                    words = words_of(text)
                    rows.append((*automaton.scan(words), len(words)))
                if k:
                    earlier = zip(batch.column(width).to_pylist(), batch.column(width + 1).to_pylist(), strict=True)
                    rows = [(joined([*s, *((x["start"], x["end"]) for x in before)]), i | set(names_before), m) for (s, i, m), (before, names_before) in zip(rows, earlier, strict=True)]
                yield pa.RecordBatch.from_arrays(finish(batch.columns[:width], rows), names=names)

        return df.mapInArrow(run, out)

    out = docs
    for k in range(n):
        out = one_pass(saved(out) if k else out, k)
    return out


def scan(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs (columns of these names are replaced) with __spans (word spans hit, in order), __items (sorted item ids) and __words (count)."""
    base = docs.drop(*FOUND)
    return passed(base, items, finds, with_found(base.schema), window=window, text_col=text_col, item_id=item_id, item_text=item_text, block_words=block_words)


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words in the spans and what stands between them."""
    if not spans:
        return text
    places = [m.span() for m in ITEM_WORD.finditer(ascii_lower(text))]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join([*out, text[at:]])


def decontaminate(docs: DataFrame, items: DataFrame, *, max_coverage: float = 0.5, window: int = WINDOW, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs without test material: hit spans are cut out of the text; a document of whose words more than
    ``max_coverage`` are hit goes as a whole. Columns and types stay as they are; clean rows are untouched.
    Texts are scanned and cut in one pass, in one Python worker."""
    names = docs.columns
    docs = numbered(docs)
    at = names.index(text_col)

    def cut(columns: list[pa.Array], rows: Rows) -> list[pa.Array]:
        kept = [sum(b - a for a, b in spans) <= max_coverage * n for spans, _, n in rows]
        if any(spans for (spans, _, _), k in zip(rows, kept, strict=True) if k):
            texts = columns[at].to_pylist()
            columns = [*columns]
            columns[at] = pa.array([cut_words(t, r[0]) if k and r[0] else t for t, r, k in zip(texts, rows, kept, strict=True)], columns[at].type)
        return columns if all(kept) else [c.filter(pa.array(kept, pa.bool_())) for c in columns]

    out = passed(docs, items, cut, docs.schema, window=window, text_col=f"c{at}", item_id=item_id, item_text=item_text, block_words=block_words)
    return out.toDF(*names)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("__spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    return found.select(
        "doc_id",
        F.col("__words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )

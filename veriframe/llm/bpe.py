"""BPE encoding and decoding by dynamic programming over prefixes.

A text is split at special tokens, then into pre-tokens. For each pre-token the byte sequence is walked
once: a multi-pattern matching automaton over the vocabulary (the suffix structure) gives, for every
prefix, the tokens that end there, longest first. Exactly one of them is the last token of the BPE encoding
of that prefix: the one for which the prefix before it ends in a token that is *compatible*, that is, a pair
that BPE itself leaves unmerged. That token is stored per prefix; following the stored tokens back from
the end gives the ids. The result equals the merge procedure, in time linear in the text for bounded tokens.

The vocabulary file (a tokenizers JSON with a byte-level BPE model) is a parameter, read on each Python worker.

Defined cases: a null text is the empty text (no ids); rows are independent, so repeated rows and ties
need nothing; extra columns are ignored by `encode`/`decode`, which return the id column and their own.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.common import field_type, held, slices, table

#: Fixed values of the byte-level scheme: the split pattern and the bytes that stand for themselves.
W = r"\p{White_Space}"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{W}\p{{L}}\p{{N}}]+|{W}+(?!\P{{White_Space}})|{W}+"
#: The same split for texts below U+0250, whose letters, numbers and white space are listed here.
L, N, S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\x09-\x0d\x20\x85\xa0"
LATIN_SPLIT = re.compile(rf" ?[{L}]+| ?[{N}]+|'(?:[stmd]|re|ve|ll)| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+")
BEYOND_LATIN = re.compile(r"[^\x00-\u024f]")
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


ANY_SPLIT = regex.compile(SPLIT)


def pre_tokens(text: str) -> list[str]:
    return (ANY_SPLIT if BEYOND_LATIN.search(text) else LATIN_SPLIT).findall(text)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that a vocabulary file writes for each byte, as letter -> byte."""
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """Decoder of one vocabulary, and the tables that its encoder starts from."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {as_bytes(s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.bytes_of = [b""] * (max([*self.ids.values(), *special.values()]) + 1)
        for b, i in self.ids.items():
            self.bytes_of[i] = b
        for s, i in special.items():
            self.bytes_of[i] = s.encode()
        self.special = special
        self.spec = spec

    def decode(self, ids: bytes) -> str:
        numbers = array("I")
        numbers.frombytes(ids)
        return b"".join(map(self.bytes_of.__getitem__, numbers)).decode("utf-8", "replace")


class Encoder(Codec):
    """Encoder of one vocabulary. Memory is bounded: when a cache is full, half of it goes, the older one."""

    CACHE = 120_000

    def __init__(self, path: str):
        import ahocorasick

        super().__init__(path)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        #: (left id, right id) -> (merge rank, id of the merged token)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(self.spec["model"]["merges"]):
            left, right = (as_bytes(x) for x in (m if isinstance(m, list) else m.split(" ")))
            self.merges[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        self.never = len(self.merges)
        #: merged token -> (merge rank, (left id, right id))
        self.parts = {t: (rank, pair) for pair, (rank, t) in self.merges.items()}
        self.edges: dict[int, tuple] = {}
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.automaton = ahocorasick.Automaton()
        for b, i in self.ids.items():
            self.automaton.add_word(b.decode("latin-1"), (len(b), i))
        self.automaton.make_automaton()
        self.pair_ok: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        del self.spec

    def merged(self, ids: list[int]) -> list[int]:
        """The merge procedure on a few tokens: lowest rank first, leftmost on ties."""
        while len(ids) > 1:
            best = min(((self.merges[p][0], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merges), default=None)
            if best is None:
                break
            k = best[1]
            ids[k : k + 2] = [self.merges[ids[k], ids[k + 1]][1]]
        return ids

    def spines(self, token: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """The parts of the token's merge tree along its left and its right edge, whole token first.

        Each with the rank of the merge that takes it up (for the whole token: none, so the largest).
        """
        found = self.edges.get(token)
        if found is None:
            found = []
            for side in (0, 1):
                part, until, edge = token, self.never, []
                while True:
                    edge.append((part, until))
                    if part not in self.parts:
                        break
                    until, pair = self.parts[part]
                    part = pair[side]
                found.append(edge)
            self.edges[token] = found = tuple(found)
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE encodes the two tokens' joined bytes as just these two.

        It doesn't if some merge across the border comes first: one of a part at the right edge of the left
        token and a part at the left edge of the right one, while both still stand alone. Of two merges of one
        rank the left one comes first.
        """
        key = left << 32 | right
        ok = self.pair_ok.get(key)
        if ok is None:
            ok, merges = True, self.merges
            heads = self.spines(right)[0]
            for x, x_until in self.spines(left)[1]:
                for y, y_until in heads:
                    m = merges.get((x, y))
                    if m is not None and m[0] < x_until and m[0] <= y_until:
                        ok = False
                        break
                if not ok:
                    break
            if len(self.pair_ok) >= 3 * self.CACHE:
                self.pair_ok.clear()
            self.pair_ok[key] = ok
        return ok

    def piece(self, data: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.ids.get(data)
        if whole is not None and self.reachable(whole):
            return [whole]
        n = len(data)
        last, size = [-1] * (n + 1), [0] * (n + 1)
        compatible, pair_ok = self.compatible, self.pair_ok
        done = -1  # the last place in data that has its token
        for place, (length, token) in self.automaton.iter(data.decode("latin-1")):
            if place == done:
                continue
            start = place + 1 - length
            if start == 0:
                if length > 1 and not self.reachable(token):
                    continue
            else:
                before = last[start]
                ok = pair_ok.get(before << 32 | token)
                if not (compatible(before, token) if ok is None else ok):
                    continue
            done = place
            last[place + 1], size[place + 1] = token, length
        out = []
        while n > 0:
            out.append(last[n])
            n -= size[n]
        out.reverse()
        return out

    def reachable(self, token: int) -> bool:
        """Whether the merge procedure makes the token from its own bytes."""
        key = -1 - token
        ok = self.pair_ok.get(key)
        if ok is None:
            data = self.bytes_of[token]
            ok = self.pair_ok[key] = self.merged([self.ids[data[k : k + 1]] for k in range(len(data))]) == [token]
        return ok

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known, out = self.known, []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(array("I", [self.special[part]]).tobytes())
                continue
            pieces = pre_tokens(part)
            try:
                out += [known[p] for p in pieces]  # nearly always all are known
                continue
            except KeyError:
                pass
            for p in pieces:
                ids = known.get(p)
                if ids is None:
                    ids = self.older.get(p)
                    if ids is None:
                        ids = array("I", self.piece(p.encode())).tobytes()
                    if len(p) <= 64:
                        if len(known) >= self.CACHE:
                            self.older, self.known = known, (known := {})
                        known[p] = ids
                out.append(ids)
        return b"".join(out)


def codec(path: str) -> Codec:
    return held(("codec", path), lambda: Codec(path))


def encoder(path: str) -> Encoder:
    return held(("encoder", path), lambda: Encoder(path))


def encode(docs: DataFrame, vocabulary: str | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids): ids is binary, the little-endian unsigned 32-bit integers one after another.

    `unpack` turns it into an array column; packed, it is a third of the size in shuffles and files.
    """
    path = vocabulary or default_vocabulary()
    schema = T.StructType([T.StructField(id_col, field_type(docs, id_col)), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = encoder(path)
        for batch in slices(batches):
            ids = [c.encode(t) if t else b"" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=[id_col, "n_tokens", "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str | None = None, *, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of the packed ids (bytes that aren't UTF-8 become U+FFFD)."""
    path = vocabulary or default_vocabulary()
    where = encoded.columns.index(ids_col)
    schema = T.StructType([*(f for f in encoded.schema if f.name != "decoded"), T.StructField("decoded", T.StringType())])
    keep = [k for k, f in enumerate(encoded.schema) if f.name != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in slices(batches):
            texts = [None if x is None else c.decode(x) for x in batch.column(where).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: str | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded): `encode` and `decode` in one Python worker, to which each text goes once."""
    path = vocabulary or default_vocabulary()
    schema = T.StructType([T.StructField(id_col, field_type(docs, id_col)), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = encoder(path)
        for batch in slices(batches, 500):
            ids = [c.encode(t) if t else b"" for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(map(c.decode, ids), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def unpack(ids: F.Column) -> F.Column:
    """Packed ids as array<bigint>, by built-in functions."""
    pair = lambda k, n: F.hex(F.substring(ids, k * 4 + n, F.lit(1)))
    one = lambda k: F.conv(F.concat(pair(k, 4), pair(k, 3), pair(k, 2), pair(k, 1)), 16, 10).cast("bigint")
    return F.when(F.length(ids) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), (F.length(ids) / 4).cast("int") - 1), one))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    both = round_trip(table(spark, sf_dir, "documents"))
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

"""Token counts under a unigram vocabulary, by dynamic programming shared over a trie of pre-tokens.

The distinct pre-tokens of a batch are walked in sorted order, which is the depth-first order of their trie. The best
score of a prefix (the largest sum of token scores over its segmentations) depends on the prefix alone, so it is
computed once per trie node: on going from one pre-token to the next, the scores of their shared prefix are kept and
only the new nodes are filled in. At a pre-token's last node its token count and score are stored, and documents add up the
stored counts of their pre-tokens.

A token's score comes from its rank r in the vocabulary file: minus the logarithm of r + 2, less the logarithm of the sum of
1 / (r + 2), as for words whose frequency falls with the rank. Scores are whole multiples of 2**-20, so sums are exact;
of segmentations with equal scores the one with fewer tokens counts. Every byte is a token, so each text can be segmented.

Documents are handled alone and nothing is shuffled; stored counts are bounded and start anew when full.

Defined cases: a null or empty text has no tokens; repeated rows are counted each; a very long pre-token takes time
in proportion to its length; extra columns don't matter; no rows give no rows.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.bpe import pre_tokens
from veriframe.llm.common import field_type, held, slices, table

#: Scores are multiples of 1 / UNIT; a score and a token count share one integer: score * COUNT - tokens.
UNIT, COUNT = 1 << 20, 1 << 40
STORED = 150_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Unigram:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        total = math.log(sum(1 / (r + 2) for r in ranks.values()))
        #: token -> what it adds: its score times COUNT, less one token
        self.gain = {t: round((-math.log(r + 2) - total) * UNIT) * COUNT - 1 for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        #: for each last byte, the lengths of tokens that end with it
        sizes: dict[int, set[int]] = {}
        for t in ranks:
            sizes.setdefault(t[-1], set()).add(len(t))
        self.sizes = {last: sorted(s) for last, s in sizes.items()}
        self.stored: dict[str, tuple[int, float]] = {}

    def fill(self, words: list[str]) -> None:
        """Stores count and score of each of the words, which aren't stored yet."""
        gain, sizes_of, stored = self.gain.get, self.sizes, self.stored
        best, before = [0], b""
        for data, word in sorted((w.encode(), w) for w in words):
            n = min(len(before), len(data))
            shared = 0
            while shared < n and before[shared] == data[shared]:
                shared += 1
            del best[shared + 1 :]
            for end in range(shared + 1, len(data) + 1):
                top = None
                for size in sizes_of[data[end - 1]]:
                    if size > end:
                        break
                    g = gain(data[end - size : end])
                    if g is not None:
                        g += best[end - size]
                        if top is None or g > top:
                            top = g
                best.append(top)
            before = data
            score, left = divmod(best[-1], COUNT)
            tokens = COUNT - left if left else 0
            stored[word] = (tokens, (score + (1 if left else 0)) / UNIT)

    def count(self, texts: list[str]) -> list[tuple[int, int, float]]:
        """(pre-tokens, tokens, natural log score) of each text."""
        if len(self.stored) > STORED:
            self.stored.clear()
        parts = [Counter(pre_tokens(t)) if t else Counter() for t in texts]
        new = set().union(*parts).difference(self.stored) if parts else set()
        self.fill(list(new))
        stored, out = self.stored, []
        for part in parts:
            tokens, score = 0, 0.0
            for w, n in part.items():
                t, s = stored[w]
                tokens += n * t
                score += n * s
            out.append((part.total(), tokens, score))
        return out


def unigram(path: str) -> Unigram:
    return held(("unigram", path), lambda: Unigram(path))


def token_counts(docs: DataFrame, vocabulary: str | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pretokens, n_tokens, log_score) of each row of docs."""
    path = vocabulary or default_vocabulary()
    schema = T.StructType([T.StructField(id_col, field_type(docs, id_col)), T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("log_score", T.DoubleType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram(path)
        for batch in slices(batches):
            found = model.count(batch.column(1).to_pylist())
            columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))

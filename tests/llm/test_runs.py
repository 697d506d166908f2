"""Periodic runs against brute force, and on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from veriframe.llm import runs
from veriframe.llm.common import WORD, table
from veriframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(words: list, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """Every maximal stretch of identical words p apart, by each p from the smallest on; stretches that a divisor of p explains go."""
    n, found = len(words), []
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            size = j - i + p if j > i else 0
            if size >= max(least, times * p) and not any(all(words[t] == words[t + q] for t in range(i, i + size - q)) for q in range(1, p)):
                found.append((i, size, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def record(words: list[str], found: list[tuple[int, int, int]]) -> tuple:
    dropped = {t for s, size, p in found for t in range(s + p, s + size)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else None
    text = " ".join(w for t, w in enumerate(words) if t not in dropped)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], digest("".join("{},{},{}\n".format(*r) for r in found)), digest(text))


@pytest.mark.parametrize("seed", range(40))
def test_random_words(seed):
    rnd = random.Random(seed)
    words = []
    while len(words) < 300:
        part = [str(rnd.randrange(rnd.choice((1, 2, 3, 40)))) for _ in range(rnd.randrange(1, 25))]
        words += (part * rnd.randrange(1, 9))[: rnd.randrange(1, 120)]
    names = np.unique(words, return_inverse=True)[1]
    for least, times in ((24, 3), (6, 3), (1, 3)):
        assert [tuple(r) for r in runs.runs_of(names, least, times).tolist()] == brute(words, least, times)


def test_fibonacci_word():
    a, b = "a", "ab"
    while len(b) < 900:
        a, b = b, b + a
    names = np.array([ord(c) for c in b[:900]])
    assert [tuple(r) for r in runs.runs_of(names, 1, 3).tolist()] == brute(b[:900], 1, 3) and len(runs.runs_of(names, 1, 3)) > 5


def test_registered(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_runs"](spark, SF).collect()}
    rows = table(spark, SF, "documents").collect()
    assert len(got) == len(rows)
    checked = 0
    for r in rows:
        words = WORD.findall(r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n <= 1500:
            assert got[r.doc_id] == record(words, brute(words)), r.doc_id
            checked += 1
    assert checked > 150 and sum(g[0] > 0 for g in got.values()) > 5


def test_cases(spark):
    line = "to be or not " * 8
    rows = [(1, line), (1, line), (None, line), (2, None), (3, ""), (4, " \n\t"), (5, "so " * 100_000), (6, "x y " * 30), (7, "w" * 100_000), (8, " ".join(f"w{k}" for k in range(50_000)))]
    docs = spark.createDataFrame([(*r, "e", "e", "e") for r in rows], "doc_id long, text string, runs string, start string, collapsed string")
    got = runs.find_runs(docs).collect()
    plain = lambda r: (r.doc_id, [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed)
    want = [(i, [(0, 32, 4)], (0, 32, 4), "to be or not") for i in (1, 1, None)] + [(i, [], None, "") for i in (2, 3, 4)]
    want += [(5, [(0, 100_000, 1)], (0, 100_000, 1), "so"), (6, [(0, 30, 1)], (0, 30, 1), "x y"), (7, [], None, rows[8][1]), (8, [], None, rows[9][1])]
    assert sorted(map(plain, got), key=repr) == sorted(want, key=repr)
    assert runs.find_runs(docs.where("false")).collect() == []
    named = runs.find_runs(docs.where("doc_id = 1").select(F.lit("k").alias("key"), F.col("text").alias("body")), id_col="key", text_col="body")
    assert [(r.key, r.collapsed) for r in named.collect()] == [("k", "to be or not")] * 2


def test_texts_taken_together_or_apart(monkeypatch):
    rnd = random.Random(3)
    texts = [[str(rnd.randrange(2)).encode() for _ in range(rnd.randrange(200))] for _ in range(20)] + [[b"0"] * 40, [b"0"] * 40]
    together = [r.tolist() for r in runs.runs_in(texts)]
    assert together == [next(runs.runs_in([t])).tolist() for t in texts] and together[-1] == [[0, 40, 1]]

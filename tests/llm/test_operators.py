"""The training-data operators against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import math
import random
import re
import time
from array import array
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm import bpe, decontam, importance, line_dedup, lm, quality_rules, secrets, simhash, unigram, url_filter
from veriframe.llm.common import WORD, ascii_lower

LONG = "lorem ipsum dolor " * 20_000
TEXTS = ["", "One two three", "a b c d e f g h i j k l m n o p q r s t u v w x y z", "É À ß 日本語 🙂 x\u2028y", "line one\nline two\nline one\n\n  \nline two", "x" * 5000, LONG, None, "One two three", None]
#: Names that operators use themselves, as columns of the input.
EXTRA = ["score", "block", "fp", "ids", "host", "lines", "__block", "__kept", "__spans", "__key", "kind", "n_tokens"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 4 else None, t, f"s{i % 2}" if i != 5 else None, i) for i, t in enumerate(TEXTS)]
    rows.append(rows[1])  # a repeated row
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    for c in EXTRA:
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 0), (3, 1, 1), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "c d e f g h i j k l m"), (2, "one, TWO"), (3, None), (None, "three"), (2, "one two"), (4, "")], "item_id long, text string")


def empty(df):
    return df.where("false")


def test_unigram_counts(spark, docs):
    out = unigram.token_counts(docs).collect()
    assert len(out) == docs.count() and unigram.token_counts(empty(docs)).count() == 0
    model = unigram.Unigram(unigram.default_vocabulary())

    def brute(word):
        best = [(0, 0)]
        for end in range(1, len(word) + 1):
            best.append(max((best[s][0] + (model.gain[word[s:end]] + 1) // unigram.COUNT, best[s][1] - 1) for s in range(max(0, end - model.longest), end) if word[s:end] in model.gain))
        return -best[-1][1], best[-1][0] / unigram.UNIT

    words = [p for t in TEXTS if t and len(t) < 6000 for p in bpe.pre_tokens(t)]
    model.fill(sorted(set(words)))
    assert all(model.stored[w] == brute(w.encode()) for w in words)
    by_id = {r.doc_id: r for r in out}
    assert by_id[7].n_tokens == by_id[0].n_tokens == 0
    assert by_id[1].n_tokens == sum(brute(p.encode())[0] for p in bpe.pre_tokens(TEXTS[1]))


def tokens(text):
    return [*WORD.findall(ascii_lower(text or "")), None]


def test_lm_scores(spark, docs):
    train = F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False))
    out = lm.score(docs, train, blocks=3).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    taught = [tokens(t) for i, t in rows if i is not None and i % 3 != 1]
    c, pairs = Counter(w for t in taught for w in t), Counter(p for t in taught for p in zip(["<s>", *t], t, strict=False))
    n, v, b, d = sum(c.values()), len(c), 500.0, 0.75
    root = lambda w: (max(c[w] - d, 0) + d * v / (v + 1)) / n
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in out)
    want = []
    for i, t in rows:
        ws = tokens(t)
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        score = sum(math.log10((pairs[p] + b * root(p[1])) / ((c[None] if p[0] == "<s>" else c[p[0]]) + b)) for p in zip(["<s>", *ws], ws, strict=False))
        want.append((str(i), len(ws), sum(c[w] > 0 for w in ws), n, round(base, 6), round(score, 6)))
    assert got == sorted(want)
    assert lm.score(empty(docs), train, blocks=2).count() == 0
    untaught = lm.score(docs, F.lit(False), blocks=2).collect()
    assert all(r.score == 0 and r.train_tokens == 0 for r in untaught)


def test_lm_sums_to_one():
    import pyarrow as pa

    block = lm.Block(pa.chunked_array([["a b a c", "b b", ""]]), 1)
    asked = lm.ask(pa.table({"__text": pa.array(["a b a c", "b b", ""]), "__train": pa.array([True] * 3), "__block": pa.array([0] * 3)}), 1)
    a = lm.Automaton(block, lm.answer(asked), 1, 2.0, 0.5)
    assert abs(sum(10 ** a.root[[k for k, w in enumerate(block.words) if k != lm.START]]) + 0.5 * a.v / (a.v + 1) / a.n - 1) < 1e-9


def test_quality_rules(spark, docs, labels):
    def brute(t):
        w = WORD.findall(t or "")
        lines, seen, dup = (t or "").split("\n"), set(), 0
        for x in lines:
            dup += bool(WORD.search(x)) and x in seen
            seen.add(x)
        windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        hit = {x for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for x in range(k, k + 8)}
        return [len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t or ""), dup, len(hit)]

    rng = random.Random(4)
    for _ in range(500):
        t = "".join(rng.choice(["a", "b", "a ", "b ", "\n", "é ", "#", "\x85", "\x1c "]) for _ in range(rng.randint(0, 120)))
        assert quality_rules.statistics(t.encode())[0] == brute(t)
    forest = quality_rules.fit(docs, labels)
    out = quality_rules.judge(docs, forest).collect()
    assert len(out) == docs.count()
    assert all([r[c] for c in quality_rules.COUNTS] == brute(TEXTS[r.doc_id]) for r in out if r.doc_id is not None)
    assert quality_rules.judge(empty(docs), None).count() == 0 and quality_rules.fit(docs, empty(labels)) is None


def test_forest_finds_the_odd_one():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(300, 3)), [[9, 9, 9]]])
    score = quality_rules.grow(x, 50, 128, 3).score(x)
    assert score.argmax() == 300


def brute_hits(items, words, window):
    hit, found = set(), set()
    for name, ws in items:
        for w in [ws] if 0 < len(ws) < window else [ws[k : k + window] for k in range(len(ws) - window + 1)]:
            for k in range(len(words) - len(w) + 1):
                if words[k : k + len(w)] == w:
                    hit.update(range(k, k + len(w)))
                    found.add(name)
    return hit, found


def test_suffix_automaton():
    rng = random.Random(1)
    for trial in range(800):
        window, letters = rng.choice([3, 4, 5]), "ab" if trial % 2 else "abc"
        items = [(str(j), [rng.choice(letters).encode() for _ in range(rng.randint(1, 9))]) for j in range(rng.randint(0, 6))]
        words = [rng.choice(letters + "d").encode() for _ in range(rng.randint(0, 30))]
        spans, found = decontam.SuffixAutomaton(items, window).scan(words)
        assert ({k for a, b in spans for k in range(a, b)}, found) == brute_hits(items, words, window)


@pytest.mark.parametrize("block_words", [3, 1000])
def test_decontamination(spark, docs, items, block_words):
    out = decontam.scan(docs, items, block_words=block_words)
    parsed = [(str(r.item_id) if r.item_id is not None else "null", decontam.words_of(r.text)) for r in items.collect()]
    for r in out.collect():
        hit, found = brute_hits(parsed, decontam.words_of(r.text), 10)
        assert ({k for s in r["__spans"] for k in range(s.start, s.end)}, set(r["__items"])) == (hit, found)
    clean = decontam.decontaminate(docs, items)
    assert clean.columns == docs.columns
    texts = [r.text for r in clean.collect()]
    assert "One two three" not in texts and LONG in texts and None in texts and "x" * 5000 in texts
    assert decontam.decontaminate(empty(docs), items).count() == 0 and decontam.decontaminate(docs, empty(items)).count() == docs.count()
    cut = decontam.decontaminate(docs, items, max_coverage=1.0).where("doc_id = 2").first().text
    assert cut.split() == ["a", "b", *"n o p q r s t u v w x y z".split()]


def brute_fingerprint(text):
    w = WORD.findall(ascii_lower(text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(ids, fps):
    parent = dict(enumerate(ids))
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return {parent[i]: min(ids[k] for k in range(len(ids)) if group[k] == group[i]) for i in range(len(ids))}


def test_simhash_documents(spark, docs):
    out = simhash.near_duplicates(docs, partitions=3).collect()
    assert len(out) == docs.count()
    with_id = {r.doc_id: r for r in out if r.doc_id is not None}
    for i, r in with_id.items():
        if TEXTS[i] is None or len(TEXTS[i]) < 10_000:
            assert r.fp & (2**64 - 1) == brute_fingerprint(TEXTS[i])
    groups = brute_groups(list(with_id), [r.fp & (2**64 - 1) for r in with_id.values()])
    assert groups == {i: r.component_id for i, r in with_id.items()}
    kept = simhash.keep_one(docs, partitions=3)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(groups.values()) | {None}
    assert simhash.near_duplicates(empty(docs), partitions=2).count() == 0


@pytest.mark.parametrize(("n", "centers", "chunk", "parts"), [(400, 15, 2048, 3), (900, 1, 32, 4)])
def test_simhash_links(spark, n, centers, chunk, parts):
    rng = np.random.default_rng(3)
    middle = rng.integers(0, 2**63, centers, dtype=np.uint64)
    smallest = {}
    for i in rng.permutation(n).tolist():
        f = int(middle[rng.integers(centers)]) if rng.random() < 0.7 else int(rng.integers(0, 2**63, dtype=np.uint64))
        for b in rng.integers(0, 64, rng.integers(0, 14)).tolist():
            f ^= 1 << b
        smallest[f] = min(i, smallest.get(f, n))
    reps = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for f, i in smallest.items()], "fp long, rep long")
    found = {r.node: r.component for r in simhash.components(simhash.links_between(reps, partitions=parts, chunk=chunk)).collect()}
    assert {i: found.get(i, i) for i in smallest.values()} == brute_groups(list(smallest.values()), list(smallest))


def test_bpe(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    out = bpe.round_trip(docs).collect()
    more = ["<|endoftext|>a <|endoftext|>", "I'll don't 'S we're", "a\x1cb\x85c\xa0d\u2003e", "ab" * 999 + " " * 50 + "x", "½²٣ ſK ́e", "=" * 300]
    codec = bpe.encoder(bpe.default_vocabulary())
    for text, ids in [*((TEXTS[r.doc_id], r.ids) for r in out if r.doc_id is not None), *((t, codec.encode(t)) for t in more)]:
        want = library.encode(text or "", add_special_tokens=False).ids
        assert array("I", ids).tolist() == want and codec.decode(ids) == library.decode(want, skip_special_tokens=False)
    two_steps = bpe.decode(bpe.encode(docs)).collect()
    assert sorted(map(str, two_steps)) == sorted(map(str, out))
    assert bpe.encode(empty(docs)).count() == 0
    numbers = bpe.encode(docs).where("doc_id = 1").select(bpe.unpack(F.col("ids")).alias("x")).first().x
    assert numbers == library.encode(TEXTS[1]).ids


def test_line_dedup(spark, docs):
    pages = [(i, f"menu\nown {i}\n\nmenu" if i % 10 else None, "a") for i in range(40)] + [(100 + i, f"menu\nfoot\nx{i}", None) for i in range(6)] + [(0, "menu", "a")]
    df = spark.createDataFrame(pages, "doc_id long, text string, source string").withColumn("line", F.lit(1)).withColumn("__found", F.lit(2))
    out = line_dedup.drop_boilerplate(df)
    assert out.columns == df.columns
    got = {(r.doc_id, r.source, r.text) for r in out.collect()}
    assert (1, "a", "own 1\n") in got and (0, "a", "menu") in got and (0, "a", None) in got  # the first page keeps its lines
    assert (100, None, "menu\nfoot\nx0") in got and (103, None, "x3") in got
    assert line_dedup.drop_boilerplate(empty(docs)).count() == 0 and line_dedup.drop_boilerplate(docs).count() == docs.count()


def test_importance(spark, docs, labels):
    model = importance.fit(docs, labels)
    out = importance.scored(docs, model).collect()
    assert len(out) == docs.count() and all(r["__kept"] is not None for r in out)
    hashes = importance.Hashes()
    by_hand = {i: model.ratio[importance.buckets_of(t.encode() if t else None, hashes)].sum() for i, t in enumerate(TEXTS)}
    assert all(abs(r["__weight"] - by_hand[r.doc_id]) < 1e-6 for r in out if r.doc_id is not None)
    assert importance.scored(docs, model, only_kept=True).columns == docs.columns
    assert importance.scored(empty(docs), model).count() == 0
    nothing = importance.fit(empty(docs), empty(labels))
    assert importance.scored(docs, nothing, only_kept=True).count() == docs.count()


def test_importance_parts_good_from_bad(spark):
    rng = random.Random(5)
    good, bad = [f"w{k}" for k in range(200)], [f"z{k}" for k in range(200)]
    rows = [(i, " ".join(rng.choice(bad if i % 5 == 0 else good) for _ in range(60))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(0, 400, 2)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in importance.scored(docs, importance.fit(docs, labels), only_kept=True).collect() if r.doc_id % 2}
    right = sum((i in kept) == (i % 5 != 0) for i in range(1, 400, 2))
    assert right >= 190


def test_gumbel_top_k(spark):
    keyed = spark.createDataFrame([(float(k % 50),) for k in range(200)], "__key double")
    assert importance.gumbel_top_k(keyed, 4).count() == 4 and importance.gumbel_top_k(keyed, 5).count() == 8
    assert importance.gumbel_top_k(keyed, 500).count() == 200 and importance.gumbel_top_k(empty(keyed), 3).count() == 0


def test_url_filter(spark):
    urls = ["https://a.org/x", "http://EXAMPLE.org/es/1?q#f", "https://www.example.org/en/12", "https://x.com/fr/1", "https://x.com/de/2", "https://x.com/de/2", None, "no scheme", "https://org", "https://notorg/", "ftp://b.net/q://c", "://" + "a" * 3000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit("clash"))
    out = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert [out[k].rule for k in range(10)] == ["org/", "example.org/es/", "example.org/en/1", "com/fr/", "com/de/", "com/de/", None, None, None, None]
    assert out[1].host == "example.org" and out[1].path == "/es/1" and out[10].host == "b.net" and out[10].path == "/q://c" and out[6].host == out[7].path == ""
    assert all(out[k].verdict == v for k, v in {0: "allow", 1: "block", 2: "block", 3: "allow", 4: "block"}.items())
    untrained = url_filter.judge(pages.where("page_id in (6, 10)")).collect()
    assert {r.verdict for r in untrained} == {"allow"} and url_filter.judge(empty(pages)).count() == 0


def test_secrets(spark, docs):
    word = "Zx9" * 12
    texts = ["token = abc", 'PassWord: "abcdef" api_key=x api-key=longenough', "🙂 token: token: abcdefgh", "AKIA" + "A" * 16 + " AKIASHORT1234", "f" * 24 + " " + "g" + "a" * 23, f"AKIAABCDEFGH12 and {word} then", f"{word} alone", "ſecret=abcdef Kpasswd='qwerty99", f"see https://host.example.com {'.' * 150} {word}", f"AKIAABCDEFGH12 {'.' * 400} {word}"]
    df = spark.createDataFrame([*enumerate(texts), (99, None), (0, texts[0])], "doc_id int, text string").withColumn("digest", F.lit(0)).withColumn("assign", F.lit(0))
    rows = secrets.scan(df)
    base = F.concat(*(secrets.tagged(k, F.col(k)) for k, *_ in secrets.BASE))
    got = {r.doc_id: (r.base, r.weak) for r in rows.select("doc_id", secrets.written(base).alias("base"), secrets.written(F.col("weak")).alias("weak")).collect()}

    def brute(t):
        found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.A) if len(m[2]) >= 6]
        found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        return ",".join(f"{f[2]}:{f[0]}:{f[3]}" for f in sorted(found))

    assert {i: b for i, (b, _) in got.items()} == {**{i: brute(t) for i, t in enumerate(texts)}, 99: ""}
    assert rows.count() == 12
    assert got[5][1] == f"weak_id:0:14,weak_secret:19:{19 + len(word)}" and got[6][1] == "" and got[9][1] == ""
    assert got[8][1].startswith("weak_secret:") and secrets.scan(empty(df)).count() == 0


def test_lm_trigrams(spark, docs):
    """Scores of order 3 against a walk of the automaton, arc by arc."""
    train = F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    taught = [tokens(t) for i, t in rows if i is not None and i % 3 != 1]
    c = Counter(w for t in taught for w in t)
    pairs = Counter(p for t in taught for p in zip(["<s>", *t], t, strict=False))
    triples = Counter(x for t in taught for x in zip(["<s>", *t], t, t[1:], strict=False))
    n, v, b2, b3, d = sum(c.values()), len(c), 500.0, 30.0, 0.75

    def walk(words):
        total, state = 0.0, ("<s>",)
        for w in words:
            failed = 0.0
            while True:
                if len(state) == 2 and triples[(*state, w)]:
                    p = (triples[(*state, w)] + b3 * arc(state[1:], w)) / (pairs[state] + b3)
                    break
                if len(state) == 1 and pairs[(*state, w)]:
                    p = arc(state, w)
                    break
                if not state:
                    p = arc(state, w)
                    break
                seen = pairs[state] if len(state) == 2 else c[None if state == ("<s>",) else state[0]]
                b = b3 if len(state) == 2 else b2
                failed += math.log10(b / (seen + b))
                state = state[1:]
            total += failed + math.log10(p)
            state = (last[0], w) if (last := (words_before[-1:] or ["<s>"])) else (w,)
            words_before.append(w)
        return total

    def arc(state, w):
        root = (max(c[w] - d, 0) + d * v / (v + 1)) / n
        return (pairs[(*state, w)] + b2 * root) / (c[None if state == ("<s>",) else state[0]] + b2) if state else root

    want = []
    for i, t in rows:
        words_before = []
        want.append((str(i), round(walk(tokens(t)), 6)))
    for blocks in (1, 3):
        assert sorted((str(r.doc_id), round(r.score, 6)) for r in lm.score(docs, train, order=3, blocks=blocks).collect()) == sorted(want)


def test_lm_packing():
    rng = np.random.default_rng(4)
    for n, top in ((0, 10), (1, 1 << 60), (1000, 1 << 48), (5000, 300), (7, 1 << 64)):
        keys = np.unique(rng.integers(0, top, n, dtype=np.uint64, endpoint=False) if top < 1 << 64 else rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        assert (lm.unpack_sorted(lm.pack_sorted(keys)) == keys).all()
        counts = rng.integers(0, 600, n)
        assert (lm.unpack_counts(lm.pack_counts(counts), n) == counts).all()


def test_forest_paths():
    """Scores are the mean path lengths, walked tree by tree."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3))
    forest = quality_rules.grow(x, 20, 64, 7)
    for row, score in zip(x[:30], forest.score(x[:30]), strict=True):
        total = 0.0
        for t in range(20):
            at = 0
            while forest.feature[t, at] >= 0:
                at = forest.child[t, at] + int(row[forest.feature[t, at]] >= forest.split[t, at])
            total += forest.path[t, at]
        assert abs(score - 2 ** (-total / 20 / quality_rules.mean_path(64))) < 1e-12


def test_forest_of_nearly_equal_values():
    """Values one unit in the last place apart: a split may leave one side empty."""
    x = np.array([[1.0, 2.0], [np.nextafter(1.0, 2), 2.0], [1.0, np.nextafter(2.0, 3)]] * 30)
    for seed in range(20):
        assert np.isfinite(quality_rules.grow(x, 20, 64, seed).score(x)).all()


@pytest.mark.parametrize("bits", [1, 7, 13, 14, 22, 40])
def test_simhash_places_lose_no_pair(bits):
    """Two fingerprints within 4 bits agree in a place, whatever the number of bits."""
    rng = np.random.default_rng(bits)
    masks = simhash.places(bits)
    for _ in range(300):
        flips = np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, 4, replace=False).astype(np.uint64))
        assert ((flips & masks) == 0).any()


def test_simhash_close_pairs():
    """The index against all pairs, within one list and between two, with close groups, and its counts."""
    rng = np.random.default_rng(2)

    def listed(n):
        base = rng.integers(0, 1 << 63, n, np.uint64)
        near = base[: n // 3] ^ (np.uint64(1) << rng.integers(0, 64, n // 3).astype(np.uint64))
        both = np.unique(np.concatenate([base, near]))
        rank = both.copy()
        for shift in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(shift)
        return both[np.argsort(rank)]

    for n, m in ((3, 1), (40, 17), (3000, 2000)):
        a, b = listed(n), listed(m)
        b = np.unique(np.concatenate([b, a[: m // 2] ^ np.uint64(5)]))
        far = np.bitwise_count(a[:, None] ^ a[None, :])
        assert set(zip(*(x.tolist() for x in simhash.close_pairs(a)), strict=True)) == {(i, j) for i, j in zip(*np.nonzero(far <= 4), strict=True) if i < j}
        far = np.bitwise_count(a[:, None] ^ b[None, :])
        assert set(zip(*(x.tolist() for x in simhash.close_pairs(a, b)), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(far <= 4)), strict=True))


def test_url_filter_long_urls(spark):
    """Work grows with a URL's length, not with its square."""
    rows = [(k, f"https://a.org/{'path/' * n}x") for k, n in enumerate((20_000, 20_000, 1, 2))] + [(4, "https://b.com/de/" + "y" * 100_000), (5, "no scheme " * 10_000)]
    began = time.time()
    out = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert time.time() - began < 60 and out[0].rule == "org/" and out[4].verdict == "block" and out[5].host == ""


def test_line_dedup_does_not_depend_on_the_rest_of_the_page(spark):
    """The same long line goes from a page of little else and from a page of much else; as an option, such pages stay whole."""
    line = " ".join(f"w{k}" for k in range(60))
    rows = [(1, "s", line), (2, "s", line + "\nshort"), (3, "s", "other text\n" * 1 + line + "\n" + "own words here " * 100), (4, "s", None), (5, None, line)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r.text for r in line_dedup.drop_boilerplate(docs).collect()}
    assert got == {1: line, 2: "short", 3: "other text\n" + "own words here " * 100, 4: None, 5: line}
    assert {r.doc_id: r.text for r in line_dedup.drop_boilerplate(docs, whole_copies=True).collect()}[2] == line + "\nshort"


def test_line_dedup_very_long_lines(spark):
    rows = [(k, "s", "x" * 200_000 + "\n" + " ".join(f"z{n}" for n in range(20_000)) + f"\nown {k}") for k in range(3)]
    got = [r.text for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, source string, text string")).orderBy("doc_id").collect()]
    assert got[1:] == [f"{'x' * 200_000}\nown {k}" for k in (1, 2)]  # one word isn't a long line: 3 pages of it are too few


def test_line_dedup_lookups_stay_small_however_many_lines_a_host_has(spark):
    n = 2000
    found = spark.range(n).selectExpr("if(id < 10, null, 'h') host", "xxhash64(id) line", "false long", "id first_id")
    lists = {r.h: r.m for r in line_dedup.slotted(found, F.struct("line", F.struct("long", "first_id"))).toDF("h", "m").collect()}
    assert set(lists) == {None, "h"} and sum(len(m or {}) for maps in lists.values() for m in maps) == n
    assert max(len(m or {}) for m in lists["h"]) < 30  # a map is searched from end to end
    assert all(line % len(maps) == k for maps in lists.values() for k, m in enumerate(maps) for line in m or {})

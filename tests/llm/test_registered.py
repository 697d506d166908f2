"""The registered queries on the smallest table against brute force: digests, types and rows."""

import hashlib
import math
import zlib

import numpy as np
import pytest

from tests.llm.test_operators import brute_fingerprint, brute_groups, brute_hits
from veriframe.llm import bpe, decontam, importance, quality_rules, simhash
from veriframe.llm.common import WORD, ascii_lower, table
from veriframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_op4(spark, texts):
    items = [(str(r.item_id), decontam.words_of(r.text)) for r in table(spark, SF, "benchmark").collect()]
    for r in QUERIES["op4_decontaminate"](spark, SF).collect():
        words = decontam.words_of(texts[r.doc_id])
        hit, found = brute_hits(items, words, 10) if len(words) < 400 else (None, None)
        if hit is not None:
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(words), len(hit), len(found), digest(",".join(sorted(found)).encode()), bool(hit))


def test_op5(spark, texts):
    out = QUERIES["op5_simhash"](spark, SF).collect()
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    groups = brute_groups(list(prints), list(prints.values()))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in out} == {i: (f"{prints[i]:016x}", groups[i]) for i in texts}


def test_op7(spark, texts):
    from array import array

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    for r in QUERIES["op7_bpe"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(array("I", ids).tobytes()), digest(library.decode(ids, skip_special_tokens=False).encode()))


def test_op2(spark, texts):
    out = QUERIES["op2_lm_score"](spark, SF)
    assert out.dtypes[:5] == [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint")]
    rows = out.collect()
    words = {i: len(WORD.findall(ascii_lower(t or ""))) + 1 for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    total = sum(n for i, n in words.items() if not held[i])
    assert {r.doc_id: (r.held_out, r.n_tokens, r.train_tokens) for r in rows} == {i: (held[i], words[i], total) for i in texts}
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


@pytest.mark.parametrize("name", ["op1_token_counts", "op3_quality_rules", "op10_importance"])
def test_rows(spark, texts, name):
    assert sorted(r.doc_id for r in QUERIES[name](spark, SF).collect()) == sorted(texts)


def test_op3(spark, texts):
    """Features, path lengths, the limit and the verdicts by plain loops."""
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    forest = quality_rules.fit(docs, labels)

    def features(text: str) -> list[float]:
        words = WORD.findall(text)
        n = len(words)
        each = [sum(c in "#*$%&|<>" for c in text), sum(a == b for a, b in zip(words, words[1:], strict=False)), sum(w.count("!") + w.count("?") for w in words)]
        parts = [words[k : k + 20] for k in range(0, n - 19, 20)]
        return [*(math.log(1 + 20 * x / n) for x in each), sum(map(len, words)) / n, sum(len(set(p)) / 20 for p in parts) / len(parts)]

    def score(x: list[float]) -> float:
        total = 0.0
        for feature, split, child, path in zip(forest.feature, forest.split, forest.child, forest.path, strict=True):
            at = 0
            while feature[at] >= 0:
                at = child[at] + (x[feature[at]] >= split[at])
            total += path[at]
        return 2 ** (-total / len(forest.feature) / forest.usual)

    rows = {r.doc_id: r for r in QUERIES["op3_quality_rules"](spark, SF).collect()}
    scores = {i: score(features(texts[i])) for i, r in rows.items() if not r.base_failed}
    assert all(abs(rows[i].anomaly - s) < 1e-9 for i, s in scores.items())
    known = importance.labelled(labels, 20_000)
    place = {int(k): j for j, k in enumerate(known.ids)}
    held = [s for i, s in scores.items() if i in place and known.good[place[i]] and not known.fit[place[i]]]
    assert len(held) > 10 and abs(forest.limit - 1e-9 - float(np.quantile(held, 0.997))) < 1e-9
    assert all(r.kept == (not r.base_failed and r.anomaly <= forest.limit) for r in rows.values())
    assert len({round(rows[i].anomaly, 9) for i in scores if rows[i].kept}) > 20  # the forest tells good documents apart


def test_op3_finds_bad_rows(spark):
    """On labelled rows held out: all bad ones that pass the plain rules, at the stated loss of good ones."""
    large = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op3_quality_rules"](spark, large).collect()}
    known = importance.labelled(table(spark, large, "labels"), 20_000)
    labels = {r.doc_id: r.quality for r in table(spark, large, "labels").collect()}
    assert known.good.any()
    bad = [rows[i] for i, q in labels.items() if q == 0 and i in rows and not rows[i].base_failed]
    good = [rows[i] for i, q in labels.items() if q == 1 and i in rows and not rows[i].base_failed]
    assert sum(not r.kept for r in bad) >= 0.98 * len(bad) and sum(not r.kept for r in good) <= 0.006 * len(good)


def test_op5_against_all_rows(spark):
    """Every document that the query set (ids divisible by 50) is within 4 bits of is in its group; the index prunes most of its nodes."""
    rows = QUERIES["op5_simhash"](spark, "/root/testdata/sf0.1").collect()
    ids, groups = np.array([r.doc_id for r in rows]), np.array([r.component_id for r in rows])
    fps = np.array([int(r.fingerprint, 16) for r in rows], np.uint64)
    for k in np.flatnonzero(ids % 50 == 0):
        near = np.bitwise_count(fps ^ fps[k]) <= 4
        assert (groups[near] == groups[k]).all()
    distinct, bits = np.unique(fps), simhash.bits_for(len(np.unique(fps)))
    rank = distinct.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    ordered = distinct[np.argsort(rank)]
    seen, pairs = {}, 0
    for mask in simhash.places(bits):
        keys = ordered & np.uint64(mask)
        for key in np.unique(keys):
            bucket = ordered[keys == key]
            pairs += len(bucket) * (len(bucket) - 1) // 2
            simhash.close_pairs(bucket, seen=seen)
    print(f"op5 on sf0.1: {len(distinct)} fingerprints, {bits} bits a field, {pairs} pairs in buckets; nodes' pairs opened {seen['opened']}, pruned {seen['pruned']}; fingerprints compared {seen['compared']}")
    assert seen["pruned"] > 0 and seen["compared"] < pairs

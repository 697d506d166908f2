"""The corpus pipeline stage by stage against brute force on the smallest table."""

from array import array

import pytest

import corpus_pipeline as P
from tests.llm.test_operators import brute_fingerprint, brute_hits
from veriframe.llm import bpe, decontam
from veriframe.llm.common import saved, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), {}
    out["input"] = docs
    for name, stage in P.STAGES:
        docs = out[name] = saved(stage(spark, docs, SF))
    return out


def test_columns_and_shrinking(stages):
    names = list(stages)
    for before, after in zip(names[:-1], names[1:-1], strict=False):
        assert stages[after].columns == stages["input"].columns and stages[after].count() <= stages[before].count()


def test_near_duplicates_are_gone(stages):
    ids = {r.doc_id for r in stages["SimHash near-dedup"].collect()}
    before = {r.doc_id: brute_fingerprint(r.text) for r in stages["line dedup"].collect()}
    kept = sorted(ids)
    assert all((before[a] ^ before[b]).bit_count() > 4 for k, a in enumerate(kept) for b in kept[:k])
    assert all(any((f ^ g).bit_count() <= 4 and j != i for j, g in before.items()) for i, f in before.items() if i not in ids)


def test_benchmark_is_gone(spark, stages):
    items = [(str(r.item_id), decontam.words_of(r.text)) for r in table(spark, SF, "benchmark").collect()]
    clean = {r.doc_id: r.text for r in stages["benchmark decontamination"].collect()}
    for r in stages["SimHash near-dedup"].collect():
        words = decontam.words_of(r.text)
        hit, _ = brute_hits(items, words, 10)
        if not hit:
            assert clean[r.doc_id] == r.text
        elif len(hit) <= 0.5 * len(words):
            assert decontam.words_of(clean[r.doc_id]) == [w for k, w in enumerate(words) if k not in hit]
        else:
            assert r.doc_id not in clean


def test_tokens(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    texts = {r.doc_id: r.text for r in stages["benchmark decontamination"].collect()}
    rows = stages["BPE encoding and decoding"].collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert array("I", bytes(r.ids)).tolist() == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids and r.decoded == (texts[r.doc_id] or "")


def test_run_is_the_stages(spark, stages):
    assert sorted(map(str, P.run(spark, SF).collect())) == sorted(map(str, stages["BPE encoding and decoding"].collect()))


ODD = [(1, "one two three four five six seven eight nine ten " * 4), (1, "one two three four five six seven eight nine ten " * 4), (None, "a row without an id, with words of its own, enough of them to be told apart from others here"), (None, None), (2, None), (3, ""), (4, " \n\t\n "),
       (5, "é À ß 日本語 🙂 some words in other letters, and more of them, so that this is a text as well"), (5, "another text under the same id, which must not be lost because of what the first one is like"), (6, "word " * 30_000), (7, "x" * 100_000)]


def odd(spark):
    rows = [(i, t, None if k % 4 == 0 else "en", None if k % 3 == 0 else f"s{k % 2}", None if t is None else len(t), *["extra"] * 4) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, __own string, fp string, node string, score string")


def through(spark, docs):
    out = [docs]
    for _, stage in P.STAGES:
        out.append(saved(stage(spark, out[-1], SF)))
    return out[1:]


def test_odd_rows_pass_through(spark):
    """Nulls in any column, empty and very long texts, repeated rows, shared ids and clashing columns: no stage fails, none brings rows up."""
    *stages, last = through(spark, odd(spark))
    assert all(s.columns == odd(spark).columns for s in stages)
    counts = [len(ODD), *(s.count() for s in stages), last.count()]
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2]
    texts = [r.text for r in stages[2].collect()]
    assert len([t for t in texts if t and t.startswith("one two")]) <= 1  # repeated rows leave one
    before = {r.text for r in stages[1].collect() if r.doc_id == 5}
    assert {r.text for r in stages[2].collect() if r.doc_id == 5} == before  # what shares an id isn't a copy


def test_no_rows_pass_through(spark):
    assert [s.count() for s in through(spark, odd(spark).where("false"))] == [0] * 5

"""Near copies at a similarity of 0.8 against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from veriframe.llm import similar, sketching
from veriframe.llm.common import WORD, ascii_lower, saved, table
from veriframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def words_changed(words: list[str], every: int, tag: str) -> str:
    return " ".join(f"{tag}{k}" if k % every == every - 1 else w for k, w in enumerate(words))


def test_keeps_no_near_copy(spark):
    rnd = random.Random(5)
    rows = []
    for k in range(60):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.randrange(40, 300))]
        rows.append((4 * k, " ".join(words)))
        rows += [(4 * k + j, words_changed(words, every, f"x{k}_{j}_")) for j, every in ((1, 60), (2, 90), (3, 12))]
    rows += [(1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: set(similar.shingles(t.encode()).tolist()) for i, t in rows if t}
    group = {i: i for i, _ in rows}
    for i, _ in rows:
        for j, _ in rows:
            near = i in sets and j in sets and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
            if i < j and near and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    assert {r.doc_id for r in similar.keep_one(docs).collect()} == {i for i, g in group.items() if i == g}
    assert similar.keep_one(docs.where("false")).count() == 0


def test_pipeline_keeps_no_near_copy(spark):
    docs = table(spark, SF, "documents")
    for _, stage in P.STAGES[:3]:
        docs = saved(stage(spark, docs, SF))
    sets = [set(similar.shingles(r.text.encode()).tolist()) for r in docs.collect() if r.text]
    assert not any(5 * len(a & b) >= 4 * len(a | b) for k, a in enumerate(sets) for b in sets[:k] if a)


def test_crowded_key_over_partitions(spark):
    base = [f"w{k}" for k in range(400)]
    rows = [(i, words_changed(base, 300, f"y{i}_")) for i in range(120)] + [(500 + i, f"other text number {i} with words of its own a{i} b{i} c{i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted(r.doc_id for r in similar.keep_one(docs).collect()) == [0, *range(500, 550)]


def test_links_beside_the_leader(spark, monkeypatch):
    """A crowd of copies too different to be linked, and some near copies of these, over many blocks."""
    monkeypatch.setattr(similar, "BLOCK", 1500)
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(90):
        own = [f"z{k}_{i}" if rnd.random() < 0.05 else w for i, w in enumerate(base)]
        rows.append((10 * k, " ".join(own)))
        if k % 3 == 1:
            rows += [(10 * k + j, words_changed(own, every, f"v{k}_{j}_")) for j, every in ((1, 80), (2, 60))]
    sets = [(i, set(similar.shingles(t.encode()).tolist())) for i, t in rows]
    want = {(a, b) for k, (b, y) in enumerate(sets) for a, x in sets[:k] if 5 * len(x & y) >= 4 * len(x | y)}
    led = spark.createDataFrame([(i, 0, i // 20) for i, _ in rows[1:]], "node long, leader long, group long")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = docs.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("__id"), similar.own_digest("text").alias("__digest"))
    packed = similar.sets_of(docs, wanted, "doc_id", "text")
    got = {tuple(sorted((r.a, r.b))) for r in similar.block_links(similar.differences(led, packed, 80), 80).collect()}
    group = {i: i for i, _ in rows}
    for a, b in sorted(want):
        low, high = sorted((group[a], group[b]))
        group = {k: low if g == high else g for k, g in group.items()}
    assert len(want) > 30 and all(group[a] == group[b] for a, b in got)
    assert {r.doc_id for r in similar.keep_one(docs).collect()} == {i for i, g in group.items() if i == g}


def brute(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """(size of the set, number of the first row of the group, its own without words) of each (id, text), by all pairs."""
    sets = []
    for _, text in rows:
        words = WORD.findall(ascii_lower(text or ""))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    holders: dict[tuple, list[int]] = {}
    group = list(range(len(rows)))
    for k, own in enumerate(sets):
        shared: dict[int, int] = {}
        for x in own:
            for j in holders.setdefault(x, []):
                shared[j] = shared.get(j, 0) + 1
            holders[x].append(k)
        for j, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n) and group[j] != group[k]:
                low, high = sorted((group[j], group[k]))
                group = [low if g == high else g for g in group]
    return [(len(s), g) for s, g in zip(sets, group, strict=True)]


def test_op12_registered(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").orderBy("doc_id").collect()]
    out = QUERIES["op12_minhash"](spark, SF)
    assert out.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.collect()}
    want = {i: (n, rows[g][0], rows[g][0] == i) for (i, _), (n, g) in zip(rows, brute(rows, 85), strict=True)}
    assert got == want and sum(not w[2] for w in want.values()) > 5


def test_groups_at_the_limit(spark):
    """Pairs just at, over and under the limit, in crowds with one leader; ids in any order."""
    rnd = random.Random(4)
    rows = []
    for k in range(12):
        base = [f"b{k}_{i}" for i in range(rnd.randrange(60, 200))]
        for j in range(12):
            at = rnd.randrange(2, len(base) - 20)
            rows.append(" ".join(base[:at] + [f"n{k}_{j}_{i}" for i in range(rnd.randrange(0, 9))] + base[at + rnd.randrange(0, 9) :]))
    rnd.shuffle(rows)
    rows = [(f"id{k:03d}", t) for k, t in enumerate(rows)]
    docs = spark.createDataFrame(rows, "key string, body string")
    for percent in (80, 85):
        want = [(i, n, rows[g][0]) for (i, _), (n, g) in zip(rows, brute(rows, percent), strict=True)]
        assert sorted(map(tuple, similar.similar_groups(docs, id_col="key", text_col="body", percent=percent).collect())) == want
        assert len({w[2] for w in want}) > 15


def test_ids_nulls_and_repeated_rows(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    near = a.replace("a59", "z")
    rows = [(3, a), (5, near), (5, b), (None, a), (None, a), (None, c), (7, b), (7, b), (8, None), (9, ""), (9, "")]
    docs = spark.createDataFrame([(*r, "e", "e", "e", "e") for r in rows], "doc_id long, text string, node string, set string, __id string, root string")
    kept = sorted(((r.doc_id, r.text) for r in similar.keep_one(docs).collect()), key=repr)
    assert kept == sorted([(3, a), (5, b), (None, c), (8, None), (9, ""), (9, "")], key=repr)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in similar.similar_groups(docs).collect()), key=repr)
    want = [(3, 56, 3), (5, 56, 3), (5, 56, 5), (None, 56, 3), (None, 56, 3), (None, 56, None), (7, 56, 5), (7, 56, 5), (8, 0, 8), (9, 0, 9), (9, 0, 9)]
    assert got == sorted(want, key=repr)
    text_ids = docs.selectExpr("concat('k', coalesce(doc_id, 0)) as doc_id", "text")
    assert sorted(r.doc_id for r in similar.keep_one(text_ids).collect()) == ["k0", "k0", "k5", "k8", "k9", "k9"]  # rows of id 0: a and c
    assert similar.similar_groups(docs.where("false")).count() == 0


def test_sketch_fills_all_bins_and_measures_similarity():
    rnd = np.random.default_rng(1)
    for size in (1, 2, 5, 40, 300, 30_000):
        assert (sketching.sketch(rnd.integers(0, 1 << 63, size, np.uint64)) != sketching.EMPTY).all()
    for size, share in ((20, 0.8), (400, 0.85), (5000, 0.5)):
        agree = []
        for _ in range(60):
            both = rnd.integers(0, 1 << 63, size, np.uint64)
            own = rnd.integers(0, 1 << 63, (2, round(size * (1 - share) / 2 / share)), np.uint64)
            one, two = (sketching.sketch(np.concatenate([both, x])) for x in own)
            agree.append((one == two).mean())
        assert abs(np.mean(agree) - size / (size + 2 * own.shape[1])) < 0.04


def test_sketch_does_not_depend_on_the_steps(monkeypatch):
    x = np.random.default_rng(2).integers(0, 1 << 63, 700, np.uint64)
    whole = sketching.sketch(x)
    monkeypatch.setattr(sketching, "AT_ONCE", 64)
    assert (sketching.sketch(x) == whole).all() and (sketching.sketch(x[::-1]) == whole).all()

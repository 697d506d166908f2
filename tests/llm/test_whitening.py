"""Whitening against numpy's eigenvalues and exact integers, and on nulls, bad and ragged vectors, ties, repeated rows and empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veriframe.llm import whitening
from veriframe.llm.common import table
from veriframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_registered(spark):
    raw = {r.vec_id: np.array(r.embedding, np.float64) for r in table(spark, SF, "embeddings").collect() if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)}
    x = {i: np.floor(64 * c).astype(np.int64) + 1_000_000 for i, c in raw.items()}
    fitted = np.unique(np.stack(list(x.values())), axis=0)
    n, sums = len(fitted), fitted.sum(axis=0)
    centred = (n * fitted - sums) / n
    v = centred.T @ centred / n
    values, units = np.linalg.eigh(v)
    values, units = values[::-1][:16], units[:, ::-1][:, :16]
    out = QUERIES["op11_whitening"](spark, SF)
    assert out.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    rows = out.collect()
    assert len(rows) == 16 * len(x) and {r.n for r in rows} == {n} and {r.identity_error for r in rows if r.identity_error <= 1e-9} and len({r.identity_error for r in rows}) == 1
    white = {(r.vec_id, r.component): r.whitened for r in rows}
    for k in range(16):
        want = np.array([(x[i] - sums / n) @ units[:, k] / np.sqrt(values[k]) for i in sorted(x)])
        got = np.array([white[i, k + 1] for i in sorted(x)])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8
    for r in rows:
        assert abs(r.explained - values[r.component - 1] / v.trace()) < 1e-10
        assert r.deviation == sum((n * int(c) - int(s)) ** 2 for c, s in zip(x[r.vec_id], sums, strict=True))


@pytest.mark.parametrize("size,rank", [(1, 1), (2, 2), (7, 7), (12, 4), (40, 40), (33, 20)])
def test_eigen(size, rank):
    base = np.random.default_rng(size).normal(size=(size, rank)) * np.logspace(0, -3, rank)
    v = base @ base.T
    values, units = whitening.eigen(v)
    want = np.linalg.eigvalsh(v)[::-1][:rank]
    assert np.allclose(values[:rank], want, rtol=1e-6, atol=1e-14) and len(values) <= max(rank + 2, 1)
    assert np.allclose(units.T @ units, np.eye(len(values)), atol=1e-7) and np.allclose(units * values @ units.T, v, atol=1e-12)


def test_small_eigenvalues_are_precise():
    """A graded matrix, on which a plain symmetric solver has few correct digits of the small values."""
    scale = np.logspace(0, -7, 8)
    inner = np.eye(8) + 0.1 * np.cos(np.subtract.outer(np.arange(8), np.arange(8)) * 1.0)
    values, _ = whitening.eigen(scale[:, None] * inner * scale)
    least = 1 / np.linalg.eigvalsh(np.linalg.inv(inner) / np.outer(scale, scale)).max()  # the inverse's large values are precise
    assert len(values) == 8 and abs(values[-1] / least - 1) < 1e-9


def test_equal_values_and_zero():
    assert [len(p) for p in whitening.eigen(np.zeros((3, 3)))] == [0, 3]
    values, units = whitening.eigen(np.eye(5) * 4)
    assert values.tolist() == [4.0] * 5 and np.allclose(units.T @ units, np.eye(5))


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (None, [0.25, -1.0]), (4, None), (5, []), (6, [0.0, None]), (7, [nan, 0.0]), (8, [0.0, -inf]), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, "e", "e") for r in rows], "vec_id long, embedding array<double>, x string, whitened string")
    model = whitening.fit(df)
    assert model.n == 3 and model.sums == (3_000_080, 3_000_032) and len(model.values) == 2 and model.identity_error < 1e-12
    out = whitening.whiten(df, model).collect()
    assert sorted((r.vec_id or 0 for r in out)) == [0, 1, 2, 2] and all(len(r.whitened) == 2 for r in out)
    assert whitening.fit(df.where("false")) is None and whitening.fit(df.where("vec_id > 3 and vec_id < 9")) is None
    assert whitening.whiten(df, None).count() == 0
    alone = whitening.fit(df.where("vec_id = 2"))  # no two different vectors
    assert len(alone.values) == 0 and [(r.deviation, r.whitened) for r in whitening.whiten(df.where("vec_id = 2"), alone).collect()] == [(0, [])] * 2
    wide = spark.createDataFrame([("a", [3e38, 1.0]), ("b", [-3e38, 1.0]), ("c", [0.0, 1.0])], "key string, vec array<float>")
    model = whitening.fit(wide, vector_col="vec")
    got = {r.key: r.deviation for r in whitening.whiten(wide, model, id_col="key", vector_col="vec").collect()}
    assert got["a"] is None and got["b"] is None and len(model.values) == 1


def test_registered_without_vectors(spark, tmp_path):
    for name, where in (("none", "false"), ("bad", "vec_id < 0"), ("one", "vec_id = (select min(vec_id) from v)")):
        table(spark, SF, "embeddings").createOrReplaceTempView("v")
        spark.sql(f"select * from v where {where}").write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        assert QUERIES["op11_whitening"](spark, f"{tmp_path}/{name}").count() == 0


def test_many_partitions_give_the_same(spark):
    df = table(spark, SF, "embeddings")
    one, many = whitening.fit(df.coalesce(1)), whitening.fit(df.repartition(13).union(df.limit(50)))
    assert one.n == many.n and one.sums == many.sums and np.allclose(one.values, many.values, rtol=1e-12)
    assert np.allclose(one.components, many.components, atol=1e-8)
    assert whitening.grid(F.col("embedding")) is not None

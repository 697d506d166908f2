"""The fitted plane against numpy's singular vectors."""

import numpy as np
from pyspark.sql import functions as F

from veriframe.operators import geometry as G


def test_plane_patch(spark):
    rng = np.random.default_rng(1)
    clouds = [rng.normal(size=(k, 3)) * rng.uniform(0.01, 3, 3) + rng.normal(size=3) for k in (3, 5, 8, 21)] + [np.ones((4, 3)), np.outer(np.arange(5), [1.0, 2.0, 3.0])]
    rows = [(n, [tuple(map(float, p)) for p in c]) for n, c in enumerate(clouds)] + [(99, [])]
    df = spark.createDataFrame(rows, "id int, points array<struct<x:double,y:double,z:double>>")
    got = {r.id: r.c and np.array([tuple(p) for p in r.c]) for r in df.select("id", G.plane_patch(F.col("points")).alias("c")).collect()}
    assert got[99] is None
    for n, c in enumerate(clouds):
        corners, mean = got[n], c.mean(axis=0)
        radius = np.linalg.norm(c - mean, axis=1).max() * 1.35 or 0.03
        assert np.allclose(corners.mean(axis=0), mean, atol=1e-9) and np.allclose(np.linalg.norm(corners - mean, axis=1), radius * np.sqrt(2), rtol=1e-6)
        u, v = (corners[1] - corners[0]) / 2 / radius, (corners[3] - corners[0]) / 2 / radius
        assert abs(u @ v) < 1e-9
        if n < 4:  # one best plane and direction
            _, _, vt = np.linalg.svd(c - mean)
            assert abs(abs(u @ vt[0]) - 1) < 1e-6 and abs(abs(v @ vt[1]) - 1) < 1e-6


def test_eigen3(spark):
    rng = np.random.default_rng(2)
    made = [b @ b.T for b in rng.normal(size=(12, 3, 3))] + [np.diag([1.0, 5.0, 3.0]), np.zeros((3, 3))]
    df = spark.createDataFrame([(n, m.ravel().tolist()) for n, m in enumerate(made)], "id int, m array<double>")
    for r in df.select("id", G.eigen3(F.col("m")).alias("e")).collect():
        assert np.allclose([e.value for e in r.e], np.linalg.eigvalsh(made[r.id])[::-1], atol=1e-9)
        vectors = np.array([[e.x, e.y, e.z] for e in r.e])
        assert np.allclose(vectors @ vectors.T, np.eye(3), atol=1e-9) and np.allclose(made[r.id] @ vectors.T, vectors.T * [e.value for e in r.e], atol=1e-8)

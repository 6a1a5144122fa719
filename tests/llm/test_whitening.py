"""Whitening against numpy on exact integers, and on vectors without full rank."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import whitening
from starmart.llm.queries import op13_whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def whitened(spark, rows, k=4):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"x": F.lit("x"), "n": F.lit(1.5), "component": F.lit(0)})
    return whitening.whiten(frame.repartition(3), k).collect()


def check(got, rows, k=4, close=1e-9):
    """Against the singular values of the centred rows."""
    kept = [(i, np.floor(256 * np.asarray(v, np.float32).astype(float)).astype(int)) for i, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    _, sigma, vectors = np.linalg.svd(centred, full_matrices=True)
    values, vectors = np.pad(sigma**2 / n, (0, fit.shape[1] - len(sigma))), vectors.T
    k = min(k, fit.shape[1])
    assert len(got) == k * len(kept)
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    for i, x in kept:
        exact = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
        for j in range(k):
            r = by_row[i][j + 1]
            assert (r.n, r.deviation) == (n, exact)
            assert r.explained == pytest.approx(values[j] / values.sum(), rel=1e-8)
            assert r.identity_error < close
            sign = np.sign(vectors[np.abs(vectors[:, j]).argmax(), j])
            expected = sign * (x - sums / n) @ vectors[:, j] / np.sqrt(values[j])
            assert r.whitened == pytest.approx(expected, rel=1e-7, abs=100 * close)


def test_noise_of_uneven_scales(spark):
    noise = np.random.default_rng(13)
    values = noise.normal(size=(400, 6)) @ np.diag([40, 9, 3, 1, 0.4, 0.1]) + 7
    rows = [(i, v.tolist()) for i, v in enumerate(values.astype(np.float32))]
    repeated = [*rows, *((1000 + i, rows[5][1]) for i in range(300))]
    check(whitened(spark, repeated), repeated)


def test_left_out_rows(spark):
    good = [(1, [0.5, -0.25]), (2, [0.1, 0.0]), (None, [-3.0, 1.0])]
    bad = [(4, None), (5, [1.0, None]), (6, [float("nan"), 0.0]), (7, [float("inf"), 0.0]), (8, []), (9, [1.0, 2.0, 3.0])]
    check(whitened(spark, good + bad), good)


def test_lacking_rank(spark):
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)]
    got = whitened(spark, line)
    assert len(got) == 60
    for r in got:
        assert (r.whitened is None, r.explained == 0) == (r.component > 1,) * 2
        assert r.identity_error < 1e-9
    assert all(r.whitened is None and r.deviation == 0 for r in whitened(spark, [(1, [3.0, 4.0])] * 5))


def test_empty(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        frame = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert frame.collect() == [] and frame.columns[0] == "vec_id"


def test_numbers_beyond_64_bits(spark):
    rows = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [5e11, 2.0])]
    assert [r.deviation for r in whitened(spark, rows)] == [None] * 6


def test_ill_conditioned_columns(spark):
    """Two nearly equal columns: the covariance's condition is near 1e13, its third variance still right."""
    noise = np.random.default_rng(5)
    base = noise.integers(-(2**22), 2**22, size=300)
    rows = [(i, [b / 256, b / 256 + (i % 2) / 256, (i % 7) / 256]) for i, b in enumerate(base.tolist())]
    check(whitened(spark, rows), rows, close=1e-6)


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(op13_whitening(spark, sf_dir).collect(), [tuple(r) for r in rows])

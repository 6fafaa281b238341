import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from abundix.llm import whitening
from abundix.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, x int, n int"


def brute(rows):
    """What whitening should give, with numpy's own eigenvectors: deviations, whitened values, shares."""
    kept = []
    for vec_id, vector in rows:
        if vector is not None and all(c is not None and math.isfinite(c) for c in vector):
            kept.append((vec_id, tuple(math.floor(256 * float(c)) for c in vector)))
    size = max((len(x) for _, x in kept), default=0)
    kept = [(i, x + (0,) * (size - len(x))) for i, x in kept]
    fit = np.array(sorted({x for _, x in kept}), dtype=np.int64)
    n, total = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    out = []
    for vec_id, x in kept:
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, total))
        w = (np.array(x) - total / n) @ vectors[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
        for k in range(4):
            out.append((vec_id, k + 1, n, deviation, abs(w[k]), values[::-1][k] / values.sum()))
    return out


def rounded(rows):
    return sorted(((i, k, n, d, round(w, 6), round(e, 9)) for i, k, n, d, w, e in rows), key=str)


def result(df):
    return [(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in df.collect()]


def test_inertia_counts_signs():
    r = np.random.default_rng(1)
    for size in (1, 2, 3, 8, 30):
        for _ in range(40):
            a = r.integers(-2, 3, size=(size, size)).astype(float)
            a = a + a.T
            values = np.linalg.eigvalsh(a)
            if np.abs(values).min() > 1e-9:
                assert whitening.inertia(a) == ((values > 0).sum(), (values < 0).sum())
    assert whitening.inertia(np.zeros((3, 3))) == (0, 0)
    assert whitening.inertia(np.array([[0.0, 2.0], [2.0, 0.0]])) == (1, 1)


@pytest.mark.parametrize("spectrum", [(9, 4, 1, 0.5, 0.25), (4, 4, 4, 1, 1), (1, 1 - 1e-9, 1 - 2e-9, 1e-3, 0), (1, 1e-5, 1e-10, 0, 0), (3, 0, 0, 0, 0)])
def test_eigenpairs_of_known_spectra(spectrum):
    r = np.random.default_rng(2)
    size = 5 * len(spectrum)
    q = np.linalg.qr(r.normal(size=(size, size)))[0]
    wanted = np.zeros(size)
    wanted[: len(spectrum)] = spectrum
    matrix = (q * wanted) @ q.T
    values, vectors = whitening.leading_eigenpairs((matrix + matrix.T) / 2, 4)
    positive = [s for s in spectrum[:4] if s > 0]
    assert np.allclose(values, positive, rtol=1e-5, atol=1e-13)
    assert np.allclose(vectors @ vectors.T, np.eye(len(positive)), atol=1e-12)
    assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-12)


def test_sums_beyond_64_bits_are_exact():
    big = np.array([[3 << 60, -5], [-(3 << 60), 7]])
    assert whitening._gram(big)[0, 0] == 2 * (3 << 60) ** 2
    assert whitening._shifted(big, 10, [1, 1])[0, 0] == 10 * (3 << 60) - 1
    limbs = whitening._limbs(0, 0, -(5 << 70) - 3)
    assert (limbs["high"] << 62) + limbs["low"] == -(5 << 70) - 3


def test_odd_rows(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=6).tolist()) for i in range(40)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (50, rows[5][1]), (51, None), (52, [1.0, None] * 3), (53, [math.nan] * 6), (54, [math.inf] + [0.0] * 5)]
    rows += [(55, []), (56, [-0.0, 0.5]), (57, rows[0][1]), (57, rows[0][1])]
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA).repartition(3)
    model = whitening.fit(df)
    got = whitening.whiten(df, model)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert rounded(result(got)) == rounded(brute(rows))
    assert model.identity_error < 1e-10


def test_few_directions_and_no_rows(spark):
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], 1, 2, 3) for i in range(10)], SCHEMA)
    assert {r.component for r in whitening.whiten(line, whitening.fit(line)).collect()} == {1}
    for none in (line.where("false"), line.where("vec_id = 3"), spark.createDataFrame([(1, [], 1, 2, 3)], SCHEMA)):
        assert whitening.whiten(none, whitening.fit(none)).count() == 0


def test_huge_entries_do_not_crash(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0]), (4, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA)
    got = result(whitening.whiten(df, whitening.fit(df)))
    assert {(i, d) for i, _, _, d, _, _ in got if i < 3} == {(1, None), (2, None)}


def test_query_as_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{folder}/embeddings.parquet").to_pylist()]
    df = QUERIES["op12_embedding_whitening"](spark, folder)
    assert rounded(result(df)) == rounded(brute(rows))
    assert {r.identity_error < 1e-8 for r in df.collect()} == {True}

import math

import numpy as np
import pytest

from feedlake.llm import bidiagonal, queries, whitening
from tests.llm.conftest import SF


@pytest.mark.parametrize("kind", ["plain", "graded", "low rank", "equal", "repeated columns", "one column", "zero"])
def test_solver_equals_a_dense_one(kind):
    rng = np.random.default_rng(5)
    a = rng.standard_normal((90, 1 if kind == "one column" else 30))
    if kind == "graded":
        a = a * 10.0 ** -np.linspace(0, 12, 30)
    elif kind == "low rank":
        a = a[:, :3] @ a[:3]
    elif kind == "equal":
        a = np.linalg.qr(a)[0] * 3
    elif kind == "repeated columns":
        a[:, 4] = a[:, 9]
    elif kind == "zero":
        a = a * 0
    r = np.linalg.qr(a, mode="r")
    want = np.linalg.svd(a, compute_uv=False) ** 2
    values, vectors = bidiagonal.right_vectors(r, 4)
    assert len(values) == {"low rank": 3, "one column": 1, "zero": 0}.get(kind, 4)
    assert np.allclose(values, want[:len(values)], rtol=1e-12)
    if len(values):
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
        assert np.abs(a.T @ (a @ vectors.T) - vectors.T * values).max() < 1e-12 * want[0]


def brute(rows, k=4):
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and not any(c is None or not math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, mean = len(fit), fit.mean(axis=0)
    sums = [int(s) for s in fit.sum(axis=0)]
    cov = (fit - mean).T @ (fit - mean) / n
    e, vectors = np.linalg.eigh(cov)
    e, vectors = e[::-1][:k], vectors.T[::-1][:k]
    return [(i, j + 1, n, sum((n * c - s) ** 2 for c, s in zip(x, sums)), float((np.array(x) - mean) @ vectors[j] / np.sqrt(e[j])),
             e[j] / np.trace(cov)) for i, x in kept for j in range(len(e)) if e[j] > 1e-9 * e[0]]


def check(found, want):
    assert len(found) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    rows = [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in found]
    signs = {}
    for a, b in zip(sorted(rows, key=key), sorted(want, key=key)):
        assert a[:4] == b[:4] and abs(a[5] - b[5]) < 1e-9
        if abs(b[4]) > 1e-3:
            assert signs.setdefault(a[1], np.sign(a[4] * b[4])) == np.sign(a[4] * b[4])
        assert abs(abs(a[4]) - abs(b[4])) < 1e-6
    assert max((r.identity_error for r in found), default=0) < 1e-9


def test_whitening_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(queries.QUERIES["op13_whitening"](spark, SF).collect(), brute(rows))


def test_whitening_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(6)]) for i in range(60)]
    rows += [(None, rows[3][1]), (7, rows[7][1]), (7, rows[8][1])] + [(100 + i, rows[0][1]) for i in range(50)]
    rows += [(61, None), (62, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (63, [float("nan")] * 6), (64, [float("-inf")] + [0.0] * 5)]
    odd = [(65, [1.0, 2.0]), (66, []), (67, [0.5])]
    table = spark.createDataFrame([(i, v, "?", "?") for i, v in rows + odd], "vec_id long, embedding array<float>, x string, n string")
    check(whitening.whiten(table.repartition(40)).collect(), brute(rows))
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(one).count() == 0 and whitening.whiten(one.limit(0)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)], "vec_id long, embedding array<float>")
    check(whitening.whiten(line).collect(), brute([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]))


def test_whitening_of_huge_entries(spark):
    table = spark.createDataFrame([(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [1e15, 7.0])], "vec_id long, embedding array<float>")
    found = whitening.whiten(table).collect()
    assert {r.vec_id for r in found} == {1, 2, 3} and all(r.deviation is None for r in found)
    assert all(math.isfinite(r.whitened) for r in found)

"""Embedding whitening against eigenvectors of the whole covariance."""

import math

import numpy as np
import pytest

from flowloom.llm.queries import QUERIES
from flowloom.llm.whitening import leading, whiten

SMALL = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, x string, n string, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "n", 3) for i, v in rows], SCHEMA)


def plain(rows, k=4, scale=256.0):
    """{row place: (n, deviation, whitened up to sign, explained)}."""
    good = [(p, [math.floor(scale * c) for c in v]) for p, (_, v) in enumerate(rows) if v and all(c is not None and math.isfinite(c) for c in v)]
    points = sorted({tuple(x) for _, x in good})
    n, sums = len(points), [sum(c) for c in zip(*points)]
    mean = np.array(sums) / n
    centred = np.array(points, float) - mean
    e, v = np.linalg.eigh(centred.T @ centred / n)
    order = [i for i in np.argsort(-e)[:k] if e[i] > 1e-9 * e.sum()]
    return {p: (n, sum((n * c - s) ** 2 for c, s in zip(x, sums)), (np.array(x) - mean) @ v[:, order] / np.sqrt(e[order]), e[order] / e.sum()) for p, x in good}


def held(got, rows, want):
    """Compare collected rows with the plain result, one sign per component."""
    assert len(got) == len(want)
    mine = sorted(((r.vec_id is None, r.vec_id or 0, r.deviation, r.whitened, r) for r in got), key=lambda x: x[:4])
    theirs = sorted(((rows[p][0] is None, rows[p][0] or 0, w[1], w) for p, w in want.items()), key=lambda x: x[:3])
    signs = None
    for a, b in zip(mine, theirs):
        assert a[:3] == b[:3] and a[4].n == b[3][0]
        white, expected = np.array(a[3]), b[3][2]
        if signs is None and len(white) and (np.abs(expected) > 1e-3).all():
            signs = np.sign(white * expected)
        assert np.allclose(np.abs(white), np.abs(expected), atol=1e-7)
        assert signs is None or np.allclose(white, signs * expected, atol=1e-7)
        assert np.allclose(a[4].explained, b[3][3], rtol=1e-6)
        assert a[4].identity_error < 1e-9


def odd_rows(d=12, count=400):
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
    x = (rng.normal(size=(count, d)) * np.linspace(3, 0.2, d)) @ turn + rng.normal(size=d)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    rows += [(5, rows[5][1]), (1000, rows[7][1]), (None, rows[8][1])] + [(2000 + i, rows[9][1]) for i in range(300)]
    return rows + [(3000, None), (3001, []), (3002, [None] + [1.0] * (d - 1)), (3003, [float("nan")] * d), (3004, [float("-inf")] + [0.0] * (d - 1)), (3005, [-0.0] * d)]


def test_against_eigenvectors(spark):
    rows = odd_rows()
    held(whiten(frame(spark, rows)).collect(), rows, plain(rows))


def test_few_directions(spark):
    """Fewer components than asked for, and none at all."""
    rows = [(i, [float(i), 2.0 * i, 1.0]) for i in range(20)]
    held(whiten(frame(spark, rows)).collect(), rows, plain(rows))
    same = whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.explained) for r in same] == [(1, 1, 0, [], []), (2, 1, 0, [], [])]
    assert whiten(frame(spark, [])).collect() == [] and whiten(frame(spark, [(1, None)])).collect() == []


def test_lengths_are_spaces_of_their_own(spark):
    rng = np.random.default_rng(6)
    one = [(i, [float(np.float32(c)) for c in rng.normal(size=3) * [3, 2, 1]]) for i in range(50)]
    two = [(100 + i, [float(np.float32(c)) for c in rng.normal(size=2) * [3, 1]]) for i in range(50)]
    got = whiten(frame(spark, one + two)).collect()
    held([r for r in got if r.vec_id < 100], one, plain(one))
    held([r for r in got if r.vec_id >= 100], two, plain(two))


def test_large_entries(spark):
    """Deviations that 64 bits do not hold are null, all others exact."""
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 5.0])]
    got = {r.vec_id: r.deviation for r in whiten(frame(spark, rows)).collect()}
    assert got[1] is None and got[2] is None and len(got) == 3
    big = [(1, [3.0e6, 0.0]), (2, [-3.0e6, 1.0]), (3, [0.0, 5.0])]
    want = plain(big)
    assert {r.vec_id: r.deviation for r in whiten(frame(spark, big)).collect()} == {big[p][0]: w[1] for p, w in want.items()}


@pytest.mark.parametrize("values", [[5, 5, 5, 4, 4, 1, 1, 1], [3, 3, 3, 3, 3, 3], [9, 0, 0, 0, 0], list(0.9 ** np.arange(40))])
def test_equal_deviations_are_all_found(values):
    rng = np.random.default_rng(8)
    d = len(values)
    x = np.diag(np.array(values, float)) @ np.linalg.qr(rng.normal(size=(d, d)))[0]

    def product(z):
        u = x @ z
        return u @ u, x.T @ u

    found = leading(product, d, 4)
    assert np.allclose([s for s, _ in found], sorted(values, reverse=True)[:len(found)], atol=1e-9) and len(found) == 4
    basis = np.array([v for _, v in found])
    assert np.abs(basis @ basis.T - np.eye(4)).max() < 1e-12


def test_query(spark):
    got = QUERIES["op11_whitening"](spark, SMALL).collect()
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    want = plain(rows)
    assert len(got) == 4 * len(want) and {r.component for r in got} == {1, 2, 3, 4}
    by_id = {rows[p][0]: w for p, w in want.items()}
    assert all(r.deviation == by_id[r.vec_id][1] and abs(abs(r.whitened) - abs(by_id[r.vec_id][2][r.component - 1])) < 1e-6 for r in got)
    assert all(abs(r.explained / by_id[r.vec_id][3][r.component - 1] - 1) < 1e-6 and r.identity_error < 1e-9 for r in got)

from fractions import Fraction

import numpy as np
import pytest

from tidewatch.llm import whitening as W
from tidewatch.llm.eigen import LONG, eigen

SCHEMA = "vec_id long, embedding array<float>, n int, vector string, length string, total string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows], SCHEMA).repartition(3)


def reflected(values, seed=0):
    """A matrix of known eigenvectors: exact products of a reflection, rounded once."""
    rng = np.random.default_rng(seed)
    v = [Fraction(int(x)) for x in rng.integers(1, 9, len(values))]
    norm = sum(x * x for x in v)
    n = len(values)
    q = [[Fraction(int(i == j)) - 2 * v[i] * v[j] / norm for j in range(n)] for i in range(n)]
    exact = lambda f: LONG(f.numerator) / LONG(f.denominator)
    a = [[exact(sum(q[i][k] * values[k] * q[j][k] for k in range(n))) for j in range(n)] for i in range(n)]
    return np.array(a, LONG), np.array([[exact(x) for x in row] for row in q], LONG)


def residual(a, values, x):
    scale = np.abs(a).max()
    return max(np.abs(a @ x - x * values).max() / scale, np.abs(x.T @ x - np.eye(len(a))).max())


def test_eigenvectors_beyond_double():
    values = [Fraction(100 - 3 * k) for k in range(20)]
    a, q = reflected(values)
    got, x = eigen(a)
    assert np.abs(got - np.array([LONG(int(v)) for v in values])).max() < 1e-15
    assert np.abs(np.abs(x) - np.abs(q)).max() < 1e-17
    assert (x[np.abs(x).argmax(axis=0), range(20)] > 0).all()


@pytest.mark.parametrize("gap", [6, 9, 12])
def test_clustered_eigenvalues(gap):
    """Single precision can't tell the cluster's vectors apart; the sub-solve can."""
    values = [Fraction(10), Fraction(5), *[Fraction(2) + Fraction(k, 10**gap) for k in range(5, 0, -1)], Fraction(1)]
    a, q = reflected(values, 3)
    got, x = eigen(a)
    assert residual(a, got, x) < 1e-17
    assert np.abs(np.abs(x) - np.abs(q)).max() < 1e-18 * 10**gap


def test_equal_eigenvalues():
    for values in ([Fraction(3)] * 4 + [Fraction(1)] * 3, [Fraction(7)] * 5, [Fraction(0)] * 3 + [Fraction(1)], []):
        a, _ = reflected(values, 5) if values else (np.zeros((0, 0), LONG), None)
        got, x = eigen(a)
        assert not values or residual(a, got, x) < 1e-17
        assert len(got) == len(values) and (np.diff(got) <= 0).all()


def test_agrees_with_double_precision():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(90, 70))
    a = a.T @ a
    got, x = eigen(a)
    want, y = np.linalg.eigh(a)
    assert np.abs(got.astype(float) / want[::-1] - 1).max() < 1e-9
    assert np.abs(np.abs((y[:, ::-1] * x.astype(float)).sum(axis=0)) - 1).max() < 1e-12
    assert residual(np.asarray(a, LONG), got, x) < 1e-17


def brute(rows, components=8):
    """Whole numbers and covariance in Python integers."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(d)]
    away = [[n * r[k] - s[k] for k in range(d)] for r in x]
    cov = np.array([[Fraction(sum(r[i] * r[j] for r in away), n**3) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(cov.astype(float))
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    white = np.array(away, float) / n @ u / np.sqrt(e)
    return [sum(c * c for c in r) for r in away], white, e / float(sum(cov[i, i] for i in range(d)))


def test_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(200, 12)) * np.linspace(2, 0.3, 12) + rng.normal(size=12)
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(base)]
    rows += [rows[5], rows[5], (None, rows[9][1])]
    bad = [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, [float("-inf")] * 12), (904, [1e30] * 12)]
    got = W.whiten(frame(spark, rows + bad)).collect()
    away, white, explained = brute(rows)
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        assert r.n == len(rows) and r.identity_error < 1e-12
        assert np.abs(np.array(r.explained) - explained).max() < 1e-12
        by_id.setdefault(r.vec_id, []).append(r)
    for (key, _), d, w in zip(rows, away, white):
        r = by_id[key].pop()
        assert int(r.deviation) == d
        assert np.abs(np.abs(r.whitened) - np.abs(w)).max() < 1e-9


def test_same_for_any_partitioning(spark):
    rng = np.random.default_rng(3)
    rows = [(k, v) for k, v in enumerate(rng.normal(size=(300, 6)).astype(np.float32).tolist())]
    one, many = (sorted(W.whiten(frame(spark, rows).repartition(n)).collect(), key=lambda r: r.vec_id) for n in (1, 7))
    for a, b in zip(one, many):
        assert (a.deviation, a.explained) == (b.deviation, b.explained)
        assert np.abs(np.subtract(a.whitened, b.whitened)).max() < 1e-13


def test_degenerate(spark):
    assert W.whiten(frame(spark, [])).count() == 0
    (only,) = W.whiten(frame(spark, [(1, [0.5, 0.25])])).collect()
    assert (only.n, only.deviation, only.whitened, only.explained, only.identity_error) == (1, 0, [None] * 2, [0.0] * 2, None)
    flat = W.whiten(frame(spark, [(k, [k / 4, 1.0, k / 2]) for k in range(8)])).collect()
    assert all(r.whitened[1:] == [None] * 2 and r.identity_error < 1e-12 for r in flat)
    mixed = [(k, [float(k), float(k * k % 5)]) for k in range(9)] + [(20 + k, [float(k)]) for k in range(3)] + [(30, [])]
    got = {r.vec_id: r for r in W.whiten(frame(spark, mixed), components=None).collect()}
    assert {r.n for r in got.values()} == {9, 3, 1} and got[30].whitened == [] and got[30].n == 1
    assert [round(got[20 + k].whitened[0], 9) for k in range(3)] == [-1.224744871, 0.0, 1.224744871]


def test_query_on_the_given_tables(spark, sf_dir):
    rows = W.op13_whitening(spark, sf_dir).collect()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    away, white, explained = brute([(r.vec_id, r.embedding) for r in table])
    assert len(rows) == 8 * len(table) and len({r.identity_error for r in rows}) == 1
    place = {r.vec_id: k for k, r in enumerate(table)}
    signs = {}
    for r in rows:
        k, c = place[r.vec_id], r.component - 1
        assert (r.n, r.deviation) == (len(table), away[k]) and r.identity_error < 1e-12
        assert r.explained == pytest.approx(explained[c], rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(white[k, c]), abs=1e-9)
        if abs(r.whitened) > 1e-6:
            signs.setdefault(c, set()).add(np.sign(r.whitened * white[k, c]))
    assert all(len(s) == 1 for s in signs.values())

import numpy as np
import pytest

from tidewatch.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, length int, first string, score string, block int"
SMALL = H.Settings(every=10, sample=60, rows_per_cell=8, block=40, anchor_block=7, slab=16)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 3) for r in rows], SCHEMA).repartition(3)


def brute(rows, every=100, low=80, n=5):
    whole = sorted({(i, y, tuple(int(np.floor(256 * float(c))) for c in v)) for i, y, v in rows})
    out = []
    for a, label, x in whole:
        if a % every:
            continue
        scored = [(-sum(p * q for p, q in zip(x, z)), i, y) for i, y, z in whole if len(z) == len(x)]
        positives = sorted((s, i) for s, i, y in scored if y == label and i != a)[:n]
        for s, p in positives:
            fit = sorted((t, i) for t, i, y in scored if y != label and low * -s <= 100 * -t <= 100 * -s)[:n]
            out += [(a, p, k, i, -s, -t) for k, (t, i) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, settings=SMALL):
    return sorted(map(tuple, H.mine(frame(spark, rows), settings).collect()))


def vectors(kind, n, d, seed):
    rng = np.random.default_rng(seed)
    if kind == "unit":
        x = rng.normal(size=(n, d))
        return x / np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "clusters":
        return rng.normal(size=(9, d))[rng.integers(0, 9, n)] + 0.05 * rng.normal(size=(n, d))
    return rng.integers(-2, 3, (n, d)) / 4.0  # many ties


@pytest.mark.parametrize("kind", ["unit", "clusters", "ties"])
@pytest.mark.parametrize("labels", [2, 40])
def test_equals_brute_force(spark, kind, labels):
    rng = np.random.default_rng(labels)
    x = vectors(kind, 400, 10, 3).astype(np.float32).tolist()
    rows = [(k, int(rng.integers(labels)), v) for k, v in enumerate(x)]
    assert mined(spark, rows) == brute(rows, 10)


def test_copies_hot_label_and_bad_rows(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(40, 6)).astype(np.float32).tolist()
    rows = [(k, k % 2, base[0]) for k in range(150)] + [(200 + k, k % 5, base[k]) for k in range(40)]
    rows += [(10, 3, base[5]), (20, 1, base[7]), rows[3], rows[3], (300, 77, base[9])]
    rows += [(400 + k, 0, [1.0 * k, 2.0, -1.0]) for k in range(12)] + [(500, 1, [0.5, 2.0, -1.0]), (510, 0, [3.0]), (520, 9, [])]
    bad = [(600, None, base[1]), (610, 1, None), (620, 1, [None] * 6), (630, 1, [float("nan")] * 6)]
    bad += [(640, 1, [float("inf")] + [0.0] * 5), (None, 1, base[2]), (650, 1, [3e37] * 6)]
    want = brute(rows, 10)
    assert want and mined(spark, rows + bad) == want


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(k, k % 3, (rng.integers(-9000, 9000, 8) * 37.0).astype(np.float32).tolist()) for k in range(60)]
    assert mined(spark, rows) == brute(rows, 10)


def test_none(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0])]) == []
    assert mined(spark, [(10, 1, [1.0])]) == []
    assert mined(spark, [(10, 1, [1.0]), (11, 1, [1.0])]) == []


def test_cells_come_by_falling_bound():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=6), rng.normal(size=9)
    cells = list(H.by_bound(a, b))
    assert len({(i, j) for _, i, j in cells}) == 54
    assert [x for x, _, _ in cells] == sorted((x for x, _, _ in cells), reverse=True)
    assert all(x == pytest.approx(a[i] + b[j]) for x, i, j in cells)


def test_bounds_hold_and_clusters_spare_cells():
    """No member of a cell scores above its bound; with clusters most cells stay below the floor."""
    x = np.floor(256 * vectors("clusters", 2000, 12, 5))
    words = tuple(H.learn(h, 12, 8) for h in (x[:, :6], x[:, 6:]))
    index = H.Index(words, ())
    near = [H.nearest(h, w) for h, w in zip(index.halves(x), words)]
    index.radii = tuple(np.array([d[c == k].max(initial=0) for k in range(len(w))]) for (c, d), w in zip(near, words))
    bounds = index.bounds(x[:50])
    for k in range(50):
        score = x @ x[k]
        assert (score <= bounds[0][k, near[0][0]] + bounds[1][k, near[1][0]]).all()
        floor = np.sort(score)[-6]
        members = bounds[0][k, near[0][0]] + bounds[1][k, near[1][0]] >= floor
        assert members.mean() < 0.5

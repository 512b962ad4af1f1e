import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import neighbours as nn

SCHEMA = "vec_id long, embedding array<float>, label int, rank int"


def brute(rows, every=20, top=20):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    for q, x in rows:
        if q % every == 0:
            scored = sorted((-float(np.dot(x, v)), i) for i, v in rows if i != q and len(v) == len(x))
            yield q, [i for _, i in scored[:top]], [-s for s, _ in scored[:top]]


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 9) for i, v in vectors], SCHEMA).repartition(3)


def grouped(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r)
    return found


@pytest.mark.parametrize("unit", [True, False])
def test_recall(spark, unit):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if unit else x * rng.uniform(0.2, 3, (3000, 1))
    x = x.astype(np.float32).tolist()
    rows = list(enumerate(x))
    # what three blocks of 150 + 20 candidates each came to before the number was one for the whole index
    small = nn.Settings(block=1000, query_block=64, candidates=510, sample=1000)
    got = grouped(nn.nearest(frame(spark, rows), settings=small))
    hits = total = 0
    for q, ids, scores in brute(rows):
        assert [r.rank for r in got[q]] == list(range(1, 21))
        by_score = [(-r.score, r.vec_id) for r in got[q]]
        assert by_score == sorted(by_score)
        for r in got[q]:
            assert r.score == pytest.approx(float(np.dot(x[q], x[r.vec_id])))
        hits += len({r.vec_id for r in got[q]} & set(ids))
        total += 20
    assert hits >= 0.9 * total


def test_copies_ties_and_bad_rows(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 8)).astype(np.float32).tolist()
    good = [(k, base[k % 3]) for k in range(100)] + [(200 + k, base[k]) for k in range(30)] + [(40, base[1]), (60, base[9])]
    good += [(300, [1.0, 2.0])]  # the only one of its length: a query without candidates
    bad = [(80, None), (400, []), (420, [0.0] * 8), (440, [float("nan")] * 8), (460, [1.0] * 7 + [None])]
    bad += [(480, [float("inf")] + [1.0] * 7), (None, base[0])]
    got = grouped(nn.nearest(frame(spark, good + bad)))
    want = {}
    for q, ids, scores in brute(good):
        want.setdefault(q, []).append(ids)
    want.pop(300)
    assert got.keys() == want.keys()
    for q, lists in want.items():
        assert sorted(r.vec_id for r in got[q]) == sorted(sum(lists, []))
        if len(lists) == 1:
            assert [r.vec_id for r in got[q]] == lists[0]


def test_few_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])]
    assert [(r.query_id, r.rank, r.vec_id) for r in nn.nearest(frame(spark, rows)).collect()] == [(0, 1, 1), (0, 2, 2)]
    assert nn.nearest(frame(spark, rows[:1])).count() == 0
    assert nn.nearest(frame(spark, rows[1:])).count() == 0
    assert nn.nearest(frame(spark, rows).where("false")).count() == 0


def test_radius_search_is_complete():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 1 << 16, (500, 6), dtype=np.uint16)
    codes[::7] = codes[0] ^ (1 << rng.integers(0, 16, (len(codes[::7]), 6))).astype(np.uint16)
    index = nn.MultiIndex(codes)
    apart = np.array([[bin(int(x)).count("1") for x in row] for row in codes ^ codes[0]]).sum(axis=1)
    for radius in (0, 1, 5, 6, 12, 30, 47, 60, 96):
        assert set(index.within(codes[0], radius)) == set(np.flatnonzero(apart <= radius))
    assert (nn._distances(codes, codes[0]) == apart).all()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_every_length_is_searched(spark, kind):
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(size=5 if k % 3 else 9).astype(np.float32).tolist()) for k in range(400)]
    table = frame(spark, rows).withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    got = grouped(nn.nearest(table, settings=nn.Settings(block=50, query_block=4, candidates=400)))
    for q, ids, scores in brute(rows):
        assert [r.vec_id for r in got[q]] == ids
        assert [r.score for r in got[q]] == pytest.approx(scores)


def test_radius_counts_the_whole_index(spark):
    """However small the blocks, a query sees the same codes."""
    rng = np.random.default_rng(9)
    rows = [(k, v) for k, v in enumerate(rng.normal(size=(600, 12)).astype(np.float32).tolist())]
    found = [
        sorted(map(tuple, nn.nearest(frame(spark, rows), settings=nn.Settings(block=b, query_block=7, candidates=60)).collect()))
        for b in (40, 1000)
    ]
    assert found[0] == found[1]

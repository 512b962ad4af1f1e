"""Boosted trees, attributions, the exact split and local surrogates against direct computations."""

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.config import MODEL_FEATURES
from tidewatch.plans import attributions as A
from tidewatch.plans import boosting as B
from tidewatch.plans import surrogate as L
from tidewatch.plans import training as M

NAMES = ["a", "b", "c", "d"]
SCHEMA = "transaction_id string, label int, fold int, a double, b double, c double, d double"


def sample(n=600, seed=1):
    """Ties, few values, and a column whose being unknown tells the label."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        a, b, c = rng.normal(), float(rng.integers(0, 3)), round(rng.normal(), 1)
        label = int(a + b * 0.7 - 0.4 * c + 0.3 * rng.normal() > 0.8)
        d = None if label and rng.random() < 0.7 else (math.nan if rng.random() < 0.1 else rng.random())
        rows.append((f"T{k}", label, k % 3, a, b, c, d))
    return rows


def matrix(rows):
    return np.array([[math.nan if v is None else v for v in r[3:]] for r in rows], float)


GROWTH = B.Growth(rounds=6, depth=3)


def grown(spark, rows, parts=3, folds=2, growth=GROWTH):
    return B.grow(spark.createDataFrame(rows, SCHEMA).repartition(parts), NAMES, folds, growth)


def test_same_trees_for_any_partitioning(spark, monkeypatch):
    rows = sample()
    found = []
    for parts in (1, 4, 13):
        monkeypatch.setattr(B, "_tasks", lambda spark, n, k=parts: k)
        models, unseen = grown(spark, rows[::-1] if parts == 4 else rows, parts)
        found.append(([m.to_json() for m in models], sorted(map(tuple, unseen.collect()))))
    assert found[0] == found[1] == found[2]


def plain_growth(rows, growth, round_count, seed_keys):
    """The same algorithm row by row: exact greedy splits at bin edges, in floating point."""
    x, y = matrix(rows), np.array([r[1] for r in rows])
    cuts = [np.unique(c[~np.isnan(c)])[1:] for c in x.T]
    margin = np.zeros(len(rows))
    for round_ in range(round_count):
        use = B._drawn(seed_keys, round_, growth)
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        features = B.drawn_features(x.shape[1], round_, growth)

        def node(rows_in, depth):
            own = rows_in & use
            G, H = g[own].sum(), h[own].sum()
            best = (1e-6, None)
            if depth < growth.depth:
                for left_missing in (False, True):
                    for f in features:
                        for cut in [*cuts[f], math.inf]:
                            left = np.where(np.isnan(x[:, f]), left_missing, x[:, f] < cut)
                            gl, hl = g[own & left].sum(), h[own & left].sum()
                            if min(hl, H - hl) < growth.least_weight:
                                continue
                            gain = gl**2 / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G**2 / (H + 1)
                            if gain > best[0] + 1e-7:
                                best = (gain, left)
            if best[1] is None:
                step[rows_in] = -growth.step * G / (H + 1)
                return
            node(rows_in & best[1], depth + 1)
            node(rows_in & ~best[1], depth + 1)

        step = np.zeros(len(rows))
        node(np.ones(len(rows), bool), 0)
        margin = margin + step
    return margin


def test_equals_row_by_row_growth(spark):
    rows = sample(160, 4)
    growth = B.Growth(rounds=4, depth=3, step=0.3)
    (model,), _ = grown(spark, rows, folds=0, growth=growth)
    frame = spark.createDataFrame(rows, SCHEMA)
    keys = {r.transaction_id: r.key for r in frame.select("transaction_id", B._key().alias("key")).collect()}
    keys = np.array([keys[r[0]] for r in rows], np.int64).view(np.uint64)
    assert np.abs(model.margins(matrix(rows)) - plain_growth(rows, growth, 4, keys)).max() < 1e-6


def test_missing_values_choose_a_side(spark):
    rows = sample()
    (model,), _ = grown(spark, rows, folds=0, growth=B.Growth(rounds=20, depth=3))
    x = matrix(rows)
    unknown = x.copy()
    unknown[:, 3] = math.nan
    known = np.where(np.isnan(x), 0.5, x)
    assert model.margins(unknown).mean() > model.margins(known).mean() + 0.2
    assert "d" in [model.names[f] for f in model.feature[model.feature >= 0]]


def test_folds_do_not_see_their_rows(spark):
    rows = sample()
    models, unseen = grown(spark, rows, folds=3)
    assert len(models) == 4 and unseen.count() == len(rows)
    # A fold's model is the one that its rows are left out of.
    (alone,), _ = grown(spark, [r for r in rows if r[2] != 1], folds=0)
    assert np.abs(models[2].margins(matrix(rows)) - alone.margins(matrix(rows))).max() < 0.4
    want = sorted(models[r[2] + 1].margins(matrix([r]))[0] for r in rows)
    assert np.abs(np.array(want) - sorted(r.margin for r in unseen.collect())).max() < 1e-9


def test_stored_trees_are_the_same(spark):
    (model,), _ = grown(spark, sample(), folds=0)
    again = B.Trees.from_json(model.to_json())
    x = matrix(sample(50, 9))
    assert (again.margins(x) == model.margins(x)).all() and again.getNumTrees == 6


def test_below_the_root_half_the_nodes_are_added_up(spark, monkeypatch):
    asked, summed = [], B._summed
    monkeypatch.setattr(B, "_summed", lambda blocks, job, tasks: asked.append(job.slots) or summed(blocks, job, tasks))
    models, _ = grown(spark, sample())
    for slots in asked:
        taken = (slots >= 0).sum(axis=1)
        assert (taken == 1).all() if slots.shape[1] == 1 else (taken <= slots.shape[1] // 2).all()
    assert any((m.feature[:, 1:] >= 0).any() for m in models)


def test_sums_of_many_tasks_meet_in_a_tree(spark, monkeypatch):
    few = [m.to_json() for m in grown(spark, sample())[0]]
    monkeypatch.setattr(B, "_FEW_TASKS", 0)
    assert [m.to_json() for m in grown(spark, sample())[0]] == few


def test_margins_from_all_trees_so_far_are_those_of_each_round(spark, monkeypatch):
    found = []
    for refresh in (1, 4, 100):
        monkeypatch.setattr(B, "_REFRESH", refresh)
        models, unseen = grown(spark, sample())
        found.append(([m.to_json() for m in models], sorted(map(tuple, unseen.collect()))))
    assert found[0] == found[1] == found[2]


def test_margins_are_made_again_from_the_last_rounds_only(spark, monkeypatch):
    steps, partial = [], B.partial

    def noted(function, *args):
        if function is B._advance:
            steps.append(len(args[0]))
        return partial(function, *args)

    monkeypatch.setattr(B, "partial", noted)
    monkeypatch.setattr(B, "_REFRESH", 2)
    grown(spark, sample(), growth=B.Growth(rounds=7, depth=2))
    assert steps == [1, 2, 1, 2, 1, 2, 1]


def test_features_of_few_bins_are_added_up_together():
    counts = [256, 3, 3, 40, 3, 17, 256]
    assert B.packs([0, 1, 3, 4, 5, 6], counts) == [[1, 4, 5], [3], [0], [6]]
    rng = np.random.default_rng(5)
    n = 3000
    bins = np.array([rng.integers(0, c - 1, n) for c in counts], np.uint8)
    bins[rng.random(bins.shape) < 0.1] = B.MISSING
    fold = np.sort(rng.integers(0, 2, n)).astype(np.int8)
    label = rng.integers(0, 2, n).astype(np.uint8)
    block = B.Block(rng.integers(0, 1 << 62, n).astype(np.uint64), label, fold, bins, rng.normal(size=(3, n)))
    growth, features = B.Growth(), [0, 1, 3, 4, 5, 6]
    trees = [B.Growing(np.array([f]), np.array([1]), np.array([left])) for f, left in ((1, True), (5, False), (3, True))]
    taken = B._drawn_mixed(block.key, 4, growth)
    for level, slots in ((0, [[0], [1], [2]]), (1, [[-1, 0], [1, -1], [-1, 2]])):
        slots = np.array(slots, np.int16)
        (got,) = B.Level(growth, 4, level, features, counts, trees, slots, 30).sums(iter([block]))
        for m, tree in enumerate(trees):
            f = tree.feature[0]
            right = np.where(bins[f] == B.MISSING, not tree.left[0], bins[f] > 1).astype(int)
            own = taken & (fold != m - 1) & (slots[m][right * level] >= 0)
            p = 1 / (1 + np.exp(-block.margins[m][own]))
            begin = 0
            for g in features:
                place = np.where(bins[g][own] == B.MISSING, counts[g] - 1, bins[g][own])
                for found, weights in zip(got, (p - label[own], np.maximum(p * (1 - p), 1e-16))):
                    want = np.zeros(counts[g], np.int64)
                    np.add.at(want, place, np.rint(weights * 2**30).astype(np.int64))
                    assert (found[m, begin : begin + counts[g]] == want).all()
                begin += counts[g]


def test_blocks_are_filled_from_small_batches(monkeypatch):
    monkeypatch.setattr(B, "_CHUNK", 100)
    whole = pa.RecordBatch.from_arrays([pa.array(range(1037))], ["k"])
    parts = [whole.slice(k, 30) for k in range(0, 1037, 30)]
    for batches in (parts, [whole], [whole.slice(0, 0), *parts]):
        got = list(B.chunks(iter(batches)))
        assert [b.num_rows for b in got] == [100] * 10 + [37]
        assert pa.Table.from_batches(got).column("k").to_pylist() == list(range(1037))
    assert list(B.chunks(iter([]))) == []


def test_a_block_holds_as_many_rows_as_its_sums_stay_exact_for():
    """65 536 rows, each with the largest derivatives that a sum in doubles can take."""
    rows = 1 << 16
    whole = pa.RecordBatch.from_arrays([pa.array(np.arange(rows + 5))], ["k"])
    assert [b.num_rows for b in B.chunks(iter([whole]))] == [rows, 5]
    label, fold = np.arange(rows) % 2, np.zeros(rows, np.int8)
    block = B.Block(np.arange(rows, dtype=np.uint64), label.astype(np.uint8), fold, np.zeros((1, rows), np.uint8), np.full((2, rows), -40.0))
    growth = B.Growth(row_share=1.0)
    growing = [B.Growing(np.full(31, -1), np.zeros(31, int), np.ones(31, bool)) for _ in range(2)]
    level = B.Level(growth, 0, 0, [0], [2], growing, np.array([[0], [1]], np.int16), 36)
    (sums,) = level.sums(iter([block]))
    gradient, second = level._derivatives(block.margins[0], block.label)
    assert sums[:, 0, 0].tolist() == [sum(map(int, gradient)), sum(map(int, second))]
    assert (sums[:, 1] == 0).all()  # the second model leaves fold 0 out


@pytest.mark.parametrize("labels", [[0] * 30, [1] * 30, []])
def test_nothing_to_learn(spark, labels):
    rows = [(f"T{k}", y, k % 2, None, 1.0, float(k), math.nan) for k, y in enumerate(labels)]
    models, unseen = grown(spark, rows)
    assert unseen.count() == len(rows)
    margins = models[0].margins(matrix(rows) if rows else np.zeros((0, 4)))
    assert len(set(margins.tolist())) <= 1


# --- attributions ----------------------------------------------------------


def expected(trees, tree, x, known):
    """Margin of one tree when only some features are known, by the shares of training weight."""
    def walk(node):
        if node >= trees.feature.shape[1]:
            return trees.value[tree, node - trees.feature.shape[1]]
        f = trees.feature[tree, node]
        if f < 0:
            return walk(2 * node + 1)
        if f in known:
            left = trees.left[tree, node] if math.isnan(x[f]) else x[f] < trees.threshold[tree, node]
            return walk(2 * node + 1 if left else 2 * node + 2)
        share = trees.cover[tree, 2 * node + 1] / trees.cover[tree, node]
        return share * walk(2 * node + 1) + (1 - share) * walk(2 * node + 2)

    return walk(0)


def shapley(trees, x):
    m = len(trees.names)
    value = {}
    for size in range(m + 1):
        for known in combinations(range(m), size):
            value[known] = sum(expected(trees, t, x, set(known)) for t in range(len(trees.feature)))
    out = np.zeros(m)
    for k in range(m):
        for known in value:
            if k not in known:
                w = math.factorial(len(known)) * math.factorial(m - len(known) - 1) / math.factorial(m)
                out[k] += w * (value[tuple(sorted((*known, k)))] - value[known])
    return out, value[()]


def test_attributions_equal_all_subsets(spark):
    (model,), _ = grown(spark, sample(), folds=0, growth=B.Growth(rounds=5, depth=4, step=0.3))
    tabled, base = A.tabled_leaves(model)
    x = matrix(sample(25, 7))
    got = A.contributions(model, tabled, x)
    for row, own in zip(x, got):
        want, want_base = shapley(model, row)
        assert base == pytest.approx(want_base, abs=1e-12)
        assert np.abs(own - want).max() < 1e-12
    assert np.abs(base + got.sum(axis=1) - model.margins(x)).max() < 1e-12


def test_rows_of_the_same_sides_share_their_attributions(spark):
    (model,), _ = grown(spark, sample(), folds=0)
    sides = np.random.default_rng(1).random((70, 400)) < 0.5
    sides[:, 200:] = sides[:, :200]
    sides[69, 0] = ~sides[69, 200]
    first, found = A._alike(sides)
    assert len(first) == 201 and (sides[:, first][:, found] == sides).all()
    rows = matrix(sample(40, 5))
    tabled, _ = A.tabled_leaves(model)
    once = A.contributions(model, tabled, rows)
    assert (A.contributions(model, tabled, np.tile(rows, (3, 1))) == np.tile(once, (3, 1))).all()


def test_attributions_of_rows(spark):
    rows = sample()
    (trees,), _ = grown(spark, rows, folds=0)
    model = M.RiskModel([trees])
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("base", F.lit("x"))
    explained = A.attributions(model, frame, ("transaction_id", "label")).collect()
    assert len(explained) == len(rows)
    assert all(abs(r.base + sum(r.contributions) - r.margin) < 1e-9 for r in explained)
    long = A.attribution_rows(model, frame)
    assert long.columns == ["transaction_id", "feature", "value"] and long.count() == 4 * len(rows)
    means = {r.feature: r.mean_abs_value for r in A.mean_attributions(model, frame).collect()}
    by_hand = np.abs([r.contributions for r in explained]).mean(axis=0)
    assert means == pytest.approx(dict(zip(NAMES, by_hand)))
    assert A.attributions(model, frame.limit(0)).count() == 0


# --- split -----------------------------------------------------------------


def inputs(spark, n, positives, ids=None):
    rows = [(None if ids and k in ids else f"T{k}", int(k < positives)) for k in range(n)]
    return spark.createDataFrame(rows, "transaction_id string, label int").repartition(3)


@pytest.mark.parametrize("n, positives", [(1000, 137), (13, 2), (6, 6), (1, 0), (20_000, 9_000)])
def test_split_is_exact(spark, n, positives):
    settings = M.TrainingSettings(folds=4)
    counts = {}
    for r in M.with_split(inputs(spark, n, positives), settings).groupBy("label", "part", "fold").count().collect():
        counts.setdefault(r.label, {}).setdefault(r.part, {})[r.fold] = r["count"]
    for label, size in ((1, positives), (0, n - positives)):
        own = counts.get(label, {})
        assert sum(own.get("test", {}).values()) == int(0.2 * size + 0.5)
        folds = [own.get("train", {}).get(f, 0) for f in range(4)]
        assert sum(folds) == size - int(0.2 * size + 0.5) and max(folds) - min(folds) <= 1


def test_split_follows_the_digest_and_keeps_ids_together(spark):
    settings = M.TrainingSettings()
    rows = inputs(spark, 500, 100)
    split = {r.transaction_id: (r.part, r.fold) for r in M.with_split(rows, settings).collect()}
    cuts = M.split_cuts(rows, settings)
    again = {r.transaction_id: (r.part, r.fold) for r in M.with_split(rows.where("label = 1"), settings, cuts).collect()}
    assert again == {k: split[k] for k in again}
    twice = M.with_split(rows.union(rows).union(inputs(spark, 50, 5, ids=range(50))), settings)
    assert twice.groupBy("transaction_id", "label").agg(F.count_distinct("part", "fold").alias("n")).where("n > 1").count() == 0
    assert M.with_split(rows.where("false"), settings).count() == 0


# --- surrogates ------------------------------------------------------------


@pytest.fixture(scope="module")
def risk(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(800):
        x = [float(v) for v in rng.normal(size=len(MODEL_FEATURES))]
        x[3] = None if k % 7 == 0 else x[3]
        x[5] = float(k % 4 == 0)
        rows.append((f"T{k}", int(x[0] + x[1] + x[5] > 0.5), *x))
    schema = "transaction_id string, label int, " + ", ".join(f"{c} double" for c in MODEL_FEATURES)
    split = M.with_split(spark.createDataFrame(rows, schema), M.TrainingSettings(folds=2)).persist()
    return M.fit(split, M.TrainingSettings(rounds=10, depth=3, step=0.3)), split


def test_surrogate_equals_direct_solve(spark, risk):
    model, split = risk
    train = M.train_part(split)
    edges = L.quartile_edges(train)
    bins = L.bin_table(train, edges)
    rows = split.orderBy("transaction_id").limit(3).withColumn("label", F.col("label"))
    cloud = L.neighbourhood(model, rows, edges, bins, samples=400).persist()
    got = L.fit_surrogates(cloud)
    assert len(got) == 3 and cloud.count() == 1200
    for name, weights in got.items():
        own = cloud.where(F.col("transaction_id") == name).collect()
        x = np.array([[r[f"same_{c}"] for c in MODEL_FEATURES] for r in own])
        y, w = np.array([r.target for r in own]), np.array([r.closeness for r in own])
        assert w == pytest.approx(np.sqrt(np.exp(-(1 - x).sum(axis=1) / (0.75**2 * len(MODEL_FEATURES)))))
        design = np.column_stack([np.ones(len(x)), x])
        shrink = np.eye(design.shape[1])
        shrink[0, 0] = 0
        direct = np.linalg.solve(design.T @ (design * w[:, None]) + shrink, design.T @ (w * y))
        assert weights == pytest.approx(direct[1:].tolist(), abs=1e-9)
    assert cloud.groupBy("transaction_id").agg(F.max("closeness")).where("`max(closeness)` < 1").count() == 0


def test_drawn_bins_follow_the_train_rates(spark, risk):
    model, split = risk
    train = M.train_part(split)
    edges = L.quartile_edges(train)
    bins = L.bin_table(train, edges)
    assert {b["bin"] for b in bins[MODEL_FEATURES[3]]} == {-1, 0, 1, 2, 3}
    assert all(sum(b["share"] for b in own) == pytest.approx(1) for own in bins.values())
    row = split.where(F.col("transaction_id") == "T0")
    cloud = L.neighbourhood(model, row, edges, bins, samples=4000)
    rates = cloud.agg(*[F.avg(f"same_{c}").alias(c) for c in MODEL_FEATURES]).first()
    place = row.select(*[L.bin_of(F.col(c), edges[c]).alias(c) for c in MODEL_FEATURES]).first()
    for c in MODEL_FEATURES:
        share = next(b["share"] for b in bins[c] if b["bin"] == place[c])
        assert rates[c] == pytest.approx(share, abs=0.04)


def test_explanations_name_what_matters(spark, risk):
    model, split = risk
    rows = L.local_explanations(model, split, n=2, samples=1500).collect()
    assert len(rows) == 2 * len(MODEL_FEATURES) and {r.rank for r in rows} == {1, 2}
    strongest = max((r for r in rows if r.rank == 1), key=lambda r: abs(r.weight))
    assert strongest.feature in (MODEL_FEATURES[0], MODEL_FEATURES[1], MODEL_FEATURES[5])
    assert L.local_explanations(model, split.where("part = 'train'")).count() == 0

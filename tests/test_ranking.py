"""AUC, KS and curve against definitions computed pair by pair."""

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import ranking as K
from tidewatch.plans import training as M


def pairs(seed, n, distinct):
    rng = random.Random(seed)
    pool = [rng.random() ** 6 for _ in range(distinct)]
    return [(rng.choice(pool), rng.random() < 0.3) for _ in range(n)]


def brute(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    edges = sorted({s for s, _ in rows})
    ks = max(abs(sum(p >= e for p in pos) / len(pos) - sum(q >= e for q in neg) / len(neg)) for e in edges)
    return auc, ks


@pytest.mark.parametrize("distinct, few", [(5, True), (5, False), (400, False)])
def test_metrics_match_definitions(spark, distinct, few):
    rows = pairs(1, 500, distinct)
    df = spark.createDataFrame(rows, "score double, y boolean").repartition(5)
    counts = K.score_counts(df, "score", F.col("y"), few_values=few)
    auc, ks = brute(rows)
    got = counts.agg(*[v.alias(k) for k, v in K.curve_metrics().items()]).first()
    assert got.auc == pytest.approx(auc, abs=1e-12)
    assert got.gini == pytest.approx(2 * auc - 1, abs=1e-12)
    assert got.ks == pytest.approx(ks, abs=1e-12)
    points = sorted((r.fpr, r.tpr) for r in K.roc_points(counts).collect())
    assert points[-1] == (1.0, 1.0)
    area = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip([(0.0, 0.0), *points], points))
    assert area == pytest.approx(auc, abs=1e-12)


def test_separate_curves(spark):
    a, b = pairs(2, 200, 50), pairs(3, 300, 50)
    df = spark.createDataFrame([("a", *r) for r in a] + [("b", *r) for r in b], "m string, score double, y boolean")
    got = {
        r.m: r.auc
        for r in K.auc_gini(K.score_counts(df, "score", F.col("y"), by=["m"]), ["m"]).collect()
    }
    assert got == {"a": pytest.approx(brute(a)[0]), "b": pytest.approx(brute(b)[0])}


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(0.5, True), (0.7, True)], "score double, y boolean")
    counts = K.score_counts(df, "score", F.col("y"))
    assert K.auc_gini(counts).first().auc is None
    assert K.ks_statistic(counts).first().ks is None


def test_split_is_stable_and_close_to_its_share(spark):
    settings = M.TrainingSettings()
    ids = spark.range(20_000).selectExpr("concat('T', id) as transaction_id", "cast(id % 10 = 0 as int) as label")
    first = M.with_split(ids, settings)
    again = M.with_split(ids.repartition(7), settings)
    assert first.exceptAll(again).count() == 0
    shares = {r.label: r.share for r in first.groupBy("label").agg(
        F.avg((F.col("part") == "test").cast("int")).alias("share")).collect()}
    assert all(abs(s - 0.2) < 0.02 for s in shares.values())
    folds = first.groupBy("fold").count().collect()
    assert len(folds) == settings.folds

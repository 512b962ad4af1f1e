"""Flags, score and tier: rule edges, null logic and invariants."""

from dataclasses import replace

import pytest
from conftest import txn
from pyspark.sql import functions as F

from tidewatch.config import Rules
from tidewatch.operators.rules import features, flagged, score_transactions
from tidewatch.plans import detection, reports
from tidewatch.sources import adapters

LOOSE = replace(Rules(), null_safe_countries=False)


def by_id(df):
    return {r.transaction_id: r for r in df.collect()}


@pytest.mark.parametrize("third", [False, True])
@pytest.mark.parametrize(
    "amount, near", [(8_999.99, False), (9_000.0, True), (9_999.99, True), (10_000.0, False)]
)
def test_structuring_needs_amount_and_count(frame, amount, near, third):
    rows = [txn(1), txn(3, 2_000, amount)] + ([txn(2, 1_000)] if third else [])
    got = by_id(score_transactions(frame(rows), split=False))
    assert got["T00000003"].flag_structuring == (near and third)


@pytest.mark.parametrize("gap, raised", [(300, True), (301, False)])
def test_rapid_succession_edge(frame, gap, raised):
    got = by_id(score_transactions(frame([txn(1), txn(2, gap)]), split=False))
    assert got["T00000002"].flag_rapid_succession == raised
    assert got["T00000001"].seconds_since_last_txn is None
    assert got["T00000001"].flag_rapid_succession is False


def test_gap_of_seconds_and_elapsed_gap_differ(frame):
    rows = frame([txn(1, 0.9), txn(2, 301.0)])
    assert by_id(features(rows, split=False))["T00000002"].seconds_since_last_txn == 301
    assert by_id(features(rows, split=False, elapsed_gap=True))["T00000002"].seconds_since_last_txn == 300


@pytest.mark.parametrize(
    "origin, dest, safe, strict",
    [
        (None, None, False, None),
        (None, "CY", True, True),
        ("CY", None, True, True),
        ("DE", None, False, None),
        ("DE", "DE", False, False),
        ("SCH", "DE", True, True),
    ],
)
def test_country_rule(frame, origin, dest, safe, strict):
    rows = frame([txn(1, origin=origin, dest=dest)])
    assert score_transactions(rows, split=False).first().flag_high_risk_country is safe
    row = score_transactions(rows, LOOSE, split=False).first()
    assert row.flag_high_risk_country is strict
    if strict is None:
        assert row.risk_score is None and row.flag_count is None and row.risk_tier == "NONE"


def test_spike_before_and_after_rounding(frame):
    # Four rows: the last is 2.99996 times the average.
    big = 2.99996 / (4 - 2.99996) * 300.0
    rows = frame([txn(i, i * 1_000) for i in range(3)] + [txn(3, 3_000, round(big, 2))])
    ratio = by_id(features(rows, split=False))["T00000003"].amount_vs_7d_avg_ratio
    assert 2.99995 <= ratio < 3.0
    assert detection.amount_spike(rows).count() == 0
    assert detection.amount_spike(rows, rounded_test=True).count() == 1


def test_ratio_is_null_without_positive_average(frame):
    assert features(frame([txn(1, amount=0.0)]), split=False).first().amount_vs_7d_avg_ratio is None


def test_velocity_edge(frame):
    rows = [txn(i, i * 1_000, 4_000.0) for i in range(5)]
    got = by_id(score_transactions(frame(rows), split=False))
    assert got["T00000004"].flag_high_velocity and not got["T00000003"].flag_high_velocity


def test_all_rules_at_once_score_100(frame):
    rows = [txn(i, i * 1_000, 2_600.0) for i in range(8)]
    rows.append(txn(9, 7_100, 9_999.0, dest="PAN"))
    row = by_id(score_transactions(frame(rows), replace(Rules(), spike_ratio=2.0), split=False))["T00000009"]
    assert (row.risk_score, row.flag_count, row.risk_tier) == (100, 5, "HIGH")


@pytest.mark.parametrize("score, name", [(None, "NONE"), (0, "NONE"), (10, "LOW"), (25, "MEDIUM"), (50, "HIGH")])
def test_tier_limits(spark, score, name):
    from tidewatch.functions.scalars import tier

    df = spark.createDataFrame([(score,)], "s int").select(tier("s", Rules()))
    assert df.first()[0] == name


@pytest.mark.parametrize("source", [adapters.txn_events, adapters.txn_orders, adapters.txn_structuring])
def test_invariants(spark, sf_dir, source):
    raw = source(spark, sf_dir)
    scored = score_transactions(raw).cache()
    reachable = {a + b + c + d + e for a in (0, 30) for b in (0, 25) for c in (0, 20) for d in (0, 15) for e in (0, 10)}
    assert {r.risk_score for r in scored.select("risk_score").distinct().collect()} <= reachable
    broken = scored.where(
        "(flag_count = 0) <> (risk_tier = 'NONE')"
        " or (flag_amount_spike and rolling_7d_count < 4)"
        " or amount_vs_7d_avg_ratio > rolling_7d_count"
        " or rolling_7d_amount < amount - 0.001"
        " or seconds_since_last_txn < 0"
    )
    assert broken.count() == 0
    profile = reports.customer_risk_profile(scored, ordered=False)
    assert profile.agg(F.sum("total_transactions")).first()[0] == raw.count()
    last = scored.groupBy("customer_id").agg(F.max_by("cumulative_amount", "cumulative_count").alias("last"))
    assert last.join(profile, "customer_id").where("last <> total_volume_eur").count() == 0
    scored.unpersist()


def test_published_counts_of_the_fixtures(spark):
    """Counts the survey recorded at scale factor 0.01."""
    sf = "/root/testdata/sf0.01"
    flags = reports.flag_totals(score_transactions(adapters.txn_events(spark, sf))).first()
    assert tuple(flags) == (65, 1_199, 1_086, 164, 68)
    orders = score_transactions(adapters.txn_orders(spark, sf))
    assert tuple(reports.flag_totals(orders).first()) == (176, 318, 1_008, 2, 899)
    assert tuple(reports.rule_confusion(orders).first()) == (196, 344, 9_568, 4_892)
    assert detection.structuring_subthreshold(adapters.txn_structuring(spark, sf)).count() == 322
    unknown = score_transactions(adapters.txn_events(spark, sf), LOOSE).where("risk_score is null")
    assert unknown.count() == 206


def test_flags_read_unrounded_values(frame):
    """Rounding the ratio to 3.0 must not raise the flag of the warehouse model."""
    big = 2.99996 / (4 - 2.99996) * 300.0
    rows = frame([txn(i, i * 1_000) for i in range(3)] + [txn(3, 3_000, round(big, 2))])
    row = by_id(detection.risk_flagged(rows))["T00000003"]
    assert row.amount_vs_7d_avg_ratio == 3.0 and row.flag_amount_spike is False
    assert by_id(flagged(features(rows, split=False)))["T00000003"].flag_amount_spike is False


def test_ordered_outputs_are_sorted(spark, sf_dir):
    raw = adapters.txn_events(spark, sf_dir)
    got = [(r.risk_score, r.amount) for r in reports.alert_queue(score_transactions(raw)).collect()]
    assert got == sorted(got, key=lambda p: (-p[0], -p[1]))
    ranked = [r.risk_score for r in detection.warehouse_score(raw, ordered=True).collect()]
    known = [s for s in ranked if s is not None]
    assert known == sorted(known, reverse=True)


def test_empty_input_gives_zero_rates(frame):
    empty = score_transactions(frame([]), split=False)
    assert tuple(reports.alert_rate(empty).first()) == (0, 0, 0.0)
    report = reports.precision_recall(reports.rule_confusion(empty)).first()
    assert (report.precision, report.recall, report.f1) == (0.0, 0.0, 0.0)
    assert [r["count"] for r in reports.tier_distribution_filled(empty).collect()] == [0, 0, 0, 0]
    assert {r.f1 for r in reports.rule_classification_report(empty).collect()} == {0.0}

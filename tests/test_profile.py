"""Exact distinct counts of a customer's counterparties without unfolding rows."""

import pytest
from conftest import txn
from pyspark.sql import functions as F

from tidewatch.operators.rules import score_transactions
from tidewatch.plans import reports


def scored(frame, rows):
    return score_transactions(frame(rows))


@pytest.mark.parametrize("codes", [3, 64, 65, 200])
def test_countries_are_counted_exactly(frame, codes):
    rows = [txn(i, i, 10.0, f"C{i % 3}", dest=None if i % 11 == 0 else f"K{i * i % codes}") for i in range(400)]
    table = scored(frame, rows).persist()
    profile = reports.customer_risk_profile(table)
    want = table.groupBy("customer_id").agg(F.count_distinct("beneficiary_country").alias("n")).collect()
    assert {r.customer_id: r.distinct_beneficiary_countries for r in profile.collect()} == {r.customer_id: r.n for r in want}
    assert "Expand" not in profile._jdf.queryExecution().executedPlan().toString()
    table.unpersist()


def test_more_countries_than_bits(frame, monkeypatch):
    monkeypatch.setattr(reports, "MOST_COUNTRIES", 4)
    rows = [txn(i, i, 10.0, "A", dest=f"K{i % 9}") for i in range(30)]
    (row,) = reports.customer_risk_profile(scored(frame, rows)).collect()
    assert (row.distinct_beneficiary_countries, row.total_transactions) == (9, 30)


def test_no_countries_and_no_rows(frame):
    rows = [txn(i, i, 10.0, "A", dest=None) for i in range(3)]
    (row,) = reports.customer_risk_profile(scored(frame, rows)).collect()
    assert (row.distinct_beneficiary_countries, row.distinct_beneficiary_accounts) == (0, 1)
    assert reports.customer_risk_profile(scored(frame, rows).where("false")).count() == 0

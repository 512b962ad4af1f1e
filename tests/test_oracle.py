"""Every query with SQL gives exactly what the SQL gives."""

import check_oracle
import pytest

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return check_oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, sf_dir, name):
    assert check_oracle.compare(spark, con, sf_dir, QUERIES[name], SQL[name]) is None


def test_same_types_as_sql(spark, con, sf_dir):
    for name in ("risk_score_final", "customer_risk_profile", "monthly_trend", "classification_report"):
        want = {r[0]: r[1] for r in con.execute(f"describe {SQL[name]}").fetchall()}
        assert {c: TYPES[t] for c, t in QUERIES[name](spark, sf_dir).dtypes} == want


def test_entry_gives_alerts(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["transaction_id", "customer_id"]
    assert df.count() > 0


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)

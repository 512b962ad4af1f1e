import pytest
from conftest import txn

from tidewatch.config import CRITICAL_COLUMNS
from tidewatch.operators import quality as Q


def test_clean_rows_pass(frame):
    rows = frame([txn(1), txn(2)])
    assert Q.enforce_gate(rows) is rows


@pytest.mark.parametrize("column", CRITICAL_COLUMNS)
def test_null_in_a_critical_column(frame, column):
    rows = frame([txn(1), txn(2, **{column: None})])
    assert Q.null_counts(rows).first()[column] == 1
    with pytest.raises(Q.QualityError, match=column):
        Q.enforce_gate(rows)


@pytest.mark.parametrize("amount", [0.0, -1.0])
def test_amount_must_be_positive(frame, amount):
    rows = frame([txn(1), txn(2, amount=amount)])
    assert Q.invalid_amounts(rows).first()[0] == 1
    with pytest.raises(Q.QualityError, match="not positive"):
        Q.enforce_gate(rows)


def test_repeated_ids(frame):
    rows = frame([txn(1), txn(1), txn(1), txn(2)])
    assert Q.duplicate_ids(rows).first()[0] == 2
    with pytest.raises(Q.QualityError, match="2 repeated"):
        Q.enforce_gate(rows)


def test_null_ids_count_as_one_value(frame):
    rows = frame([txn(1), txn(2, transaction_id=None), txn(3, transaction_id=None)])
    assert Q.duplicate_ids(rows).first()[0] == 1


def test_empty_input(frame):
    assert set(Q.gate_report(frame([])).first()) == {0}
    assert Q.duplicate_ids(frame([])).first()[0] == 0


def test_data_tests_report_and_raise(frame):
    rows = frame([txn(1, currency="XXX"), txn(1, currency=None), txn(2)])
    results = Q.together(
        [
            Q.not_null(rows, "m", ("transaction_id", "currency")),
            Q.unique(rows, "m", "transaction_id"),
            Q.accepted_values(rows, "m", "currency", ("EUR",)),
        ]
    )
    assert {r.test_name: r.violations for r in results.collect()} == {
        "not_null_m_transaction_id": 0,
        "not_null_m_currency": 1,
        "unique_m_transaction_id": 1,
        "accepted_values_m_currency": 1,
    }
    with pytest.raises(Q.QualityError, match="not_null_m_currency: 1"):
        Q.enforce_tests(results)
    Q.enforce_tests(Q.not_null(rows, "m", ("transaction_id",)))


def test_minimum_score(spark):
    alerts = spark.createDataFrame([(25,), (24,)], "risk_score int")
    assert Q.minimum_score(alerts, 25).first().violations == 1


def test_compiled_tests_equal_the_single_ones(spark):
    rows = [(1, "a", 5), (1, "b", None), (2, None, 30), (None, "c", 10), (3, "a", 40), (3, "c", 40), (None, "c", 20)]
    model = spark.createDataFrame(rows, "id int, tier string, score int").repartition(3)
    tests = [
        Q.DataTest("n", "not_null", "id"),
        Q.DataTest("u", "unique", "id"),
        Q.DataTest("u2", "unique", "tier"),
        Q.DataTest("a", "accepted", "tier", ("a", "b")),
        Q.DataTest("l", "least", "score", (25,)),
    ]
    single = Q.together(
        [
            Q.not_null(model, "m", ("id",)),
            Q.unique(model, "m", "id"),
            Q.unique(model, "m", "tier"),
            Q.accepted_values(model, "m", "tier", ("a", "b")),
        ]
    )
    want = [r.violations for r in single.collect()] + [3]
    assert [tuple(r) for r in Q.compiled(model, tests).collect()] == list(zip("n u u2 a l".split(), want))
    assert [r.violations for r in Q.compiled(model.limit(0), tests).collect()] == [0] * 5
    with pytest.raises(ValueError):
        Q.DataTest("x", "odd", "id").finding()


def test_compiled_tests_scan_a_model_once(spark, sf_dir):
    from tidewatch.queries import TESTS

    stored = spark.read.parquet(f"{sf_dir}/events.parquet")
    named = stored.selectExpr("cast(event_id as string) transaction_id", "cast(user_id as string) customer_id", "value amount", "event_type channel")
    plan = Q.compiled(named, TESTS["source"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1

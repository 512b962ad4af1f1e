import os
import sys
import tempfile
from datetime import datetime, timedelta
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="warehouse-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


START = datetime(2024, 1, 1, 12, 0, 0)


def txn(i, seconds=0.0, amount=100.0, customer="C1", origin="DE", dest="SE", flagged=False, **other):
    """One transaction as a tuple in schema order."""
    row = {
        "transaction_id": f"T{i:08d}",
        "customer_id": customer,
        "originator_account": "A1",
        "beneficiary_account": "A2",
        "amount": amount,
        "currency": "EUR",
        "channel": "SEPA",
        "originator_country": origin,
        "beneficiary_country": dest,
        "timestamp": START + timedelta(seconds=seconds),
        "is_flagged_source": flagged,
        **other,
    }
    return tuple(row.values())


@pytest.fixture
def frame(spark):
    """Make a transactions frame; columns may hold nulls the schema forbids."""
    from pyspark.sql.types import StructField, StructType

    from tidewatch.schema import TRANSACTIONS

    loose = StructType([StructField(f.name, f.dataType, True) for f in TRANSACTIONS])
    return lambda rows: spark.createDataFrame(rows, loose)

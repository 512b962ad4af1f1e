"""Column types of the transactions table and of its JSON messages."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, types and which of them are required.
TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("originator_account", T.StringType(), True),
        T.StructField("beneficiary_account", T.StringType(), True),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("currency", T.StringType(), False),
        T.StructField("channel", T.StringType(), False),
        T.StructField("originator_country", T.StringType(), True),
        T.StructField("beneficiary_country", T.StringType(), True),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("is_flagged_source", T.BooleanType(), False),
    ]
)

RAW_COLUMNS = tuple(TRANSACTIONS.fieldNames())


def message_schema() -> T.StructType:
    """The message form: the same fields, all optional, with the time as text."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType, True)
            for f in TRANSACTIONS
        ]
    )

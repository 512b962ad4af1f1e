"""Transactions seen in the driver's tables.

The expressions are plain SQL that both Spark and other engines accept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.session import fit_session

_CURRENCY = (
    "case {k} % 5 when 0 then 'EUR' when 1 then 'USD' when 2 then 'GBP' when 3 then 'SEK' else 'CHF' end"
)



def _padded(number: str, width: int) -> str:
    """Zeros in front of a short number; a longer one stays whole."""
    return f"lpad({number}, cast(greatest(length({number}), {width}) as int), '0')"


EVENT_COLUMNS = {
    "transaction_id": "'TXN' || " + _padded("cast(event_id as string)", 8),
    "customer_id": "'CUST' || " + _padded("cast(cast(user_id * 4 + floor(event_id / 7) % 4 as bigint) as string)", 5),
    "originator_account": "'ACC' || " + _padded("cast((event_id * 7 + 1) % 600 as string)", 6),
    "beneficiary_account": "'ACC' || " + _padded("cast((event_id * 13 + 5) % 600 as string)", 6),
    "amount": "round(value * 50, 2)",
    "currency": _CURRENCY.format(k="event_id"),
    "channel": "event_type",
    "originator_country": "case when event_id % 97 = 0 then null when event_id % 41 = 0 then 'CY' "
    "when event_id % 43 = 0 then 'PAN' else 'DE' end",
    "beneficiary_country": "case when event_id % 89 = 0 then null when event_id % 37 = 0 then 'MT' "
    "when event_id % 47 = 0 then 'BVI' when event_id % 53 = 0 then 'SCH' else 'SE' end",
    "timestamp": "ts",
    "is_flagged_source": "event_type = 'error' or value between 180 and 200",
}

STRUCTURING_COLUMNS = {
    **EVENT_COLUMNS,
    "customer_id": "'CUST' || " + _padded("cast(cast(user_id as bigint) as string)", 5),
    "amount": "case when event_id % 12 = 0 then (900000 + event_id * 37 % 99900) / 100 else round(value * 50, 2) end",
}

ORDER_COLUMNS = {
    "transaction_id": "'TXN' || " + _padded("cast(o_orderkey as string)", 8),
    "customer_id": "'CUST' || " + _padded("cast(o_custkey % 50 as string)", 5),
    "originator_account": "'ACC' || " + _padded("cast(o_custkey % 600 as string)", 6),
    "beneficiary_account": "'ACC' || " + _padded("cast((o_orderkey * 13 + 5) % 600 as string)", 6),
    "amount": "floor(o_totalprice * 5) / 100",
    "currency": _CURRENCY.format(k="o_orderkey"),
    "channel": "o_orderpriority",
    "originator_country": "case when o_custkey % 29 = 0 then 'CY' else 'LV' end",
    "beneficiary_country": "case when o_orderkey % 31 = 0 then 'PAN' else 'EE' end",
    "timestamp": "o_orderdate",
    "is_flagged_source": "o_orderstatus = 'P'",
}


def adapter_sql(columns: dict[str, str], table: str, where: str | None = None) -> str:
    """The adapter as a SELECT, for engines that take SQL text."""
    items = ", ".join(f"{text} as {name}" for name, text in columns.items())
    return f"select {items} from {table}" + (f" where {where}" if where else "")


EVENTS_SQL = adapter_sql(EVENT_COLUMNS, "events")
STRUCTURING_SQL = adapter_sql(STRUCTURING_COLUMNS, "events")
ORDERS_SQL = adapter_sql(ORDER_COLUMNS, "orders")


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """All rows of ``df`` as transactions; the session is fitted to its size."""
    fit_session(df)
    return df.selectExpr(*[f"{text} as `{name}`" for name, text in columns.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def txn_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "events"), EVENT_COLUMNS)


def txn_structuring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "events"), STRUCTURING_COLUMNS)


def txn_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "orders"), ORDER_COLUMNS)

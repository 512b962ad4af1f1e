"""JSON messages: transactions to key/value pairs and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.schema import RAW_COLUMNS, message_schema


def iso_text(ts: Column) -> Column:
    """ISO-8601 with microseconds and no zone, as producers send it."""
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def encode(txn: DataFrame) -> DataFrame:
    """Messages keyed by customer, so that a topic keeps a customer's order."""
    fields = [iso_text(F.col(c)).alias(c) if c == "timestamp" else F.col(c) for c in RAW_COLUMNS]
    return txn.select(F.col("customer_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def decode_json(
    raw: DataFrame, schema: StructType | str, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Flatten the JSON in ``value`` (text or bytes) beside the columns ``keep``; bad JSON gives null fields."""
    data = F.from_json(F.col(value).cast("string"), schema).alias("data")
    return raw.select(*keep, data).select(*keep, "data.*")


def decode(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Messages to rows, without those that have no transaction id.

    ``timestamp`` stays text; ``with_time`` turns it into a time.
    """
    return decode_json(raw, message_schema(), keep=keep).where(F.col("transaction_id").isNotNull())


def with_time(decoded: DataFrame) -> DataFrame:
    """Parse the time; text that is no time becomes null."""
    return decoded.withColumn("timestamp", F.try_to_timestamp(F.col("timestamp")))


def examined(raw: DataFrame) -> DataFrame:
    """Every message: its fields, ``message`` as it came, and ``reject_reason``.

    The reason is null for usable rows; the others have no id (bad JSON has
    none), no customer, or a time that cannot be read.
    """
    text = F.col("value").cast("string")
    fields = raw.select(text.alias("message"), F.from_json(text, message_schema()).alias("data"))
    timed = with_time(fields.select("data.*", "message"))
    reason = (
        F.when(F.col("transaction_id").isNull(), "no readable id")
        .when(F.col("customer_id").isNull(), "no customer")
        .when(F.col("timestamp").isNull(), "unreadable time")
    )
    return timed.withColumn("reject_reason", reason)

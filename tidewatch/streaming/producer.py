"""A stream of synthetic messages for the consumer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.config import StreamSettings
from tidewatch.sources.generator import synthesize_recent
from tidewatch.streaming.messages import encode


def synthetic_stream(
    spark: SparkSession, settings: StreamSettings = StreamSettings(), seed: int = 42
) -> DataFrame:
    """Transactions at one per ``producer_interval`` seconds, timed just now."""
    per_second = max(1, round(1 / settings.producer_interval)) if settings.producer_interval > 0 else 1
    ticks = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    ids = ticks.select(F.col("value").alias("id"), F.col("timestamp").alias("_now"))
    return synthesize_recent(ids, F.col("_now"), seed)


def to_kafka(
    txn: DataFrame, checkpoint: str, settings: StreamSettings = StreamSettings()
) -> StreamingQuery:
    return (
        encode(txn)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", settings.bootstrap_servers)
        .option("topic", settings.topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{max(settings.producer_interval, 0.1)} seconds")
        .start()
    )


def to_json_lines(txn: DataFrame, folder: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """The same messages as text files, one message per line."""
    writer = encode(txn).select("value").writeStream.format("text").option("path", folder)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

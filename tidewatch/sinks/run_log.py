"""One row per pipeline run, with an expiry time."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sinks.versions import delete

TTL_SECONDS = 86_400
_SCHEMA = (
    "run_id string, record_count long, alert_count long, status string, "
    "details string, timestamp timestamp, expires_at timestamp"
)


def run_record(counts: DataFrame, run_id: str, status: str = "completed", details: dict | None = None) -> DataFrame:
    """The log row of a run; ``counts`` is one row of record_count and alert_count."""
    now = F.current_timestamp()
    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.col("record_count").cast("long").alias("record_count"),
        F.col("alert_count").cast("long").alias("alert_count"),
        F.lit(status).alias("status"),
        F.lit(json.dumps(details or {}, sort_keys=True)).alias("details"),
        now.alias("timestamp"),
        F.timestamp_micros(F.unix_micros(now) + TTL_SECONDS * 1_000_000).alias("expires_at"),
    )


def append_run(record: DataFrame, path: str) -> None:
    record.coalesce(1).write.mode("append").parquet(path)


def live_runs(spark: SparkSession, path: str) -> DataFrame:
    runs = spark.read.schema(_SCHEMA).parquet(path)
    return runs.where(F.col("expires_at") > F.current_timestamp())


def purge_runs(spark: SparkSession, path: str) -> int:
    """Delete the files whose every record has expired, but the newest; returns how many went.

    A record is a file of its own and never changes, so readers see no other difference.
    """
    try:
        runs = spark.read.schema(_SCHEMA).parquet(path)
    except AnalysisException:
        return 0
    by_file = runs.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.max("expires_at").alias("expires_at"), F.max("timestamp").alias("timestamp")
    )
    newest = by_file.agg(F.max_by("file", "timestamp")).first()[0]
    gone = by_file.where((F.col("expires_at") <= F.current_timestamp()) & (F.col("file") != newest)).collect()
    for row in gone:  # one short record a run
        delete(spark, row.file)
    return len(gone)


def find_run(spark: SparkSession, path: str, run_id: str) -> dict:
    """All fields of the newest record of a run, or an empty dict."""
    try:
        row = live_runs(spark, path).where(F.col("run_id") == run_id).orderBy(F.desc("timestamp")).first()
    except AnalysisException:
        return {}
    if row is None:
        return {}
    found = row.asDict()
    return {**found, "details": json.loads(found["details"])}

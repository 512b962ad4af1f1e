"""High-risk country codes kept in a small table with an expiry time."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sinks import versions

TTL_SECONDS = 3_600


def replace_codes(
    spark: SparkSession, path: str, codes: Iterable[str], ttl_seconds: int = TTL_SECONDS
) -> int:
    """Put ``codes`` in the place of all before; returns how many there are now.

    Readers see the old list or the new one. ``purge_codes`` removes lists that are no longer read.
    """
    members = sorted(set(codes))
    expiry = F.timestamp_micros(F.unix_micros(F.current_timestamp()) + ttl_seconds * 1_000_000)
    rows = spark.createDataFrame([(c,) for c in members], "code string").select("code", expiry.alias("expires_at"))
    versions.replace(rows.coalesce(1), path)
    return len(members)


def live_codes(spark: SparkSession, path: str) -> DataFrame | None:
    """Distinct codes (code) that have not expired; None when there are none."""
    table = versions.read(spark, path, "code string, expires_at timestamp")
    if table is None:
        return None
    live = table.where(F.col("expires_at") > F.current_timestamp()).select("code").distinct()
    return None if live.isEmpty() else live


def purge_codes(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete older lists, expired or replaced; the newest ``keep`` stay. Returns how many went."""
    return versions.purge(spark, path, keep)

"""What a scorer knows of earlier micro-batches, at a cost that does not grow with their number.

After each batch there is a version of the memory: every customer's totals and last
time, and the list of the stored batches that reach into the look-back. A version is
immutable and named by its batch, so a replayed batch starts from the same
version and writes the same one again.

Totals are kept as a base and a few newer deltas (the customers of one batch each),
both in folders by a hash of the customer, so a batch reads the buckets of its own
customers only. Every ``deltas`` batches they are merged to a new base.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import scalars as S

TOTALS = "customer_id string, units long, known long, n long, last timestamp, bucket int"


@dataclass(frozen=True)
class Version:
    """State after a batch. ``recent`` lists [batch, its latest microsecond] of the batches that may
    matter to later ones; rows before ``floor`` (microseconds) may be in others."""

    batch: int
    base: int | None = None
    deltas: list[int] = field(default_factory=list)
    recent: list[list[int]] = field(default_factory=list)
    floor: int = -(1 << 62)
    latest: int = -(1 << 62)


@dataclass(frozen=True)
class Memory:
    """Versions below ``root`` of the scored rows below ``output``.

    ``slack_seconds`` keeps batches in the list for longer than the look-back, so that a batch
    that comes that late still finds all it needs there.
    """

    root: str
    output: str
    lookback_seconds: int
    slack_seconds: int = 86_400
    buckets: int = 32
    deltas: int = 16

    # --- versions ---

    def _place(self, batch: int, what: str) -> str:
        return f"{self.root}/batch={batch}/{what}"

    def _read_version(self, spark: SparkSession, batch: int) -> Version | None:
        try:
            row = spark.read.schema("value string").text(self._place(batch, "version")).first()
        except AnalysisException:
            return None
        return None if row is None else Version(**json.loads(row.value))

    def before(self, spark: SparkSession, batch: int) -> Version | None:
        """The newest version of a batch before ``batch``; None if there is none."""
        found = self._read_version(spark, batch - 1) if batch else None
        if found is not None:
            return found
        try:  # some batch left none: look for the newest that did
            known = spark.read.schema("value string").text(f"{self.root}/batch=*/version")
            rows = known.collect()  # one short line a batch; after a gap only
        except AnalysisException:
            return None
        earlier = [v for v in (Version(**json.loads(r.value)) for r in rows) if v.batch < batch]
        return max(earlier, key=lambda v: v.batch, default=None)

    def carry(self, spark: SparkSession, batch: int) -> None:
        """The version of a batch without rows: that of the batch before."""
        old = self.before(spark, batch)
        if old is not None:
            self._write_version(spark, Version(**{**asdict(old), "batch": batch}))

    def _write_version(self, spark: SparkSession, version: Version) -> None:
        line = spark.createDataFrame([(json.dumps(asdict(version)),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(self._place(version.batch, "version"))

    # --- what is known ---

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("customer_id"), F.lit(self.buckets)).cast("int")

    def paths(self, version: Version, edge: int) -> list[str]:
        """Folders of the stored batches that hold rows from ``edge`` (microseconds) on."""
        return [f"{self.output}/batch_id={b}" for b, latest in version.recent if latest >= edge]

    def totals(self, spark: SparkSession, version: Version, customers: DataFrame, touched: list[int]) -> DataFrame:
        """Totals of ``customers`` (customer_id), who are in the buckets ``touched``: the newest
        entry of each in base and deltas."""
        entries = self._entries(spark, version).where(F.col("bucket").isin(touched))
        return self._newest(entries.join(customers, "customer_id", "left_semi"))

    def _entries(self, spark: SparkSession, version: Version) -> DataFrame:
        folders = [] if version.base is None else [(version.base, "base")]
        folders += [(d, "delta") for d in version.deltas]
        parts = [
            spark.read.schema(TOTALS).parquet(self._place(batch, kind)).withColumn("batch", F.lit(batch))
            for batch, kind in folders
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionAll(part)
        return out

    def _newest(self, entries: DataFrame) -> DataFrame:
        whole = F.struct("batch", "units", "known", "n", "last")
        newest = entries.groupBy("customer_id").agg(F.max(whole).alias("t"))
        return newest.select("customer_id", "t.units", "t.known", "t.n", "t.last")

    def rows_since(self, spark: SparkSession, version: Version, edge: int, columns: list[str]) -> DataFrame | None:
        """Stored rows from ``edge`` on."""
        paths = self.paths(version, edge)
        if not paths:
            return None
        stored = spark.read.parquet(*paths).select(*columns)
        return stored.where(F.col("timestamp") >= F.timestamp_micros(F.lit(edge)))

    # --- what is added ---

    def _added(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("customer_id").agg(
            F.sum(S.exact_units("amount")).alias("_units"),
            F.count("amount").alias("_known"),
            F.count(F.lit(1)).alias("_n"),
            F.max("timestamp").alias("_last"),
        )

    def remember(
        self, spark: SparkSession, batch: int, old: Version | None, totals: DataFrame | None, rows: DataFrame, latest: int
    ) -> Version:
        """Write the version after ``batch``. ``totals`` are those of its customers before it,
        ``latest`` is its latest microsecond."""
        zero = F.lit(0)
        if totals is None:
            totals = spark.createDataFrame([], TOTALS).drop("bucket")
        joined = self._added(rows).join(totals, "customer_id", "left")
        delta = joined.select(
            "customer_id",
            (F.coalesce("units", zero) + F.coalesce("_units", zero)).alias("units"),
            (F.coalesce("known", zero) + F.col("_known")).alias("known"),
            (F.coalesce("n", zero) + F.col("_n")).alias("n"),
            F.greatest("last", "_last").alias("last"),
            self.bucket().alias("bucket"),
        )
        self._write(delta, batch, "delta")
        old = old or Version(batch)
        here = max(old.latest, latest)
        floor = max(old.floor, self._floor(here))
        recent = [[b, at] for b, at in [*old.recent, [batch, latest]] if at >= floor]
        new = Version(batch, old.base, [*old.deltas, batch], recent, floor, here)
        if len(new.deltas) >= self.deltas:
            merged = self._newest(self._entries(spark, new)).withColumn("bucket", self.bucket())
            self._write(merged, batch, "base")
            new = Version(batch, batch, [], recent, floor, here)
        self._write_version(spark, new)
        return new

    def rebuild(self, spark: SparkSession, batch: int, past: DataFrame) -> Version:
        """A version from all stored rows (with their batch_id), where there is none."""
        added = self._added(past)
        base = added.select(
            "customer_id",
            F.coalesce("_units", F.lit(0)).alias("units"),
            F.col("_known").alias("known"),
            F.col("_n").alias("n"),
            F.col("_last").alias("last"),
            self.bucket().alias("bucket"),
        )
        self._write(base, batch, "base")
        reach = past.groupBy("batch_id").agg(F.max(F.unix_micros("timestamp")).alias("at")).collect()
        here = max((r.at for r in reach), default=Version.latest)
        floor = self._floor(here)
        recent = sorted([int(r.batch_id), r.at] for r in reach if r.at >= floor)
        new = Version(batch, batch, [], recent, floor, here)
        self._write_version(spark, new)
        return new

    def _floor(self, latest: int) -> int:
        return latest - (self.lookback_seconds + 1 + self.slack_seconds) * S.MICROS

    def _write(self, totals: DataFrame, batch: int, kind: str) -> None:
        totals.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._place(batch, kind))

"""Score a stream of JSON messages, one micro-batch at a time.

The windows see the rows of their micro-batch only, unless the scorer is told to
remember what it stored before. Every batch writes its own
folder ``batch_id=N`` and replaces it when it is replayed, so a failure between
the write and the checkpoint commit leaves no copies.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.config import Rules, Scale, StreamSettings
from tidewatch.functions import scalars as S
from tidewatch.operators.rules import features, flagged, score_transactions, scored
from tidewatch.plans.reports import is_alert
from tidewatch.session import all_cores, fit_session
from tidewatch.streaming.memory import Memory
from tidewatch.streaming.messages import examined


def kafka_source(spark: SparkSession, settings: StreamSettings = StreamSettings()) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", settings.bootstrap_servers)
        .option("subscribe", settings.topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
        .load()
    )


def json_lines_source(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files of one message per line, behind the same ``value`` column."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


@dataclass(frozen=True)
class BatchScorer:
    """The foreachBatch callback, for rows as ``messages.examined`` gives them.

    ``rejects`` receives every message that cannot be scored, with the reason;
    ``summaries`` one row per batch. Countries follow the three-valued rule
    unless ``rules`` says otherwise. ``alerts_only`` keeps just the rows at or
    above the threshold. ``remember`` lets windows and totals go on from the rows
    that earlier batches stored, which needs all of them: it excludes
    ``alerts_only``. The cost of a batch follows its own customers and the look-back,
    not the batches before (see ``memory``); only a customer with a row no later
    than the last one stored is scored from all stored rows. Rows that come late do not
    change what is stored.
    """

    output: str
    rejects: str
    summaries: str | None = None
    rules: Rules = replace(Rules(), null_safe_countries=False)
    scale: Scale = Scale()
    alerts_only: bool = False
    remember: bool = False
    on_summary: Callable[[int, int, int], None] | None = None

    def __post_init__(self) -> None:
        if self.remember and self.alerts_only:
            raise ValueError("history needs all rows to be stored")

    @property
    def memory(self) -> Memory:
        return Memory(f"{self.output.rstrip('/')}-memory", self.output, self.rules.lookback_seconds)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with all_cores(batch.sparkSession):
            self._batch(batch, batch_id)

    def _batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = without_read_messages(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # Counting fills the cache and gives the planner the real size, so a
            # small batch is windowed in one shuffle.
            sound = F.col("reject_reason").isNull()
            micros = F.when(sound, F.unix_micros("timestamp"))
            counts = held.agg(
                F.count(F.lit(1)).alias("total"),
                F.count("reject_reason").alias("rejected"),
                F.min(micros).alias("start"),
                F.max(micros).alias("latest"),
                F.collect_set(F.when(sound, self.memory.bucket())).alias("touched"),
            ).first()
            if counts.rejected:
                bad = held.where(F.col("reject_reason").isNotNull())
                self._write(bad.select("message", "reject_reason"), self.rejects, batch_id)
            if counts.start is None:  # nothing to score
                if self.remember:
                    self.memory.carry(spark, batch_id)
                if counts.total:
                    self._summarise(spark, batch_id, 0, 0)
                return
            fit_session(held, self.scale)
            usable = held.where(F.col("reject_reason").isNull()).drop("message", "reject_reason")
            if self.remember:
                table = self._remembering(usable, batch_id, counts.start, counts.latest, counts.touched)
            else:
                table = score_transactions(usable, self.rules, self.scale)
            seen = Observation(f"batch {batch_id}")
            alerts = F.count_if(F.coalesce(is_alert(self.rules), F.lit(False)))
            table = table.observe(seen, F.count(F.lit(1)).alias("processed"), alerts.alias("alerts"))
            out = table.where(is_alert(self.rules)) if self.alerts_only else table
            self._write(out, self.output, batch_id)
            self._summarise(spark, batch_id, seen.get["processed"], seen.get["alerts"])
        finally:
            held.unpersist()

    def _remembering(
        self, usable: DataFrame, batch_id: int, start: int, latest: int, touched: list[int]
    ) -> DataFrame:
        """The batch scored after all that is stored, and the memory brought up to it.

        The memory is written first: it follows from the batch and the version before alone, so
        a replay writes the same again whether or not the rows were stored.
        """
        spark, memory = usable.sparkSession, self.memory
        version = memory.before(spark, batch_id)
        if version is None:
            past = self._past(usable, batch_id)
            if past is not None:
                version = memory.rebuild(spark, batch_id - 1, past)
        if version is None:
            memory.remember(spark, batch_id, None, None, usable, latest)
            return score_transactions(usable, self.rules, self.scale)
        customers = usable.select("customer_id").distinct()
        totals = memory.totals(spark, version, customers, touched)
        memory.remember(spark, batch_id, version, totals, usable, latest)
        edge = start - (self.rules.lookback_seconds + 1) * S.MICROS
        columns = usable.columns
        if edge < version.floor:  # rows later than the list of batches allows for
            return score_with_past(usable, self._past(usable, batch_id).select(*columns), edge, self.rules, self.scale)
        late = usable.join(totals.select("customer_id", "last"), "customer_id").where(F.col("timestamp") <= F.col("last"))
        late = late.select("customer_id").distinct()
        recent = memory.rows_since(spark, version, edge, columns)
        if late.isEmpty():
            return score_with_totals(usable, recent, totals, self.rules, self.scale)
        on_time = usable.join(late, "customer_id", "left_anti").select(*columns)
        behind = usable.join(late, "customer_id", "left_semi").select(*columns)
        past = self._past(usable, batch_id).select(*columns)
        return score_with_totals(on_time, recent, totals, self.rules, self.scale).unionByName(
            score_with_past(behind, past, edge, self.rules, self.scale)
        )

    def _past(self, usable: DataFrame, batch_id: int) -> DataFrame | None:
        """Stored rows of earlier batches, with their batch_id."""
        try:
            stored = usable.sparkSession.read.parquet(self.output)
        except AnalysisException:
            return None
        return stored.where(F.col("batch_id") < batch_id).select(*usable.columns, "batch_id")

    def _write(self, df: DataFrame, root: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    def _summarise(self, spark: SparkSession, batch_id: int, processed: int, alerts: int) -> None:
        """Both counts were observed by the write itself: Spark takes each finished task's once,
        also when tasks had to run twice."""
        if self.summaries:
            row = spark.createDataFrame([(processed, alerts)], "processed long, alerts long")
            self._write(row.coalesce(1), self.summaries, batch_id)
        if self.on_summary:
            self.on_summary(batch_id, processed, alerts)


def without_read_messages(batch: DataFrame) -> DataFrame:
    """The batch with the text of those messages only that go to the rejects."""
    return batch.withColumn("message", F.when(F.col("reject_reason").isNotNull(), F.col("message")))


def score_with_totals(
    batch: DataFrame, recent: DataFrame | None, totals: DataFrame, rules: Rules = Rules(), scale: Scale = Scale()
) -> DataFrame:
    """Rows of ``batch`` scored as if they followed everything that ``totals`` counts.

    ``totals``: customer_id, units, known, n, last, of all earlier rows; ``recent``: those of them that
    the look-back of the batch reaches, all customers'. No row of the batch may be as
    early as its customer's last one. What is not recent is the difference of both.
    """
    customers = batch.select("customer_id").distinct()
    mine = (batch.limit(0) if recent is None else recent).join(customers, "customer_id", "left_semi")
    inside = mine.groupBy("customer_id").agg(
        F.sum(S.exact_units("amount")).alias("_units"), F.count("amount").alias("_known"), F.count(F.lit(1)).alias("_n")
    )
    zero = F.lit(0)
    n, known = F.col("n") - F.coalesce("_n", zero), F.col("known") - F.coalesce("_known", zero)
    older = totals.join(inside, "customer_id", "left").select(
        "customer_id",
        F.when(known > 0, F.col("units") - F.coalesce("_units", zero)).alias("_old_units"),
        n.alias("_old_n"),
        F.when(F.col("_n").isNull(), F.col("last")).alias("_old_last"),
    )
    return _scored_after(batch, mine, older, rules, scale)


def score_with_past(
    batch: DataFrame, past: DataFrame, edge: int, rules: Rules = Rules(), scale: Scale = Scale()
) -> DataFrame:
    """Rows of ``batch`` scored as if they followed the rows of ``past``.

    Of the past, rows of the batch's customers from ``edge`` (microseconds; the look-back before
    the batch's earliest time) go through the windows again; the time
    bound reaches the scan. What is older only adds to the totals and
    the previous time, one row a customer.
    """
    limit = F.timestamp_micros(F.lit(edge))
    customers = batch.select("customer_id").distinct()
    mine = past.join(customers, "customer_id", "left_semi")
    recent = mine.where(F.col("timestamp") >= limit)
    older = (
        mine.where(F.col("timestamp") < limit)
        .groupBy("customer_id")
        .agg(
            F.sum(S.exact_units("amount")).alias("_old_units"),
            F.count(F.lit(1)).alias("_old_n"),
            F.max("timestamp").alias("_old_last"),
        )
    )
    return _scored_after(batch, recent, older, rules, scale)


def _scored_after(batch: DataFrame, recent: DataFrame, older: DataFrame, rules: Rules, scale: Scale) -> DataFrame:
    """The batch's rows in the windows of ``recent`` rows, with the totals of ``older`` ones added."""
    new = F.lit(True).alias("_new")
    both = batch.select("*", new).unionByName(recent.select("*", F.lit(False).alias("_new")))
    known = features(both, rules, scale).where("_new")
    joined = known.join(older, "customer_id", "left")
    amount = F.coalesce("cumulative_amount", F.lit(0.0)) + F.coalesce(S.from_units(F.col("_old_units")), F.lit(0.0))
    gap = S.epoch_second("timestamp") - S.epoch_second(F.coalesce("prev_timestamp", "_old_last"))
    whole = joined.withColumns(
        {
            "cumulative_amount": F.when(
                F.col("cumulative_amount").isNotNull() | F.col("_old_units").isNotNull(), amount
            ),
            "cumulative_count": F.col("cumulative_count") + F.coalesce("_old_n", F.lit(0)),
            "seconds_since_last_txn": gap,
        }
    )
    kept = [c for c in known.columns if c not in ("_new", "prev_timestamp")]
    return scored(flagged(whole.select(*kept), rules), rules)


def start(
    raw: DataFrame,
    scorer: BatchScorer,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Start scoring ``raw``; without ``interval`` it handles what is there and ends."""
    writer = examined(raw).writeStream.foreachBatch(scorer).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def scored_table(spark: SparkSession, output: str) -> DataFrame:
    """All batches written so far; ``batch_id`` is a column from the folder names."""
    return spark.read.parquet(output)

"""What a customer did before each transaction: rolling sums, totals, last time.

Two plans give the same columns.

*Whole customer.* One shuffle on the customer and one sort serve all windows. A
seven-day sum is the running total now minus the running total just outside
the window; both frames start at the first row, so Spark extends them row by
row and the cost does not grow with the number of rows per window.

*Split customer.* A customer may hold a large part of all rows. Such customers
are found by counting first. Each of their rows is also sent to the moments at
which it enters and leaves the seven-day window, so that a rolling sum becomes a
running total. These rows are written once, dealt by ranges of their order;
Spark's range sampler cuts a busy customer, day or instant wherever it has to.
Running totals are taken within each part, and the parts' totals are carried on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import Rules, Scale
from tidewatch.functions import scalars as S
from tidewatch.session import estimated_bytes, work_folder

KEY = "_key"


def history_key() -> Column:
    """The customer; a row without customer or time has a history of its own."""
    known = F.when(F.col("timestamp").isNotNull(), F.col("customer_id"))
    return F.coalesce(known, F.concat(F.lit("\0"), F.coalesce("transaction_id", F.lit(""))))


def with_history(
    txn: DataFrame,
    rules: Rules = Rules(),
    scale: Scale = Scale(),
    split: bool | None = None,
    open_window: bool = False,
) -> DataFrame:
    """Add the history columns to every transaction.

    Added: rolling_7d_amount, rolling_7d_count, rolling_7d_avg,
    cumulative_amount, cumulative_count, prev_timestamp.

    ``split``: True looks for busy customers, False treats every customer
    whole, None decides by the size estimate of the input. ``open_window``
    selects the variant frame (t - 7 days, t] in microseconds that leaves out
    later rows of the same instant.

    Rows of one instant follow their ids. A row without customer or time
    has no others before it.
    """
    if split is None:
        size = estimated_bytes(txn)
        split = size is None or size > scale.small_input_bytes
    rows = txn.withColumns(
        {
            KEY: history_key(),
            # without a time a row is alone, so any place in the order will do
            "_s": F.coalesce(S.epoch_second("timestamp"), F.lit(0)),
            "_us": F.coalesce(S.epoch_micros("timestamp"), F.lit(0)),
            "_units": S.exact_units("amount"),
        }
    )
    whole = _open_whole if open_window else _whole
    if not split:
        return _finish(whole(rows, rules), txn.columns)
    found = busy_customers(txn, row_cutoff(txn, scale))
    path = work_folder(txn.sparkSession, "busy-customers")
    found.write.parquet(path)
    busy = F.broadcast(txn.sparkSession.read.schema(found.schema).parquet(path))
    if busy.isEmpty():
        return _finish(whole(rows, rules), txn.columns)
    calm_part = whole(rows.join(busy, KEY, "left_anti"), rules)
    busy_part = _split(rows.join(busy, KEY, "left_semi"), txn.columns, rules, open_window)
    return _finish(calm_part, txn.columns).unionByName(_finish(busy_part, txn.columns))


def _sizes(txn: DataFrame) -> DataFrame:
    return txn.groupBy(history_key().alias(KEY)).agg(F.count(F.lit(1)).alias("n"))


def row_cutoff(txn: DataFrame, scale: Scale = Scale()) -> Column:
    """The most rows one task may get, as a one-value subquery.

    Never below total / max_busy_customers: at most that many groups of a
    partition of the rows can be larger, so lists of such groups are safe to
    broadcast.
    """
    total = _sizes(txn).agg(F.sum("n")).scalar()
    share = F.ceil(total / F.lit(scale.max_busy_customers))
    return F.greatest(F.lit(scale.busy_rows).cast("long"), share)


def busy_customers(txn: DataFrame, cutoff: Column) -> DataFrame:
    """Customers with more rows than the cut-off."""
    return _sizes(txn).where(F.col("n") > cutoff).select(KEY)


def _finish(rows: DataFrame, keep: list[str]) -> DataFrame:
    return rows.selectExpr(
        *[f"`{name}`" for name in keep],
        f"case when _roll_k > 0 then _roll_units / {S.UNITS}D end as rolling_7d_amount",
        "_roll_n as rolling_7d_count",
        f"case when _roll_k > 0 then _roll_units / {S.UNITS}D / _roll_k end as rolling_7d_avg",
        f"_cum_units / {S.UNITS}D as cumulative_amount",
        "_cum_n as cumulative_count",
        "_prev_ts as prev_timestamp",
    )


# --- whole customers -------------------------------------------------------


def _in_order():
    return Window.partitionBy(KEY).orderBy("_s", "_us", "transaction_id")


def _whole(rows: DataFrame, rules: Rules) -> DataFrame:
    """One exchange, one sort: the row order (second, instant, id) also serves
    the range frames, which order by second alone."""
    to_here = _in_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_second = Window.partitionBy(KEY).orderBy("_s")
    now = by_second.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    gone = by_second.rangeBetween(Window.unboundedPreceding, -(rules.lookback_seconds + 1))
    ordered = rows.select(
        "*",
        F.sum("_units").over(to_here).alias("_cum_units"),
        F.count(F.lit(1)).over(to_here).alias("_cum_n"),
        F.lag("timestamp").over(_in_order()).alias("_prev_ts"),
    )
    return ordered.select("*", *_rolling(now, gone))


def _rolling(now, gone) -> list[Column]:
    """Totals up to ``now`` without those of ``gone``."""
    zero = F.lit(0)
    units = F.coalesce(F.sum("_units").over(now), zero) - F.coalesce(F.sum("_units").over(gone), zero)
    return [
        units.alias("_roll_units"),
        (F.count(F.lit(1)).over(now) - F.count(F.lit(1)).over(gone)).alias("_roll_n"),
        (F.count("_units").over(now) - F.count("_units").over(gone)).alias("_roll_k"),
    ]


def _open_whole(rows: DataFrame, rules: Rules) -> DataFrame:
    order = Window.partitionBy(KEY).orderBy("_us", "transaction_id")
    to_here = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gone = (
        Window.partitionBy(KEY)
        .orderBy("_us")
        .rangeBetween(Window.unboundedPreceding, -rules.lookback_seconds * S.MICROS)
    )
    ordered = rows.select(
        "*",
        F.sum("_units").over(to_here).alias("_cum_units"),
        F.count(F.lit(1)).over(to_here).alias("_cum_n"),
        F.count("_units").over(to_here).alias("_cum_k"),
        F.lag("timestamp").over(order).alias("_prev_ts"),
    )
    zero = F.lit(0)
    return ordered.select(
        "*",
        (F.coalesce("_cum_units", zero) - F.coalesce(F.sum("_units").over(gone), zero)).alias("_roll_units"),
        (F.col("_cum_n") - F.count(F.lit(1)).over(gone)).alias("_roll_n"),
        (F.col("_cum_k") - F.count("_units").over(gone)).alias("_roll_k"),
    )


# --- split customers -------------------------------------------------------

_OWN = ("_units", "_n", "_k")
_NET = tuple(f"_net{m}" for m in _OWN)


def _moves(rows: DataFrame, payload: list[str], rules: Rules, open_window: bool) -> DataFrame:
    """Each transaction as itself (``_turn`` 1), and as it enters and leaves (``_turn`` 0).

    At one second the entering and leaving rows come first, so the running net
    total at a transaction holds all of its second. An open window is
    entered at the transaction itself and left at the exact instant.
    """
    steps = ["self", "leave"] if open_window else ["self", "enter", "leave"]
    each = rows.withColumn("_step", F.explode(F.array(*map(F.lit, steps))))
    itself, leaves = F.col("_step") == "self", F.col("_step") == "leave"
    far = F.col("_us") + rules.lookback_seconds * S.MICROS
    if open_window:
        place = {"_s": F.lit(0).cast("long"), "_us": F.when(leaves, far).otherwise(F.col("_us"))}
        sign = F.when(leaves, -1).otherwise(1)
    else:
        gone = F.col("_s") + rules.lookback_seconds + 1
        place = {
            "_s": F.when(leaves, gone).otherwise(F.col("_s")),
            "_us": F.when(itself, F.col("_us")).otherwise(0),
        }
        sign = F.when(leaves, -1).when(itself, 0).otherwise(1)
    known = F.col("_units").isNotNull().cast("long")
    amounts = {"_units": F.coalesce("_units", F.lit(0)), "_n": F.lit(1).cast("long"), "_k": known}
    return each.select(
        KEY,
        *[value.alias(name) for name, value in place.items()],
        itself.cast("int").alias("_turn"),
        F.coalesce("transaction_id", F.lit("")).alias("_id"),
        *[F.when(itself, F.col(c)).alias(c) for c in payload],
        *[F.when(itself, v).otherwise(0).alias(m) for m, v in amounts.items()],
        *[(sign * v).alias(f"_net{m}") for m, v in amounts.items()],
        F.when(itself, F.col("timestamp")).alias("_last"),
    )


def _split(rows: DataFrame, payload: list[str], rules: Rules, open_window: bool) -> DataFrame:
    """Running totals in parts of the rows' order, which are written and read again.

    A part is a contiguous range of (customer, order), so the totals of the
    parts are at most as many as parts and busy customers together; carrying
    them takes one window of at most as many rows as there are parts.
    """
    spark = rows.sparkSession
    moves = _moves(rows, payload, rules, open_window)
    order = ["_us", "_turn", "_id"] if open_window else ["_s", "_turn", "_us", "_id"]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = moves.repartitionByRange(width, KEY, *order).withColumn("_part", F.spark_partition_id())
    path = work_folder(spark, "history-parts")
    dealt.write.parquet(path)
    parts = spark.read.schema(dealt.schema).parquet(path)

    sums = [F.sum(m).alias(m) for m in (*_OWN, *_NET)]
    totals = parts.groupBy("_part", KEY).agg(*sums, F.max("_last").alias("_last"))
    earlier = Window.partitionBy(KEY).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        "_part",
        KEY,
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_past{m}") for m in (*_OWN, *_NET)],
        F.max("_last").over(earlier).alias("_past_last"),
    )
    inside = Window.partitionBy("_part", KEY).orderBy(*order)
    to_here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    running = parts.select(
        "*",
        *[F.sum(m).over(to_here).alias(f"_here{m}") for m in (*_OWN, *_NET)],
        F.max("_last").over(before).alias("_here_last"),
    ).where("_turn = 1")
    joined = running.join(carry, ["_part", KEY])

    def total(name: str) -> Column:
        return F.col(f"_past{name}") + F.col(f"_here{name}")

    return joined.select(
        *payload,
        F.when(total("_k") > 0, total("_units")).alias("_cum_units"),
        total("_n").alias("_cum_n"),
        *[total(f"_net{m}").alias(f"_roll{m}") for m in _OWN],
        F.coalesce("_here_last", "_past_last").alias("_prev_ts"),
    )

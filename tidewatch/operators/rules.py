"""From transactions to features, flags, score and tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import Rules, Scale
from tidewatch.functions import scalars as S
from tidewatch.operators.history import with_history

LEGS = ("originator_country", "beneficiary_country")


def with_listed_legs(txn: DataFrame, codes: DataFrame) -> DataFrame:
    """``txn`` with a Boolean for each leg: whether ``codes`` (distinct, column code) has its country.

    Spark broadcasts the codes if their size allows and shuffles otherwise. An
    unknown country is not listed.
    """
    for leg in LEGS:
        listed = codes.select(F.col("code").alias(leg), F.lit(True).alias(f"_{leg}_listed"))
        txn = txn.join(listed, leg, "left")
    return txn.withColumns({f"_{leg}_listed": F.coalesce(f"_{leg}_listed", F.lit(False)) for leg in LEGS})


def features(
    txn: DataFrame,
    rules: Rules = Rules(),
    scale: Scale = Scale(),
    split: bool | None = None,
    elapsed_gap: bool = False,
    open_window: bool = False,
    codes: DataFrame | None = None,
) -> DataFrame:
    """Calendar, country and history features of every transaction.

    ``codes`` holds high-risk countries in place of the rules' list. The gap to the previous transaction is the difference of whole seconds;
    ``elapsed_gap`` takes the whole seconds of the exact difference instead.
    """
    columns, risky = txn.columns, S.touches_high_risk(rules)
    if codes is not None:
        txn = with_listed_legs(txn, codes)
        risky = F.col(f"_{LEGS[0]}_listed") | F.col(f"_{LEGS[1]}_listed")
    known = with_history(txn, rules, scale, split, open_window)
    if elapsed_gap:
        micros = S.epoch_micros("timestamp") - S.epoch_micros("prev_timestamp")
        gap = F.floor(micros / S.MICROS)
    else:
        gap = S.epoch_second("timestamp") - S.epoch_second("prev_timestamp")
    return known.select(
        *columns,
        *[value.alias(name) for name, value in S.calendar_columns(rules).items()],
        risky.alias("involves_high_risk_country"),
        "rolling_7d_amount",
        "rolling_7d_count",
        "rolling_7d_avg",
        "cumulative_amount",
        "cumulative_count",
        "prev_timestamp",
        gap.alias("seconds_since_last_txn"),
        S.ratio_to_average(F.col("amount"), F.col("rolling_7d_avg")).alias("amount_vs_7d_avg_ratio"),
    )


def rule_conditions(rules: Rules) -> dict[str, Column]:
    """The five typologies as conditions over the feature columns."""
    amount, count, volume = F.col("amount"), F.col("rolling_7d_count"), F.col("rolling_7d_amount")
    near_limit = amount.between(rules.structuring_low, rules.structuring_high)
    spike = F.col("amount_vs_7d_avg_ratio") >= rules.spike_ratio
    rapid = F.col("seconds_since_last_txn") <= rules.rapid_seconds
    return {
        "flag_structuring": near_limit & (count >= rules.structuring_count),
        "flag_high_velocity": (count >= rules.velocity_count) & (volume >= rules.velocity_amount),
        "flag_high_risk_country": F.col("involves_high_risk_country"),
        "flag_amount_spike": F.coalesce(spike, F.lit(False)),
        "flag_rapid_succession": F.coalesce(rapid, F.lit(False)),
    }


def flagged(featured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return featured.withColumns(rule_conditions(rules))


def scored(flags: DataFrame, rules: Rules = Rules()) -> DataFrame:
    counted = {
        "flag_count": S.weighted(dict.fromkeys(rules.points, 1)),
        "risk_score": S.weighted(rules.points),
    }
    return flags.withColumns(counted).withColumn("risk_tier", S.tier("risk_score", rules))


def score_transactions(
    txn: DataFrame,
    rules: Rules = Rules(),
    scale: Scale = Scale(),
    split: bool | None = None,
    elapsed_gap: bool = False,
    open_window: bool = False,
    codes: DataFrame | None = None,
) -> DataFrame:
    """The scored table: raw columns, features, flags, score and tier."""
    featured = features(txn, rules, scale, split, elapsed_gap, open_window, codes)
    return scored(flagged(featured.drop("prev_timestamp"), rules), rules)

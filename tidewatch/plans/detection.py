"""Stand-alone results of the typologies and the combined score.

Each result selects from one feature plan; Catalyst drops the windows and scan
columns a result does not use. ``ordered`` adds a global sort for presentation.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import Rules, Scale
from tidewatch.functions import scalars as S
from tidewatch.operators.history import with_history
from tidewatch.operators.rules import features, flagged, rule_conditions, scored

_IDENTITY = ("transaction_id", "customer_id", "amount", "currency", "channel")
_COUNTRIES = ("originator_country", "beneficiary_country")


def _money(name: str, alias: str | None = None) -> Column:
    return S.half_up(F.col(name), 2).alias(alias or name)


def _tag(name: str) -> Column:
    return F.lit(name).alias("typology")


def structuring(
    txn: DataFrame, rules: Rules = Rules(), scale: Scale = Scale(), ordered: bool = False
) -> DataFrame:
    """Near-threshold amounts of customers with enough transactions of any size."""
    found = features(txn, rules, scale).where(rule_conditions(rules)["flag_structuring"])
    out = found.select(
        *_IDENTITY, *_COUNTRIES, "timestamp", "rolling_7d_count", _money("rolling_7d_amount"), _tag("structuring")
    )
    return out.orderBy("customer_id", "timestamp", "transaction_id") if ordered else out


def structuring_subthreshold(
    txn: DataFrame, rules: Rules = Rules(), scale: Scale = Scale(), ordered: bool = False
) -> DataFrame:
    """Variant that counts near-threshold transactions only.

    The filter comes before the windows, so it reaches the scan and only the
    few near-threshold rows are shuffled.
    """
    near = txn.where(F.col("amount").between(rules.structuring_low, rules.structuring_high))
    found = with_history(near, rules, scale).where(F.col("rolling_7d_count") >= rules.structuring_count)
    out = found.select(
        *_IDENTITY,
        *_COUNTRIES,
        "timestamp",
        F.col("rolling_7d_count").alias("sub_threshold_count_7d"),
        _money("rolling_7d_amount", "sub_threshold_volume_7d"),
        _tag("structuring"),
    )
    return out.orderBy("customer_id", "timestamp", "transaction_id") if ordered else out


def high_velocity(
    txn: DataFrame, rules: Rules = Rules(), scale: Scale = Scale(), ordered: bool = False
) -> DataFrame:
    found = features(txn, rules, scale).where(rule_conditions(rules)["flag_high_velocity"])
    out = found.select(
        *_IDENTITY,
        *_COUNTRIES,
        "timestamp",
        "rolling_7d_count",
        _money("rolling_7d_amount"),
        _money("rolling_7d_avg"),
        _tag("high_velocity_layering"),
    )
    return out.orderBy(F.desc("rolling_7d_amount"), "customer_id", "timestamp", "transaction_id") if ordered else out


def high_risk_country(
    txn: DataFrame, rules: Rules = Rules(), scale: Scale = Scale(), ordered: bool = False
) -> DataFrame:
    """Either leg in a listed country; each leg's own test stays three-valued."""
    legs = replace(rules, null_safe_countries=False)
    known = with_history(txn, rules, scale).where(S.touches_high_risk(legs))
    out = known.select(
        *_IDENTITY,
        "originator_country",
        S.high_risk_leg("originator_country", legs).alias("originator_is_high_risk"),
        "beneficiary_country",
        S.high_risk_leg("beneficiary_country", legs).alias("beneficiary_is_high_risk"),
        "timestamp",
        _money("rolling_7d_amount"),
        "rolling_7d_count",
        _tag("high_risk_country_routing"),
    )
    return out.orderBy(F.desc("amount"), "customer_id", "timestamp", "transaction_id") if ordered else out


def amount_spike(
    txn: DataFrame, rules: Rules = Rules(), scale: Scale = Scale(), rounded_test: bool = False, ordered: bool = False
) -> DataFrame:
    """Amounts far above the customer's own average; ``rounded_test`` compares
    the ratio after rounding it to four digits instead of before."""
    ratio4 = S.half_up(F.col("amount_vs_7d_avg_ratio"), 4)
    tested = ratio4 if rounded_test else F.col("amount_vs_7d_avg_ratio")
    found = features(txn, rules, scale).where(tested >= rules.spike_ratio)
    out = found.select(
        *_IDENTITY,
        *_COUNTRIES,
        "timestamp",
        _money("rolling_7d_avg"),
        "rolling_7d_count",
        ratio4.alias("amount_vs_7d_avg_ratio"),
        _tag("amount_spike"),
    )
    return out.orderBy(F.desc("amount_vs_7d_avg_ratio"), "customer_id", "timestamp", "transaction_id") if ordered else out


def rapid_succession(
    txn: DataFrame,
    rules: Rules = Rules(),
    scale: Scale = Scale(),
    elapsed_gap: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """``elapsed_gap`` tests the whole seconds of the exact difference."""
    found = features(txn, rules, scale, elapsed_gap=elapsed_gap).where(rule_conditions(rules)["flag_rapid_succession"])
    out = found.select(
        *_IDENTITY,
        *_COUNTRIES,
        F.col("prev_timestamp"),
        F.col("timestamp").alias("current_timestamp"),
        "seconds_since_last_txn",
        _money("rolling_7d_amount"),
        "rolling_7d_count",
        _tag("rapid_succession"),
    )
    return out.orderBy("seconds_since_last_txn", "customer_id", "current_timestamp", "transaction_id") if ordered else out


def staged(txn: DataFrame) -> DataFrame:
    """Staging projection: canonical types and the time under its staged name."""
    return txn.select(
        *[
            F.col(c).cast("double").alias(c) if c == "amount" else F.col(c)
            for c in txn.columns
            if c != "timestamp"
        ],
        F.col("timestamp").alias("transaction_timestamp"),
    )


def _warehouse_rules(rules: Rules) -> Rules:
    return replace(rules, null_safe_countries=False)


def _rounded() -> dict[str, Column]:
    return {
        "rolling_7d_amount": S.half_up(F.col("rolling_7d_amount"), 2),
        "rolling_7d_avg": S.half_up(F.col("rolling_7d_avg"), 2),
        "amount_vs_7d_avg_ratio": S.half_up(F.col("amount_vs_7d_avg_ratio"), 4),
    }


def warehouse_score(
    txn: DataFrame, rules: Rules = Rules(), scale: Scale = Scale(), ordered: bool = False
) -> DataFrame:
    """The combined score as the warehouse dialect gives it: unknown countries
    make the score null, gaps are exact differences, output is rounded after
    the flags are set. ``ordered`` adds a global sort for presentation."""
    strict = _warehouse_rules(rules)
    table = scored(flagged(features(txn, strict, scale, elapsed_gap=True), strict), strict)
    out = table.withColumns(_rounded()).select(
        *_IDENTITY,
        *_COUNTRIES,
        "timestamp",
        "is_flagged_source",
        "rolling_7d_amount",
        "rolling_7d_count",
        "rolling_7d_avg",
        "amount_vs_7d_avg_ratio",
        "seconds_since_last_txn",
        *rules.points,
        "flag_count",
        "risk_score",
        "risk_tier",
    )
    if ordered:
        out = out.orderBy(F.desc("risk_score"), F.desc("amount"), "transaction_id")
    return out


def risk_flagged(txn: DataFrame, rules: Rules = Rules(), scale: Scale = Scale()) -> DataFrame:
    """Intermediate model: rounded features and flags, not yet scored.

    Flags are computed from unrounded features; rounding replaces the columns
    in a later step.
    """
    strict = _warehouse_rules(rules)
    table = flagged(features(txn, strict, scale, elapsed_gap=True), strict).withColumns(_rounded())
    return staged(
        table.select(
            "transaction_id",
            "customer_id",
            "originator_account",
            "beneficiary_account",
            "amount",
            "currency",
            "channel",
            *_COUNTRIES,
            "timestamp",
            "is_flagged_source",
            "rolling_7d_amount",
            "rolling_7d_count",
            "rolling_7d_avg",
            "amount_vs_7d_avg_ratio",
            "seconds_since_last_txn",
            *rules.points,
        )
    )


def warehouse_model(txn: DataFrame, rules: Rules = Rules(), scale: Scale = Scale()) -> DataFrame:
    """The intermediate model with its score; both marts select from it. Store
    it when several results are wanted, so the windows run once."""
    return scored(risk_flagged(txn, rules, scale), rules)


def alert_mart(model: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return model.where(F.col("risk_score") >= rules.alert_threshold)


def customer_mart(model: DataFrame) -> DataFrame:
    """One row per customer over all transactions, with the four-level tier."""
    units = F.sum(S.exact_units("amount"))
    peak = F.col("max_risk_score")
    return (
        model.groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            S.from_units(units).alias("total_amount"),
            S.half_up(S.from_units(units) / F.count("amount"), 2).alias("avg_amount"),
            F.sum("flag_count").alias("flags_triggered"),
            F.max("risk_score").alias("max_risk_score"),
            F.max("transaction_timestamp").alias("latest_transaction_timestamp"),
        )
        .withColumn(
            "risk_tier",
            F.when(peak >= 75, "Critical").when(peak >= 50, "High").when(peak >= 25, "Medium").otherwise("Low"),
        )
    )


def mart_alert_queue(
    txn: DataFrame, rules: Rules = Rules(), scale: Scale = Scale(), ordered: bool = False
) -> DataFrame:
    """Alert mart from raw transactions. A stored table keeps no order, so
    sorting is for presentation only."""
    alerts = alert_mart(warehouse_model(txn, rules, scale), rules)
    if ordered:
        alerts = alerts.orderBy(F.desc("risk_score"), F.desc("amount"), "transaction_id")
    return alerts


def mart_customer_profile(
    txn: DataFrame, rules: Rules = Rules(), scale: Scale = Scale(), ordered: bool = False
) -> DataFrame:
    profile = customer_mart(warehouse_model(txn, rules, scale))
    if ordered:
        profile = profile.orderBy(F.desc("max_risk_score"), F.desc("total_amount"), "customer_id")
    return profile

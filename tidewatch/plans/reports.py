"""Aggregates, queues and rankings over the scored table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import ALERT_COLUMNS, FLAG_TITLES, TIERS, Rules
from tidewatch.functions import scalars as S


def is_alert(rules: Rules) -> Column:
    return F.col("risk_score") >= rules.alert_threshold


def alert_queue(scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Alerts, most urgent first; the id makes the order total."""
    return (
        scored.where(is_alert(rules))
        .select(*ALERT_COLUMNS)
        .orderBy(F.desc("risk_score"), F.desc("amount"), "transaction_id")
    )


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).count().orderBy(F.desc("count"), column)


def flag_totals(scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return scored.agg(*[S.count_where(F.col(flag)).alias(flag) for flag in rules.points])


def flag_breakdown(scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Flag totals in long form, one row per typology."""
    totals = flag_totals(scored, rules)
    pairs = ", ".join(f"'{FLAG_TITLES[flag]}', `{flag}`" for flag in rules.points)
    return totals.selectExpr(f"stack({len(rules.points)}, {pairs}) as (typology, flagged)").orderBy(
        "flagged", "typology"
    )


def tier_distribution(scored: DataFrame) -> DataFrame:
    return counts_by(scored, "risk_tier")


def tier_distribution_filled(scored: DataFrame) -> DataFrame:
    """Every tier in its fixed order, those without rows as 0: one aggregate row
    unfolded, so no join is needed."""
    wide = scored.agg(*[S.count_where(F.col("risk_tier") == name).alias(name) for name in TIERS])
    rows = ", ".join(f"{i}, '{name}', `{name}`" for i, name in enumerate(TIERS, 1))
    return wide.selectExpr(f"stack({len(TIERS)}, {rows}) as (position, risk_tier, count)").orderBy("position")


#: Countries that are told apart by bits, 64 a column; beyond, Spark counts distinct values itself.
MOST_COUNTRIES = 1_024


def _country_bits(scored: DataFrame) -> tuple[DataFrame, list[Column], Column]:
    """Rows with the place of their beneficiary country, aggregates that gather places in bits,
    and the count of bits afterwards.

    A second distinct count would make Spark unfold every row into three. The list of
    countries is one narrow scan, and broadcast, as its size is checked.
    """
    country = "beneficiary_country"
    known = scored.select(country).where(F.col(country).isNotNull()).distinct()
    codes = sorted(r[0] for r in known.limit(MOST_COUNTRIES + 1).collect())
    if len(codes) > MOST_COUNTRIES:
        return scored, [F.count_distinct(country).alias("_countries")], F.col("_countries")
    places = scored.sparkSession.createDataFrame(list(zip(codes, range(len(codes)))), f"{country} string, _place int")
    placed = scored.join(F.broadcast(places), country, "left")
    words = range(-(-len(codes) // 64))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_place") % 64)
    gathered = [F.bit_or(F.when(F.floor(F.col("_place") / 64) == w, bit)).alias(f"_bits{w}") for w in words]
    total = sum((F.coalesce(F.bit_count(f"_bits{w}"), F.lit(0)) for w in words), F.lit(0)).cast("long")
    return placed, gathered, total


def customer_risk_profile(scored: DataFrame, rules: Rules = Rules(), ordered: bool = True) -> DataFrame:
    units = F.sum(S.exact_units("amount"))
    placed, gathered, countries = _country_bits(scored)
    grouped = placed.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        S.from_units(units).alias("total_volume_eur"),
        (S.from_units(units) / F.count("amount")).alias("avg_transaction_amount"),
        F.max("amount").alias("max_transaction_amount"),
        F.sum("risk_score").alias("cumulative_risk_score"),
        F.max("risk_score").alias("peak_risk_score"),
        S.count_where(F.col("flag_structuring")).alias("structuring_flags"),
        S.count_where(F.col("flag_high_velocity")).alias("velocity_flags"),
        S.count_where(F.col("flag_high_risk_country")).alias("high_risk_country_flags"),
        *gathered,
        F.count_distinct("beneficiary_account").alias("distinct_beneficiary_accounts"),
    )
    kept = [c for c in grouped.columns if not c.startswith("_")]
    profile = grouped.select(
        *kept[:-1], countries.alias("distinct_beneficiary_countries"), kept[-1], S.tier("peak_risk_score", rules).alias("customer_risk_tier")
    )
    return profile.orderBy(F.desc("cumulative_risk_score"), "customer_id") if ordered else profile


def top_customers(scored: DataFrame, rules: Rules = Rules(), n: int = 15) -> DataFrame:
    return customer_risk_profile(scored, rules).limit(n)


def alert_rate(scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    total, alerts = F.count(F.lit(1)), S.count_where(is_alert(rules))
    return scored.agg(
        total.alias("total"), alerts.alias("alerts"), S.share(alerts, total).alias("alert_rate")
    )


def rule_confusion(scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Alerts against the source label, all four counts in one pass."""
    truth, alert = F.col("is_flagged_source"), is_alert(rules)
    return scored.agg(
        S.count_where(truth & alert).alias("tp"),
        S.count_where(~truth & alert).alias("fp"),
        S.count_where(~truth & ~alert).alias("tn"),
        S.count_where(truth & ~alert).alias("fn"),
    )


def precision_recall(confusion: DataFrame) -> DataFrame:
    """Precision, recall and F1 of a tp/fp/tn/fn row; 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rates = confusion.select(
        "*",
        S.share(tp, tp + fp).alias("precision"),
        S.share(tp, tp + fn).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.select("*", S.share(2 * p * r, p + r).alias("f1"))


def classification_report(pairs: DataFrame) -> DataFrame:
    """Per-class precision, recall, F1 and support with macro and weighted
    averages, from Boolean columns ``label`` and ``predicted``."""
    label, guess = F.col("label"), F.col("predicted")
    cells = pairs.agg(
        S.count_where(label & guess).alias("tp"),
        S.count_where(~label & guess).alias("fp"),
        S.count_where(~label & ~guess).alias("tn"),
        S.count_where(label & ~guess).alias("fn"),
    )
    classes = cells.selectExpr(
        "stack(2, 'Low Risk', tn, fn, fp, 'High Risk', tp, fp, fn) as (class, hit, false_hit, missed)"
    )
    rated = precision_recall(
        classes.selectExpr("class", "hit as tp", "false_hit as fp", "missed as fn")
    ).select("class", "precision", "recall", "f1", (F.col("tp") + F.col("fn")).alias("support"))
    wide = rated.groupBy().pivot("class", ["Low Risk", "High Risk"]).agg(
        F.first("precision").alias("p"),
        F.first("recall").alias("r"),
        F.first("f1").alias("f"),
        F.first("support").alias("s"),
    )
    lo, hi = "`Low Risk_{}`", "`High Risk_{}`"

    def both(form: str) -> str:
        return ", ".join(
            form.format(lo=lo.format(m), hi=hi.format(m), ls=lo.format("s"), hs=hi.format("s")) for m in "prf"
        )

    macro = both("({lo} + {hi}) / 2")
    weighted = both("coalesce(try_divide({lo} * {ls} + {hi} * {hs}, {ls} + {hs}), 0)")
    total = f"{lo.format('s')} + {hi.format('s')}"
    each = [
        f"'{name}', " + ", ".join(f"`{name}_{m}`" for m in "prfs") for name in ("Low Risk", "High Risk")
    ]
    rows = ", ".join([*each, f"'macro avg', {macro}, {total}", f"'weighted avg', {weighted}, {total}"])
    return wide.selectExpr(f"stack(4, {rows}) as (class, precision, recall, f1, support)")


def rule_classification_report(scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return classification_report(
        scored.select(F.col("is_flagged_source").alias("label"), is_alert(rules).alias("predicted"))
    )


def monthly_trend(scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    total, alerts = F.count("transaction_id"), S.count_where(is_alert(rules))
    return (
        scored.groupBy(F.year("timestamp").alias("year"), F.month("timestamp").alias("month"))
        .agg(
            total.alias("total_transactions"),
            S.from_units(F.sum(S.exact_units("amount"))).alias("total_volume_eur"),
            alerts.alias("alerts_raised"),
            S.count_where(F.col("flag_structuring")).alias("structuring_flags"),
            S.half_up(alerts / total * 100, 2).alias("alert_rate_pct"),
        )
        .orderBy("year", "month")
    )


def daily_alerts(scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return (
        scored.where(is_alert(rules))
        .groupBy(F.to_date("timestamp").alias("date"), "risk_tier")
        .count()
        .orderBy("date", "risk_tier")
    )


def score_histogram(scored: DataFrame) -> DataFrame:
    """Rows per positive score and tier. Scores are whole multiples of five, so
    the distinct values are the bins."""
    return (
        scored.where(F.col("risk_score") > 0)
        .groupBy("risk_score", "risk_tier")
        .count()
        .orderBy("risk_score", "risk_tier")
    )


def histogram(df: DataFrame, value: str, by: Sequence[str] = (), bins: int = 40) -> DataFrame:
    """Counts of a number in at most ``bins`` bins of a round width: low, high, ``by``, count.

    A first pass finds the bounds; the width is the least of 1, 2 or 5 times a power of ten
    that covers them with so many bins, and bins begin at its multiples. A second pass
    counts, combining where the rows are read. Bins without rows are left out, as
    are unknown and infinite values. No rows, or all of one value: one bin of width 1 or none.
    """
    number = F.col(value).cast("double")
    known = df.where(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf")))
    ends = known.agg(F.min(number).alias("least"), F.max(number).alias("largest")).first()
    step, digits = _round_step(ends.least, ends.largest, bins)
    place = F.floor(number / F.lit(step)) if digits <= 0 else F.floor(number * F.lit(1 / step))
    edge = lambda k: F.round(k * F.lit(step), max(digits, 0))
    return (
        known.groupBy(place.alias("_place"), *by)
        .count()
        .select(edge(F.col("_place")).alias("low"), edge(F.col("_place") + 1).alias("high"), *by, "count")
        .orderBy("low", *by)
    )


def _round_step(least: float | None, largest: float | None, bins: int) -> tuple[float, int]:
    """A round bin width, and the decimals it needs."""
    if least is None or not largest > least:
        return 1.0, 0
    for power in range(math.floor(math.log10(largest - least)) - math.ceil(math.log10(bins)) - 1, 309):
        for lead in (1, 2, 5):
            step = float(f"{lead}e{power}")
            if math.floor(largest / step) - math.floor(least / step) < bins:
                return step, -power
    return largest - least, 0


def overview_kpis(scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    total = F.count(F.lit(1))
    alerts = S.count_where(is_alert(rules))
    high = S.count_where(F.col("risk_tier") == "HIGH")
    return scored.agg(
        total.alias("total_transactions"),
        alerts.alias("alerts"),
        high.alias("high_risk"),
        F.count_distinct("customer_id").alias("unique_customers"),
        S.share(alerts, total).alias("alert_rate"),
        S.share(high, total).alias("high_rate"),
    )


def high_tier_top(scored: DataFrame, n: int = 10) -> DataFrame:
    return (
        scored.where(F.col("risk_tier") == "HIGH")
        .select(
            "transaction_id",
            "customer_id",
            "amount",
            "risk_score",
            "risk_tier",
            "flag_structuring",
            "flag_high_velocity",
            "flag_high_risk_country",
        )
        .orderBy(F.desc("risk_score"), F.desc("amount"), "transaction_id")
        .limit(n)
    )


def top_flagged(scored: DataFrame, rules: Rules = Rules(), n: int = 20) -> DataFrame:
    """The n most urgent alerts with amount and time as display text."""
    top = (
        scored.where(is_alert(rules))
        .select(
            "transaction_id",
            "customer_id",
            "timestamp",
            "amount",
            "channel",
            "originator_country",
            "beneficiary_country",
            "risk_score",
            "risk_tier",
            "flag_count",
        )
        .orderBy(F.desc("risk_score"), F.desc("amount"), "transaction_id")
        .limit(n)
    )
    return top.withColumns(
        {"amount": S.euro_text(F.col("amount")), "timestamp": S.minute_text(F.col("timestamp"))}
    )

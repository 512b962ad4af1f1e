"""Column expressions shared by batch, streaming and reports.

All of them are built-in Spark expressions, so they stay inside generated code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.config import Rules

MICROS = 1_000_000
#: Parts of an amount that are kept exactly.
UNITS = 1_000_000


def epoch_micros(ts: str | Column) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def epoch_second(ts: str | Column) -> Column:
    """Whole epoch seconds, fractions cut towards the past."""
    return F.unix_seconds(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def exact_units(amount: str | Column) -> Column:
    """An amount in millionths as a long; finer parts are rounded half to even.

    Sums of longs do not depend on the order of addition, so totals are the
    same however the rows are split over tasks. A sum beyond nine million
    millions raises an overflow error instead of losing digits.
    """
    value = F.col(amount) if isinstance(amount, str) else amount
    return F.rint(value * UNITS).cast("long")


def from_units(total: Column) -> Column:
    return total / F.lit(float(UNITS))


def half_up(value: Column, digits: int) -> Column:
    """Round a non-negative value with exact halves going up.

    ``round`` treats a binary double as its shortest decimal, which other
    engines do not; this form is plain arithmetic and agrees everywhere.
    """
    unit = float(10**digits)
    return F.floor(value * unit + 0.5) / unit


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def calendar_columns(rules: Rules = Rules(), ts: str = "timestamp") -> dict[str, Column]:
    """Date, hour and weekday (1 = Sunday) with the two derived Booleans."""
    hour, weekday = F.hour(ts), F.dayofweek(ts)
    return {
        "date": F.to_date(ts),
        "hour": hour,
        "day_of_week": weekday,
        "is_weekend": weekday.isin(1, 7),
        "is_offhours": (hour < rules.day_starts) | (hour >= rules.day_ends),
    }


def high_risk_leg(country: str, rules: Rules) -> Column:
    """Whether a country is listed; unknown ones are null, or not listed under the null-safe rule."""
    listed = F.col(country).isin(*rules.high_risk_countries) if rules.high_risk_countries else F.lit(False)
    return F.coalesce(listed, F.lit(False)) if rules.null_safe_countries else listed


def touches_high_risk(rules: Rules) -> Column:
    return high_risk_leg("originator_country", rules) | high_risk_leg("beneficiary_country", rules)


def ratio_to_average(amount: Column, average: Column) -> Column:
    return F.when(average > 0, amount / average)


def weighted(flags_to_points: dict[str, int]) -> Column:
    """Sum of points of the raised flags; null as soon as one flag is unknown."""
    return reduce(Column.__add__, [F.col(flag).cast("int") * points for flag, points in flags_to_points.items()])


def tier(score: str, rules: Rules) -> Column:
    """The tier of the score column; an unknown score has tier NONE."""
    value = F.col(score)
    return (
        F.when(value >= rules.high_score, "HIGH")
        .when(value >= rules.medium_score, "MEDIUM")
        .when(value > 0, "LOW")
        .otherwise("NONE")
    )


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def euro_text(amount: Column) -> Column:
    return F.concat(F.lit("€"), F.format_number(amount, 2))


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")

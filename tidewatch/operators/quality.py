"""Input gate and data tests, each as one row per check."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import CRITICAL_COLUMNS
from tidewatch.functions import scalars as S


class QualityError(ValueError):
    """The input breaks a rule the pipeline depends on."""


def null_counts(txn: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    return txn.agg(*[S.count_where(F.col(c).isNull()).alias(c) for c in columns])


def invalid_amounts(txn: DataFrame) -> DataFrame:
    return txn.agg(S.count_where(F.col("amount") <= 0).alias("invalid_amounts"))


def duplicate_ids(txn: DataFrame) -> DataFrame:
    """Rows beyond the first of their id; all null ids count as one id.

    Grouping by id combines copies before the shuffle, so an id with very many
    copies costs one row per task.
    """
    per_id = txn.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def gate_report(txn: DataFrame) -> DataFrame:
    """All gate counts in one row.

    Nulls and amounts are counted where the rows are read. Only the ids are
    shuffled, for the duplicate count.
    """
    return txn.agg(
        *[S.count_where(F.col(c).isNull()).alias(f"null_{c}") for c in CRITICAL_COLUMNS],
        S.count_where(F.col("amount") <= 0).alias("invalid_amounts"),
    ).withColumn("duplicates", duplicate_ids(txn).scalar())


def accepted(txn: DataFrame) -> DataFrame:
    """The rows that the gate's row checks let pass."""
    for column in CRITICAL_COLUMNS:
        txn = txn.where(F.col(column).isNotNull())
    return txn.where(F.col("amount") > 0)


def enforce_gate(txn: DataFrame) -> DataFrame:
    """Run the gate and raise on the first broken rule; returns ``txn``."""
    row = gate_report(txn).first().asDict()
    for column in CRITICAL_COLUMNS:
        if row[f"null_{column}"]:
            raise QualityError(f"{row[f'null_{column}']} null values in required column {column}")
    if row["invalid_amounts"]:
        raise QualityError(f"{row['invalid_amounts']} amounts are not positive")
    if row["duplicates"]:
        raise QualityError(f"{row['duplicates']} repeated transaction ids")
    return txn


# --- data tests: (test_name, violations) ----------------------------------


def _named(name: str, violations: DataFrame) -> DataFrame:
    """One row from a one-column count."""
    return violations.select(F.lit(name).alias("test_name"), F.col("violations"))


def not_null(df: DataFrame, model: str, columns: Iterable[str], also: Sequence[str] = ()) -> DataFrame:
    """One row per column from a single pass over ``df``; ``also`` names models of the same rows and columns."""
    columns = list(columns)
    wide = df.agg(*[S.count_where(F.col(c).isNull()).alias(c) for c in columns])
    rows = [f"'not_null_{name}_{c}', `{c}`" for name in (model, *also) for c in columns]
    return wide.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) as (test_name, violations)")


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once."""
    sizes = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return _named(
        f"unique_{model}_{column}", sizes.agg(S.count_where(F.col("n") > 1).alias("violations"))
    )


def accepted_values(df: DataFrame, model: str, column: str, values: Iterable[str]) -> DataFrame:
    """Distinct values outside the list; null is not a value."""
    found = df.where(~F.col(column).isin(*values)).groupBy(column).count()
    return _named(
        f"accepted_values_{model}_{column}", found.agg(F.count(F.lit(1)).alias("violations"))
    )


def minimum_score(alerts: DataFrame, threshold: int) -> DataFrame:
    return _named(
        "alert_queue_min_score",
        alerts.agg(S.count_where(F.col("risk_score") < threshold).alias("violations")),
    )


@dataclass(frozen=True)
class DataTest:
    """A declared test of one column. ``kind``: not_null; unique; accepted (of ``values``);
    least (``values`` holds the one bound). ``name`` is the test's in the results."""

    name: str
    kind: str
    column: str
    values: tuple = ()

    def finding(self) -> Column:
        """What a row adds to the test: a value to be counted, or null."""
        value = F.col(self.column)
        text = value.cast("string")
        if self.kind == "not_null":
            return F.when(value.isNull(), F.lit(""))
        if self.kind == "unique":
            return text
        if self.kind == "accepted":
            return F.when(~value.isin(*self.values), text)
        if self.kind == "least":
            return F.when(value < self.values[0], F.lit(""))
        raise ValueError(f"unknown kind of test {self.kind!r}")


def compiled(model: DataFrame, tests: Sequence[DataTest]) -> DataFrame:
    """All tests of a model from one scan and one shuffle: test_name, violations.

    Each row unfolds to what it adds to the tests (for most tests nothing), which is counted by
    test and value. Counts combine where the rows are read, so a value with very many rows
    costs one row a task.
    """
    cells = [F.struct(F.lit(k).alias("test"), t.finding().alias("value")) for k, t in enumerate(tests)]
    found = model.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    counted = found.groupBy("test", "value").agg(F.count(F.lit(1)).alias("n"))
    wide = counted.agg(*[_of_test(t, k) for k, t in enumerate(tests)])
    rows = ", ".join(f"'{t.name}', v{k}" for k, t in enumerate(tests))
    return wide.selectExpr(f"stack({len(tests)}, {rows}) as (test_name, violations)")


def _of_test(test: DataTest, k: int) -> Column:
    """A test's violations from the number of rows of each value found."""
    n = F.when(F.col("test") == k, F.col("n"))
    if test.kind == "unique":
        total = F.count_if(n > 1)
    else:
        total = F.count(n) if test.kind == "accepted" else F.coalesce(F.sum(n), F.lit(0))
    return total.cast("long").alias(f"v{k}")


def together(tests: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tests)


def enforce_tests(results: DataFrame) -> None:
    """Raise if any test reports violations; one small row per test."""
    failed = [f"{r.test_name}: {r.violations}" for r in results.where("violations > 0").collect()]
    if failed:
        raise QualityError("failed data tests: " + ", ".join(failed))

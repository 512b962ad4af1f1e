"""Parquet, catalog and JSON sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.schema import TRANSACTIONS


def write_parquet(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> None:
    """Write ``df``. ``files`` merges the output for small results only: it
    narrows the last stage to that many tasks."""
    out = df.coalesce(files) if files else df
    out.write.mode(mode).option("maxRecordsPerFile", 20_000_000).parquet(path)


def write_by_day(
    df: DataFrame, path: str, time_column: str, day_column: str = "txn_date", mode: str = "overwrite"
) -> None:
    """Write one folder per day.

    The rebalance hint brings a day's rows together, so a day is a few files
    and not one per task; adaptive execution cuts a day that is too big for
    one task into several.
    """
    dated = df.withColumn(day_column, F.to_date(time_column))
    dated.hint("rebalance", day_column).write.mode(mode).partitionBy(day_column).parquet(path)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def typed(df: DataFrame, schema: StructType = TRANSACTIONS, required: bool = True) -> DataFrame:
    """Cast to ``schema``. With ``required`` a null in a required column fails
    the job that reads it, so the check needs no pass of its own."""
    columns = []
    for field in schema:
        value = F.col(field.name).cast(field.dataType)
        if required and not field.nullable:
            value = F.coalesce(
                value, F.raise_error(F.lit(f"null in required column {field.name}")).cast(field.dataType)
            )
        columns.append(value.alias(field.name))
    return df.select(*columns)


def load_table(
    df: DataFrame, table: str, database: str | None = None, schema: StructType | None = TRANSACTIONS
) -> int:
    """Replace a catalog table in one write; returns its row count.

    With ``schema=None`` the types of ``df`` are kept.
    """
    name = f"`{database}`.`{table}`" if database else f"`{table}`"
    out = df if schema is None else typed(df, schema)
    out.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name).count()


def materialise(df: DataFrame, name: str, how: str, path: str | None = None) -> DataFrame:
    """Give a model a name: as a view, inline (no object at all) or a table."""
    if how == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if how == "inline":
        return df
    if how == "table":
        writer = df.write.mode("overwrite").format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)
        return df.sparkSession.table(name)
    raise ValueError(f"unknown materialisation {how!r}")


def write_json(df: DataFrame, path: str) -> None:
    """Write a small report as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)

"""File and table sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.schema import TRANSACTIONS
from tidewatch.sinks import versions


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | None = None, recursive: bool = False
) -> DataFrame:
    """A Parquet file or folder; partition folders become columns.

    ``recursive`` takes all files below the folder instead, whatever the names
    of the folders between.

    A table that is replaced in versions (``sinks.versions``) is read as last published.

    Raises FileNotFoundError when there is nothing to read. Without ``schema``
    the types come from the file footers.
    """
    path = versions.resolve(spark, path) or path
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", "*.parquet")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        found = reader.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no parquet data at {path!r}") from error
    if schema is not None and not _holds_files(spark, path, recursive):
        raise FileNotFoundError(f"no parquet data at {path!r}")
    return found


def _holds_files(spark: SparkSession, path: str, recursive: bool) -> bool:
    """Whether there is a Parquet file; the footer of one is all that is read."""
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        reader.parquet(path)
    except AnalysisException:
        return False
    return True


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, TRANSACTIONS)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """A table written with partition folders, whose names become columns."""
    return spark.read.parquet(path)


def transactions_from_rows(spark: SparkSession, rows: Iterable) -> DataFrame:
    """A small frame with the transactions schema from Python rows."""
    return spark.createDataFrame(list(rows), TRANSACTIONS)


def read_in_order(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """All rows with their place: ``file``, the path of their file, and ``row``, their number in it.

    Ordering by (``file``, ``row``) gives the rows as reading the sorted files one after the other
    does. The places come with the rows from the scan; no listing is gathered here, and
    nothing is sorted until a caller asks for it.
    """
    found = read_parquet(spark, path, recursive=recursive)
    taken = {c.lower() for c in found.columns}
    if taken & {"file", "row"}:
        raise ValueError("the files have columns named file or row")
    return found.select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )


def source_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """A declared catalog table or view."""
    return spark.table(f"`{database}`.`{name}`" if database else f"`{name}`")

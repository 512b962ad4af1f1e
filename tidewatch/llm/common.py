"""Helpers shared by the text operators: tables, stored intermediate results, size checks."""

from __future__ import annotations

import ctypes
import math
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import partial
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import work_folder

#: One word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage, so that a lost executor costs a read and not the work
    before it, and pins results that later steps must all see alike.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows, else unmarked.

    For stored tables, whose count comes from the file footers.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def width(spark: SparkSession, amount: float, per_task: float) -> int:
    """Tasks for ``amount`` of work, no fewer than the session's shuffle width."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(amount / per_task))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its letters' case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def pack(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``df`` with its columns ``needed`` and all others in one struct, and the way back.

    Whatever names a step uses in between, it cannot meet one of the table's own. The
    way back takes the step's result and the names of its new columns: it gives the table's
    columns as they were, without those that a new one replaces, and the new ones.
    """
    others = [c for c in df.columns if c not in needed]
    held = F.struct(F.lit(0).alias(fresh(df, "_")), *[F.col(f"`{c}`") for c in others])
    packed = df.select(*needed, *([held.alias("_packed")] if others else []))

    def unpack(done: DataFrame, *new: str) -> DataFrame:
        replaced = {c.lower() for c in new}
        own = [c for c in df.columns if c.lower() not in replaced]
        return done.select(
            *[F.col(c) if c in needed else F.col("_packed").getField(c).alias(c) for c in own], *new
        )

    return packed, unpack


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    bundle = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(bundle, "w") as archive:
        for source in package.rglob("*.py"):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(bundle))
    _SHIPPED.add(context.applicationId)


def _tidily(function: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``function``, after which the worker gives back memory that Arrow and the C library keep: workers serve many stages."""
    yield from function(batches)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(partial(_tidily, function), schema)

"""Tables that are replaced as a whole: a reader sees the old rows or the new ones, never none.

Every replacement writes its rows to a folder of their own and then adds one line
to the table's manifest. The line is a file of one task, which Spark's commit
puts in place by a single rename; until then readers resolve the line before it. A job that
dies earlier has changed nothing but an unnamed folder.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_MANIFEST = "version long, place string, published timestamp"


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException:
        return None


def _newest_first(lines: DataFrame) -> DataFrame:
    return lines.orderBy(F.desc("version"), F.desc("place"))


def resolve(spark: SparkSession, root: str) -> str | None:
    """Folder of the published rows; None if nothing was published at ``root``."""
    lines = _manifest(spark, root)
    newest = None if lines is None else _newest_first(lines).first()
    return None if newest is None else f"{root}/data/{newest.place}"


def stage(df: DataFrame, root: str) -> str:
    """Write rows beside the published ones; returns their place, for ``publish`` or ``discard``."""
    place = uuid.uuid4().hex
    df.write.option("maxRecordsPerFile", 20_000_000).parquet(f"{root}/data/{place}")
    return place


def publish(spark: SparkSession, root: str, place: str) -> int:
    """Make staged rows the table's; returns the version."""
    lines = _manifest(spark, root)
    newest = None if lines is None else _newest_first(lines).first()
    version = 1 if newest is None else newest.version + 1
    line = spark.createDataFrame([(version, place)], "version long, place string")
    line.withColumn("published", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return version


def replace(df: DataFrame, root: str) -> int:
    """Stage and publish ``df``; returns the version."""
    return publish(df.sparkSession, root, stage(df, root))


def read(spark: SparkSession, root: str, schema: StructType | str | None = None) -> DataFrame | None:
    """The published rows. The frame stays with the version it resolved."""
    path = resolve(spark, root)
    if path is None:
        return None
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def purge(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` versions (at least one); returns how many went.

    Lines go before their rows, so no line ever names rows that are gone. Keep as
    many as readers may still hold.
    """
    lines = _manifest(spark, root)
    if lines is None:
        return 0
    named = _newest_first(lines.select("version", "place", F.col("_metadata.file_path").alias("file"))).collect()
    old = named[max(keep, 1) :]  # one short line a version
    for line in old:
        delete(spark, line.file)
    for line in old:
        delete(spark, f"{root}/data/{line.place}")
    return len(old)


def discard(spark: SparkSession, root: str, place: str) -> None:
    """Remove staged rows that are not to be published, and the folder if it holds nothing else."""
    delete(spark, f"{root}/data/{place}")
    if _manifest(spark, root) is None:
        delete(spark, f"{root}/data", only_empty=True)
        delete(spark, root, only_empty=True)


def delete(spark: SparkSession, path: str, only_empty: bool = False) -> None:
    """Delete a file or folder in whatever store its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(target) and not (only_empty and len(store.listStatus(target))):
        store.delete(target, True)

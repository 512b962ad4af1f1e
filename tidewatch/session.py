"""Session set-up, shuffle sizing and the shared work folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidewatch.config import Scale


def build_session(app: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.parquet.filterPushdown": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df``, or None where it has none.

    Read from the optimised plan, so it costs no job. Sources without
    statistics report Spark's "unknown" default, which is huge.
    """
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # a remote session exposes no plan statistics
        return None
    return None if size >= 2**62 else size


_FOUND: dict[str, dict[str, str]] = {}
_FITTED = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")


def fit_session(df: DataFrame, scale: Scale = Scale()) -> int:
    """Suit the width of shuffles and scans to the size of ``df``.

    Widths are raised above what the session came with, never below it:
    adaptive execution merges small tasks, but it cannot widen a shuffle that
    was planned too narrow. Every call starts from the session's own
    settings, so a large input leaves nothing behind for a small one. Both task
    counts have a ceiling, above which tasks get larger instead, since the
    blocks of a shuffle grow with their product. Returns the shuffle width.
    """
    spark = df.sparkSession
    conf, app = spark.conf, spark.sparkContext.applicationId
    now = {name: conf.get(name) for name in _FITTED}
    made = _FOUND.get(f"{app}/made")
    if made != now:  # set by someone else since
        _FOUND[app] = now
    own = _FOUND[app]
    for name in _FITTED:
        if now[name] != own[name]:
            conf.set(name, own[name])
    current = int(own[_FITTED[0]])
    size = estimated_bytes(df)
    if size is not None:
        split_bytes = math.ceil(size / scale.max_scan_tasks)
        if split_bytes > scale.scan_task_bytes:
            conf.set(_FITTED[1], str(split_bytes))
        wanted = min(math.ceil(size / scale.shuffle_task_bytes), scale.max_shuffle_tasks)
        if wanted > current:
            conf.set(_FITTED[0], str(wanted))
            current = wanted
    _FOUND[f"{app}/made"] = {name: conf.get(name) for name in _FITTED}
    return current


_MERGED = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


@contextmanager
def all_cores(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution leaves a shuffle at least a task for each core, however little it holds: for
    work on rows that takes far longer than reading them."""
    before = spark.conf.get(_MERGED)
    spark.conf.set(_MERGED, "true")
    try:
        yield
    finally:
        spark.conf.set(_MERGED, before)


_LOCAL_WORK: dict[str, str] = {}


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names it. Only a local-mode session may go without
    and gets a temporary folder; on a cluster a machine-local folder would be
    invisible to the other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_WORK:
            _LOCAL_WORK[app] = tempfile.mkdtemp(prefix="tidewatch-")
        root = _LOCAL_WORK[app]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

"""Tables replaced as a whole, and what is purged of them."""

import threading

import pytest
from conftest import txn
from pyspark.sql import functions as F

from tidewatch.config import Paths
from tidewatch.operators.quality import QualityError
from tidewatch.plans import pipeline
from tidewatch.plans.reports import histogram
from tidewatch.sinks import run_log, versions
from tidewatch.sources import files, reference_set


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v long")


def held(spark, root):
    found = versions.read(spark, root)
    return None if found is None else sorted(r.v for r in found.collect())


def test_readers_see_old_or_new(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.read(spark, root) is None and versions.purge(spark, root) == 0
    assert versions.replace(numbers(spark, 1, 2), root) == 1
    old = versions.read(spark, root)
    place = versions.stage(numbers(spark, 3), root)
    assert held(spark, root) == [1, 2]  # staged, not published: as after a crash
    assert versions.publish(spark, root, place) == 2
    assert held(spark, root) == [3] and sorted(r.v for r in old.collect()) == [1, 2]
    assert files.read_parquet(spark, root).first().v == 3


def test_reader_during_replacements(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace(numbers(spark, 0, 0), root)
    seen, stop = [], threading.Event()

    def look():
        while not stop.is_set():
            seen.append(held(spark, root))

    reader = threading.Thread(target=look)
    reader.start()
    for k in range(1, 5):
        versions.replace(numbers(spark, k, k), root)
    stop.set()
    reader.join()
    seen.append(held(spark, root))
    assert all(rows is not None and len(rows) == 2 and rows[0] == rows[1] for rows in seen)
    assert [rows[0] for rows in seen] == sorted(rows[0] for rows in seen) and seen[-1] == [4, 4]


def test_failed_write_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace(numbers(spark, 1), root)
    broken = numbers(spark, 5).select(F.raise_error(F.lit("no")).cast("long").alias("v"))
    with pytest.raises(Exception, match="no"):
        versions.replace(broken, root)
    assert held(spark, root) == [1]


def test_purge_keeps_the_newest(spark, tmp_path):
    root = str(tmp_path / "t")
    for k in range(5):
        versions.replace(numbers(spark, k), root)
    assert versions.purge(spark, root, keep=2) == 3
    assert held(spark, root) == [4] and len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert versions.purge(spark, root, keep=0) == 1 and held(spark, root) == [4]
    assert versions.replace(numbers(spark, 9), root) == 6


def test_expired_lists_and_runs_go(spark, tmp_path):
    path = str(tmp_path / "codes")
    for codes in (["CY"], ["MT"], ["SE"]):
        reference_set.replace_codes(spark, path, codes)
    assert reference_set.purge_codes(spark, path, keep=1) == 2
    assert [r.code for r in reference_set.live_codes(spark, path).collect()] == ["SE"]
    log = str(tmp_path / "runs")
    assert run_log.purge_runs(spark, log) == 0
    counts = numbers(spark, 1).select(F.col("v").alias("record_count"), F.col("v").alias("alert_count"))
    for name in ("r1", "r2", "r3"):
        record = run_log.run_record(counts, name)
        run_log.append_run(record.withColumn("expires_at", F.col("timestamp")) if name != "r2" else record, log)
    assert run_log.purge_runs(spark, log) == 1  # r1; r3 has expired too, but is the newest
    assert sorted(r.run_id for r in spark.read.parquet(log).collect()) == ["r2", "r3"]


def test_ingest_replaces_only_what_passes(spark, frame, tmp_path):
    paths = Paths(raw=str(tmp_path / "raw"))
    pipeline.ingest(spark, paths, source=frame([txn(1), txn(2, 5)]))
    with pytest.raises(QualityError):
        pipeline.ingest(spark, paths, source=frame([txn(3), txn(3, 1)]))
    assert sorted(r.transaction_id for r in files.read_transactions(spark, paths.raw).collect()) == ["T00000001", "T00000002"]
    assert len(list((tmp_path / "raw" / "data").iterdir())) == 1
    pipeline.ingest(spark, paths, source=frame([txn(4)]))
    assert files.read_transactions(spark, paths.raw).first().transaction_id == "T00000004"


def test_nested_files_keep_their_order(spark, tmp_path):
    for k, folder in enumerate(("b", "a/x", "a/y")):
        rows = spark.range(10 * k, 10 * k + 5, 1, 1)
        rows.write.parquet(str(tmp_path / "in" / folder))
    rows = files.read_in_order(spark, str(tmp_path / "in")).orderBy("file", "row").collect()
    assert [r.id for r in rows] == [*range(10, 15), *range(20, 25), *range(0, 5)]
    (single,) = [str(p) for p in (tmp_path / "in" / "b").glob("*.parquet")]
    assert [r.row for r in files.read_in_order(spark, single).orderBy("row").collect()] == [0, 1, 2, 3, 4]
    with pytest.raises(FileNotFoundError):
        files.read_in_order(spark, str(tmp_path / "none"))
    spark.range(1).withColumnRenamed("id", "File").write.parquet(str(tmp_path / "odd"))
    with pytest.raises(ValueError):
        files.read_in_order(spark, str(tmp_path / "odd"))


def test_histogram_bins(spark):
    def bins(values, most=40):
        df = spark.createDataFrame([(v, "k") for v in values], "v double, k string")
        return [tuple(r) for r in histogram(df, "v", by=["k"], bins=most).collect()]

    assert bins([]) == [] and bins([None, float("nan"), float("inf")]) == []
    assert bins([3.0, 3.0]) == [(3.0, 4.0, "k", 2)]
    assert bins([0.1, 0.15, 0.19, 0.3], 3) == [(0.1, 0.2, "k", 3), (0.3, 0.4, "k", 1)]
    assert bins([-5.0, 0.0, 95.0], 3) == [(-50.0, 0.0, "k", 1), (0.0, 50.0, "k", 1), (50.0, 100.0, "k", 1)]
    many = bins([k / 997 for k in range(998)])
    assert len(many) <= 40 and sum(r[3] for r in many) == 998
    for low, high, _, _ in many:
        assert high - low == pytest.approx(many[0][1] - many[0][0])

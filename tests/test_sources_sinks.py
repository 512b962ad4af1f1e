import json

import pytest
from conftest import txn
from pyspark.sql import functions as F

from tidewatch.config import HIGH_RISK_COUNTRIES, Rules, Scale
from tidewatch.schema import RAW_COLUMNS, TRANSACTIONS
from tidewatch.session import estimated_bytes, fit_session, work_folder
from tidewatch.sinks import run_log, tables
from tidewatch.sources import files, generator, reference_set


def test_generator_is_the_same_for_any_partitioning(spark):
    few = generator.synthesize(spark.range(0, 2_000, 1, 1)).collect()
    many = generator.synthesize(spark.range(0, 2_000, 1, 7)).collect()
    assert sorted(few) == sorted(many)
    assert sorted(few) != sorted(generator.synthesize(spark.range(2_000), seed=7).collect())


def test_generator_distributions(spark):
    df = generator.synthesize(spark.range(40_000)).cache()
    assert df.columns == list(RAW_COLUMNS)
    shares = df.agg(
        F.avg(F.col("is_flagged_source").cast("int")).alias("suspicious"),
        F.avg(F.when(~F.col("is_flagged_source"), F.col("amount"))).alias("mean"),
        F.min("amount").alias("least"),
        F.count_distinct("customer_id").alias("customers"),
        F.min("timestamp").cast("string").alias("first"),
        F.max("timestamp").cast("string").alias("last"),
    ).first()
    assert abs(shares.suspicious - 0.08) < 0.006
    assert abs(shares.mean - 2_500) < 60
    assert shares.least >= 0.01
    assert shares.customers == 500
    assert shares["first"].startswith("2024-01-01") and shares["last"].startswith("2024-12-30")
    near = df.where("is_flagged_source").agg(F.min("amount"), F.max("amount")).first()
    assert 9_000 <= near[0] and near[1] <= 9_999
    risky_calm = df.where(~F.col("is_flagged_source") & F.col("beneficiary_country").isin(*HIGH_RISK_COUNTRIES))
    assert risky_calm.count() == 0
    assert df.where("length(transaction_id) = 11 and length(customer_id) = 9").count() == 40_000
    df.unpersist()


def test_recent_generator_stays_within_thirty_seconds(spark):
    now = F.lit("2024-05-01 10:00:30.25").cast("timestamp")
    df = generator.synthesize_recent(spark.range(500), now)
    gap = F.unix_micros(now) - F.unix_micros("timestamp")
    low, high = df.agg(F.min(gap), F.max(gap)).first()
    assert low == 0 and high == 30_000_000


def test_lognormal_generator(spark):
    df = generator.synthesize_lognormal(spark.range(40_000))
    got = df.agg(
        F.min("amount").alias("lo"),
        F.max("amount").alias("hi"),
        F.percentile_approx("amount", 0.5, 1_000).alias("mid"),
        F.avg((F.col("originator_country") == "DE").cast("int")).alias("de"),
        F.avg((F.col("channel") == "Mobile").cast("int")).alias("mobile"),
    ).first()
    assert got.lo >= 10 and got.hi <= 50_000
    assert 620 < got.mid < 780  # exp(6.5) is 665, the near-limit rows lift it
    assert abs(got.de - 0.25) < 0.01 and abs(got.mobile - 0.10) < 0.01


def test_parquet_folders_files_and_missing_paths(spark, frame, tmp_path):
    rows = frame([txn(i) for i in range(6)])
    rows.repartition(2).write.parquet(str(tmp_path / "a/b"))
    rows.coalesce(1).write.parquet(str(tmp_path / "a/c"))
    assert files.read_parquet(spark, str(tmp_path / "a"), recursive=True).count() == 12
    one = next((tmp_path / "a/c").glob("*.parquet"))
    assert files.read_transactions(spark, str(one)).count() == 6
    for schema in (None, TRANSACTIONS):
        with pytest.raises(FileNotFoundError):
            files.read_parquet(spark, str(tmp_path / "nowhere"), schema)
        (tmp_path / "empty").mkdir(exist_ok=True)
        with pytest.raises(FileNotFoundError):
            files.read_parquet(spark, str(tmp_path / "empty"), schema)


def test_rows_with_schema(spark):
    df = files.transactions_from_rows(spark, [txn(1)])
    assert df.schema == TRANSACTIONS


def test_typed_load_rejects_nulls_in_required_columns(frame):
    assert tables.typed(frame([txn(1, origin=None)])).count() == 1
    with pytest.raises(Exception, match="null in required column amount"):
        tables.typed(frame([txn(1), txn(2, amount=None)])).collect()


def test_load_replaces_the_table(spark, frame, tmp_path):
    tables.create_database(spark, "load_test", str(tmp_path / "db"))
    tables.create_database(spark, "load_test", str(tmp_path / "db"))  # already there
    assert tables.load_table(frame([txn(1), txn(2)]), "transactions", "load_test") == 2
    assert tables.load_table(frame([txn(3)]), "transactions", "load_test") == 1
    assert files.source_table(spark, "transactions", "load_test").dtypes[4] == ("amount", "double")


def test_day_folders_prune(spark, frame, tmp_path):
    out = str(tmp_path / "days")
    tables.write_by_day(frame([txn(i, i * 86_400) for i in range(5)]), out, "timestamp")
    back = files.read_partitioned(spark, out).where("txn_date = date'2024-01-03'")
    assert back.count() == 1
    assert "PartitionFilters: [isnotnull(txn_date" in back._jdf.queryExecution().executedPlan().toString()


def test_materialise(spark, frame, tmp_path):
    df = frame([txn(1)])
    assert tables.materialise(df, "a_view", "view").count() == 1
    assert tables.materialise(df, "unused", "inline") is df
    assert tables.materialise(df, "a_table", "table", str(tmp_path / "t")).count() == 1
    with pytest.raises(ValueError):
        tables.materialise(df, "x", "cube")


def codes(spark, path):
    live = reference_set.live_codes(spark, path)
    return None if live is None else {r.code for r in live.collect()}


def test_reference_set_replaces_and_expires(spark, tmp_path):
    path = str(tmp_path / "codes")
    assert codes(spark, path) is None
    assert reference_set.replace_codes(spark, path, ["CY", "XX", "XX"]) == 2
    assert codes(spark, path) == {"CY", "XX"}
    assert reference_set.replace_codes(spark, path, ["MT"]) == 1
    assert codes(spark, path) == {"MT"}
    reference_set.replace_codes(spark, path, ["MT"], ttl_seconds=-1)
    assert codes(spark, path) is None


def test_stored_codes_take_the_place_of_the_list(spark, frame, tmp_path):
    from tidewatch.operators.rules import score_transactions

    path = str(tmp_path / "codes")
    many = [f"X{k}" for k in range(20_000)]
    reference_set.replace_codes(spark, path, ["MT", *many])
    rows = frame([txn(1, origin="CY"), txn(2, dest="MT"), txn(3, origin=None, dest="X19999"), txn(4, origin=None, dest=None)])
    got = score_transactions(rows, split=False, codes=reference_set.live_codes(spark, path))
    plain = score_transactions(rows, split=False)
    assert got.columns == plain.columns
    assert {r.transaction_id[-1]: r.flag_high_risk_country for r in got.collect()} == {
        "1": False, "2": True, "3": True, "4": False,
    }


def test_quoted_country_codes_are_literals(frame):
    from dataclasses import replace

    from tidewatch.operators.rules import score_transactions

    rules = replace(Rules(), high_risk_countries=("O'X", "\\"))
    rows = frame([txn(1, origin="O'X"), txn(2, origin="\\"), txn(3, origin="OX")])
    got = {r.transaction_id: r.flag_high_risk_country for r in score_transactions(rows, rules, split=False).collect()}
    assert list(got.values()).count(True) == 2 and got["T00000003"] is False
    none = replace(Rules(), high_risk_countries=())
    assert score_transactions(rows, none, split=False).where("flag_high_risk_country").count() == 0


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert run_log.find_run(spark, path, "r1") == {}
    counts = spark.createDataFrame([(10, 3)], "record_count long, alert_count long")
    run_log.append_run(run_log.run_record(counts, "r1", details={"a": 1}), path)
    run_log.append_run(run_log.run_record(counts, "r2"), path)
    got = run_log.find_run(spark, path, "r1")
    assert (got["record_count"], got["alert_count"], got["status"], got["details"]) == (10, 3, "completed", {"a": 1})
    assert run_log.find_run(spark, path, "r3") == {}
    old = run_log.run_record(counts, "r4").withColumn("expires_at", F.current_timestamp())
    run_log.append_run(old, path)
    assert run_log.find_run(spark, path, "r4") == {}
    assert run_log.live_runs(spark, path).count() == 2


def test_json_report(spark, tmp_path):
    tables.write_json(spark.createDataFrame([(1, 0.5)], "n int, auc double"), str(tmp_path / "r"))
    text = next((tmp_path / "r").glob("*.json")).read_text()
    assert json.loads(text) == {"n": 1, "auc": 0.5}


def test_session_is_fitted_to_the_input(spark, sf_dir):
    from tidewatch.sources.adapters import txn_events

    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = {name: spark.conf.get(name) for name in names}
    df = txn_events(spark, sf_dir)
    assert estimated_bytes(df) < 1_000_000
    width = int(before[names[0]])
    try:
        assert fit_session(df) == width
        assert {name: spark.conf.get(name) for name in names} == before
        assert fit_session(df, Scale(shuffle_task_bytes=1_000, max_shuffle_tasks=width + 5)) == width + 5
        assert int(spark.conf.get(names[0])) == width + 5
        fit_session(df, Scale(scan_task_bytes=10, max_scan_tasks=100))
        assert int(spark.conf.get(names[1])) == -(-estimated_bytes(df) // 100)
        # a smaller input finds the session as it came
        assert fit_session(df, Scale(shuffle_task_bytes=10**12)) == width
        assert {name: spark.conf.get(name) for name in names} == before
        spark.conf.set(names[0], str(width + 1))  # the user's own change stays
        assert fit_session(df) == width + 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_long_ids_stay_whole(spark):
    from tidewatch.sources import adapters, generator

    events = spark.range(100_000_000, 100_000_020).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01' as ts", "id - 99975000 as user_id", "'view' as event_type", "1.0D as value"
    )
    txn = adapters.project(events, adapters.EVENT_COLUMNS)
    assert txn.select("transaction_id").distinct().count() == 20
    assert txn.select("customer_id").distinct().count() == 20
    made = generator.synthesize(spark.range(99_999_950, 100_000_060))
    assert made.select("transaction_id").distinct().count() == 110
    assert {len(r[0]) for r in made.select("transaction_id").collect()} == {11, 12}


class FakeSession:
    """The parts of a cluster session that ``work_folder`` reads."""

    def __init__(self, **settings):
        self.conf = self
        self.sparkContext = self
        self.master = "yarn"
        self._settings = settings

    def get(self, key, default=None):
        return self._settings.get(key, default)

    def getConf(self):
        return self


def test_work_folder_follows_the_shared_setting(spark):
    cluster = FakeSession(**{"spark.checkpoint.dir": "hdfs:///shared/work/"})
    assert work_folder(cluster, "x").startswith("hdfs:///shared/work/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(FakeSession(), "x")
    assert work_folder(spark, "x") != work_folder(spark, "x")

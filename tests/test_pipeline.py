"""The batch jobs end to end, through the command line's entry points."""

import json

import pytest
from conftest import txn
from pyspark.sql import functions as F

from tidewatch.__main__ import parser
from tidewatch.config import Paths, Rules
from tidewatch.operators.quality import QualityError
from tidewatch.plans import pipeline
from tidewatch.plans import training as M
from tidewatch.sources import files, reference_set
from tidewatch.sources.adapters import txn_events


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    names = ("raw", "scored", "customer_risk", "alerts_out", "customer_risk_out", "output_dir", "run_log", "reference_set")
    return Paths(**{n: str(root / n) for n in names})


@pytest.fixture(scope="module")
def done(spark, paths):
    pipeline.ingest(spark, paths, source=txn_events(spark, "/root/testdata/sf0.01"))
    return pipeline.detect(spark, paths, run_id="run_1")


def test_ingest_generates_by_default(spark, tmp_path):
    raw = pipeline.ingest(spark, Paths(raw=str(tmp_path / "raw")), n=1_000)
    assert raw.count() == 1_000
    assert raw.select("transaction_id").distinct().count() == 1_000


def test_detect_logs_its_counts(spark, paths, done):
    scored = files.read_parquet(spark, paths.scored)
    assert done["record_count"] == scored.count() == 10_000
    assert done["alert_count"] == scored.where("risk_score >= 25").count()
    assert files.read_parquet(spark, paths.customer_risk).count() == scored.select("customer_id").distinct().count()


def test_export_writes_sorted_alerts(spark, paths, done):
    rate = pipeline.export(spark, paths, files_out=1)
    assert rate["alerts"] == done["alert_count"]
    alerts = files.read_parquet(spark, paths.alerts_out).collect()
    assert [(-r.risk_score, -r.amount) for r in alerts] == sorted((-r.risk_score, -r.amount) for r in alerts)
    assert len(alerts) == rate["alerts"]
    assert files.read_parquet(spark, paths.customer_risk_out).count() == 600


def test_export_scan_gets_threshold_and_columns(spark, paths, done):
    from tidewatch.plans.reports import alert_queue

    plan = alert_queue(files.read_parquet(spark, paths.scored), Rules())._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(risk_score,25)" in plan
    assert "is_flagged_source" not in plan and "cumulative_amount" not in plan


def test_stored_countries_change_the_result(spark, paths, tmp_path, done):
    other = Paths(**{**paths.__dict__, "scored": str(tmp_path / "s"), "customer_risk": str(tmp_path / "c"),
                     "reference_set": str(tmp_path / "codes"), "run_log": str(tmp_path / "runs")})
    reference_set.replace_codes(spark, other.reference_set, ["DE"])
    pipeline.detect(spark, other, run_id="run_2")
    scored = files.read_parquet(spark, other.scored)
    expected = (F.col("originator_country") == "DE") | (F.col("beneficiary_country") == "DE")
    assert scored.where(F.col("flag_high_risk_country") != expected).count() == 0


@pytest.mark.parametrize(
    "second, why", [({}, "repeated"), ({"transaction_id": "X", "customer_id": None}, "customer_id")]
)
def test_failed_gate_stores_nothing(spark, frame, tmp_path, second, why):
    target = Paths(raw=str(tmp_path / "raw"))
    with pytest.raises(QualityError, match=why):
        pipeline.ingest(spark, target, source=frame([txn(1), txn(1, **second)]))
    assert not (tmp_path / "raw").exists()


def test_load_job(spark, paths, done, tmp_path):
    n = pipeline.load(spark, paths.raw, "pipeline_db", location=str(tmp_path / "db"), create_database=True)
    assert n == 10_000
    assert pipeline.load(spark, paths.scored, "pipeline_db", "scored") == 10_000
    with pytest.raises(FileNotFoundError):
        pipeline.load(spark, str(tmp_path / "none"), "pipeline_db")


def test_report_job(spark, paths, done):
    names = pipeline.report(spark, paths)
    got = {n: spark.read.json(f"{paths.output_dir}/reports/{n}").collect() for n in names}
    assert got["alert_rate"][0].alerts == done["alert_count"]
    assert sum(r["count"] for r in got["tier_distribution"]) == 10_000
    assert len(got["top_customers"]) == 15 and len(got["top_flagged"]) == 20
    assert got["rank_metrics"][0].gini == pytest.approx(2 * got["rank_metrics"][0].auc - 1)
    assert all(got.values())


def test_simulated_dashboard_frame(spark):
    frame = pipeline.build_scored_transactions(spark, n=2_000, customers=50)
    assert frame.count() == 2_000
    assert frame.select("customer_id").distinct().count() == 50
    assert frame.where("rolling_7d_count > cumulative_count").count() == 0


def test_train_and_evaluate_jobs(spark, paths, done, tmp_path):
    settings = M.TrainingSettings(rounds=4, folds=2)
    report = pipeline.train(spark, paths, Rules(), settings)
    assert report["test_auc"] > 0.9 and report["cv_mean_auc"] > 0.9
    assert report["test_gini"] == pytest.approx(2 * report["test_auc"] - 1)
    again = pipeline.evaluate(spark, paths, str(tmp_path / "report"))
    for name in ("test_auc", "test_ks", "precision", "recall", "f1", "tp", "fp", "tn", "fn", "n_test"):
        assert again[name] == pytest.approx(report[name])
    runs = spark.read.parquet(paths.run_log).where("run_id like 'train_%'").first()
    details = json.loads(runs.details)
    assert details["parameters"]["rounds"] == 4
    assert details["metrics"]["test_auc"] == pytest.approx(report["test_auc"])
    importance = {r.feature: r for r in spark.read.json(f"{paths.output_dir}/feature_importance").collect()}
    assert len(importance) == 10
    assert importance["is_weekend"].auc_drop < importance["rolling_7d_count"].auc_drop
    local = spark.read.json(f"{paths.output_dir}/local_explanations")
    assert local.select("rank").distinct().count() == 3 and local.count() == 30


def test_training_without_positives_still_reports(spark, frame, tmp_path):
    names = ("raw", "scored", "customer_risk", "output_dir", "run_log", "reference_set")
    calm = Paths(**{n: str(tmp_path / n) for n in names})
    pipeline.ingest(spark, calm, source=frame([txn(i, i * 1_000, customer=f"C{i}") for i in range(40)]))
    pipeline.detect(spark, calm)
    got = pipeline.train(spark, calm, Rules(), M.TrainingSettings(rounds=1, folds=2))
    assert got["test_auc"] is None and got["tp"] == 0 and got["f1"] == 0.0
    assert pipeline.evaluate(spark, calm)["test_auc"] is None


def test_command_line_defaults():
    args = parser().parse_args(["load", "--parquet", "p", "--database", "d"])
    assert (args.table, args.create_database) == ("transactions", False)
    assert parser().parse_args(["train"]).rounds == 300
    assert parser().parse_args(["ingest"]).rows == 10_000
    with pytest.raises(SystemExit):
        parser().parse_args(["load"])

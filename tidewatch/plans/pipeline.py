"""The batch jobs: ingest, detect, export, report, train, evaluate, load."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.config import Paths, Rules, Scale
from tidewatch.operators import ranking as K
from tidewatch.operators.quality import QualityError, enforce_gate
from tidewatch.operators.rules import score_transactions
from tidewatch.plans import attributions as A
from tidewatch.plans import reports
from tidewatch.plans import surrogate as L
from tidewatch.plans import training as M
from tidewatch.session import fit_session, work_folder
from tidewatch.sinks import run_log, tables, versions
from tidewatch.sources import files, generator, reference_set


def ingest(
    spark: SparkSession, paths: Paths, n: int = 10_000, seed: int = 42, source: DataFrame | None = None
) -> DataFrame:
    """Check transactions (generated unless given) and store them.

    The rows are written once, the gate reads the written files, and only then they
    take the place of the earlier ones: a failing gate leaves the table as it was, and
    readers see the old rows or the new ones.
    """
    txn = source if source is not None else generator.synthesize(generator.row_ids(spark, n), seed)
    place = versions.stage(tables.typed(txn, required=False), paths.raw)
    try:
        enforce_gate(files.read_transactions(spark, f"{paths.raw}/data/{place}"))
    except QualityError:
        versions.discard(spark, paths.raw, place)
        raise
    versions.publish(spark, paths.raw, place)
    return files.read_transactions(spark, paths.raw)


def detect(
    spark: SparkSession,
    paths: Paths,
    rules: Rules = Rules(),
    scale: Scale = Scale(),
    run_id: str | None = None,
) -> dict:
    """Score the stored transactions; write scored rows, profiles and a run record.

    The windows run once: profiles and counts read the written table. Readers see
    each table's old rows until its new ones are complete; ``purge`` removes versions
    that are no longer read.
    """
    codes = reference_set.live_codes(spark, paths.reference_set)
    txn = files.read_transactions(spark, paths.raw)
    fit_session(txn, scale)
    versions.replace(score_transactions(txn, rules, scale, codes=codes), paths.scored)
    scored = files.read_parquet(spark, paths.scored)
    profile = reports.customer_risk_profile(scored, rules, ordered=False)
    versions.replace(profile, paths.customer_risk)
    run_id = run_id or datetime.now(timezone.utc).strftime("run_%Y%m%d_%H%M%S")
    counts = reports.alert_rate(scored, rules).select(
        F.col("total").alias("record_count"), F.col("alerts").alias("alert_count")
    )
    run_log.append_run(run_log.run_record(counts, run_id), paths.run_log)
    return run_log.find_run(spark, paths.run_log, run_id)


def purge(spark: SparkSession, paths: Paths, keep: int = 2) -> dict[str, int]:
    """Delete older versions of the stored tables and expired run records; how many went of each."""
    tables_ = {name: getattr(paths, name) for name in ("raw", "scored", "customer_risk", "reference_set")}
    gone = {name: versions.purge(spark, path, keep) for name, path in tables_.items()}
    return {**gone, "run_log": run_log.purge_runs(spark, paths.run_log)}


def export(spark: SparkSession, paths: Paths, rules: Rules = Rules(), files_out: int | None = None) -> dict:
    """Write the alert queue and the customer profiles; returns the alert rate.

    The queue is sorted by range over many tasks. ``files_out`` merges the
    output for small results.
    """
    scored = files.read_parquet(spark, paths.scored)
    fit_session(scored)
    tables.write_parquet(reports.alert_queue(scored, rules), paths.alerts_out, files_out)
    profiles = files.read_parquet(spark, paths.customer_risk)
    tables.write_parquet(profiles, paths.customer_risk_out, files_out)
    return reports.alert_rate(scored, rules).first().asDict()


def train(
    spark: SparkSession,
    paths: Paths,
    rules: Rules = Rules(),
    settings: M.TrainingSettings = M.FULL_SETTINGS,
) -> dict:
    """Fit and explain the classifier; reports go to the output folder."""
    path = work_folder(spark, "model-inputs")
    scored = files.read_parquet(spark, paths.scored)
    fit_session(scored)
    tables.write_parquet(M.model_inputs(scored, rules), path)
    inputs = spark.read.parquet(path)
    cuts = M.split_cuts(inputs, settings)
    split = M.with_split(inputs, settings, cuts)
    model, unseen = M.fit_all(split, settings)
    model.cuts = cuts
    folds = M.fold_report(unseen, settings)
    M.save(model, f"{paths.output_dir}/risk_model", rules, settings)
    test = M.test_part(split)
    evaluated = M.evaluate(M.predict(model, test))
    metrics = evaluated.first()
    schema = StructType([*folds.schema, *evaluated.schema])
    row = spark.createDataFrame([(*folds.first(), *metrics)], schema)
    tables.write_json(row, f"{paths.output_dir}/metrics")
    report = row.first().asDict()
    tables.write_json(M.permutation_importance(model, test), f"{paths.output_dir}/feature_importance")
    tables.write_json(A.mean_attributions(model, test), f"{paths.output_dir}/mean_attributions")
    tables.write_parquet(A.attribution_rows(model, test), f"{paths.output_dir}/attributions")
    tables.write_json(L.local_explanations(model, split), f"{paths.output_dir}/local_explanations")
    run_id = datetime.now(timezone.utc).strftime("train_%Y%m%d_%H%M%S")
    counts = spark.createDataFrame(
        [(metrics.n_test, metrics.tp + metrics.fp)], "record_count long, alert_count long"
    )
    details = M.run_details(settings, rules, report)
    run_log.append_run(run_log.run_record(counts, run_id, details=details), paths.run_log)
    return report


def evaluate(spark: SparkSession, paths: Paths, report_path: str | None = None) -> dict:
    """Re-evaluate the stored model on its test rows and write the report."""
    scored = files.read_parquet(spark, paths.scored)
    fit_session(scored)
    evaluated = M.reload_and_evaluate(scored, f"{paths.output_dir}/risk_model")
    row = evaluated.first()
    out = report_path or f"{paths.output_dir}/evaluation"
    tables.write_json(spark.createDataFrame([tuple(row)], evaluated.schema), out)
    return row.asDict()


def rule_reports(scored: DataFrame, rules: Rules = Rules()) -> dict[str, DataFrame]:
    """Every report over scored rows; each is small, whatever the size of the input."""
    counts = K.score_counts(scored, "risk_score", F.col("is_flagged_source"), few_values=True)
    return {
        "count_by_currency": reports.counts_by(scored, "currency"),
        "count_by_channel": reports.counts_by(scored, "channel"),
        "flag_totals": reports.flag_totals(scored, rules),
        "flag_breakdown": reports.flag_breakdown(scored, rules),
        "tier_distribution": reports.tier_distribution_filled(scored),
        "overview": reports.overview_kpis(scored, rules),
        "alert_rate": reports.alert_rate(scored, rules),
        "high_tier_top": reports.high_tier_top(scored),
        "top_flagged": reports.top_flagged(scored, rules),
        "top_customers": reports.top_customers(scored, rules),
        "monthly_trend": reports.monthly_trend(scored, rules),
        "daily_alerts": reports.daily_alerts(scored, rules),
        "score_histogram": reports.score_histogram(scored),
        "rule_evaluation": reports.precision_recall(reports.rule_confusion(scored, rules)),
        "classification_report": reports.rule_classification_report(scored, rules),
        "rank_metrics": counts.agg(*[v.alias(k) for k, v in K.curve_metrics().items()]),
        "roc_curve": K.roc_points(counts),
    }


def report(spark: SparkSession, paths: Paths, rules: Rules = Rules()) -> list[str]:
    """Write all reports as JSON below the output folder.

    They read the stored scored table, each only the columns it needs, so
    nothing has to be held in memory between them.
    """
    scored = files.read_parquet(spark, paths.scored)
    fit_session(scored)
    made = rule_reports(scored, rules)
    for name, frame in made.items():
        tables.write_json(frame, f"{paths.output_dir}/reports/{name}")
    return list(made)


def build_scored_transactions(
    spark: SparkSession, n: int = 2_000, customers: int = 300, seed: int = 42, rules: Rules = Rules()
) -> DataFrame:
    """The dashboard's frame: log-normal transactions scored with the open
    window and exact gaps."""
    txn = generator.synthesize_lognormal(generator.row_ids(spark, n), seed, customers)
    return score_transactions(txn, rules, elapsed_gap=True, open_window=True)


def load(
    spark: SparkSession,
    parquet: str,
    database: str,
    table: str = "transactions",
    location: str | None = None,
    create_database: bool = False,
) -> int:
    """Load Parquet files into a catalog table; returns the rows it then holds.

    The transactions table has fixed types and required columns; any other
    table keeps the types of its files.
    """
    if create_database:
        tables.create_database(spark, database, location)
    found = files.read_parquet(spark, parquet)
    if table == "transactions":
        return tables.load_table(found, table, database)
    return tables.load_table(found, table, database, schema=None)

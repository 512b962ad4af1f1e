"""The registered queries: a name, a source and a plan each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.config import MODEL_FEATURES, Rules, Scale
from tidewatch.functions import scalars as S
from tidewatch.operators import quality as Q
from tidewatch.operators import ranking as K
from tidewatch.operators.history import with_history
from tidewatch.operators.rules import LEGS, features, score_transactions, with_listed_legs
from tidewatch.plans import attributions as A
from tidewatch.plans import detection as D
from tidewatch.plans import reports as R
from tidewatch.plans import surrogate as L
from tidewatch.plans import training as M
from tidewatch.schema import RAW_COLUMNS
from tidewatch.session import work_folder
from tidewatch.sinks import run_log, tables
from tidewatch.sources import adapters, files, generator, reference_set
from tidewatch.streaming import consumer, messages

Query = Callable[[SparkSession, str], DataFrame]
Source = Callable[[SparkSession, str], DataFrame]

ALL_EVENTS = adapters.txn_events


def EVENTS(spark: SparkSession, sf_dir: str) -> DataFrame:  # noqa: N802
    return Q.accepted(ALL_EVENTS(spark, sf_dir))


def ORDERS(spark: SparkSession, sf_dir: str) -> DataFrame:  # noqa: N802
    return Q.accepted(adapters.txn_orders(spark, sf_dir))


def NEAR_LIMIT(spark: SparkSession, sf_dir: str) -> DataFrame:  # noqa: N802
    return Q.accepted(adapters.txn_structuring(spark, sf_dir))


RULES = Rules()
SETTINGS = M.FULL_SETTINGS
THREE_VALUED = replace(RULES, null_safe_countries=False)
# Splits customers from 20 rows on, so that the plan for busy customers runs on
# any size of input.
SPLIT_EARLY = Scale(busy_rows=20)


def _on(source: Source, plan: Callable[[DataFrame], DataFrame]) -> Query:
    """A plan over raw transactions."""
    return lambda spark, sf_dir: plan(source(spark, sf_dir))


def _scored(plan: Callable[[DataFrame], DataFrame], source: Source = EVENTS) -> Query:
    """A plan over scored transactions."""
    return _on(source, lambda txn: plan(score_transactions(txn, RULES)))


_HISTORY = ("rolling_7d_amount", "rolling_7d_count", "rolling_7d_avg")


def _rolling(txn: DataFrame, **how) -> DataFrame:
    return with_history(txn, RULES, **how).select("transaction_id", "customer_id", *_HISTORY)


def _running(txn: DataFrame, **how) -> DataFrame:
    return with_history(txn, RULES, **how).select(
        "transaction_id", "customer_id", "cumulative_amount", "cumulative_count"
    )


def _gaps(txn: DataFrame, elapsed: bool = False, **how) -> DataFrame:
    return features(txn, RULES, elapsed_gap=elapsed, **how).select(
        "transaction_id", "customer_id", "timestamp", "prev_timestamp", "seconds_since_last_txn"
    )


def _calendar(txn: DataFrame) -> DataFrame:
    return txn.select(
        "transaction_id", "timestamp", *[c.alias(n) for n, c in S.calendar_columns().items()]
    )


def _countries(txn: DataFrame, rules: Rules) -> DataFrame:
    return txn.select(
        "transaction_id",
        "originator_country",
        "beneficiary_country",
        S.touches_high_risk(rules).alias("involves_high_risk_country"),
    )


def _stored_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country test with a list kept in a table instead of the constant."""
    path = work_folder(spark, "reference-set")
    reference_set.replace_codes(spark, path, ["CY", "MT", "SE"])
    codes = reference_set.live_codes(spark, path)
    txn = with_listed_legs(EVENTS(spark, sf_dir), codes)
    return txn.select(
        "transaction_id",
        *LEGS,
        (F.col(f"_{LEGS[0]}_listed") | F.col(f"_{LEGS[1]}_listed")).alias("involves_high_risk_country"),
    )


# --- written and read back -------------------------------------------------


def _scored_rescan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "scored")
    tables.write_parquet(score_transactions(EVENTS(spark, sf_dir), RULES), path)
    return files.read_parquet(spark, path)


def _alerts_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export from the stored table: threshold and columns reach its scan."""
    path = work_folder(spark, "alerts")
    tables.write_parquet(R.alert_queue(_scored_rescan(spark, sf_dir), RULES), path)
    return files.read_parquet(spark, path)


def _typed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load raw transactions into a catalog table with required fields."""
    folder = work_folder(spark, "database")
    name = "db_" + folder.rsplit("-", 1)[1]
    tables.create_database(spark, name, folder)
    tables.load_table(EVENTS(spark, sf_dir), "transactions", name)
    return files.source_table(spark, "transactions", name).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )


def _detected_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load any other table with the types it brings."""
    folder = work_folder(spark, "database")
    name = "db_" + folder.rsplit("-", 1)[1]
    tables.create_database(spark, name, folder)
    queue = R.alert_queue(score_transactions(EVENTS(spark, sf_dir), RULES), RULES)
    tables.load_table(queue, "alert_queue", name, schema=None)
    return files.source_table(spark, "alert_queue", name)


def _recursive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in nested folders: each row with its file's place among the sorted paths and its own place in the file."""
    root = work_folder(spark, "nested")
    events = EVENTS(spark, sf_dir).select("transaction_id", "amount", "currency", "channel")
    nested = events.withColumns({"c1": F.col("currency"), "c2": F.col("channel")})
    dealt = nested.repartition("c1", "c2").sortWithinPartitions("c1", "c2", "transaction_id")
    dealt.write.partitionBy("c1", "c2").parquet(root)
    rows = files.read_in_order(spark, root)
    names = rows.select("file").distinct()
    ranked = names.select("file", F.row_number().over(Window.orderBy("file")).alias("file_place"))  # one row a file
    return rows.join(ranked, "file").select("transaction_id", "amount", "file_place", F.col("row").alias("row_place"))


def _partitioned_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "alert-mart")
    tables.write_by_day(D.mart_alert_queue(EVENTS(spark, sf_dir), RULES), path, "transaction_timestamp")
    return files.read_partitioned(spark, path)


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View, inline model and table in a row, as the warehouse project has them."""
    tag = work_folder(spark, "models")
    suffix = tag.rsplit("-", 1)[1]
    EVENTS(spark, sf_dir).createOrReplaceTempView(f"transactions_{suffix}")
    raw = files.source_table(spark, f"transactions_{suffix}")
    staged = tables.materialise(D.staged(raw), f"stg_{suffix}", "view")
    model_input = staged.withColumnRenamed("transaction_timestamp", "timestamp")
    inline = tables.materialise(D.mart_alert_queue(model_input, RULES), f"queue_{suffix}", "inline")
    mart = tables.materialise(inline, f"mart_{suffix}", "table", path=f"{tag}/mart")
    return mart.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"))


def _run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "runs")
    rate = R.alert_rate(score_transactions(EVENTS(spark, sf_dir), RULES), RULES)
    counts = rate.select(F.col("total").alias("record_count"), F.col("alerts").alias("alert_count"))
    run_log.append_run(run_log.run_record(counts, "run_events", details={"source": "events"}), path)
    return run_log.live_runs(spark, path).select(
        "run_id",
        "record_count",
        "alert_count",
        "status",
        "details",
        (F.unix_seconds("expires_at") - F.unix_seconds("timestamp")).alias("kept_seconds"),
    )


# --- quality ---------------------------------------------------------------


def _repeated_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The duplicate count on a column that does repeat."""
    users = adapters.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("transaction_id")
    )
    return Q.duplicate_ids(users)


def _raw_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts before the adapter drops those that are not positive."""
    events = adapters.table(spark, sf_dir, "events")
    return Q.invalid_amounts(events.select((F.col("value") * 50).alias("amount")))


_CORE = ("transaction_id", "customer_id", "amount")


def _stored_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored warehouse model as a table: tests look at stored models, and
    both marts share one run of the windows."""
    path = work_folder(spark, "warehouse-model")
    tables.write_parquet(D.warehouse_model(EVENTS(spark, sf_dir), RULES), path)
    return files.read_parquet(spark, path)


_LEVELS = ("Critical", "High", "Medium", "Low")
#: The declared tests of each model. Staging has the rows and columns of the source.
TESTS = {
    "source": [
        *[Q.DataTest(f"not_null_{m}_{c}", "not_null", c) for m in ("source", "staging") for c in _CORE],
        *[Q.DataTest(f"unique_{m}_transaction_id", "unique", "transaction_id") for m in ("source", "staging")],
        # Two that fail on purpose: customers have many transactions, and there are further channels.
        Q.DataTest("unique_raw_customer_customer_id", "unique", "customer_id"),
        Q.DataTest("accepted_values_raw_channel_channel", "accepted", "channel", ("click", "view")),
    ],
    "alert_queue": [
        *[Q.DataTest(f"not_null_alert_queue_{c}", "not_null", c) for c in ("transaction_id", "risk_score")],
        Q.DataTest("accepted_values_alert_queue_risk_tier", "accepted", "risk_tier", ("HIGH", "MEDIUM")),
        Q.DataTest("alert_queue_min_score", "least", "risk_score", (RULES.alert_threshold,)),
    ],
    "customer_profile": [
        *[Q.DataTest(f"not_null_customer_profile_{c}", "not_null", c) for c in ("customer_id", "max_risk_score")],
        Q.DataTest("unique_customer_profile_customer_id", "unique", "customer_id"),
        Q.DataTest("accepted_values_customer_profile_risk_tier", "accepted", "risk_tier", _LEVELS),
    ],
}


def _data_tests(kinds: tuple[str, ...]) -> Query:
    """The declared tests of some kinds, each model scanned once."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = _stored_model(spark, sf_dir)
        models = {
            "source": ALL_EVENTS(spark, sf_dir),
            "alert_queue": D.alert_mart(stored, RULES),
            "customer_profile": D.customer_mart(stored),
        }
        wanted = {name: [t for t in tests if t.kind in kinds] for name, tests in TESTS.items()}
        return Q.together([Q.compiled(models[name], tests) for name, tests in wanted.items() if tests])

    return run


# --- rank metrics ----------------------------------------------------------


def _score_counts(scored: DataFrame) -> DataFrame:
    return K.score_counts(scored, "risk_score", F.col("is_flagged_source"), few_values=True)


# --- model ------------------------------------------------------------------

class _Fit(NamedTuple):
    """What one fit of all models left: the stored feature table, the model, its stored
    copy, and the stored margins of rows under the models of the other folds."""

    inputs: DataFrame
    model: M.RiskModel
    path: str
    unseen: DataFrame


_FITTED: dict[tuple, _Fit] = {}


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Time and size of the input files; changed data are fitted anew."""
    files_ = adapters.table(spark, sf_dir, "events").select("_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size")
    return tuple(files_.distinct().agg(F.max("file_modification_time"), F.sum("file_size"), F.count(F.lit(1))).first())


def _split_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, M.Cuts]:
    """Model inputs, stored once, and the cuts of their split: boosting reads them often,
    and a lost executor then costs a re-read and not the windows again."""
    path = work_folder(spark, "model-inputs")
    tables.write_parquet(M.model_inputs(score_transactions(EVENTS(spark, sf_dir), RULES), RULES), path)
    inputs = spark.read.parquet(path)
    return inputs, M.split_cuts(inputs, SETTINGS)


def _fitted(spark: SparkSession, sf_dir: str) -> _Fit:
    """All models of one state of a data set, kept for the session."""
    key = (spark.sparkContext.applicationId, sf_dir, _stamp(spark, sf_dir))
    if key not in _FITTED:
        inputs, cuts = _split_table(spark, sf_dir)
        split = M.with_split(inputs, SETTINGS, cuts)
        model, unseen = M.fit_all(split, SETTINGS)
        model.cuts = cuts
        path = work_folder(spark, "model")
        M.save(model, path, RULES, SETTINGS)
        _FITTED[key] = _Fit(split, model, path, unseen)
    return _FITTED[key]


def _feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir).inputs


def _test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.test_part(_feature_table(spark, sf_dir))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.predict(_fitted(spark, sf_dir).model, _test_rows(spark, sf_dir))


def _split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs, cuts = _split_table(spark, sf_dir)
    return M.split_counts(M.with_split(inputs, SETTINGS, cuts))


def _fold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs, cuts = _split_table(spark, sf_dir)
    return M.train_part(M.with_split(inputs, SETTINGS, cuts)).groupBy("fold", "label").count()


def _cross_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.fold_report(_fitted(spark, sf_dir).unseen, SETTINGS)


def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.permutation_importance(_fitted(spark, sf_dir).model, _test_rows(spark, sf_dir))


def _attributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.attribution_rows(_fitted(spark, sf_dir).model, _test_rows(spark, sf_dir))


def _mean_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.mean_attributions(_fitted(spark, sf_dir).model, _test_rows(spark, sf_dir))


def _attribution_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each test row's base and contributions add up to its margin."""
    whole = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    return A.attributions(_fitted(spark, sf_dir).model, _test_rows(spark, sf_dir)).select(
        "transaction_id",
        (F.abs(whole - F.col("margin")) < 1e-9).alias("adds_up"),
        F.size("contributions").alias("features"),
    )


def _explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.local_explanations(_fitted(spark, sf_dir).model, _feature_table(spark, sf_dir))


def _reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the stored model and evaluate it on rows scored afresh."""
    return M.reload_and_evaluate(score_transactions(EVENTS(spark, sf_dir), RULES), _fitted(spark, sf_dir).path)


def _model_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    guess = F.col("predicted") == 1
    return R.classification_report(_predictions(spark, sf_dir).select((F.col("label") == 1).alias("label"), guess.alias("predicted")))


def _model_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.roc_points(K.score_counts(_predictions(spark, sf_dir), "probability", F.col("label") == 1))


def _model_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.histogram(_predictions(spark, sf_dir), "probability", by=["predicted"])


def _scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test rows, each with whether its probability and class are as they must be."""
    p = F.col("probability")
    return _predictions(spark, sf_dir).select(
        "transaction_id",
        "label",
        p.between(0, 1).alias("in_range"),
        (F.col("predicted") == (p >= 0.5).cast("int")).alias("class_follows"),
    )


def _near(a: float, b: float) -> bool:
    return abs(a - b) < 1e-9


def _metrics_checks(spark: SparkSession, sf_dir: str) -> dict[str, bool]:
    m = M.evaluate(_predictions(spark, sf_dir)).first()
    p, r = m.precision, m.recall
    return {
        "auc_is_high": m.test_auc > 0.9,
        "gini_from_auc": _near(m.test_gini, 2 * m.test_auc - 1),
        "f1_from_precision_and_recall": _near(m.f1, 2 * p * r / (p + r) if p + r else 0.0),
        "cells_add_up": m.tp + m.fp + m.tn + m.fn == m.n_test,
    }


def _reload_checks(spark: SparkSession, sf_dir: str) -> dict[str, bool]:
    evaluated, again = M.evaluate(_predictions(spark, sf_dir)), _reloaded(spark, sf_dir)
    return {"reloaded_model_is_the_same": tuple(again.first()) == tuple(evaluated.first())}


def _importance_checks(spark: SparkSession, sf_dir: str) -> dict[str, bool]:
    rows = _importance(spark, sf_dir).collect()
    return {
        "importance_of_every_feature": {r.feature for r in rows} == set(MODEL_FEATURES),
        "gains_add_up_to_one": _near(sum(r.split_gain for r in rows), 1.0),
    }


def _explanation_checks(spark: SparkSession, sf_dir: str) -> dict[str, bool]:
    explained = _explained(spark, sf_dir).collect()
    first = {r.transaction_id: r.probability for r in M.top_risks(_predictions(spark, sf_dir)).collect()}
    return {
        "three_rows_explained_by_every_feature": sorted(r.rank for r in explained) == sorted([1, 2, 3] * len(MODEL_FEATURES)),
        "explained_rows_are_the_riskiest": {r.transaction_id: r.probability for r in explained} == first,
    }


def _fold_checks(spark: SparkSession, sf_dir: str) -> dict[str, bool]:
    row = _cross_validated(spark, sf_dir).first()
    return {
        "cross_validated_auc_is_high": row.cv_mean_auc > 0.9,
        "cross_validated_gini_from_auc": _near(row.cv_gini, 2 * row.cv_mean_auc - 1),
    }


def _report_checks(spark: SparkSession, sf_dir: str) -> dict[str, bool]:
    m = M.evaluate(_predictions(spark, sf_dir)).first()
    last = _model_curve(spark, sf_dir).agg(F.max("fpr").alias("fpr"), F.max("tpr").alias("tpr")).first()
    report = {r["class"]: r.support for r in _model_report(spark, sf_dir).collect()}
    return {
        "attribution_of_every_feature": _mean_attributions(spark, sf_dir).count() == len(MODEL_FEATURES),
        "report_covers_test_rows": report["macro avg"] == m.n_test and report["High Risk"] == m.tp + m.fn,
        "curve_ends_at_one": _near(last.fpr, 1.0) and _near(last.tpr, 1.0),
        "histogram_covers_test_rows": _model_histogram(spark, sf_dir).agg(F.sum("count")).first()[0] == m.n_test,
    }


def _checks(*groups: Callable[[SparkSession, str], dict[str, bool]]) -> Query:
    """What must hold of any fitted model, one row a check, from the stored results of the fit."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = {name: bool(ok) for group in groups for name, ok in group(spark, sf_dir).items()}
        return spark.createDataFrame(list(found.items()), "check_name string, ok boolean")

    return run


def model_queries() -> dict[str, Query]:
    return {
        "ml_features": _scored(lambda s: M.model_inputs(s, RULES)),
        "ml_label_balance": _scored(lambda s: M.label_balance(M.model_inputs(s, RULES))),
        "ml_split_counts": _split_counts,
        "ml_fold_counts": _fold_counts,
        "ml_train_score": _predictions,
        "ml_metrics": lambda spark, sf_dir: M.evaluate(_predictions(spark, sf_dir)),
        "top3_risk": lambda spark, sf_dir: M.top_risks(_predictions(spark, sf_dir)),
        "ml_cv": _cross_validated,
        "ml_feature_importance": _importance,
        "ml_local_explanations": _explained,
        "ml_reload_evaluate": _reloaded,
        "ml_shap": _attributed,
        "ml_shap_importance": _mean_attributions,
        "ml_shap_checks": _attribution_checks,
        "ml_classification_report": _model_report,
        "ml_roc_curve": _model_curve,
        "ml_score_histogram": _model_histogram,
        "ml_scored_rows": _scored_rows,
        "ml_metrics_checks": _checks(_metrics_checks),
        "ml_reload_checks": _checks(_reload_checks),
        "ml_importance_checks": _checks(_importance_checks),
        "ml_explanation_checks": _checks(_explanation_checks),
        "ml_cv_checks": _checks(_fold_checks),
        "ml_checks": _checks(
            _metrics_checks, _reload_checks, _importance_checks, _explanation_checks, _fold_checks, _report_checks
        ),
    }


# --- streams and messages --------------------------------------------------


def _props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapters.table(spark, sf_dir, "events")
    return messages.decode_json(events, "k long", "props", keep=("event_id",)).where(F.col("k").isNotNull())


def _messages_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode to keyed messages as bytes, then decode."""
    sent = messages.encode(EVENTS(spark, sf_dir)).select("key", F.col("value").cast("binary").alias("value"))
    return messages.with_time(messages.decode(sent, keep=("key",))).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _sent(txn: DataFrame) -> DataFrame:
    """Transactions as messages, made by all cores: few tasks read a small file, which
    takes far less time than making messages of its rows. Dealt by id: to deal rows
    in turn, Spark sorts them first."""
    return messages.encode(txn.repartition(txn.sparkSession.sparkContext.defaultParallelism, "transaction_id"))


def _as_message_files(spark: SparkSession, sf_dir: str) -> str:
    folder = work_folder(spark, "messages")
    _sent(EVENTS(spark, sf_dir)).select("value").write.text(folder)
    return folder


def _stream_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode a message stream into a table, without scoring."""
    folder = _as_message_files(spark, sf_dir)
    out, checkpoint = work_folder(spark, "decoded"), work_folder(spark, "checkpoint")
    rows = messages.with_time(messages.decode(consumer.json_lines_source(spark, folder)))
    (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(rows.schema).parquet(out).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )


def _stream_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score a message stream that delivers everything in one micro-batch."""
    raw = consumer.json_lines_source(spark, _as_message_files(spark, sf_dir))
    out = work_folder(spark, "stream-scored")
    scorer = consumer.BatchScorer(out, work_folder(spark, "rejects"))
    consumer.start(raw, scorer, work_folder(spark, "checkpoint")).awaitTermination()
    return (
        consumer.scored_table(spark, out)
        .drop("batch_id")
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    )


def _stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are damaged: how many of each kind are put aside."""
    sent = _sent(EVENTS(spark, sf_dir))
    number = F.regexp_extract("value", r'"TXN(\d+)"', 1).cast("long")
    damaged = (
        F.when(number % 50 == 1, F.substring("value", 1, 9))
        .when(number % 50 == 2, F.regexp_replace("value", '"customer_id"', '"customer"'))
        .when(number % 50 == 3, F.regexp_replace("value", r'"timestamp":"[^"]*"', '"timestamp":"soon"'))
        .otherwise(F.col("value"))
    )
    folder, rejects = work_folder(spark, "messages"), work_folder(spark, "rejects")
    sent.select(damaged.alias("value")).write.text(folder)
    scorer = consumer.BatchScorer(work_folder(spark, "stream-scored"), rejects)
    raw = consumer.json_lines_source(spark, folder)
    consumer.start(raw, scorer, work_folder(spark, "checkpoint")).awaitTermination()
    found = spark.read.schema("message string, reject_reason string").parquet(rejects)
    return found.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


#: Days of the month of the three deliveries.
_DELIVERIES = ((1, 10), (11, 20), (21, 31))


def _delivered(spark: SparkSession, sf_dir: str, scorer: consumer.BatchScorer) -> None:
    """Messages in the order of time, in three deliveries. The stream is stopped after each and
    started again from its checkpoint, as one batch a delivery. Each row becomes a message once."""
    folder, checkpoint = work_folder(spark, "messages"), work_folder(spark, "checkpoint")
    day = F.dayofmonth("timestamp")
    for days in _DELIVERIES:
        _sent(EVENTS(spark, sf_dir).where(day.between(*days))).select("value").write.mode("append").text(folder)
        consumer.start(consumer.json_lines_source(spark, folder), scorer, checkpoint).awaitTermination()


def _stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, each going on from what is stored."""
    out = work_folder(spark, "stream-scored")
    _delivered(spark, sf_dir, consumer.BatchScorer(out, work_folder(spark, "rejects"), remember=True))
    return (
        consumer.scored_table(spark, out)
        .drop("batch_id")
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    )


def _stream_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of the three batches counted while it was written."""
    summaries = work_folder(spark, "summaries")
    scorer = consumer.BatchScorer(
        work_folder(spark, "stream-scored"), work_folder(spark, "rejects"), summaries=summaries, remember=True
    )
    _delivered(spark, sf_dir, scorer)
    return spark.read.parquet(summaries).select(F.col("batch_id").cast("long"), "processed", "alerts")


# --- generated from the tables' ids ----------------------------------------


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))


def _zoneless(txn: DataFrame) -> DataFrame:
    return txn.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(generator.synthesize(_ids(spark, sf_dir)))


def _generated_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapters.table(spark, sf_dir, "events")
    ids = events.select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("_now"))
    return _zoneless(generator.synthesize_recent(ids, F.col("_now")))


def _generated_lognormal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's frame: generated rows scored with the open window."""
    txn = generator.synthesize_lognormal(_ids(spark, sf_dir))
    return score_transactions(txn, RULES, elapsed_gap=True, open_window=True)


def relational_queries() -> dict[str, Query]:
    return {
        # scans, sinks, staging
        "scan_transactions": _on(ALL_EVENTS, lambda t: t.select(*RAW_COLUMNS)),
        "scan_scored": _scored_rescan,
        "scan_nested_files": _recursive_scan,
        "sink_parquet_roundtrip": _alerts_roundtrip,
        "load_typed_table": _typed_table,
        "load_detected_table": _detected_table,
        "stg_transactions": _on(ALL_EVENTS, D.staged),
        "materialised_models": _models,
        "gen_transactions": _generated,
        "gen_transactions_recent": _generated_recent,
        "gen_transactions_lognormal": _generated_lognormal,
        # scalar features
        "calendar_features": _on(EVENTS, _calendar),
        "calendar_features_orders": _on(ORDERS, _calendar),
        "high_risk_feature": _on(EVENTS, lambda t: _countries(t, RULES)),
        "high_risk_feature_3vl": _on(EVENTS, lambda t: _countries(t, THREE_VALUED)),
        "ref_high_risk_countries": _stored_countries,
        "inter_arrival": _on(EVENTS, _gaps),
        "inter_arrival_elapsed": _on(EVENTS, lambda t: _gaps(t, True)),
        "txn_features": _on(EVENTS, lambda t: features(t, RULES).drop("prev_timestamp")),
        # windows
        "rolling_7d": _on(EVENTS, _rolling),
        "rolling_7d_orders": _on(ORDERS, _rolling),
        "rolling_7d_split": _on(EVENTS, lambda t: _rolling(t, scale=SPLIT_EARLY, split=True)),
        "rolling_7d_open_split": _on(
            EVENTS, lambda t: _rolling(t, open_window=True, scale=SPLIT_EARLY, split=True)
        ),
        "cumulative_split": _on(EVENTS, lambda t: _running(t, scale=SPLIT_EARLY, split=True)),
        "inter_arrival_split": _on(EVENTS, lambda t: _gaps(t, scale=SPLIT_EARLY, split=True)),
        "rolling_7d_open": _on(EVENTS, lambda t: _rolling(t, open_window=True)),
        "rolling_7d_open_orders": _on(ORDERS, lambda t: _rolling(t, open_window=True)),
        "cumulative": _on(EVENTS, _running),
        "cumulative_orders": _on(ORDERS, _running),
        # typologies and score
        "typology_structuring": _on(EVENTS, D.structuring),
        "typology_structuring_subthreshold": _on(NEAR_LIMIT, D.structuring_subthreshold),
        "typology_velocity": _on(EVENTS, D.high_velocity),
        "typology_high_risk_country": _on(EVENTS, D.high_risk_country),
        "typology_amount_spike": _on(EVENTS, D.amount_spike),
        "typology_amount_spike_rounded": _on(EVENTS, lambda t: D.amount_spike(t, rounded_test=True)),
        "typology_rapid_succession": _on(EVENTS, D.rapid_succession),
        "typology_rapid_succession_elapsed": _on(EVENTS, lambda t: D.rapid_succession(t, elapsed_gap=True)),
        "risk_score_final": _scored(lambda s: s),
        "risk_score_final_orders": _scored(lambda s: s, ORDERS),
        "risk_score_final_structuring": _scored(lambda s: s, NEAR_LIMIT),
        "risk_score_final_split": _on(
            EVENTS, lambda t: score_transactions(t, RULES, SPLIT_EARLY, split=True)
        ),
        "risk_score_final_sql": _on(EVENTS, D.warehouse_score),
        "int_risk_flagged": _on(EVENTS, D.risk_flagged),
        # marts
        "mart_aml_alert_queue": _on(EVENTS, lambda t: D.mart_alert_queue(t, ordered=True)),
        "mart_alert_queue_partitioned": _partitioned_mart,
        "mart_customer_risk_profile": _on(EVENTS, lambda t: D.mart_customer_profile(t, ordered=True)),
        # reports
        "alert_queue": _scored(R.alert_queue),
        "count_by_currency": _on(EVENTS, lambda t: R.counts_by(t, "currency")),
        "count_by_channel": _on(EVENTS, lambda t: R.counts_by(t, "channel")),
        "flag_totals": _scored(R.flag_totals),
        "flag_breakdown": _scored(R.flag_breakdown),
        "tier_distribution": _scored(R.tier_distribution),
        "tier_distribution_filled": _scored(R.tier_distribution_filled),
        "customer_risk_profile": _scored(R.customer_risk_profile),
        "customer_risk_profile_orders": _scored(R.customer_risk_profile, ORDERS),
        "top_customers": _scored(R.top_customers),
        "alert_rate": _scored(R.alert_rate),
        "rule_confusion": _scored(R.rule_confusion),
        "rule_precision_recall": _scored(lambda s: R.precision_recall(R.rule_confusion(s))),
        "classification_report": _scored(R.rule_classification_report),
        "monthly_trend": _scored(R.monthly_trend, ORDERS),
        "monthly_trend_top": _scored(lambda s: R.monthly_trend(s).limit(12), ORDERS),
        "daily_alerts": _scored(R.daily_alerts),
        "score_histogram": _scored(R.score_histogram),
        "amount_histogram": _scored(lambda s: R.histogram(s, "rolling_7d_amount", by=["risk_tier"])),
        "overview_kpis": _scored(R.overview_kpis),
        "high_tier_top10": _scored(R.high_tier_top),
        "top_flagged": _scored(R.top_flagged),
        "top_alerts": _scored(lambda s: R.alert_queue(s).limit(20)),
        # quality
        "dq_null_counts": _on(ALL_EVENTS, Q.null_counts),
        "dq_invalid_amounts": _raw_amounts,
        "dq_duplicates": _repeated_users,
        "dq_gate": _on(ALL_EVENTS, Q.gate_report),
        "test_not_null": _data_tests(("not_null",)),
        "test_unique": _data_tests(("unique",)),
        "test_accepted_values": _data_tests(("accepted",)),
        "test_all_models": _data_tests(("not_null", "unique", "accepted", "least")),
        "test_alert_min_score": _on(
            EVENTS, lambda t: Q.minimum_score(D.mart_alert_queue(t, RULES), RULES.alert_threshold)
        ),
        # rank metrics
        "auc_gini": _scored(lambda s: K.auc_gini(_score_counts(s))),
        "ks_statistic": _scored(lambda s: K.ks_statistic(_score_counts(s))),
        "roc_curve": _scored(lambda s: K.roc_points(_score_counts(s))),
        # messages and streams
        "decode_events_json": _props,
        "encode_events_json": _messages_roundtrip,
        "stream_source_json": _stream_source,
        "stream_scored_append": _stream_scored,
        "stream_rejects": _stream_rejects,
        "stream_scored_history": _stream_history,
        "stream_batch_summaries": _stream_summaries,
        "run_log": _run_record,
    }

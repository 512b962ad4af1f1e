"""Command line: ``spark-submit`` or ``python -m tidewatch <job>``."""

from __future__ import annotations

import argparse
from dataclasses import replace

from tidewatch.config import HIGH_RISK_COUNTRIES, Paths, StreamSettings, rules_from_env
from tidewatch.plans import pipeline
from tidewatch.plans import training as M
from tidewatch.session import build_session
from tidewatch.sources import reference_set
from tidewatch.streaming import consumer, producer


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewatch")
    p.add_argument("--master", default=None)
    jobs = p.add_subparsers(dest="job", required=True)
    ingest = jobs.add_parser("ingest", help="generate, check and store transactions")
    ingest.add_argument("--rows", type=int, default=10_000)
    ingest.add_argument("--seed", type=int, default=42)
    jobs.add_parser("detect", help="score stored transactions")
    export = jobs.add_parser("export", help="write alert queue and profiles")
    export.add_argument("--files", type=int, default=None)
    jobs.add_parser("report", help="write all reports over scored transactions")
    train = jobs.add_parser("train", help="fit and explain the classifier")
    train.add_argument("--rounds", type=int, default=M.FULL_SETTINGS.rounds)
    train.add_argument("--folds", type=int, default=M.FULL_SETTINGS.folds)
    evaluate = jobs.add_parser("evaluate", help="re-evaluate the stored model")
    evaluate.add_argument("--report", default=None)
    load = jobs.add_parser("load", help="load Parquet files into a table")
    load.add_argument("--parquet", required=True)
    load.add_argument("--database", required=True)
    load.add_argument("--table", default="transactions")
    load.add_argument("--location", default=None)
    load.add_argument("--create-database", action="store_true")
    countries = jobs.add_parser("countries", help="replace the stored high-risk country codes")
    countries.add_argument("codes", nargs="*", default=list(HIGH_RISK_COUNTRIES))
    purge = jobs.add_parser("purge", help="delete older versions of stored tables and expired records")
    purge.add_argument("--keep", type=int, default=2)
    stream = jobs.add_parser("stream", help="score messages from Kafka, or from text files")
    stream.add_argument("--folder", default=None)
    produce = jobs.add_parser("produce", help="send synthetic messages to Kafka, or to text files")
    produce.add_argument("--folder", default=None)
    return p


def run(argv: list[str] | None = None):
    args = parser().parse_args(argv)
    spark = build_session(f"tidewatch-{args.job}", args.master)
    paths, rules, settings = Paths(), rules_from_env(), StreamSettings()
    if args.job == "ingest":
        return pipeline.ingest(spark, paths, args.rows, args.seed).count()
    if args.job == "detect":
        return pipeline.detect(spark, paths, rules)
    if args.job == "export":
        return pipeline.export(spark, paths, rules, args.files)
    if args.job == "report":
        return pipeline.report(spark, paths, rules)
    if args.job == "train":
        chosen = replace(M.FULL_SETTINGS, rounds=args.rounds, folds=args.folds)
        return pipeline.train(spark, paths, rules, chosen)
    if args.job == "evaluate":
        return pipeline.evaluate(spark, paths, args.report)
    if args.job == "load":
        return pipeline.load(
            spark, args.parquet, args.database, args.table, args.location, args.create_database
        )
    if args.job == "countries":
        return reference_set.replace_codes(spark, paths.reference_set, args.codes)
    if args.job == "purge":
        return pipeline.purge(spark, paths, args.keep)
    if args.job == "produce":
        txn = producer.synthetic_stream(spark, settings)
        checkpoint = f"{settings.checkpoint}/producer"
        if args.folder:
            return producer.to_json_lines(txn, args.folder, checkpoint).awaitTermination()
        return producer.to_kafka(txn, checkpoint, settings).awaitTermination()
    raw = (
        consumer.json_lines_source(spark, args.folder)
        if args.folder
        else consumer.kafka_source(spark, settings)
    )
    scorer = consumer.BatchScorer(
        settings.output,
        rejects=f"{settings.output}_rejects",
        summaries=f"{settings.output}_summaries",
        rules=replace(rules, null_safe_countries=False),
        on_summary=lambda batch, rows, alerts: print(f"batch {batch}: {rows} rows, {alerts} alerts"),
    )
    return consumer.start(raw, scorer, settings.checkpoint, settings.trigger_interval).awaitTermination()


if __name__ == "__main__":
    result = run()
    if result is not None:
        print(result)

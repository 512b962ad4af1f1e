"""The stream scores like the batch, drops what it must and survives replays."""

import json
from dataclasses import replace

import pytest
from conftest import txn

from tidewatch.config import Rules, StreamSettings
from tidewatch.operators.quality import accepted
from tidewatch.operators.rules import score_transactions
from tidewatch.schema import RAW_COLUMNS
from tidewatch.sources.adapters import txn_events
from tidewatch.streaming import consumer, messages, producer

STRICT = replace(Rules(), null_safe_countries=False)


def line(**change):
    row = dict(zip(RAW_COLUMNS, txn(1)))
    row["timestamp"] = "2024-01-01T12:00:00.250000"
    row.update(change)
    return json.dumps({k: v for k, v in row.items() if v is not ...})


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def run(spark, folder, tmp_path, scorer=None, **source):
    scorer = scorer or consumer.BatchScorer(str(tmp_path / "out"), str(tmp_path / "rejects"))
    raw = consumer.json_lines_source(spark, str(folder), **source)
    consumer.start(raw, scorer, str(tmp_path / "checkpoint")).awaitTermination()


def test_messages_that_cannot_be_scored_are_put_aside(spark, tmp_path):
    folder = tmp_path / "in"
    write(
        folder,
        "a.json",
        [
            line(transaction_id="T1"),
            "{not json",
            line(transaction_id=...),
            line(transaction_id="T2", timestamp="soon"),
            line(transaction_id="T3", amount=None),
            line(transaction_id="T4", customer_id=None),
            line(transaction_id="T1"),
        ],
    )
    seen = []
    scorer = consumer.BatchScorer(
        str(tmp_path / "out"),
        rejects=str(tmp_path / "rejects"),
        summaries=str(tmp_path / "summaries"),
        on_summary=lambda *args: seen.append(args),
    )
    run(spark, folder, tmp_path, scorer)
    ids = sorted(r.transaction_id for r in consumer.scored_table(spark, scorer.output).collect())
    assert ids == ["T1", "T1", "T3"]  # repeats are kept, as in the batch
    rejects = sorted(r.reject_reason for r in spark.read.parquet(scorer.rejects).collect())
    assert rejects == ["no customer", "no readable id", "no readable id", "unreadable time"]
    assert seen == [(0, 3, 0)]
    assert tuple(spark.read.parquet(scorer.summaries).select("processed", "alerts").first()) == (3, 0)


def test_one_batch_equals_the_batch_result(spark, sf_dir, tmp_path):
    raw = accepted(txn_events(spark, sf_dir))
    messages.encode(raw).select("value").write.text(str(tmp_path / "in"))
    run(spark, tmp_path / "in", tmp_path)
    got = consumer.scored_table(spark, str(tmp_path / "out")).drop("batch_id")
    want = score_transactions(raw, STRICT)
    assert got.columns == want.columns
    key = lambda r: r.transaction_id
    assert [tuple(r) for r in sorted(got.collect(), key=key)] == [tuple(r) for r in sorted(want.collect(), key=key)]


def test_windows_see_one_batch_only(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "a.json", [line(transaction_id="T1"), line(transaction_id="T2")])
    write(folder, "b.json", [line(transaction_id="T3")])
    run(spark, folder, tmp_path, files_per_batch=1)
    counts = {r.batch_id: r.rolling_7d_count for r in consumer.scored_table(spark, str(tmp_path / "out")).collect()}
    assert sorted(counts.values()) == [1, 2] and set(counts) == {0, 1}


def test_remembering_scorer_goes_on_from_stored_rows(spark, frame, tmp_path):
    day = 86_400
    rows = [txn(i, k * day, 100.0 + i, f"C{i % 2}") for i, k in enumerate([0, 0, 1, 9, 9, 10, 12, 20, 20, 21])]
    scorer = consumer.BatchScorer(str(tmp_path / "out"), str(tmp_path / "rejects"), remember=True)
    for batch_id, part in enumerate((rows[:3], rows[3:4], rows[4:8], rows[8:])):
        scorer(messages.examined(messages.encode(frame(part))), batch_id)
    scorer(messages.examined(messages.encode(frame(rows[8:]))), 3)  # replayed
    got = consumer.scored_table(spark, scorer.output).drop("batch_id")
    want = score_transactions(frame(rows), STRICT)
    key = lambda r: r.transaction_id
    assert [tuple(r) for r in sorted(got.collect(), key=key)] == [tuple(r) for r in sorted(want.collect(), key=key)]
    with pytest.raises(ValueError):
        consumer.BatchScorer("a", "b", alerts_only=True, remember=True)


def test_replayed_batch_replaces_its_rows(spark, tmp_path):
    scorer = consumer.BatchScorer(str(tmp_path / "out"), str(tmp_path / "rejects"))
    raw = spark.createDataFrame([(line(transaction_id="T1"),), (line(transaction_id="T2"),)], "value string")
    for _ in range(2):
        scorer(messages.examined(raw), 5)
    assert consumer.scored_table(spark, scorer.output).count() == 2
    scorer(messages.examined(raw), 6)
    assert consumer.scored_table(spark, scorer.output).count() == 4


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "a.json", [line(transaction_id="T1")])
    run(spark, folder, tmp_path)
    write(folder, "b.json", [line(transaction_id="T2")])
    run(spark, folder, tmp_path)
    ids = sorted(r.transaction_id for r in consumer.scored_table(spark, str(tmp_path / "out")).collect())
    assert ids == ["T1", "T2"]


def test_empty_batch_writes_nothing(spark, tmp_path):
    scorer = consumer.BatchScorer(str(tmp_path / "out"), str(tmp_path / "rejects"))
    scorer(messages.examined(spark.createDataFrame([], "value string")), 0)
    assert not (tmp_path / "out").exists()


def test_alerts_only(spark, tmp_path):
    scorer = consumer.BatchScorer(
        str(tmp_path / "out"),
        str(tmp_path / "rejects"),
        alerts_only=True,
        rules=replace(STRICT, alert_threshold=20),
        summaries=str(tmp_path / "summaries"),
    )
    raw = spark.createDataFrame(
        [
            (line(transaction_id="T1", customer_id="A", originator_country="CY"),),
            (line(transaction_id="T2", customer_id="B"),),
        ],
        "value string",
    )
    scorer(messages.examined(raw), 0)
    assert [r.transaction_id for r in consumer.scored_table(spark, scorer.output).collect()] == ["T1"]
    assert tuple(spark.read.parquet(scorer.summaries).select("processed", "alerts").first()) == (2, 1)


def test_message_form(spark, frame):
    row = messages.encode(frame([txn(1, 0.25)])).first()
    assert row.key == "C1"
    sent = json.loads(row.value)
    assert tuple(sent) == RAW_COLUMNS
    assert sent["timestamp"] == "2024-01-01T12:00:00.250000"
    assert sent["is_flagged_source"] is False


def test_producer_feeds_the_consumer(spark, tmp_path):
    stream = producer.synthetic_stream(spark, StreamSettings(producer_interval=0.01))
    assert stream.isStreaming and stream.columns == list(RAW_COLUMNS)
    query = producer.to_json_lines(stream, str(tmp_path / "in"), str(tmp_path / "send"))
    try:
        for _ in range(60):
            query.awaitTermination(1)
            if (query.lastProgress or {}).get("numInputRows", 0) > 0:
                break
    finally:
        query.stop()
    run(spark, tmp_path / "in", tmp_path)
    scored = consumer.scored_table(spark, str(tmp_path / "out"))
    assert scored.count() > 0
    assert scored.where("transaction_id not like 'TXN%' or timestamp is null").count() == 0


def test_kafka_source_needs_only_the_connector(spark):
    """Without the connector on the class path Spark says so by name."""
    with pytest.raises(Exception, match="(?i)kafka"):
        consumer.kafka_source(spark)

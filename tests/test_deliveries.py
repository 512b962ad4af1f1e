"""The three deliveries of the history stream."""

import pytest
from conftest import txn
from pyspark.sql import functions as F

from tidewatch import queries as registered
from tidewatch import session
from tidewatch.streaming import consumer, messages


def test_every_row_becomes_a_message_once_and_on_all_cores(spark, sf_dir, monkeypatch):
    given, encode = [], messages.encode
    monkeypatch.setattr(messages, "encode", lambda txn: given.append(txn) or encode(txn))
    monkeypatch.setattr(registered.consumer, "start", lambda *a, **k: type("Ended", (), {"awaitTermination": lambda self: None})())
    registered._delivered(spark, sf_dir, None)
    days = [{r.d for r in txn.select(F.dayofmonth("timestamp").alias("d")).distinct().collect()} for txn in given]
    assert [all(a <= d <= b for d in own) for own, (a, b) in zip(days, registered._DELIVERIES)] == [True] * 3
    assert sum(txn.count() for txn in given) == registered.EVENTS(spark, sf_dir).count()
    assert {txn.rdd.getNumPartitions() for txn in given} == {spark.sparkContext.defaultParallelism}


def test_messages_are_dealt_without_a_sort(spark, sf_dir):
    sent = registered._sent(registered.EVENTS(spark, sf_dir))
    plan = sent._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [transaction_id" in plan


def test_only_rejected_messages_are_held(spark, frame):
    good = messages.encode(frame([txn(1)])).select("value")
    batch = messages.examined(good.union(spark.createDataFrame([("{nothing",)], "value string")))
    held = consumer.without_read_messages(batch)
    assert held.columns == batch.columns
    assert sorted((r.reject_reason or "", r.message) for r in held.collect()) == [("", None), ("no readable id", "{nothing")]


def test_a_batch_runs_on_all_cores(spark, frame, tmp_path, monkeypatch):
    seen, key = [], session._MERGED
    before = spark.conf.get(key)
    monkeypatch.setattr(consumer, "score_transactions", lambda *a: seen.append(spark.conf.get(key)) or (_ for _ in ()).throw(KeyError))
    batch = messages.examined(messages.encode(frame([txn(1)])))
    with pytest.raises(KeyError):
        consumer.BatchScorer(str(tmp_path / "out"), str(tmp_path / "rejects"))(batch, 0)
    assert seen == ["true"] and spark.conf.get(key) == before

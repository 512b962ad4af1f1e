"""A remembering scorer: right for any order of arrival, and no dearer with every batch."""

from dataclasses import replace

import pytest
from conftest import txn
from pyspark.sql import functions as F

from tidewatch.config import Rules
from tidewatch.operators.rules import score_transactions
from tidewatch.streaming import consumer, messages
from tidewatch.streaming.memory import Memory

STRICT = replace(Rules(), null_safe_countries=False)
DAY = 86_400


def make(tmp_path, **how):
    return consumer.BatchScorer(str(tmp_path / "out"), str(tmp_path / "rejects"), remember=True, **how)


def deliver(frame, scorer, batch_id, rows):
    scorer(messages.examined(messages.encode(frame(rows))), batch_id)


def stored(spark, scorer):
    return {r.transaction_id: tuple(r) for r in consumer.scored_table(spark, scorer.output).drop("batch_id").collect()}


def whole(frame, rows, rules=STRICT):
    return {r.transaction_id: tuple(r) for r in score_transactions(frame(rows), rules).collect()}


def versions(spark, scorer, batch):
    memory = scorer.memory
    version = memory._read_version(spark, batch)
    entries = memory._newest(memory._entries(spark, version))
    return version, sorted(map(tuple, entries.collect()))


def test_batches_cost_alike(spark, frame, tmp_path, monkeypatch):
    """One batch a day: what a batch reads levels off, and the result is that of one big batch."""
    rules = replace(STRICT, lookback_seconds=3 * DAY)
    monkeypatch.setattr(consumer.BatchScorer, "memory", property(lambda s: Memory(s.output + "-memory", s.output, rules.lookback_seconds, buckets=2, deltas=3)))
    scorer = make(tmp_path, rules=rules)
    rows = [txn(i, i * DAY + i, 100.0 + i, f"C{i % 3}") for i in range(18)]
    reads = []
    for batch_id, row in enumerate(rows):
        memory = scorer.memory
        version = memory.before(spark, batch_id)
        if version is not None:
            edge = int(row[9].timestamp() * 1e6) - (rules.lookback_seconds + 1) * 1_000_000
            reads.append((len(memory.paths(version, edge)), len(version.recent), len(version.deltas)))
        deliver(frame, scorer, batch_id, [row])
    assert stored(spark, scorer) == whole(frame, rows, rules)
    for place, most in enumerate((4, 6, 3)):
        assert max(r[place] for r in reads[6:12]) == max(r[place] for r in reads[12:]) <= most


def test_replay_writes_the_same_version(spark, frame, tmp_path):
    scorer = make(tmp_path)
    rows = [txn(i, i * DAY, 50.0 * (i + 1), f"C{i % 2}") for i in range(6)]
    for batch_id in range(3):
        deliver(frame, scorer, batch_id, rows[2 * batch_id : 2 * batch_id + 2])
    before, kept = versions(spark, scorer, 2), stored(spark, scorer)
    for _ in range(2):
        deliver(frame, scorer, 2, rows[4:])
    assert versions(spark, scorer, 2) == before and stored(spark, scorer) == kept
    deliver(frame, scorer, 1, rows[2:4])  # an older one, too
    deliver(frame, scorer, 2, rows[4:])
    assert versions(spark, scorer, 2) == before and stored(spark, scorer) == kept


def test_late_and_simultaneous_rows(spark, frame, tmp_path):
    """A row no later than its customer's last is scored from all that is stored, as of its own time."""
    scorer = make(tmp_path)
    first = [txn(1, 0, 10.0, "A"), txn(2, 20 * DAY, 20.0, "A"), txn(3, 0, 30.0, "B"), txn(4, 20 * DAY, 40.0, "C")]
    deliver(frame, scorer, 0, first)
    late = [txn(5, 15 * DAY, 5.0, "A"), txn(6, 21 * DAY, 6.0, "B"), txn(9, 20 * DAY, 7.0, "C"), txn(7, 20 * DAY, 8.0, "D")]
    deliver(frame, scorer, 1, late)
    deliver(frame, scorer, 2, [txn(8, 1, 9.0, "B")])  # before the listed batches reach
    got, want = stored(spark, scorer), whole(frame, first + late)
    for name in ("T00000005", "T00000006", "T00000009", "T00000007"):
        assert got[name] == want[name]
    assert got["T00000008"] == whole(frame, [*first, *late, txn(8, 1, 9.0, "B")])["T00000008"]
    assert got["T00000002"] == whole(frame, first)["T00000002"]
    deliver(frame, scorer, 3, [txn(10, 22 * DAY, 1.0, "A")])
    assert stored(spark, scorer)["T00000010"] == whole(frame, [*first, *late, txn(10, 22 * DAY, 1.0, "A")])["T00000010"]


def test_empty_batches_and_gaps(spark, frame, tmp_path):
    scorer = make(tmp_path)
    deliver(frame, scorer, 0, [])
    deliver(frame, scorer, 1, [txn(1, 0, 10.0)])
    deliver(frame, scorer, 2, [])
    scorer(messages.examined(spark.createDataFrame([("{",)], "value string")), 3)
    deliver(frame, scorer, 6, [txn(2, 60, None), txn(3, 90, 5.0)])
    rows = [txn(1, 0, 10.0), txn(2, 60, None), txn(3, 90, 5.0)]
    assert stored(spark, scorer) == whole(frame, rows)


def test_memory_is_rebuilt_from_stored_rows(spark, frame, tmp_path):
    plain = consumer.BatchScorer(str(tmp_path / "out"), str(tmp_path / "rejects"))
    rows = [txn(i, i * DAY, 10.0 + i, f"C{i % 2}") for i in range(5)]
    deliver(frame, plain, 0, rows[:2])
    deliver(frame, plain, 1, rows[2:4])
    scorer = make(tmp_path)
    deliver(frame, scorer, 2, rows[4:])
    assert stored(spark, scorer)["T00000004"] == whole(frame, rows)["T00000004"]


@pytest.mark.parametrize("alerts_only", [False, True])
def test_counts_come_with_the_write(spark, frame, tmp_path, alerts_only):
    """Nothing reads the output again."""
    seen = []
    rules = replace(STRICT, alert_threshold=20)
    scorer = consumer.BatchScorer(
        str(tmp_path / "out"), str(tmp_path / "rejects"), rules=rules, alerts_only=alerts_only,
        on_summary=lambda *args: seen.append(args), summaries=str(tmp_path / "s"),
    )
    rows = [txn(i, i, 10.0, f"C{i}", origin="CY" if i % 4 == 0 else "DE") for i in range(40)]

    batch = messages.examined(messages.encode(frame(rows)))
    scorer(batch, 0)
    assert seen == [(0, 40, 10)]
    assert consumer.scored_table(spark, scorer.output).count() == (10 if alerts_only else 40)
    assert tuple(spark.read.parquet(scorer.summaries).select("processed", "alerts").first()) == (40, 10)


def test_every_total_is_counted_once(spark, frame, tmp_path):
    scorer = make(tmp_path)
    rows = [txn(i, i * DAY, 1.5 * i + 1, f"C{i % 4}") for i in range(12)]
    for batch_id in range(4):
        deliver(frame, scorer, batch_id, rows[3 * batch_id : 3 * batch_id + 3])
    _, entries = versions(spark, scorer, 3)
    want = {}
    for row in rows:
        units, n = want.get(row[1], (0, 0))
        want[row[1]] = (units + round(row[4] * 1e6), n + 1)
    assert {e[0]: (e[1], e[3]) for e in entries} == want
    assert frame(rows).select(F.count_distinct("customer_id")).first()[0] == len(entries)

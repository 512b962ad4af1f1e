import re
from collections import Counter

from tidewatch.llm.quality_rules import MEASURES, THRESHOLDS, Threshold, compiled, judge


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + i for k in range(len(words) - 7) if runs[tuple(words[k : k + 8])] > 1 for i in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def check(rows):
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measured(r.text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_against_brute_force(docs):
    rows = judge(docs).collect()
    assert len(rows) == docs.count()
    check(rows)


def test_repeats_and_lines(spark):
    run = " ".join(f"w{k}" for k in range(11))
    texts = [
        f"{run} {run}",
        f"{run} x {run}\n{run}",
        "a " * 9,
        "a " * 8,
        "a a a a a a a a b " * 3,
        "l1\nl1\n \n \nl1\r\nl1\n\n",
        "x\ny\nx ",
    ]
    check(judge(spark.createDataFrame([(t,) for t in texts], "text string")).collect())


def test_verdicts(spark, docs):
    good = "The river is wide and the garden is full of stones that were brought in winter by a man with a cart. "
    lines = good + "\nIt rains in the morning and the window is open to the sea."
    bad = " | ".join(["nav"] + [f"Item{k}" for k in range(40)])
    frame = spark.createDataFrame([(1, lines, "old"), (2, bad, "old")], "doc_id long, text string, kept string")
    assert {r.doc_id: r.kept for r in judge(frame).collect()} == {1: True, 2: False}
    assert judge(docs).where("kept is null or base_failed is null").count() == 0


def test_thresholds_compile_to_one_condition(spark):
    one = spark.createDataFrame([(1, 0), (5, 2)], "a int, b int")
    table = (Threshold("ratio", "a / b", 2.0, 3.0),)
    assert [r[0] for r in one.select(compiled(table)).collect()] == [True, True]
    assert len({t.name for t in THRESHOLDS}) == len(THRESHOLDS)


def test_empty_and_plan(no_docs, docs):
    assert judge(no_docs).count() == 0
    plan = judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan.split("InMemoryRelation")[0]
    assert set(MEASURES) < set(judge(docs).columns)

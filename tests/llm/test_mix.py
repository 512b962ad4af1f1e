import re
from collections import Counter, defaultdict

import duckdb
import pytest

from tidewatch.llm.mix import OP1_SQL, mix, mix_copies, op1_mix


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(sizes, weights=(1, 2, 3), limit=3):
    """Water filling by rounds, as the rule is worded."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, pool = {}, set(names), sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: pool * weight[s] / total for s in open_}
        over = {s for s in open_ if share[s] > limit * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = limit * sizes[s]
            pool -= target[s]
        open_ -= over
    return target


def test_targets_and_bounds(docs):
    rows = mix_copies(docs).collect()
    assert len(rows) == docs.count()
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += size(r.text)
    expected = filled(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r["size"] == size(r.text) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r["size"]
    largest = max(r["size"] for r in rows)
    for source, words in taken.items():
        assert abs(words - expected[source]) <= largest


def test_sources_that_fill_up(spark):
    rows = [(k, "w " * 10, s, None) for k, s in enumerate(["a"] * 2 + ["b"] * 100 + ["c"] * 1 + ["d"] * 40)]
    got = mix_copies(spark.createDataFrame(rows, "doc_id long, text string, source string, target string"))
    expected = filled({"a": 20, "b": 1000, "c": 10, "d": 400})
    found = {r.source: r.target for r in got.collect()}
    assert found == pytest.approx(expected)
    assert found["a"] == 60 and found["c"] == 30


def test_mix_repeats_rows_and_keeps_columns(docs):
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    copies = Counter()
    for r in mix_copies(docs).collect():
        copies[r.doc_id, r.text, r.source] += r.copies
    assert Counter((r.doc_id, r.text, r.source) for r in mixed.collect()) == +copies
    assert {r["size"] for r in mixed.collect()} <= {"x", None}


def test_reruns_agree_on_another_layout(docs):
    key = lambda df: sorted(map(str, mix_copies(df).select("doc_id", "size", "copies").collect()))
    assert key(docs) == key(docs.repartition(7).orderBy("text"))


def test_empty(no_docs):
    assert mix_copies(no_docs).count() == 0 and mix(no_docs).count() == 0


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    query = f"select doc_id, size, source_size, target, taken, copies from ({OP1_SQL})"
    rows = op1_mix(spark, sf_dir).select("doc_id", "size", "source_size", "target", "taken", "copies").collect()
    assert sorted(map(tuple, rows)) == sorted(con.sql(query).fetchall())

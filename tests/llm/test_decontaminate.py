import random
import re

import pyarrow as pa
import pytest

from tidewatch.llm import decontaminate as D
from tidewatch.llm.words import text_bytes
from tidewatch.llm.wu_manber import Searcher, split_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, window string"
AWKWARD = [None, "", " .,;\x00", "Ä" * 3, "İ K ſ é 日本語 a-B_c", "\x80x y", "A" * 9000]


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(docs, items, size=10):
    """Every window against every place of every text."""
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(len(w) - size, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, named = words(text), set(), set()
        for window, owners in windows.items():
            m = len(window)
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) == window:
                    hit |= set(range(k, k + m))
                    named |= owners
        out.append((doc, len(w), sorted(hit), sorted(str(x) for x in named if x is not None)))
    return sorted(out, key=repr)


def found(spark, docs, items, **how):
    left = spark.createDataFrame(docs, "doc_id long, text string")
    left = left.selectExpr("*", "'x' AS digest", "1 AS items", "2 AS n_words", "text AS more_items").repartition(3)
    right = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    rows = D.find_items(left, right, **how).collect()
    return sorted(
        ((r.doc_id, r.n_words, [k for a, b in r.spans for k in range(a, b)], list(r.items)) for r in rows), key=repr
    )


def sample(seed, size):
    """Few words, so that windows overlap, share ends and occur often."""
    rng = random.Random(seed)
    some = lambda n: " ".join(rng.choice(["a", "b", "C", "ä", "x1"][: rng.randint(1, 5)]) for _ in range(n))
    items = [(k, some(rng.randint(0, 2 * size + 2))) for k in range(25)] + [(3, some(size + 1)), (None, some(size))]
    items += [(40 + k, t) for k, t in enumerate(AWKWARD)] + [(60, items[5][1]), items[6]]
    docs = [(k, some(rng.randint(0, 60))) for k in range(60)]
    docs += [(100 + k, "q, " + (items[k][1] or "").upper().replace(" ", "! ") + "\n.zz") for k in range(25)]
    docs += [(200 + k, t) for k, t in enumerate(AWKWARD)] + [(None, items[7][1]), docs[0], docs[0], (300, some(3000))]
    return docs, items


@pytest.mark.parametrize("size", [1, 2, 3, 10])
def test_equals_brute_force(spark, size):
    docs, items = sample(size, size)
    assert found(spark, docs, items, size=size) == brute(docs, items, size)


def test_several_sets_of_tables(spark):
    docs, items = sample(9, 4)
    assert found(spark, docs, items, size=4, most=15) == brute(docs, items, 4)


def test_empty_tables(spark):
    docs, items = sample(2, 10)
    assert found(spark, docs, []) == brute(docs, [])
    assert found(spark, [], items) == []
    assert found(spark, docs, [(1, None), (2, " ?")]) == brute(docs, [])


def test_spans_end_with_their_text(spark):
    rows = found(spark, [(1, "a b"), (2, "a b c a b"), (3, "b a")], [(7, "a b")])
    assert rows == [(1, 2, [0, 1], ["7"]), (2, 5, [0, 1, 3, 4], ["7"]), (3, 2, [], [])]


def test_words_and_long_text():
    texts = [*AWKWARD, "one Two\x7fthree", "9:a"]
    content, bounds = text_bytes(pa.array(texts, pa.string()))
    got, starts = split_words(content, bounds)
    got = [w.decode() for w in got.to_pylist()]
    assert [got[a:b] for a, b in zip(starts[:-1], starts[1:])] == [words(t) for t in texts]
    rng = random.Random(4)
    body = [f"w{rng.randrange(5000)}" for _ in range(200_000)]
    windows = [" ".join(body[k : k + 10]) for k in range(0, 190_000, 1000)]
    content, bounds = text_bytes(pa.array([" ".join(body)]))
    _, inside, rows, owners = Searcher(windows, range(len(windows))).search(content, bounds)
    assert set(owners) == set(range(len(windows))) and not rows.any()
    assert inside.sum() == 10 * len(windows)


def test_query_on_the_given_tables(spark, sf_dir):
    rows = D.op11_decontaminate(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(len(w) - 10, 0) + 1):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    want = {}
    for doc, text in docs:
        w, hit, named = words(text), set(), set()
        for m in lengths:
            for k in range(len(w) - m + 1):
                if (owners := windows.get(tuple(w[k : k + m]))) is not None:
                    hit |= set(range(k, k + m))
                    named |= owners
        want[doc] = (len(w), len(hit), len(named))
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in rows} == want
    assert any(r.contaminated for r in rows) and len(rows) == len(docs)

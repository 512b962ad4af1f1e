import random

import numpy as np

from tidewatch.llm import language_id as li
from tidewatch.llm.words import text_bytes

LETTERS = {"aa": "abcdefghij", "bb": "klmnopqrst", "cc": "äöüßéèçñóí"}


def text(lang, seed, size):
    rng = random.Random(seed)
    return "".join(rng.choice(LETTERS[lang]) if rng.random() < 0.8 else " " for _ in range(size)).strip() + LETTERS[lang][0]


def table(spark, n=240):
    rows = [(k, text(lang := "abc"[k % 3] * 2, k, 20 + 7 * (k % 150)), lang, None) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(4)


def test_held_out_accuracy(spark):
    rows = li.identify(table(spark), li.Training(steps=200)).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 240 and 50 < len(held) < 110
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_rows(spark, docs, no_docs):
    network = li.fit(table(spark), li.Training(steps=60))
    got = li.predict(docs, network)
    rows = got.collect()
    assert len(rows) == docs.count() and got.columns == [*docs.columns, "lang_pred", "score"]
    for r in rows:
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == li.UNKNOWN) == (not letter)
        assert letter or r.score == 0
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 1}) == 1
    assert li.predict(no_docs, network).count() == 0
    assert li.identify(no_docs).count() == 0
    assert {r.lang_pred for r in li.predict(docs, None).collect()} == {li.UNKNOWN}


def test_every_window_counts(spark):
    network = li.fit(table(spark), li.Training(steps=200))
    mixed = text("aa", 1, 600) + text("bb", 2, 3000)
    row = li.predict(spark.createDataFrame([(mixed,)], "text string"), network).first()
    assert row.lang_pred == "bb" and 0.6 < row.score < 0.95


def test_network_against_plain_loops():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 256, (3, li.WINDOW), dtype=np.uint8)
    windows[1, 40:] = 0
    net = li.train(windows, np.array([0, 1, 0]), ["x", "y"], li.Training(steps=3, batch=4, filters=2))
    for window, got in zip(windows, net.probabilities(windows)):
        vectors = net.embedding[window]
        pooled = []
        for k in range(net.filters.shape[1]):
            width = li.WIDTHS[k // 2]
            weights = net.filters[:, k].reshape(max(li.WIDTHS), -1)
            assert not weights[width:].any()
            places = range(li.WINDOW - max(li.WIDTHS) + 1)
            pooled.append(max(0.0, max((vectors[p : p + width] * weights[:width]).sum() for p in places) + net.bias[k]))
        scores = np.exp(np.array(pooled) @ net.weights + net.offset)
        assert np.allclose(got, scores / scores.sum(), atol=1e-4)


def test_cut():
    import pyarrow as pa

    content, bounds = text_bytes(pa.array(["a" * 300, None, "", "b", "c" * 256]))
    windows, begin = li.cut(content, bounds)
    assert begin.tolist() == [0, 2, 2, 2, 3, 4]
    assert bytes(windows[1]).rstrip(b"\0") == b"a" * 44 and bytes(windows[3]) == b"c" * 256

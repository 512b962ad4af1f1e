import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import lm_scoring as lm


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def remainder(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7


def close(step):
    """An estimate as the held-out cells keep it."""
    return 0.0 if step == 0 else 2.0 ** (-(step - 1) / lm.STEPS)


def brute(rows):
    """Both scores of every row, from plain counters."""
    texts = [(r.doc_id, tokens(r.text)) for r in rows]
    pairs = lambda t: list(zip(["<"] + t[:-1], t))

    def counts(keep):
        words, two = Counter(), Counter()
        for i, t in texts:
            if keep(remainder(i)):
                words.update(t + ["<"])
                two.update(pairs(t))
        return words, two, sum(n for w, n in words.items() if w != "<"), len(words) - ("<" in words)

    octave = lambda x: 0 if x == 0 else 1 + int(np.round(-np.log2(x) * lm.STEPS))
    words, two, total, types = counts(lambda k: k not in (2, 6))
    cells = Counter()
    for i, t in texts:
        if remainder(i) == 6:
            for a, b in pairs(t):
                cells[
                    int(math.floor(math.log2(words[a] + 0.5))) + 1,
                    octave(two[a, b] / max(words[a], 1)),
                    octave(words[b] / max(total, 1)),
                ] += 1
    of_word, of_pair = lm.learn_weights(sorted((*k, n) for k, n in cells.items()), types)
    words, two, total, types = counts(lambda k: k != 2)
    for i, t in texts:
        base = score = 0.0
        for a, b in pairs(t):
            base += math.log10((words[b] + 1) / (total + types + 1))
            mixed = of_word * words[b] / max(total, 1) + (1 - of_word) / (types + 1)
            k = min(int(math.floor(math.log2(words[a] + 0.5))) + 1, len(of_pair) - 1)
            weight = of_pair[k] if words[a] else 0.0
            score += math.log10(weight * two[a, b] / max(words[a], 1) + (1 - weight) * mixed)
        yield (i, remainder(i) == 2, len(t), sum(words[b] > 0 for b in t), total), base, score


def test_against_brute_force(docs):
    got = sorted(lm.score_documents(docs).collect(), key=lambda r: (str(r[:5]), r.score))
    want = sorted(brute(docs.collect()), key=lambda r: (str(r[0]), r[2]))
    assert [tuple(r[:5]) for r in got] == [r[0] for r in want]
    assert [r.base_score for r in got] == pytest.approx([r[1] for r in want])
    assert [r.score for r in got] == pytest.approx([r[2] for r in want])


def test_small_blocks_and_shards_change_nothing(docs, monkeypatch):
    key = lambda df: sorted((str(r[:5]), round(r.base_score, 6), round(r.score, 6)) for r in df.collect())
    want = key(lm.score_documents(docs))
    monkeypatch.setattr(lm, "SHARD_TOKENS", 500)
    assert key(lm.score_documents(docs.repartition(5))) == want


def test_model_is_a_distribution():
    """Over all known words and one unknown, the mixture adds up to one."""
    of_word, weights = lm.learn_weights([(1, 17, 33, 5), (1, 0, 49, 7), (4, 1, 60, 3)], 10)
    assert 0 < of_word < 1 and (weights >= 0).all() and (weights < 1).all()
    counts = np.array([5, 3, 1, 1, 0])  # the last is the unknown word
    mixed = of_word * counts / counts.sum() + (1 - of_word) / 5
    assert mixed.sum() == pytest.approx(1)


def test_weights_follow_the_held_out_counts():
    """The weight that makes the held-out cells likeliest, found by search."""
    cells = [(1, 17, 65, 40), (1, 0, 33, 60)]
    of_word, weights = lm.learn_weights(cells, 1000, rounds=500)
    high, low = 2.0 ** (-16 / lm.STEPS), [2.0 ** (-(s - 1) / lm.STEPS) for s in (65, 33)]
    low = [of_word * x + (1 - of_word) / 1001 for x in low]
    likely = lambda w: 40 * math.log(w * high + (1 - w) * low[0]) + 60 * math.log((1 - w) * low[1])
    assert weights[1] == pytest.approx(max(np.linspace(0.001, 0.999, 999), key=likely), abs=2e-3)


def test_packing():
    values = np.array([0, 5, 1 << 40, 3], np.int64)
    assert (lm.unpack(lm.pack(values)) == values).all()
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 50, dtype=np.uint64) * np.uint64(2))
    assert (lm.unpack_sorted(lm.pack_sorted(keys)) == keys).all()


def test_empty_and_untrained(spark, no_docs):
    assert lm.score_documents(no_docs).count() == 0
    held = next(k for k in range(1000) if remainder(k) == 2)
    rows = lm.score_documents(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows] == [(True, 3, 0, 0, 0.0)]

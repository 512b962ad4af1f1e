import math
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from llm_samples import prose
from tidewatch.llm import quality_model as qm
from tidewatch.llm import words as words_module


def corpus(spark, n=60):
    rows = [(k, prose(k, 30 + k), "en" if k % 3 else "de", "x") for k in range(n)]
    labels = [(k, 1, 0) for k in range(n)] + [(0, 1, 0), (3, 0, 1), (None, 1, 0)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string").repartition(3),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def kneser_ney(texts):
    """Interpolated modified Kneser-Ney of order three with plain dictionaries."""
    split = [t.split() + ["</s>"] for t in texts]
    seen = Counter(w for t in split for w in t)
    vocabulary = {w for w, c in seen.items() if c > 1 or w == "</s>"}
    three = Counter()
    for t in split:
        t = ["<s>", "<s>"] + [w if w in vocabulary else "?" for w in t]
        three.update(zip(t, t[1:], t[2:]))
    two = Counter()
    for (_, v, w), c in three.items():
        two[v, w] += c if v == "<s>" else 1
    one = Counter(w for _, w in two)

    def level(counts, lower):
        n = [0] + [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        d = [0.5, 1.0, 1.5]
        if n[1] and n[2]:
            y = n[1] / (n[1] + 2 * n[2])
            d = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2 for k in (1, 2, 3)]
            d = [min(max(x, 0.05), top) for x, top in zip(d, (0.95, 1.95, 2.95))]
        total, left = Counter(), defaultdict(float)
        for gram, c in counts.items():
            total[gram[:-1]] += c
            left[gram[:-1]] += d[min(c, 3) - 1]

        def p(gram):
            h = gram[:-1]
            if h not in total:
                return lower(gram[1:])
            c = counts.get(gram, 0)
            return max(c - (d[min(c, 3) - 1] if c else 0), 0) / total[h] + left[h] / total[h] * lower(gram[1:])

        return p

    p1 = level({(w,): c for w, c in one.items()}, lambda _: 1 / len(one))
    p3 = level(dict(three), level(dict(two), p1))
    return vocabulary, max(1, len(seen) - len(vocabulary)), p3


def test_against_dictionaries(spark):
    texts = [prose(k, 40) for k in range(25)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scorer = qm.Scorer(qm.fit(frame))
    vocabulary, rare, p3 = kneser_ney(texts)
    for text in [prose(k, 25) for k in (3, 500, 501)] + ["of", "zzz of", ""]:
        words = text.split() + ["</s>"]
        line = ["<s>", "<s>"] + [w if w in vocabulary else "?" for w in words]
        want = [
            math.log10(p3(g)) - (math.log10(rare) if w not in vocabulary else 0)
            for g, w in zip(zip(line, line[1:], line[2:]), words)
        ]
        got = scorer.log_probabilities(*qm._tokens(pa.array([text])))
        assert got == pytest.approx(want, rel=1e-4)


def test_probabilities_add_up(spark):
    texts = [prose(k, 40) for k in range(25)]
    scorer = qm.Scorer(qm.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    vocabulary, rare, p3 = kneser_ney(texts)
    for history in (("<s>", "<s>"), ("<s>", "the"), ("the", "of"), ("zzz", "of")):
        assert sum(p3((*history, w)) for w in vocabulary | {"?"}) == pytest.approx(1)
    assert np.isfinite(scorer.model.gamma).all()


def test_rejects_other_text_and_keeps_clean(spark):
    docs, labels = corpus(spark)
    noise = [(1000 + k, " | ".join(f"Zq{k}x{i}" for i in range(40)), "en", "x") for k in range(10)]
    clean = [(2000 + k, prose(5000 + k, 80), lang, None) for k, lang in enumerate(["en", "de", "xx", None] * 5)]
    both = docs.union(spark.createDataFrame(noise + clean, docs.schema))
    rows = qm.classify(both, labels).collect()
    assert len(rows) == 90
    for r in rows:
        assert r.kept == (not 1000 <= r.doc_id < 2000), r.doc_id


def test_awkward_rows(docs, no_docs, spark):
    _, labels = corpus(spark, 20)
    got = qm.classify(docs, labels)
    rows = got.collect()
    assert len(rows) == docs.count() and got.columns == [*docs.columns, "n_tokens", "log_perplexity", "limit", "kept"]
    for r in rows:
        words = len([w for w in (r.text or "").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w.strip(" \t\n\r")])
        assert (r.log_perplexity is None) == (words == 0)
        assert words or r.kept is False
    assert len({str(r) for r in rows if r.doc_id == 1}) == 1
    assert qm.classify(no_docs, labels).count() == 0
    nothing = qm.classify(docs, labels.where("false")).collect()
    assert all(r.kept == (r.n_tokens > 1) and r.log_perplexity is None for r in nothing)


def test_every_trusted_document_trains_and_scores_by_exchange(spark, monkeypatch):
    monkeypatch.setattr(qm, "BLOCK_TOKENS", 4000)
    monkeypatch.setattr(qm, "SHARD_GRAMS", 3000)
    monkeypatch.setattr(qm, "PART_BYTES", 100_000)
    texts = [f"{prose(k, 20)} own{k} own{k}" for k in range(2300)] + [f"{prose(9, 5400)} lengthy lengthy"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    scorer = qm.Scorer(qm.fit(frame))
    assert len(scorer.model.words) == len(kneser_ney(texts)[0] | {"?"})  # those of each document, and of the long one
    asked = [(k, prose(7000 + k, 30)) for k in range(40)] + [(90, None), (91, " "), (None, "zz of"), (None, "zz of")]
    asked = spark.createDataFrame(asked, "doc_id long, text string").union(frame.where("doc_id > 2200"))
    got = asked.select("*", *qm._names()).join(qm.perplexities(asked, frame), ["_first", "_second"]).collect()
    assert len(got) == asked.count()
    for r in got:
        tokens, stops = qm._tokens(pa.array([r.text], pa.string()))
        assert r.n_tokens == len(tokens)
        if r.n_tokens == 1:
            assert r.log_perplexity is None
        else:
            assert r.log_perplexity == pytest.approx(-scorer.log_probabilities(tokens, stops).mean(), rel=1e-5)


def test_words_are_counted_in_slices_of_a_batch(monkeypatch):
    """A batch of long texts: no array of the size of all its bytes, as of 2**25 powers for 20 MB."""
    words_module._powers.cache_clear()
    monkeypatch.setattr(qm.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    texts = pa.array([f"{prose(k % 7, 3000)} own{k}" for k in range(600)])
    numbers = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([numbers, numbers, texts], ["a", "b", "text"])
    assert len(qm.text_bytes(texts)[0]) > 4 * words_module.SLICE_BYTES
    tracemalloc.start()
    found = Counter()
    for out in qm._count_words(qm._blocks(iter([batch]))):
        for w, c in zip(out.column("w").to_pylist(), out.column("c").to_pylist()):
            found[w] += c
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    words, counts = np.unique(qm._tokens(texts)[0].view(np.int64), return_counts=True)
    assert found == dict(zip(words.tolist(), counts.tolist()))
    assert peak < 150 << 20


def test_grams_ask_for_every_context(monkeypatch):
    """Pairs and one pair of begin marks hold all contexts; each token finds its own among them."""
    monkeypatch.setattr(qm.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    texts = ["a b a b a", "", "b", None, "a b a c"]
    numbers = pa.array(range(len(texts)), pa.int64())
    (block,) = qm._blocks(iter([pa.RecordBatch.from_arrays([numbers, numbers, pa.array(texts)], ["a", "b", "text"])]))
    (row,) = block.to_pylist()
    tokens, stops = qm._tokens(pa.array(texts))
    one, two = qm._histories(tokens, stops)
    pair, triple = qm._grams(row)
    assert pair[:-1].tolist() == qm._pair(one, tokens).tolist()
    contexts = qm._pair(two, one)
    heads = np.concatenate([[0], stops[:-1]])
    assert pair[qm._before(heads, len(tokens))].tolist() == contexts.tolist()
    assert triple.tolist() == qm._triple(contexts, pair[:-1]).tolist()
    asked = {b.column("kind")[0].as_py(): np.concatenate([qm.unpack_sorted(k) for k in b.column("keys").to_pylist()])
             for b in qm._ask_grams(3, iter([block]))}
    assert asked[qm.PAIRS].tolist() == sorted(set(pair.tolist())) and asked[qm.TRIPLES].tolist() == sorted(set(triple.tolist()))


def test_model_is_not_moved_for_each_part_and_leaves_no_table(spark):
    texts = spark.createDataFrame([(k, prose(k, 40)) for k in range(25)], "doc_id long, text string")
    made = qm._tables(texts, 2, 4)
    asked, blocks = spark.createDataFrame([], qm.ASKED), spark.createDataFrame([], qm.CLASSED)
    met = qm._exchanged(blocks, asked, made.grams, 4).applyInArrow(lambda left, right: right, qm.ANSWER)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange ") == 3  # what is asked, the answers, the blocks
    made.drop()
    assert qm.perplexities(texts, texts).count() == 25
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("kn_grams")]

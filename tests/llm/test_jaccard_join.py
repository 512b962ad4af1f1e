import random
import re
from itertools import combinations

import numpy as np
import pytest

from llm_samples import prose
from tidewatch.llm import jaccard_join as jj
from tidewatch.llm.components import components
from tidewatch.llm.set_signatures import PROBE, SKETCH, Threshold, allocated, bands, parity, scheme, signatures
from tidewatch.llm.words import splitmix


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def brute(rows, size, percent):
    sets = [shingles(r.text, size) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            parent[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k].doc_id)
    smallest = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[k].doc_id, len(sets[k]), smallest[find(k)]) for k in range(len(rows))), key=str), len(groups)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def families(spark, seed=1, many=60):
    """Families of copies that lie around the threshold, sharing a passage; one is large."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(30)]
    rows = []
    for family in range(12):
        size = rng.choice([3, 6, 12, 40, 90, 200])
        base = [f"f{family}w{rng.randrange(10**6)}" for _ in range(size)] + passage * (family % 2)
        for _ in range(many if family == 0 else 8):
            rows.append(edited(rng, base, rng.randrange(0, 2 + len(base) // 25)))
    return spark.createDataFrame([(10 + k, t, "a", 1) for k, t in enumerate(rows)], "doc_id long, text string, a string, sig int")


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80)])
def test_against_brute_force(spark, docs, size, percent):
    for frame in (families(spark), docs.select("doc_id", "text")):
        got = jj.join_documents(frame.repartition(4), size, Threshold(percent)).collect()
        assert sorted(map(tuple, got), key=str) == brute(frame.collect(), size, percent)[0]


def test_large_buckets_go_by_pivots(spark, monkeypatch):
    monkeypatch.setattr(jj, "SMALL_BUCKET", 2)
    frame = families(spark, 5, 40)
    import tidewatch.llm.common as common

    common._SHIPPED.clear()
    made = jj.JaccardJoin(frame, 4, Threshold())
    original = made.candidates

    def all_large():
        found = original()
        pairs = found.where("b is not null")
        one = pairs.selectExpr("a", "cast(null as long) as b", "xxhash64(a) % 3 as sig", "true as probe")
        two = pairs.selectExpr("b as a", "cast(null as long) as b", "xxhash64(a) % 3 as sig", "false as probe")
        return one.union(two).union(found.where("sig is not null")).distinct()

    made.candidates = all_large
    labels = {r.node: r.component for r in made.labels().collect()}
    sets = {r.doc_id: r.set_id for r in made.described.collect()}
    want = {i: c for i, _, c in brute(frame.collect(), 4, 85)[0]}
    for a, b in combinations(sets, 2):
        same = labels.get(sets[a], sets[a]) == labels.get(sets[b], sets[b])
        assert same == (want[a] == want[b])


def test_keep_first(spark, docs, no_docs):
    for frame in (families(spark, 3), docs):
        kept = jj.keep_first(frame)
        rows = kept.collect()
        assert kept.columns == frame.columns
        worded = [r for r in frame.collect() if shingles(r.text, 5)]
        groups = brute(worded, 5, 80)[1]
        assert len(rows) == groups + frame.count() - len(worded)
    assert jj.keep_first(no_docs).count() == 0 and jj.join_documents(no_docs).count() == 0


def test_pigeonhole():
    """Any two sets within the bound share a signature that one of them probes."""
    rng = np.random.default_rng(3)
    threshold = Threshold()
    sketch = rng.integers(0, 50, SKETCH)
    for size in (1, 2, 3, 5, 7, 12, 33, 100, 400):
        for _ in range(60):
            a = rng.integers(0, 1 << 62, size, dtype=np.uint64)
            lost = rng.integers(0, size // 8 + 1)
            new = rng.integers(0, 1 << 62, rng.integers(0, size // 8 + 2), dtype=np.uint64)
            b = np.unique(np.concatenate([a[lost:], new]))
            a = np.unique(a)
            common = len(np.intersect1d(a, b))
            if not threshold.links(common, len(a) + len(b)):
                continue
            row, sig, kind = signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), sketch, threshold)
            probes = lambda k: set(sig[(row == k) & (kind >= PROBE)])
            rows = lambda k: set(sig[row == k])
            assert probes(0) & rows(1) and probes(1) & rows(0)


@pytest.mark.parametrize("percent", [80, 85])
def test_empty_segments_are_spared(percent):
    """Sets without a common element hardly meet, though many have segments of at most one element."""
    rng = np.random.default_rng(7)
    for size in (32, 100, 250, 400):
        sets = [np.unique(rng.integers(0, 1 << 62, size + k % 9, dtype=np.uint64)) for k in range(600)]
        starts = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        row, sig, kind = signatures(np.concatenate(sets), starts, np.ones(SKETCH, np.int64), Threshold(percent))
        _, bucket = np.unique(sig, return_inverse=True)
        met = np.bincount(bucket)[bucket] * (kind >= PROBE)
        assert met[met > 1].sum() < 200  # at 100 elements and more, 855 to 34 783 where they are not spared


def test_pigeonhole_sum_of_each_set():
    """What is left of v(i) + 1 is what the set's own size needs, whatever its segments hold."""
    rng = np.random.default_rng(8)
    begin = np.array([0, 5, 5, 12, 40])
    deletions, spare = np.array([1, 0, 2, 3]), np.array([2, 0, 9, 6])
    filled = rng.integers(0, 4, 40)
    v = allocated(begin, deletions, spare, rng.integers(0, 9, 40), rng.integers(9, 20, 40), filled)
    units = np.add.reduceat(np.append(v + 1, 0), begin[[0, 2, 3]])
    assert units.tolist() == [5 + 1 - 2, 7 + 2 - 9, 28 + 3 - 6]
    assert v.min() == -1 and (v[12 + 3 :] < 1).all() and (v[5:12] == -1).all()
    last = v[12:][filled[12:] == 0]
    assert (last == -1).sum() >= min(len(last), 6 // 2)


def test_schemes_and_bands():
    threshold = Threshold()
    first = bands(threshold, 5000)
    for a, b in zip(first, first[2:]):
        assert not threshold.links(np.array(b - 1), np.array(2 * b - 1)) or threshold.largest(b - 1) >= b
        assert threshold.largest(int(a)) < b
    for size in range(1, 3000):
        plan = scheme(threshold, size)
        need = threshold.apart(size + threshold.largest(size)) + 1
        assert plan.segments + plan.deletions - plan.skips >= need
        assert plan.skips <= plan.segments - plan.deletions


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 62, 300, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.integers(0, 60) :], rng.integers(0, 1 << 62, 20, dtype=np.uint64)]))
        bits = parity(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert np.unpackbits(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b))


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1200)]
    links += [(5, 5), (7, 8), (7, 8)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(9)
    got = {r.node: r.component for r in components(frame).collect()}
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent}
    assert components(frame.where("false")).count() == 0


def test_prose_copies(spark):
    rows = [(k, prose(k % 4, 50)) for k in range(40)]
    got = jj.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0, 1, 2, 3}


def test_hash_mix_is_a_bijection():
    values = np.arange(1 << 16, dtype=np.uint64)
    assert len(np.unique(splitmix(values))) == len(values)


def test_documents_without_ids_meet_by_their_sets(spark):
    """Each such document is made again once, not once for every other one."""
    rows = [(None, prose(k % 40, 60), "x") for k in range(120)] + [(k, prose(k, 60) + " more", "x") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, set_id string").repartition(3)
    job = jj.JaccardJoin(docs, 4, jj.Threshold(percent=85))
    ids = sorted({r.set_id for r in job.described.where("doc_id is null").collect()})
    pairs = spark.createDataFrame([(a, b) for a, b in zip(ids, ids[1:])], "a long, b long")
    assert job.made(pairs, jj.histogram, "test-made").count() == len(ids) == 40
    out = jj.join_documents(docs)
    assert out.count() == 160

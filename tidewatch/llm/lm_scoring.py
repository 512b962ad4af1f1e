"""Scoring texts with a bigram model mixed by deleted interpolation (operator 7).

Words are counted over the whole corpus by an exchange of counts: documents are
packed into blocks of some million tokens; each block sends its distinct
n-grams with local counts to shards by ranges of the n-gram's hash; each shard
adds up and answers every block with the corpus counts, in the order asked. So
an n-gram goes through the shuffle once for each block that has it, however
frequent it is, and no table of counts is ever in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import fold, map_arrow, ship, stored, table, width
from tidewatch.llm.words import U64, slices, splitmix, text_bytes, word_hashes

BEGIN, END = splitmix(np.array([1, 2], U64))
#: What a block's documents do: give counts, give the held-out counts that the
#: mixture weights are fitted to (and counts once those are known), or neither.
COUNTED, TUNING, UNSEEN = 0, 1, 2
BLOCK_TOKENS = 2_000_000
SHARD_TOKENS = 1_500_000
#: Held-out counts are kept by eighths of an octave of each estimate, so that their
#: table is bounded: buckets times steps of two estimates.
STEPS = 8

BLOCK = "block long, role int, doc_id array<long>, sizes binary, tokens binary, words binary"
REQUEST = "order int, shard long, block long, role int, keys binary, counts binary"
ANSWER = "order int, shard long, block long, counts binary, first binary"


def pack(values: np.ndarray) -> bytes:
    """Numbers as bytes, all lowest bytes first, so that small numbers compress."""
    values = np.ascontiguousarray(values)
    # copied before tobytes, which takes ten times as long over a transposed array
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def unpack(data: bytes, kind=np.int64) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=U64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, U64), dtype=U64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pack rows (doc_id, text, role) into blocks, each of one role."""
    made = 0
    waiting: dict[int, list] = {COUNTED: [], TUNING: [], UNSEEN: []}
    amount = dict.fromkeys(waiting, 0)

    def block(role: int) -> pa.RecordBatch:
        nonlocal made
        parts = waiting[role]
        ids = [i for p in parts for i in p[0]]
        sizes = np.concatenate([p[1] for p in parts])
        hashes = np.concatenate([p[2] for p in parts])
        words, tokens = np.unique(hashes, return_inverse=True)
        number = TaskContext.get().partitionId() << 32 | made
        made += 1
        waiting[role], amount[role] = [], 0
        columns = [[number], [role], [ids], [pack(sizes)], [pack(tokens.astype(np.int32))], [pack_sorted(words)]]
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            ["block", "role", "doc_id", "sizes", "tokens", "words"],
        )

    for whole in batches:
        _, bounds = text_bytes(whole.column(1))
        for start, end in slices(bounds):
            batch = whole.slice(start, end - start)
            ids = batch.column(0).to_pylist()
            roles = batch.column(2).to_numpy(zero_copy_only=False)
            words, begin = word_hashes(*text_bytes(batch.column(1)))
            stops = begin[1:] + np.arange(len(ids))  # each row's end token
            hashes = np.full(len(words) + len(ids), END, U64)
            inner = np.ones(len(hashes), bool)
            inner[stops] = False
            hashes[inner] = words
            sizes = np.diff(begin) + 1
            for role in waiting:
                of = roles == role
                if of.any():
                    parts = ([i for i, x in zip(ids, of) if x], sizes[of], hashes[np.repeat(of, sizes)])
                    waiting[role].append(parts)
                    amount[role] += len(parts[2])
                    if amount[role] >= BLOCK_TOKENS:
                        yield block(role)
    for role in waiting:
        if waiting[role]:
            yield block(role)


def _grams(sizes: np.ndarray, tokens: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
    """Hashes of a block's tokens, of their predecessors, and of the pairs."""
    hashes = words[tokens]
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = BEGIN
    return [hashes, before, splitmix(before * U64(0x9E3779B97F4A7C15) + hashes)]


def _edges(shards: int) -> np.ndarray:
    """First hash of each shard but the first."""
    return np.array([-(-(k << 64) // shards) for k in range(1, shards)], U64)


def _singles(words: np.ndarray, tokens: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct words, the begin mark among them, and their counts."""
    keys = np.append(words, BEGIN)
    counts = np.append(np.bincount(tokens, minlength=len(words)), documents)
    order = np.argsort(keys)
    return keys[order], counts[order]


def _requests(shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    edges = _edges(shards)
    for batch in batches:
        for row in batch.to_pylist():
            sizes, tokens = unpack(row["sizes"]), unpack(row["tokens"], np.int32)
            words = unpack_sorted(row["words"])
            pairs = np.unique(_grams(sizes, tokens, words)[2], return_counts=True)
            for order, (keys, counts) in ((1, _singles(words, tokens, len(sizes))), (2, pairs)):
                cuts = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
                used = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(used), order, np.int32)),
                        pa.array(used.astype(np.int64)),
                        pa.array(np.full(len(used), row["block"], np.int64)),
                        pa.array(np.full(len(used), row["role"], np.int32)),
                        pa.array([pack_sorted(keys[cuts[k] : cuts[k + 1]]) for k in used], pa.binary()),
                        pa.array([pack(counts[cuts[k] : cuts[k + 1]]) for k in used], pa.binary()),
                    ],
                    ["order", "shard", "block", "role", "keys", "counts"],
                )


def _answers(asked: pa.Table) -> pa.Table:
    """Corpus counts for all requests to one shard; ``first`` without the tuning documents.

    A last row with block -1 holds the shard's sums: tokens and types, without
    the begin mark, in all training documents and in the counted ones.
    """
    rows = asked.to_pylist()
    keys = [unpack_sorted(r["keys"]) for r in rows]
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    places = np.split(at, cuts)
    sums = {role: np.zeros(len(known), np.int64) for role in (COUNTED, TUNING, UNSEEN)}
    for row, place in zip(rows, places):
        sums[row["role"]][place] += unpack(row["counts"])
    first = sums[COUNTED]
    total = first + sums[TUNING]
    order = rows[0]["order"]
    real = known != BEGIN
    summary = [total[real].sum(), (total[real] > 0).sum(), first[real].sum(), (first[real] > 0).sum()]
    return pa.table(
        {
            "order": pa.array([order] * (len(rows) + 1), pa.int32()),
            "shard": pa.array([rows[0]["shard"]] * (len(rows) + 1), pa.int64()),
            "block": pa.array([*(r["block"] for r in rows), -1], pa.int64()),
            "counts": pa.array([*(pack(total[p]) for p in places), pack(np.array(summary))], pa.binary()),
            "first": pa.array(
                [*(pack(first[p]) if r["role"] == TUNING else None for r, p in zip(rows, places)), None], pa.binary()
            ),
        }
    )


def _with_counts(block: dict, answers: pa.Table, column: str) -> tuple[np.ndarray, ...]:
    """Corpus counts of each token of a block, of its predecessor and of the pair."""
    sizes, tokens = unpack(block["sizes"]), unpack(block["tokens"], np.int32)
    words = unpack_sorted(block["words"])
    hashes, before, pairs = _grams(sizes, tokens, words)
    counts = {}
    for order in (1, 2):
        parts = sorted((r["shard"], r[column]) for r in answers.to_pylist() if r["order"] == order)
        counts[order] = np.concatenate([unpack(data) for _, data in parts])
    singles, _ = _singles(words, tokens, len(sizes))
    of = lambda keys: counts[1][np.searchsorted(singles, keys)]
    distinct, at = np.unique(pairs, return_inverse=True)
    if len(distinct) != len(counts[2]):
        raise RuntimeError("answers do not fit the block")
    by_word = of(words)
    context = np.empty(len(tokens), np.int64)
    context[1:] = by_word[tokens[:-1]]
    context[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = of(np.array([BEGIN]))[0]
    return sizes, by_word[tokens], context, counts[2][at]


def bucket(context: np.ndarray) -> np.ndarray:
    """Contexts by frequency: never seen, then by octaves of their count."""
    return np.floor(np.log2(context + 0.5)).astype(np.int64) + 1


def _octave(values: np.ndarray) -> np.ndarray:
    """Steps of an octave below 1, from 1 on; 0 for zero."""
    out = np.zeros(len(values), np.int64)
    seen = values > 0
    out[seen] = 1 + np.round(-np.log2(values[seen]) * STEPS).astype(np.int64)
    return out


def _held_out(tokens: int, _key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Counts of a tuning block's tokens by (bucket, pair estimate, word estimate)."""
    found: list[np.ndarray] = []
    for block in blocks.to_pylist():
        _, word, context, pair = _with_counts(block, answers, "first")
        estimate = pair / np.maximum(context, 1)
        found.append(np.stack([bucket(context), _octave(estimate), _octave(word / max(tokens, 1))]))
    cells, counts = np.unique(np.concatenate(found, axis=1), axis=1, return_counts=True)
    return pa.table({"bucket": cells[0], "pair": cells[1], "word": cells[2], "n": counts.astype(np.int64)})


def learn_weights(cells: list[Row] | list[tuple], types: int, rounds: int = 60) -> tuple[float, np.ndarray]:
    """Mixture weights by expectation-maximisation on held-out counts.

    ``cells`` are (bucket, pair, word, n). The word estimate is mixed with the
    uniform 1 / (types + 1) by one weight; then, for each bucket of context
    frequency, the pair estimate with that mixture. A bucket without held-out
    tokens, or of contexts never seen, takes the weight 0 if it is the first,
    else that of the bucket below.
    """
    uniform = 1.0 / (types + 1)
    if not cells:
        return 0.5, np.zeros(1)
    kind, pair, word, n = (np.array(x, np.float64) for x in zip(*cells))
    value = lambda step: np.where(step > 0, 2.0 ** (-(step - 1) / STEPS), 0.0)
    pair, word = value(pair), value(word)

    def em(high: np.ndarray, low: np.ndarray, n: np.ndarray) -> float:
        weight = 0.5
        for _ in range(rounds):
            part = weight * high
            weight = float((n * part / (part + (1 - weight) * low)).sum() / n.sum())
            weight = min(max(weight, 1e-6), 1 - 1e-6)
        return weight

    of_word = em(word, np.full_like(word, uniform), n)
    mixed = of_word * word + (1 - of_word) * uniform
    weights = np.zeros(int(kind.max()) + 1)
    for k in range(1, len(weights)):
        here = kind == k
        weights[k] = em(pair[here], mixed[here], n[here]) if here.any() else weights[k - 1]
    return of_word, weights


def _scores(model: dict, _key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Scores of the documents of one block."""
    out = []
    for block in blocks.to_pylist():
        sizes, word, context, pair = _with_counts(block, answers, "counts")
        base = np.log10((word + 1.0) / (model["tokens"] + (model["types"] + 1.0)))
        mixed = model["word"] * word / max(model["tokens"], 1) + (1 - model["word"]) / (model["types"] + 1.0)
        weight = model["pairs"][np.minimum(bucket(context), len(model["pairs"]) - 1)]
        weight = np.where(context > 0, weight, 0.0)
        score = np.log10(weight * pair / np.maximum(context, 1) + (1 - weight) * mixed)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        total = lambda x: np.add.reduceat(x, begin)
        out.append(
            pa.table(
                {
                    "doc_id": pa.array(block["doc_id"], pa.int64()),
                    "held_out": pa.array([block["role"] == UNSEEN] * len(sizes)),
                    "n_tokens": sizes.astype(np.int64),
                    "n_known": total((word > 0).astype(np.int64)),
                    "train_tokens": np.full(len(sizes), model["tokens"], np.int64),
                    "base_score": total(base),
                    "score": total(score),
                }
            )
        )
    return pa.concat_tables(out)


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score_documents(docs: DataFrame, held_out: int = 2, tuning: int = 6, folds: int = 7) -> DataFrame:
    """Log10 probability of every text under a model of the training documents.

    Needs doc_id and text; other columns are not read. A document is held out
    if the crc32 of its id, modulo ``folds``, is ``held_out``; all others are
    training documents. Words are lower-cased in A-Z; an end mark follows and
    counts as a token. ``base_score`` adds one to each word's count;
    ``score`` mixes bigram, word and uniform estimates. The weights are
    learned with the training documents of remainder ``tuning`` deleted from
    the counts, on those documents; then the counts take them in again.

    Null or blank texts consist of the end mark. A null id counts as empty
    text in the hash. Repeated rows count and are scored each. With no training
    document all counts are 0 and both scores are uniform. An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    remainder = fold("doc_id", folds)
    role = F.when(remainder == held_out, UNSEEN).when(remainder == tuning, TUNING).otherwise(COUNTED)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), role.cast("int").alias("role"))
    blocks = stored(map_arrow(rows, _blocks, BLOCK), "lm-blocks")
    held = blocks.agg(F.coalesce(F.sum(F.length("tokens") / 4), F.lit(0.0))).first()[0]
    shards = width(spark, held, SHARD_TOKENS)
    asked = map_arrow(blocks.repartition("block"), partial(_requests, shards), REQUEST)
    answers = stored(asked.groupBy("order", "shard").applyInArrow(_answers, ANSWER), "lm-answers")

    summaries = [unpack(r.counts) for r in answers.where("block = -1 and order = 1").select("counts").collect()]
    tokens, types, first_tokens, first_types = map(int, np.sum(summaries, axis=0)) if summaries else (0, 0, 0, 0)

    def matched(which: str):
        mine = blocks.where(which).groupBy("block")
        theirs = answers.where("block >= 0").join(blocks.where(which).select("block"), "block", "left_semi")
        return mine.cogroup(theirs.groupBy("block"))

    cells = (
        matched(f"role = {TUNING}")
        .applyInArrow(partial(_held_out, first_tokens), "bucket long, pair long, word long, n long")
        .groupBy("bucket", "pair", "word")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    of_word, of_pair = learn_weights(sorted(map(tuple, cells)), first_types)
    model = {"tokens": tokens, "types": types, "word": of_word, "pairs": of_pair}
    return matched("true").applyInArrow(partial(_scores, model), SCORES)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))

"""Quality classifier: perplexity under an n-gram model of trusted text (operator 4).

The model is an interpolated modified Kneser-Ney trigram model of all trusted
documents of the training half. Its counts are dealt to shards by the hash of their
context, trigrams by word pairs and pairs by words; each shard adds up its own, and
discounts come from the counts of counts of all. The shards end as tables of discounted
shares and of what each context leaves to lower orders, interpolated when a text is scored.

Texts meet the model by two exchanges, first for their words and then for their
word pairs and trigrams: documents are packed into blocks of some tokens, each
block sends its distinct n-grams to the shards, and each shard answers every
block with what it holds of them. An n-gram goes through the shuffle once for
each block that has it, and no table is ever in one place.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import fresh, map_arrow, pack, ship, small, stored, table, width
from tidewatch.llm.lm_scoring import pack as to_bytes
from tidewatch.llm.lm_scoring import pack_sorted, unpack_sorted
from tidewatch.llm.lm_scoring import unpack as from_bytes
from tidewatch.llm.words import U64, HashIndex, slices, splitmix, text_bytes, word_hashes
from tidewatch.session import work_folder
from tidewatch.sinks.versions import delete

BEGIN, END, RARE = splitmix(np.array([11, 12, 13], U64))
_MIX = U64(0x9E3779B97F4A7C15)


#: Tokens of a block (a longer text is one alone), and n-grams of a shard, about.
BLOCK_TOKENS = 500_000
SHARD_GRAMS = 500_000
#: Documents are scored in up to so many parts, one after the other, each of at least so many
#: bytes of text: only one part's n-grams are in the shuffle at once.
PARTS, PART_BYTES = 8, 64 << 20
WORDS, PAIRS, TRIPLES = 1, 2, 3

BLOCK = "block long, first binary, second binary, sizes binary, tokens binary, words binary"
CLASSED = f"{BLOCK}, p binary, g binary"
ASKED = "kind int, shard long, block long, size long, keys binary"
ANSWER = "kind int, shard long, block long, size long, p binary, g binary"
SHARD = "kind int, shard long, keys binary, p binary, g binary"
#: n-grams by context: hashes of the contexts, their last words, how many words follow each, these
#: words and their counts; and how many n-grams have a count of 1, 2, 3 and 4.
COUNTS = "shard long, contexts binary, last binary, followers binary, words binary, counts binary, n array<long>"
#: Leading bits of a trigram's hash that are its context's, so that it lies in the context's shard.
_SHARED_BITS = 16


@dataclass(frozen=True)
class Settings:
    """Where the line is drawn.

    A document is rejected if its log perplexity is over the line of its
    language: the median of trusted documents plus ``slack`` times the distance
    from it to their ``quantile``; for a text of few words the distance grows by
    ``short`` / sqrt(tokens).
    """

    quantile: float = 0.99
    slack: float = 1.5
    short: float = 2.0


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return splitmix(left * _MIX + right)


#: The context of a text's first token.
_START = _pair(np.array([BEGIN]), np.array([BEGIN]))


def _triple(context: np.ndarray, pair: np.ndarray) -> np.ndarray:
    own = U64(64 - _SHARED_BITS)
    return (context >> own << own) | (_pair(context, pair) >> U64(_SHARED_BITS))


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words of all rows, an end mark behind each row, and where rows end (exclusive)."""
    words, begin = word_hashes(*text_bytes(column))
    stops = begin[1:] + np.arange(1, len(begin))
    out = np.full(len(words) + len(column), END, U64)
    inner = np.ones(len(out), bool)
    inner[stops - 1] = False
    out[inner] = words
    return out, stops


def _histories(tokens: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token before and the one before that, begin marks at each row's start."""
    heads = np.concatenate([[0], stops[:-1]])
    one = np.empty_like(tokens)
    one[1:] = tokens[:-1]
    one[heads] = BEGIN
    two = np.empty_like(tokens)
    two[1:] = one[:-1]
    two[heads] = BEGIN
    return one, two


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _sorted_distinct(keys: np.ndarray) -> np.ndarray:
    """``np.unique`` of hashes: sorting takes a third of the time of numpy's hash table."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each block and their counts."""
    for batch in batches:
        for row in batch.to_pylist():
            _, tokens, words = _read(row)
            yield pa.RecordBatch.from_arrays([_signed(words), pa.array(np.bincount(tokens))], ["w", "c"])


def _dealt(context: np.ndarray, last: np.ndarray, word: np.ndarray, count: np.ndarray, bits: int) -> Iterator[tuple]:
    """Counts of n-grams as rows by shard of the context; equal n-grams are added up."""
    order = np.lexsort((word, context))
    context, last, word = context[order], last[order], word[order]
    new = np.ones(len(word), bool)
    new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
    first = np.flatnonzero(new)
    count = np.add.reduceat(count[order], first) if len(first) else count
    context, last, word = context[first], last[first], word[first]
    edges = np.arange(1, 1 << bits).astype(U64) << U64(64 - bits)
    cuts = np.concatenate([[0], np.searchsorted(context, edges), [len(context)]])
    new = np.ones(len(context), bool)
    new[1:] = context[1:] != context[:-1]
    heads = np.flatnonzero(new)  # a shard begins with a new context
    known, last, followers = context[heads], last[heads], np.diff(heads, append=len(context))
    owned = np.searchsorted(heads, cuts)
    for k in np.flatnonzero(np.diff(cuts)):
        here, own = slice(cuts[k], cuts[k + 1]), slice(owned[k], owned[k + 1])
        held = [pack_sorted(known[own]), to_bytes(last[own]), to_bytes(followers[own]), to_bytes(word[here]), to_bytes(count[here])]
        yield int(k), *held, np.bincount(np.minimum(count[here], 5), minlength=6)[1:5].tolist()


def _count_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 7
    kinds = [pa.int64(), *[pa.binary()] * 5, pa.list_(pa.int64())]
    names = ["shard", "contexts", "last", "followers", "words", "counts", "n"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _counts(row: dict) -> tuple[np.ndarray, ...]:
    """Contexts and their last words for each n-gram, and its word and count."""
    followers = from_bytes(row["followers"])
    context, last = unpack_sorted(row["contexts"]), from_bytes(row["last"], U64)
    return np.repeat(context, followers), np.repeat(last, followers), from_bytes(row["words"], U64), from_bytes(row["counts"])


def _count_trigrams(bits: int, half: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams of the shards of even or odd number."""
    for batch in batches:
        for row in batch.to_pylist():
            sizes, tokens, words = _read(row)
            classes = words[tokens]
            one, two = _histories(classes, np.cumsum(sizes))
            context = _pair(two, one)
            own = np.flatnonzero(context >> U64(64 - bits) & U64(1) == U64(half))
            yield _count_rows(list(_dealt(context[own], one[own], classes[own], np.ones(len(own), np.int64), bits)))


def _count_bigrams(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word pairs with the number of different words in front; begin marks have none and count occurrences."""
    for batch in batches:
        for row in batch.to_pylist():
            context, last, words, counts = _counts(row)
            yield _count_rows(list(_dealt(last, last, words, np.where(context == _START, counts, 1), bits)))


def _count_unigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            words, counts = np.unique(from_bytes(row["words"], U64), return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(words), pa.array(counts)], ["w", "c"])


def _added(bits: int, part: pa.Table) -> pa.Table:
    """The counts of one shard in one row."""
    parts = [_counts(row) for row in part.to_pylist()]
    return pa.Table.from_batches([_count_rows(list(_dealt(*(np.concatenate(x) for x in zip(*parts)), bits)))])


def _summed(counts: DataFrame, bits: int, tasks: int, path: str) -> DataFrame:
    """The shards' counts, added to those at ``path``."""
    spark = counts.sparkSession
    summed = counts.repartition(tasks, "shard").groupBy("shard").applyInArrow(lambda part: _added(bits, part), COUNTS)
    summed.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(COUNTS).parquet(path)


def _from_counts_of_counts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts for counts of one, two, and three or more."""
    n = [0, n1, n2, n3, n4]
    if not n[1] or not n[2]:
        return [0.5, 1.0, 1.5]
    y = n[1] / (n[1] + 2 * n[2])
    raw = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2 for k in (1, 2, 3)]
    return [min(max(d, 0.05), k) for k, d in zip((0.95, 1.95, 2.95), raw)]


def _discounts(summed: DataFrame) -> list[float]:
    row = summed.agg(*[F.sum(F.col("n")[k]).alias(f"n{k}") for k in range(4)]).first()
    return _from_counts_of_counts(*row)


def _shares(row: dict, discounts: list[float]) -> tuple[np.ndarray, ...]:
    """A shard's contexts, what each leaves to lower orders, and each n-gram's discounted share."""
    followers, counts = from_bytes(row["followers"]), from_bytes(row["counts"])
    begin = np.cumsum(followers) - followers
    discount = np.array([0.0, *discounts])[np.minimum(counts, 3)]
    total = np.add.reduceat(counts, begin)
    gamma = np.add.reduceat(discount, begin) / total
    return unpack_sorted(row["contexts"]), gamma, (counts - discount) / np.repeat(total, followers)


@dataclass
class Model:
    """The stored n-grams' shares in their contexts (a word's: its probability) and the contexts' remainders, as arrays."""

    words: np.ndarray
    word_p: np.ndarray
    pairs: np.ndarray
    pair_p: np.ndarray
    triples: np.ndarray
    triple_p: np.ndarray
    contexts: np.ndarray  # words and pairs as contexts
    gamma: np.ndarray
    rare_types: int


class Scorer:
    """Looks n-grams up in the arrays of a whole model."""

    def __init__(self, model: Model):
        self.model = model
        self.words, self.pairs = HashIndex(model.words), HashIndex(model.pairs)
        self.triples, self.contexts = HashIndex(model.triples), HashIndex(model.contexts)

    def _gamma(self, context: np.ndarray) -> np.ndarray:
        at = self.contexts.find(context)
        return np.where(at >= 0, self.model.gamma[at], 1.0)

    def log_probabilities(self, tokens: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Log10 probability of each token; a word out of vocabulary shares the rare class evenly."""
        m = self.model
        known = self.words.find(tokens)
        rare = known < 0
        classes = np.where(rare, RARE, tokens)
        rare_place = int(self.words.find(np.array([RARE], U64))[0])
        one, two = _histories(classes, stops)
        pair, context = _pair(one, classes), _pair(two, one)
        p = m.word_p[np.where(rare, rare_place, known)]
        at = self.pairs.find(pair)
        p = np.where(at >= 0, m.pair_p[at], 0.0) + self._gamma(one) * p
        at = self.triples.find(_triple(context, pair))
        p = np.where(at >= 0, m.triple_p[at], 0.0) + self._gamma(context) * p
        return np.log10(p) - np.where(rare, np.log10(m.rare_types), 0.0)


@dataclass
class Tables:
    """The model as stored shards of ``SHARD``, by the ``bits`` leading bits of the hash.

    ``p`` is a trigram's or word pair's share in its context, a word's probability, and 0 for what
    is a context only; ``g`` what it leaves to lower orders as a context, 1 for what is none.
    Pairs and trigrams are the table ``name``, bucketed by kind and shard: every part of the
    texts meets it where it lies, without a shuffle of the model. ``drop`` it when all is scored.
    """

    words: DataFrame
    name: str
    folder: str
    bits: int
    rare_types: int

    @property
    def grams(self) -> DataFrame:
        return self.words.sparkSession.table(self.name)

    def drop(self) -> None:
        spark = self.words.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete(spark, self.folder)


def _bucketed(shards: DataFrame, tasks: int, name: str, folder: str) -> None:
    """Append ``shards`` to a table that is bucketed as an exchange to ``tasks`` deals them."""
    writer = shards.repartition(tasks, "kind", "shard").write.mode("append").format("parquet")
    writer = writer.option("compression", "zstd").option("path", folder).bucketBy(tasks, "kind", "shard")
    writer.saveAsTable(name)


def _triples(discounts: list[float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            context, last, words, _ = _counts(row)
            share = _shares(row, discounts)[2]
            yield _shard_row(TRIPLES, row["shard"], _triple(context, _pair(last, words)), share, np.ones(len(share)))


def _pair_shares(discounts: list[float], bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shares of word pairs to the shards of the pairs' hashes."""
    for batch in batches:
        for row in batch.to_pylist():
            _, last, words, _ = _counts(row)
            key, share = _pair(last, words), _shares(row, discounts)[2].astype(np.float32)
            order = np.argsort(key)
            yield _ask(PAIRS, key[order], row["shard"], bits, share[order])


def _left_by_words(discounts: list[float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            words, gamma, _ = _shares(row, discounts)
            yield pa.RecordBatch.from_arrays([_signed(words), pa.array(gamma)], ["w", "g"])


def _left_by_pairs(discounts: list[float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            known, gamma, _ = _shares(row, discounts)
            yield _shard_row(PAIRS, row["shard"], known, np.zeros(len(known)), gamma)


def _pairs(_key, shares: pa.Table, contexts: pa.Table) -> pa.Table:
    """A shard's word pairs: their shares, and what they leave as contexts."""
    rows = shares.to_pylist()
    key = np.concatenate([np.zeros(0, U64), *(unpack_sorted(r["keys"]) for r in rows)])
    share = np.concatenate([np.zeros(0, np.float32), *(from_bytes(r["p"], np.float32) for r in rows)])
    known, left = np.zeros(0, U64), np.zeros(0)
    for row in contexts.to_pylist():
        known, _, left = _held(row)
    every = _sorted_distinct(np.concatenate([key, known]))
    p, g = np.zeros(len(every)), np.ones(len(every))
    p[np.searchsorted(every, key)] = share
    g[np.searchsorted(every, known)] = left
    number = int((shares if rows else contexts)["shard"][0].as_py())
    return pa.Table.from_batches([_shard_row(PAIRS, number, every, p, g)])


def _tables(trusted: DataFrame, bits: int = 1, buckets: int = 1) -> Tables | None:
    """The model of all ``trusted`` (doc_id, text), in 2**``bits`` shards or more; None without text.

    Words met once form one class, which later also stands for unknown words;
    its probability is shared among as many words as it had.
    """
    spark = trusted.sparkSession
    ship(spark)
    folder = work_folder(spark, "kn-counts")

    def held(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    blocks = held(_packed(trusted.where(F.col("text").isNotNull())), "blocks")
    words = held(map_arrow(blocks, _count_words, "w long, c long").groupBy("w").agg(F.sum("c").alias("c")), "words")
    end = int(END.view(np.int64))
    own = (F.col("c") > 1) | (F.col("w") == end)
    row = words.agg(F.count("*").alias("types"), F.sum("c").alias("tokens"), F.sum(own.cast("long")).alias("own")).first()
    if not row.types:
        delete(spark, folder)
        return None
    bits = max(bits, _bits(row.tokens))
    tasks = width(spark, row.tokens, SHARD_GRAMS)
    known = words.where(own).select(F.col("w").alias("key"), F.lit(1.0).alias("p"), F.lit(1.0).alias("g"))
    classed = held(_classed(blocks, _sharded(known, bits), bits, row.tokens), "classed")
    delete(spark, f"{folder}/blocks")
    for half in (0, 1):
        counts = map_arrow(classed, partial(_count_trigrams, bits, half), COUNTS)
        trigrams = _summed(counts, bits, tasks, f"{folder}/trigrams")
    delete(spark, f"{folder}/classed")
    bigrams = _summed(map_arrow(trigrams, partial(_count_bigrams, bits), COUNTS), bits, tasks, f"{folder}/bigrams")
    d3, d2 = _discounts(trigrams), _discounts(bigrams)
    name, model = f"kn_grams_{uuid.uuid4().hex}", work_folder(spark, "kn-grams")
    _bucketed(map_arrow(trigrams, partial(_triples, d3), SHARD), buckets, name, model)
    contexts = held(map_arrow(trigrams, partial(_left_by_pairs, d3), SHARD), "contexts")
    delete(spark, f"{folder}/trigrams")  # the corpus's n-grams are many: each table goes when the next is made
    unigrams = held(map_arrow(bigrams, _count_unigrams, "w long, c long").groupBy("w").agg(F.sum("c").alias("c")), "unigrams")
    # words follow no context: every one has its discounted share, and an even part of what is left
    counts = [F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]
    ones = unigrams.agg(F.count("*").alias("types"), F.sum("c").alias("total"), *counts).first()
    d1 = _from_counts_of_counts(ones.n1, ones.n2, ones.n3, ones.n4)
    left = d1[0] * ones.n1 + d1[1] * ones.n2 + d1[2] * (ones.types - ones.n1 - ones.n2)
    rest = left / ones.total / ones.types
    discount = F.when(F.col("c") == 1, d1[0]).when(F.col("c") == 2, d1[1]).otherwise(d1[2])
    p1 = unigrams.select("w", ((F.col("c") - discount) / ones.total + rest).alias("p"))
    rare = spark.range(1).select(F.lit(int(RARE.view(np.int64))).cast("long").alias("w"), F.lit(rest).alias("rare"))
    g1 = map_arrow(bigrams, partial(_left_by_words, d2), "w long, g double")
    singles = p1.join(g1, "w", "full").join(rare, "w", "full")
    singles = singles.select(
        F.col("w").alias("key"), F.coalesce("p", "rare", F.lit(0.0)).alias("p"), F.coalesce("g", F.lit(1.0)).alias("g")
    )
    shares = map_arrow(bigrams, partial(_pair_shares, d2, bits), f"{ASKED}, p binary").repartition(tasks, "shard")
    pairs = (
        shares.groupBy("shard")
        .cogroup(contexts.repartition(tasks, "shard").groupBy("shard"))
        .applyInArrow(_pairs, SHARD)
    )
    _bucketed(pairs, buckets, name, model)
    singles = stored(_sharded(singles, bits), "kn-singles")
    delete(spark, folder)
    return Tables(singles, name, model, bits, max(1, row.types - row.own))


def fit(trusted: DataFrame) -> Model | None:
    """The model of all ``trusted`` (doc_id, text) as arrays, for a ``Scorer`` in one process.

    For trusted sets that fit one process; ``classify`` leaves the shards where they are.
    None without text.
    """
    made = _tables(trusted)
    if made is None:
        return None
    rows = [r.asDict() for r in made.words.union(made.grams.select(made.words.columns)).collect()]
    made.drop()

    def arrays(kind: int) -> tuple[np.ndarray, ...]:
        held = [_held(r) for r in rows if r["kind"] == kind]
        return tuple(np.concatenate(x) for x in zip(*held))

    (w, p1, g1), (b, p2, g2), (t, p3, _) = arrays(WORDS), arrays(PAIRS), arrays(TRIPLES)
    return Model(
        w[p1 > 0], p1[p1 > 0], b[p2 > 0], p2[p2 > 0], t, p3, np.concatenate([w, b]), np.concatenate([g1, g2]), made.rare_types
    )


# --- scoring by exchange ------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pack rows (two key numbers, text) into blocks."""
    made = amount = 0
    waiting: list[tuple] = []

    def block() -> pa.RecordBatch:
        nonlocal made, amount
        first, second, sizes, hashes = (np.concatenate(x) for x in zip(*waiting))
        words, tokens = np.unique(hashes, return_inverse=True)
        number = TaskContext.get().partitionId() << 32 | made
        made, amount = made + 1, 0
        waiting.clear()
        held = [to_bytes(first), to_bytes(second), to_bytes(sizes), to_bytes(tokens.astype(np.int32)), pack_sorted(words)]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), *(pa.array([x], pa.binary()) for x in held)],
            ["block", "first", "second", "sizes", "tokens", "words"],
        )

    for whole in batches:
        _, bounds = text_bytes(whole.column(2))
        for start, end in slices(bounds):
            batch = whole.slice(start, end - start)
            hashes, stops = _tokens(batch.column(2))
            sizes = np.diff(stops, prepend=0).astype(np.int32)
            waiting.append((np.asarray(batch.column(0)), np.asarray(batch.column(1)), sizes, hashes))
            amount += len(hashes)
            if amount >= BLOCK_TOKENS:
                yield block()
    if waiting:
        yield block()


def _names() -> tuple[Column, Column]:
    """Two numbers that stand for a row's id and text."""
    return (
        F.xxhash64("doc_id", "text").alias("_first"),
        F.xxhash64(F.lit("second"), "text", "doc_id", F.col("text").isNull()).alias("_second"),
    )


def _packed(docs: DataFrame) -> DataFrame:
    return map_arrow(docs.select(*_names(), F.col("text").cast("string")), _blocks, BLOCK)


def _read(row: dict) -> tuple[np.ndarray, ...]:
    """A block's texts' sizes, its tokens' places among its words, and these."""
    return from_bytes(row["sizes"], np.int32), from_bytes(row["tokens"], np.int32), unpack_sorted(row["words"])


def _bits(grams: float) -> int:
    """Shards are the ranges of equal leading bits of a hash, of about ``SHARD_GRAMS`` n-grams."""
    return min(max(1, math.ceil(math.log2(max(grams, 1) / SHARD_GRAMS))), _SHARED_BITS)


def _thin(values: np.ndarray, usual: float) -> bytes:
    """Numbers of which many are the usual one."""
    other = values != np.float32(usual)
    return np.packbits(other).tobytes() + to_bytes(values[other].astype(np.float32))


def _full(data: bytes, size: int, usual: float) -> np.ndarray:
    head = (size + 7) // 8
    other = np.unpackbits(np.frombuffer(data[:head], np.uint8), count=size).astype(bool)
    out = np.full(size, usual, np.float32)
    out[other] = from_bytes(data[head:], np.float32)
    return out


def _shard_row(kind: int, shard: int, keys: np.ndarray, p: np.ndarray, g: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(keys)
    held = [pack_sorted(keys[order]), _thin(p[order].astype(np.float32), 0.0), _thin(g[order].astype(np.float32), 1.0)]
    return pa.RecordBatch.from_arrays(
        [pa.array([kind], pa.int32()), pa.array([shard], pa.int64()), *(pa.array([x], pa.binary()) for x in held)],
        ["kind", "shard", "keys", "p", "g"],
    )


def _held(row: dict) -> tuple[np.ndarray, ...]:
    """Keys, probabilities and remainders of a shard."""
    keys = unpack_sorted(row["keys"])
    return keys, _full(row["p"], len(keys), 0.0), _full(row["g"], len(keys), 1.0)


def _shard_words(part: pa.Table) -> pa.Table:
    columns = np.asarray(part["key"]).view(U64), np.asarray(part["p"]), np.asarray(part["g"])
    return pa.Table.from_batches([_shard_row(WORDS, int(part["shard"][0].as_py()), *columns)])


def _sharded(words: DataFrame, bits: int) -> DataFrame:
    """Words (key, p, g) as one row a shard."""
    shard = F.shiftrightunsigned(F.col("key"), 64 - bits).cast("long")
    return words.withColumn("shard", shard).groupBy("shard").applyInArrow(_shard_words, SHARD)


def _ask(kind: int, keys: np.ndarray, block: int, bits: int, p: np.ndarray | None = None) -> pa.RecordBatch:
    """A block's distinct n-grams, in rising order, as one row for each shard; ``p``: with their numbers."""
    edges = np.arange(1, 1 << bits).astype(U64) << U64(64 - bits)
    cuts = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
    used = np.flatnonzero(np.diff(cuts))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(used), kind, np.int32)),
            pa.array(used.astype(np.int64)),
            pa.array(np.full(len(used), block, np.int64)),
            pa.array(np.diff(cuts)[used].astype(np.int64)),
            pa.array([pack_sorted(keys[cuts[k] : cuts[k + 1]]) for k in used], pa.binary()),
            *([] if p is None else [pa.array([to_bytes(p[cuts[k] : cuts[k + 1]]) for k in used], pa.binary())]),
        ],
        ["kind", "shard", "block", "size", "keys", *([] if p is None else ["p"])],
    )


def _singles(words: np.ndarray) -> np.ndarray:
    """A block's words and the two marks that its n-grams may hold besides."""
    return _sorted_distinct(np.append(words, [BEGIN, RARE]))


def _grams(row: dict) -> list[np.ndarray]:
    """Hashes of a classed block's tokens: as pairs with the token before, and one pair of begin marks behind
    them; trigrams. A token's context is the pair of the token before, or at a text's start that of begin marks."""
    sizes, tokens, words = _read(row)
    classes = words[tokens]
    heads = np.cumsum(sizes) - sizes
    one = np.empty_like(classes)
    one[1:] = classes[:-1]
    one[heads] = BEGIN
    pair = np.append(_pair(one, classes), _START)
    return [pair, _triple(pair[_before(heads, len(classes))], pair[:-1])]


def _before(heads: np.ndarray, size: int) -> np.ndarray:
    """For each token the place of its context among the pairs of ``_grams``."""
    before = np.arange(-1, size - 1)
    before[heads] = size
    return before


def _ask_words(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _ask(WORDS, _singles(unpack_sorted(row["words"])), row["block"], bits)


def _ask_grams(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            for kind, grams in zip((PAIRS, TRIPLES), _grams(row)):
                yield _ask(kind, _sorted_distinct(grams), row["block"], bits)


def _answer(_key, asked: pa.Table, held: pa.Table) -> pa.Table:
    """What a shard holds of the n-grams that each block asks for."""
    keys = p = g = np.zeros(0)
    for row in held.to_pylist():
        keys, p, g = _held(row)
    out: dict[str, list] = {name: [] for name in ("p", "g")}
    for k in range(asked.num_rows):
        wanted = unpack_sorted(asked["keys"][k].as_py())
        own_p, own_g = np.zeros(len(wanted), np.float32), np.ones(len(wanted), np.float32)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            met = keys[at] == wanted
            own_p[met], own_g[met] = p[at[met]], g[at[met]]
        out["p"].append(_thin(own_p, 0.0))
        out["g"].append(_thin(own_g, 1.0))
    columns = [asked[c] for c in ("kind", "shard", "block", "size")]
    return pa.table([*columns, pa.array(out["p"], pa.binary()), pa.array(out["g"], pa.binary())], ANSWER_NAMES)


ANSWER_NAMES = ["kind", "shard", "block", "size", "p", "g"]


def _answered(answers: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities and remainders in the order in which a block has asked."""
    rows = sorted((r for r in answers.to_pylist() if r["kind"] == kind), key=lambda r: r["shard"])
    return tuple(
        np.concatenate([_full(r[c], r["size"], usual) for r in rows]) for c, usual in (("p", 0.0), ("g", 1.0))
    )


def _class(_key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """A block with unknown words put into one class, and each class's probability and remainder."""
    (row,) = blocks.to_pylist()
    _, tokens, words = _read(row)
    singles = _singles(words)
    p, g = _answered(answers, WORDS)
    classes = np.where(p[np.searchsorted(singles, words)] > 0, words, RARE)
    kept = (p > 0) | np.isin(singles, np.array([BEGIN, RARE], U64))
    row["tokens"] = to_bytes(np.searchsorted(singles[kept], classes)[tokens].astype(np.int32))
    row["words"], row["p"], row["g"] = pack_sorted(singles[kept]), to_bytes(p[kept]), to_bytes(g[kept])
    return pa.table({k: pa.array([v], pa.int64() if k == "block" else pa.binary()) for k, v in row.items()})


def _score(rare_types: int, _key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Sizes and mean negative log10 probabilities of a block's texts."""
    (row,) = blocks.to_pylist()
    sizes, tokens, words = _read(row)
    p1, g1 = from_bytes(row["p"], np.float32), from_bytes(row["g"], np.float32)
    p2, g2 = _answered(answers, PAIRS)
    p3, _ = _answered(answers, TRIPLES)
    pair, triple = (np.unique(grams, return_inverse=True)[1] for grams in _grams(row))
    begin = np.cumsum(sizes) - sizes
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[begin] = np.searchsorted(words, BEGIN)
    p = p2[pair[:-1]] + g1[before] * p1[tokens].astype(np.float64)
    p = p3[triple] + g2[pair[_before(begin, len(tokens))]] * p
    rare = tokens == np.searchsorted(words, RARE)
    score = np.log10(p) - np.where(rare, np.log10(rare_types), 0.0)
    mean = -np.add.reduceat(score, begin) / sizes
    return pa.table(
        {
            "_first": from_bytes(row["first"]),
            "_second": from_bytes(row["second"]),
            "n_tokens": sizes.astype(np.int64),
            "log_perplexity": pa.array(mean, pa.float64(), mask=sizes < 2),
        }
    )


def _exchanged(blocks: DataFrame, asked: DataFrame, shards: DataFrame, tasks: int):
    """Blocks beside the answers to what they ask; ``shards`` are moved unless they are bucketed by as many tasks."""
    answers = (
        asked.repartition(tasks, "kind", "shard")
        .groupBy("kind", "shard")
        .cogroup(shards.groupBy("kind", "shard"))
        .applyInArrow(_answer, ANSWER)
    )
    return blocks.groupBy("block").cogroup(answers.repartition(tasks, "block").groupBy("block"))


def _classed(blocks: DataFrame, shards: DataFrame, bits: int, tokens: float) -> DataFrame:
    tasks = width(blocks.sparkSession, tokens, BLOCK_TOKENS)
    dealt = blocks.repartition(tasks, "block")
    asked = map_arrow(dealt, partial(_ask_words, bits), ASKED)
    return _exchanged(dealt, asked, shards, tasks).applyInArrow(_class, CLASSED)


@contextmanager
def _tidy(spark: SparkSession):
    """Each job inside drops its shuffle files when it ends; all results inside are stored ones."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """n_tokens and log_perplexity (base 10) of all rows of ``docs`` under the model of ``trusted``.

    Both need doc_id and text; rows go by ``_names``, and those of equal id and text are one.
    The end mark counts as a token. log_perplexity is null for texts without a
    word, and if there is no model.
    """
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = min(PARTS, max(1, math.ceil(size / PART_BYTES)))
    tokens = size / parts / 6
    tasks = width(spark, tokens, BLOCK_TOKENS)
    model = _tables(trusted, _bits(tokens), tasks)
    if model is None:
        sizes = map_arrow(_packed(docs), _sizes, "_first long, _second long, n_tokens long")
        return sizes.dropDuplicates(["_first", "_second"]).withColumn("log_perplexity", F.lit(None).cast("double"))
    scores = None
    own = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(parts))
    try:
        for k in range(parts):
            part = docs.where(own == k) if parts > 1 else docs
            classed = _classed(_packed(part), model.words, model.bits, tokens).repartition(tasks, "block")
            asked = map_arrow(classed, partial(_ask_grams, model.bits), ASKED)
            made = _exchanged(classed, asked, model.grams, tasks).applyInArrow(
                partial(_score, model.rare_types), "_first long, _second long, n_tokens long, log_perplexity double"
            )
            made = stored(made, "kn-scores")
            scores = made if scores is None else scores.union(made)
    finally:
        model.drop()
    return scores.dropDuplicates(["_first", "_second"])


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            columns = [from_bytes(row["first"]), from_bytes(row["second"]), _read(row)[0].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_first", "_second", "n_tokens"])


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All columns of ``docs`` with n_tokens, log_perplexity, limit and kept (replaced if present).

    ``docs`` needs doc_id, text and lang; ``labels`` doc_id, quality and toxic.
    Trusted documents have quality 1 and are not toxic. Half of them, by hash, train
    the model, all and whole; the perplexities of all in the other half
    give each language's quantiles. A language without trusted documents, and a
    null one, takes the quantiles of all. Perplexity and limit are logarithms.

    Null, empty and blank texts have no perplexity and are rejected. Without
    any trusted text nothing is rejected but those. Repeated rows are judged
    alike, also if labels repeat; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs, unpack = pack(docs, "doc_id", "text", "lang")
    trusted_ids = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").alias("_trusted"))
    trusted_ids = small(stored(trusted_ids.distinct(), "kn-trusted"), 1_000_000)  # else all texts are shuffled
    trusted = docs.select("doc_id", "text", "lang").join(trusted_ids, F.col("doc_id") == F.col("_trusted"), "left_semi")
    trains = F.xxhash64(F.lit("half"), F.col("doc_id"), F.col("text")) % 2 == 0
    with _tidy(spark):
        scores = stored(perplexities(docs.select("doc_id", "text"), trusted.where(trains)), "kn-perplexities")
    scored = lambda df: df.select("*", *_names()).join(scores, ["_first", "_second"])
    measured = scored(trusted.where(~trains).select("doc_id", "text", "lang")).select("lang", "log_perplexity")
    exact = lambda q: F.percentile_approx("log_perplexity", F.lit(q), F.lit(10_000))
    lines = stored(
        measured.where("log_perplexity is not null")
        .cube("lang")
        .agg(
            F.grouping("lang").alias("all_languages"),
            exact(0.5).alias("middle"),
            exact(settings.quantile).alias("high"),
        ),
        "kn-lines",
    )
    every = lines.where("all_languages = 1").first()
    of = fresh(docs, "_of")
    by_language = lines.where("all_languages = 0 and lang is not null").select(
        F.col("lang").alias(of), "middle", "high"
    )
    joined = scored(docs).join(small(by_language), F.col("lang") == F.col(of), "left")
    middle = F.coalesce(F.col("middle"), F.lit(every.middle if every else None).cast("double"))
    high = F.coalesce(F.col("high"), F.lit(every.high if every else None).cast("double"))
    line = middle + (high - middle) * settings.slack * (1 + F.lit(settings.short) / F.sqrt("n_tokens"))
    verdict = F.coalesce(F.col("log_perplexity") <= line, F.col("n_tokens") > 1)
    judged = joined.select(*docs.columns, "n_tokens", "log_perplexity", line.alias("limit"), verdict.alias("kept"))
    return unpack(judged, "n_tokens", "log_perplexity", "limit", "kept")


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return classify(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_tokens", "log_perplexity", "limit", "kept"
    )

"""Hard-negative mining over an inverted multi-index (operator 12)."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow, ship, small, stored, table, width

#: Rows whose squares add up to this or more take no part: 100 times any product stays a long.
LARGEST_SQUARE = float(1 << 55)
_EXACT = float(1 << 53)


@dataclass(frozen=True)
class Settings:
    """What is sought, and the size of the codebooks, of their sample and of the blocks.

    The negatives of a positive score from ``low`` to 100 hundredths of it. The sample
    is drawn for each length of vectors; its rows also give the first floors.
    """

    every: int = 100
    scale: int = 256
    positives: int = 5
    negatives: int = 5
    low: int = 80
    sample: int = 8192
    most_codes: int = 64
    rows_per_cell: int = 64
    rounds: int = 8
    block: int = 4096
    anchor_block: int = 1024
    slab: int = 512


# --- codebooks and cells ---------------------------------------------------


def learn(half: np.ndarray, codes: int, rounds: int) -> np.ndarray:
    """Codewords of a half space: k-means from rows spread over the first principal axis."""
    half = np.asarray(half, np.float64)
    codes = max(1, min(codes, len(np.unique(half, axis=0)))) if half.shape[1] else 1
    if not half.shape[1]:
        return np.zeros((1, 0))
    apart = half - half.mean(axis=0)
    axis = np.linalg.eigh(apart.T @ apart)[1][:, -1]
    order = np.argsort(apart @ axis, kind="stable")
    words = half[order[((np.arange(codes) + 0.5) * len(half) / codes).astype(int)]]
    for _ in range(rounds):
        near = nearest(half, words)[0]
        counts = np.bincount(near, minlength=codes)
        sums = np.zeros_like(words)
        np.add.at(sums, near, half)
        words = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], words)
    return words


def nearest(half: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's codeword and its distance from it."""
    far = (words**2).sum(axis=1)[None, :] - 2 * half @ words.T
    near = far.argmin(axis=1)
    return near, np.sqrt(((half - words[near]) ** 2).sum(axis=1))


@dataclass
class Index:
    """Codebooks of both half spaces, the radii around their words, and where cells are stored."""

    words: tuple[np.ndarray, np.ndarray]
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray] | None = None
    blocks: dict[tuple[int, int], tuple[int, int]] | None = None

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.words[0].shape[1]
        return x[:, :cut], x[:, cut:]

    def bounds(self, x: np.ndarray) -> list[np.ndarray]:
        """For each half and row of ``x``: the largest half score that a member of each word can have."""
        out = []
        for half, words, radii in zip(self.halves(x), self.words, self.radii):
            score, reach = half @ words.T, np.sqrt((half**2).sum(axis=1))[:, None] * radii[None, :]
            out.append(score + reach + 1e-9 * (np.abs(score) + reach) + 1e-6)
        return out


def by_bound(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Cells (places in both lists) by falling sum of their half bounds, from a heap of the frontier."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    heap = [(-(x[0] + y[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(a[i]), int(b[j])
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


# --- scores ----------------------------------------------------------------


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def exact(rows: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a type whose products are exact: doubles up to 2**53, else longs."""
    longest = [math.sqrt((m**2).sum(axis=1).max(initial=0)) for m in (rows, x)]
    kind = np.float64 if longest[0] * longest[1] < _EXACT else np.int64
    return rows.astype(kind, copy=False), x.astype(kind, copy=False)


def _first(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:n]


class Best:
    """The best rows of a range of scores [low, high], as far as cells were visited."""

    def __init__(self, low: float, high: float, n: int):
        self.low, self.high, self.n = low, high, n
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = (scores >= self.low) & (scores <= self.high)
        scores, ids = np.concatenate([self.scores, scores[fit]]), np.concatenate([self.ids, ids[fit]])
        best = _first(scores, ids, self.n)
        self.scores, self.ids = scores[best], ids[best]

    def floor(self) -> float:
        """No row below this score can still get in."""
        return max(self.low, self.scores[-1]) if len(self.scores) == self.n else self.low


def _windows(anchor_scores: list[int] | None, settings: Settings) -> list[Best]:
    """One open window for the positives, or one for each positive's negatives."""
    if anchor_scores is None:
        return [Best(-math.inf, math.inf, settings.positives)]
    return [Best(-(-settings.low * s // 100), s, settings.negatives) for s in sorted(set(anchor_scores)) if s >= 0]


def _wanted(own: int, label: int, ids: np.ndarray, labels: np.ndarray, positive: bool) -> np.ndarray:
    return (labels == label) & (ids != own) if positive else labels != label


def _search(settings: Settings, indexes: dict[int, Index], key, anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """The best rows of one block for some anchors, cell by cell.

    Each anchor visits the block's cells by falling bound and stops when every
    window is certified: what it holds, or its floor, is above the next bound.
    """
    kinds = [pa.int64()] * 5
    names = ["vec_id", "key", "aim", "score", "other_id"]
    out: list[list[np.ndarray]] = [[] for _ in kinds]
    if anchors.num_rows and rows.num_rows:
        x = _matrix(rows.column("x"))
        ids, labels = np.asarray(rows.column("vec_id")), np.asarray(rows.column("label"))
        first, second = np.asarray(rows.column("first")), np.asarray(rows.column("second"))
        ours, ours2 = np.unique(first), np.unique(second)
        cell = np.searchsorted(ours, first) * len(ours2) + np.searchsorted(ours2, second)
        order = np.argsort(cell, kind="stable")
        begin = np.searchsorted(cell[order], np.arange(len(ours) * len(ours2) + 1)).tolist()
        wanted = _matrix(anchors.column("x"))
        bounds = indexes[x.shape[1]].bounds(wanted)
        x, wanted = exact(x, wanted)
        aims = anchors.column("aims").to_pylist()
        floors = np.asarray(anchors.column("floor"))
        columns = [np.asarray(anchors.column(c)) for c in ("vec_id", "key", "label")]
        for k, (own, name, label) in enumerate(zip(*columns)):
            windows = _windows(aims[k], settings)
            held: list[np.ndarray] = []
            waiting = 0

            def look() -> None:
                places = np.concatenate(held)
                places = places[_wanted(own, label, ids[places], labels[places], aims[k] is None)]
                scores = (x[places] @ wanted[k]).astype(np.int64)
                for window in windows:
                    window.add(scores, ids[places])

            needed = max(floors[k], min((w.floor() for w in windows), default=math.inf))
            for bound, i, j in by_bound(bounds[0][k, ours], bounds[1][k, ours2]):
                if bound < needed:
                    break
                a, b = begin[i * len(ours2) + j], begin[i * len(ours2) + j + 1]
                if a < b:
                    held.append(order[a:b])
                    waiting += b - a
                if waiting >= settings.slab:
                    look()
                    held, waiting = [], 0
                    needed = max(floors[k], min(w.floor() for w in windows))
            if held:
                look()
            for window in windows:
                n = len(window.ids)
                aim = 0 if aims[k] is None else int(window.high)
                for column, values in zip(out, (own, name, aim)):
                    column.append(np.full(n, values, np.int64))
                out[3].append(window.scores)
                out[4].append(window.ids)
    arrays = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, kinds)]
    return pa.table(arrays, names)


def _assign(indexes: dict[int, Index], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add each row's codewords and its distances from them."""
    for batch in batches:
        lengths = np.asarray(batch.column("length"))
        for length in np.unique(lengths):
            rows = batch.filter(pa.array(lengths == length))
            index = indexes[int(length)]
            found = [nearest(h, w) for h, w in zip(index.halves(_matrix(rows.column("x"))), index.words)]
            more = [pa.array(c, t) for t, pair in ((pa.int32(), 0), (pa.float64(), 1)) for c in (f[pair] for f in found)]
            yield pa.RecordBatch.from_arrays(rows.columns + more, rows.schema.names + ["first", "second", "far", "far2"])


def _route(indexes, settings: Settings, anchor_blocks: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Send each anchor to the blocks that hold a cell whose bound reaches its floor.

    The floor is the score that a window's last place already has among the sample's rows.
    """
    indexes = indexes.value
    for batch in batches:
        lengths = np.asarray(batch.column("length"))
        for length in np.unique(lengths):
            anchors = batch.filter(pa.array(lengths == length))
            index = indexes[int(length)]
            x, aims = _matrix(anchors.column("x")), anchors.column("aims").to_pylist()
            ids, labels, rows = index.sample
            floors, places, blocks = [], [], []
            bounds = index.bounds(x)
            rows, x = exact(rows, x)
            for k, (own, label) in enumerate(zip(anchors.column("vec_id").to_pylist(), anchors.column("label").to_pylist())):
                windows = _windows(aims[k], settings)
                fit = _wanted(own, label, ids, labels, aims[k] is None)
                scores = (rows @ x[k]).astype(np.int64)[fit]
                for window in windows:
                    window.add(scores, ids[fit])
                floors.append(min((w.floor() for w in windows), default=math.inf))
                mine: set[int] = set()
                for bound, i, j in by_bound(bounds[0][k], bounds[1][k]):
                    if bound < floors[-1]:
                        break
                    start, parts = index.blocks.get((i, j), (0, 0))
                    mine.update(range(start, start + parts))
                blocks += sorted(mine)
                places += [k] * len(mine)
            sent = anchors.take(pa.array(places, pa.int64()))
            part = np.asarray(sent.column("key")).view(np.uint64) % np.uint64(anchor_blocks)
            names = ["length", "block", "part", "vec_id", "key", "label", "x", "aims", "floor"]
            yield pa.RecordBatch.from_arrays(
                [sent.column("length"), pa.array(blocks, pa.int64()), pa.array(part.astype(np.int64))]
                + [sent.column(c) for c in ("vec_id", "key", "label", "x", "aims")]
                + [pa.array(np.array(floors, float)[np.array(places, int)])],
                names,
            )


# --- the job ---------------------------------------------------------------

_ROW = "vec_id long, label long, x array<int>, length int"
_ANCHOR = "length int, block long, part long, vec_id long, key long, label long, x array<int>, aims array<long>, floor double"
_FOUND = "vec_id long, key long, aim long, score long, other_id long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _whole(vectors: DataFrame, settings: Settings) -> DataFrame:
    """Distinct rows that take part, their components as whole numbers."""
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + (F.abs(c) * settings.scale + 1) * (F.abs(c) * settings.scale + 1))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    rows = rows.where(square < LARGEST_SQUARE)
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(settings.scale))).cast("int"))
    return rows.select("vec_id", "label", x.alias("x"), F.size("v").alias("length")).distinct()


def _learn_all(rows: DataFrame, sizes: dict[int, int], settings: Settings) -> dict[int, Index]:
    """Codebooks of every length from about ``sample`` of its rows, drawn by their hash."""
    dealt = F.pmod(F.xxhash64(F.lit("codebook"), "vec_id", "x"), F.lit(1 << 40)) / float(1 << 40)
    share = F.lit(0.0)
    for length, n in sizes.items():
        share = F.when(F.col("length") == length, min(1.0, settings.sample / n)).otherwise(share)
    drawn = rows.where(dealt < share).orderBy("length", "vec_id", "label", "x").toArrow()
    lengths = np.asarray(drawn.column("length"))
    out = {}
    for length, n in sizes.items():
        own = drawn.filter(pa.array(lengths == length))
        x = _matrix(own.column("x")) if own.num_rows else np.zeros((1, length))
        codes = min(settings.most_codes, max(1, round(math.sqrt(n / settings.rows_per_cell))))
        cut = length // 2
        words = tuple(learn(h, codes, settings.rounds) for h in (x[:, :cut], x[:, cut:]))
        known = np.arange(own.num_rows)
        out[length] = Index(words, (np.asarray(own.column("vec_id")), np.asarray(own.column("label")), x[known]))
    return out


def _place(indexes: dict[int, Index], cells: list, settings: Settings) -> list[tuple]:
    """Radii of the codewords, and blocks of about ``block`` rows: small cells share one, large ones get several."""
    for length, index in indexes.items():
        own = [c for c in cells if c.length == length]
        index.radii = tuple(np.full(len(w), -math.inf) for w in index.words)
        for c in own:
            index.radii[0][c.first] = max(index.radii[0][c.first], c.far)
            index.radii[1][c.second] = max(index.radii[1][c.second], c.far2)
        index.radii = tuple(np.where(np.isfinite(r), r, 0) for r in index.radii)
        index.blocks, block, filled = {}, 0, 0
        for c in sorted(own, key=lambda c: (c.first, c.second)):
            if filled and filled + c.n > settings.block:
                block, filled = block + 1, 0
            parts = -(-c.n // settings.block)
            index.blocks[c.first, c.second] = (block, parts)
            filled += c.n
            if parts > 1:
                block, filled = block + parts, 0
    return [(n, i, j, *where) for n, index in indexes.items() for (i, j), where in index.blocks.items()]


def mine(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Hard negatives of every anchor and positive among ``vectors`` (vec_id, label, embedding).

    Components become floor(scale * c); a row's score is its inner product with
    the anchor, a whole number. Higher scores come first, ties by smaller id.
    Anchors are the rows whose id is divisible by ``every``; an anchor's
    positives are the first rows of its label with another id, a positive's negatives the
    first rows of other labels whose score is ``low`` to 100 hundredths of the positive's.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score. A positive without negatives gives no row.

    The result is exact. Vectors are halved; codebooks learned from a bounded
    sample put every row in a cell (word of the first half, of the second). A half's
    score is at most that of its word plus the anchor's length times the word's radius, so
    cells are visited by the sum of both bounds from a heap, until each window
    is certified. Cells lie in blocks of bounded size, large ones in several;
    anchors meet only the blocks that hold a cell whose bound reaches the floor known from
    the sample. How much that spares depends on the data: of structureless vectors
    nearly all blocks are met, the search then being one of the stated queries against
    all rows, in blocks. The driver holds the sample and the cells (``most_codes`` squared
    for each length of vectors).

    Take no part: null ids, labels and vectors, vectors holding a null or a number that is
    not finite, and those whose whole numbers' squares reach 2**55. Equal rows count
    once. Vectors are compared with those of their own length. Other columns are
    not read; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = stored(_whole(vectors, settings), "negatives-rows")
    sizes = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], RESULT)
    indexes = _learn_all(rows, sizes, settings)
    cellular = map_arrow(rows, partial(_assign, indexes), f"{_ROW}, first int, second int, far double, far2 double")
    cellular = stored(cellular, "negatives-cells")
    cells = cellular.groupBy("length", "first", "second").agg(
        F.count("*").alias("n"), F.max("far").alias("far"), F.max("far2").alias("far2")
    )
    places = _place(indexes, cells.collect(), settings)
    where = spark.createDataFrame(places, "length int, first int, second int, start long, parts long")
    spread = F.col("start") + F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.col("parts"))
    located = cellular.join(small(where), ["length", "first", "second"]).select(
        "length", spread.alias("block"), "vec_id", "label", "x", "first", "second"
    )

    anchors = rows.where(F.col("vec_id") % settings.every == 0).withColumn("key", F.xxhash64("label", "x"))
    anchor_blocks = max(1, -(-anchors.count() // settings.anchor_block))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(anchor_blocks - 1).cast("long")))
    tasks = width(spark, sum(sizes.values()) * anchor_blocks, settings.block * 4)
    dealt = located.select("*", each.alias("part")).repartition(tasks, "length", "block", "part")
    known = spark.sparkContext.broadcast(indexes)
    slim = {n: Index(i.words, (), i.radii) for n, i in indexes.items()}

    def best(asked: DataFrame, n: int, by: list[str]) -> DataFrame:
        """The first ``n`` rows of each window of the anchors' ``aims``."""
        routed = map_arrow(asked, partial(_route, known, settings, anchor_blocks), _ANCHOR)
        keys = ["length", "block", "part"]
        met = routed.repartition(tasks, *keys).groupBy(*keys).cogroup(dealt.groupBy(*keys))
        found = met.applyInArrow(partial(_search, settings, slim), _FOUND)
        order: Column = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "other_id"))
        return found.withColumn("rank", order).where(F.col("rank") <= n)

    open_ended = anchors.withColumn("aims", F.lit(None).cast("array<long>"))
    positives = stored(best(open_ended, settings.positives, ["vec_id", "key"]).drop("aim"), "negatives-positives")
    aims = positives.groupBy("vec_id", "key").agg(F.collect_list("score").alias("aims"))
    negatives = best(anchors.join(aims, ["vec_id", "key"]), settings.negatives, ["vec_id", "key", "aim"])
    pairs = positives.select("vec_id", "key", F.col("score").alias("aim"), F.col("other_id").alias("positive_id"))
    return pairs.join(negatives, ["vec_id", "key", "aim"]).select(
        F.col("vec_id").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("other_id").alias("negative_id"),
        F.col("aim").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", label.alias("label"), "embedding"))


OP12_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
    CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON b.vec_id <> a.vec_id OR b.label <> a.label
  WHERE a.vec_id % 100 = 0
),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

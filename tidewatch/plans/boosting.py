"""Boosted trees grown level by level from aggregated histograms.

Rows are binned once and kept in blocks. For every level of every round one Spark job
sums the gradients of each (model, node, feature, bin) where the blocks lie; the driver
combines the tasks' sums, whose size does not depend on the number of rows (those of many
tasks meet in a tree first), and picks each node's split. All models of a cross-validation
grow in the same jobs. Of two children only the smaller one's rows are added up: the
other's sums are what is left of their parent's. The blocks are an RDD: some 1500 short jobs
pass over them, for each of which a DataFrame's planning would take longer than the work.

Nothing depends on how rows lie in partitions: draws come from hashes of the
row's id and the round, gradients are summed as whole numbers.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import work_folder

#: Bin of a missing value; the others are 0 .. MISSING - 1.
MISSING = 255
_BINS = MISSING + 1
#: Rows of a block: as many as leave its sums in doubles exact, since each call of numpy costs the same for few.
_CHUNK = 1 << 16
#: The margins follow from those of the round before, and every so many rounds from those of as many
#: rounds ago and the trees since, which keeps their lineage short.
_REFRESH = 20
#: Features of few bins are added up together, by all their bins at once: up to so many.
_PACKED = 1_024
#: Nodes whose splits are tried at once: their sums stay in the cache.
_TRIED = 8
#: Rows for which a further task pays, and rows that one task should not exceed.
_TASK_ROWS = (20_000, 1_000_000)
#: Tasks whose sums the driver combines itself.
_FEW_TASKS = 64
#: Rows of the sample for the bins that tell which of two children is the smaller.
_SCOUTS = 8_192


@dataclass(frozen=True)
class Growth:
    """How trees grow. ``ridge`` and ``least_weight`` are the usual L2 term and the least sum
    of second derivatives in a child; ``edge_rows`` bounds the rows (drawn by id)
    whose values give the bins' edges."""

    rounds: int = 300
    depth: int = 5
    step: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.8
    ridge: float = 1.0
    least_weight: float = 1.0
    edge_rows: int = 50_000
    seed: int = 42


@dataclass
class Trees:
    """Complete trees of equal depth as arrays, children of node i at 2 i + 1 and 2 i + 2.

    A row goes left if its value is below ``threshold``, or is missing and ``left``
    says so. A node that is not split has ``feature`` -1 and sends all rows left. ``value`` holds
    the bottom nodes' margins, ``cover`` the second derivatives that reached each node,
    ``gain`` what each split won.
    """

    names: list[str]
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    value: np.ndarray

    @property
    def getNumTrees(self) -> int:  # noqa: N802  (the name that Spark's tree models have)
        return len(self.feature)

    @property
    def depth(self) -> int:
        return (self.feature.shape[1] + 1).bit_length() - 1

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Sum of the trees' values for rows of ``x``; missing values are NaN."""
        total = np.zeros(len(x))
        columns = np.ascontiguousarray(x.T)
        for tree, value in enumerate(self.value):
            total += value[places(partial(self.goes_right, columns, tree), self.depth, len(x))]
        return total

    def goes_right(self, columns: np.ndarray, tree: int, node: int) -> np.ndarray | None:
        """Which rows (``columns``: feature by row) a node sends right; None if it is not split."""
        f = self.feature[tree, node]
        if f < 0:
            return None
        at = self.threshold[tree, node]
        return columns[f] >= at if self.left[tree, node] else ~(columns[f] < at)

    def importances(self) -> dict[str, float]:
        """Each feature's share of all gains."""
        sums = np.zeros(len(self.names))
        split = self.feature >= 0
        np.add.at(sums, self.feature[split], self.gain[split])
        return dict(zip(self.names, (sums / max(sums.sum(), 1e-300)).tolist()))

    def to_json(self) -> str:
        arrays = {k: v.tolist() for k, v in vars(self).items() if k != "names"}
        return json.dumps({"names": self.names, **arrays})

    @classmethod
    def from_json(cls, text: str) -> Trees:
        held = json.loads(text)
        kinds = {"feature": np.int16, "left": bool}
        depth_free = {k: np.array(v, kinds.get(k, np.float64)) for k, v in held.items() if k != "names"}
        return cls(held["names"], **depth_free)


def places(goes_right: Callable[[int], np.ndarray | None], depth: int, count: int) -> np.ndarray:
    """Each row's node of the level ``depth`` below the root, counted from the level's first.

    From the bottom up, every node chooses between its children's answers for all rows at once.
    """
    kind = np.uint8 if depth <= 8 else np.uint32

    def below(node: int, levels: int):
        if not levels:
            return 0
        left = below(2 * node + 1, levels - 1)
        right = goes_right(node)
        if right is None:
            return left
        right = right.view(np.uint8).astype(kind, copy=False)
        if levels == 1:
            return right
        other = below(2 * node + 2, levels - 1) + kind(1 << levels - 1)
        return left ^ ((left ^ other) & np.negative(right))

    found = below(0, depth)
    return np.full(count, found, kind) if isinstance(found, int) else found


# --- bins ------------------------------------------------------------------


def _key() -> Column:
    return F.xxhash64(F.coalesce("transaction_id", F.lit("")))


def sampled(rows: DataFrame, names: Sequence[str], growth: Growth) -> np.ndarray:
    """About ``edge_rows`` rows (by feature), drawn by id: the same whatever the partitioning."""
    n = rows.count()
    drawn = F.pmod(F.xxhash64(_key(), F.lit(f"edges{growth.seed}")), F.lit(1 << 30)) < growth.edge_rows / max(n, 1) * (1 << 30)
    sample = rows.where(drawn).select(*names).toArrow()
    return np.array([sample.column(c).fill_null(math.nan).to_numpy() for c in names], np.float64)


def edges(sample: np.ndarray) -> list[np.ndarray]:
    """For each feature of ``sample`` the values from which its bins begin, at most 254: quantiles."""
    out = []
    for known in sample:
        known = np.sort(known[~np.isnan(known)] + 0.0)  # one zero, whatever the order of rows
        distinct = np.unique(known)
        if len(distinct) > MISSING:
            distinct = np.unique(known[(np.arange(1, MISSING) * len(known)) // MISSING])
        else:
            distinct = distinct[1:]
        out.append(distinct[: MISSING - 1])
    return out


def binned(columns: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The bin of each value, feature by row."""
    bins = np.array([np.searchsorted(cut, x, "right") for cut, x in zip(cuts, columns)], np.uint8)
    bins[np.isnan(columns)] = MISSING
    return bins


def values(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Features as columns of doubles; a null is NaN."""
    columns = [batch.column(c).fill_null(math.nan).to_numpy(zero_copy_only=False) for c in names]
    return np.column_stack(columns).astype(np.float64) if columns else np.zeros((batch.num_rows, 0))


_STORED = "size int, key binary, label binary, fold binary, bins binary"


@dataclass
class Block:
    """Up to ``_CHUNK`` rows in the order of their folds: hash of the id (mixed), label, fold, bins (feature
    by row), and the margin under each model (model by row; None: all zero)."""

    key: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    bins: np.ndarray
    margins: np.ndarray | None = None


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of ``_CHUNK``, the last one of what is left."""
    held, rows = [], 0
    for batch in batches:
        while rows + batch.num_rows >= _CHUNK:
            yield pa.concat_batches([*held, batch.slice(0, _CHUNK - rows)])
            batch, held, rows = batch.slice(_CHUNK - rows), [], 0
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
    if held:
        yield pa.concat_batches(held)


def _bin(names: Sequence[str], cuts: list[np.ndarray], batches: Iterator[pa.RecordBatch]):
    """Rows to blocks of bytes."""
    for part in chunks(batches):
        fold = np.asarray(part.column("fold")).astype(np.int8)
        order = np.argsort(fold, kind="stable")
        columns = [
            _mix(np.asarray(part.column("key"))[order].view(np.uint64)),
            np.asarray(part.column("label")).astype(np.uint8)[order],
            fold[order],
            binned(values(part, names)[order].T, cuts),
        ]
        held = [pa.array([c.tobytes()], pa.binary()) for c in columns]
        yield pa.RecordBatch.from_arrays(
            [pa.array([part.num_rows], pa.int32()), *held], ["size", "key", "label", "fold", "bins"]
        )


def _block(row) -> Block:
    return Block(
        np.frombuffer(row.key, np.uint64),
        np.frombuffer(row.label, np.uint8),
        np.frombuffer(row.fold, np.int8),
        np.frombuffer(row.bins, np.uint8).reshape(-1, row.size),
    )


# --- one level -------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn(key: np.ndarray, round_: int, growth: Growth) -> np.ndarray:
    return _drawn_mixed(_mix(key), round_, growth)


def _drawn_mixed(key: np.ndarray, round_: int, growth: Growth) -> np.ndarray:
    salt = np.array([growth.seed * 1_000_003 + round_], np.uint64)
    return _mix(key + _mix(salt)) < np.uint64(min(int(growth.row_share * 2**64), 2**64 - 1))


def drawn_features(count: int, round_: int, growth: Growth) -> list[int]:
    """The features that a round's tree may split on."""
    salt = np.arange(count, dtype=np.uint64) + np.uint64(growth.seed * 7_919 + round_ * 104_729)
    taken = max(1, int(growth.feature_share * count))
    return sorted(np.argsort(_mix(_mix(salt)), kind="stable")[:taken].tolist())


@dataclass
class Growing:
    """The tree that a model grows in this round: splits so far, by node."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray

    def nodes(
        self, bins: np.ndarray | Mapping[int, np.ndarray], raised: np.ndarray | Mapping[int, np.ndarray], level: int, count: int
    ) -> np.ndarray:
        """Each row's node of the level, counted from the level's first; ``raised``: one more than ``bins``."""
        return places(partial(self._goes_right, bins, raised), level, count)

    def _goes_right(
        self, bins: np.ndarray | Mapping[int, np.ndarray], raised: np.ndarray | Mapping[int, np.ndarray], node: int
    ) -> np.ndarray | None:
        f, cut = int(self.feature[node]), np.uint8(self.cut[node])
        if f < 0:
            return None
        # one more than MISSING is 0, which goes left
        return raised[f] > cut + np.uint8(1) if self.left[node] else bins[f] > cut


def packs(features: Sequence[int], counts: Sequence[int]) -> list[list[int]]:
    """The features in groups that are added up together. ``counts`` gives every feature's places: its
    bins and the missing; those of a group multiply to at most ``_PACKED``."""
    out: list[list[int]] = []
    for f in sorted(features, key=lambda f: (counts[f], f)):
        if out and math.prod(counts[g] for g in out[-1]) * counts[f] <= _PACKED:
            out[-1].append(f)
        else:
            out.append([f])
    return out


@dataclass
class Level:
    """One job: which sums of first and second derivatives it adds up.

    ``slots`` gives each (model, node of the level) its place in the sums, -1 if they are not
    asked for; a model's places follow on each other. ``counts`` are the features' places, the
    missing behind the bins. The sums' axes: derivative, slot, and the places of all drawn
    features one after the other.
    """

    growth: Growth
    round_: int
    level: int
    features: list[int]
    counts: list[int]
    growing: list[Growing]
    slots: np.ndarray
    digits: int

    def sums(self, blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        """The sums of a task's blocks; nothing without rows."""
        groups = packs(self.features, self.counts)
        shapes = [tuple(self.counts[f] for f in group) for group in groups]
        totals = None
        for block in blocks:
            if totals is None:
                slots = int(self.slots.max()) + 1
                totals = [np.zeros((2, slots * math.prod(shape)), np.int64) for shape in shapes]
            self._add(totals, block, groups)
        if totals is not None:
            alone = {}
            for group, shape, total in zip(groups, shapes, totals):
                whole = total.reshape(2, -1, *shape)
                for k, f in enumerate(group, 2):
                    alone[f] = whole.sum(axis=tuple(a for a in range(2, whole.ndim) if a != k))
            yield np.concatenate([alone[f] for f in self.features], axis=2)

    def _add(self, totals: list[np.ndarray], block: Block, groups: list[list[int]]) -> None:
        drawn = np.flatnonzero(_drawn_mixed(block.key, self.round_, self.growth))
        bins = {f: block.bins[f].take(drawn) for f in self.features}
        label, fold = block.label.take(drawn), block.fold.take(drawn)
        raised = {f: own + np.uint8(1) for f, own in bins.items()}
        columns = [self._places(bins, group) for group in groups]
        # where each fold's rows begin; of the folds' own type, as they would be converted whole for each search
        begin = np.searchsorted(fold, np.arange(-1, len(self.growing), dtype=np.int8))
        for m, tree in enumerate(self.growing):
            asked = self.slots[m][self.slots[m] >= 0]
            if not len(asked):
                continue
            first = int(asked.min())
            out = slice(begin[m], begin[m + 1])  # the rows left out
            if not self.level:  # all rows but those left out, as they lie
                margin = self._margin(block, m, drawn)
                for own in (slice(0, out.start), slice(out.stop, len(drawn))):
                    derivatives = self._derivatives(margin[own], label[own])
                    self._count(totals, first, (place[own] for place in columns), derivatives, 1)
                continue
            slot = self.slots[m].take(tree.nodes(bins, raised, self.level, len(drawn)))
            slot[out] = -1
            rows = np.flatnonzero(slot >= 0)
            base = slot.take(rows).astype(np.int64) - first
            derivatives = self._derivatives(self._margin(block, m, drawn.take(rows)), label.take(rows))
            by_group = self._by_slot(columns, rows, base, totals)
            self._count(totals, first, by_group, derivatives, len(asked))

    def _margin(self, block: Block, m: int, rows: np.ndarray) -> np.ndarray:
        return np.zeros(len(rows)) if block.margins is None else block.margins[m].take(rows)

    def _places(self, bins: Mapping[int, np.ndarray], group: list[int]) -> np.ndarray:
        """Each row's place among those of a group, the last feature's running fastest."""
        place = 0
        for k, f in enumerate(group):
            after = math.prod(self.counts[g] for g in group[k + 1 :])
            if self.counts[f] == _BINS and after == 1:  # the missing are behind the bins as they are
                place = place + bins[f].astype(np.int64)
            else:
                table = np.arange(_BINS) * after
                table[MISSING] = (self.counts[f] - 1) * after
                place = place + table.take(bins[f])
        return place

    def _by_slot(
        self, columns: list[np.ndarray], rows: np.ndarray, base: np.ndarray, totals: list[np.ndarray]
    ) -> Iterator[np.ndarray]:
        """The places of ``rows`` in the sums of their slots; one array, filled anew for each group."""
        held = np.empty(len(rows), np.int64)
        slots, scaled, width = int(self.slots.max()) + 1, None, 0
        for place, total in zip(columns, totals):
            own = total.shape[1] // slots
            if own != width:
                scaled, width = base * own, own
            np.take(place, rows, out=held, mode="clip")
            held += scaled
            yield held

    def _derivatives(self, margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one = float(1 << self.digits)
        p = 1.0 / (1.0 + np.exp(-margin))
        return np.rint((p - label) * one), np.rint(np.maximum(p * (1.0 - p), 1e-16) * one)

    def _count(
        self, totals: list[np.ndarray], first: int, by_group: Iterable[np.ndarray], derivatives: Sequence[np.ndarray], slots: int
    ) -> None:
        every = int(self.slots.max()) + 1
        for total, place in zip(totals, by_group):
            width = total.shape[1] // every
            begin, size = first * width, slots * width
            for own, weights in zip(total, derivatives):
                own[begin : begin + size] += np.bincount(place, weights, size).astype(np.int64)


def _summed(blocks: RDD, job: Level, tasks: int) -> np.ndarray | None:
    """The sums of all blocks by derivative, slot, feature and bin; None without rows."""
    parts = blocks.mapPartitions(job.sums)
    sums = parts.fold(0, add) if tasks <= _FEW_TASKS else parts.treeAggregate(0, add, add)
    if isinstance(sums, int):
        return None
    out = np.zeros((*sums.shape[:2], len(job.features), _BINS), np.int64)
    begin = 0
    for k, f in enumerate(job.features):
        bins = job.counts[f] - 1
        out[:, :, k, :bins] = sums[:, :, begin : begin + bins]
        out[:, :, k, MISSING] = sums[:, :, begin + bins]
        begin += bins + 1
    return out


@dataclass
class Split:
    """Of every open node: the split that wins most, feature -1 if none wins
    anything, and both derivatives' sums in the node and in its left child."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    whole: np.ndarray
    below: np.ndarray


def best_splits(sums: np.ndarray, features: list[int], growth: Growth, digits: int) -> Split:
    """Try each bin's end, with missing values left and right of it; the first of equal gains wins.

    ``sums``: derivative, node, feature, bin.
    """
    tried = [_best(sums[:, k : k + _TRIED], features, growth, digits) for k in range(0, sums.shape[1], _TRIED)]
    return Split(*(np.concatenate([getattr(t, field) for t in tried]) for field in Split.__dataclass_fields__))


def _best(sums: np.ndarray, features: list[int], growth: Growth, digits: int) -> Split:
    scale = float(1 << digits)
    whole = sums[:, :, 0].sum(axis=2) / scale
    known = np.cumsum(sums[..., :MISSING], axis=3) / scale
    missing = sums[..., MISSING:] / scale
    # derivative, node, missing left, feature, cut
    tried = np.stack([known, known + missing], axis=2) if missing.any() else known[:, :, None]
    rest = whole[:, :, None, None, None] - tried
    score = lambda x: x[0] ** 2 / (x[1] + growth.ridge)
    gain = score(tried) + score(rest) - score(whole)[:, None, None, None]
    gain[(tried[1] < growth.least_weight) | (rest[1] < growth.least_weight)] = -math.inf
    flat = gain.reshape(len(gain), -1)
    place = flat.argmax(axis=1)
    node = np.arange(len(gain))
    won = flat[node, place]
    left, feature, cut = np.unravel_index(place, gain.shape[1:])
    below = tried[:, node, left, feature, cut]
    feature = np.where(won > 1e-6, np.array(features)[feature], -1)
    return Split(feature, cut, left == 1, won, whole.T, below.T)


def _advance(made: list[tuple[list[Growing], list[np.ndarray]]], depth: int, block: Block) -> Block:
    """Add the trees of some rounds to the margins."""
    count, raised = len(block.key), block.bins + np.uint8(1)
    margins = np.zeros((len(made[0][0]), count)) if block.margins is None else block.margins.copy()
    for growing, added in made:
        for own, tree, value in zip(margins, growing, added):
            own += value[tree.nodes(block.bins, raised, depth, count)]
    return Block(block.key, block.label, block.fold, block.bins, margins)


# --- all rounds ------------------------------------------------------------


def _grow_round(
    blocks: RDD, tasks: int, scouts: np.ndarray, counts: list[int], growth: Growth, round_: int, models: int, digits: int
):
    """One tree for each model: the finished splits, bottom values, covers and gains."""
    inner, bottom = (1 << growth.depth) - 1, 1 << growth.depth
    growing = [Growing(np.full(inner, -1, np.int16), np.zeros(inner, np.int16), np.ones(inner, bool)) for _ in range(models)]
    gains = np.zeros((models, inner))
    reached = np.zeros((models, inner + bottom, 2))  # sums of both derivatives
    features, raised = drawn_features(len(scouts), round_, growth), scouts + np.uint8(1)
    # the open (model, node) of the level, children side by side, and which of them are added up
    opened, asked = [(m, 0) for m in range(models)], np.arange(models)
    parents, held = np.zeros(0, int), None
    for level in range(growth.depth):
        slots = np.full((models, 1 << level), -1, np.int16)
        for slot, place in enumerate(asked):
            slots[opened[place]] = slot
        sums = _summed(blocks, Level(growth, round_, level, features, counts, growing, slots, digits), tasks)
        if sums is None:  # no rows
            break
        if held is not None:
            whole = np.empty((2, len(opened), *sums.shape[2:]), np.int64)
            whole[:, asked] = sums
            whole[:, asked ^ 1] = held[:, parents] - sums
            sums = whole
        split = best_splits(sums, features, growth, digits)
        for at, (m, k) in enumerate(opened):
            node, tree = (1 << level) - 1 + k, growing[m]
            reached[m, node] = split.whole[at]
            if split.feature[at] < 0:
                continue
            tree.feature[node], tree.cut[node], tree.left[node] = split.feature[at], split.cut[at], split.left[at]
            gains[m, node] = split.gain[at]
            reached[m, 2 * node + 1] = split.below[at]
            reached[m, 2 * node + 2] = split.whole[at] - split.below[at]
        held, parents = sums, np.flatnonzero(split.feature >= 0)
        if not len(parents):
            break
        met = [np.bincount(t.nodes(scouts, raised, level + 1, scouts.shape[1]), minlength=2 << level) for t in growing]
        smaller = [int(met[m][2 * k] > met[m][2 * k + 1]) for m, k in (opened[p] for p in parents)]
        opened = [(m, 2 * k + side) for m, k in (opened[p] for p in parents) for side in (0, 1)]
        asked = 2 * np.arange(len(parents)) + smaller
    for m, tree in enumerate(growing):
        for node in range(inner):  # what is not split goes left as it is
            if tree.feature[node] < 0:
                reached[m, 2 * node + 1] = reached[m, node]
    added = [-growth.step * reached[m, inner:, 0] / (reached[m, inner:, 1] + growth.ridge) for m in range(models)]
    return growing, added, reached[:, :, 1], gains


def _tasks(spark: SparkSession, rows: int) -> int:
    """As many as there are cores, or whole rounds of them."""
    few, most = _TASK_ROWS
    cores = spark.sparkContext.defaultParallelism
    return max(min(cores, -(-rows // few)), -(-rows // (most * cores)) * cores if rows > most * cores else 1)


def grow(rows: DataFrame, names: Sequence[str], folds: int, growth: Growth) -> tuple[list[Trees], DataFrame]:
    """Grow one model on all ``rows`` and one without each fold.

    ``rows``: transaction_id, label (0 or 1), fold (0 .. folds - 1) and the features
    ``names`` as doubles, null or NaN where unknown. Returns the models (that of all rows first)
    and a stored table (fold, label, margin) of every row's margin
    under the model that has not seen it (without folds: the model of all rows).

    A lost executor costs its blocks' rounds since the last refresh.
    """
    spark = rows.sparkSession
    models = 1 + folds
    sample = sampled(rows, names, growth)
    cuts = edges(sample)
    scouts = binned(sample[:, :_SCOUTS], cuts)
    counts = [len(cut) + 2 for cut in cuts]
    path = work_folder(spark, "boosting")
    keyed = rows.select(_key().alias("key"), F.col("label").cast("int").alias("label"), F.col("fold").cast("int"), *names)
    n = keyed.count()
    dealt = keyed.repartition(_tasks(spark, n))
    dealt.mapInArrow(partial(_bin, list(names), cuts), _STORED).write.parquet(path)
    digits = max(1, min(36, 62 - n.bit_length()))
    stored = spark.read.schema(_STORED).option("recursiveFileLookup", "true").parquet(path)
    # kept as the bytes that the tasks read: some 1500 jobs need not decompress them
    level = StorageLevel.MEMORY_AND_DISK_DESER
    bins = stored.rdd.map(_block).coalesce(_tasks(spark, n)).persist(level)
    tasks = bins.getNumPartitions()
    blocks = base = bins  # the margins of the last round, and of the last that is a multiple of _REFRESH
    made: list[tuple] = []
    older: list[RDD] = []
    for round_ in range(growth.rounds):
        made.append(_grow_round(blocks, tasks, scouts, counts, growth, round_, models, digits))
        while older:  # the job above has filled its successor
            older.pop().unpersist()
        if blocks is not base:
            older.append(blocks)
        again = (round_ + 1) % _REFRESH == 0
        steps = [(growing, added) for growing, added, *_ in made[-(_REFRESH if again else 1) :]]
        blocks = (base if again else blocks).map(partial(_advance, steps, growth.depth)).persist(level)
        if again:
            if base is not bins:
                older.append(base)
            base = blocks
    path = work_folder(spark, "boosting-margins")
    unseen = blocks.mapPartitions(_unseen).toDF("fold int, label int, margin double")
    unseen.write.parquet(path)
    for held in (*older, blocks, base, bins):
        held.unpersist()
    unseen = spark.read.schema("fold int, label int, margin double").parquet(path)
    return [_assembled(made, m, names, cuts, growth) for m in range(models)], unseen


def _unseen(blocks: Iterator[Block]) -> Iterator[tuple[int, int, float]]:
    for block in blocks:
        if block.margins is None:  # no rounds
            margins = np.zeros(len(block.key))
        else:
            own = np.minimum(block.fold.astype(int) + 1, len(block.margins) - 1)
            margins = block.margins[own, np.arange(len(own))]
        yield from zip(block.fold.tolist(), block.label.tolist(), margins.tolist())


def _assembled(made: list[tuple], m: int, names: Sequence[str], cuts: list[np.ndarray], growth: Growth) -> Trees:
    """Bin numbers back to values, rounds to arrays."""
    inner, bottom = (1 << growth.depth) - 1, 1 << growth.depth
    none = np.zeros((0, inner))
    if not made:
        return Trees(list(names), none.astype(np.int16), none, none.astype(bool), none, np.zeros((0, inner + bottom)), np.zeros((0, bottom)))
    feature = np.array([growing[m].feature for growing, *_ in made], np.int16)
    cut = np.array([growing[m].cut for growing, *_ in made])
    threshold = np.full(feature.shape, math.inf)
    for place in np.argwhere(feature >= 0):
        edge = cuts[feature[tuple(place)]]
        at = cut[tuple(place)]
        # a split behind the last bin parts the missing from all the others
        threshold[tuple(place)] = edge[at] if at < len(edge) else math.inf
    return Trees(
        list(names),
        feature,
        threshold,
        np.array([growing[m].left for growing, *_ in made]),
        np.array([gains[m] for *_, gains in made]),
        np.array([covers[m] for _, _, covers, _ in made]),
        np.array([values[m] for _, values, _, _ in made]),
    )

"""N-gram Jaccard join of documents by universe partition (operator 9)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewatch.llm.common import WORD, fresh, map_arrow, ship, small, stored, table, width
from tidewatch.llm.components import components
from tidewatch.llm.lm_scoring import pack, pack_sorted, unpack, unpack_sorted
from tidewatch.llm.set_signatures import PROBE, SKETCH, Threshold, parity, signatures
from tidewatch.llm.words import U64, shingle_hashes, slices, splitmix, text_bytes, word_hashes

#: All pairs of a bucket are candidates up to this size; larger ones go by pivots.
SMALL_BUCKET = 24
#: Pivots of a large bucket in each round after the first, which takes one.
PIVOTS = 4096
#: Sets of up to so many elements together are told apart well enough by their parities.
PARITY_TOTAL = 2000
SKETCH_PART = 1 << 16
PARITY_WORDS = 16
#: Sets of more elements have a second, wider parity, as theirs fill the first.
WIDE_FROM, WIDE_WORDS = 1500, 128
ROWS_PER_TASK = 2_000_000
BATCH_ROWS = 200_000

PARITY = [f"p{k}" for k in range(PARITY_WORDS)]
OUTLINE = [*PARITY, "wide"]
INFO = "doc_id long, n_shingles long, set_id long, " + ", ".join(f"{p} long" for p in PARITY) + ", wide array<long>, part int, counts binary"
#: The lowest bit of sig tells whether the row probes.
SIGNATURE = "sig long, set_id long"
FOUND = "a long, b long, sig long, probe boolean"
CONTENT = "set_id long, content binary"
#: Cells of the histogram that large sets are compared by before their elements.
CELLS = 1024


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row in order, and where each row's begin."""
    words, begin = word_hashes(*text_bytes(column))
    shingles, begin = shingle_hashes(words, begin, size)
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    keep = np.ones(len(shingles), bool)
    keep[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[keep], np.searchsorted(owner[keep], np.arange(len(begin)))


def set_ids(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set's content."""
    sums = np.concatenate([[U64(0)], np.cumsum(splitmix(shingles), dtype=U64)])
    sizes = np.diff(starts).astype(np.uint64)
    return splitmix(sums[starts[1:]] - sums[starts[:-1]] + sizes).view(np.int64)


def _parts(size: int, place: int, batches: Iterator[pa.RecordBatch]):
    """Slices of the batches with their shingle sets."""
    for whole in batches:
        _, bounds = text_bytes(whole.column(place))
        for start, end in slices(bounds):
            part = whole.slice(start, end - start)
            yield part, *shingle_sets(part.column(place), size)


def _describe(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and name of each row's set; at the end the task's sketch of shingle frequencies."""
    sketch = np.zeros(SKETCH, np.int32)
    names = ["doc_id", "n_shingles", "set_id", *PARITY, "wide", "part", "counts"]
    for part, shingles, starts in _parts(size, 1, batches):
        sketch += np.bincount((shingles & U64(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.int32)
        bits = parity(shingles, starts, 64 * PARITY_WORDS).view(np.int64)
        n = part.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.array(np.diff(starts)),
                pa.array(set_ids(shingles, starts)),
                *(pa.array(np.ascontiguousarray(bits[:, k])) for k in range(PARITY_WORDS)),
                _wide(shingles, starts),
                pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.binary()),
            ],
            names,
        )
    if sketch.any():
        packed = [pack(sketch[k : k + SKETCH_PART]) for k in range(0, SKETCH, SKETCH_PART)]
        n = len(packed)
        empty = [*[pa.nulls(n, pa.int64())] * (3 + PARITY_WORDS), pa.nulls(n, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(range(n), pa.int32()), pa.array(packed, pa.binary())], names)


def _wide(shingles: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The wider parity of the large sets, null for the others."""
    out: list[np.ndarray | None] = [None] * (len(starts) - 1)
    for k in np.flatnonzero(np.diff(starts) > WIDE_FROM):
        part = shingles[starts[k] : starts[k + 1]]
        out[k] = parity(part, np.array([0, len(part)]), 64 * WIDE_WORDS).view(np.int64)[0]
    return pa.array(out, pa.list_(pa.int64()))


def _add_sketches(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of one part of all tasks' sketches, a batch at a time."""
    total = np.zeros(SKETCH_PART, np.int64)
    for batch in batches:
        for x in batch.column("counts"):
            total += unpack(x.as_py(), np.int32)
    columns = [pa.array([key[0].as_py()], pa.int32()), pa.array([pack(total)], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["part", "counts"])


def _sign(size: int, threshold: Threshold, sketch, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signature rows of the distinct sets of each slice."""
    for _, shingles, starts in _parts(size, 0, batches):
        names = set_ids(shingles, starts)
        _, first = np.unique(names, return_index=True)
        row, sig, kind = signatures(shingles, starts, sketch.value, threshold)
        mine = np.isin(row, first)
        row, probe = row[mine], (kind[mine] >= PROBE).astype(np.uint64)
        sig = ((sig[mine] & ~U64(1)) | probe).view(np.int64)
        for at in range(0, len(row), BATCH_ROWS):
            cut = slice(at, at + BATCH_ROWS)
            yield pa.RecordBatch.from_arrays([pa.array(sig[cut]), pa.array(names[row[cut]])], ["sig", "set_id"])


def _bucket_pairs(set_id, probes, starts, lengths) -> np.ndarray:
    """Distinct candidate pairs (smaller, larger) within small buckets, one of each pair probing."""
    found = []
    for length in np.unique(lengths):
        at = starts[lengths == length][:, None] + np.arange(length)
        for i in range(length - 1):
            for j in range(i + 1, length):
                a, b = at[:, i], at[:, j]
                good = (probes[a] | probes[b]) & (set_id[a] != set_id[b])
                a, b = set_id[a[good]], set_id[b[good]]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
    return np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a, b) of small buckets and members (a, sig, probe) of large ones.

    The rows come in order of sig. Only a bucket's first rows are ever kept from
    one batch to the next: those of a large one go out as they come. A bucket
    in which nothing probes is of no use.
    """
    waiting = [np.zeros(0, np.int64)] * 3
    large: int | None = None
    names = ["a", "b", "sig", "probe"]

    def members(rows: list[np.ndarray], chosen: np.ndarray) -> pa.RecordBatch:
        sig, set_id, probe = (r[chosen] for r in rows)
        nothing = pa.nulls(len(sig), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(set_id), nothing, pa.array(sig), pa.array(probe == 1)], names)

    def finish(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sig, set_id, probe = rows
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        lengths = np.diff(np.append(starts, len(sig)))
        useful = (lengths > 1) & (np.maximum.reduceat(probe, starts) == 1)
        big = np.repeat(useful & (lengths > SMALL_BUCKET), lengths)
        if big.any():
            yield members(rows, big)
        few = useful & (lengths <= SMALL_BUCKET)
        if few.any():
            pairs = _bucket_pairs(set_id, probe == 1, starts[few], lengths[few])
            n = pairs.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[0]), pa.array(pairs[1]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_())], names
            )

    for batch in batches:
        sig, set_id = (np.asarray(c) for c in batch.columns)
        rows = [sig >> 1, set_id, sig & 1]
        if large is not None:
            more = int(np.searchsorted(rows[0], large, "right"))
            if more:
                yield members(rows, np.arange(len(rows[0])) < more)
            rows = [r[more:] for r in rows]
        rows = [np.concatenate(x) for x in zip(waiting, rows)]
        if not len(rows[0]):
            continue
        large = None
        last = int(np.searchsorted(rows[0], rows[0][-1]))
        if last:
            yield from finish([r[:last] for r in rows])
        waiting = [r[last:] for r in rows]
        if len(waiting[0]) > SMALL_BUCKET:
            large = int(waiting[0][0])
            yield members(waiting, np.ones(len(waiting[0]), bool))
            waiting = [r[:0] for r in rows]
    if len(waiting[0]):
        yield from finish(waiting)


def _made(size: int, pack_set: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted sets as ``pack_set`` gives them, from rows (text, wanted set_id)."""
    for part, shingles, starts in _parts(size, 0, batches):
        names = set_ids(shingles, starts)
        keep = np.flatnonzero(names == np.asarray(part.column(1)))
        packed = [pack_set(shingles[starts[k] : starts[k + 1]]) for k in keep]
        yield pa.RecordBatch.from_arrays([pa.array(names[keep]), pa.array(packed, pa.binary())], ["set_id", "content"])


def histogram(shingles: np.ndarray) -> bytes:
    """How many elements fall into each cell, at most 255.

    Two sets differ in at least as many elements as their histograms differ.
    """
    counts = np.bincount((shingles & U64(CELLS - 1)).astype(np.int64), minlength=CELLS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _near(threshold: Threshold, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose histograms leave a link possible, from rows (a, b, sizes together, both histograms)."""
    for batch in batches:
        sides = [
            np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, CELLS).astype(np.int16)
            for c in batch.columns[3:]
        ]
        apart = np.abs(sides[0] - sides[1]).sum(axis=1, dtype=np.int64)
        total = np.asarray(batch.column(2))
        kept = pa.array((threshold.of + threshold.percent) * apart <= (threshold.of - threshold.percent) * total)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], ["a", "b"])


def _verify(threshold: Threshold, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets link, from rows (a, b, shingles of a, shingles of b)."""
    for batch in batches:
        good = []
        for left, right in zip(batch.column(2), batch.column(3)):
            x, y = unpack_sorted(left.as_py()), unpack_sorted(right.as_py())
            both = np.sort(np.concatenate([x, y]))
            common = int((both[1:] == both[:-1]).sum())
            good.append(bool(threshold.links(common, len(x) + len(y))))
        kept = pa.array(good)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], ["a", "b"])


def may_link(threshold: Threshold, left: str = "l", right: str = "r") -> Column:
    """False only for sets that cannot link: by their sizes, or as their parities differ in too many bits."""
    differ = reduce(
        Column.__add__, [F.bit_count(F.col(f"{left}.{p}").bitwiseXOR(F.col(f"{right}.{p}"))) for p in PARITY]
    )
    x, y = F.col(f"{left}.n"), F.col(f"{right}.n")
    most = (threshold.of - threshold.percent) * (x + y)
    bits = F.zip_with(f"{left}.wide", f"{right}.wide", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    wide = F.aggregate(bits, F.lit(0), lambda total, n: total + n)
    sizes = threshold.of * F.least(x, y) >= threshold.percent * F.greatest(x, y)
    near = (threshold.of + threshold.percent) * differ <= most
    # null, and so no hindrance, unless both are large
    return sizes & near & F.coalesce((threshold.of + threshold.percent) * wide <= most, F.lit(True))


class JaccardJoin:
    """Finds all links between distinct sets and joins them up."""

    def __init__(self, docs: DataFrame, size: int, threshold: Threshold):
        self.spark = docs.sparkSession
        ship(self.spark)
        self.size, self.threshold = size, threshold
        self.docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        info = stored(map_arrow(self.docs, partial(_describe, size), INFO), "jaccard-sets")
        self.described = info.where("part is null").select("doc_id", "n_shingles", "set_id", *OUTLINE)
        self.sketches = info.where("part is not null").select("part", "counts")

    def candidates(self) -> DataFrame:
        """Stored rows: pairs (a, b), or members (a, sig) of large buckets."""
        sketch = np.zeros(SKETCH, np.int64)
        summed = self.sketches.groupBy("part").applyInArrow(_add_sketches, "part int, counts binary")
        for row in summed.collect():
            sketch[row.part * SKETCH_PART : (row.part + 1) * SKETCH_PART] = unpack(row.counts)
        shared = self.spark.sparkContext.broadcast(sketch)
        held = self.described.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
        rows = map_arrow(
            self.docs.select("text"), partial(_sign, self.size, self.threshold, shared), SIGNATURE
        )
        tasks = width(self.spark, held / 2, ROWS_PER_TASK)
        dealt = rows.repartition(tasks, F.shiftright("sig", 1)).sortWithinPartitions("sig")
        return stored(map_arrow(dealt, _buckets, FOUND), "jaccard-candidates")

    def outlines(self, wanted: DataFrame) -> DataFrame:
        """Stored size and parity of the sets ``wanted`` (set_id)."""
        columns = [F.first("n_shingles").alias("n"), *[F.first(p).alias(p) for p in OUTLINE]]
        mine = self.described.join(wanted, "set_id", "left_semi")
        return stored(mine.groupBy("set_id").agg(*columns), "jaccard-outlines")

    def made(self, pairs: DataFrame, pack_set: Callable, name: str) -> DataFrame:
        """Stored content of all sets in ``pairs`` (a, b), made again from one text each."""
        wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
        chosen = self.described.select("doc_id", "set_id").join(wanted, "set_id").groupBy("set_id")
        chosen = stored(chosen.agg(F.min("doc_id").alias("_key")), "jaccard-wanted")
        by_id = small(chosen.where("_key is not null"), 500_000)
        texts = self.docs.join(by_id, F.col("doc_id") == F.col("_key")).select("text", "set_id")
        # sets that only documents without an id have: those documents meet them by the set's name
        nameless = self.docs.where("doc_id is null")
        schema = StructType([*nameless.schema.fields, StructField("set_id", LongType())])
        named = map_arrow(nameless, partial(_with_set_id, self.size, 1, ["doc_id", "text", "set_id"]), schema)
        bare = small(chosen.where("_key is null").select("set_id"), 500_000)
        texts = texts.unionAll(named.join(bare, "set_id", "left_semi").select("text", "set_id"))
        packed = map_arrow(texts, partial(_made, self.size, pack_set), CONTENT)
        return stored(packed.groupBy("set_id").agg(F.first("content").alias("content")), name)

    def beside(self, pairs: DataFrame, content: DataFrame) -> DataFrame:
        """``pairs`` with the content of both sets as x and y."""
        left = content.select(F.col("set_id").alias("a"), F.col("content").alias("x"))
        right = content.select(F.col("set_id").alias("b"), F.col("content").alias("y"))
        return pairs.join(left, "a").join(right, "b")

    def verified(self, close: DataFrame) -> DataFrame:
        """Stored links among ``close`` (a, b, total): by histograms first, then by the sets themselves."""
        close = stored(close, "jaccard-close")
        near, large = close.where(F.col("total") <= PARITY_TOTAL), close.where(F.col("total") > PARITY_TOTAL)
        near = near.select("a", "b")
        if not large.isEmpty():
            cells = self.made(large, histogram, "jaccard-cells")
            rows = self.beside(large, cells).select("a", "b", "total", "x", "y")
            left = map_arrow(rows, partial(_near, self.threshold), "a long, b long")
            near = stored(near.union(left), "jaccard-near")
        rows = self.beside(near, self.made(near, pack_sorted, "jaccard-content")).select("a", "b", "x", "y")
        return stored(map_arrow(rows, partial(_verify, self.threshold), "a long, b long"), "jaccard-links")

    def labels(self) -> DataFrame:
        """Rows (node, component) for the sets that link with another.

        Candidates meet by their outlines first; only the sets of pairs that
        pass are made again from their texts.
        """
        found = self.candidates()
        pairs = found.where("b is not null").select("a", "b").distinct()
        members = found.where("sig is not null").groupBy("sig", F.col("a").alias("set_id"))
        members = members.agg(F.max("probe").alias("probe"))
        ends = [found.select(F.col("a").alias("set_id")), found.where("b is not null").select(F.col("b").alias("set_id"))]
        outlines = self.outlines(ends[0].union(ends[1]).distinct())
        close = (
            pairs.join(outlines.alias("l"), F.col("a") == F.col("l.set_id"))
            .join(outlines.alias("r"), (F.col("b") == F.col("r.set_id")) & may_link(self.threshold))
            .select("a", "b", (F.col("l.n") + F.col("r.n")).alias("total"))
        )
        degrees = members.groupBy("set_id").agg(F.count("*").alias("degree"))
        members = stored(members.join(degrees, "set_id"), "jaccard-members")
        more = not members.isEmpty()
        if more:
            pairs, members = self.by_pivots(members, None, outlines, 1)
            close = close.union(pairs).distinct()
        labels = stored(components(self.verified(close)), "jaccard-labels")
        while more and not members.isEmpty():
            pairs, members = self.by_pivots(members, labels, outlines, PIVOTS)
            links = None if pairs.isEmpty() else self.verified(pairs)
            if links is not None and not links.isEmpty():
                labels = self.joined(labels, links)
        return labels

    def by_pivots(
        self, members: DataFrame, labels: DataFrame | None, outlines: DataFrame, pivots: int
    ) -> tuple[DataFrame, DataFrame]:
        """Candidate pairs of large buckets with pivots, and the buckets without those pivots.

        A bucket whose sets are all of one component, or in which nothing probes
        any more, is done. In the others, up
        to ``pivots`` sets outside the bucket's largest component, those in
        most buckets first, are compared with all sets of other components, if
        one of the two probes, and then leave the bucket; so every pair is compared
        or joined up before. A bucket of which all such sets were pivots is done.
        Pairs that differ in too many parities never leave the join.
        """
        if labels is None:
            labels = members.select(F.col("set_id").alias("node"), F.col("set_id").alias("component")).limit(0)
        placed = members.join(labels, F.col("set_id") == F.col("node"), "left").select(
            "sig", "set_id", "probe", "degree", F.coalesce("component", "set_id").alias("component")
        )
        parts = placed.groupBy("sig", "component").agg(
            F.count("*").alias("n_sets"), F.max("probe").alias("probes")
        )
        open_buckets = (
            parts.groupBy("sig")
            .agg(
                F.count("*").alias("n_parts"),
                F.sum("n_sets").alias("size"),
                F.max(F.struct("n_sets", "component")).alias("main"),
                F.max("probes").alias("probes"),
            )
            .where("n_parts > 1 and probes")
        )
        left = stored(placed.join(open_buckets, "sig").drop("n_parts", "probes"), "jaccard-open")
        outside = F.col("component") != F.col("main.component")
        alone = F.col("main.n_sets") == 1
        per_bucket = Window.partitionBy("sig").orderBy(F.desc("degree"), "set_id")
        chosen = left.where(outside | alone).withColumn("place", F.row_number().over(per_bucket))
        chosen = chosen.where(F.col("place") <= pivots)
        chosen = stored(
            chosen.select("sig", "probe", F.col("set_id").alias("pivot"), F.col("component").alias("of")),
            "jaccard-pivots",
        )
        heads = chosen.join(outlines, F.col("pivot") == F.col("set_id")).select("sig", "probe", "pivot", "of", "n", *OUTLINE)
        others = left.join(outlines, "set_id").select("sig", "probe", "set_id", "component", "n", *OUTLINE)
        met = heads.alias("l").join(
            others.alias("r"),
            (F.col("l.sig") == F.col("r.sig"))
            & (F.col("l.of") != F.col("r.component"))
            & (F.col("l.probe") | F.col("r.probe"))
            & may_link(self.threshold),
        )
        ends = F.least("pivot", "set_id").alias("a"), F.greatest("pivot", "set_id").alias("b")
        pairs = stored(met.select(*ends, (F.col("l.n") + F.col("r.n")).alias("total")).distinct(), "jaccard-met")
        gone = chosen.select("sig", F.col("pivot").alias("set_id"))
        many = F.when(alone, F.col("size")).otherwise(F.col("size") - F.col("main.n_sets")) > pivots
        rest = stored(left.where(many).join(gone, ["sig", "set_id"], "left_anti").select(*members.columns), "jaccard-rest")
        return pairs, rest

    def joined(self, labels: DataFrame, links: DataFrame) -> DataFrame:
        """``labels`` after new links, which are drawn between the components of their ends."""
        old = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        ends = links
        for end in ("a", "b"):
            ends = ends.join(old, F.col(end) == F.col("_n"), "left").withColumn(end, F.coalesce("_c", end)).drop("_n", "_c")
        new = stored(components(ends), "jaccard-joined")
        again = new.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        moved = labels.join(again, F.col("component") == F.col("_n"), "left").select(
            "node", F.coalesce("_c", "component").alias("component")
        )
        fresh_nodes = new.join(labels, "node", "left_anti")
        return stored(moved.unionByName(fresh_nodes), "jaccard-labels")


def join_documents(docs: DataFrame, size: int = 4, threshold: Threshold = Threshold()) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each row of ``docs``.

    A document's set holds its distinct shingles of ``size`` words, lower-cased
    in A-Z; a shorter text is one shingle, and a text without words has an empty
    set and links with nothing. Documents link when their sets reach the
    threshold; component_id is the smallest doc_id reachable by links.

    Equal sets are one node from the start, so copies cost one row each.
    Null ids take part; a component of null ids alone is null. Repeated
    rows and ids are kept; other columns are not read; an empty table gives an
    empty result. Sets and their shingles are told apart by 64-bit hashes.
    """
    job = JaccardJoin(docs, size, threshold)
    labels = job.labels()
    described = job.described
    keyed = described.where("n_shingles > 0").join(labels, F.col("set_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "set_id").alias("key")
    )
    smallest = keyed.groupBy("key").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n_docs"))
    several = smallest.where("n_docs > 1").drop("n_docs")
    linked = keyed.join(several, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("component_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    empty = described.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(empty)


def _with_set_id(size: int, place: int, fields: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, shingles, starts in _parts(size, place, batches):
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(set_ids(shingles, starts))], fields)


def keep_first(docs: DataFrame, size: int = 5, threshold: Threshold = Threshold(percent=80)) -> DataFrame:
    """``docs`` with one document of each group that hangs together by links; columns as they are.

    The smallest doc_id stays (nulls last; then by the set's hash). Of repeated
    rows one stays. Documents without words link with nothing and all stay.
    What goes is decided on ids alone; texts are not shuffled unless the list
    of ids to drop is too long to broadcast.
    """
    job = JaccardJoin(docs, size, threshold)
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    keyed = job.described.where("n_shingles > 0").join(job.labels(), F.col("set_id") == F.col("node"), "left")
    rows = keyed.groupBy(F.coalesce("component", "set_id").alias("group"), "doc_id", "set_id").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "set_id")
    best = rows.groupBy("group").agg(F.min(order).alias("best"), F.sum("n").alias("all")).where(F.col("all") > 1)
    first = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("set_id") == F.col("best.set_id"))
    marked = rows.join(best, "group").select("doc_id", "set_id", first.alias("first"), "n").where(~first | (F.col("n") > 1))
    marked = stored(marked, "jaccard-marked")
    name, mark, other, rank = (fresh(docs, x) for x in ("_set_id", "_mark", "_other", "_rank"))
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])
    fields, place = [*docs.columns, name], docs.columns.index("text")

    def named(part: DataFrame) -> DataFrame:
        return map_arrow(part, partial(_with_set_id, size, place, fields), schema)

    marks = marked.select(F.col("doc_id").alias(other), F.col("set_id").alias(mark))
    same = F.col(other).eqNullSafe(F.col("doc_id")) & (F.col(mark) == F.col(name))
    kept = named(docs.where(worded)).join(small(marks, 500_000), same, "left_anti").select(*docs.columns)
    repeated = marked.where("first").select(F.col("doc_id").alias(other), F.col("set_id").alias(mark))
    if not repeated.isEmpty():
        again = named(docs.where(worded)).join(small(repeated, 500_000), same, "left_semi")
        alike = Window.partitionBy(name).orderBy(F.xxhash64("text"))
        again = again.withColumn(rank, F.row_number().over(alike)).where(F.col(rank) == 1)
        kept = kept.unionByName(again.select(*docs.columns))
    return kept.unionByName(docs.where(~worded))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(table(spark, sf_dir, "documents"))

"""Approximate nearest neighbours by multi-index hashing (operator 8)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow, ship, stored, table, width

SUBSTRING = 16
_ONES = np.array([bin(x).count("1") for x in range(1 << 8)], np.uint8)
_ONES = (_ONES[:, None] + _ONES[None, :]).ravel()  # of all 16-bit numbers


@dataclass(frozen=True)
class Settings:
    """Size of the codes, of the sample they are learned from (for each length of vectors), and of the blocks.

    A query's radius is the least that holds ``candidates`` codes of the whole
    index; all codes within it are compared by their vectors.
    """

    bits: int = 192
    sample: int = 8192
    rounds: int = 25
    block: int = 8192
    query_block: int = 4096
    candidates: int = 1536
    seed: int = 3


@dataclass
class Coder:
    """Centre, rotation and norm bound of the binary codes.

    A vector is extended by what its squared norm lacks to the largest, so that
    the inner product with a query (extended by 0) orders as the angle does.
    """

    centre: np.ndarray
    planes: np.ndarray
    largest: float

    def extended(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        rest = np.zeros(len(vectors)) if query else self.largest**2 - (vectors**2).sum(axis=1)
        return np.column_stack([vectors, np.sqrt(np.maximum(rest, 0))])

    def codes(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Codes as rows of 16-bit substrings."""
        bits = (self.extended(vectors, query) - self.centre) @ self.planes > 0
        return np.ascontiguousarray(np.packbits(bits, axis=1)).view(np.uint16)


def learn(sample: np.ndarray, largest: float, settings: Settings = Settings()) -> Coder:
    """Rotations by iterative quantisation of the centred, extended sample.

    Each turns the principal axes so that the codes' corners lie near the
    vectors; as many are learned, from different starts, as fill the bits.
    """
    rng = np.random.default_rng(settings.seed)
    coder = Coder(np.zeros(sample.shape[1] + 1), np.zeros((0, 0)), largest)
    wide = coder.extended(sample, False)
    centre = wide.mean(axis=0)
    centre[-1] = wide[:, -1].mean() / 2  # between the vectors' and the queries'
    wide = wide - wide.mean(axis=0)
    axes = np.linalg.svd(wide, full_matrices=False)[2].T
    axes = axes[:, : min(axes.shape[1], sample.shape[1])]
    flat = wide @ axes
    planes = []
    while sum(p.shape[1] for p in planes) < settings.bits:
        turn = np.linalg.qr(rng.normal(size=(flat.shape[1], flat.shape[1])))[0]
        for _ in range(settings.rounds):
            u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (u @ v).T
        planes.append(axes @ turn)
    return Coder(centre, np.concatenate(planes, axis=1)[:, : settings.bits], largest)


class MultiIndex:
    """Codes of a block, indexed by each of their substrings."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order, self.values, self.counts = [], [], []
        for column in codes.T:
            order = np.argsort(column, kind="stable")
            values, counts = np.unique(column, return_counts=True)
            self.order.append(order)
            self.values.append(values)
            self.counts.append(counts)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows of all codes that differ from ``code`` in at most ``radius`` bits.

        A code that near agrees in some substring j to within (radius - j) // m
        bits, m the number of substrings; only the buckets so near are opened.
        """
        pieces = len(code)
        seen = np.zeros(len(self.codes), bool)
        for j in range(pieces):
            near = _ONES[self.values[j] ^ code[j]] <= (radius - j) // pieces
            seen[self.order[j][np.repeat(near, self.counts[j])]] = True
        rows = np.flatnonzero(seen)
        return rows[_distances(self.codes[rows], code) <= radius]


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(values.flatten(), np.float64).reshape(len(values), -1)


def _words(codes, bits: int) -> np.ndarray:
    """Codes from bytes, as rows of 16-bit substrings."""
    data = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
    return np.frombuffer(b"".join(data.to_pylist()), np.uint16).reshape(len(data), bits // SUBSTRING)


def _encode(coders: dict[int, Coder], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add each vector's code, as a row of the index and as a query."""
    for batch in batches:
        lengths = np.asarray(batch.column("length"))
        for length in np.unique(lengths):
            rows = batch.filter(pa.array(lengths == length))
            vectors, coder = _matrix(rows.column("vector")), coders[int(length)]
            codes = [pa.array([c.tobytes() for c in coder.codes(vectors, query)], pa.binary()) for query in (False, True)]
            yield pa.RecordBatch.from_arrays([*rows.columns, *codes], [*rows.schema.names, "code", "query_code"])


def _distances(index: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Differing bits between a code and each of the index, 64 at a time where the width allows."""
    wide = np.uint64 if index.shape[1] % 4 == 0 else np.uint16
    return np.bitwise_count(index.view(wide) ^ code.view(wide)).sum(axis=1, dtype=np.int64)


def _count(settings: Settings, queries: pa.Table, index: pa.Table) -> pa.Table:
    """How many codes of a block lie at each distance from each query, as far as its radius can reach."""
    names, kinds = ["query_id", "query_key", "distance", "n"], [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    out: list[list[np.ndarray]] = [[] for _ in names]
    if queries.num_rows and index.num_rows:
        codes = _words(index.column("code"), settings.bits)
        wanted = _words(queries.column("query_code"), settings.bits)
        for own, key, code in zip(np.asarray(queries.column("vec_id")), np.asarray(queries.column("query_key")), wanted):
            counts = np.bincount(_distances(codes, code), minlength=settings.bits + 1)
            reach = int(np.searchsorted(np.cumsum(counts), settings.candidates)) + 1
            at = np.flatnonzero(counts[:reach])
            for column, values in zip(out, (np.full(len(at), own), np.full(len(at), key), at, counts[at])):
                column.append(values)
    return pa.table([pa.array(np.concatenate(c) if c else [], k) for c, k in zip(out, kinds)], names)


FOUND = "query_id long, query_key long, vec_id long, score double"


def _search(settings: Settings, top: int, queries: pa.Table, index: pa.Table) -> pa.Table:
    """The best of one block of the index for the queries: those within the radius, by their vectors."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    columns: list[list[np.ndarray]] = [[], [], [], []]
    if queries.num_rows and index.num_rows:
        vectors, ids = _matrix(index.column("vector")), np.asarray(index.column("vec_id"))
        blocks = MultiIndex(_words(index.column("code"), settings.bits))
        wanted = _matrix(queries.column("vector"))
        each = zip(
            np.asarray(queries.column("vec_id")),
            np.asarray(queries.column("query_key")),
            np.asarray(queries.column("radius")),
            wanted,
            _words(queries.column("query_code"), settings.bits),
        )
        for own, key, radius, vector, code in each:
            rows = blocks.within(code, int(radius))
            rows = rows[ids[rows] != own]
            scores = (vectors[rows] * vector).sum(axis=1)
            best = np.lexsort((ids[rows], -scores))[:top]
            for column, values in zip(columns, (own, key)):
                column.append(np.full(len(best), values))
            columns[2].append(ids[rows[best]])
            columns[3].append(scores[best])
    arrays = [pa.array(np.concatenate(c) if c else [], k) for c, k in zip(columns, kinds)]
    return pa.table(arrays, ["query_id", "query_key", "vec_id", "score"])


def _learn_all(usable: DataFrame, settings: Settings) -> tuple[dict[int, Coder], dict[int, int]]:
    """A coder for every length of vectors, and how many there are of each."""
    sizes = usable.groupBy("length").agg(
        F.count("*").alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("square")
    ).collect()
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("length") == r.length, min(1.0, settings.sample / r.n)).otherwise(share)
    dealt = F.pmod(F.xxhash64(F.lit("sample"), "vec_id", "vector"), F.lit(1 << 40)) / float(1 << 40)
    drawn = usable.where(dealt < share).orderBy("length", "vec_id", "vector").select("length", "vector").toArrow()
    lengths = np.asarray(drawn.column("length"))
    coders = {}
    for r in sizes:
        own = drawn.filter(pa.array(lengths == r.length))
        sample = _matrix(own.column("vector")) if own.num_rows else np.eye(r.length)
        coders[r.length] = learn(sample, float(np.sqrt(r.square)), settings)
    return coders, {r.length: r.n for r in sizes}


def nearest(vectors: DataFrame, every: int = 20, top: int = 20, settings: Settings = Settings()) -> DataFrame:
    """The ``top`` rows of largest inner product for each query: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and embedding. Queries are the rows whose id is
    divisible by ``every``; candidates are all rows of other ids whose vector has the
    same length. Ties go to the smaller id. Codes are learned from a bounded sample (some
    ``sample`` rows of each length, drawn by hash); every row is indexed.

    First the codes alone meet: queries count the index's codes at each distance, which
    gives each query the radius that holds ``candidates`` of all codes, however many there
    are. Then the substrings' buckets are probed for the codes within that radius, and
    those are compared by their vectors.

    Of equal vectors only the ``top`` + 1 smallest ids can be among a result and
    are indexed; they are picked before the shuffle and again after it, so
    copies of one vector never meet in one place.

    Take no part: null ids, null or empty vectors, zero vectors, and those that
    hold a null or a number that is not finite. Repeated rows count once.
    With fewer candidates than ``top`` all are returned. Other columns are not
    read; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kept = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    numbers = vectors.select(F.col("vec_id").cast("long"), kept.alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = numbers.where(
        F.col("vec_id").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    )
    usable = sound.withColumn("length", F.size("vector"))
    coders, sizes = _learn_all(usable, settings)
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    copies = Window.partitionBy("vector").orderBy("vec_id")
    first = usable.withColumn("place", F.dense_rank().over(copies)).where(F.col("place") <= top + 1)
    asked = F.col("vec_id") % every == 0
    rows = first.select("vec_id", "vector", "length", F.lit(True).alias("indexed")).unionAll(
        usable.where(asked).select("vec_id", "vector", "length", F.lit(False).alias("indexed"))
    )
    rows = rows.groupBy("vec_id", "vector", "length").agg(F.max("indexed").alias("indexed"))
    kind = "array<float>" if single else "array<double>"
    schema = f"vec_id long, vector {kind}, length int, indexed boolean, code binary, query_code binary"
    coded = stored(map_arrow(rows, partial(_encode, coders), schema), "ann-codes")
    queries = coded.where(asked).withColumn("query_key", F.xxhash64("vector"))
    index = coded.where("indexed").toDF(*coded.columns)  # columns of its own, to be told from the queries'
    index_blocks, query_blocks = -(-index.count() // settings.block), -(-queries.count() // settings.query_block)
    if not query_blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    part = lambda n: F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    keys = ["length", "q", "i"]
    tasks = width(spark, index_blocks * query_blocks, 1)

    def met(left: DataFrame, right: DataFrame, job: Callable, result: str) -> DataFrame:
        """Every block of queries with every block of the index, length by length."""
        left = left.select("*", part(query_blocks).alias("q")).select("*", each(index_blocks).alias("i"))
        right = right.select("*", part(index_blocks).alias("i")).select("*", each(query_blocks).alias("q"))
        left, right = (side.repartition(tasks, *keys).groupBy(*keys) for side in (left, right))
        return left.cogroup(right).applyInArrow(job, result)

    counted = met(
        queries.select("length", "vec_id", "query_key", "query_code"),
        index.select("length", "vec_id", "code"),
        partial(_count, settings),
        "query_id long, query_key long, distance int, n long",
    )
    counted = counted.groupBy("query_id", "query_key", "distance").agg(F.sum("n").alias("n"))
    inwards = Window.partitionBy("query_id", "query_key").orderBy("distance")  # as many rows as bits
    before = F.coalesce(F.sum("n").over(inwards.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = counted.withColumn("before", before).where(F.col("before") < settings.candidates)
    radii = within.groupBy("query_id", "query_key").agg(F.max("distance").alias("radius"))
    reaching = queries.join(radii.withColumnRenamed("query_id", "vec_id"), ["vec_id", "query_key"])
    found = met(
        reaching.select("length", "vec_id", "query_key", "query_code", "vector", "radius"),
        index.select("length", "vec_id", "code", "vector"),
        partial(_search, settings, top),
        FOUND,
    )
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))

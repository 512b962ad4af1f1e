"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow, ship, stored, table
from tidewatch.llm.words import slices, text_bytes
from tidewatch.llm.wu_manber import Searcher, split_words

WINDOW = 10
#: Windows in one broadcast set of tables: some 100 bytes each, words included.
MOST_WINDOWS = 500_000

FOUND = "doc_id long, digest binary, n_words long, spans array<struct<start: long, stop: long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _item_windows(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        content, bounds = text_bytes(batch.column("text"))
        for start, end in slices(bounds, 1 << 18):
            part = content[bounds[start] : bounds[end]]
            words, starts = split_words(part, bounds[start : end + 1] - bounds[start])
            words = [w.decode() for w in words.to_pylist()]
            rows, windows = [], []
            for row, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist()), start):
                own = [" ".join(words[k : min(k + size, b)]) for k in range(a, max(b - size, a) + 1)] if b > a else []
                rows += [row] * len(own)
                windows += own
            items = batch.column("item").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([items, pa.array(windows, pa.string())], ["item", "window"])


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (item, window): every run of ``size`` words, or all words of a shorter text."""
    texts = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return map_arrow(texts, partial(_item_windows, size), "item string, window string").distinct()


def _spans(inside: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Runs of covered words of each row, counted from the row's first word."""
    rows = len(starts) - 1
    padded = np.concatenate([[False], inside, [False]])
    opens = padded[1:-1] & ~padded[:-2]
    closes = padded[1:-1] & ~padded[2:]
    edges = starts[:-1][starts[1:] > starts[:-1]]
    opens[edges] = inside[edges]  # a run ends with its row
    lasts = starts[1:][starts[1:] > starts[:-1]] - 1
    closes[lasts] = inside[lasts]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    row = np.searchsorted(starts, first, "right") - 1
    offsets = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays(
        [pa.array(first - starts[row]), pa.array(last + 1 - starts[row])], fields=list(_SPANS.value_type)
    )
    return pa.ListArray.from_arrays(pa.array(offsets), pairs).cast(_SPANS)


def _search(tables, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    searcher, items = tables.value
    for batch in batches:
        content, bounds = text_bytes(batch.column("text"))
        for start, end in slices(bounds):
            part = content[bounds[start] : bounds[end]]
            starts, inside, rows, owners = searcher.search(part, bounds[start : end + 1] - bounds[start])
            named = np.array([items[k] is not None for k in owners], bool)
            rows, owners = rows[named], owners[named]
            offsets = np.searchsorted(rows, np.arange(end - start + 1)).astype(np.int32)
            names = pa.ListArray.from_arrays(pa.array(offsets), pa.array([items[k] for k in owners], pa.string()))
            here = batch.slice(start, end - start)
            yield pa.RecordBatch.from_arrays(
                [here.column("doc_id"), here.column("digest"), pa.array(np.diff(starts)), _spans(inside, starts), names],
                ["doc_id", "digest", "n_words", "spans", "items"],
            )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unite the spans and items that several sets of tables found in one text."""
    for batch in batches:
        spans, items = [], []
        for own, more in zip(batch.column("spans").to_pylist(), batch.column("more_spans").to_pylist()):
            united: list[dict] = []
            for span in sorted(own + (more or []), key=lambda s: s["start"]):
                if united and span["start"] <= united[-1]["stop"]:
                    united[-1]["stop"] = max(united[-1]["stop"], span["stop"])
                else:
                    united.append(span)
            spans.append(united)
        for own, more in zip(batch.column("items").to_pylist(), batch.column("more_items").to_pylist()):
            items.append(sorted({*own, *(more or [])}))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), batch.column("n_words"), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))],
            ["doc_id", "digest", "n_words", "spans", "items"],
        )


def find_items(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, most: int = MOST_WINDOWS) -> DataFrame:
    """Where texts of ``benchmark`` (item_id, text) occur in those of ``docs`` (doc_id, text).

    Returns for each row of ``docs``: doc_id, n_words, spans (runs of words inside
    occurrences: start and stop, counted from 0, in order) and items (ids as
    strings, in order). Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z
    became a-z. A window is ``size`` consecutive words of an item; an item
    of fewer, but not none, is one window. Windows lie within one text.

    Windows are searched by the shifts of two-word blocks, suffix buckets, and a
    comparison of all words. The tables are broadcast, with at most about
    ``most`` windows: more are dealt out by hash and searched set by set, a scan
    of ``docs`` each, and what was found is united by the texts' digests.

    Null and empty texts have no words. An item without an id marks words
    but is not named in items; items of one id count as one. Repeated rows of
    ``docs`` are searched alike. An empty benchmark marks nothing. Other columns are not read.
    """
    spark = docs.sparkSession
    windows = stored(item_windows(benchmark, size), "benchmark-windows")
    sets = max(1, -(-windows.count() // most))
    texts = docs.select(
        F.col("doc_id").cast("long"),
        "text",
        (F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)) if sets > 1 else F.lit(None).cast("binary")).alias("digest"),
    )

    def found(k: int) -> DataFrame:
        dealt = F.pmod(F.xxhash64("item", "window"), F.lit(sets)) == k
        own = (windows.where(dealt) if sets > 1 else windows).orderBy("item", "window").toArrow()
        names = own.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
        searcher = Searcher(own.column("window").to_pylist(), names.indices.to_numpy())
        tables = spark.sparkContext.broadcast((searcher, names.dictionary.to_pylist()))
        return map_arrow(texts, partial(_search, tables), FOUND)

    ship(spark)
    result = found(0)
    if sets > 1:
        others = [found(k).where(F.size("spans") > 0).dropDuplicates(["digest"]) for k in range(1, sets)]
        more = others[0]
        for other in others[1:]:
            more = more.unionAll(other)
        more = more.groupBy("digest").agg(
            F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items")
        )
        result = map_arrow(result.join(more, "digest", "left"), _merge, FOUND)
    return result.drop("digest")


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    items = F.array_sort("items")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_WORDS = "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP11_SQL = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format("text")} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS m, array_to_string(w[k : k + least(len(w), {WINDOW}) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS k FROM item WHERE len(w) > 0)
),
doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
sizes AS (SELECT DISTINCT m FROM windows),
places AS (
  SELECT r, m, k, array_to_string(w[k : k + m - 1], ' ') AS win
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM doc CROSS JOIN sizes WHERE len(w) >= m)
),
hits AS (SELECT DISTINCT r, p.m, k, item_id FROM places p JOIN windows b ON p.m = b.m AND p.win = b.win),
covered AS (
  SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(k, k + m)) AS pos FROM hits) GROUP BY r
),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT r, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

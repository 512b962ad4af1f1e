"""Language identification with a byte convolutional network (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.llm.common import fold, fresh, map_arrow, pack, small, stored, table
from tidewatch.llm.words import slices, text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4)
#: Windows evaluated at once, so that the activations stay in the processor's cache.
CHUNK = 192
UNKNOWN = "und"


@dataclass(frozen=True)
class Training:
    """Bounds of the labelled sample, and how the network is fitted to it.

    At most ``documents`` for each language with at most ``windows`` windows
    each. Every language is learned; with more than four, ``steps`` grow in proportion.
    """

    documents: int = 400
    windows: int = 6
    embedding: int = 6
    filters: int = 12
    steps: int = 500
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass
class Network:
    """Embedding, filters of all widths side by side in one matrix, and softmax weights."""

    languages: list[str]
    embedding: np.ndarray  # 256 x e; byte 0 pads and is zero
    filters: np.ndarray  # (widest * e) x f
    bias: np.ndarray  # f
    weights: np.ndarray  # f x languages
    offset: np.ndarray  # languages

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """For each window and place, the embeddings under the widest filter."""
        n, length = windows.shape
        e = self.embedding.shape[1]
        places = length - max(WIDTHS) + 1
        vectors = self.embedding[windows]
        view = np.lib.stride_tricks.as_strided(
            vectors,
            (n, places, max(WIDTHS) * e),
            (vectors.strides[0], vectors.strides[1], vectors.itemsize),
        )
        return view.reshape(n * places, -1).reshape(n, places, -1)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        columns = self.columns(windows)
        n, places, k = columns.shape
        values = columns.reshape(n * places, k) @ self.filters
        return np.maximum(values.reshape(n, places, -1).max(axis=1) + self.bias, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for start in range(0, len(windows), CHUNK):
            scores = self.pooled(windows[start : start + CHUNK]) @ self.weights + self.offset
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            out[start : start + CHUNK] = scores / scores.sum(axis=1, keepdims=True)
        return out


def _filter_mask(embedding: int, filters: int) -> np.ndarray:
    """Ones where a filter of its width has weights; narrower ones are zero behind."""
    mask = np.zeros((max(WIDTHS) * embedding, filters * len(WIDTHS)), np.float32)
    for k, width in enumerate(WIDTHS):
        mask[: width * embedding, k * filters : (k + 1) * filters] = 1
    return mask


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], how: Training = Training()) -> Network:
    """Fit by Adam on cross-entropy; a third of each batch is cut short to resemble short texts."""
    rng = np.random.default_rng(how.seed)
    e, f = how.embedding, how.filters * len(WIDTHS)
    mask = _filter_mask(e, how.filters)
    net = Network(
        languages,
        rng.normal(0, 0.5, (256, e)).astype(np.float32),
        (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32),
        np.zeros(f, np.float32),
        rng.normal(0, 0.1, (f, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    net.embedding[0] = 0
    params = [net.embedding, net.filters, net.bias, net.weights, net.offset]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    of_language = [np.flatnonzero(labels == k) for k in range(len(languages))]
    steps = how.steps * max(4, len(languages)) // 4
    for step in range(1, steps + 1):
        target = rng.integers(0, len(languages), how.batch)
        batch = windows[[rng.choice(of_language[t]) for t in target]].copy()
        for row in np.flatnonzero(rng.random(how.batch) < 1 / 3):
            batch[row, rng.integers(16, WINDOW) :] = 0
        columns = net.columns(batch)
        n, places, k = columns.shape
        values = (columns.reshape(n * places, k) @ net.filters).reshape(n, places, f)
        where = values.argmax(axis=1)
        hidden = np.take_along_axis(values, where[:, None], 1)[:, 0] + net.bias
        active = np.maximum(hidden, 0)
        scores = active @ net.weights + net.offset
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        error = scores / scores.sum(axis=1, keepdims=True)
        error[np.arange(n), target] -= 1
        error /= n
        back = (error @ net.weights.T) * (hidden > 0)
        chosen = columns[np.arange(n)[:, None], where]  # n x f x k
        into = (back[:, :, None] * (net.filters.T * mask.T)[None]).reshape(n, f, max(WIDTHS), e)
        embedding = np.zeros_like(net.embedding)
        for offset in range(max(WIDTHS)):
            np.add.at(embedding, batch[np.arange(n)[:, None], where + offset], into[:, :, offset])
        embedding[0] = 0
        gradients = [
            embedding,
            np.einsum("nfk,nf->kf", chosen, back) * mask,
            back.sum(0),
            active.T @ error,
            error.sum(0),
        ]
        rate = how.rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, a, b in zip(params, gradients, first, second):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return net


def cut(content: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all rows, the last of each padded with zeros, and where each row's begin."""
    lengths = np.diff(bounds)
    counts = -(-lengths // WINDOW)
    begin = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(begin[-1] * WINDOW, np.uint8)
    at = np.arange(len(content)) + np.repeat(begin[:-1] * WINDOW - bounds[:-1], lengths)
    out[at] = content
    return out.reshape(-1, WINDOW), begin


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _hash(name: str) -> Column:
    return F.xxhash64(F.lit(name), F.col("doc_id"), F.col("text"))


def training_windows(labelled: DataFrame, how: Training) -> DataFrame:
    """Rows (lang, window), a bounded sample of ``labelled`` (doc_id, text, lang).

    Documents come by hash: a first threshold for each language, fitted to its
    count, passes about twice the documents wanted; of these the lowest hashes
    stay. Windows of a document are spread evenly over its length.
    """
    usable = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    counts = stored(usable.groupBy("lang").agg(F.count("*").alias("_count")), "language-counts")
    counts = counts.select(F.col("lang").alias("_lang"), "_count")
    share = F.lit(2.0 * how.documents) / F.col("_count") * 2.0**63
    passed = usable.join(small(counts), F.col("lang") == F.col("_lang")).where(
        F.shiftright(_hash("pick"), 1).cast("double") + 2.0**62 <= share
    )
    first = Window.partitionBy("lang").orderBy(_hash("pick"), "doc_id")
    chosen = passed.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= how.documents)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, bounds = text_bytes(batch.column(0))
            names, rows = batch.column(1).to_pylist(), []
            for k, name in enumerate(names):
                size = int(bounds[k + 1] - bounds[k])
                count = min(how.windows, max(1, size // WINDOW))
                for start in np.linspace(0, max(0, size - WINDOW), count).astype(int):
                    piece = content[bounds[k] + start : min(bounds[k + 1], bounds[k] + start + WINDOW)]
                    rows.append((name, piece.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())],
                ["lang", "window"],
            )

    return map_arrow(chosen.select("text", "lang"), windows, "lang string, window binary")


def fit(labelled: DataFrame, how: Training = Training()) -> Network | None:
    """A network for the languages of ``labelled``; None if there is nothing to learn from."""
    sample = training_windows(labelled, how).collect()
    if not sample:
        return None
    sample.sort(key=lambda r: (r.lang, bytes(r.window)))
    languages = sorted({r.lang for r in sample})
    windows = np.zeros((len(sample), WINDOW), np.uint8)
    for k, row in enumerate(sample):
        windows[k, : len(row.window)] = np.frombuffer(row.window, np.uint8)
    labels = np.array([languages.index(r.lang) for r in sample])
    return train(windows, labels, languages, how)


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """All columns of ``docs`` with lang_pred and score (replaced if present).

    Every window of the whole text is classified; the probabilities are
    averaged by the bytes of each window. ``und`` with score 0: null text, text
    without a letter, or no network. A tie goes to the first language in
    order. Each row is judged alone, so repeated rows agree and an empty table
    stays empty.
    """
    kept, unpack = pack(docs, "text")
    letter = fresh(kept, "_letter")
    marked = kept.withColumn(letter, has_letter(F.col("text")))
    place = marked.columns.index("text")
    fields = [*kept.columns, "lang_pred", "score"]
    schema = StructType(list(kept.schema.fields)).add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            _, sizes = text_bytes(whole.column(place))
            for start, end in slices(sizes):
                batch = whole.slice(start, end - start)
                content, bounds = text_bytes(batch.column(place))
                known = np.asarray(batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False), bool)
                names = np.full(batch.num_rows, UNKNOWN, object)
                scores = np.zeros(batch.num_rows)
                if network is not None and len(content):
                    windows, begin = cut(content, bounds)
                    weights = np.full(len(windows), WINDOW, np.float64)
                    lengths = np.diff(bounds)
                    filled = lengths > 0
                    weights[begin[1:][filled] - 1] = (lengths[filled] - 1) % WINDOW + 1
                    mass = network.probabilities(windows) * weights[:, None]
                    total = np.add.reduceat(mass, begin[:-1][filled], axis=0) / lengths[filled][:, None]
                    best = total.argmax(axis=1)
                    names[filled] = np.array(network.languages, object)[best]
                    scores[filled] = np.clip(total[np.arange(len(best)), best], 0, 1)
                    names[~known] = UNKNOWN
                    scores[~known] = 0
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores)],
                    fields,
                )

    return unpack(map_arrow(marked, run, schema), "lang_pred", "score")


def identify(docs: DataFrame, how: Training = Training(), held_out: int = 1, folds: int = 3) -> DataFrame:
    """``docs`` with held_out, lang_pred and score, learned from the other folds' text and lang."""
    known = docs.where(fold("doc_id", folds) != held_out).select("doc_id", "text", "lang")
    network = fit(known, how)
    return predict(docs.withColumn("held_out", fold("doc_id", folds) == held_out), network)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")

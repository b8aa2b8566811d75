"""Quality scores from random-indexing word vectors and a small network.

Every token has a sparse random index vector. A word vector is the sum of the
index vectors of the tokens around it, over the whole corpus; words share rows of
a hashed table of fixed size. A document is the mean of its word vectors and a few
figures of its whole text. A two-layer network, fitted on labelled documents,
gives the probability of the good label, calibrated by a temperature.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortwise.llm.common import WordHashes, Workspace

# Rows of the hashed word table, and width of the vectors.
ROWS = 1 << 14
WIDTH = 32
# Tokens on each side that count as context, and non-zero entries of an index vector.
REACH = 2
NONZERO = 2
# Labelled documents that the network is fitted on, at most.
FIT_ROWS = 20_000
HIDDEN = 24
EPOCHS = 60
BATCH = 256
SEED = 11
# Runs of letters, digits, or other marks; separators part them.
TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\x20\x09-\x0D0-9A-Za-z\x80-\xff]+")
FIGURES = 8


def tokens_of(text: str | None) -> list[bytes]:
    return TOKEN.findall(text.encode()) if text else []


def index_entries(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of tokens' index vectors."""
    parts = [hashes >> np.uint64(20 + 12 * i) for i in range(NONZERO)]
    places = np.stack([(p % np.uint64(WIDTH)).astype(np.int64) for p in parts], axis=1)
    signs = np.stack([1 - 2 * ((p >> np.uint64(8)) & np.uint64(1)).astype(np.int64) for p in parts], axis=1)
    return places, signs


def row_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(ROWS)).astype(np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums of context vectors: one row per row of the word table."""
    hashes, total = WordHashes(), np.zeros(ROWS * WIDTH)
    for batch in batches:
        for text in batch.column(0):
            tokens = tokens_of(text.as_py())
            if len(tokens) < 2:
                continue
            h = hashes.of(tokens)
            rows = row_of(h) * WIDTH
            places, signs = index_entries(h)
            for off in range(1, min(REACH, len(h) - 1) + 1):
                for to, of in ((slice(off, None), slice(None, -off)), (slice(None, -off), slice(off, None))):
                    at = (rows[to, None] + places[of]).ravel()
                    if len(at) > total.size // 8:
                        total += np.bincount(at, signs[of].ravel(), total.size)
                    else:
                        np.add.at(total, at, signs[of].ravel())
    sums = total.reshape(ROWS, WIDTH)
    used = np.flatnonzero(np.abs(sums).sum(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), *[pa.array(sums[used, i].astype(np.int64)) for i in range(WIDTH)]],
        ["row", *[f"v{i}" for i in range(WIDTH)]],
    )


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Word table of the whole corpus, rows of length one. Each task sends a table
    of fixed size, summed by row; the result has ``ROWS`` x ``WIDTH`` values."""
    schema = "row bigint, " + ", ".join(f"v{i} bigint" for i in range(WIDTH))
    sums = docs.select(F.col(text).cast("string")).mapInArrow(_sums, schema)
    sums = sums.groupBy("row").agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(WIDTH)])
    table = np.zeros((ROWS, WIDTH), np.float32)
    found = sums.toArrow()
    if found.num_rows:
        values = np.stack([found.column(f"v{i}").to_numpy() for i in range(WIDTH)], axis=1).astype(np.float64)
        size = np.linalg.norm(values, axis=1, keepdims=True)
        table[found.column("row").to_numpy()] = values / np.where(size > 0, size, 1)
    return table


def figures(text: str, tokens: list[bytes]) -> list[float]:
    """What a mean of word vectors cannot show: length, repetition, kinds of marks."""
    data = text.encode()
    n, lines = max(1, len(data)), text.split("\n")
    letters = [t for t in tokens if t[0] >= 0x80 or chr(t[0]).isalpha()]
    upper = sum(t.isupper() and len(t) > 1 for t in letters)
    return [
        np.log1p(len(data)) / 12,
        len(set(tokens)) / max(1, len(tokens)),
        len(set(lines)) / len(lines),
        len(letters) / max(1, len(tokens)),
        upper / max(1, len(letters)),
        sum(map(len, letters)) / n,
        np.log1p(n / len(lines)) / 12,
        np.log1p(sum(map(len, letters)) / max(1, len(letters))) / 4,
    ]


def _pooled(table: Broadcast):
    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, vectors = WordHashes(), table.value
        for batch in batches:
            out = np.zeros((batch.num_rows, WIDTH + FIGURES), np.float64)
            for row, text in zip(out, batch.column(1)):
                words = text.as_py() or ""
                tokens = tokens_of(words)
                if tokens:
                    row[:WIDTH] = vectors[row_of(hashes.of(tokens))].mean(axis=0)
                row[WIDTH:] = figures(words, tokens)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * out.shape[1]
            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel().astype(np.float32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "features"])

    return pooled


class Network:
    """Two layers: tanh, then a logistic output divided by a temperature."""

    def __init__(self, width: int, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.w1, self.b1 = rng.standard_normal((width, hidden)) / np.sqrt(width), np.zeros(hidden)
        self.w2, self.b2 = rng.standard_normal(hidden) / np.sqrt(hidden), np.zeros(1)
        self.temperature = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, decay: float = 1e-4, rate: float = 3e-3):
        """Adam on the log loss. One row in six is left out, to set the temperature."""
        if not len(y):
            return self
        rng = np.random.default_rng(SEED)
        order = rng.permutation(len(y))
        held, used = order[: len(y) // 6], order[len(y) // 6 :]
        self.mean, self.scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-6
        z = (x - self.mean) / self.scale
        values = [self.w1, self.b1, self.w2, self.b2]
        first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
        for _ in range(epochs):
            rng.shuffle(used)
            for a in range(0, len(used), BATCH):
                rows = used[a : a + BATCH]
                h = np.tanh(z[rows] @ self.w1 + self.b1)
                off = 1 / (1 + np.exp(-np.clip(h @ self.w2 + self.b2[0], -60, 60))) - y[rows]
                back = np.outer(off, self.w2) * (1 - h * h)
                grads = [z[rows].T @ back, back.sum(axis=0), h.T @ off, np.array([off.sum()])]
                step += 1
                for v, g, m, s in zip(values, grads, first, second):
                    g = g / len(rows) + decay * v
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        if len(held):
            self.temperature = self._calibrated(self.logits(x[held]), y[held])
        return self

    @staticmethod
    def _calibrated(logits: np.ndarray, y: np.ndarray) -> float:
        """The temperature of least log loss."""
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 200))
        q = np.clip(logits[None, :] / grid[:, None], -60, 60)
        return float(grid[(np.logaddexp(0, q) - q * y[None, :]).mean(axis=1).argmin()])


def _scored(network: Broadcast):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(network.value.scores(x), pa.float64())], ["doc_id", "score"]
            )

    return scored


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    fit_rows: int = FIT_ROWS,
    work: Workspace | None = None,
) -> DataFrame:
    """``(doc_id, score)`` for every row: the probability that its label is 1.

    Word vectors come from all documents. The network is fitted on at most
    ``fit_rows`` labelled rows that ``learn`` (over ``doc_id``) selects, taken in the
    order of a hash of the id. Labels other than 0 and 1 are passed over; a label
    that repeats counts again. Without any label the score is that of the untrained
    network.

    Null and empty texts have a zero vector and are scored like others; null ids
    are kept and never learned from; repeated rows are scored each; an empty table
    gives no rows. Only key and text are read; lang, source and id are no inputs.
    """
    spark: SparkSession = docs.sparkSession
    work = work or Workspace(spark, "quality")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    vectors = spark.sparkContext.broadcast(word_vectors(rows))
    pooled = work.stored(rows.mapInArrow(_pooled(vectors), "doc_id bigint, features array<float>"), "pooled")
    marked = labels.select(F.col(key).alias("doc_id"), F.col(label).alias("_label"))
    marked = marked.filter(F.col("_label").isin(0, 1) & F.col("doc_id").isNotNull())
    known = pooled.filter(learn).join(marked, "doc_id")
    fit = known.orderBy(F.xxhash64("doc_id"), "doc_id", "_label").limit(fit_rows).select("features", "_label").toArrow()
    network = Network(WIDTH + FIGURES)
    if fit.num_rows:
        x = fit.column("features").combine_chunks().flatten().to_numpy().reshape(fit.num_rows, -1)
        network.fit(x.astype(np.float64), fit.column("_label").to_numpy().astype(np.float64))
    shared = spark.sparkContext.broadcast(network)
    return pooled.mapInArrow(_scored(shared), "doc_id bigint, score double")

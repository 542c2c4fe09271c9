"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned filters slide over each chunk and keep
their largest response there; a document's chunks are combined by their mean and their maximum, and a logistic layer makes one
probability of these. A filter's response is a sum of one learned number for each byte value and place, so that scoring looks
up pairs of bytes in precomputed tables.

Rows: a null or empty text scores by the network's answer to padding alone, a text shorter than a filter by that to its bytes and
the padding behind them; a text of any length is read whole; rows with equal or null doc_ids are scored each for itself, equal texts alike; of places
that tie in a chunk the first learns; documents that are marked both ways, and marks whose label or doc_id is null, teach nothing;
without labels of both kinds, as with an empty labels table, every score is 0.5; an empty documents table gives no rows; other
columns of both tables, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordlake.llm.common import documents, is_held_out, kept_and, labelled_sample, labels, small_batches, texts_of

FILTERS = 24
WIDTH = 6
CHUNK = 512
OVERLAP = 64
#: Labelled documents of each kind from which the network learns.
SAMPLE = 1200
#: Chunks that are convolved at a time.
AT_ONCE = 64


def chunks_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All chunks of all texts, padded with byte 0, each text's first chunk (with the total last), and each chunk's number of own bytes."""
    step = CHUNK - OVERLAP
    raw = [t.encode("utf-8", "replace") for t in texts]
    counts = [max(1, -(-(len(b) - OVERLAP) // step)) for b in raw]
    first = np.concatenate(([0], np.cumsum(counts)))
    out = np.zeros((first[-1], CHUNK), np.uint8)
    for i, b in enumerate(raw):
        flat = np.zeros(OVERLAP + counts[i] * step, np.uint8)
        flat[: len(b)] = np.frombuffer(b, np.uint8)
        out[first[i] : first[i + 1]] = np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::step]
    own = np.repeat([len(b) for b in raw], counts) - step * (np.arange(first[-1]) - np.repeat(first[:-1], counts))
    return out, first, np.clip(own, 0, CHUNK)


def pooled(chunks: np.ndarray, own: np.ndarray, filters: np.ndarray, bias: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Largest response of each filter in each chunk (0 at least), and, if asked for, its place. filters: width x 256 x filters.

    Only places that begin in a chunk's own bytes count (in a chunk without any, the first), so that padding is seen at a text's end alone."""
    tables = [(filters[j][:, None, :] + filters[j + 1][None, :, :]).reshape(1 << 16, -1) for j in range(0, WIDTH, 2)]
    best = np.empty((len(chunks), filters.shape[2]), np.float32)
    place = np.empty(best.shape, np.int32) if where else None
    n = chunks.shape[1] - WIDTH + 1
    for at in range(0, len(chunks), AT_ONCE):
        some = chunks[at : at + AT_ONCE].astype(np.uint16)
        pairs = (some[:, :-1] << np.uint16(8)) | some[:, 1:]
        total = tables[0][pairs[:, :n]]
        for k, table in enumerate(tables[1:], 1):
            total += table[pairs[:, 2 * k : 2 * k + n]]
        for i, bytes_ in enumerate(own[at : at + AT_ONCE].tolist()):
            if bytes_ < n:
                total[i, max(bytes_, 1) :] = -np.inf
        if where:
            place[at : at + AT_ONCE] = total.argmax(axis=1)
        best[at : at + AT_ONCE] = total.max(axis=1)
    return np.maximum(best + bias, 0), place


def combined(features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean and maximum over each text's chunks."""
    counts = np.diff(first)[:, None]
    return np.hstack([np.add.reduceat(features, first[:-1], axis=0) / counts, np.maximum.reduceat(features, first[:-1], axis=0)])


@dataclass
class ByteNetwork:
    filters: np.ndarray
    filter_bias: np.ndarray
    weights: np.ndarray
    bias: float
    known: bool = True

    def score(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), 0.5)
        for at in range(0, len(texts) if self.known else 0, 256):
            chunks, first, own = chunks_of(texts[at : at + 256])
            logits = combined(pooled(chunks, own, self.filters, self.filter_bias)[0], first) @ self.weights + self.bias
            out[at : at + 256] = 1 / (1 + np.exp(-np.clip(logits.astype(float), -50, 50)))
        return out


def train(rows: list[tuple[str, int]], epochs: int = 6, batch: int = 48, rate: float = 0.02, seed: int = 2) -> ByteNetwork:
    """Adam over shuffled batches; a filter's gradient goes to the bytes under its largest response in each chunk."""
    y = np.array([label for _, label in rows], np.float32)
    random = np.random.default_rng(seed)
    filters = random.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
    filter_bias = np.zeros(FILTERS, np.float32)
    weights = random.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
    if not len(y) or y.min() == y.max():
        return ByteNetwork(filters, filter_bias, weights, 0.0, False)
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    step = 0
    values = [filters, filter_bias, weights, np.zeros(1, np.float32)]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    for epoch in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            chunks, first, sizes = chunks_of([rows[i][0] for i in own])
            features, place = pooled(chunks, sizes, values[0], values[1], where=True)
            both = combined(features, first)
            logits = both @ values[2] + values[3][0]
            error = ((1 / (1 + np.exp(-np.clip(logits, -50, 50))) - y[own]) * share[own] / len(own)).astype(np.float32)
            text_of = np.repeat(np.arange(len(own)), np.diff(first))
            to_mean = error[:, None] * values[2][:FILTERS] / np.diff(first)[:, None]
            to_features = to_mean[text_of] + (features == both[:, FILTERS:][text_of]) * (error[:, None] * values[2][FILTERS:])[text_of]
            to_features *= features > 0
            to_filters = np.zeros((WIDTH * 256 * FILTERS), np.float32)
            row = np.arange(len(chunks))[:, None]
            for j in range(WIDTH):
                bins = (j * 256 + chunks[row, place + j].astype(np.int64)) * FILTERS + np.arange(FILTERS)
                to_filters += np.bincount(bins.ravel(), to_features.ravel(), len(to_filters)).astype(np.float32)
            step += 1
            for k, gradient in enumerate((to_filters.reshape(filters.shape), to_features.sum(axis=0), both.T @ error, np.array([error.sum()], np.float32))):
                m, v = moments[k]
                m += 0.1 * (gradient - m)
                v += 0.01 * (gradient**2 - v)
                values[k] -= rate * (0.3 if epoch == epochs - 1 else 1) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return ByteNetwork(values[0], values[1], values[2], float(values[3][0]))


def fit(docs: DataFrame, marks: DataFrame, sample: int = SAMPLE) -> ByteNetwork:
    return train(labelled_sample(docs, marks, "quality", sample, seed=2))


def score_quality(docs: DataFrame, network: ByteNetwork, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and score of each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, len(keep)):
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(shared.value.score(texts_of(batch.column(len(keep)))))], [*keep, "score"])

    return docs.select(*keep, "text").mapInArrow(run, kept_and(docs, keep, "score double"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = score_quality(docs, fit(docs, labels(spark, sf_dir)))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))

"""Language identification by the nearest centroid of TF-IDF n-gram vectors.

A text is lower-cased, everything but letters becomes a space, and its byte pairs and triples are counted in hashed bins.
Counts are damped by a logarithm, weighted by inverse document frequency over all training documents and scaled to length 1.
Each language has several centroids, found by spherical k-means on a bounded sample; the language of the centroid with the
largest cosine is predicted. A text further from it than nearly all texts of the sample in that language, by a margin, is rejected.

Rows: a null or empty text, or one without a letter, is `und`, scores 0 and is rejected; a text of any length is read whole; rows
with equal or null doc_ids are scored each for itself; of languages that tie the first by name is predicted; a row with a null
doc_id or lang teaches nothing; without training rows all texts are `und`; an empty table gives no rows; other columns, whatever
their names, are kept by `keep_identified` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordlake.llm.common import as_rows, documents, is_held_out, kept_and, sample_by_class, small_batches

BITS = 12
BINS = 1 << BITS
#: Training documents of each language from which centroids are made, and centroids of each.
SAMPLE = 500
CENTROIDS = 4
#: A text is rejected below this share of a low quantile of its language's cosines in the sample; with fewer n-grams than FULL_SIZE, below less.
SLACK = 0.5
QUANTILE = 0.01
FULL_SIZE = 256
UNKNOWN = "und"

_TO_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: Odd multipliers of the pair and triple hashes.
_M = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393], np.uint32)


def counts_of(texts: list[str]) -> np.ndarray:
    """Hashed pair and triple counts, a row for each whole text."""
    out = np.zeros((len(texts), BINS), np.float32)
    down = np.uint32(32 - BITS)
    for i, text in enumerate(texts):
        clean = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_TO_LETTERS).split()) + b" "
        if len(clean) < 3:
            continue
        b = np.frombuffer(clean, np.uint8).astype(np.uint32)
        pair = b[:-1] * _M[0] + b[1:] * _M[1]
        triple = (pair[:-1] ^ (b[2:] * _M[2])) * _M[3]
        out[i] = np.bincount((pair * _M[4]) >> down, minlength=BINS)
        out[i] += np.bincount(triple >> down, minlength=BINS)
    return out


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


@dataclass
class CentroidModel:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray  # by centroid: cosines below are rejected; for texts of few n-grams, whose cosines are lower, proportionally less

    def reject_below(self, counts: np.ndarray, centroid: np.ndarray) -> np.ndarray:
        return self.least[centroid] * np.sqrt(np.minimum(counts.sum(axis=1) / FULL_SIZE, 1))

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        weighted = np.log1p(counts) * self.idf
        return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, cosines and whether each text is rejected."""
        names, scores, rejected = [], np.zeros(len(texts)), np.ones(len(texts), bool)
        for at in range(0, len(texts), 256):
            some = texts[at : at + 256]
            if not len(self.centroids):
                names += [UNKNOWN] * len(some)
                continue
            counts = counts_of(some)
            cosines = self.vectors(counts) @ self.centroids.T
            best = cosines.argmax(axis=1)
            known = np.array([has_letter(t) for t in some])
            score = np.where(known, np.clip(cosines[np.arange(len(some)), best], 0, 1), 0)
            names += [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            scores[at : at + len(some)] = score
            rejected[at : at + len(some)] = ~known | (score < self.reject_below(counts, best))
        return names, scores, rejected


def _clustered(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, begun at the mean and then at whatever is furthest from all centroids."""
    centroids = vectors.mean(axis=0, keepdims=True)
    centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-9)
    while len(centroids) < min(k, len(vectors)):
        furthest = (vectors @ centroids.T).max(axis=1).argmin()
        centroids = np.vstack([centroids, vectors[furthest]])
    for _ in range(rounds):
        own = (vectors @ centroids.T).argmax(axis=1)
        sums = np.vstack([vectors[own == j].sum(axis=0) if (own == j).any() else centroids[j] for j in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centroids


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Of every bin over all rows of docs (text), and the number of rows: sums of one vector for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BINS, np.int64), 0
        for batch in small_batches(batches, 0):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for at in range(0, len(texts), 256):
                total += (counts_of(texts[at : at + 256]) > 0).sum(axis=0)
            n += len(texts)
        yield pa.RecordBatch.from_pydict({"bin": pa.array(range(BINS + 1), pa.int32()), "n": pa.array([*total.tolist(), n], pa.int64())})

    found = np.zeros(BINS + 1, np.int64)
    for r in docs.select("text").mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        found[r["bin"]] = r["n"]
    return found[:BINS], int(found[BINS])


def fit(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> CentroidModel:
    """Learns from text and lang of the rows of docs that are not held out."""
    training = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~is_held_out(F.col("doc_id")))
    frequencies, n = document_frequencies(training)
    idf = np.log((1 + n) / (1 + frequencies)).astype(np.float32) + 1
    model = CentroidModel([], np.zeros((0, BINS), np.float32), idf, np.zeros(0))
    rows = [(t, lang) for t, lang in sample_by_class(training.select("doc_id", "text", F.col("lang").alias("label")), sample, seed=5) if has_letter(t)]
    if not rows:
        return model
    counts = counts_of([t for t, _ in rows])
    vectors = model.vectors(counts)
    marks = np.array([lang for _, lang in rows])
    found = []
    for lang in sorted(set(marks.tolist())):
        own = _clustered(vectors[marks == lang], centroids)
        found.append(own)
        model.languages += [lang] * len(own)
    model.centroids = np.vstack(found).astype(np.float32)
    nearest = (vectors @ model.centroids.T).max(axis=1)
    # each text's cosine is set against what its size would be given, so that short texts don't lower the bar for long ones
    full = nearest / np.sqrt(np.minimum(counts.sum(axis=1) / FULL_SIZE, 1).clip(1 / FULL_SIZE))
    by_language = {lang: SLACK * float(np.quantile(full[marks == lang], QUANTILE)) for lang in set(marks.tolist())}
    model.least = np.array([by_language[lang] for lang in model.languages])
    return model


def identify(docs: DataFrame, model: CentroidModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, lang_pred, score and rejected of each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, len(keep)):
            names, scores, rejected = shared.value.predict([t or "" for t in batch.column(len(keep)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)], [*keep, "lang_pred", "score", "rejected"])

    return docs.select(*keep, "text").mapInArrow(run, kept_and(docs, keep, "lang_pred string, score double, rejected boolean"))


def keep_identified(docs: DataFrame, model: CentroidModel) -> DataFrame:
    """Rows of docs whose language is not rejected, with all their columns."""
    return identify(as_rows(docs), model, keep=("own_row",)).filter(~F.col("rejected")).select("own_row.*")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = identify(docs, fit(docs))
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")

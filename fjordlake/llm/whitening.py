"""Whitening of embeddings by the leading principal components, found with the Jacobi-Davidson method.

The covariance is never formed. Its product with a few vectors at a time is one Spark pass over the rows, centred before they are
multiplied, whose tasks send back a sum of the vectors' size. The driver keeps a search space of a bounded number of vectors: the
Rayleigh-Ritz step takes the best approximations in it; those whose residual has come down to rounding are locked; for the others,
all at once, a correction equation projected against what is known is solved by a few steps of MINRES, each one such product, and
the corrections extend the space.

Rows: vectors that are null or hold null or non-finite entries take no part, nor do vectors whose length is not the commonest (of
equally common lengths the greatest); empty vectors give no rows; repeated rows count as often as they come, and so do rows without
an id; equal eigenvalues give some orthonormal components of their space, the same for all rows; components beyond the rank are left
out, so one row alone, like an empty table, gives none; integers must fit 64 bits, else the job fails; other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordlake.llm.common import written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Bytes of 64-bit entries in a block of rows; a longer vector stands alone.
BLOCK_BYTES = 4 << 20
#: Partial sums that come to the driver; more are first added up in so many tasks.
PARTIAL_SUMS = 64
#: Steps of MINRES for a correction, and rounds after which the method gives up.
INNER_STEPS, MOST_ROUNDS = 6, 200

_BLOCKS = "ids array<long>, entries binary"


def integers(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * entry) + shift of each entry; null where the vector takes no part."""
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.when(whole, F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(shift).cast("long")))


class Rows:
    """The rows (id, x) of one length in a written table of blocks, with their count, sums and the covariance's trace."""

    def __init__(self, rows: DataFrame):
        lengths = {r["k"]: r["n"] for r in rows.groupBy(F.size("x").alias("k")).agg(F.count("*").alias("n")).collect()}
        self.dim = max(lengths, key=lambda k: (lengths[k], k), default=0)
        self.n = lengths.get(self.dim, 0) if self.dim else 0
        if self.n:
            self.blocks = written(rows.filter(F.size("x") == self.dim).select("id", "x").mapInArrow(_in_blocks(self.dim), _BLOCKS), "vectors")
            self.sums = self.total(lambda x: x.sum(axis=0), np.int64, self.dim)
            n, sums = self.n, self.sums
            self.trace = float(self.total(lambda x: np.square(_centred(x, n, sums)).sum(), np.float64, 1)[0]) / n

    def total(self, part: Callable[[np.ndarray], np.ndarray], kind: type, size: int) -> np.ndarray:
        """The sum over all blocks of part(block), an array of `size` entries."""
        dim = self.dim

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, some = np.zeros(size, kind), False
            for batch in batches:
                for entries in batch.column(0):
                    sums, some = sums + np.ravel(part(np.frombuffer(entries.as_buffer(), "<i8").reshape(-1, dim))), True
            if some:
                yield pa.RecordBatch.from_pydict({"sums": [sums.tobytes()]}, schema=pa.schema([("sums", pa.binary())]))

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(size, kind)
            for batch in batches:
                for own in batch.column(0):
                    sums = sums + np.frombuffer(own.as_buffer(), kind)
            yield pa.RecordBatch.from_pydict({"sums": [sums.tobytes()]}, schema=pa.schema([("sums", pa.binary())]))

        sums = self.blocks.select("entries").mapInArrow(add, "sums binary")
        if sums.rdd.getNumPartitions() > PARTIAL_SUMS:
            sums = sums.repartition(PARTIAL_SUMS).mapInArrow(add_up, "sums binary")
        return np.sum([np.frombuffer(r["sums"], kind) for r in sums.collect()], axis=0, dtype=kind)

    def product(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance times vectors (a column each)."""
        n, sums = self.n, self.sums

        def part(x: np.ndarray) -> np.ndarray:
            own = _centred(x, n, sums)
            return own.T @ (own @ vectors)

        return self.total(part, np.float64, vectors.size).reshape(vectors.shape) / n


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x minus the mean, rounded once: n * x minus the sums is whole."""
    return (n * x - sums) / float(n)


def _in_blocks(dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    most = max(1, BLOCK_BYTES // (8 * dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                entries = part.column(1).flatten().to_numpy(zero_copy_only=False).astype("<i8")
                yield pa.RecordBatch.from_pydict({"ids": [part.column(0).to_pylist()], "entries": [entries.tobytes()]}, schema=pa.schema([("ids", pa.list_(pa.int64())), ("entries", pa.binary())]))

    return run


def _orthonormal(new: np.ndarray, *known: np.ndarray) -> np.ndarray:
    """Columns that extend known ones to more of the space; what depends on them or on each other is left out."""
    norms = np.linalg.norm(new, axis=0)
    new = new[:, norms > 0] / norms[norms > 0]
    for _ in range(3):
        for k in known:
            new = new - k @ (k.T @ new)
        if not new.shape[1]:
            return new
        left, values, _ = np.linalg.svd(new, full_matrices=False)
        new = left[:, values > 1e-8]
    return new


def corrections(product: Callable[[np.ndarray], np.ndarray], values: np.ndarray, known: np.ndarray, right: np.ndarray, steps: int) -> np.ndarray:
    """Columns t that lie across known and nearly solve P (A - value) P t = right, with P the projection across known.

    MINRES for all columns side by side: a Lanczos step each, its tridiagonal matrix reduced by rotations as it grows."""
    across = lambda v: v - known @ (known.T @ v)
    v = across(right)
    beta = np.linalg.norm(v, axis=0)
    safe = lambda x: np.where(x > 0, x, 1.0)
    before, v = np.zeros_like(v), v / safe(beta)
    x, w_before, w = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    c, c_before, s, s_before = (np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta))
    left, off = beta.copy(), np.zeros_like(beta)
    for _ in range(steps):
        p = across(product(v) - v * values)
        alpha = (v * p).sum(axis=0)
        p = across(p - v * alpha - before * off)
        following = np.linalg.norm(p, axis=0)
        # the last column of the tridiagonal matrix after the two rotations before, then one that clears what follows
        third, second = s_before * off, c_before * off
        upper = c * second + s * alpha
        main = -s * second + c * alpha
        norm = np.hypot(main, following)
        w_new = (v - upper * w - third * w_before) / safe(norm)
        c_before, s_before = c, s
        c, s = np.where(norm > 0, main / safe(norm), 1.0), np.where(norm > 0, following / safe(norm), 0.0)
        x = x + w_new * (c * left)
        left = -s * left
        before, v = v, p / safe(following)
        w_before, w, off = w, w_new, following
        if (np.abs(left) <= 1e-3 * beta).all():
            break
    return x


def leading_components(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, inner_steps: int = INNER_STEPS, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a symmetric positive semidefinite matrix, falling, and their unit eigenvectors as columns.

    product gives the matrix times a few columns. A pair is locked when its residual is that of rounding."""
    wanted = min(wanted, dim)
    most = min(dim, max(3 * wanted, wanted + 8))
    space = _orthonormal(np.random.default_rng(seed).standard_normal((dim, min(dim, wanted + 4))))
    image = product(space)
    locked, locked_values = np.zeros((dim, 0)), np.zeros(0)
    best = np.inf
    for _ in range(MOST_ROUNDS):
        small = space.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, ritz_image = space @ turn, image @ turn
        need = min(wanted - locked.shape[1], ritz.shape[1])
        residual = ritz_image[:, :need] - ritz[:, :need] * values[:need]
        residual -= locked @ (locked.T @ residual)
        sizes = np.linalg.norm(residual, axis=0)
        scale = max([*locked_values[:1], *values[:1], 0.0])
        whole = locked.shape[1] + space.shape[1] == dim
        rounding = 64 * np.finfo(float).eps * scale
        # pairs are locked from the greatest on, so that none is passed over
        done = need if whole else int(np.argmax(np.append(sizes > rounding, True)))
        locked, locked_values = np.hstack([locked, ritz[:, :done]]), np.append(locked_values, values[:done])
        if locked.shape[1] == wanted:
            order = np.argsort(-locked_values, kind="stable")
            return locked_values[order], locked[:, order]
        sizes, residual, values, ritz, ritz_image, need = sizes[done:], residual[:, done:], values[done:], ritz[:, done:], ritz_image[:, done:], need - done
        if locked.shape[1] + ritz.shape[1] + need > most:
            keep = max(need + 4, most - locked.shape[1] - 2 * need)
            ritz, ritz_image = ritz[:, :keep], ritz_image[:, :keep]
        open_ = sizes > rounding
        known = np.hstack([locked, ritz[:, :need]])
        found = corrections(product, values[:need][open_], known, -residual[:, open_], inner_steps)
        new = _orthonormal(found, locked, ritz)
        if not new.shape[1]:  # nothing new in the corrections: go on from a fresh direction
            new = _orthonormal(np.random.default_rng(seed + 1).standard_normal((dim, min(4, dim - locked.shape[1] - ritz.shape[1]))), locked, ritz)
        best = min(best, float(sizes.max()))
        space, image = np.hstack([ritz, new]), np.hstack([ritz_image, product(new)])
    raise ArithmeticError(f"no convergence in {MOST_ROUNDS} rounds; the largest residual left was {best:.3g}")


_WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each of rows (id, x: integers) and component; see the module's text. identity_error is measured over all rows."""
    own = Rows(rows)
    empty = rows.sparkSession.createDataFrame([], _WHITENED + ", identity_error double")
    if not own.n:
        return empty
    values, vectors = leading_components(own.product, own.dim, components)
    rank = int((values > max(values[0], 0.0) * own.dim * 64 * np.finfo(float).eps).sum())
    values, vectors = values[:rank], vectors[:, :rank]
    if not rank:
        return empty
    n, sums, dim, trace = own.n, own.sums, own.dim, own.trace
    weights = vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, sums) @ weights
        return np.vstack([w.T @ w, w.sum(axis=0)])

    found = own.total(moments, np.float64, (rank + 1) * rank).reshape(rank + 1, rank) / n
    error = float(np.abs(found[:rank] - np.outer(found[rank], found[rank]) - np.eye(rank)).max())
    explained = values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, 50_000 // rank)
        for batch in batches:
            for ids, entries in zip(batch.column(0), batch.column(1)):
                ids, x = ids.as_py(), np.frombuffer(entries.as_buffer(), "<i8").reshape(-1, dim)
                for at in range(0, len(ids), step):
                    part = x[at : at + step]
                    whole = n * part - sums
                    if float(np.abs(whole).max()) ** 2 * dim >= 2.0**63:
                        raise OverflowError("a squared deviation does not fit 64 bits")
                    k = len(part)
                    columns = {
                        "vec_id": pa.array(ids[at : at + step], pa.int64()).take(pa.array(np.repeat(np.arange(k), rank))), "component": pa.array(np.tile(np.arange(1, rank + 1, dtype=np.int32), k)), "n": pa.array(np.full(k * rank, n, np.int64)),
                        "deviation": pa.array(np.repeat(np.square(whole).sum(axis=1), rank)), "whitened": pa.array((whole / float(n) @ weights).ravel()), "explained": pa.array(np.tile(explained, k)),
                    }
                    yield pa.RecordBatch.from_pydict(columns)

    return own.blocks.mapInArrow(run, _WHITENED).withColumn("identity_error", F.lit(error))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whiten(table.select(F.col("vec_id").cast("long").alias("id"), integers(F.col("embedding")).alias("x")).filter(F.col("x").isNotNull()))

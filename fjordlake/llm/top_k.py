"""Exact top-k search by inner product with MaxScore.

A vector's components are the terms. Rows are gathered into shards where they lie, without a shuffle; each shard holds, term by
term, the values of all its vectors and their range, which bounds what a term can add to a query's score beyond the least it
adds to anyone. For a query, terms are ordered by that bound. While the bounds of the remaining terms could still lift an unseen
vector past the k-th best score known, terms are essential and their postings are traversed whole; the others are probed only
for vectors that stay competitive, and after every few of them those that no longer are fall out. Shards' results are merged.

Shards stay in their table. Queries come to them in batches of bounded size, each a broadcast, and a task carries its k best of
every query from shard to shard, so that only those are shuffled: bytes grow with the rows and with the queries, not with their
product, while the work of comparing does.

Rows: vectors that are null or hold null or non-finite components, and rows with a null id, take no part; each row stands for
itself, also where rows share an id or a vector, so a query meets every row but its own, and ties go to the smaller id; vectors
meet only others of their length, empty ones included; a vector of any length fits if it fits a task's memory; scores must fit
64 bits; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fjordlake.llm.common import written

#: Bytes of vectors in a shard, and about those of the queries that are broadcast at a time; a larger vector stands alone.
SHARD_BYTES = 4 << 20
QUERY_BYTES = 32 << 20
SCALE = 256

_SHARDS = "dim int, keys binary, ids binary, values binary, asked binary"


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as a double; null where the vector takes no part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(whole, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def shards_of(rows: DataFrame, shard_bytes: int) -> DataFrame:
    """rows (id, asks, vector) in shards: 64-bit little-endian keys (which name a row for good), ids, values and marks of queries; a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        key = TaskContext.get().partitionId() << 40
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}
        sizes: dict[int, int] = {}

        def closed(dim: int) -> pa.RecordBatch:
            keys, ids, asked, values = (np.concatenate(x) for x in zip(*held.pop(dim)))
            sizes.pop(dim)
            row = {"dim": [dim], "keys": [keys.tobytes()], "ids": [ids.tobytes()], "values": [values.tobytes()], "asked": [asked.tobytes()]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("dim", pa.int32()), *((c, pa.binary()) for c in ("keys", "ids", "values", "asked"))]))

        for batch in batches:
            ids, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            flat, bounds = batch.column(2).flatten().to_numpy(), np.cumsum([0, *batch.column(2).value_lengths().to_pylist()])
            dims = np.diff(bounds)
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                most = max(1, shard_bytes // (8 * dim + 17))
                for at in range(0, len(own), most):
                    some = own[at : at + most]
                    values = flat[bounds[some][:, None] + np.arange(dim)]
                    held.setdefault(dim, []).append((key + some, ids[some], asks[some].astype(np.uint8), values.ravel()))
                    sizes[dim] = sizes.get(dim, 0) + len(some)
                    if sizes[dim] >= most:
                        yield closed(dim)
            key += len(ids)
            while sum(n * (8 * d + 17) for d, n in sizes.items()) > 4 * shard_bytes:
                yield closed(max(sizes, key=lambda d: sizes[d] * (8 * d + 17)))
        for dim in list(held):
            yield closed(dim)

    return written(rows.mapInArrow(run, _SHARDS), "vectors")


def queries_of(shards: DataFrame) -> DataFrame:
    """The queries among the vectors of each shard: dim, keys, ids and values; a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                keys, ids, values = _unpacked(r)
                asks = np.flatnonzero(np.frombuffer(r["asked"], np.uint8))
                if len(asks):
                    yield pa.RecordBatch.from_pydict({"dim": pa.array([r["dim"]], pa.int32()), "keys": [keys[asks].tobytes()], "ids": [ids[asks].tobytes()], "values": [values[asks].tobytes()]})

    return written(shards.mapInArrow(run, "dim int, keys binary, ids binary, values binary"), "queries")


def _unpacked(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys = np.frombuffer(r["keys"], "<i8")
    return keys, np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["values"], "<i8").reshape(len(keys), r["dim"])


class Postings:
    """One shard: values term by term, and their ranges."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, values: np.ndarray):
        self.keys, self.ids = keys, ids
        self.terms = np.ascontiguousarray(values.T)
        self.high, self.low = self.terms.max(axis=1), self.terms.min(axis=1)

    def top(self, own: int, query: np.ndarray, k: int, known: int | None = None, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the k best vectors other than the row `own`, ties to the smaller id; those below the score `known` may be left out."""
        least, most = np.minimum(query * self.low, query * self.high), np.maximum(query * self.low, query * self.high)
        bound = most - least  # of what a term adds beyond the least
        order = np.argsort(-bound, kind="stable")
        others = np.flatnonzero(self.keys != own)
        base, rest = int(least.sum()), int(bound.sum())
        threshold = 0 if known is None else known - base
        if len(others) >= k:
            start = others[:: max(1, len(others) // 256)] if len(others) >= 256 else others  # a first threshold from some full scores
            threshold = max(threshold, int(np.partition(query @ self.terms[:, start], -k)[-k]) - base) if len(start) >= k else threshold
        part = np.zeros(len(self.ids), np.int64)
        at = 0
        while at < len(order) and rest >= threshold:  # essential: an unseen vector could still be among the best
            t = order[at]
            part += query[t] * self.terms[t] - least[t]
            rest -= int(bound[t])
            at += 1
        alive = others[part[others] + rest >= threshold]
        while at < len(order) and len(alive):  # the others are probed for competitive vectors alone
            some = order[at : at + step]
            part[alive] += query[some] @ self.terms[some][:, alive] - least[some].sum()
            rest -= int(bound[some].sum())
            at += step
            if len(alive) > k:
                threshold = max(threshold, int(np.partition(part[alive], -k)[-k]))
            alive = alive[part[alive] + rest >= threshold]
        return best_of(self.ids[alive], part[alive] + base, k)


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    best = np.lexsort((ids, -scores))[:k]
    return ids[best], scores[best]


def _search(shards: DataFrame, queries: list[dict], k: int) -> DataFrame:
    """key, query_id, vec_id and score of the k best of each task's shards for each of the queries; a written table."""
    shared = shards.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        for r in shared.value:
            asked.setdefault(r["dim"], []).extend(zip(*(x.tolist() for x in _unpacked(r)[:2]), _unpacked(r)[2]))
        found: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                postings = Postings(*_unpacked(r))
                for key, query_id, vector in asked.get(r["dim"], ()):
                    _, ids, scores = found.get(key, (0, np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    new, points = postings.top(key, vector, k, int(scores[-1]) if len(scores) == k else None)
                    if len(new):
                        found[key] = (query_id, *best_of(np.concatenate([ids, new]), np.concatenate([scores, points]), k))
        if found:
            sizes = [len(ids) for _, ids, _ in found.values()]
            columns = (np.repeat(list(found), sizes), np.repeat([q for q, _, _ in found.values()], sizes), np.concatenate([x[1] for x in found.values()]), np.concatenate([x[2] for x in found.values()]))
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["key", "query_id", "vec_id", "score"])

    out = written(shards.select("dim", "keys", "ids", "values").mapInArrow(run, "key long, query_id long, vec_id long, score long"), "found")
    shared.destroy()
    return out


def top_k(vectors: DataFrame, queries: Column, k: int = 5, shard_bytes: int = SHARD_BYTES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank, vec_id and score: for each row of vectors (vec_id, embedding) that fulfils `queries`, the k best others by the inner product of quantized vectors."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("asks"), quantized(F.col("embedding")).alias("vector"))
    shards = shards_of(rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull()), shard_bytes)
    asked = queries_of(shards)
    size = asked.agg(F.sum(F.octet_length("values") + F.octet_length("keys") * 2)).collect()[0][0] or 0
    batches = max(1, math.ceil(size / query_bytes))
    batch = F.pmod(F.xxhash64("keys"), F.lit(batches))
    each = []
    for n in range(batches):
        own = [r.asDict() for r in asked.filter(batch == n).collect()]
        if own or not each:
            each.append(_search(shards, own, k))
    found = each[0]
    for more in each[1:]:
        found = found.unionByName(more)
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0)

"""Packing of documents' tokens into sequences of one window, by non-negative least squares over a length histogram.

Whole windows are cut off each document first. What is left has a length below the window; combinations of two or three such
lengths that fill a window exactly are the columns of a least-squares problem whose right side is the histogram of left
lengths. Its solution, rounded down where counts run out, says how often each combination is used. Residuals are packed
greedily: the longest first, then always the longest that still fits, as long as that fills a window exactly. Only what is left
then is laid end to end and cut at window borders; the last stretch is cut into powers of two, so no sequence needs padding.

Rows: null and empty texts give the end id alone; a text of any length is packed whole; rows with equal or null doc_ids are packed
each for itself, documents whose lengths tie in the order in which they were read; an empty table gives no rows; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fjordlake.llm.common import documents, shuffle_partitions, small_batches, texts_of, written
from fjordlake.llm.tokens import encoder

WINDOW = 1024
#: Lengths, the most frequent ones, from which combinations of three are formed; those of two use every length. This bounds the
#: least-squares problem, not the data: other lengths are packed greedily.
TRIPLE_LENGTHS = 96
#: Pieces that a worker keeps twice over while it encodes.
PIECES = 150_000


def combinations(histogram: np.ndarray, window: int, triple_lengths: int = TRIPLE_LENGTHS) -> list[tuple[int, ...]]:
    """Two or three present lengths that add up to the window."""
    present = {int(x) for x in np.flatnonzero(histogram)}
    out: list[tuple[int, ...]] = [(a, window - a) for a in range(1, window // 2 + 1) if a in present and window - a in present]
    often = sorted(sorted(present, key=lambda x: (-histogram[x], x))[:triple_lengths])
    for a, b in combinations_with_replacement(often, 2):
        c = window - a - b
        if c >= b and c in present:
            out.append((a, b, c))
    return out


def nonnegative_least_squares(columns: np.ndarray, target: np.ndarray, rounds: int = 300) -> np.ndarray:
    """min |columns x - target|, x >= 0, by accelerated projected gradients."""
    x = y = np.zeros(columns.shape[1])
    if not len(x):
        return x
    largest = np.ones(columns.shape[1])  # towards the largest singular value's vector
    for _ in range(30):
        largest = columns.T @ (columns @ (largest / np.linalg.norm(largest)))
    step = 1.0 / (1.05 * np.linalg.norm(largest))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * (columns.T @ (columns @ y - target)), 0)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x


def plan(histogram: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations with the number of sequences that each fills, greedy ones last; no length is used oftener than it occurs."""
    options = combinations(histogram, window)
    columns = np.zeros((window, len(options)))
    for j, lengths in enumerate(options):
        for x in lengths:
            columns[x, j] += 1
    solved = nonnegative_least_squares(columns, histogram.astype(float))
    left, out = histogram.astype(np.int64).copy(), {}

    def use(j: int, most: int) -> None:
        needs = {x: options[j].count(x) for x in options[j]}
        n = int(min(most, *(left[x] // k for x, k in needs.items())))
        if n > 0:
            out[options[j]] = out.get(options[j], 0) + n
            for x, k in needs.items():
                left[x] -= n * k

    order = np.argsort(-solved, kind="stable").tolist()
    for j in order:
        use(j, int(np.floor(solved[j] + 1e-6)))
    for j in order:  # what rounding has left over
        use(j, int(histogram.sum()))
    return sorted(out.items()) + greedy(left, window)


def greedy(left: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Windows of the lengths in left (a histogram, from which they are taken), each filled exactly: the longest, then always the longest that fits."""
    out = []
    for x in range(window - 1, 0, -1):
        while left[x]:
            used, chosen, gap, y = {x: 1}, [x], window - x, x
            while gap:
                y = min(y, gap)
                while y and left[y] <= used.get(y, 0):
                    y -= 1
                if not y:
                    break
                used[y] = used.get(y, 0) + 1
                chosen.append(y)
                gap -= y
            if gap:
                break
            times = min(int(left[k]) // n for k, n in used.items())
            for k, n in used.items():
                left[k] -= times * n
            out.append((tuple(chosen), times))
    return out


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, drops_space: bool) -> DataFrame:
    """part and row (which name a row for good), doc_id, n and ids of each document, its end id included; a written table."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, row = TaskContext.get().partitionId(), 0
        tokens = encoder(tokenizer, drops_space, PIECES)
        end = np.array([end_id], tokens.type).tobytes()
        for batch in small_batches(batches, 1, keeps=True):
            own = [x + end for x in tokens.encode_all(texts_of(batch.column(1)))]
            if own:
                yield pa.RecordBatch.from_pydict({"part": pa.array([part] * len(own), pa.int32()), "row": pa.array(range(row, row + len(own)), pa.int64()), "doc_id": batch.column(0), "n": pa.array([len(x) // tokens.width for x in own], pa.int64()), "width": pa.array([tokens.width] * len(own), pa.int32()), "ids": pa.array(own, pa.binary())})
            row += len(own)

    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, "part int, row long, doc_id long, n long, width int, ids binary"), "packing")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW, drops_space: bool = False) -> DataFrame:
    """Pieces: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id and offset.

    Only the histogram (below one row for each length under the window) comes to the driver. A document's rank among those
    of its length is counted within salted groups, whose sizes are added up apart, so that a length that many documents
    share is dealt over many tasks."""
    spark = docs.sparkSession
    tokens = tokenized(docs, tokenizer, end_id, drops_space)
    sized = tokens.select("part", "row", (F.col("n") % window).cast("int").alias("left"), F.expr(f"n div {window}").alias("whole"), F.pmod(F.xxhash64("part", "row"), F.lit(shuffle_partitions(spark))).cast("int").alias("salt"))
    groups = sized.groupBy("left", "salt").agg(F.count("*").alias("n"), F.sum("whole").alias("whole"))
    totals = groups.groupBy("left").agg(F.sum("n").alias("n"), F.sum("whole").alias("whole")).orderBy("left").collect()
    histogram, whole_base, whole = np.zeros(window, np.int64), np.zeros(window, np.int64), 0
    for r in totals:
        histogram[r["left"]] = r["n"]
        whole_base[r["left"]] = whole
        whole += r["whole"]
    histogram[0] = 0
    slots: dict[int, list[tuple[int, int, int]]] = {}  # by length: how many documents fill this place, its first sequence, its offset
    sequence = whole
    for lengths, times in plan(histogram, window):
        offset = 0
        for x in lengths:
            slots.setdefault(x, []).append((times, sequence, offset))
            offset += x
        sequence += times
    planned = np.zeros(window, np.int64)
    for x, places in slots.items():
        planned[x] = sum(p[0] for p in places)
    rest = (histogram - planned) * np.arange(window)
    rest_base = np.cumsum(rest) - rest
    rest_first, rest_all = sequence, int(rest.sum())
    tail_at = rest_all - rest_all % window
    tail = []  # (position, sequence) where a stretch of a power of two begins
    at, number = tail_at, rest_first + tail_at // window
    while at < rest_all:
        tail.append((at, number))
        at += 1 << ((rest_all - at).bit_length() - 1)
        number += 1
    tail_starts = np.array([x[0] for x in tail], np.int64)
    place_ends = {x: np.cumsum([p[0] for p in places]) for x, places in slots.items()}

    def stretches(position: int, length: int) -> Iterator[tuple[int, int, int]]:
        """sequence, offset and length of the pieces of a left part laid at this position."""
        while length:
            if position < tail_at:
                number, offset = rest_first + position // window, position % window
                size = min(length, window - offset)
            else:
                k = int(np.searchsorted(tail_starts, position, "right")) - 1
                offset = position - tail[k][0]
                number = tail[k][1]
                end = tail[k + 1][0] if k + 1 < len(tail) else rest_all
                size = min(length, end - position)
            yield number, offset, size
            position += size
            length -= size

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 7):
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
            for r in batch.to_pylist():
                n, left, rank = r["n"], r["left"], r["rank"]
                ids = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4").tobytes()
                pieces = [(int(whole_base[left]) + r["before"] + i, 0, window) for i in range(r["whole"])]
                if left and rank < planned[left]:
                    k = int(np.searchsorted(place_ends[left], rank, "right"))
                    times, first, offset = slots[left][k]
                    pieces.append((first + rank - (int(place_ends[left][k]) - times), offset, left))
                elif left:
                    pieces += stretches(int(rest_base[left]) + (rank - int(planned[left])) * left, left)
                start = 0
                for number, offset, length in pieces:
                    for k, v in zip(out, (r["doc_id"], start, length, ids[4 * start : 4 * (start + length)], n, number, offset)):
                        out[k].append(v)
                    start += length
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()], list(out))

    in_order = Window.partitionBy("left").orderBy("salt")
    bases = groups.select("left", "salt", (F.sum("n").over(in_order) - F.col("n")).alias("rank_base"), (F.sum("whole").over(in_order) - F.col("whole")).alias("whole_base"))
    in_group = Window.partitionBy("left", "salt").orderBy("part", "row")
    ranked = sized.select("part", "row", "left", "salt", "whole", (F.row_number().over(in_group) - 1).alias("nth"), (F.sum("whole").over(in_group) - F.col("whole")).alias("own"))
    placed = ranked.join(bases, ["left", "salt"]).select("part", "row", "left", "whole", (F.col("rank_base") + F.col("nth")).alias("rank"), (F.col("whole_base") + F.col("own")).alias("before"))
    rows = tokens.join(placed, ["part", "row"]).select("doc_id", "n", "width", "left", "whole", "rank", "before", "ids")
    return rows.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

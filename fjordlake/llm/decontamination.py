"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

A test string is a window of consecutive words of a benchmark item. Shift tables over blocks of two words say how far the
search may jump; where the jump is zero, the block's bucket names the test strings that end so, and direct comparison
confirms them. Windows of different lengths (items shorter than the window) have a search each.

Tables are flat arrays: a shift table is indexed by a block's hash (equal hashes keep the least jump, which only costs a look),
and a bucket is a stretch of the sorted hashes of test strings' suffixes and of the whole strings. So a shard of the benchmark
takes about eight times its own bytes, and its bound is set from that. One shard is the usual case and is broadcast. More are built
one after another, each a file that Spark brings to every executor; a task then takes its documents in groups and searches each
group with one shard after another, so that documents are read once, never shuffled, and a worker holds one shard at a time.

Rows: null, empty or wordless texts have no words and no hits; a text of any length is searched whole; a null item_id still marks
words but is not listed; item rows that are repeated, or tie in a test string, count once an item; rows with equal or null doc_ids
are searched each for itself; an empty benchmark finds nothing; an empty documents table gives no rows; other columns of both,
whatever their names, are ignored by `find_contamination` and those of documents kept by `drop_contaminated`.
"""

from __future__ import annotations

import math
import pickle
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordlake.llm.common import as_rows, documents, file_for_tasks, kept_and, small_batches, texts_of

WINDOW = 10
BLOCK = 2
#: Bytes of benchmark text in a shard. Driver and workers each hold its tables: 8 MB of random words take 230 MB while they are built, 70 MB after.
SHARD_BYTES = 8_000_000
#: Bytes of text that a worker searches with one shard before it loads the next.
GROUP_BYTES = 32_000_000

#: Bytes of a word stay, A-Z become a-z, all others become spaces.
_WORD_BYTES = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

#: Stands for a null item_id.
NO_ITEM = -(1 << 63)

FOUND = "n_words long, starts array<int>, ends array<int>, items array<long>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class WuManber:
    """Search for word strings of one length. Test strings are stretches of `text`, where words are parted by single spaces."""

    def __init__(self, length: int, text: bytes, places: np.ndarray, blocks: np.ndarray):
        """places: key (hashes of the last block and of the whole), begin, end and item (or NO_ITEM) of each test string. blocks: hash and least jump of each block in one."""
        self.length, self.block = length, min(BLOCK, length)
        self.furthest = length - self.block + 1
        self.text = text
        self.mask = (1 << min(24, max(10, (8 * places.shape[1]).bit_length()))) - 1
        shift = np.full(self.mask + 1, self.furthest, np.uint8)
        np.minimum.at(shift, blocks[0] & self.mask, blocks[1].astype(np.uint8))
        self.shift = shift.tobytes()
        # equal test strings become one with several items; unequal ones of equal hashes stay apart
        keys = places[0].view(np.uint64)
        order = np.argsort(keys, kind="stable")
        edges = np.concatenate(([0], np.flatnonzero(np.diff(keys[order])) + 1, [len(order)]))
        new = np.ones(len(order), bool)
        begins, ends = places[1], places[2]
        for at in np.flatnonzero(np.diff(edges) > 1).tolist():
            start, stop = int(edges[at]), int(edges[at + 1])
            own: dict[bytes, list[int]] = {}
            for i in order[start:stop].tolist():
                own.setdefault(text[begins[i] : ends[i]], []).append(i)
            order[start:stop] = [i for same in own.values() for i in same]
            new[start:stop] = False
            new[start + np.cumsum([0, *(len(same) for same in own.values())])[:-1]] = True
        first = order[new]
        self.keys, self.begins, self.ends = array("Q", keys[first].tobytes()), begins[first], ends[first]
        self.first_item = np.append(np.flatnonzero(new), len(order))
        self.items = places[3][order]

    def search(self, words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """Where test strings begin, and the items that hold them."""
        at, n, shift, mask, back, crc = self.length - 1, len(words), self.shift, self.mask, self.length - 1, zlib.crc32
        while at < n:
            suffix = crc(words[at - 1] + b" " + words[at] if self.block == 2 else words[at])
            jump = shift[suffix & mask]
            if jump:
                at += jump
                continue
            start = at - back
            own = b" ".join(words[start : at + 1])
            key = suffix << 32 | crc(own)
            i = bisect_left(self.keys, key)
            while i < len(self.keys) and self.keys[i] == key:
                if self.text[self.begins[i] : self.ends[i]] == own:
                    items = self.items[self.first_item[i] : self.first_item[i + 1]]
                    yield start, items[items != NO_ITEM]
                i += 1
            at += 1


def searchers(rows: list[tuple[int | None, str | None]], window: int) -> list[WuManber]:
    """A search for each length of test strings that the items have."""
    text, at = [], 0
    places: dict[int, list[np.ndarray]] = {}
    blocks: dict[int, list[np.ndarray]] = {}
    for item, raw in rows:
        words = words_of(raw)
        size = min(window, len(words))
        if not size:
            continue
        own, block = b" ".join(words), min(BLOCK, size)
        firsts = np.cumsum([0, *(len(w) + 1 for w in words)])
        begins, ends = firsts[:-1].tolist(), (firsts[1:] - 1).tolist()
        suffixes = np.array([zlib.crc32(own[a:b]) for a, b in zip(begins, ends[block - 1 :])], np.int64)
        wholes = np.array([zlib.crc32(own[a:b]) for a, b in zip(begins, ends[size - 1 :])], np.int64)
        key = suffixes[size - block :].view(np.uint64) << np.uint64(32) | wholes.view(np.uint64)
        n = len(wholes)
        places.setdefault(size, []).append(np.stack([key.view(np.int64), at + firsts[:n], at + firsts[size:] - 1, np.full(n, NO_ITEM if item is None else item, np.int64)]))
        blocks.setdefault(size, []).append(np.stack([suffixes, np.maximum(size - block - np.arange(len(suffixes)), 0)]))
        text.append(own)
        at += len(own) + 1
    whole = b" ".join(text)
    return [WuManber(size, whole, np.concatenate(places.pop(size), axis=1), np.concatenate(blocks.pop(size), axis=1)) for size in sorted(places)]


def _found(text: str, tables: list[WuManber]) -> tuple[int, list[int], list[int], list[int]]:
    """Number of words, disjoint hit stretches and items of one text."""
    words = words_of(text)
    hits, items = [], set()
    for table in tables:
        for start, own in table.search(words):
            hits.append((start, start + table.length))
            items.update(own.tolist())
    return len(words), *_disjoint(hits), sorted(items)


def _disjoint(hits: Iterable[tuple[int, int]]) -> tuple[list[int], list[int]]:
    starts, ends = [], []
    for start, end in sorted(hits):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _in_all(texts: list[str], shards: list[Callable[[], list[WuManber]]]) -> list[tuple[int, list[int], list[int], list[int]]]:
    """Findings of each text by all shards, one of which is loaded at a time."""
    found: list = []
    for load in shards:
        tables = load()
        own = [_found(text, tables) for text in texts]
        del tables
        found = [(n, *_disjoint([*zip(a, b), *zip(c, d)]), sorted({*x, *y})) if x or a else (n, c, d, y) for (_, a, b, x), (n, c, d, y) in zip(found, own)] if found else own
    return found


def _search(docs: DataFrame, shards: list[Callable[[], list[WuManber]]], keys: list[str], group_bytes: int) -> DataFrame:
    """Findings of each row; docs has the columns `keys` and text."""

    def of(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = iter(_in_all([t for b in batches for t in texts_of(b.column(len(keys)))], shards))
        for batch in batches:
            own = list(islice(found, batch.num_rows))
            columns = [list(c) for c in zip(*own)] or [[]] * 4
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), *(pa.array(x, k) for x, k in zip(columns, kinds))], [*keys, "n_words", "starts", "ends", "items"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in small_batches(batches, len(keys)):
            held.append(batch)
            size += pc.sum(pc.binary_length(batch.column(len(keys)))).as_py() or 0
            if len(shards) == 1 or size >= group_bytes:
                yield from of(held)
                held, size = [], 0
        if held:
            yield from of(held)

    return docs.select(*keys, "text").mapInArrow(run, kept_and(docs, keys, FOUND))


def _file_of(spark: SparkSession, tables: list[WuManber], k: int) -> Callable[[], list[WuManber]]:
    """Writes tables to the shared folder for Spark to bring to executors; loads them there."""
    name = file_for_tasks(spark, f"shard-{k}", pickle.dumps(tables, pickle.HIGHEST_PROTOCOL))

    def load() -> list[WuManber]:
        with open(SparkFiles.get(name), "rb") as file:
            return pickle.load(file)

    return load


def _covered(starts: Column, ends: Column) -> Column:
    """Words in any of the stretches, which may overlap."""
    spans = F.array_sort(F.arrays_zip(starts.alias("s"), ends.alias("e")))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to"))
    return F.aggregate(
        spans,
        zero,
        lambda a, x: F.struct((a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["to"]), F.lit(0))).cast("long").alias("n"), F.greatest(a["to"], x["e"]).alias("to")),
        lambda a: a["n"],
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, keep: tuple[str, ...] = ("doc_id",), group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The columns `keep` of each row of docs, n_words, n_hit, items (ids of items with an occurring window), starts and ends of hit stretches (words)."""
    spark = docs.sparkSession
    size = benchmark.agg(F.sum(F.octet_length("text")).alias("n")).collect()[0]["n"] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))

    def tables(k: int) -> list[WuManber]:
        rows = benchmark.filter(F.col("text").isNotNull() & (shard == k)).select(F.col("item_id").cast("long"), "text").distinct().collect()
        return searchers([tuple(r) for r in rows], window)

    if shards == 1:
        shared = spark.sparkContext.broadcast(tables(0))
        loads = [lambda: shared.value]
    else:
        loads = [_file_of(spark, tables(k), k) for k in range(shards)]
    found = _search(docs, loads, list(keep), group_bytes)
    return found.select(*keep, "n_words", _covered(F.col("starts"), F.col("ends")).alias("n_hit"), "items", "starts", "ends")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of docs in which no test string occurs, with all their columns."""
    found = find_contamination(as_rows(docs), benchmark, keep=("own_row",))
    return found.filter(F.col("n_hit") == 0).select("own_row.*")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))

"""Token-ID output: documents as Simple-8b coded token files, in ascending doc_id order.

A file set is a Parquet folder of chunks, each a run of whole documents: their doc_ids and lengths, the coded words and the
first word of each block. Parquet is only the container, so that any store Spark writes to can hold it.

Rows: null and empty texts give the end id alone; a text of any length is written whole; null doc_ids come first; rows that share
a doc_id are ordered by a hash of their text, then by text, and each kept, those that tie in all being equal; an empty table gives no rows; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fjordlake.llm import simple8b
from fjordlake.llm.common import documents, new_folder, small_batches, texts_of
from fjordlake.llm.tokens import BLOCK, encoder

#: Ids at which a chunk is closed.
CHUNK = 1 << 18
#: File parts, 12 bytes each, up to which their sizes are broadcast; beyond, they are joined by a shuffle.
BROADCAST_PARTS = 100_000

CHUNK_SCHEMA = "part int, chunk int, part_start long, n_ids long, doc_ids array<long>, lengths array<long>, blocks binary, words binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, drops_space: bool = False, chunk: int = CHUNK) -> None:
    """Writes the ids of docs (doc_id, text), each document's followed by end_id.

    One shuffle deals documents out by ranges of doc_id and, within one, of a hash of the text, whose sample is all that the driver sees; each task then encodes its range and codes it chunk by chunk."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, start = TaskContext.get().partitionId(), 0, 0
        tokens = encoder(tokenizer, drops_space)
        end = np.array([end_id], tokens.type).tobytes()
        doc_ids: list = []
        ids: list[bytes] = []
        held = 0

        def closed() -> pa.RecordBatch:
            nonlocal number, start, held
            flat = np.frombuffer(b"".join(ids), tokens.type)
            words, first = simple8b.encode(flat)
            row = {"part": [part], "chunk": [number], "part_start": [start], "n_ids": [len(flat)], "doc_ids": [list(doc_ids)], "lengths": [[len(x) // tokens.width for x in ids]], "blocks": [first.astype("<u4").tobytes()], "words": [words.astype("<u8").tobytes()]}
            number, start, held = number + 1, start + len(flat), 0
            doc_ids.clear()
            ids.clear()
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("part_start", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("blocks", pa.binary()), ("words", pa.binary())]))

        for batch in small_batches(batches, 1, BLOCK, keeps=True):
            for doc_id, own in zip(batch.column(0).to_pylist(), tokens.encode_all(texts_of(batch.column(1)))):
                doc_ids.append(doc_id)
                ids.append(own + end)
                held += len(own) // tokens.width + 1
                if held >= chunk:
                    yield closed()
        if doc_ids:
            yield closed()

    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("by_text", F.xxhash64("text")).repartitionByRange("doc_id", "by_text").sortWithinPartitions("doc_id", "by_text", "text")
    dealt.select("doc_id", "text").mapInArrow(code, CHUNK_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit) of each document."""

    def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 6, keeps=True):
            for r in batch.to_pylist():
                ids = simple8b.decode(np.frombuffer(r["words"], "<u8"), np.frombuffer(r["blocks"], "<u4"), r["n_ids"]).astype("<u4").tobytes()
                ends = np.cumsum(r["lengths"]).tolist()
                starts = [0, *ends[:-1]]
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array(r["doc_ids"], pa.int64()), "local_start": pa.array([r["part_start"] + s for s in starts], pa.int64()), "n_tokens": pa.array(r["lengths"], pa.int64()), "ids": pa.array([ids[4 * a : 4 * b] for a, b in zip(starts, ends)], pa.binary()), "part": pa.array([r["part"]] * len(ends), pa.int32())}
                )

    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    # one row for each file part, however long the parts are
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    pieces = chunks.select("part", "part_start", "n_ids", "doc_ids", "lengths", "blocks", "words").mapInArrow(take_apart, "doc_id long, local_start long, n_tokens long, ids binary, part int")
    few = parts.count() <= BROADCAST_PARTS
    return pieces.join(F.broadcast(parts) if few else parts, "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_folder(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1, drops_space=True)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

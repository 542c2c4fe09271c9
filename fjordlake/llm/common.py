"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def is_held_out(doc_id: Column) -> Column:
    """True where no label may be learned from; rows without a doc_id count as held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(True))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in spark.checkpoint.dir; there is no other."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return path.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the scratch folder; its content goes when the application ends."""
    path = f"{scratch_dir(spark)}/fjordlake-{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def file_for_tasks(spark: SparkSession, name: str, data: bytes | memoryview) -> str:
    """Writes data to the shared folder and has Spark bring it to every executor; its name there, for SparkFiles.get."""
    own = f"{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{new_folder(spark, name)}/{own}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    for at in range(0, len(data), 1 << 24):
        out.write(bytearray(data[at : at + (1 << 24)]))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return own


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the scratch folder: its lineage ends there, so a lost executor costs no recomputation."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Keys with at least one in so many of all rows are joined by broadcast; there are no more than so many of them.
HOT_KEYS = 1024


def join_hot(rows: DataFrame, facts: DataFrame, on: list[str], spread: str, total: int) -> DataFrame:
    """rows, left-joined with facts (one row a key: the columns `on`, n, which is how many of the `total` rows have it, and others), without n.

    Facts of the few keys that many rows share come by broadcast, and their rows go wherever a hash of the column `spread` sends
    them; all others meet in a shuffle, where no key weighs much."""
    values = [c for c in facts.columns if c not in (*on, "n")]
    hot = facts.filter(F.col("n") * HOT_KEYS >= total).select(*on, F.struct(*values).alias("hot_facts"))
    place = F.when(F.col("hot_facts").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(spread), F.lit(1 << 20))).cast("int")
    marked = rows.join(F.broadcast(hot), on, "left").withColumn("hot_place", place)
    # a place that only looks as if it could vary: a constant would be taken out of the join's keys
    plain = facts.select(*on, F.when(F.col("n") < 0, F.lit(1)).otherwise(F.lit(0)).cast("int").alias("hot_place"), F.struct(*values).alias("own_facts"))
    joined = marked.join(plain, [*on, "hot_place"], "left")
    return joined.select(*rows.columns, *(F.coalesce(F.col("hot_facts")[v], F.col("own_facts")[v]).alias(v) for v in values))


def texts_of(column: pa.Array) -> list[str]:
    """A batch's texts; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def kept_and(docs: DataFrame, keep: tuple[str, ...] | list[str], ddl: str) -> T.StructType:
    """Schema of the columns `keep` of docs and those that ddl names."""
    return T.StructType([*(docs.schema[k] for k in keep), *T.StructType.fromDDL(ddl).fields])


def as_rows(docs: DataFrame) -> DataFrame:
    """own_row (all columns of docs, whatever their names) and text."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own_row"), F.col("text"))


#: Bytes of text or ids that a Python worker unpacks at a time; a larger row stands alone.
AT_ONCE = 4_000_000


_kept: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """make(), which the Python worker keeps across its tasks until one asks for another key or keeps nothing."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def give_back() -> None:
    """Frees what the Python worker keeps and returns unused memory to the system, since workers outlive their stage."""
    _kept.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def small_batches(batches: Iterator[pa.RecordBatch], column: int, most: int = AT_ONCE, keeps: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches in slices that hold about `most` bytes in a column, so that what a worker unpacks stays small.

    Unless keeps, the worker gives back what earlier tasks and this one have left in memory."""
    if not keeps:
        give_back()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for part in blocks_by_size(sizes, most):
            yield batch.slice(part.start, part.stop - part.start)
    if not keeps:
        give_back()


def blocks_by_size(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive rows whose sizes add up to about `most`; a larger row stands alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def _share_of(ids: DataFrame, most: int, seed: int) -> tuple[DataFrame, dict]:
    """Rows of ids (doc_id, label, ...) that a hash of doc_id picks, about `most` of each label, and the labels' counts.

    One aggregate counts the labels; the hash threshold then keeps the expected share, so no class is gathered whole."""
    counts = {r["label"]: r["n"] for r in ids.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for k, n in counts.items():
        share = F.when(F.col("label") == F.lit(k), F.lit(min(1.0, most / n))).otherwise(share)
    position = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return ids.filter(position < share), counts


def _at_most(rows: list, counts: dict, most: int) -> list[tuple[str, object]]:
    """(text, label) of the first `most` rows of each label, in order of doc_id."""
    kept, seen = [], dict.fromkeys(counts, 0)
    for _, text, label in sorted(((r["doc_id"], r["text"] or "", r["label"]) for r in rows), key=lambda r: r[:2]):
        seen[label] += 1
        if seen[label] <= most:
            kept.append((text, label))
    return kept


def sample_by_class(rows: DataFrame, most: int, seed: int) -> list[tuple[str, object]]:
    """At most `most` (text, label) of each label of rows (doc_id, text, label)."""
    chosen, counts = _share_of(rows, most, seed)
    return _at_most(chosen.collect(), counts, most)


def labelled_sample(docs: DataFrame, marks: DataFrame, label: str, most: int, seed: int) -> list[tuple[str, int]]:
    """At most `most` (text, label) for each of the labels 0 and 1 that marks gives documents outside the held-out fifth.

    A document that is marked both ways teaches nothing. Only the chosen ids, about twice `most`, are broadcast."""
    known = marks.filter(F.col(label).isin(0, 1) & ~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
    chosen, counts = _share_of(known.filter(F.col("label") == F.col("other")).drop("other"), most, seed)
    return _at_most(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").collect(), counts, most)

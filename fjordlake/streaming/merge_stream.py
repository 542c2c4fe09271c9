"""The posting feed as a stream, merged by a keyed state.

Each posting lives in the state store under its id. A micro-batch folds the new events of its postings, in feed order, into what is
stored, and emits one row for each event. Written are, batch by batch, the postings that the batch touched and its audit rows: bytes
follow the touched postings, not the table. `current_state` reads the last row of each posting; `compact` gathers a long log in one
folder. A batch that runs again replaces its own folders with equal ones and pages that come again change nothing, so that a restart
at any point is safe.

Rows: a batch's events of one posting are sorted in memory, so `pages_per_batch` bounds them; pages without items change nothing."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery, StreamingQueryListener

from fjordlake.operators import events, fold
from fjordlake.sources.feed_source import FeedPages
from fjordlake.sources.files import read_feed_pages

DETAIL = f"struct<{events.DETAIL_SCHEMA.replace(' string', ':string').replace(' struct', ':struct')}>"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_POSTING = ", ".join(f"{c} {'long' if c == 'source_event_version' else 'string'}" for c in fold.POSTING)


class Postings(StatefulProcessor):
    """The payload fold, a posting's state in the store between batches."""

    def init(self, handle) -> None:
        self.stored = handle.getValueState("posting", _POSTING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        posting = dict(zip(fold.POSTING, self.stored.get())) if self.stored.exists() else None
        own = sorted((r.asDict() for r in rows), key=lambda r: (r["seq"], r["source_event_id"] or "", r["version"] or 0, r["raw_payload"] or ""))
        for n, event in enumerate(own, 1):
            before = posting
            action, posting = fold.apply_event(posting, event)
            yield Row(**fold.acted_row(key[0], event["seq"], action, before, posting, n == len(own)))
        if own:
            self.stored.update(tuple(posting[c] for c in fold.POSTING))

    def close(self) -> None:
        pass


def _batches(spark: SparkSession, state_path: str) -> dict[str, int]:
    """Folders of complete batches and, as -1, of the compacted log, with their numbers."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{state_path}/postings")
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(root):
        return {}
    names = [f.getPath().getName() for f in store.listStatus(root) if store.exists(hadoop.Path(f.getPath(), "_SUCCESS"))]
    return {n: int(n.split("=")[1]) for n in names if n.startswith(("batch=", "upto="))}


def current_state(spark: SparkSession, state_path: str, before: int | None = None) -> DataFrame | None:
    """Each posting after the batches below `before`, or all: its row of the latest batch that touched it."""
    known = _batches(spark, state_path)
    base = max((n for k, n in known.items() if k.startswith("upto=") and (before is None or n < before)), default=-1)
    parts = [f"{state_path}/postings/{k}" for k, n in known.items() if (k.startswith("upto=") and n == base) or (k.startswith("batch=") and n > base and (before is None or n < before))]
    if not parts:
        return None
    rows = spark.read.parquet(*parts)
    last = rows.groupBy("external_id").agg(F.max_by(F.struct(*fold.POSTING), "batch").alias("x"))
    return last.select("external_id", "x.*")


def compact(spark: SparkSession, state_path: str) -> None:
    """Gathers the log so far in one folder, which later reads start from; the batches' folders stay for their readers."""
    known = _batches(spark, state_path)
    if known:
        last = max(known.values())
        current_state(spark, state_path).withColumn("batch", F.lit(last)).write.mode("overwrite").parquet(f"{state_path}/postings/upto={last}")


def _with_details(found: DataFrame, details: DataFrame | None) -> DataFrame:
    """found with the detail of each item's id, the newest by its own time, if there is one."""
    if details is None:
        return found.withColumn("detail", F.lit(None).cast(DETAIL))
    newest = details.groupBy(F.trim("external_id").alias("detail_id")).agg(F.max_by(F.col("detail").cast(DETAIL), F.coalesce(F.col("detail.sistEndret"), F.lit(""))).alias("detail"))
    return found.join(newest, F.trim("id") == F.col("detail_id"), "left").drop("detail_id")


def events_of(found: DataFrame, order: Column, base_url: str, details: DataFrame | None = None) -> DataFrame:
    """Events of page items, active and inactive ones, with seq, their order in the feed."""
    items = _with_details(found.withColumn("feed_order", order), details)
    own = events.normalize_events(items, base_url).filter(events.event_class(F.col("status")) != "skipped")
    return own.withColumn("seq", F.col("feed_order"))


def _by_file() -> Column:
    return F.concat_ws("#", "page", F.lpad(F.col("place").cast("string"), 9, "0"))


def _by_link() -> Column:
    return F.concat_ws("#", F.lpad(F.col("page_number").cast("string"), 12, "0"), F.lpad(F.col("place").cast("string"), 9, "0"))


def _write(acted: DataFrame, batch_id: int, state_path: str) -> None:
    rows = acted.persist()
    fold.state_after(rows).withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{state_path}/postings/batch={batch_id}")
    fold.audit_of(rows).write.mode("overwrite").parquet(f"{state_path}/audit/batch={batch_id}")
    rows.groupBy("action").agg(F.count("*").alias("n")).coalesce(1).write.mode("overwrite").json(f"{state_path}/counts/batch={batch_id}")
    rows.unpersist()


def merge_batch(found: DataFrame, batch_id: int, state_path: str, base_url: str, details: DataFrame | None = None) -> None:
    """Merges page items (with page and place) without a stream; of the stored postings only those that the items name are read and written.

    details (external_id, detail) gives items their publication, expiry and due dates."""
    spark = found.sparkSession
    own = events_of(found, _by_file(), base_url, details)
    state = current_state(spark, state_path, batch_id)
    touched = None if state is None else state.join(own.select("external_id").distinct(), "external_id", "left_semi")
    _write(fold.fold_events(own, touched).filter(F.col("action") != "stored"), batch_id, state_path)


def _started(own: DataFrame, state_path: str, checkpoint: str, once: bool, name: str | None) -> StreamingQuery:
    spark = own.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)  # the only store with states of this kind
    acted = fold.as_input(own, False, "string").groupBy("external_id").transformWithState(Postings(), fold._ddl(fold._OUTPUT, "string"), "Update", "None")
    writer = acted.writeStream.outputMode("update").foreachBatch(lambda rows, n: _write(fold.typed(rows), n, state_path)).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="0 seconds")).start()


def start_merge_stream(spark: SparkSession, landing: str, state_path: str, checkpoint: str, base_url: str, pages_per_batch: int = 10, details: DataFrame | None = None) -> StreamingQuery:
    """Merges all pages that have landed, by the time of their files and within a batch by name, and stops. For the order of the links see `start_feed_stream`."""
    pages = read_feed_pages(spark, landing, stream=True, pages_per_batch=pages_per_batch)
    return _started(events_of(pages, _by_file(), base_url, details), state_path, checkpoint, True, None)


def start_feed_stream(spark: SparkSession, landing: str, first: str, state_path: str, checkpoint: str, base_url: str, pages_per_batch: int = 10, details: DataFrame | None = None, name: str | None = None) -> StreamingQuery:
    """Merges pages in the order of their next links, from the page `first` on, as they land; stop it when it should end.

    The metrics of `page_metrics` are observed on what is read; a `PageCounters` listener adds them up."""
    spark.dataSource.register(FeedPages)
    pages = spark.readStream.format("feed_pages").option("path", landing).option("first", first).option("pages_per_batch", pages_per_batch).load()
    return _started(events_of(pages.observe("pages", *page_metrics()), _by_link(), base_url, details), state_path, checkpoint, False, name)


def page_metrics() -> list[Column]:
    """Counts of pages and of their items by class."""
    item = F.col("place") >= 0
    kind = events.event_class(F.coalesce(F.col("_feed_entry.status"), F.lit("")))
    count = lambda c: F.count(F.when(c, 1))
    return [count(~item).alias("pages"), count(item).alias("items"), *(count(item & (kind == k)).alias(k) for k in ("active", "inactive", "skipped"))]


class PageCounters(StreamingQueryListener):
    """Adds up the observed page metrics of the streams of one name, a batch once."""

    def __init__(self, name: str | None = None):
        self.name, self.counts, self._seen = name, {}, set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        own = progress.observedMetrics.get("pages")
        batch = (str(progress.id), progress.batchId)
        if own is None or (self.name is not None and progress.name != self.name) or batch in self._seen:
            return
        self._seen.add(batch)
        for metric, n in own.asDict().items():
            self.counts[metric] = self.counts.get(metric, 0) + n

    def onQueryTerminated(self, event) -> None:
        pass

    def rows(self, spark: SparkSession, run_id: str) -> DataFrame:
        """The counters as (run_id, metric, n), for `merge.add_counters`."""
        return spark.createDataFrame([(run_id, k, v) for k, v in sorted(self.counts.items())], "run_id string, metric string, n long")

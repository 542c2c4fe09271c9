"""Merge of late and repeated events into a keyed table of postings.

Events of a key apply in feed order. One is accepted if its version is not below any earlier one's (none counts as lowest), and
the first of a key always is. That makes the order-dependent gate a running maximum, and each scalar the last value that is not
null among accepted events, so that the whole merge is window expressions over one exchange by key.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fjordlake.functions import columns as L

SCALARS = ("title", "company_name", "location", "url", "status", "published_at", "expires_at", "application_due", "detail")
LOWEST = "timestamp'0001-01-01 00:00:00'"


def payload_hash(columns: tuple[str, ...], event_at: Column) -> Column:
    """Hash of a JSON object of scalars and the event's time, so that no two different rows look alike; a payload counts in its canonical form."""
    return F.md5(L.canonical_json(*(_text(c).alias(c) for c in columns), L.utc_text(event_at).alias("event_at")))


def _text(c: str) -> Column:
    if c == "raw_payload":
        return canonical_json(F.coalesce(F.col(c), F.lit("{}")))
    return L.utc_text(F.col(c)) if c.endswith("_at") else F.col(c).cast("string")


def applied(events: DataFrame, state: DataFrame | None = None, scalars: tuple[str, ...] = SCALARS) -> DataFrame:
    """Each event with its action (insert, merge, no_op or stale_ignored) and the scalars, hash, version and event id after it.

    events: external_id, seq, version, source_event_id and scalars. state: a former result; its rows come first, as `stored`."""
    own = events.select("external_id", "seq", "version", "source_event_id", *(_blank(events, c) for c in scalars), F.lit(False).alias("stored"))
    if state is not None:
        old = state.select("external_id", F.lit(None).cast(dict(events.dtypes)["seq"]).alias("seq"), F.col("source_event_version").alias("version"), "source_event_id", *scalars, F.lit(True).alias("stored"))
        own = own.unionByName(old)
    key = Window.partitionBy("external_id").orderBy(F.desc("stored"), "seq")
    so_far, before = key.rowsBetween(Window.unboundedPreceding, 0), key.rowsBetween(Window.unboundedPreceding, -1)
    floor = F.expr(LOWEST)
    rank = F.coalesce("version", floor)
    top = F.max(rank).over(before)
    gated = own.withColumn("first", top.isNull()).withColumn("accepted", top.isNull() | (rank >= top)).withColumn("advances", top.isNull() | (rank > top))
    merged = gated.select(
        "external_id", "seq", "stored", "first", "accepted", "advances",
        F.nullif(F.max(rank).over(so_far), floor).alias("source_event_version"),
        "source_event_id",
        *(F.last(F.when(F.col("accepted"), F.col(c)), ignorenulls=True).over(so_far).alias(c) for c in scalars),
    )
    hashed = merged.withColumn("payload_hash", payload_hash(scalars, F.col("source_event_version")))
    same = F.lag("payload_hash").over(key) == F.col("payload_hash")  # a stale event leaves the state, and its hash, as it was
    action = F.when(F.col("stored"), "stored").when(F.col("first"), "insert").when(~F.col("accepted"), "stale_ignored").when(same, "no_op").otherwise("merge")
    acted = hashed.withColumn("action", action)
    counts = F.col("action").isin("stored", "insert", "merge")
    by_advance = F.last(F.when(counts & F.col("advances"), F.col("source_event_id")), ignorenulls=True).over(so_far)
    by_fill = F.first(F.when(counts & ~F.col("advances"), F.col("source_event_id")), ignorenulls=True).over(so_far)
    return acted.withColumn("source_event_id", F.coalesce(by_advance, by_fill)).drop("first", "accepted", "advances")


def _blank(events: DataFrame, c: str) -> Column:
    return F.nullif(F.col(c), F.lit("")).alias(c) if dict(events.dtypes)[c] == "string" else F.col(c)


def merged_state(actions: DataFrame, scalars: tuple[str, ...] = SCALARS) -> DataFrame:
    """The table after all events: the last row of each key."""
    own = ("source_event_version", "source_event_id", "payload_hash", *scalars)
    last = actions.groupBy("external_id").agg(F.max_by(F.struct(*own), F.struct((~F.col("stored")).alias("new"), "seq")).alias("x"))
    return last.select("external_id", *(F.col(f"x.{c}") for c in own))


def merge_events(events: DataFrame, state: DataFrame | None = None, scalars: tuple[str, ...] = SCALARS) -> tuple[DataFrame, DataFrame]:
    """The new state, and one row for each event with its action."""
    actions = applied(events, state, scalars)
    return merged_state(actions, scalars), actions.filter(~F.col("stored"))


def mark_present(state: DataFrame, actions: DataFrame, run_id: str, now: Column) -> DataFrame:
    """Stamps of a reconcile run on postings that it inserted or merged; a no_op leaves none."""
    touched = actions.filter(F.col("action").isin("insert", "merge")).select("external_id").distinct().withColumn("touched", F.lit(True))
    rows = state.join(touched, "external_id", "left")
    stamps = {"last_reconciled_run_id": F.lit(run_id), "last_reconciled_at": now, "reconciliation_status": F.lit("present")}
    before = lambda c: F.col(c) if c in state.columns else F.lit(None)
    return rows.select(*(c for c in state.columns if c not in stamps), *(F.when(F.col("touched"), x).otherwise(before(c)).alias(c) for c, x in stamps.items()))


def merge_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count("*").alias("n"))


def add_counters(counters: DataFrame, actions: DataFrame, run_id: str) -> DataFrame:
    """Counters (run_id, metric, n) with an action count added for this run."""
    new = merge_counts(actions).select(F.lit(run_id).alias("run_id"), F.col("action").alias("metric"), "n")
    return counters.unionByName(new).groupBy("run_id", "metric").agg(F.sum("n").alias("n"))


def event_audit(actions: DataFrame, scalars: tuple[str, ...] = SCALARS) -> DataFrame:
    """A row for each insert and merge with the values before and after; needs `applied` rows, stored ones included."""
    key = Window.partitionBy("external_id").orderBy(F.desc("stored"), "seq")
    values = F.struct("payload_hash", *scalars)
    with_before = actions.withColumn("new_values", values).withColumn("previous_values", F.lag(values).over(key))
    return with_before.filter(F.col("action").isin("insert", "merge")).select("external_id", "seq", F.col("action").alias("change_kind"), F.when(F.col("action") == "merge", F.col("previous_values")).alias("previous_values"), "new_values")


def upsert(state: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """state with the rows of updates in place of those with equal keys. Of updates that share a key the last in the order of their JSON text counts."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(L.canonical_json(*updates.columns))))
    last = updates.withColumn("nth", nth).filter(F.col("nth") == 1).drop("nth")
    return state.join(last.select(*keys), keys, "left_anti").unionByName(last, allowMissingColumns=True)


#: Payload keys that a hash ignores at every depth.
VOLATILE = ("imported_at", "mirror_observed_at", "last_polled_at", "nav_inactive_event", "nav_lifecycle_events", "careerjet_lifecycle_events", "_run_id", "_etag", "_ingested_at", "downstream_counters")


def _stable(value):
    """A JSON value without volatile keys."""
    if isinstance(value, dict):
        return {k: _stable(v) if isinstance(v, (dict, list)) else v for k, v in value.items() if k not in VOLATILE}
    return [_stable(v) for v in value] if isinstance(value, list) else value


_JSON = json.JSONEncoder(sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def compact_json(value) -> str:
    return _JSON.encode(value)


#: A key that an object does not have, in contrast to one that is null.
_ABSENT = object()


def _richer(stored, incoming):
    """Union of both objects; what comes in wins unless it is empty. A null for a key that is not stored leaves an empty object."""
    if incoming is _ABSENT or incoming is None:
        return {} if stored is _ABSENT or stored is None else stored
    if stored is _ABSENT or stored is None:
        return incoming
    if isinstance(stored, dict) and isinstance(incoming, dict):
        out = {k: {} if v is None else v for k, v in stored.items()}
        for k, v in incoming.items():  # as a call for each key would give it, which only objects in both need
            known = stored.get(k)
            if v is None:
                out.setdefault(k, {})
            elif known is None or v.__class__ is not dict and (v or v.__class__ not in (str, list)):
                out[k] = v
            elif v.__class__ is dict:
                out[k] = _richer(known, v)
        return out
    return incoming if incoming or not isinstance(incoming, (str, list, dict)) else stored


def canonical_json(payload: Column) -> Column:
    """JSON text with sorted keys and without volatile ones; null if it can't be read."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text):
            try:
                return compact_json(_stable(json.loads(text)))
            except (TypeError, ValueError):
                return None

        for batch in batches:
            yield batch.map(one)

    return run(payload)


def rich_merge_json(payloads: Column) -> Column:
    """An array of JSON texts, oldest first, merged into one."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(texts):
            out = _ABSENT
            for text in texts if texts is not None else ():
                out = _richer(out, json.loads(text) if text else None)
            return None if out is _ABSENT else compact_json(out)

        for batch in batches:
            yield batch.map(one)

    return run(payloads)


def merged_payloads(actions: DataFrame) -> DataFrame:
    """The rich payload of each key from rows with external_id, seq, action and raw_payload.

    Rows of a key come sorted to one task, which carries only the merged object from row to row: the merge is not associative."""
    kept = actions.filter(F.col("action").isin("insert", "merge", "no_op")).select("external_id", "seq", "raw_payload")
    schema = T.StructType([kept.schema["external_id"], T.StructField("raw_payload", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, out, begun = None, _ABSENT, False
        text = lambda: compact_json(out)
        for batch in batches:
            done = []
            for own, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if begun and own != key:
                    done.append((key, text()))
                    out = _ABSENT
                key, begun = own, True
                out = _richer(out, json.loads(payload) if payload else None)
            if done:
                yield _records(done, batch.schema.types[0])
            last_type = batch.schema.types[0]
        if begun:
            yield _records([(key, text())], last_type)

    def _records(rows: list, kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], kind), pa.array([t for _, t in rows], pa.string())], ["external_id", "raw_payload"])

    ordered = kept.repartition("external_id").sortWithinPartitions("external_id", "seq", "raw_payload")
    return ordered.select("external_id", "raw_payload").mapInArrow(run, schema)

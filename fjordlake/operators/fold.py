"""The merge of posting events with their payloads: a fold of each posting's events in feed order.

An event below the stored version is stale. Otherwise known scalars replace stored ones, the payload is merged key by key into the
stored one, and the result is hashed: an equal hash leaves the posting as it is (no_op), else it is stored (merge). Since the hash is
of the merged payload and the merge depends on order, no window can express this. Rows of a posting come sorted to one task, which
carries only the posting from row to row; the same step serves the keyed state of a stream.

Rows: events without an id are left out, blank text counts as null; a payload that can't be read or is no object counts as empty;
without any time an event has the lowest version; rows of equal seq apply in the order of their event id, version and payload; a
stored posting without version or hash gets both from its own row; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordlake.functions import columns as L
from fjordlake.operators.merge import _ABSENT, _richer, _stable, compact_json

TEXTS = ("title", "company_name", "location", "url", "status")
TIMES = ("published_at", "expires_at", "date_modified", "event_modified_at")
DATES = ("application_due",)
SCALARS = (*TEXTS, "published_at", "expires_at", *DATES, "date_modified", "event_modified_at")
STAMPS = ("last_reconciled_run_id", "last_reconciled_at", "reconciliation_status")
#: What a posting holds besides its id.
POSTING = (*SCALARS, "raw_payload", "source_event_version", "payload_hash", "source_event_id", *STAMPS)
#: Places in a payload that hold a time of the event.
PAYLOAD_TIMES = ("$._feed_entry.sistEndret", "$.nav_detail.sistEndret", "$.nav_detail.ad_content.updated", "$.nav_detail.json.updated")


def payload_version(date_modified: Column, event_modified_at: Column, payload: Column) -> Column:
    """The newest of a posting's times, those in its payload included."""
    # text without a path's last key, escaped or not, need not be read for it
    held = lambda path: F.when(payload.contains(path.rpartition(".")[2]) | payload.contains("\\"), payload)
    return L.newest(date_modified, event_modified_at, *(L.safe_timestamp(F.get_json_object(held(p), p)) for p in PAYLOAD_TIMES))


_READ = json.JSONDecoder().decode


def read_payload(text: str | None) -> dict:
    """The object that a payload's text holds; whoever gets it must not change it."""
    try:
        found = _READ(text) if text else {}
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def _payload_of(posting: dict):
    """What a posting's payload holds, read once; no payload is _ABSENT."""
    if "payload" not in posting:
        if not posting["raw_payload"]:
            return _ABSENT
        posting["payload"] = read_payload(posting["raw_payload"])
    return posting["payload"]


def _text_of(posting: dict) -> str | None:
    """A posting's payload as text; a merged one is written when it is asked for."""
    if posting["raw_payload"] is None and "payload" in posting:
        posting["raw_payload"] = compact_json(posting["payload"])
    return posting["raw_payload"]


def hash_of(posting: dict) -> str:
    """MD5 of a posting's scalars (times as UTC text) and its payload without volatile keys, as JSON with sorted keys."""
    payload = _payload_of(posting)
    return hashlib.md5(compact_json({c: posting[c] for c in SCALARS} | {"raw_payload": {} if payload is _ABSENT else _stable(payload)}).encode()).hexdigest()


def _hash_of(posting: dict) -> str:
    """A posting's hash, made when it is asked for."""
    if posting["payload_hash"] is None:
        posting["payload_hash"] = hash_of(posting)
    return posting["payload_hash"]


def _step(stored: dict | None, event: dict, stamps: dict | None = None) -> tuple[str, dict]:
    """As apply_event; the new posting's payload may be without its text and its hash not yet made."""
    if stored is None:
        return "insert", {c: event[c] for c in SCALARS} | {"raw_payload": event["raw_payload"] or "{}", "source_event_version": event["version"], "payload_hash": None, "source_event_id": event["source_event_id"]} | (stamps or dict.fromkeys(STAMPS))
    lowest = float("-inf")
    known, own = (lowest if v is None else v for v in (stored["source_event_version"], event["version"]))
    if own < known:
        return "stale_ignored", stored
    changed = {c: v for c in SCALARS if (v := event[c]) is not None and v != stored[c]}
    new = stored | changed | {"raw_payload": None, "payload": _richer(_payload_of(stored), read_payload(event["raw_payload"])), "payload_hash": None}
    # other scalars are another hash; it need not be made to see that. A stored row's hash may be another's, so it is compared
    if (not changed or "stored_hash" in stored) and _hash_of(new) == _hash_of(stored):
        return "no_op", stored
    new.pop("stored_hash", None)
    newer, older = (event, stored) if own > known else (stored, event)
    new["source_event_id"] = newer["source_event_id"] if newer["source_event_id"] is not None else older["source_event_id"]
    new["source_event_version"] = max(own, known) if max(own, known) != lowest else None
    return "merge", new | (stamps or {})


def apply_event(stored: dict | None, event: dict, stamps: dict | None = None) -> tuple[str, dict]:
    """The action of one event and the posting after it. Versions are microseconds; stamps are what a reconcile run leaves on rows it writes."""
    action, posting = _step(stored, event, stamps)
    return action, posting if posting is stored else {c: _VALUES.get(c, lambda p: p[c])(posting) for c in POSTING}  # noqa: B023


def stored_posting(row: dict) -> dict:
    """A posting as it was stored, its version and hash made up from the row where they lack."""
    own = {c: row[c] for c in POSTING if c != "source_event_version"} | {"source_event_version": row["version"]}
    return own if own["payload_hash"] is None else own | {"stored_hash": True}


_INPUT = ("external_id", "seq", "stored", "version", *SCALARS, "raw_payload", "payload_hash", "source_event_id", *STAMPS)
#: What audit rows tell of a posting before and after.
AUDITED = (*SCALARS, "source_event_version", "payload_hash", "has_detail")
_BEFORE = tuple(f"previous_{c}" for c in AUDITED)
_OUTPUT = ("external_id", "seq", "action", "is_last", *POSTING, "has_detail", *_BEFORE)
#: Fixed value: the payload's key of a posting's details. It is there even where its value is null.
DETAIL_KEY = "nav_detail"


def _kind(c: str, seq: str) -> str:
    return "long" if c.endswith("version") else "boolean" if c in ("stored", "is_last") or c.endswith("has_detail") else seq if c == "seq" else "string"


def _ddl(columns: tuple[str, ...], seq: str) -> str:
    return ", ".join(f"{c} {_kind(c, seq)}" for c in columns)


def as_input(rows: DataFrame, stored: bool, seq: str) -> DataFrame:
    """Events or stored postings as the fold reads them: text, times as UTC text, versions as microseconds."""
    has = lambda c, kind="string": F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    text = lambda c: F.nullif(has(c), F.lit("")) if c in TEXTS or c == "source_event_id" else L.utc_text(has(c, "timestamp")) if c in TIMES or c == "last_reconciled_at" else has(c).cast("string")
    version = payload_version(has("date_modified", "timestamp"), has("event_modified_at", "timestamp"), has("raw_payload"))
    if stored and "source_event_version" in rows.columns:
        version = F.coalesce("source_event_version", version)
    own = {"external_id": F.trim("external_id"), "seq": F.lit(None).cast(seq) if stored else F.col("seq"), "stored": F.lit(stored), "version": F.unix_micros(version)}
    if not stored:
        own |= {c: F.lit(None).cast("string") for c in ("payload_hash", *STAMPS)}
    return rows.select(*(own.get(c, text(c) if c not in own else None).alias(c) for c in _INPUT)).filter(F.coalesce("external_id", F.lit("")) != "")


def has_detail(posting: dict) -> bool:
    if "payload" not in posting and DETAIL_KEY not in (posting["raw_payload"] or ""):
        return False
    payload = _payload_of(posting)
    return payload is not _ABSENT and DETAIL_KEY in payload


#: Values of a posting that are made when they are asked for.
_VALUES = {"raw_payload": _text_of, "payload_hash": _hash_of, "has_detail": has_detail}


def acted_row(key: str, seq, action: str, before: dict | None, after: dict, is_last: bool) -> dict:
    was = {f"previous_{c}": has_detail(before) if c == "has_detail" else before[c] for c in AUDITED} if action == "merge" else dict.fromkeys(_BEFORE)
    return {"external_id": key, "seq": seq, "action": action, "is_last": is_last, "has_detail": has_detail(after)} | {c: after[c] for c in POSTING} | was


def _rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """A batch's rows, taken out of it by column."""
    values = [c.to_pylist() if c.null_count and not pa.types.is_string(c.type) else c.to_numpy(zero_copy_only=False).tolist() for c in batch.columns]
    return (dict(zip(batch.schema.names, row)) for row in zip(*values))


def _fold(seq: str, stamps: dict | None, columns: tuple[str, ...] = _OUTPUT, only_last: bool = False, at_last: tuple[str, ...] = ()) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    place = {c: n for n, c in enumerate(("external_id", "seq", "action", "is_last"))}

    def values(c: str, rows: list[tuple]) -> list:
        if c in place:
            return [r[place[c]] for r in rows]
        name = c.removeprefix("previous_")
        made = _VALUES.get(name)
        if c in at_last:
            return [(made(r[5]) if made else r[5][c]) if r[3] else None for r in rows]
        if c == name:
            return [made(r[5]) for r in rows] if made else [r[5][c] for r in rows]
        return [(made(r[4]) if made else r[4][name]) if r[2] == "merge" else None for r in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, posting, waiting, kinds = None, None, None, {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(values(c, rows), kinds["seq"] if c == "seq" else kinds[_kind(c, seq)]) for c in columns], list(columns))

        for batch in batches:
            kinds["seq"] = batch.schema.field("seq").type
            done = []
            for row in _rows_of(batch):
                other = row["external_id"] != key
                if waiting is not None and (other or not only_last):
                    done.append((*waiting[:3], other, *waiting[3:]))
                if other:
                    key, posting = row["external_id"], None
                before = posting
                action, posting = ("stored", stored_posting(row)) if row["stored"] else _step(posting, row, stamps)
                waiting = key, row["seq"], action, before, posting
            yield batch_of(done)
        if waiting is not None:
            yield batch_of([(*waiting[:3], True, *waiting[3:])])

    return run


def typed(acted: DataFrame) -> DataFrame:
    """The fold's rows with times and dates in place of text."""
    kind = lambda c: "timestamp" if c.removeprefix("previous_") in (*TIMES, "last_reconciled_at") else "date" if c.removeprefix("previous_") in DATES else None
    return acted.select(*(F.timestamp_micros(c).alias(c) if c.endswith("source_event_version") else F.col(c).cast(kind(c)).alias(c) if kind(c) else F.col(c) for c in acted.columns))


def fold_events(events: DataFrame, state: DataFrame | None = None, run: tuple[str, Column] | None = None, columns: tuple[str, ...] = _OUTPUT, only_last: bool = False, at_last: tuple[str, ...] = ()) -> DataFrame:
    """A row for each event, and for each stored posting, with its action and the posting after it; `is_last` marks a posting's last row.

    events: external_id, seq, SCALARS, raw_payload, source_event_id. state: a former `state_after`. run: id and time of a reconcile
    run, which stamps what it inserts or merges as present. columns: what the caller reads of a row; Spark can't drop the others itself.
    only_last: each posting's last row alone, where nothing else is read. at_last: columns that only a posting's last row needs; null elsewhere."""
    seq = dict(events.dtypes)["seq"]
    rows = as_input(events, False, seq)
    if state is not None:
        rows = rows.unionByName(as_input(state, True, seq))
    stamps = None
    if run is not None:
        stamps = {"last_reconciled_run_id": run[0], "last_reconciled_at": events.sparkSession.range(1).select(L.utc_text(run[1])).first()[0], "reconciliation_status": "present"}
    ordered = rows.repartition("external_id").sortWithinPartitions("external_id", F.desc("stored"), "seq", "source_event_id", "version", "raw_payload")
    return typed(ordered.mapInArrow(_fold(seq, stamps, columns, only_last, at_last), _ddl(columns, seq)))


def state_after(acted: DataFrame) -> DataFrame:
    """The postings after all events: no further shuffle, since the fold marks each posting's last row."""
    return acted.filter("is_last").select("external_id", *POSTING)


def fold_state(events: DataFrame, state: DataFrame | None = None, run: tuple[str, Column] | None = None) -> DataFrame:
    """`state_after` of `fold_events` where no other row of it is read."""
    return fold_events(events, state, run, ("external_id", *POSTING), only_last=True)


def audit_of(acted: DataFrame) -> DataFrame:
    """A row for each insert and merge with the values before and after, as far as acted has both."""
    own = [c for c in AUDITED if {c, f"previous_{c}"} <= set(acted.columns)]
    before = F.struct(*(F.col(f"previous_{c}").alias(c) for c in own))
    return acted.filter(F.col("action").isin("insert", "merge")).select("external_id", "seq", F.col("action").alias("change_kind"), F.when(F.col("action") == "merge", before).alias("previous_values"), F.struct(*own).alias("new_values"))


def posting_hash(rows: DataFrame) -> Column:
    """The hash of each of rows (SCALARS and raw_payload) as the fold computes it."""
    @F.pandas_udf("string")
    def run(found: pd.DataFrame) -> pd.Series:
        return pd.Series([hash_of({k: v if isinstance(v, str) else None for k, v in r.items()}) for r in found.to_dict("records")], dtype=object)

    text = lambda c: L.utc_text(F.col(c)) if c in TIMES else F.col(c).cast("string")
    return run(F.struct(*(text(c).alias(c) for c in SCALARS), F.col("raw_payload")))

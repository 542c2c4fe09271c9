"""The fold makes what its caller reads, and that equals the whole fold's."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fjordlake.operators import fold, health
from fjordlake.plans import payload_queries, posting_queries


def batch_of(rows):
    full = [dict.fromkeys(fold._INPUT) | {"stored": False} | r for r in rows]
    kind = lambda c: pa.bool_() if c == "stored" else pa.int64() if c in ("seq", "version") else pa.string()
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in full], kind(c)) for c in fold._INPUT], list(fold._INPUT))


def made(rows, *a):
    return [r for b in fold._fold("long", None, *a)([batch_of(rows)]) for r in b.to_pylist()]


#: A merge at each event, the last of which has no new payload.
ROWS = [{"external_id": k, "seq": n, "version": n, "title": f"T{n}", "raw_payload": f'{{"a":{min(n, 3)},"_etag":{n}}}'} for k in "jk" for n in range(5)]


def test_texts_and_hashes_are_made_for_last_rows_only(monkeypatch):
    calls, own = [], fold.compact_json
    monkeypatch.setattr(fold, "compact_json", lambda x: calls.append(1) or own(x))
    whole = made(ROWS)
    assert len(calls) > 12 and len({r["payload_hash"] for r in whole if r["external_id"] == "j"}) == 5
    calls.clear()
    ends = ("raw_payload", "payload_hash")
    columns = tuple(c for c in fold._OUTPUT if c != "previous_payload_hash")
    lean = made(ROWS, columns, False, ends)
    assert len(calls) == 4  # a text and a hash for each of two postings
    assert lean == [{c: r[c] if r["is_last"] or c not in ends else None for c in columns} for r in whole]


@pytest.mark.parametrize("columns", [("external_id", "seq", "action", "payload_hash", "source_event_id"), ("external_id", "seq", "action", "title", "previous_title", "previous_payload_hash")])
def test_fewer_columns_are_those_of_the_whole_fold(columns):
    assert made(ROWS, columns) == [{c: r[c] for c in columns} for r in made(ROWS)]


def test_last_rows_alone_are_the_state(spark, sf_dir):
    found = payload_queries.feed(spark, sf_dir).filter("event_id < 400")
    first, second = (posting_queries.late(found, 1, 2, how) for how in ("left_anti", "left_semi"))
    assert first.unionByName(second).exceptAll(found).count() == 0 and first.count() + second.count() == found.count()
    whole = fold.state_after(fold.fold_events(first))
    assert {tuple(r) for r in fold.fold_state(first).collect()} == {tuple(r) for r in whole.collect()}


def test_health_changes_without_a_row_for_each_metric(spark):
    kind = "struct<status:string,expires_at:timestamp,has_detail:boolean,source_event_version:timestamp>"
    day = lambda n: f"timestamp'2024-01-0{n}'"
    value = lambda status, n, detail: f"cast(struct('{status}', {day(n) if n else 'null'}, {detail}, {day(n or 1)}) as {kind})"
    rows = [(f"cast(null as {kind})", value("ACTIVE", 2, True)), (value("ACTIVE", 2, True), value("ACTIVE", 3, False)), (value("ACTIVE", 3, False), value("ACTIVE", 3, True)), (f"cast(null as {kind})", value("INACTIVE", 0, False)), (value("INACTIVE", 0, False), value("ACTIVE", 0, False))]
    audit = spark.sql(" union all ".join(f"select {a} as previous_values, {b} as new_values" for a, b in rows))
    changes = health.health_changes(audit)
    assert {(r["metric"], r["at"] and r["at"].day): r["n"] for r in changes.collect()} == {("total", None): 2, ("active", None): 2, ("active_with_detail", None): 1, ("active_missing_detail", None): 1, ("active_without_expiry", None): 1, ("active_expires", 3): 1, ("newest", 3): 1}
    assert tuple(health.health_of(health.add_health(None, audit), F.lit("2024-02-01").cast("timestamp")).first())[:7] == (2, 2, 0, 1, 1, 1, 1)
    assert health.health_changes(audit.limit(0)).count() == 0

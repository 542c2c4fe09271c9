"""The payload fold against a fold of its own, and the keyed stream with its cursor and counters."""

import hashlib
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from fjordlake.operators import events, fold, merge
from fjordlake.sources.feed_source import FeedReader
from fjordlake.streaming import merge_stream

FIELDS = "external_id string, seq long, title string, status string, date_modified timestamp, event_modified_at timestamp, raw_payload string, source_event_id string"
VOLATILE = {"_etag", "imported_at", "nav_inactive_event"}


def made(spark, rows):
    """rows: external_id, seq, title, status, day, payload, event id."""
    day = lambda d: None if d is None else f"2024-01-{d:02d} 00:00:00"
    text = FIELDS.replace("timestamp", "string")
    found = spark.createDataFrame([(k, s, t, st, day(d), None, None if p is None else p if isinstance(p, str) else json.dumps(p), e) for k, s, t, st, d, p, e in rows], text)
    return found.withColumns({c: F.col(c).cast("timestamp") for c in ("date_modified", "event_modified_at")})


def union_of(old, new):
    """Deep union, what is empty never replacing what is there."""
    if new is None:
        return {} if old is None else old
    if isinstance(old, dict) and isinstance(new, dict):
        return {k: union_of(old.get(k), new.get(k)) for k in {*old, *new}}
    if old is not None and (new == "" or new == [] or new == {}):
        return old
    return new


def without_volatile(x):
    if isinstance(x, dict):
        return {k: without_volatile(v) for k, v in x.items() if k not in VOLATILE}
    return [without_volatile(v) for v in x] if isinstance(x, list) else x


def plain_fold(rows):
    """One event at a time; compares rows by value where the library compares hashes."""
    state, actions = {}, {}
    for key, seq, title, status, day, payload, event in sorted(rows, key=lambda r: r[1]):
        inner = (payload or {}).get("_feed_entry", {}).get("sistEndret")
        times = [x for x in (day, int(inner[8:10]) if inner else None) if x is not None]
        version = max(times, default=0)
        own = state.get(key)
        if own is None:
            state[key] = {"title": title or None, "status": status or None, "day": day, "payload": payload or {}, "version": version, "event": event}
            actions[seq] = "insert"
            continue
        if version < own["version"]:
            actions[seq] = "stale_ignored"
            continue
        new = {"title": title or own["title"], "status": status or own["status"], "day": own["day"] if day is None else day, "payload": union_of(own["payload"], payload or {})}
        if all(new[k] == own[k] for k in ("title", "status", "day")) and without_volatile(new["payload"]) == without_volatile(own["payload"]):
            actions[seq] = "no_op"
            continue
        newer = version > own["version"]
        state[key] = new | {"version": max(version, own["version"]), "event": (event or own["event"]) if newer else (own["event"] or event)}
        actions[seq] = "merge"
    return state, actions


def some_rows(seed, n=400):
    pick = random.Random(seed)
    leaf = lambda: pick.choice(["", "a", "b", [], ["x"], {}, {"k": 1}, 0, False])
    rows = []
    for seq in range(n):
        payload = {k: leaf() for k in ("p", "q", "_etag") if pick.random() < 0.6}
        if pick.random() < 0.5:
            payload["deep"] = {k: leaf() for k in ("r", "imported_at") if pick.random() < 0.7}
        if pick.random() < 0.3:
            payload["_feed_entry"] = {"sistEndret": f"2024-01-{pick.randint(1, 9):02d}T00:00:00Z"}
        rows.append((f"k{pick.randrange(30)}", seq, pick.choice([None, "", "A", "B"]), pick.choice(["ACTIVE", "INACTIVE"]), pick.choice([None, *range(1, 9)]), payload if pick.random() < 0.9 else None, pick.choice([None, f"e{seq}"])))
    return rows


def postings_of(state):
    return {r["external_id"]: {"title": r["title"], "status": r["status"], "day": r["date_modified"].day if r["date_modified"] else None, "payload": json.loads(r["raw_payload"]), "version": r["source_event_version"].day if r["source_event_version"] else 0, "event": r["source_event_id"]} for r in state.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_fold_equals_a_plain_fold(spark, seed):
    rows = some_rows(seed)
    state, actions = plain_fold(rows)
    acted = fold.fold_events(made(spark, rows))
    assert {r["seq"]: r["action"] for r in acted.collect()} == actions and len(set(actions.values())) == 4
    once = fold.state_after(acted)
    assert postings_of(once) == state
    cut = random.Random(seed).randrange(50, 350)
    first = fold.state_after(fold.fold_events(made(spark, [r for r in rows if r[1] < cut])))
    both = fold.fold_events(made(spark, [r for r in rows if r[1] >= cut]), first)
    assert postings_of(fold.state_after(both)) == state and {r["seq"]: r["action"] for r in both.collect() if r["action"] != "stored"} == {s: a for s, a in actions.items() if s >= cut}


def test_sparser_payload_is_no_change(spark):
    rows = [("j", 1, "T", "ACTIVE", 5, {"x": 1, "y": 2}, "e1"), ("j", 2, "T", "ACTIVE", 5, {"x": 1}, "e2"), ("j", 3, None, "ACTIVE", 5, {"x": 1, "y": "", "_etag": 9}, "e3"), ("j", 4, "T", "ACTIVE", 4, {"x": 7}, "e0"), ("j", 5, None, "INACTIVE", 6, {"y": 3}, "e5")]
    acted = fold.fold_events(made(spark, rows))
    assert [r["action"] for r in acted.orderBy("seq").collect()] == ["insert", "no_op", "no_op", "stale_ignored", "merge"]
    one = fold.state_after(acted).collect()[0]
    assert json.loads(one["raw_payload"]) == {"x": 1, "y": 3} and one["source_event_id"] == "e5" and one["title"] == "T"
    audit = fold.audit_of(acted).orderBy("seq").collect()
    assert [r["change_kind"] for r in audit] == ["insert", "merge"] and audit[0]["previous_values"] is None and audit[1]["previous_values"]["status"] == "ACTIVE" and audit[1]["new_values"]["status"] == "INACTIVE"


def test_no_op_leaves_the_payload_and_stamps_alone(spark):
    note = lambda t: {"a": 1, "nav_inactive_event": {"observed_at": t}}
    state = fold.state_after(fold.fold_events(made(spark, [("j", 1, "T", "INACTIVE", 5, note("t1"), "e")])))
    again = fold.state_after(fold.fold_events(made(spark, [("j", 2, "T", "INACTIVE", 5, note("t9"), "e")]), state, ("r9", F.lit("2024-02-01").cast("timestamp")))).collect()[0]
    assert json.loads(again["raw_payload"]) == note("t1") and again["reconciliation_status"] is None
    stamped = fold.state_after(fold.fold_events(made(spark, [("j", 2, "U", "INACTIVE", 5, note("t9"), "e")]), state, ("r9", F.lit("2024-02-01").cast("timestamp")))).collect()[0]
    assert (stamped["last_reconciled_run_id"], stamped["reconciliation_status"], str(stamped["last_reconciled_at"])) == ("r9", "present", "2024-02-01 00:00:00") and json.loads(stamped["raw_payload"]) == note("t9")


def test_stored_version_and_hash_come_from_the_row(spark):
    state = fold.state_after(fold.fold_events(made(spark, [("j", 1, "T", "ACTIVE", 5, {"x": 1}, "e")])))
    bare = state.withColumns({"source_event_version": F.lit(None).cast("timestamp"), "payload_hash": F.lit(None).cast("string")})
    late = fold.fold_events(made(spark, [("j", 2, "L", "ACTIVE", 4, {"x": 2}, "l"), ("j", 3, "T", "ACTIVE", 5, {"x": 1}, "e")]), bare)
    assert [r["action"] for r in late.orderBy(F.desc("action")).collect()] == ["stored", "stale_ignored", "no_op"]


def test_versions_lie_in_every_place_of_a_payload(spark):
    texts = ['{"_feed_entry":{"sistEndret":"2024-01-02T00:00:00Z"}}', '{"nav_detail":{"sistEndret":"2024-01-03T00:00:00Z"}}', '{"nav_detail":{"ad_content":{"updated":"2024-01-04T00:00:00Z"},"json":{"updated":"2024-01-05T00:00:00Z"}}}', '{"nav_detail":{"json":{"updated":"soon"}}}', "{", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, p string")
    none = F.lit(None).cast("timestamp")
    got = [r["v"] for r in rows.orderBy("i").select(fold.payload_version(none, none, F.col("p")).alias("v")).collect()]
    assert [v and v.day for v in got] == [2, 3, 5, None, None, None]


def test_odd_events(spark):
    rows = [(" j ", 1, "T", "ACTIVE", None, "[1]", None), ("", 2, "T", "ACTIVE", 1, {}, None), (None, 3, "T", "ACTIVE", 1, {}, None), ("j", 4, "T", "ACTIVE", None, "no json", None), ("j", 4, "T", "ACTIVE", None, "no json", None)]
    acted = fold.fold_events(made(spark, rows)).orderBy("seq").collect()
    assert [(r["external_id"], r["action"]) for r in acted] == [("j", "insert"), ("j", "merge"), ("j", "no_op")] or [r["action"] for r in acted] == ["insert", "no_op", "no_op"]
    assert fold.fold_events(made(spark, [])).count() == 0


def test_hash_of_a_posting(spark):
    found = made(spark, [("j", 1, "Tø", "ACTIVE", 5, {"b": 1, "_etag": 2, "a": [{"imported_at": 1, "k": None}]}, "e")])
    acted = fold.fold_events(found).collect()[0]
    columns = found.withColumns({c: F.lit(None).cast("string") for c in ("company_name", "location", "url", "application_due")} | {c: F.lit(None).cast("timestamp") for c in ("published_at", "expires_at")})
    text = '{"application_due":null,"company_name":null,"date_modified":"2024-01-05T00:00:00.000000Z","event_modified_at":null,"expires_at":null,"location":null,"published_at":null,"raw_payload":{"a":[{"k":null}],"b":1},"status":"ACTIVE","title":"Tø","url":null}'
    assert acted["payload_hash"] == columns.select(fold.posting_hash(columns).alias("h")).collect()[0]["h"] == hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("payload,expected", [("{ }", {}), ('{"a":1} ', {"a": 1}), ('{"nav_inactive_event":{"old":1},"b":2}', {"b": 2}), ("", {}), (None, {}), ("[1]", {}), ("{", {})])
def test_inactive_payload(spark, payload, expected):
    found = spark.createDataFrame([("j", payload, "ACTIVE", "e")], "external_id string, raw_payload string, status string, source_event_id string").withColumn("version", F.lit(None).cast("timestamp"))
    got = json.loads(events.inactive_event(found, "now").collect()[0]["raw_payload"])
    note = {"observed_at": "now", "source_event_at": None, "source_event_at_reliable": False, "external_id": "j"}
    assert got == expected | {"nav_inactive_event": note, "last_nav_status": "INACTIVE"}


def item(key, day, status="ACTIVE", **more):
    return {"id": key, "url": f"/{key}", "date_modified": f"2024-01-{day:02d}T00:00:00Z", "_feed_entry": {"status": status, "businessName": "Firm"}} | more


def land(folder, name, items, following=None):
    """A page lands whole."""
    text = json.dumps({"feed_url": f"/feed/{name}", "next_url": f"/feed/{following}?x=1" if following else None, "items": items})
    (folder / f".{name}").write_text(text)
    os.rename(folder / f".{name}", folder / f"{name}.json")


def test_cursor_follows_links(tmp_path):
    land(tmp_path, "a", [item("x", 1), "odd", item("y", 1)], "b")
    reader = FeedReader(str(tmp_path), "a", 10)
    start = reader.initialOffset()
    end = reader.latestOffset()
    assert end == {"page": "b", "number": 1, "place": 0} == reader.latestOffset()  # b has not landed
    assert [(p.page, p.start, p.stop) for p in reader.partitions(start, end)] == [("a", 0, None)]
    land(tmp_path, "c", [item("z", 1)])
    land(tmp_path, "b", [], "c")
    tail = reader.latestOffset()
    assert tail == {"page": "c", "number": 2, "place": 1} and [(p.page, p.start, p.stop) for p in reader.partitions(end, tail)] == [("b", 0, None), ("c", 0, 1)]
    land(tmp_path, "c", [item("z", 1), item("w", 2)], "d")
    grown = reader.latestOffset()
    rest = reader.partitions(tail, grown)
    assert grown == {"page": "d", "number": 3, "place": 0} and [(p.page, p.start, p.stop) for p in rest] == [("c", 1, None)]
    assert [r[2:4] for r in reader.read(rest[0])] == [(1, "w")] and [r[2] for r in reader.read(reader.partitions(end, tail)[0])] == [-1]
    (tmp_path / "d.json").write_text('{"items": [')
    assert reader.latestOffset() == grown
    again = FeedReader(str(tmp_path), "a", 1)
    again.partitions(end, tail)  # what a restart asks for
    assert again.latestOffset() == grown


def caught_up(query):
    query.processAllAvailable()
    query.stop()
    query.awaitTermination()


def shown(spark, state):
    return {r["external_id"]: (r["title"], r["status"], r["payload_hash"]) for r in merge_stream.current_state(spark, state).collect()}


def test_feed_stream(spark, tmp_path):
    """Pages that land out of order apply in feed order; a restart goes on from the cursor; replay changes nothing; bytes follow touched postings."""
    landing, state, mark = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "mark")
    landing.mkdir()
    counters = merge_stream.PageCounters("feed")
    spark.streams.addListener(counters)
    try:
        run = lambda: caught_up(merge_stream.start_feed_stream(spark, str(landing), "p1", state, mark, "https://f", pages_per_batch=2, name="feed"))
        # of one version: the page that comes last in the feed wins, though it landed first
        land(landing, "p2", [item("a", 2, title="Second"), item("b", 3, status="INACTIVE")], "p3")
        land(landing, "p1", [item("a", 2, title="First"), item("b", 2, title="B"), item("c", 1, status="ODD")] + [item(f"k{i}", 1) for i in range(60)], "p2")
        run()
        first = shown(spark, state)
        assert len(first) == 62 and first["a"][:2] == ("Second", "ACTIVE") and first["b"][:2] == ("B", "INACTIVE")
        land(landing, "p3", [], "p4")
        land(landing, "p4", [item("a", 1, title="Late"), item("a", 4, title="New")])
        run()
        second = shown(spark, state)
        assert second["a"][:2] == ("New", "ACTIVE") and {k: v for k, v in second.items() if k != "a"} == {k: v for k, v in first.items() if k != "a"}
        numbers = sorted(n for k, n in merge_stream._batches(spark, state).items())
        assert sum(spark.read.parquet(f"{state}/postings/batch={n}").count() for n in numbers) == 62 + 1
        land(landing, "p4", [item("a", 1, title="Late"), item("a", 4, title="New"), item("a", 4, title="New"), item("b", 3, status="INACTIVE")])  # the tail grows by replays
        run()
        assert shown(spark, state) == second
        last = max(merge_stream._batches(spark, state).values())
        assert sum(r["n"] for r in spark.read.json(f"{state}/counts/batch={last}").collect() if r["action"] == "no_op") == 2
        merge_stream.compact(spark, state)
        assert shown(spark, state) == second
        for _ in range(100):
            if counters.counts.get("items") == 69:
                break
            time.sleep(0.1)
        assert counters.counts == {"pages": 4, "items": 69, "active": 66, "inactive": 2, "skipped": 1}
        assert merge.add_counters(counters.rows(spark, "r1"), spark.createDataFrame([("merge",)], "action string"), "r1").filter("metric = 'pages'").collect()[0]["n"] == 4
    finally:
        spark.streams.removeListener(counters)
    # the same pages in one batch, without a stream
    found = [(f"p{n}", place, i) for n in (1, 2, 4) for place, i in enumerate(json.loads((landing / f"p{n}.json").read_text())["items"])]
    rows = spark.createDataFrame([(p, place, i["id"], i["url"], i.get("title"), i["date_modified"], (i["_feed_entry"]["status"], None, "Firm", None, None)) for p, place, i in found], f"page string, place int, {events.ITEM_SCHEMA}")
    merge_stream.merge_batch(rows, 0, str(tmp_path / "batch"), "https://f")
    assert shown(spark, str(tmp_path / "batch")) == second


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    rows = spark.createDataFrame([("p", n, f"k{n % 3}", "/u", f"T{n}", f"2024-01-0{n + 1}", ("ACTIVE", None, None, None, None)) for n in range(5)], f"page string, place int, {events.ITEM_SCHEMA}")
    state = str(tmp_path / "state")
    merge_stream.merge_batch(rows.filter("place < 3"), 0, state, "https://f")
    for _ in range(2):
        merge_stream.merge_batch(rows.filter("place >= 3"), 1, state, "https://f")
    assert {k: v[0] for k, v in shown(spark, state).items()} == {"k0": "T3", "k1": "T4", "k2": "T2"}
    assert spark.read.parquet(f"{state}/postings/batch=1").count() == 2 and spark.read.parquet(f"{state}/audit/batch=1").count() == 2


def test_a_hot_posting_is_folded_batch_by_batch(spark):
    """Twenty thousand events of one posting over many Arrow batches, among others of one event each."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        n = 20_000
        hot = spark.range(n).select(F.lit("hot").alias("external_id"), F.col("id").alias("seq"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("date_modified"), F.to_json(F.struct((F.col("id") % 7).alias("k"), F.when(F.col("id") == 3, "kept").alias("once"))).alias("raw_payload"))
        cold = spark.range(300).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("external_id"), (F.col("id") + n).alias("seq"), F.lit(None).cast("timestamp").alias("date_modified"), F.lit("{}").alias("raw_payload"))
        rows = hot.unionByName(cold).withColumns({"title": F.lit("T"), "status": F.lit("ACTIVE"), "source_event_id": F.concat(F.lit("e"), F.col("seq").cast("string"))})
        acted = fold.fold_events(rows)
        assert {r["action"]: r["n"] for r in acted.groupBy("action").agg(F.count("*").alias("n")).collect()} == {"insert": 301, "merge": n - 1}
        last = fold.state_after(acted)
        one = last.filter("external_id = 'hot'").collect()
        assert last.count() == 301 and len(one) == 1 and json.loads(one[0]["raw_payload"]) == {"k": (n - 1) % 7, "once": "kept"} and one[0]["source_event_id"] == f"e{n - 1}"
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

"""Scenarios and properties of the library's own operators."""

import json
import random

import pytest
from pyspark.sql import functions as F

from fjordlake.functions import columns as L
from fjordlake.operators import cube, events, merge, quality, reconcile, registry, serving, signals
from fjordlake.plans import fixtures as X
from fjordlake.plans.config import SignalConfig
from fjordlake.sources import files
from fjordlake.streaming import merge_stream

EVENT = "external_id string, seq long, version timestamp, source_event_id string, title string, status string"


def events_of(spark, rows):
    made = spark.createDataFrame([(k, s, None if v is None else f"2024-01-{v:02d} 00:00:00", e, t, st) for k, s, v, e, t, st in rows], EVENT.replace("version timestamp", "version string"))
    return made.withColumn("version", F.col("version").cast("timestamp"))


def naive(rows):
    """One event at a time, in order."""
    state, actions = {}, {}
    for key, seq, version, event, title, status in sorted(rows, key=lambda r: r[1]):
        own, known = state.get(key), version or 0
        if own is None:
            state[key], actions[(key, seq)] = [version, event, title or None, status or None], "insert"
        elif known < (own[0] or 0):
            actions[(key, seq)] = "stale_ignored"
        else:
            new = [title or own[2], status or own[3]]
            if new == own[2:] and known <= (own[0] or 0):
                actions[(key, seq)] = "no_op"
                continue
            event_id = (event or own[1]) if known > (own[0] or 0) else (own[1] or event)
            state[key], actions[(key, seq)] = [version if known > (own[0] or 0) else own[0], event_id, *new], "merge"
    return state, actions


@pytest.mark.parametrize("seed", range(3))
def test_merge_is_the_fold(spark, seed):
    pick = random.Random(seed)
    rows = [(f"k{pick.randrange(40)}", i, pick.choice([None, *range(1, 9)]), pick.choice([None, f"e{i}"]), pick.choice([None, "", "a", "b"]), pick.choice(["ACTIVE", "INACTIVE"])) for i in range(400)]
    found = events_of(spark, rows)
    scalars = ("title", "status")
    state, actions = naive(rows)
    once, acted = merge.merge_events(found, scalars=scalars)
    assert {(r["external_id"], r["seq"]): r["action"] for r in acted.collect()} == actions
    as_dict = lambda df: {r["external_id"]: [r["source_event_version"].day if r["source_event_version"] else None, r["title"], r["status"]] for r in df.collect()}
    assert as_dict(once) == {k: [v[0], v[2], v[3]] for k, v in state.items()}
    cut = pick.randrange(1, 400)
    first, _ = merge.merge_events(found.filter(F.col("seq") < cut), scalars=scalars)
    both, _ = merge.merge_events(found.filter(F.col("seq") >= cut), first, scalars=scalars)
    assert as_dict(both) == as_dict(once)
    again, replayed = merge.merge_events(found.withColumn("seq", F.col("seq") + 1000), once, scalars=scalars)
    assert as_dict(once).keys() == as_dict(again).keys() and not {"insert"} & {r["action"] for r in replayed.collect()}


def test_acceptance_scenario(spark):
    rows = [("j", 1, 5, "e1", "Cook", "ACTIVE"), ("j", 2, 5, "e1", "Cook", "ACTIVE"), ("j", 3, 4, "e0", "Old", "ACTIVE"), ("j", 4, 6, "e2", None, "INACTIVE")]
    state, actions = merge.merge_events(events_of(spark, rows), scalars=("title", "status"))
    assert [r["action"] for r in actions.orderBy("seq").collect()] == ["insert", "no_op", "stale_ignored", "merge"]
    one = state.collect()[0]
    assert (one["title"], one["status"], one["source_event_id"]) == ("Cook", "INACTIVE", "e2")


@pytest.mark.parametrize("texts,expected", [
    (['{"a":1,"b":{"c":"x"}}', '{"b":{"c":"","d":[1]},"e":null}'], {"a": 1, "b": {"c": "x", "d": [1]}, "e": {}}),
    (['{"a":[1]}', '{"a":[]}', None], {"a": [1]}),
    (['{"a":{"b":1}}', '{"a":0}'], {"a": 0}),
    ([None, '{"a":null}'], {"a": None}),
])
def test_rich_merge(spark, texts, expected):
    got = spark.createDataFrame([(texts,)], "t array<string>").select(merge.rich_merge_json(F.col("t")).alias("x")).collect()[0]["x"]
    assert json.loads(got) == expected


def test_canonical_json(spark):
    rows = [('{"b":1,"a":{"_etag":2,"z":[{"imported_at":1,"k":2}]}}',), ("no json",), (None,)]
    got = [r["x"] for r in spark.createDataFrame(rows, "t string").select(merge.canonical_json(F.col("t")).alias("x")).collect()]
    assert got == ['{"a":{"z":[{"k":2}]},"b":1}', None, None]


def test_pages_of_list_since_meet_without_gaps(spark, sf_dir):
    state = X.view(spark, sf_dir, X.POSTINGS).filter(F.col("updated_at").isNotNull()).persist()
    seen, since, after = [], "1900-01-01", ""
    for _ in range(100):
        page = serving.list_since(state, F.lit(since).cast("timestamp"), after, 70).collect()
        if not page:
            break
        seen += [r["external_id"] for r in page]
        since, after = page[-1]["changed_at"].isoformat(), page[-1]["external_id"]
    assert len(seen) == len(set(seen)) == state.count()
    state.unpersist()


def test_closeout_leaves_nothing_closeable(spark, sf_dir):
    state = X.view(spark, sf_dir, X.POSTINGS).withColumn("payload_hash", merge.payload_hash(X.SCALARS, F.col("source_event_version")))
    snapshot = reconcile.reconcile_snapshot(X.view(spark, sf_dir, X.EVENTS).filter(F.col("event_id") % 3 == 1), "r")
    cutoff, derived = F.lit("2030-01-01").cast("timestamp"), F.lit(None).cast("timestamp")
    for _ in range(20):
        state, audit = reconcile.closeout(state, snapshot, cutoff, 250)
        if audit.isEmpty():
            break
    left = reconcile.closeout_remaining(state, snapshot, cutoff, derived).collect()[0]
    assert left["remaining"] == (1 if left["unversioned"] else 0)


def test_more_than_500_ids(spark, sf_dir):
    with pytest.raises(ValueError):
        serving.list_by_ids(X.view(spark, sf_dir, X.POSTINGS), [f"j{i}" for i in range(501)])


def test_safe_parsing(spark):
    rows = [("2024-02-30",), ("2024-02-29T10:00:00Z",), (" ",), (None,), ("soon",)]
    got = spark.createDataFrame(rows, "t string").select(L.safe_timestamp(F.col("t")).alias("a"), L.safe_date(F.col("t")).alias("b")).collect()
    assert [r["a"] is not None for r in got] == [False, True, False, False, False]
    assert [r["b"] is not None for r in got] == [False, True, False, False, False]


@pytest.mark.parametrize("url,expected", [("https://x/y", "https://x/y"), ("/a", "https://b/a"), ("a", "https://b/a"), (" ", None), (None, None)])
def test_urls(spark, url, expected):
    assert spark.createDataFrame([(url,)], "u string").select(L.resolve_url(F.col("u"), "https://b").alias("x")).collect()[0]["x"] == expected


def test_quality_flags_and_penalties(spark):
    cfg = SignalConfig()
    rows = spark.createDataFrame([(50.0, 80.0, 5.0)], "s double, p double, c double")
    parts = quality.change_quality(F.col("s"), F.col("p"), F.col("c"), cfg, F.lit(True), F.lit(True), F.lit(False), F.lit(False))
    got = rows.select(parts.alias("x")).collect()[0]["x"]
    assert set(got["flags"]) == {"unspecified_dimension", "total_category", "missing_labels", "mixed_units", "low_baseline", "noisy_change", "unstable_slice", "low_confidence_preview_only"}
    raw = 0.34 * 50 / 300 + 0.22 * 5 / 50 + 0.22 * 0.45
    assert got["score"] == pytest.approx(raw * 0.55 * 0.35 * 0.75, abs=1e-4)


CUBE = {"class": "dataset", "label": "Jobs", "id": ["Region", "Tid"], "size": [2, 2], "dimension": {"Region": {"label": "region", "category": {"index": {"B": 1, "A": 0}, "label": {"A": "North", "B": "alle"}}}, "Tid": {"label": "year", "category": {"index": {"2023": 0, "2024": 1}, "label": {"2023": "2023", "2024": "2024"}}}}, "value": [1.0, 2.0, None, 4.0]}


def test_cube_files(spark, tmp_path):
    (tmp_path / "11615_a.json").write_text(json.dumps(CUBE | {"value": [9, 9, 9, 9]}))
    (tmp_path / "11615_b.json").write_text(json.dumps({"request_method_used": "GET", "data": CUBE}))
    (tmp_path / "11615_metadata.json").write_text("{}")
    (tmp_path / "12850_a.json").write_text("[1]")
    (tmp_path / "09793_a.json").write_text(json.dumps(CUBE | {"value": [1.0]}))
    cubes, rejects = files.read_cube_files(spark, f"{tmp_path}/*.json")
    assert [r["source_file"] for r in rejects.collect()] == ["12850_a.json"]
    got = {(r["dimensions"]["Region"], r["period"]): r["value"] for r in cube.cube_flatten(cubes).collect()}
    assert got == {("A", "2023"): 1, ("A", "2024"): 2, ("B", "2024"): 4}
    assert {r["table_id"]: r["matches"] for r in cube.check_cartesian(cubes).collect()} == {"11615": True, "09793": False}
    assert cube.cube_flatten(cubes, lenient=True).count() == 5
    totals = {r["code"]: r["is_total"] for r in cube.dimension_catalog(cubes)[1].filter("dimension = 'region'").collect()}
    assert totals == {"A": False, "B": True}


def test_signal_files_round_trip(spark, sf_dir, tmp_path):
    found = signals.regional_education_signal(X.regional(spark, sf_dir), SignalConfig(min_baseline=2, min_absolute_change=1))
    files.write_signals_csv(found, f"{tmp_path}/s")
    back = files.read_signal_csv(spark, f"{tmp_path}/s")
    key = lambda df: sorted((r["signal_deterministic_hash"], r["value_end"], r["percent_change"], tuple(r["quality_flags"]), r["explainability_summary_json"]) for r in df.collect())
    assert key(back) == key(found) and back.count() > 0


def test_decision_and_sheet_files(spark, tmp_path):
    (tmp_path / "d.csv").write_text("signal_deterministic_hash,review_decision,reviewer_id,reviewed_at,review_notes\nh1,reject,,,\nh1,approve_for_persistence,anna,,\n,reject,,,\nh2,approve_for_persistence,,,\nh3,maybe,x,,\n")
    good, bad = files.read_review_decisions(spark, f"{tmp_path}/d.csv")
    assert [(r["signal_deterministic_hash"], r["review_decision"]) for r in good.collect()] == [("h1", "approve_for_persistence")]
    assert sorted(r["reason"] for r in bad.collect()) == ["approval without reviewer", "unknown decision"]
    (tmp_path / "sheet.csv").write_text(" Navn ,,URL\na,1,u\n,,\n")
    rows = files.read_source_sheets(spark, f"{tmp_path}/sheet.csv")
    assert rows.columns[:3] == ["navn", "column_1", "url"] and [r["sheet"] for r in rows.collect()] == ["sheet"]


def page(n, items):
    return json.dumps({"feed_url": f"/p{n}", "next_url": f"/p{n + 1}", "items": items})


def item(key, day, status="ACTIVE", **more):
    return {"id": key, "url": f"/{key}", "date_modified": f"2024-01-{day:02d}T00:00:00Z", "_feed_entry": {"status": status, "businessName": "Firm"}} | more


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    landing, state, mark = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "mark")
    landing.mkdir()
    (landing / "page-1.json").write_text(page(1, [item("a", 2, title="Cook"), item("b", 2), item("c", 1, status="ODD")]))
    (landing / "page-2.json").write_text(page(2, [item("a", 1, title="Late"), item("b", 3, status="INACTIVE")]))
    (landing / "page-3.json").write_text(json.dumps({"feed_url": "/p3"}))
    run = lambda: merge_stream.start_merge_stream(spark, str(landing), state, mark, "https://f", pages_per_batch=1).awaitTermination()
    run()
    look = lambda: {r["external_id"]: (r["title"], r["status"], r["payload_hash"]) for r in merge_stream.current_state(spark, state).collect()}
    first = look()
    assert {k: v[:2] for k, v in first.items()} == {"a": ("Cook", "ACTIVE"), "b": (None, "INACTIVE")}
    (landing / "page-4.json").write_text((landing / "page-1.json").read_text())
    run()
    assert look() == first
    items = files.read_feed_pages(spark, f"{landing}/page-[12].json")
    merge_stream.merge_batch(items, 0, str(tmp_path / "batch"), "https://f")
    assert {r["external_id"]: (r["title"], r["status"], r["payload_hash"]) for r in merge_stream.current_state(spark, str(tmp_path / "batch")).collect()} == first


def test_event_rules(spark):
    made = spark.createDataFrame([json.loads(json.dumps(item("a", 2)))], events.ITEM_SCHEMA).withColumn("detail", F.lit(None).cast(f"struct<{events.DETAIL_SCHEMA.replace(' string', ':string').replace(' struct', ':struct')}>"))
    got = events.normalize_events(made, "https://f")
    off = events.inactive_event(got, "now").collect()[0]
    assert off["status"] == "INACTIVE" and off["source_event_id"].startswith("a:INACTIVE:2024-01-02") and off["inactive_note"]["source_event_at_reliable"]


def test_scores_that_miss_a_tie_by_rounding_round_to_even(spark):
    """Of the smaller table: 0.665 of a total comes to just below 0.23275."""
    near = spark.createDataFrame([(0.23274999999999998,), (0.23275,), (0.23265,), (0.2327,), (0.0,), (None,)], "x double")
    assert [r.y for r in near.select(L.half_even_scaled(F.col("x"), 4).alias("y")).collect()] == [0.2328, 0.2328, 0.2326, 0.2327, 0.0, None]


def test_rows_with_one_name_keep_slugs_of_their_own(spark):
    """Digests of these two agree in their first eight digits."""
    cells = F.create_map(F.lit("kilde"), F.lit("Same"), F.lit("url"), F.col("id").cast("string"))
    sheets = spark.createDataFrame([(54002,), (82235,)], "id long").select(F.lit("s").alias("sheet"), F.col("id").cast("int").alias("row_no"), cells.alias("cells"))
    rows = registry.source_rows(sheets, "layer", "emp-demand", "b")
    assert rows.select(F.regexp_replace("slug", ".{8}$", "")).distinct().count() == 1 and rows.select("slug").distinct().count() == 2

"""Sheets, cubes, clustered pages, kept-up health and summaries beyond what the queries show."""

import json

import pytest
from pyspark.sql import functions as F

from fjordlake.functions import columns as L
from fjordlake.operators import cube, fold, health, registry, serving, signals
from fjordlake.plans import fixtures as X
from fjordlake.plans import payload_queries, posting_queries
from fjordlake.plans.config import SignalConfig
from fjordlake.sources import clustered, sheets, summary


def test_sheets_with_headers_of_their_own(spark, tmp_path):
    (tmp_path / "First.csv").write_text(' Kilde ,,URL,url\n"a,\nb",1, u ,v\n\n,,,\nc\nd,2,,w,beyond\n')
    (tmp_path / "second.CSV").write_text("﻿title,Eier\nT,me\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "note.txt").write_text("x\ny\n")
    rows = sheets.read_sheets(spark, str(tmp_path))
    got = sorted((r["sheet"], r["row_no"], r["cells"]) for r in rows.collect())
    first = ["kilde", "column_1", "url"]
    assert got == [("First", 2, dict(zip(first, ["a,\nb", "1", "v"]))), ("First", 5, dict(zip(first, ["c", None, None]))), ("First", 6, dict(zip(first, ["d", "2", "w"]))), ("second", 2, {"title": "T", "eier": "me"})]
    made = {r["name"]: (r["url"], r["owner_team"], json.loads(r["metadata"])["sheet_row"]) for r in registry.source_rows(rows, "l", "p", "w").collect()}
    assert made == {"a,\nb": ("v", None, 2), "c": (None, None, 5), "d": ("w", None, 6), "T": (None, "me", 2)}
    assert sheets.read_sheets(spark, str(tmp_path / "First.csv")).count() == 3


def test_a_cell_by_part_of_its_header(spark):
    rows = spark.createDataFrame([(1, {"z": "no", "api url": "by part", "lenke": " "}), (2, {"min kilde": "first", "kilde": "exact"}), (3, {}), (4, None)], "i int, cells map<string,string>")
    got = {r["i"]: (r["u"], r["n"]) for r in rows.select("i", registry.pick_cell(F.col("cells"), registry.URL_KEYS).alias("u"), registry.pick_cell(F.col("cells"), registry.NAME_KEYS).alias("n")).collect()}
    assert got == {1: ("by part", None), 2: (None, "exact"), 3: (None, None), 4: (None, None)}


def big_cube(spark, regions, periods):
    codes = lambda n, p: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(F.lit(p), i.cast("string")))
    as_dimension = lambda n, p: F.struct(F.lit(p).alias("label"), F.struct(F.map_from_entries(F.transform(codes(n, p), lambda c, i: F.struct(c, i))).alias("index"), F.map_from_entries(F.transform(codes(n, p), lambda c, i: F.struct(c, c))).alias("label"), F.lit(None).cast("map<string,struct<base:string,label:string>>").alias("unit")).alias("category"))
    value = F.transform(F.sequence(F.lit(0), F.lit(regions * periods - 1)), lambda i: F.when(i % 10 != 0, i.cast("double")))
    return spark.range(1).select(
        F.lit("1").alias("table_id"), F.lit("1.json").alias("source_file"), F.lit("big").alias("label"), F.array(F.lit("Region"), F.lit("Tid")).alias("id"), F.array(F.lit(regions), F.lit(periods)).alias("size"),
        F.array(F.lit("Tid")).alias("role_time"), F.lit(None).cast("array<string>").alias("role_metric"), F.create_map(F.lit("Region"), as_dimension(regions, "r"), F.lit("Tid"), as_dimension(periods, "t")).alias("dimension"), value.alias("value"),
    )


def test_a_large_cube_is_flattened_by_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        flat = cube.cube_flatten(big_cube(spark, 300, 200), slice_cells=1000).withColumn("task", F.spark_partition_id())
        got = flat.agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.countDistinct("task").alias("tasks"), F.countDistinct("id").alias("ids")).first()
        cells = [i for i in range(60_000) if i % 10]
        assert (got["n"], got["total"], got["ids"]) == (len(cells), sum(cells), len(cells)) and got["tasks"] > 2
        assert flat.filter((F.col("value") == 12_345) & (F.col("dimensions")["Region"] == "r61") & (F.col("period") == "t145")).count() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("slice_cells", [1, 4, 1 << 16])
def test_slices_of_odd_cubes(spark, slice_cells):
    one = big_cube(spark, 2, 3)
    odd = one.withColumn("value", F.array(*(F.lit(float(i)) for i in range(8)))).withColumn("table_id", F.lit("surplus")).unionByName(one.withColumn("value", F.array().cast("array<double>")).withColumn("table_id", F.lit("none")))
    assert cube.cube_flatten(odd, slice_cells=slice_cells).count() == 0
    lenient = cube.cube_flatten(odd, lenient=True, slice_cells=slice_cells).collect()
    assert sorted(r["value"] for r in lenient) == [0, 1, 2, 3, 4, 5] and {r["table_id"] for r in lenient} == {"surplus"}


def test_clustered_pages_meet_and_read_few_files(spark, sf_dir, tmp_path):
    state = posting_queries.postings(spark, sf_dir).drop("payload_hash")
    path = str(tmp_path / "clustered")
    clustered.write_clustered(state, path)
    seen, since, after = [], F.lit("1900-01-01").cast("timestamp"), ""
    while rows := clustered.page_of(spark, path, since, after, 100).collect():
        seen += [(r["changed_at"], r["external_id"]) for r in rows]
        since, after = F.lit(rows[-1]["changed_at"]), rows[-1]["external_id"]
    known = state.withColumn("changed_at", F.greatest("updated_at", "event_modified_at")).filter("changed_at IS NOT NULL")
    assert seen == sorted(seen) == sorted((r["changed_at"], r["external_id"]) for r in known.collect())
    page = clustered.page_of(spark, path, F.lit(seen[len(seen) // 2][0]), seen[len(seen) // 2][1], 20)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(changed_at" in plan and "PartitionFilters: [isnotnull(changed_day" in plan
    assert page.count() == 20 and [tuple(r) for r in page.select("changed_at", "external_id").collect()] == seen[len(seen) // 2 + 1 : len(seen) // 2 + 21]
    held = {d: n for d, n in spark.read.parquet(f"{path}/days").collect()}
    assert sum(held.values()) == len(seen) and page.agg(F.countDistinct(F.to_date("changed_at"))).first()[0] < len(held)
    assert [tuple(r) for r in page.select("external_id").collect()] == [tuple(r) for r in serving.list_since(state, F.lit(seen[len(seen) // 2][0]), seen[len(seen) // 2][1], 20).select("external_id").collect()]


def test_no_page_behind_the_last_row(spark, sf_dir, tmp_path):
    clustered.write_clustered(posting_queries.postings(spark, sf_dir).limit(5), str(tmp_path / "c"))
    assert clustered.page_of(spark, str(tmp_path / "c"), F.lit("2100-01-01").cast("timestamp")).count() == 0


def test_health_after_each_batch_equals_a_scan(spark, sf_dir):
    found = payload_queries.feed(spark, sf_dir)
    state, counters = None, None
    now = F.lit("2024-02-01").cast("timestamp")
    for batch in range(3):
        acted = fold.fold_events(found.filter(F.col("event_id") % 3 == batch), state).cache()
        counters = health.add_health(counters, fold.audit_of(acted)).cache()
        state = fold.state_after(acted).cache()
        active, detailed = F.col("status") == "ACTIVE", L.has_path(F.col("raw_payload"), "$.nav_detail")
        scan = state.agg(
            F.count("*").alias("total"), F.count_if(active).alias("active"), F.count_if(F.col("status") == "INACTIVE").alias("inactive"), F.count_if(active & detailed).alias("active_with_detail"), F.count_if(active & ~detailed).alias("active_missing_detail"),
            F.count_if(active & F.col("expires_at").isNull()).alias("active_without_expiry"), F.count_if(active & (F.col("expires_at") < now)).alias("active_expired"), F.max("source_event_version").alias("latest_source_event_at"),
        ).first()
        assert health.health_of(counters, now).first() == scan


def test_null_is_not_absent(spark):
    texts = {'{"a":{"b":null}}': (True, True), '{"a":{"b":0}}': (True, False), '{"a":{}}': (False, False), "{": (False, False), None: (False, False), "null": (False, False)}
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r["t"]: (r["x"], r["y"]) for r in rows.select("t", L.has_path(F.col("t"), "$.a.b").alias("x"), L.is_json_null(F.col("t"), "$.a.b").alias("y")).collect()} == texts


def test_summary_takes_one_pass(spark, tmp_path):
    rows = spark.range(100).withColumn("reason", F.when(F.col("id") % 3 == 0, "small").when(F.col("id") % 3 == 1, "late"))
    tracker, group = spark.sparkContext.statusTracker(), "summary-pass"
    spark.sparkContext.setJobGroup(group, group)
    written = summary.write_with_summary(spark, {"kept": rows, "none": rows.filter("id < 0")}, str(tmp_path / "out"), {"b": "2", "a": "1"}, {"kept": summary.counts_by("reason", ("small", "late", "other"))})
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    assert jobs <= 3 and spark.read.parquet(f"{tmp_path}/out/kept").count() == 100
    back = summary.read_summary(spark, str(tmp_path / "out")).first()
    assert back["counters"] == {"kept": {"rows": 100, "reason_small": 34, "reason_late": 33, "reason_other": 0}, "none": {"rows": 0}} and back["config"] == {"a": "1", "b": "2"} and written.first() == back
    with pytest.raises(Exception):
        summary.write_with_summary(spark, {"kept": rows}, str(tmp_path / "out"), {})


def test_totals_of_keys_and_of_dimensions_without_parts_stay(spark):
    rows = [("a", "TOT", "x", "Alle", "1"), ("a", "TOT", "y", "Y", "2"), ("TOT", "TOT", "y", "Y", "4"), ("b", "TOT", "z", "Z", "8")]
    flat = spark.createDataFrame([(f"i{v}", "09793", "1999", "L", "u", float(v), o, s, a, al) for o, s, a, al, v in rows], "id string, table_id string, period string, contents_code string, unit string, value double, occupation string, sex string, age string, age_label string")
    obs = X.observations(flat, {"Yrke": "occupation", "Kjonn": "sex", "Alder": "age"}, {"Alder": "age_label"})
    found = {r["Yrke"]: (r["value_end"], r["ids"]) for r in signals.snapshot_buckets(obs, "09793", ("Yrke",), SignalConfig(exclude_totals="rows")).collect()}
    assert found == {"a": (2, ["i2"]), "TOT": (4, ["i4"]), "b": (8, ["i8"])}


def test_audit_rows_are_folded_once(spark, sf_dir, monkeypatch):
    from fjordlake.plans import store_queries

    folds, own = [], fold.fold_events
    monkeypatch.setattr(fold, "fold_events", lambda *a: folds.append(1) or own(*a))
    assert store_queries.QUERIES["write_audit"](spark, sf_dir).columns == ["run_id", "run_mode", "change_kind", "n"] and len(folds) == 1

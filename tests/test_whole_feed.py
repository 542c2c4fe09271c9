"""Operators over whole feeds and groups of any size."""

import json
import random

from pyspark.sql import functions as F

from fjordlake.operators import merge
from fjordlake.plans import fixtures as X
from fjordlake.plans import posting_queries


def test_merged_payloads_carries_one_object_a_key(spark):
    draw = random.Random(3)
    payload = lambda: draw.choice([None, "", "null", "{}", '{"a":""}', json.dumps({draw.choice("abc"): draw.choice([1, "", "x", {draw.choice("de"): draw.randrange(9)}])})])
    rows = [(draw.choice(["hot"] * 9 + ["k1", "k2", None]), draw.randrange(900), draw.choice(["insert", "merge", "no_op", "stale_ignored"]), payload()) for _ in range(3000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = merge.merged_payloads(spark.createDataFrame(rows, "external_id string, seq long, action string, raw_payload string"))
        got = {r["external_id"]: r["raw_payload"] for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {}
    for key, _, action, text in sorted(rows, key=lambda r: (r[1], r[3] is not None, r[3] or "")):
        if action != "stale_ignored":
            expected[key] = merge._richer(expected.get(key, merge._ABSENT), json.loads(text) if text else None)
    assert {k: json.loads(v) for k, v in got.items()} == expected
    assert "collect_list" not in found._jdf.queryExecution().toString()
    assert merge.merged_payloads(found.limit(0).select("external_id", F.lit(1).alias("seq"), F.lit("merge").alias("action"), "raw_payload")).count() == 0


def test_a_snapshot_of_the_whole_feed_has_every_id(spark, sf_dir):
    last = {}
    for r in X.view(spark, sf_dir, X.EVENTS).collect():
        rank = (str(r["version"] or ""), r["seq"])
        if r["external_id"] not in last or rank > last[r["external_id"]][0]:
            last[r["external_id"]] = rank, r["status"], r["source_event_id"]
    got = posting_queries.QUERIES["reconcile_snapshot_whole"](spark, sf_dir).collect()
    assert {r["external_id"]: (r["final_status"], r["source_event_id"]) for r in got} == {k: v[1:] for k, v in last.items()}
    assert len(got) == len(last)

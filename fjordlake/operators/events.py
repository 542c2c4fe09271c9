"""Feed items to posting events."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordlake.functions import columns as L

ENTRY = "struct<status:string,title:string,businessName:string,municipal:string,sistEndret:string>"
CONTENT = "struct<published:string,expires:string,updated:string,applicationDue:string>"
#: Payload keys of the detail, of the last known status and of an inactive event's note.
DETAIL_KEY, STATUS_KEY, INACTIVE_KEY = "nav_detail", "last_nav_status", "nav_inactive_event"
ITEM_COLUMNS = ("id", "url", "title", "date_modified", "_feed_entry")
ITEM_SCHEMA = f"id string, url string, title string, date_modified string, _feed_entry {ENTRY}"
DETAIL_SCHEMA = f"uuid string, status string, sistEndret string, ad_content {CONTENT}, json {CONTENT}"


def event_version(*texts: Column) -> Column:
    """The newest readable of several timestamps in text."""
    return L.newest(*(L.safe_timestamp(t) for t in texts))


def normalize_events(items: DataFrame, base_url: str) -> DataFrame:
    """Events from items (the columns of ITEM_SCHEMA, and a struct `detail` of DETAIL_SCHEMA, which may be null). Items without an id go."""
    entry, detail = F.col("_feed_entry"), F.col("detail")
    content = lambda c: F.coalesce(detail["ad_content"], detail["json"])[c]
    external_id = L.first_text(F.col("id"), detail["uuid"])
    version = event_version(F.col("date_modified"), entry["sistEndret"], detail["sistEndret"], content("updated"))
    status = L.first_text(detail["status"], entry["status"])
    events = items.select(
        "*",
        external_id.alias("external_id"), version.alias("version"), status.alias("event_status"),
    )
    others = [c for c in items.columns if c not in (*ITEM_COLUMNS, "detail")]
    return events.filter(F.col("external_id").isNotNull()).select(
        *others,
        "external_id",
        L.first_text(F.col("title"), entry["title"]).alias("title"),
        L.blank_to_null(entry["businessName"]).alias("company_name"),
        L.blank_to_null(entry["municipal"]).alias("location"),
        F.col("event_status").alias("status"),
        L.resolve_url(F.col("url"), base_url).alias("url"),
        F.col("version").alias("date_modified"), F.col("version").alias("event_modified_at"), "version",
        L.safe_timestamp(content("published")).alias("published_at"), L.safe_timestamp(content("expires")).alias("expires_at"), L.safe_date(content("applicationDue")).alias("application_due"),
        F.to_json(F.struct("id", "url", "date_modified", "_feed_entry", detail.alias(DETAIL_KEY), F.col("event_status").alias(STATUS_KEY))).alias("raw_payload"),
        L.source_event_id(F.col("external_id"), F.col("event_status"), L.utc_text(F.col("version"))).alias("source_event_id"),
    )


def event_class(status: Column) -> Column:
    clean = F.trim(status)
    return F.when(clean == "ACTIVE", "active").when(clean == "INACTIVE", "inactive").otherwise("skipped")


def classify_events(events: DataFrame) -> DataFrame:
    return events.groupBy(event_class(F.col("status")).alias("class")).agg(F.count("*").alias("n"))


def with_key(payload: Column, key: str, value: Column) -> Column:
    """A JSON object's text with key set to the JSON text in value, in place of any it has; of text that is no object, the key alone is kept."""
    @F.pandas_udf("string")
    def run(payloads: pd.Series, values: pd.Series) -> pd.Series:
        def one(text, own):
            try:
                found = json.loads(text) if text else {}
            except ValueError:
                found = {}
            return json.dumps((found if isinstance(found, dict) else {}) | {key: json.loads(own)}, separators=(",", ":"), ensure_ascii=False)

        return pd.Series([one(t, v) for t, v in zip(payloads, values)], dtype=object)

    return run(payload, value)


def inactive_event(events: DataFrame, observed_at: str) -> DataFrame:
    """Events with status INACTIVE; inactive_note says when it was seen and whether the source gave a time, and goes into a payload, too."""
    note = F.struct(F.lit(observed_at).alias("observed_at"), L.utc_text(F.col("version")).alias("source_event_at"), F.col("version").isNotNull().alias("source_event_at_reliable"), F.col("external_id").alias("external_id"))
    noted = []
    if "raw_payload" in events.columns:
        marked = with_key(F.col("raw_payload"), INACTIVE_KEY, F.to_json(note, {"ignoreNullFields": "false"}))
        noted = [with_key(marked, STATUS_KEY, F.lit('"INACTIVE"')).alias("raw_payload")]
    return events.select(
        *(F.col(c) for c in events.columns if c not in ("status", "source_event_id", "raw_payload")),
        *noted,
        F.lit("INACTIVE").alias("status"),
        L.source_event_id(F.col("external_id"), F.lit("INACTIVE"), L.utc_text(F.col("version"))).alias("source_event_id"),
        note.alias("inactive_note"),
    )


def attach_details(items: DataFrame, details: DataFrame, budget: int, order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Active items, the first `budget` of them in feed order with their detail, and what is queued with its reason."""
    active = items.filter(event_class(F.col("status")) == "active")
    first = active.orderBy(order).limit(budget).select("external_id", order).withColumn("within", F.lit(True))
    known = details.select("external_id", F.col("detail").alias("found"))
    joined = active.join(first, ["external_id", order], "left").join(known, "external_id", "left")
    with_detail = joined.select(*active.columns, F.when(F.col("within"), F.col("found")).alias("found"))
    reason = F.when(F.col("within").isNull(), "detail budget exhausted").when(F.col("found").isNull(), "detail missing")
    queued = joined.select("external_id", order, reason.alias("reason")).filter(F.col("reason").isNotNull())
    return with_detail, queued


def queue_details(queue: DataFrame, queued: DataFrame, resolved: DataFrame, now: Column) -> DataFrame:
    """The retry queue after a page: queued ids pending (the last reason counts), resolved ones resolved, which wins."""
    new = queued.groupBy("external_id").agg(F.max_by("reason", "seq").alias("last_error"))
    done = resolved.select("external_id").distinct().withColumn("done", F.lit(True))
    old = queue.select("external_id", "status", "attempt_count", "next_attempt_at")
    touched = new.join(done, "external_id", "full")
    rows = old.join(touched, "external_id", "full")
    status = F.when(F.col("done"), "resolved").when(F.col("last_error").isNotNull(), "pending").otherwise(F.col("status"))
    is_new = F.col("last_error").isNotNull() & F.col("done").isNull()
    return rows.filter(F.col("status").isNotNull() | F.col("last_error").isNotNull()).select(
        "external_id", status.alias("status"), F.coalesce("attempt_count", F.lit(0)).alias("attempt_count"), F.when(is_new, now).otherwise(F.col("next_attempt_at")).alias("next_attempt_at"), "last_error"
    )


def due_details(queue: DataFrame, now: Column, n: int, fallback: DataFrame | None = None) -> DataFrame:
    """The oldest due ids; only if none is due, ids of `fallback` (active postings without detail)."""
    due = queue.filter((F.col("status") == "pending") & (F.col("next_attempt_at") <= now)).orderBy("next_attempt_at", "external_id").limit(n).select("external_id")
    if fallback is None:
        return due
    none_due = due.agg(F.count("*").alias("n")).filter(F.col("n") == 0)
    return due.unionByName(fallback.select("external_id").orderBy("external_id").limit(n).join(F.broadcast(none_due.select(F.lit(True).alias("go"))), F.col("go")).drop("go"))


def fail_details(queue: DataFrame, failures: DataFrame, now: Column, most_attempts: int = 10) -> DataFrame:
    """The queue after failed attempts: one attempt more, a growing delay, abandoned at the limit."""
    failed = failures.select("external_id", F.col("message").alias("failure")).dropDuplicates(["external_id"])
    rows = queue.join(failed, "external_id", "left")
    attempts = F.col("attempt_count") + 1
    hit = F.col("failure").isNotNull()
    return rows.select(
        "external_id",
        F.when(hit & (attempts >= most_attempts), "abandoned").when(hit, "pending").otherwise(F.col("status")).alias("status"),
        F.when(hit, attempts).otherwise(F.col("attempt_count")).cast("int").alias("attempt_count"),
        F.when(hit, now + F.make_dt_interval(mins=L.backoff_minutes(attempts))).otherwise(F.col("next_attempt_at")).alias("next_attempt_at"),
        F.col("failure").alias("last_error"),
    )

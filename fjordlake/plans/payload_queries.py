"""Registered queries of the payload fold. Their DuckDB forms hold no fold: a running maximum gates events and each leaf of a payload is the last that is not empty among accepted ones, which is what merging comes to for payloads of a known shape."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjordlake.operators import events, fold, merge
from fjordlake.plans import fixtures as X
from fjordlake.plans.posting_queries import _NOW, late, now, us

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, oracle
        return f

    return add


def feed(spark, sf_dir) -> DataFrame:
    """Feed events with both times and a payload: some of its keys are absent, null, empty or volatile, and some versions come from it alone."""
    found = X.view(spark, sf_dir, X.EVENTS)
    seen = F.when(F.col("event_id") % 5 == 0, F.lit("")).otherwise(F.coalesce(F.date_format("version", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit("")))
    entry = F.struct(F.col("status"), seen.alias("sistEndret"))
    extra = F.when(F.col("event_id") % 3 == 1, F.struct((F.col("event_id") % 4).alias("k"))).alias("extra")
    tags = F.when(F.col("event_id") % 6 == 0, F.array(F.concat(F.lit("t"), (F.col("event_id") % 7).cast("string")))).otherwise(F.array().cast("array<string>"))
    detail = F.struct(tags.alias("tags"), F.coalesce("detail", F.lit("")).alias("note")).alias("nav_detail")
    own = [entry.alias("_feed_entry"), extra, F.col("seq").alias("_etag")]
    text = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    return found.withColumns({
        "raw_payload": F.when(F.col("event_id") % 4 == 0, text(*own)).otherwise(text(detail, *own)),
        "date_modified": F.when(F.col("event_id") % 13 != 0, F.col("version")),
        "event_modified_at": F.when(F.col("event_id") % 4 != 0, F.col("version")),
    })


_UTC = lambda c: f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ')"
_LEAVES = f"""SELECT *, CASE WHEN event_id % 13 <> 0 THEN version END AS date_modified, CASE WHEN event_id % 4 <> 0 THEN version END AS event_modified_at, CASE WHEN event_id % 5 <> 0 THEN {_UTC('version')} END AS seen,
CASE WHEN event_id % 3 = 1 THEN event_id % 4 END AS extra, CASE WHEN event_id % 4 <> 0 THEN 1 END AS has_detail, CASE WHEN event_id % 4 <> 0 AND event_id % 6 = 0 THEN concat('t', CAST(event_id % 7 AS VARCHAR)) END AS tag, CASE WHEN event_id % 4 <> 0 THEN detail END AS note FROM ({X.EVENTS}) e"""
_KEPT = ("title", "company_name", "location", "url", "status", "published_at", "expires_at", "application_due", "date_modified", "event_modified_at", "seen", "extra", "has_detail", "tag", "note")
_DETAIL = "json_object('note', coalesce(note, ''), 'tags', CASE WHEN tag IS NULL THEN json_array() ELSE json_array(tag) END)"
_ENTRY = "'_feed_entry', json_object('sistEndret', coalesce(seen, ''), 'status', status), 'extra', CASE WHEN extra IS NULL THEN {empty} ELSE json_object('k', extra) END"
_JSON = lambda empty: f"CASE WHEN has_detail = 1 THEN json_object({_ENTRY.format(empty=empty)}, 'nav_detail', {_DETAIL}) ELSE json_object({_ENTRY.format(empty=empty)}) END"
_HASH = lambda payload: f"md5(CAST(json_object('application_due', CAST(application_due AS VARCHAR), 'company_name', company_name, 'date_modified', {_UTC('date_modified')}, 'event_modified_at', {_UTC('event_modified_at')}, 'expires_at', {_UTC('expires_at')}, 'location', location, 'published_at', {_UTC('published_at')}, 'raw_payload', {payload}, 'status', status, 'title', title, 'url', url) AS VARCHAR))"
_RANK = "coalesce(own_version, TIMESTAMP '0001-01-01 00:00:00')"
_KEY = "(PARTITION BY external_id ORDER BY seq"
#: A first event's null stays null in its hash, since nothing is merged; a merged one is an empty object.
_APPLIED = f"""WITH l AS (SELECT *, greatest(date_modified, event_modified_at, CASE WHEN seen IS NOT NULL THEN version END) AS own_version FROM ({_LEAVES}) z),
g AS (SELECT *, max({_RANK}) OVER {_KEY} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM l), a AS (SELECT *, top IS NULL OR {_RANK} >= top AS accepted, top IS NULL OR {_RANK} > top AS advances FROM g),
m AS (SELECT external_id, seq, top, accepted, advances, source_event_id AS own_id, own_version, nullif(max({_RANK}) OVER {_KEY}), TIMESTAMP '0001-01-01 00:00:00') AS source_event_version, count(*) FILTER (WHERE accepted AND top IS NOT NULL) OVER {_KEY}) AS merges,
{", ".join(f"last_value(CASE WHEN accepted THEN {c} END IGNORE NULLS) OVER {_KEY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in _KEPT)} FROM a),
j AS (SELECT *, CASE WHEN merges = 0 THEN {_JSON("NULL")} ELSE {_JSON("json_object()")} END AS payload FROM m), h AS (SELECT *, {_HASH("payload")} AS new_hash FROM j),
x AS (SELECT *, CASE WHEN top IS NULL THEN 'insert' WHEN NOT accepted THEN 'stale_ignored' WHEN lag(new_hash) OVER {_KEY}) = new_hash THEN 'no_op' ELSE 'merge' END AS action FROM h),
r AS (SELECT *, coalesce(last_value(CASE WHEN action IN ('insert', 'merge') AND advances THEN own_id END IGNORE NULLS) OVER {_KEY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(CASE WHEN action IN ('insert', 'merge') AND NOT advances THEN own_id END IGNORE NULLS) OVER {_KEY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS source_event_id FROM x)
"""
_LAST = _APPLIED + ", s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY seq DESC) AS nth FROM r) t WHERE nth = 1) "


@query("merge_payload_actions", _APPLIED + "SELECT external_id, seq, action, new_hash AS payload_hash, source_event_id FROM r")
def _(spark, sf_dir):
    return fold.fold_events(feed(spark, sf_dir), columns=("external_id", "seq", "action", "payload_hash", "source_event_id"))


@query("merge_payload_events", _LAST + "SELECT external_id, epoch_us(source_event_version) AS source_event_version, source_event_id, new_hash AS payload_hash, CAST(payload AS VARCHAR) AS payload, title, location, status, epoch_us(date_modified) AS date_modified, application_due FROM s")
def _(spark, sf_dir):
    """In two batches: the first half of the feed, then the second on the postings it left."""
    found = feed(spark, sf_dir)
    state = fold.fold_state(late(found, 1, 2, "left_anti"))
    after = fold.fold_state(late(found, 1, 2), state)
    return after.select("external_id", us("source_event_version").alias("source_event_version"), "source_event_id", "payload_hash", merge.canonical_json(F.col("raw_payload")).alias("payload"), "title", "location", "status", us("date_modified").alias("date_modified"), "application_due")


@query("merge_payload_audit", _APPLIED + ", b AS (SELECT *, lag(new_hash) OVER (PARTITION BY external_id ORDER BY seq) AS old_hash, lag(source_event_version) OVER (PARTITION BY external_id ORDER BY seq) AS old_version, lag(title) OVER (PARTITION BY external_id ORDER BY seq) AS old_title FROM r) SELECT external_id, seq, action AS change_kind, CASE WHEN action = 'merge' THEN old_hash END AS previous_hash, CASE WHEN action = 'merge' THEN epoch_us(old_version) END AS previous_version, CASE WHEN action = 'merge' THEN old_title END AS previous_title, new_hash, epoch_us(source_event_version) AS new_version FROM b WHERE action IN ('insert', 'merge')")
def _(spark, sf_dir):
    audited = ("payload_hash", "source_event_version", "title")
    audit = fold.audit_of(fold.fold_events(feed(spark, sf_dir), columns=("external_id", "seq", "action", *audited, *(f"previous_{c}" for c in audited))))
    return audit.select(
        "external_id", "seq", "change_kind", F.col("previous_values.payload_hash").alias("previous_hash"), us("previous_values.source_event_version").alias("previous_version"), F.col("previous_values.title").alias("previous_title"),
        F.col("new_values.payload_hash").alias("new_hash"), us("new_values.source_event_version").alias("new_version"),
    )


@query("merge_payload_present", _APPLIED + f", f AS (SELECT DISTINCT external_id FROM r WHERE action IN ('insert', 'merge') AND 2 * seq > (SELECT max(seq) FROM r)) SELECT s.external_id, CASE WHEN f.external_id IS NOT NULL THEN 'r1' END AS last_reconciled_run_id, CASE WHEN f.external_id IS NOT NULL THEN epoch_us({_NOW}) END AS last_reconciled_at, CASE WHEN f.external_id IS NOT NULL THEN 'present' END AS reconciliation_status FROM (SELECT DISTINCT external_id FROM r) s LEFT JOIN f ON s.external_id = f.external_id")
def _(spark, sf_dir):
    """The feed's second half as a reconcile run on the postings that the first left: what it writes is stamped, a no_op is not."""
    found = feed(spark, sf_dir)
    state = fold.fold_state(late(found, 1, 2, "left_anti"))
    after = fold.fold_state(late(found, 1, 2), state, ("r1", now()))
    return after.select("external_id", "last_reconciled_run_id", us("last_reconciled_at").alias("last_reconciled_at"), "reconciliation_status")


@query("posting_hash", f"SELECT seq, {_HASH(_JSON('NULL'))} AS payload_hash FROM ({_LEAVES}) e")
def _(spark, sf_dir):
    found = feed(spark, sf_dir)
    return found.select("seq", fold.posting_hash(found).alias("payload_hash"))


@query("payload_version", f"SELECT seq, epoch_us(greatest(date_modified, event_modified_at, CASE WHEN seen IS NOT NULL THEN version END)) AS version FROM ({_LEAVES}) e")
def _(spark, sf_dir):
    return feed(spark, sf_dir).select("seq", us(fold.payload_version(F.col("date_modified"), F.col("event_modified_at"), F.col("raw_payload"))).alias("version"))


@query("inactive_payload", f"SELECT seq, CAST(json_object('last_nav_status', 'INACTIVE', 'nav_inactive_event', json_object('external_id', external_id, 'observed_at', '{X.NOW}', 'source_event_at', {_UTC('version')}, 'source_event_at_reliable', version IS NOT NULL), 'title', title) AS VARCHAR) AS payload FROM ({X.EVENTS}) e WHERE status = 'INACTIVE'")
def _(spark, sf_dir):
    """Payloads with a note of their own, blanks at the end and nothing else in them come out whole."""
    off = X.view(spark, sf_dir, X.EVENTS).filter(F.col("status") == "INACTIVE")
    plain = F.concat(F.to_json(F.struct("title"), {"ignoreNullFields": "false"}), F.lit(" "))
    noted = F.to_json(F.struct(F.lit("old").alias("nav_inactive_event"), F.col("title")), {"ignoreNullFields": "false"})
    marked = events.inactive_event(off.withColumn("raw_payload", F.when(F.col("event_id") % 2 == 0, noted).otherwise(plain)), X.NOW)
    return marked.select("seq", F.col("raw_payload").alias("payload")).select("seq", sorted_keys(F.col("payload")).alias("payload"))


def sorted_keys(payload):
    """JSON text with sorted keys; null for what can't be read."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else merge.compact_json(json.loads(t)))

    return run(payload)

"""Registered queries of the posting feed: events, merge, reconciliation, serving and health, with their DuckDB forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


from fjordlake.operators import events, merge, reconcile, serving
from fjordlake.plans import fixtures as X

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


_NOW, _TODAY = f"TIMESTAMP '{X.NOW}'", f"DATE '{X.NOW[:10]}'"
us = F.unix_micros


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def now() -> Column:
    return at(X.NOW)


def today() -> Column:
    return F.lit(X.NOW[:10]).cast("date")


def cut() -> Column:
    return at("2024-01-20 00:00:00")

# Feed items with their details, as the reference's pages hold them, made of the events table.
_ITEMS = f"""SELECT seq, event_id, CASE WHEN event_id % 50 = 0 THEN '  ' ELSE external_id END AS id, title, url, status, company_name, location, strftime(version, '%Y-%m-%dT%H:%M:%S') AS version_text, version, detail FROM ({X.EVENTS}) e"""


def feed(spark, sf_dir) -> DataFrame:
    return X.view(spark, sf_dir, X.EVENTS)


def items_of(found: DataFrame) -> DataFrame:
    text = F.date_format("version", "yyyy-MM-dd'T'HH:mm:ss")
    entry = F.struct(F.concat(F.lit(" "), "status").alias("status"), F.lit("Entry title").alias("title"), F.col("company_name").alias("businessName"), F.col("location").alias("municipal"), F.when(F.col("event_id") % 8 == 0, "not a time").otherwise(text).alias("sistEndret"))
    content = F.struct(text.alias("published"), F.lit("").alias("expires"), F.lit(None).cast("string").alias("updated"), F.when(F.col("event_id") % 4 == 0, "soon").otherwise("2024-03-01T00:00:00").alias("applicationDue"))
    detail = F.when(F.col("detail").isNotNull(), F.struct(F.col("external_id").alias("uuid"), F.lit(None).cast("string").alias("status"), text.alias("sistEndret"), content.alias("ad_content"), F.lit(None).cast(events.CONTENT).alias("json")))
    return found.select("seq", "event_id", F.when(F.col("event_id") % 50 == 0, "  ").otherwise(F.col("external_id")).alias("id"), "url", "title", text.alias("date_modified"), entry.alias("_feed_entry"), detail.alias("detail"))


@query(
    "normalize_events",
    f"""SELECT seq, external_id, coalesce(title, 'Entry title') AS title, company_name, location, status, concat('https://feed.example', url) AS url, epoch_us(date_trunc('second', version)) AS version,
epoch_us(CASE WHEN detail IS NOT NULL THEN date_trunc('second', version) END) AS published_at, CASE WHEN detail IS NOT NULL AND event_id % 4 <> 0 THEN DATE '2024-03-01' END AS application_due,
concat(external_id, ':', status, ':', coalesce(strftime(date_trunc('second', version), '%Y-%m-%dT%H:%M:%S.000000Z'), 'unversioned')) AS source_event_id
FROM ({X.EVENTS}) e WHERE event_id % 50 <> 0 OR detail IS NOT NULL""",
)
def _(spark, sf_dir):
    found = events.normalize_events(items_of(feed(spark, sf_dir)), "https://feed.example")
    return found.select("seq", "external_id", "title", "company_name", "location", "status", "url", us("version").alias("version"), us("published_at").alias("published_at"), "application_due", "source_event_id")


_ODD_STATUS = "CASE WHEN event_id % 19 = 0 THEN 'active' WHEN event_id % 23 = 0 THEN concat(' ', status, ' ') ELSE status END"


@query("classify_events", f"SELECT CASE trim({_ODD_STATUS}) WHEN 'ACTIVE' THEN 'active' WHEN 'INACTIVE' THEN 'inactive' ELSE 'skipped' END AS class, count(*) AS n FROM ({X.EVENTS}) e GROUP BY 1")
def _(spark, sf_dir):
    return events.classify_events(feed(spark, sf_dir).withColumn("status", F.expr(_ODD_STATUS)))


@query("inactive_event", f"SELECT seq, 'INACTIVE' AS status, concat(external_id, ':INACTIVE:', coalesce(strftime(version, '%Y-%m-%dT%H:%M:%S.%fZ'), 'unversioned')) AS source_event_id, version IS NOT NULL AS reliable FROM ({X.EVENTS}) e WHERE status = 'INACTIVE'")
def _(spark, sf_dir):
    found = events.inactive_event(feed(spark, sf_dir).filter(F.col("status") == "INACTIVE"), X.NOW)
    return found.select("seq", "status", "source_event_id", F.col("inactive_note.source_event_at_reliable").alias("reliable"))


@query("event_version", f"SELECT seq, epoch_us(greatest(version, published_at, CAST(application_due AS TIMESTAMP))) AS version FROM ({X.EVENTS}) e")
def _(spark, sf_dir):
    text = lambda c: F.when(F.col("event_id") % 3 == 0, F.concat(F.col(c).cast("string"), F.lit(" "))).otherwise(F.col(c).cast("string"))
    return feed(spark, sf_dir).select("seq", us(events.event_version(text("version"), text("published_at"), text("application_due"), F.lit("no time"), F.lit(""))).alias("version"))


@query("attach_details", f"""WITH a AS (SELECT *, row_number() OVER (ORDER BY seq) AS nth FROM ({X.EVENTS}) e WHERE status = 'ACTIVE')
SELECT seq, external_id, CASE WHEN nth > 500 THEN 'detail budget exhausted' WHEN CAST(substr(external_id, 2) AS BIGINT) % 3 = 0 THEN 'detail missing' ELSE 'attached' END AS outcome FROM a""")
def _(spark, sf_dir):
    found = feed(spark, sf_dir)
    details = found.select("external_id").distinct().filter(F.substring("external_id", 2, 20).cast("long") % 3 != 0).withColumn("detail", F.lit("detail"))
    attached, queued = events.attach_details(found, details, 500)
    return attached.filter(F.col("found").isNotNull()).select("seq", "external_id", F.lit("attached").alias("outcome")).unionByName(queued.select("seq", "external_id", F.col("reason").alias("outcome")))


# The merge's closed form: a running maximum gates events, scalars are the last known of accepted ones.
_RANK = "coalesce(version, TIMESTAMP '0001-01-01 00:00:00')"
_KEY = "(PARTITION BY external_id ORDER BY seq"
_UTC = lambda c: f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ')"
_HASHED = lambda event_at: "md5(CAST(json_object(" + ", ".join(f"'{c}', {_UTC(c) if c.endswith('_at') else 'CAST(' + c + ' AS VARCHAR)'}" for c in X.SCALARS) + f", 'event_at', {_UTC(event_at)}) AS VARCHAR))"
_APPLIED = f"""WITH e AS ({X.EVENTS}), g AS (SELECT *, max({_RANK}) OVER {_KEY} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM e),
a AS (SELECT *, top IS NULL OR {_RANK} >= top AS accepted, top IS NULL OR {_RANK} > top AS advances FROM g),
m AS (SELECT external_id, seq, top, accepted, advances, source_event_id AS own_id, nullif(max({_RANK}) OVER {_KEY}), TIMESTAMP '0001-01-01 00:00:00') AS source_event_version,
{", ".join(f"last_value(CASE WHEN accepted THEN {c} END IGNORE NULLS) OVER {_KEY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in X.SCALARS)} FROM a),
h AS (SELECT *, {_HASHED('source_event_version')} AS payload_hash FROM m),
x AS (SELECT *, CASE WHEN top IS NULL THEN 'insert' WHEN NOT accepted THEN 'stale_ignored' WHEN lag(payload_hash) OVER {_KEY}) = payload_hash THEN 'no_op' ELSE 'merge' END AS action FROM h),
r AS (SELECT * EXCLUDE (top, accepted, advances, own_id), coalesce(last_value(CASE WHEN action IN ('insert', 'merge') AND advances THEN own_id END IGNORE NULLS) OVER {_KEY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
first_value(CASE WHEN action IN ('insert', 'merge') AND NOT advances THEN own_id END IGNORE NULLS) OVER {_KEY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS source_event_id FROM x)
"""
_LAST = _APPLIED + ", s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY seq DESC) AS nth FROM r) t WHERE nth = 1) "


@query("merge_events", _LAST + "SELECT external_id, epoch_us(source_event_version) AS source_event_version, source_event_id, payload_hash, title, company_name, location, status, application_due FROM s")
def _(spark, sf_dir):
    """In two batches: the first half of the feed, then the second on the state it left."""
    found = feed(spark, sf_dir)
    half = found.agg((F.max("seq") / 2).alias("half"))
    first = found.join(F.broadcast(half), F.col("seq") <= F.col("half"), "left_semi")
    second = found.join(F.broadcast(half), F.col("seq") > F.col("half"), "left_semi")
    state, _ = merge.merge_events(first)
    state, _ = merge.merge_events(second, state)
    return state.select("external_id", us("source_event_version").alias("source_event_version"), "source_event_id", "payload_hash", "title", "company_name", "location", "status", "application_due")


@query("merge_actions", _APPLIED + "SELECT external_id, seq, action, payload_hash, source_event_id FROM r")
def _(spark, sf_dir):
    return merge.applied(feed(spark, sf_dir)).select("external_id", "seq", "action", "payload_hash", "source_event_id")


@query("merge_counts", _APPLIED + "SELECT action, count(*) AS n FROM r GROUP BY action")
def _(spark, sf_dir):
    return merge.merge_counts(merge.merge_events(feed(spark, sf_dir))[1])


@query("add_counters", _APPLIED + "SELECT 'r1' AS run_id, action AS metric, 2 * count(*) AS n FROM r GROUP BY action")
def _(spark, sf_dir):
    actions = merge.merge_events(feed(spark, sf_dir))[1]
    counters = merge.merge_counts(actions).select(F.lit("r1").alias("run_id"), F.col("action").alias("metric"), "n")
    return merge.add_counters(counters, actions, "r1")


@query("event_audit", _APPLIED + ", l AS (SELECT *, lag(payload_hash) OVER (PARTITION BY external_id ORDER BY seq) AS before FROM r) SELECT external_id, seq, action AS change_kind, CASE WHEN action = 'merge' THEN before END AS previous_hash, payload_hash AS new_hash FROM l WHERE action IN ('insert', 'merge')")
def _(spark, sf_dir):
    audit = merge.event_audit(merge.applied(feed(spark, sf_dir)))
    return audit.select("external_id", "seq", "change_kind", F.col("previous_values.payload_hash").alias("previous_hash"), F.col("new_values.payload_hash").alias("new_hash"))


@query("payload_hash", f"SELECT seq, {_HASHED('version')} AS payload_hash FROM ({X.EVENTS}) e")
def _(spark, sf_dir):
    return feed(spark, sf_dir).select("seq", merge.payload_hash(X.SCALARS, F.col("version")).alias("payload_hash"))


_LEAVES_LAST = ", ".join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY external_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS {c}" for c in ("title", "location", "company_name", "detail"))
# a merge patch leaves out what is null, at every depth
_COMPACT = lambda x: f"CAST(json_merge_patch(CAST('{{}}' AS JSON), {x}) AS VARCHAR)"


@query("rich_merge_payloads", f"SELECT DISTINCT external_id, {_COMPACT("json_object('detail', json_object('company_name', company_name, 'detail', detail), 'location', location, 'title', title)")} AS raw_payload FROM (SELECT external_id, {_LEAVES_LAST} FROM ({X.EVENTS}) e) x")
def _(spark, sf_dir):
    found = feed(spark, sf_dir)
    payload = F.to_json(F.struct("title", "location", F.struct("company_name", "detail").alias("detail")))
    return merge.merged_payloads(found.select("external_id", "seq", F.lit("merge").alias("action"), payload.alias("raw_payload")))


@query("canonical_payload", f"SELECT seq, {_COMPACT("json_object('a', json_object('location', location), 'title', title)")} AS payload FROM ({X.EVENTS}) e")
def _(spark, sf_dir):
    payload = F.to_json(F.struct("title", F.col("seq").alias("_etag"), F.struct("location", F.lit("x").alias("imported_at")).alias("a")))
    return feed(spark, sf_dir).select("seq", merge.canonical_json(payload).alias("payload"))


@query("upsert", f"SELECT external_id, CASE WHEN nth % 3 = 0 THEN 'new' ELSE status END AS status FROM (SELECT *, CAST(substr(external_id, 2) AS BIGINT) AS nth FROM ({X.POSTINGS}) p) x UNION ALL SELECT concat('n', external_id), 'new' FROM ({X.POSTINGS}) p WHERE CAST(substr(external_id, 2) AS BIGINT) % 3 = 0")
def _(spark, sf_dir):
    state = X.view(spark, sf_dir, X.POSTINGS).select("external_id", "status")
    some = state.filter(F.substring("external_id", 2, 20).cast("long") % 3 == 0).withColumn("status", F.lit("new"))
    return merge.upsert(state, some.unionByName(some.withColumn("external_id", F.concat(F.lit("n"), "external_id"))), ["external_id"])


_DUE = "status = 'pending' AND next_attempt_at <= TIMESTAMP '1997-01-01 00:00:00'"


@query("due_details", f"SELECT external_id FROM ({X.RETRY}) r WHERE {_DUE} ORDER BY next_attempt_at, external_id LIMIT 50")
def _(spark, sf_dir):
    return events.due_details(X.view(spark, sf_dir, X.RETRY), F.lit("1997-01-01").cast("timestamp"), 50, X.view(spark, sf_dir, X.POSTINGS))


@query("due_details_fallback", f"SELECT external_id FROM ({X.POSTINGS}) p WHERE status = 'ACTIVE' AND detail IS NULL ORDER BY external_id LIMIT 50")
def _(spark, sf_dir):
    postings = X.view(spark, sf_dir, X.POSTINGS).filter((F.col("status") == "ACTIVE") & F.col("detail").isNull())
    return events.due_details(X.view(spark, sf_dir, X.RETRY), F.lit("1900-01-01").cast("timestamp"), 50, postings)


@query("fail_details", f"""SELECT external_id, CASE WHEN hit AND attempt_count + 1 >= 10 THEN 'abandoned' WHEN hit THEN 'pending' ELSE status END AS status, CASE WHEN hit THEN attempt_count + 1 ELSE attempt_count END AS attempt_count,
epoch_us(CASE WHEN hit THEN {_NOW} + INTERVAL 1 MINUTE * CAST(least(pow(2, least(attempt_count + 1, 8)), 360) AS INT) ELSE next_attempt_at END) AS next_attempt_at FROM (SELECT *, CAST(substr(external_id, 2) AS BIGINT) % 2 = 0 AS hit FROM ({X.RETRY}) r) x""")
def _(spark, sf_dir):
    queue = X.view(spark, sf_dir, X.RETRY)
    failures = queue.filter(F.substring("external_id", 2, 20).cast("long") % 2 == 0).select("external_id", F.lit("timeout").alias("message"))
    return events.fail_details(queue, failures, now()).select("external_id", "status", "attempt_count", us("next_attempt_at").alias("next_attempt_at"))


@query("queue_details", f"""WITH q AS ({X.RETRY}), e AS (SELECT concat('o', substr(external_id, 2)) AS external_id, max(CASE WHEN status = 'INACTIVE' THEN 1 ELSE 0 END) AS done, arg_max(concat('missing at ', CAST(seq AS VARCHAR)), seq) FILTER (WHERE status = 'ACTIVE') AS reason FROM ({X.EVENTS}) v GROUP BY 1)
SELECT coalesce(q.external_id, e.external_id) AS external_id, CASE WHEN e.done = 1 THEN 'resolved' WHEN e.reason IS NOT NULL THEN 'pending' ELSE q.status END AS status, coalesce(q.attempt_count, 0) AS attempt_count, e.reason AS last_error FROM q FULL JOIN e ON q.external_id = e.external_id WHERE q.external_id IS NOT NULL OR e.reason IS NOT NULL""")
def _(spark, sf_dir):
    """The whole feed as one page: ids repeat, the last reason counts and resolved wins."""
    found = feed(spark, sf_dir).withColumn("external_id", F.concat(F.lit("o"), F.substring("external_id", 2, 20)))
    queued = found.filter(F.col("status") == "ACTIVE").select("external_id", "seq", F.concat(F.lit("missing at "), F.col("seq").cast("string")).alias("reason"))
    return events.queue_details(X.view(spark, sf_dir, X.RETRY), queued, found.filter(F.col("status") == "INACTIVE"), now()).select("external_id", "status", "attempt_count", "last_error")


_CUT = "TIMESTAMP '2024-01-20 00:00:00'"


@query("reconcile_window", f"SELECT count(*) AS n, min(seq) AS least, max(seq) AS most FROM ({X.EVENTS}) e WHERE version >= {_CUT} - INTERVAL 6 MONTH AND version <= {_CUT}")
def _(spark, sf_dir):
    return reconcile.reconcile_window(feed(spark, sf_dir), cut()).agg(F.count("*").alias("n"), F.min("seq").alias("least"), F.max("seq").alias("most"))


_LATE = f"SELECT * FROM ({X.EVENTS}) e WHERE 3 * seq > 2 * (SELECT max(seq) FROM ({X.EVENTS}) m)"
_FINAL = lambda rows: f"SELECT 'r1' AS run_id, external_id, status AS final_status, version, source_event_id FROM (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY {_RANK} DESC, seq DESC) AS nth FROM ({rows}) t) x WHERE nth = 1"
_SNAPSHOT = _FINAL(_LATE)


def late(found: DataFrame, parts: int, of: int, how: str = "left_semi") -> DataFrame:
    """Events behind that share of the feed; with left_anti all others."""
    end = found.agg((F.max("seq") * parts).alias("end"))
    return found.join(F.broadcast(end), F.col("seq") * of > F.col("end"), how)


def snapshot(spark, sf_dir) -> DataFrame:
    """Of the last third of the feed, so that older postings are absent."""
    return reconcile.reconcile_snapshot(late(feed(spark, sf_dir), 2, 3), "r1")


@query("reconcile_snapshot", f"SELECT run_id, external_id, final_status, epoch_us(version) AS source_event_version, source_event_id FROM ({_FINAL(X.EVENTS)}) s")
def _(spark, sf_dir):
    found = reconcile.reconcile_snapshot(feed(spark, sf_dir), "r1")
    return found.select("run_id", "external_id", "final_status", us("source_event_version").alias("source_event_version"), "source_event_id")


@query("reconcile_snapshot_whole", f"SELECT 'r1' AS run_id, external_id, status AS final_status, epoch_us(version) AS source_event_version, source_event_id FROM (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY {_RANK} DESC, seq DESC) AS nth FROM ({X.EVENTS}) t) x WHERE nth = 1")
def _(spark, sf_dir):
    found = reconcile.reconcile_snapshot(feed(spark, sf_dir), "r1")
    return found.select("run_id", "external_id", "final_status", us("source_event_version").alias("source_event_version"), "source_event_id")


@query("mark_present", f"WITH f AS ({_APPLIED} SELECT external_id, count(*) AS n FROM r WHERE action IN ('insert', 'merge') AND 2 * seq > (SELECT max(seq) FROM r) GROUP BY external_id) SELECT p.external_id, CASE WHEN f.n IS NOT NULL THEN 'r1' END AS last_reconciled_run_id, CASE WHEN f.n IS NOT NULL THEN 'present' END AS reconciliation_status FROM ({X.POSTINGS}) p LEFT JOIN f ON p.external_id = f.external_id")
def _(spark, sf_dir):
    actions = late(merge.merge_events(feed(spark, sf_dir))[1], 1, 2)
    return merge.mark_present(X.view(spark, sf_dir, X.POSTINGS), actions, "r1", now()).select("external_id", "last_reconciled_run_id", "reconciliation_status")


_OPEN = f"SELECT p.* FROM ({X.POSTINGS}) p WHERE status = 'ACTIVE' AND external_id NOT IN (SELECT external_id FROM ({_SNAPSHOT}) s WHERE final_status = 'ACTIVE')"


def postings(spark, sf_dir) -> DataFrame:
    return X.view(spark, sf_dir, X.POSTINGS).withColumn("payload_hash", merge.payload_hash(X.SCALARS, F.col("source_event_version")))


@query("closeout", f"SELECT external_id, 'closeout' AS change_kind, epoch_us(final_version) AS final_version FROM (SELECT *, coalesce(source_event_version, published_at) AS final_version FROM ({_OPEN}) o) x WHERE final_version <= {_CUT} ORDER BY source_event_version IS NULL, external_id LIMIT 250")
def _(spark, sf_dir):
    state, audit = reconcile.closeout(postings(spark, sf_dir), snapshot(spark, sf_dir), cut(), 1000, F.col("published_at"))
    return audit.select("external_id", "change_kind", us("final_version").alias("final_version"))


@query("closeout_state", f"WITH c AS (SELECT external_id FROM (SELECT *, coalesce(source_event_version, published_at) AS v FROM ({_OPEN}) o) x WHERE v <= {_CUT} ORDER BY source_event_version IS NULL, external_id LIMIT 20) SELECT p.external_id, CASE WHEN c.external_id IS NULL THEN p.status ELSE 'INACTIVE' END AS status, CASE WHEN c.external_id IS NOT NULL THEN 'absent' END AS reconciliation_status FROM ({X.POSTINGS}) p LEFT JOIN c ON p.external_id = c.external_id")
def _(spark, sf_dir):
    state, _ = reconcile.closeout(postings(spark, sf_dir), snapshot(spark, sf_dir), cut(), 20, F.col("published_at"))
    return state.select("external_id", "status", "reconciliation_status")


@query("closeout_after_mark_present", f"""WITH f AS ({_APPLIED} SELECT DISTINCT external_id FROM r WHERE action IN ('insert', 'merge') AND 2 * seq > (SELECT max(seq) FROM r)),
c AS (SELECT external_id FROM (SELECT *, coalesce(source_event_version, published_at) AS v FROM ({_OPEN}) o) x WHERE v <= {_CUT} ORDER BY source_event_version IS NULL, external_id LIMIT 20)
SELECT p.external_id, CASE WHEN c.external_id IS NULL THEN p.status ELSE 'INACTIVE' END AS status, CASE WHEN c.external_id IS NOT NULL THEN 'absent' WHEN f.external_id IS NOT NULL THEN 'present' END AS reconciliation_status, CASE WHEN f.external_id IS NOT NULL THEN 'r1' END AS run_id
FROM ({X.POSTINGS}) p LEFT JOIN c ON p.external_id = c.external_id LEFT JOIN f ON p.external_id = f.external_id""")
def _(spark, sf_dir):
    """A run's marks, then its close-out of what the snapshot lacks."""
    actions = late(merge.merge_events(feed(spark, sf_dir))[1], 1, 2)
    state = merge.mark_present(postings(spark, sf_dir), actions, "r1", now())
    closed, _ = reconcile.closeout(state, snapshot(spark, sf_dir), cut(), 20, F.col("published_at"))
    return closed.select("external_id", "status", "reconciliation_status", F.col("last_reconciled_run_id").alias("run_id"))


@query("backfill_versions", f"SELECT external_id, epoch_us(published_at) AS version FROM ({_OPEN}) o WHERE source_event_version IS NULL AND published_at IS NOT NULL ORDER BY external_id LIMIT 100")
def _(spark, sf_dir):
    return reconcile.backfill_versions(postings(spark, sf_dir), snapshot(spark, sf_dir), F.col("published_at")).select("external_id", us("version").alias("version"))


@query("closeout_remaining", f"SELECT CAST(coalesce(max(CASE WHEN v IS NULL OR v <= {_CUT} THEN 1 ELSE 0 END), 0) AS INT) AS remaining, count(*) FILTER (WHERE v IS NULL) AS unversioned FROM (SELECT coalesce(source_event_version, published_at) AS v FROM ({_OPEN}) o) x")
def _(spark, sf_dir):
    return reconcile.closeout_remaining(postings(spark, sf_dir), snapshot(spark, sf_dir), cut(), F.col("published_at"))


_VALID = f"(status = 'ACTIVE' AND published_at IS NOT NULL AND (application_due IS NULL OR application_due >= {_TODAY}))"
_STALE = f"(status = 'ACTIVE' AND (published_at IS NULL OR application_due < {_TODAY} OR event_modified_at < {_NOW} - INTERVAL 90 DAY))"


@query("valid_jobs", f"SELECT external_id, title, epoch_us(published_at) AS published_at FROM ({X.POSTINGS}) p WHERE {_VALID}")
def _(spark, sf_dir):
    return serving.valid_jobs(postings(spark, sf_dir), today()).select("external_id", "title", us("published_at").alias("published_at"))


@query("stale_jobs", f"SELECT external_id, title FROM ({X.POSTINGS}) p WHERE {_STALE}")
def _(spark, sf_dir):
    return serving.stale_jobs(postings(spark, sf_dir), today(), now()).select("external_id", "title")


@query("job_stats", f"SELECT count(*) FILTER (WHERE {_VALID}) AS valid, count(*) FILTER (WHERE {_STALE}) AS stale, count(*) FILTER (WHERE status = 'INACTIVE') AS inactive FROM ({X.POSTINGS}) p")
def _(spark, sf_dir):
    return serving.job_stats(postings(spark, sf_dir), today(), now())


@query("list_since", f"SELECT external_id, epoch_us(changed_at) AS changed_at FROM (SELECT *, greatest(updated_at, event_modified_at) AS changed_at FROM ({X.POSTINGS}) p) x WHERE changed_at IS NOT NULL AND (changed_at, external_id) > (TIMESTAMP '2024-01-10 00:00:00', 'j5') ORDER BY changed_at, external_id LIMIT 200")
def _(spark, sf_dir):
    found = serving.list_since(postings(spark, sf_dir), F.lit("2024-01-10 00:00:00").cast("timestamp"), "j5", 200)
    return found.select("external_id", us("changed_at").alias("changed_at"))


_IDS = [f" j{n} " for n in range(10, 900, 7)] + ["", "j10"]


@query("list_by_ids", f"SELECT external_id, status FROM ({X.POSTINGS}) p WHERE external_id IN ({', '.join(repr(i.strip()) for i in _IDS)})")
def _(spark, sf_dir):
    return serving.list_by_ids(postings(spark, sf_dir), _IDS).select("external_id", "status")


@query("source_health", f"""SELECT count(*) AS total, count(*) FILTER (WHERE status = 'ACTIVE') AS active, count(*) FILTER (WHERE status = 'INACTIVE') AS inactive, count(*) FILTER (WHERE status = 'ACTIVE' AND detail IS NOT NULL) AS active_with_detail, count(*) FILTER (WHERE status = 'ACTIVE' AND detail IS NULL) AS active_missing_detail,
count(*) FILTER (WHERE status = 'ACTIVE' AND expires_at < {_NOW}) AS active_expired, count(*) FILTER (WHERE status = 'ACTIVE' AND expires_at IS NULL) AS active_without_expiry, CAST(epoch({_NOW}) AS BIGINT) - CAST(floor(epoch(max(source_event_version))) AS BIGINT) AS source_event_lag_seconds,
(SELECT count(*) FROM (SELECT external_id FROM ({X.POSTINGS}) d GROUP BY external_id HAVING count(*) > 1) dd) AS duplicate_external_ids,
(SELECT count(*) FROM ({X.RETRY}) r WHERE status = 'pending') AS retry_pending, (SELECT count(*) FROM ({X.RETRY}) r WHERE status = 'abandoned') AS retry_abandoned,
(SELECT id FROM ({X.RUNS}) r WHERE mode = 'sync' ORDER BY started_at DESC, id DESC LIMIT 1) AS sync_id, (SELECT id FROM ({X.RUNS}) r WHERE mode = 'reconcile' ORDER BY started_at DESC, id DESC LIMIT 1) AS reconcile_id FROM ({X.POSTINGS}) p""")
def _(spark, sf_dir):
    return health(spark, sf_dir).select("total", "active", "inactive", "active_with_detail", "active_missing_detail", "active_expired", "active_without_expiry", "source_event_lag_seconds", "duplicate_external_ids", "retry_pending", "retry_abandoned", F.col("latest_sync.id").alias("sync_id"), F.col("latest_reconcile.id").alias("reconcile_id"))


def health(spark, sf_dir) -> DataFrame:
    return serving.source_health(postings(spark, sf_dir), X.view(spark, sf_dir, X.RETRY), X.view(spark, sf_dir, X.RUNS), now())


@query("health_snapshot", f"SELECT count(*) AS total, CAST(1200 AS BIGINT) AS age_seconds, true AS stale FROM ({X.POSTINGS}) p")
def _(spark, sf_dir):
    return serving.health_snapshot(health(spark, sf_dir), now() - F.expr("INTERVAL 20 MINUTES"), now()).select("total", "age_seconds", "stale")


_BY_TIME = "ORDER BY started_at DESC, id DESC LIMIT 1"


@query("sync_status", f"SELECT (SELECT id FROM ({X.RUNS}) r {_BY_TIME}) AS latest, (SELECT id FROM ({X.RUNS}) r WHERE status = 'failed' {_BY_TIME}) AS latest_failure, (SELECT error FROM ({X.RUNS}) r WHERE status = 'failed' {_BY_TIME}) AS error, (SELECT id FROM ({X.RUNS}) r WHERE status <> 'failed' {_BY_TIME}) AS latest_success")
def _(spark, sf_dir):
    return serving.sync_status(X.view(spark, sf_dir, X.RUNS)).select(F.col("latest.id").alias("latest"), F.col("latest_failure.id").alias("latest_failure"), F.col("latest_failure.error").alias("error"), F.col("latest_success.id").alias("latest_success"))


@query("status_report", f"""SELECT count(*) AS total, count(*) FILTER (WHERE updated_at >= {_NOW} - INTERVAL 24 HOUR) AS updated_last_day, count(*) FILTER (WHERE status = 'ACTIVE') AS active, count(*) FILTER (WHERE {_VALID}) AS valid, count(*) FILTER (WHERE {_STALE}) AS stale, epoch_us(max(published_at)) AS newest_published,
(SELECT status FROM ({X.RUNS}) r {_BY_TIME}) <> 'failed' AND count(*) FILTER (WHERE {_VALID}) > 0 AS ok FROM ({X.POSTINGS}) p""")
def _(spark, sf_dir):
    report = serving.status_report(postings(spark, sf_dir), X.view(spark, sf_dir, X.RUNS), now(), today())
    return report.select("total", "updated_last_day", "active", "valid", "stale", us("newest_published").alias("newest_published"), "ok")


@query("recent_runs", f"SELECT id, status FROM ({X.RUNS}) r ORDER BY started_at DESC, id DESC LIMIT 10")
def _(spark, sf_dir):
    return serving.recent_runs(X.view(spark, sf_dir, X.RUNS)).select("id", "status")


@query("published_since", f"SELECT count(*) AS n FROM ({X.POSTINGS}) p WHERE published_at >= {_NOW} - INTERVAL 24 DAY")
def _(spark, sf_dir):
    return serving.published_since(postings(spark, sf_dir), now() - F.expr("INTERVAL 24 DAYS"))


@query("job_health", f"""SELECT j.job, r.id, r.status, substr(r.error, 1, 8) AS message FROM (SELECT DISTINCT mode AS job FROM ({X.RUNS}) x UNION ALL SELECT 'idle') j LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY started_at DESC, id DESC) AS nth FROM ({X.RUNS}) y) z WHERE nth = 1) r ON r.mode = j.job""")
def _(spark, sf_dir):
    runs = X.view(spark, sf_dir, X.RUNS)
    jobs = runs.select(F.col("mode").alias("job")).distinct().unionByName(spark.createDataFrame([("idle",)], "job string"))
    return serving.job_health(jobs, runs, 8).select("job", "id", "status", "message")

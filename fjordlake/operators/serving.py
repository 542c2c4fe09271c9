"""Reads of the posting table, and health and run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordlake.functions import columns as L
from fjordlake.operators.merge import SCALARS, payload_hash


def _is_valid(today: Column) -> Column:
    due = F.col("application_due")
    return (F.col("status") == "ACTIVE") & F.col("published_at").isNotNull() & (due.isNull() | (due >= today))


def _is_stale(today: Column, now: Column) -> Column:
    late = F.col("published_at").isNull() | (F.col("application_due") < today) | (F.col("event_modified_at") < now - F.expr("INTERVAL 90 DAYS"))
    return (F.col("status") == "ACTIVE") & F.coalesce(late, F.lit(False))


def valid_jobs(state: DataFrame, today: Column) -> DataFrame:
    return state.filter(_is_valid(today)).orderBy(F.desc("published_at"), "external_id")


def stale_jobs(state: DataFrame, today: Column, now: Column) -> DataFrame:
    """Not the complement of valid_jobs: an open posting without an event for 90 days is in both."""
    return state.filter(_is_stale(today, now))


def job_stats(state: DataFrame, today: Column, now: Column) -> DataFrame:
    return state.agg(F.count_if(_is_valid(today)).alias("valid"), F.count_if(_is_stale(today, now)).alias("stale"), F.count_if(F.col("status") == "INACTIVE").alias("inactive"))


def changed_at(*columns: str) -> Column:
    return F.greatest(*(F.col(c) for c in columns))


#: Columns any of which may say when a posting changed.
CLOCKS = ("updated_at", "date_modified", "event_modified_at", "imported_at")


def list_since(state: DataFrame, since: Column, after_id: str = "", limit: int | None = 500, clocks: tuple[str, ...] = CLOCKS) -> DataFrame:
    """The next page behind the cursor (since, after_id), by the latest of those clocks that state has.

    A version that is missing is the latest event time, and a hash that is missing is computed. The plain comparison repeats
    what the tuple implies, for pushdown."""
    times = [c for c in ("event_modified_at", "date_modified") if c in state.columns]
    version = F.coalesce("source_event_version", changed_at(*times)) if len(times) > 1 else F.coalesce("source_event_version", *times)
    rows = state.withColumn("source_event_version", version)
    stored = [F.col("payload_hash")] if "payload_hash" in state.columns else []
    rows = rows.withColumn("payload_hash", F.coalesce(*stored, payload_hash(SCALARS, F.col("source_event_version"))))
    own = [c for c in clocks if c in state.columns]
    rows = rows.withColumn("changed_at", changed_at(*own) if len(own) > 1 else F.col(own[0]))
    past = F.struct(F.col("changed_at"), F.col("external_id")) > F.struct(since.alias("changed_at"), F.lit(after_id).alias("external_id"))
    return rows.filter((F.col("changed_at") >= since) & past).orderBy("changed_at", "external_id").limit(L.clamp(limit, 500, 1000))


def list_by_ids(state: DataFrame, ids: list[str]) -> DataFrame:
    wanted = sorted({i.strip() for i in ids if i and i.strip()})
    if len(wanted) > 500:
        raise ValueError("at most 500 ids")
    return state.filter(F.col("external_id").isin(wanted)).orderBy("external_id")


def has_detail(state: DataFrame) -> Column:
    """Whether a posting has details: its payload has their key, even with null; without payloads, the column `detail` is filled."""
    return L.has_path(F.col("raw_payload"), "$.nav_detail") if "raw_payload" in state.columns else F.col("detail").isNotNull()


def missing_detail(state: DataFrame) -> DataFrame:
    """Open postings without details, for `events.due_details` to fall back on."""
    return state.filter((F.col("status") == "ACTIVE") & ~has_detail(state))


def source_health(state: DataFrame, queue: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    """One row: the inventory in one pass, duplicates, the retry queue and the latest sync and reconcile runs."""
    active, detailed = F.col("status") == "ACTIVE", has_detail(state)
    inventory = state.agg(
        F.count("*").alias("total"), F.count_if(active).alias("active"), F.count_if(F.col("status") == "INACTIVE").alias("inactive"),
        F.count_if(active & detailed).alias("active_with_detail"), F.count_if(active & ~detailed).alias("active_missing_detail"),
        F.count_if(active & (F.col("expires_at") < now)).alias("active_expired"), F.count_if(active & F.col("expires_at").isNull()).alias("active_without_expiry"),
        F.max("source_event_version").alias("latest_source_event_at"),
    )
    duplicates = state.groupBy("external_id").count().agg(F.count_if(F.col("count") > 1).alias("duplicate_external_ids"))
    retries = queue.agg(F.count_if(F.col("status") == "pending").alias("retry_pending"), F.count_if(F.col("status") == "abandoned").alias("retry_abandoned"))
    newest = lambda mode: F.max_by(F.struct("id", "status", "started_at"), F.when(F.col("mode") == mode, F.struct("started_at", "id"))).alias(f"latest_{mode}")
    latest = runs.agg(newest("sync"), newest("reconcile"))
    one = inventory.crossJoin(duplicates).crossJoin(retries).crossJoin(latest)  # four frames of one row
    return one.withColumn("source_event_lag_seconds", L.seconds_between(now, F.col("latest_source_event_at")))


def health_snapshot(health: DataFrame, computed_at: Column, now: Column, fresh_minutes: int = 15) -> DataFrame:
    age = L.seconds_between(now, computed_at)
    return health.select("*", computed_at.alias("computed_at"), age.alias("age_seconds"), (age > 60 * fresh_minutes).alias("stale"))


def sync_status(runs: DataFrame) -> DataFrame:
    """One row: the latest run, failure and success."""
    order = F.struct("started_at", "id")
    own = F.struct("id", "started_at", "status", "error")
    failed = F.col("status") == "failed"
    return runs.agg(F.max_by(own, order).alias("latest"), F.max_by(own, F.when(failed, order)).alias("latest_failure"), F.max_by(own, F.when(~failed, order)).alias("latest_success"))


def status_report(state: DataFrame, runs: DataFrame, now: Column, today: Column) -> DataFrame:
    """One row with counts, newest times, the latest run and whether all is well."""
    counts = state.agg(
        F.count("*").alias("total"), F.count_if(F.col("updated_at") >= now - F.expr("INTERVAL 24 HOURS")).alias("updated_last_day"), F.count_if(F.col("status") == "ACTIVE").alias("active"),
        F.count_if(_is_valid(today)).alias("valid"), F.count_if(_is_stale(today, now)).alias("stale"), F.max("published_at").alias("newest_published"),
    )
    latest = runs.agg(F.max_by(F.struct("id", "status"), F.struct("started_at", "id")).alias("latest"))
    rows = counts.crossJoin(latest)  # two frames of one row
    reason = F.when(F.col("latest").isNull(), "no runs").when(F.col("latest.status") == "failed", "latest run failed").when(F.col("valid") == 0, "no valid postings")
    return rows.select("*", reason.isNull().alias("ok"), reason.alias("reason"))


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("id")).limit(n)


def published_since(state: DataFrame, since: Column) -> DataFrame:
    return state.agg(F.count_if(F.col("published_at") >= since).alias("n"))


def job_health(jobs: DataFrame, runs: DataFrame, message_length: int = 500) -> DataFrame:
    """Each job with its latest run."""
    latest = runs.groupBy(F.col("mode").alias("job")).agg(F.max_by(F.struct("id", "status", "started_at", F.substring("error", 1, message_length).alias("message")), F.struct("started_at", "id")).alias("run"))
    return jobs.join(latest, "job", "left").select("job", "run.id", "run.status", "run.started_at", "run.message")

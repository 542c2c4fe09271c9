"""Reconciliation of the posting table with a full snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordlake.functions.columns import clamp
from fjordlake.operators.merge import SCALARS, payload_hash


def reconcile_window(events: DataFrame, cutoff: Column, months: int = 6) -> DataFrame:
    """Events of the calendar months up to the cutoff."""
    return events.filter((F.col("version") >= F.add_months(cutoff, -months).cast("timestamp") + (cutoff - F.date_trunc("day", cutoff))) & (F.col("version") <= cutoff))


def reconcile_snapshot(events: DataFrame, run_id: str) -> DataFrame:
    """The final status of each id: that of its highest version, ties to the later event."""
    last = events.groupBy("external_id").agg(F.max_by(F.struct("status", "version", "source_event_id"), F.struct(F.coalesce("version", F.expr("timestamp'0001-01-01 00:00:00'")), "seq")).alias("x"))
    return last.select(F.lit(run_id).alias("run_id"), "external_id", F.col("x.status").alias("final_status"), F.col("x.version").alias("source_event_version"), F.col("x.source_event_id").alias("source_event_id"))


def _absent(state: DataFrame, snapshot: DataFrame) -> DataFrame:
    present = snapshot.filter(F.col("final_status") == "ACTIVE").select("external_id")
    return state.filter(F.col("status") == "ACTIVE").join(present, "external_id", "left_anti")


def closeout(state: DataFrame, snapshot: DataFrame, cutoff: Column, limit: int | None = 100, derived: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The new state and an audit row for each posting that was closed.

    Active postings that the snapshot does not have active and whose version is not past the cutoff become INACTIVE, the first
    by id, those with a stored version before those where it must be derived. Postings without any version are never closed."""
    stored = F.col("source_event_version")
    version = stored if derived is None else F.coalesce(stored, derived)
    open_rows = _absent(state, snapshot).withColumn("legacy", stored.isNull()).withColumn("final_version", version)
    closing = open_rows.filter(F.col("final_version") <= cutoff).orderBy("legacy", "external_id").limit(clamp(limit, 100, 250))
    own = ["final_version", *state.columns]
    closed = closing.select(*own).withColumn("source_event_version", F.col("final_version")).drop("final_version").withColumn("status", F.lit("INACTIVE")).withColumn("payload_hash", payload_hash(SCALARS, F.col("source_event_version")))
    audit = closing.select("external_id", F.lit("closeout").alias("change_kind"), F.lit("ACTIVE").alias("previous_status"), F.lit("INACTIVE").alias("new_status"), "final_version")
    rest = state.join(closed.select("external_id"), "external_id", "left_anti")
    # what a run has marked before, such as present, stays where nothing was closed
    known = rest if "reconciliation_status" in state.columns else rest.withColumn("reconciliation_status", F.lit(None).cast("string"))
    return known.unionByName(closed.withColumn("reconciliation_status", F.lit("absent"))), audit


def backfill_versions(state: DataFrame, snapshot: DataFrame, derived: Column, limit: int = 100) -> DataFrame:
    """external_id and version of active postings without a stored one that the snapshot lacks."""
    found = _absent(state.filter(F.col("source_event_version").isNull()), snapshot).withColumn("version", derived).filter(F.col("version").isNotNull())
    return found.orderBy("external_id").limit(limit).select("external_id", "version")


def closeout_remaining(state: DataFrame, snapshot: DataFrame, cutoff: Column, derived: Column) -> DataFrame:
    """One row: whether any closeable posting is left (0 or 1), and how many without a version keep the run from ending."""
    rows = _absent(state, snapshot).withColumn("v", F.coalesce("source_event_version", derived))
    return rows.agg(F.coalesce(F.max((F.col("v").isNull() | (F.col("v") <= cutoff)).cast("int")), F.lit(0)).alias("remaining"), F.count_if(F.col("v").isNull()).alias("unversioned"))

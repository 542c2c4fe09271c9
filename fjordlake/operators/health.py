"""The health report's counts kept up from audit rows, instead of a scan of the table.

Counters are rows (metric, at, n): sums by metric, for open postings with an expiry time one row for each such time, so that those
expired at any moment are a sum, and for the newest version its time. Each batch of audit rows adds what its changes add and takes
away; a batch costs its own rows and the counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COUNTERS = "metric string, at timestamp, n long"
#: Metrics with a counter for each time.
_TIMED = ("active_expires",)


#: What is counted of audit rows, before and after.
COUNTED = ("status", "expires_at", "has_detail", "source_event_version")


def _counted(values: str) -> list[tuple[str, Column, Column]]:
    """Metric, its time and whether a posting with these values counts for it."""
    v = lambda c: F.col(f"{values}.{c}")
    none = F.lit(None).cast("timestamp")
    there = F.col(values).isNotNull()
    active = there & F.coalesce(v("status") == "ACTIVE", F.lit(False))
    detail = F.coalesce(v("has_detail"), F.lit(False))
    return [
        ("total", none, there),
        ("active", none, active),
        ("inactive", none, there & F.coalesce(v("status") == "INACTIVE", F.lit(False))),
        ("active_with_detail", none, active & detail),
        ("active_missing_detail", none, active & ~detail),
        ("active_without_expiry", none, active & v("expires_at").isNull()),
        ("active_expires", v("expires_at"), active & v("expires_at").isNotNull()),
    ]


def health_changes(audit: DataFrame) -> DataFrame:
    """What audit rows (previous_values, new_values) add to the counters."""
    once = lambda counts, sign: F.when(counts, F.lit(sign)).otherwise(0)
    before, after = (_counted(values) for values in ("previous_values", "new_values"))
    plain = [(m, F.sum(once(was, -1) + once(now, 1))) for (m, _, was), (_, _, now) in zip(before, after) if m not in _TIMED]
    one = audit.agg(*(n.cast("long").alias(m) for m, n in plain), F.max("new_values.source_event_version").alias("newest"))
    none, n = F.lit(None).cast("timestamp"), lambda c: F.col(c).cast("long").alias("n")
    counters = [F.struct(F.lit(m).alias("metric"), none.alias("at"), n(m)) for m, _ in plain] + [F.struct(F.lit("newest").alias("metric"), F.col("newest").alias("at"), F.when(F.col("newest").isNotNull(), 1).cast("long").alias("n"))]
    sums = one.select(F.explode(F.array(*counters)).alias("x")).select("x.*").filter(F.col("n") != 0)
    # a row's own changes that cancel out make no row
    timed = [F.struct(F.lit(m).alias("metric"), at.alias("at"), F.lit(sign).cast("long").alias("n"), counts.alias("counts")) for sign, values in ((-1, before), (1, after)) for m, at, counts in values if m in _TIMED]
    same = F.col("previous_values.status").eqNullSafe(F.col("new_values.status")) & F.col("previous_values.expires_at").eqNullSafe(F.col("new_values.expires_at"))
    dated = audit.filter(F.col("previous_values").isNull() | ~same).select(F.explode(F.filter(F.array(*timed), lambda x: x["counts"])).alias("x"))
    return sums.unionByName(dated.select("x.metric", "x.at", "x.n").groupBy("metric", "at").agg(F.sum("n").alias("n")).filter(F.col("n") != 0))


def add_health(counters: DataFrame | None, audit: DataFrame) -> DataFrame:
    """The counters after a batch; versions never fall, so the newest is the largest."""
    new = health_changes(audit)
    both = new if counters is None else counters.unionByName(new)
    sums = both.filter(F.col("metric") != "newest").groupBy("metric", "at").agg(F.sum("n").alias("n")).filter(F.col("n") != 0)
    newest = both.filter(F.col("metric") == "newest").groupBy("metric").agg(F.max("at").alias("at")).select("metric", "at", F.lit(1).cast("long").alias("n"))
    return sums.unionByName(newest)


def health_of(counters: DataFrame, now: Column) -> DataFrame:
    """One row, as a scan of the table would give it at that moment."""
    of = lambda m: F.coalesce(F.sum(F.when(F.col("metric") == m, F.col("n"))), F.lit(0))
    expired = F.coalesce(F.sum(F.when((F.col("metric") == "active_expires") & (F.col("at") < now), F.col("n"))), F.lit(0))
    return counters.agg(*(of(m).alias(m) for m in ("total", "active", "inactive", "active_with_detail", "active_missing_detail", "active_without_expiry")), expired.alias("active_expired"), F.max(F.when(F.col("metric") == "newest", F.col("at"))).alias("latest_source_event_at"))

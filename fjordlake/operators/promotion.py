"""Promotion of reviewed signals into the governed store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjordlake.functions import columns as L
from fjordlake.plans.config import BLOCKING_FLAGS, PROMOTABLE


def promotion_thresholds() -> tuple[Column, Column]:
    """Least start value and change: from the explanation, else the row (0 counts as missing), else 100 and 10."""
    said = lambda name: F.get_json_object("explainability_summary_json", f"$.thresholds_applied.{name}").try_cast("double")
    return F.coalesce(said("min_baseline"), F.nullif(F.col("min_baseline").cast("double"), F.lit(0.0)), F.lit(100.0)), F.coalesce(said("min_absolute_change"), F.lit(10.0))


def promotion_reject_reason(signals: DataFrame, decisions: DataFrame | None = None, type_filter: str | None = None) -> DataFrame:
    """signals with reject_reason: the first rule, in a fixed order, that blocks promotion; null if none does.

    With decisions, only approved signals pass, and approval waives the flag preview_not_product_ready."""
    rows = signals
    if decisions is not None:
        rows = rows.join(decisions.select("signal_deterministic_hash", "review_decision", "reviewer_id"), "signal_deterministic_hash", "left")
    least_start, least_change = promotion_thresholds()
    waived = ("preview_not_product_ready",) if decisions is not None else ()
    blocked = F.array_sort(F.array_intersect("quality_flags", F.array(*(F.lit(f) for f in BLOCKING_FLAGS if f not in waived))))
    empty = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    kind = F.trim(F.coalesce("signal_type", F.lit("")))
    reason = F.when(kind != type_filter, "signal_type_filtered") if type_filter else F.when(F.lit(False), "")
    reason = reason.when(~kind.isin(*PROMOTABLE), "signal_type_not_allowed")
    if decisions is not None:
        decision = F.col("review_decision")
        reason = reason.when(decision.isNull(), "not_review_approved").when(decision == "reject", "review_rejected").when(decision == "quarantine", "review_quarantined").when(decision == "needs_more_review", "review_needs_more")
    reason = (
        reason.when(F.coalesce("confidence_category", F.lit("")) != "verified_statistical", "confidence_category")
        .when(F.coalesce(F.col("confidence_score") < 0.9, F.lit(True)), "confidence_score")
        .when(F.coalesce(F.col("signal_quality_score") < 0.8, F.lit(True)), "signal_quality_score")
        .when(F.col("value_start").isNull(), "value_start_missing")
        .when(F.col("value_start") < least_start, "baseline_below_min")
        .when(F.col("absolute_change").isNull(), "absolute_change_missing")
        .when(F.abs("absolute_change") < least_change, "absolute_change_below_min")
        .when(F.size(blocked) > 0, F.concat(F.lit("blocked_quality_flags:"), L.joined(blocked)))
        .when(empty("explainability_note"), "explainability_note_missing")
        .when(empty("lineage_json") | (F.col("lineage_json") == "{}"), "lineage_json_missing")
        .when(empty("signal_deterministic_hash"), "signal_deterministic_hash_missing")
        .when(F.size(L.split_ids(F.coalesce("source_observation_ids", F.lit("")))) == 0, "source_observation_ids_missing")
    )
    return rows.withColumn("reject_reason", reason)


def orphan_decisions(decisions: DataFrame, signals: DataFrame) -> DataFrame:
    return decisions.join(signals.select("signal_deterministic_hash"), "signal_deterministic_hash", "left_anti")


def decision_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("review_decision").agg(F.count("*").alias("n"))


def promotion_limit(signals: DataFrame, n: int, order: tuple[str, ...] = ("source_observation_ids", "signal_deterministic_hash")) -> DataFrame:
    return signals.orderBy(*order).limit(n)


def skip_persisted_hashes(signals: DataFrame, store: DataFrame, order: tuple[str, ...] = ("source_observation_ids",)) -> tuple[DataFrame, DataFrame]:
    """Signals that are new (the first of each hash, of equals in order that whose JSON text is least), and rejects: known hashes, and later rows of a hash."""
    known = store.select("signal_deterministic_hash").distinct().withColumn("is_known", F.lit(True))
    nth = F.row_number().over(Window.partitionBy("signal_deterministic_hash").orderBy(*order, L.canonical_json(*signals.columns)))
    rows = signals.withColumn("nth", nth).join(known, "signal_deterministic_hash", "left")
    is_new = F.col("is_known").isNull() & (F.col("nth") == 1)
    return rows.filter(is_new).select(*signals.columns), rows.filter(~is_new).select(*signals.columns, F.lit("duplicate_hash_already_persisted").alias("reject_reason"))


def require_observations(signals: DataFrame, obs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signals all of whose observations are known, and rejects that name the first three missing."""
    sources = signals.select("signal_deterministic_hash", F.posexplode(L.split_ids(F.col("source_observation_ids"))).alias("nth", "id"))
    place = F.row_number().over(Window.partitionBy("signal_deterministic_hash").orderBy("nth", "id"))
    first = sources.join(obs.select("id"), "id", "left_anti").withColumn("place", place).filter(F.col("place") <= 3)
    missing = first.groupBy("signal_deterministic_hash").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "id"))), lambda x: x["id"]).alias("missing"))
    reason = F.concat(F.lit("missing_observations:"), L.joined(F.col("missing")))
    return signals.join(missing, "signal_deterministic_hash", "left_anti"), signals.join(missing, "signal_deterministic_hash").withColumn("reject_reason", reason).drop("missing")


def build_signal_rows(signals: DataFrame, batch_id: str) -> DataFrame:
    start, end = L.arrow_split(F.col("periods_compared"))
    said = lambda name: F.get_json_object("explainability_summary_json", f"$.periods.{name}")
    return signals.select(
        F.sha2(F.concat_ws("|", F.lit(batch_id), "signal_deterministic_hash"), 256).alias("id"),
        F.lit(batch_id).alias("batch_id"), "signal_deterministic_hash", "signal_type", "signal_label", "table_id", F.coalesce(said("start"), start).alias("period_start"), F.coalesce(said("end"), end).alias("period_end"),
        "value_start", "value_end", "absolute_change", "percent_change", "direction_label", F.col("signal_quality_score").cast("decimal(5,4)").alias("signal_quality_score"), F.col("confidence_score").cast("decimal(5,4)").alias("confidence_score"),
        "quality_flags", "dimensions_json", "lineage_json", "source_observation_ids",
    )


def build_batch_row(rows: DataFrame, batch_id: str) -> DataFrame:
    return rows.agg(F.lit(batch_id).alias("batch_id"), F.count("*").alias("signals"), F.countDistinct("signal_type").alias("types"))


def build_signal_sources(rows: DataFrame, obs: DataFrame) -> DataFrame:
    """One row for each signal and source observation, with the observation's facts."""
    sources = rows.select("signal_deterministic_hash", F.explode(L.split_ids(F.col("source_observation_ids"))).alias("id"))
    return sources.join(obs.select("id", "table_id", "period", "contents_code", "value", "source_file"), "id").withColumnRenamed("id", "observation_id")


def build_review_rows(rows: DataFrame, decisions: DataFrame, default_reviewer: str) -> DataFrame:
    own = decisions.select("signal_deterministic_hash", "review_decision", "reviewer_id", "review_notes")
    return rows.select("signal_deterministic_hash").join(own, "signal_deterministic_hash", "left").select("signal_deterministic_hash", F.coalesce("review_decision", F.lit("approve_for_persistence")).alias("review_decision"), F.coalesce(L.blank_to_null(F.col("reviewer_id")), F.lit(default_reviewer)).alias("reviewer_id"), "review_notes")


def reject_reason_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason").agg(F.count("*").alias("n"))

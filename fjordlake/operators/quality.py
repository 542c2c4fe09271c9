"""Quality scores and flags of signals, their order, samples and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordlake.functions import columns as L
from fjordlake.plans.config import SignalConfig


def change_quality(start: Column, percent: Column, change: Column, cfg: SignalConfig, unspecified: Column, total: Column, complete: Column, units_match: Column) -> Column:
    """score, flags and reasoning (JSON): a weighted sum of baseline size, change size, labels and units, then penalties."""
    unit = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    parts = {
        "baseline_size": (0.34, unit(start / max(1.0, cfg.min_baseline * 3))),
        "absolute_change_magnitude": (0.22, unit(F.abs(change) / max(1e-9, cfg.min_absolute_change * 5))),
        "label_completeness": (0.22, F.when(complete, 1.0).otherwise(0.45)),
        "unit_consistency": (0.22, F.when(units_match, 1.0).otherwise(0.0)),
    }
    # sums and products in a fixed order, since a score between two rounded values goes either way by its last bit
    size, change_size, labels, units = (w * c for w, c in parts.values())
    weighted = size + change_size + (labels + units)
    unstable = (F.abs(percent) >= 40) & (start < 250)
    score = weighted * F.when(unstable, 0.75).otherwise(1.0) * F.when(unspecified, 0.55).otherwise(1.0) * F.when(total, 0.35).otherwise(1.0)
    named = (
        (unspecified, "unspecified_dimension"),
        (total, "total_category"),
        (~complete, "missing_labels"),
        (~units_match, "mixed_units"),
        (start < cfg.min_baseline, "low_baseline"),
        (F.abs(change) < cfg.min_absolute_change, "noisy_change"),
        (unstable, "unstable_slice"),
        (score < 0.55, "low_confidence_preview_only"),
    )
    flags = F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in named)))
    reasoning = F.struct(
        F.struct(*(L.half_even(c, 4).alias(k) for k, (_, c) in parts.items())).alias("components"),
        F.struct(*(F.lit(w).alias(k) for k, (w, _) in parts.items())).alias("weights"),
        F.array_remove(flags, "noisy_change").alias("penalty_flags"),
    )
    return F.struct(unit(L.half_even_scaled(score, 4)).alias("score"), flags.alias("flags"), F.to_json(reasoning).alias("reasoning"))


def snapshot_quality_score(n: Column) -> Column:
    return L.half_even(F.least(F.lit(1.0), 0.45 + 0.12 * F.least(n, F.lit(20)) / 20 + F.when(n >= 3, 0.43).otherwise(0.0)), 4)


def snapshot_reasoning(n: Column) -> Column:
    """JSON of what a snapshot's score is made of."""
    components = F.struct(F.lit(0.45).alias("base"), L.half_even(0.12 * F.least(n, F.lit(20)) / 20, 4).alias("source_count"), F.when(n >= 3, 0.43).otherwise(0.0).alias("enough_sources"))
    return F.to_json(F.struct(components.alias("components"), n.alias("aggregated_rows"), F.array().cast("array<string>").alias("penalty_flags")))


def quality_flags(parts: Column, fixed: list[str]) -> Column:
    return F.array_sort(F.array_distinct(F.concat(parts["flags"], F.array(*(F.lit(f) for f in fixed)))))


ORDER = ("signal_type", "table_id", "periods_compared", "dimensions_json", "source_observation_ids", "signal_deterministic_hash")


def signals_ordered(signals: DataFrame) -> DataFrame:
    return signals.orderBy(*(F.coalesce(c, F.lit("")) for c in ORDER))


def review_samples(signals: DataFrame, cap: int = 200) -> dict[str, DataFrame]:
    """Growth, decline, unstable and low-quality samples for a reviewer; each is a top-k, not a sort."""
    changes = signals.filter(F.col("percent_change").isNotNull())
    last = F.col("source_observation_ids")
    return {
        "top_growth": changes.orderBy(F.desc("percent_change"), last).limit(cap),
        "top_decline": changes.orderBy("percent_change", last).limit(cap),
        "unstable": changes.orderBy(F.abs("percent_change").desc(), F.coalesce("value_start", F.lit(0.0)), last).limit(cap),
        "low_quality": signals.orderBy(F.coalesce(F.nullif("signal_quality_score", F.lit(0.0)), F.lit(1.0)), last).limit(cap),
    }


def quality_histogram(signals: DataFrame) -> DataFrame:
    x = F.col("signal_quality_score")
    bin_of = F.when(x < 0.2, "0.0-0.2").when(x < 0.4, "0.2-0.4").when(x < 0.6, "0.4-0.6").when(x < 0.8, "0.6-0.8").otherwise("0.8-1.0")
    return signals.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))


def signal_counts(signals: DataFrame) -> DataFrame:
    """Counts by type, by direction and by table, in one pass."""
    named = F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("name")) for c in ("signal_type", "direction_label", "table_id")))
    return signals.select(F.explode(named).alias("x")).groupBy("x.kind", "x.name").agg(F.count("*").alias("n"))

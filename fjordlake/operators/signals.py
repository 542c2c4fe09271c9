"""Signals from observations: two-period changes and latest-period snapshots.

Observations have id, table_id, period, contents_code, unit, value, dimensions (map), labels (map) and lineage columns. The
grouping key is one exchange; pairing, filtering, scoring and hashing are column expressions on top of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjordlake.functions import columns as L
from fjordlake.operators import quality
from fjordlake.plans.config import TIME_KEYS, TOTALS, UNSPECIFIED, SignalConfig

LINEAGE = ("source_file", "table_id", "normalization_version", "transformation_version")


def slice_dimensions(dimensions: Column) -> Column:
    """Sorted dimensions without time, contents code and nulls."""
    kept = F.map_filter(dimensions, lambda k, v: ~k.isin(*TIME_KEYS, "ContentsCode") & v.isNotNull())
    return L.sorted_map(kept)


def has_unspecified(labels: Column) -> Column:
    return L.contains_any(L.label_text(labels), UNSPECIFIED)


def is_total_like(dimensions: Column, labels: Column) -> Column:
    """Whether a dimension's code is TOT or its label contains a total phrase."""
    own = F.map_entries(slice_dimensions(dimensions))
    return F.exists(own, lambda e: (F.upper(F.trim(e["value"])) == "TOT") | L.contains_any(F.element_at(labels, e["key"]), TOTALS))


def contents_label(code: Column, labels: Column) -> Column:
    return L.first_text(F.coalesce(labels["ContentsCode"], labels["contents_code"]), code)


def signal_label(base: Column, code: Column, label: Column) -> Column:
    detail = F.when((code != "") & (code != label), F.concat(F.lit(" ("), code, F.lit(")"))).otherwise(F.lit(""))
    return F.when(F.coalesce(label, F.lit("")) == "", base).otherwise(F.concat(base, F.lit(" — ContentsCode: "), label, detail))


def scan_observations(obs: DataFrame, table_id: str, period: str | None = None, contents_code: str | None = None, limit: int | None = None) -> DataFrame:
    found = obs.filter(F.col("table_id") == table_id)
    if period is not None:
        found = found.filter(F.col("period") == period)
    if contents_code is not None:
        found = found.filter(F.col("contents_code") == contents_code)
    found = found.orderBy("period", "id")
    return found if limit is None else found.limit(limit)


def latest_two_periods(obs: DataFrame, table_id: str, contents_code: str | None = None) -> DataFrame:
    """period and nth (1: newest); no rows if there are fewer than two periods."""
    found = obs.filter((F.col("table_id") == table_id) & F.col("period").isNotNull())
    if contents_code is not None:
        found = found.filter(F.col("contents_code") == contents_code)
    newest = found.select("period").distinct().orderBy(L.period_key(F.col("period")).desc()).limit(2)
    numbered = newest.withColumn("nth", F.row_number().over(Window.orderBy(L.period_key(F.col("period")).desc())))  # two rows
    return numbered.withColumn("n", F.count("*").over(Window.partitionBy())).filter(F.col("n") == 2).drop("n")


def balanced_period_scan(obs: DataFrame, table_id: str, limit_per_period: int, contents_code: str | None = None) -> DataFrame:
    """At most so many rows, by id, of each of the two newest periods."""
    periods = latest_two_periods(obs, table_id, contents_code).select("period")
    found = obs.filter(F.col("table_id") == table_id)
    if contents_code is not None:
        found = found.filter(F.col("contents_code") == contents_code)
    nth = F.row_number().over(Window.partitionBy("period").orderBy("id"))
    return found.join(F.broadcast(periods), "period", "left_semi").withColumn("nth", nth).filter(F.col("nth") <= limit_per_period).drop("nth")


def period_pairs(obs: DataFrame) -> DataFrame:
    """One row for each table, contents code and slice: its two newest periods as start and end, the changes and a status.

    Of rows with one slice and period that with the highest id counts. status: pair, missing_prior or zero_baseline."""
    keyed = obs.filter(F.col("period").isNotNull() & F.col("dimensions").isNotNull()).select(
        F.struct(*obs.columns).alias("row"), "table_id", F.coalesce("contents_code", F.lit("")).alias("contents"), F.to_json(slice_dimensions(F.col("dimensions"))).alias("slice"), "period"
    )
    keyed = keyed.repartition("table_id", "contents", "slice")  # one exchange serves all three steps below
    each = keyed.groupBy("table_id", "contents", "slice", "period").agg(F.max_by("row", F.col("row.id")).alias("row"))
    newest = Window.partitionBy("table_id", "contents", "slice").orderBy(L.period_key(F.col("period")).desc())
    two = each.withColumn("nth", F.row_number().over(newest)).filter(F.col("nth") <= 2)
    paired = two.groupBy("table_id", "contents", "slice").agg(F.max(F.when(F.col("nth") == 2, F.struct("period", "nth")))["period"].alias("period_start"), F.max_by("row", F.when(F.col("nth") == 2, 1)).alias("start"), F.max_by("period", F.when(F.col("nth") == 1, 1)).alias("period_end"), F.max_by("row", F.when(F.col("nth") == 1, 1)).alias("end"))
    start, end = F.col("start.value").cast("double"), F.col("end.value").cast("double")
    status = F.when(start.isNull() | end.isNull(), "missing_prior").when(start == 0, "zero_baseline").otherwise("pair")
    return paired.select("*", start.alias("value_start"), end.alias("value_end"), (end - start).alias("absolute_change"), F.when(start != 0, (end - start) / F.nullif(start, F.lit(0.0)) * 100).alias("percent_change"), status.alias("status"))


def slice_guards() -> dict[str, Column]:
    """Whether both sides of a pair (start, end) agree in their dimensions but for time and measure, their contents code and their unit; blank counts as null."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    return {
        "same_slice": F.to_json(slice_dimensions(F.col("start.dimensions"))) == F.to_json(slice_dimensions(F.col("end.dimensions"))),
        "same_contents": text("start.contents_code") == text("end.contents_code"),
        "same_unit": text("start.unit") == text("end.unit"),
    }


def reject_reason(cfg: SignalConfig) -> Column:
    """The first rule, in a fixed order, that a pair breaks; null for a pair that is emitted."""
    guards = slice_guards()
    no_lineage = F.coalesce(*(L.blank_to_null(F.col(f"{side}.{c}")) for side in ("start", "end") for c in LINEAGE)).isNull()
    unspecified = has_unspecified(F.col("start.labels")) | has_unspecified(F.col("end.labels"))
    total = is_total_like(F.col("start.dimensions"), F.col("start.labels")) | is_total_like(F.col("end.dimensions"), F.col("end.labels"))
    small = (F.col("value_start") < cfg.min_baseline) & (F.col("value_end") < cfg.min_baseline)
    reason = (
        F.when(F.col("status") != "pair", F.col("status"))
        .when(~L.period_pair_valid(F.col("period_start"), F.col("period_end")), "invalid_period_pairing")
        .when(~guards["same_slice"], "slice_mismatch")
        .when(~guards["same_contents"], "dimension_mismatch")
        .when(~guards["same_unit"], "unit_mismatch")
        .when(no_lineage, "lineage_failure")
    )
    if cfg.exclude_totals:
        reason = reason.when(total, "total_category")
    if cfg.exclude_small:
        reason = reason.when(small, "both_below_baseline")
    if cfg.exclude_unspecified:
        reason = reason.when(unspecified, "unspecified_category")
    return reason.when(F.abs("absolute_change") < cfg.min_absolute_change, "low_absolute_change").when(F.col("value_start") < cfg.min_baseline, "low_baseline")


def change_filters(pairs: DataFrame, cfg: SignalConfig) -> DataFrame:
    return pairs.withColumn("reject_reason", reject_reason(cfg))


def change_skip_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy(F.coalesce("reject_reason", F.lit("emitted")).alias("outcome")).agg(F.count("*").alias("n"))


STRICT = ("invalid_period_pairing", "slice_mismatch", "dimension_mismatch", "unit_mismatch", "lineage_failure")


def validation_violations(judged: DataFrame) -> DataFrame:
    """Pairs that break a strict rule, with a message; the caller decides whether to stop."""
    message = F.concat_ws(":", "reject_reason", F.concat_ws("|", "period_start", "period_end"))
    return judged.filter(F.col("reject_reason").isin(*STRICT)).select("table_id", "contents", "slice", "period_start", "period_end", "reject_reason", message.alias("message"))


def direction_label(percent: Column, cfg: SignalConfig) -> Column:
    return F.when(percent.isNull(), "n/a").when(percent >= cfg.growth_percent, "growth").when(percent <= cfg.decline_percent, "decline").otherwise("stable")


def signal_hash(signal_type: Column, dimensions: Column, start: Column, end: Column, ids: Column, version: str) -> Column:
    text = L.canonical_json(
        end.alias("period_end"), start.alias("period_start"), F.lit(version).alias("signal_logic_version"), signal_type.alias("signal_type"), slice_dimensions(dimensions).alias("slice_dims"), F.array_sort(F.array_distinct(ids)).alias("source_observation_ids")
    )
    return F.sha2(text, 256)


def lineage_object(rows: list[Column], cfg: SignalConfig) -> Column:
    """JSON of the datasets, versions and files behind a signal: those of its first row, the second's where they may differ, and lists of both.

    Signatures are counted where rows have them; the importer's version is that of the first row's, if it has one, else the setting's."""
    first, names = rows[0], ("normalization_version", "transformation_version", "ingestion_batch_id", "statistical_dataset_id", "dataset_version_id", "source_file", "table_id")
    each = lambda c: F.array_distinct(F.array_compact(F.array(*(r[c] for r in rows))))
    signature = lambda r: L.blank_to_null(F.coalesce(r["observation_signature"], r["id"])) if cfg.has_signatures else L.blank_to_null(r["id"])
    second = [rows[1]["source_file"].alias("source_file_b"), rows[1]["dataset_version_id"].alias("dataset_version_id_b")] if len(rows) > 1 else []
    return F.to_json(F.struct(
        F.lit(cfg.logic_version).alias("signal_logic_version"), F.lit(cfg.importer_version).alias("importer_version"), *(first[c].alias(c) for c in names), *second,
        each("statistical_dataset_id").alias("source_dataset_ids"), each("dataset_version_id").alias("source_dataset_version_ids"), F.size(F.array_compact(F.array(*(signature(r) for r in rows)))).alias("source_observation_signature_count"),
    ), {"ignoreNullFields": "false"})


def explainability(cfg: SignalConfig) -> Column:
    """JSON of the periods, thresholds and the direction rule of a pair."""
    return F.to_json(
        F.struct(
            F.struct(F.col("period_start").alias("start"), F.col("period_end").alias("end")).alias("periods"),
            F.map_keys(slice_dimensions(F.col("end.dimensions"))).alias("dimensions_included"),
            F.struct(F.lit(cfg.min_baseline).alias("min_baseline"), F.lit(cfg.min_absolute_change).alias("min_absolute_change"), F.lit(cfg.growth_percent).alias("growth_pct_min"), F.lit(cfg.decline_percent).alias("decline_pct_max")).alias("thresholds_applied"),
            direction_label(F.col("percent_change"), cfg).alias("direction_result"),
            L.half_even(F.col("percent_change"), 6).alias("percent_change"),
        )
    )


def explainability_note(cfg: SignalConfig) -> Column:
    return F.format_string(
        "Direct two-period comparison %s→%s. Values %s→%s, absolute change %s, percent change %.4f%%: %s. Filters: start value >= %s, change >= %s.",
        "period_start", "period_end", F.col("value_start").cast("string"), F.col("value_end").cast("string"), F.col("absolute_change").cast("string"), "percent_change", direction_label(F.col("percent_change"), cfg), F.lit(str(cfg.min_baseline)), F.lit(str(cfg.min_absolute_change)),
    )


def emit_changes(judged: DataFrame, signal_type: str, title: str, cfg: SignalConfig) -> DataFrame:
    """Signals of the pairs without a reject reason."""
    ids = F.array("start.id", "end.id")
    unspecified = has_unspecified(F.col("start.labels")) | has_unspecified(F.col("end.labels"))
    own, labels = slice_dimensions(F.col("end.dimensions")), F.col("end.labels")
    complete = F.forall(F.map_keys(own), lambda k: F.coalesce(F.element_at(labels, k), F.lit("")) != "")
    parts = quality.change_quality(F.col("value_start"), F.col("percent_change"), F.col("absolute_change"), cfg, unspecified, F.lit(False), complete, F.lit(True))
    direction = direction_label(F.col("percent_change"), cfg)
    fixed = ["preview_not_product_ready", "two_period_change", f"min_baseline_met(>={cfg.min_baseline:g})", *(["no_blocked_unspecified_phrase_in_labels"] if cfg.exclude_unspecified else [])]
    code, label = F.trim(F.coalesce("end.contents_code", F.lit(""))), contents_label(F.col("end.contents_code"), labels)
    return judged.filter(F.col("reject_reason").isNull()).select(
        F.lit(signal_type).alias("signal_type"),
        signal_label(F.concat(F.lit(f"{title} ("), "period_start", F.lit("→"), "period_end", F.lit("): "), direction), code, label).alias("signal_label"),
        "table_id",
        F.concat("period_start", F.lit("→"), "period_end").alias("periods_compared"),
        F.concat(L.period_type(F.col("period_start")), F.lit("→"), L.period_type(F.col("period_end"))).alias("period_type"),
        L.period_granularity(F.col("period_end")).alias("period_granularity"),
        "value_start", "value_end", "absolute_change",
        L.half_even(F.col("percent_change"), 6).alias("percent_change"),
        direction.alias("direction_label"),
        F.lit("verified_statistical").alias("confidence_category"), F.lit(0.9).alias("confidence_score"),
        L.joined(ids).alias("source_observation_ids"),
        F.col("table_id").alias("source_table"),
        F.to_json(L.sorted_map(F.col("end.dimensions"))).alias("dimensions_json"), F.to_json(L.sorted_map(labels)).alias("dimension_labels_json"),
        explainability_note(cfg).alias("explainability_note"), explainability(cfg).alias("explainability_summary_json"),
        lineage_object([F.col("start"), F.col("end")], cfg).alias("lineage_json"),
        quality.quality_flags(parts, fixed).alias("quality_flags"), parts["score"].alias("signal_quality_score"), parts["reasoning"].alias("quality_reasoning_json"),
        signal_hash(F.lit(signal_type), F.col("end.dimensions"), F.col("period_start"), F.col("period_end"), ids, cfg.logic_version).alias("signal_deterministic_hash"),
        F.lit(float(cfg.min_baseline)).alias("min_baseline"), code.alias("contents_code"), label.alias("contents_code_label"),
    )


def _with_dimensions(obs: DataFrame, table_ids: tuple[str, ...], needed: str | None, one_of: tuple[str, ...]) -> DataFrame:
    found = obs.filter(F.col("table_id").isin(*table_ids))
    if needed:
        found = found.filter(F.map_contains_key("dimensions", F.lit(needed)))
    if one_of:
        found = found.filter(F.exists(F.map_keys("dimensions"), lambda k: k.isin(*one_of)))
    return found


def employment_count_change(obs: DataFrame, cfg: SignalConfig) -> DataFrame:
    return emit_changes(change_filters(period_pairs(_with_dimensions(obs, ("11615", "12850"), None, ())), cfg), "employment_count_change", "Employment count change", cfg)


def regional_education_signal(obs: DataFrame, cfg: SignalConfig) -> DataFrame:
    return emit_changes(change_filters(period_pairs(_with_dimensions(obs, ("11615",), "Region", ("Fagfelt", "UtdNivaa"))), cfg), "regional_education_employment_signal", "Regional + education/fagfelt employment", cfg)


def industry_education_signal(obs: DataFrame, cfg: SignalConfig) -> DataFrame:
    return emit_changes(change_filters(period_pairs(_with_dimensions(obs, ("12850",), "NACE2007", ("Fagfelt", "UtdNivaa"))), cfg), "industry_education_employment_signal", "Industry (NACE) + education employment", cfg)


def without_total_members(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows without those that sum up others: whose member of a dimension beyond the keys is a total although the dimension has parts.

    A dimension of which there is nothing but totals stays: nothing would be counted twice, and all would be lost."""
    others = lambda m: F.map_filter(slice_dimensions(m), lambda k, _: ~k.isin(*keys))
    is_total = lambda code, label: F.coalesce(F.upper(F.trim(code)) == "TOT", F.lit(False)) | L.contains_any(label, TOTALS)
    members = rows.select(F.explode(others(F.col("dimensions"))).alias("name", "code"), "labels").groupBy("name").agg(F.count_if(~is_total(F.col("code"), F.element_at("labels", F.col("name")))).alias("parts"))
    with_parts = members.filter(F.col("parts") > 0).agg(F.collect_list("name").alias("with_parts"))  # a name for each dimension
    repeats = F.exists(F.map_entries(others(F.col("dimensions"))), lambda e: F.array_contains("with_parts", e["key"]) & is_total(e["value"], F.element_at(F.col("labels"), e["key"])))
    return rows.crossJoin(F.broadcast(with_parts)).filter(~repeats).drop("with_parts")  # one row


def snapshot_buckets(obs: DataFrame, table_id: str, keys: tuple[str, ...], cfg: SignalConfig) -> DataFrame:
    """Sums of the newest period by the given dimensions (the first is required), with a guard against mixed measures.

    The row with the least id stands for its bucket. reject_reason: invalid_aggregation, no_values, total_category or null."""
    rows = obs.filter((F.col("table_id") == table_id) & F.col("period").isNotNull())
    newest = rows.agg(F.max_by("period", L.period_key(F.col("period"))).alias("period"))
    own = rows.join(F.broadcast(newest), "period").filter(F.map_contains_key("dimensions", F.lit(keys[0])))
    if cfg.exclude_unspecified:
        own = own.filter(~has_unspecified(F.col("labels")))
    if cfg.exclude_totals == "rows":
        own = without_total_members(own, keys)
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    buckets = own.groupBy(*(F.col("dimensions")[k].alias(k) for k in keys)).agg(
        F.min("period").alias("period"), F.sum("value").alias("value_end"), F.count("value").alias("n_values"),
        F.array_sort(F.collect_list(F.when(F.col("value").isNotNull(), F.col("id")))).alias("ids"),
        F.min_by(F.struct(*own.columns), F.col("id")).alias("first"),
        *(f(text(c)).alias(f"{n}_{c}") for c in ("contents_code", "unit") for n, f in (("min", F.min), ("max", F.max))),
    )
    mixed = (F.col("min_contents_code") != F.col("max_contents_code")) | (F.col("min_unit") != F.col("max_unit")) | (L.period_granularity(F.col("period")) == "unknown")
    reason = F.when(mixed, "invalid_aggregation").when(F.col("n_values") == 0, "no_values")
    if cfg.exclude_totals:
        reason = reason.when(is_total_like(F.col("first.dimensions"), F.col("first.labels")), "total_category")
    return buckets.withColumn("reject_reason", reason)


def emit_snapshots(buckets: DataFrame, signal_type: str, title: str, table_id: str, cfg: SignalConfig) -> DataFrame:
    code, label = F.trim(F.coalesce("first.contents_code", F.lit(""))), contents_label(F.col("first.contents_code"), F.col("first.labels"))
    flags = sorted(["preview_not_product_ready", "structure_snapshot", "aggregated_sum_latest_period"])
    return buckets.filter(F.col("reject_reason").isNull()).select(
        F.lit(signal_type).alias("signal_type"),
        signal_label(F.concat(F.lit(f"{title} ("), "period", F.lit("): structure_snapshot")), code, label).alias("signal_label"),
        F.lit(table_id).alias("table_id"), F.col("period").alias("periods_compared"),
        L.period_type(F.col("period")).alias("period_type"), L.period_granularity(F.col("period")).alias("period_granularity"),
        F.lit(None).cast("double").alias("value_start"), "value_end", F.lit(None).cast("double").alias("absolute_change"), F.lit(None).cast("double").alias("percent_change"),
        F.lit("structure_snapshot").alias("direction_label"), F.lit("verified_statistical").alias("confidence_category"), F.lit(1.0).alias("confidence_score"),
        L.joined(F.col("ids")).alias("source_observation_ids"), F.lit(table_id).alias("source_table"),
        F.to_json(L.sorted_map(F.col("first.dimensions"))).alias("dimensions_json"), F.to_json(L.sorted_map(F.col("first.labels"))).alias("dimension_labels_json"),
        F.format_string("Summed %d observations of one slice in period %s.", "n_values", "period").alias("explainability_note"),
        F.to_json(F.struct("period", "n_values")).alias("explainability_summary_json"), lineage_object([F.col("first")], cfg).alias("lineage_json"),
        F.array(*(F.lit(f) for f in flags)).alias("quality_flags"), quality.snapshot_quality_score(F.col("n_values")).alias("signal_quality_score"), quality.snapshot_reasoning(F.col("n_values")).alias("quality_reasoning_json"),
        signal_hash(F.lit(signal_type), F.col("first.dimensions"), F.col("period"), F.col("period"), F.col("ids"), cfg.logic_version).alias("signal_deterministic_hash"),
        F.lit(None).cast("double").alias("min_baseline"), code.alias("contents_code"), label.alias("contents_code_label"),
    )


def occupation_structure_signal(obs: DataFrame, cfg: SignalConfig) -> DataFrame:
    return emit_snapshots(snapshot_buckets(obs, "09793", ("Yrke",), cfg), "occupation_structure_signal", "Occupation structure", "09793", cfg)


def education_workforce_signal(obs: DataFrame, cfg: SignalConfig) -> DataFrame:
    return emit_snapshots(snapshot_buckets(obs, "08417", ("UtdNivaa", "HeltidDeltid"), cfg), "education_level_workforce_signal", "Education level workforce", "08417", cfg)


def drop_missing_sources(signals: DataFrame, obs: DataFrame) -> DataFrame:
    """Signals whose every source observation exists."""
    sources = signals.select("signal_deterministic_hash", F.explode(L.split_ids(F.col("source_observation_ids"))).alias("id"))
    missing = sources.join(obs.select("id"), "id", "left_anti").select("signal_deterministic_hash").distinct()
    return signals.join(missing, "signal_deterministic_hash", "left_anti")

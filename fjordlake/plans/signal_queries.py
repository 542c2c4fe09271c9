"""Registered queries of signals, their quality and promotion, with their DuckDB forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordlake.functions import columns as L
from fjordlake.operators import promotion, quality, signals
from fjordlake.plans import fixtures as X
from fjordlake.plans.config import SignalConfig

CFG = SignalConfig(min_baseline=50, min_absolute_change=5)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def dim(name: str) -> Column:
    return F.get_json_object("dimensions_json", f"$.{name}")


def _pairs(flat: str, dims: str, labels: str) -> str:
    """Pairs of a flat view. dims: its dimension columns; labels: SQL text with all labels of a row."""
    return f"""SELECT e.table_id, e.contents_code, {", ".join("e." + d.strip() for d in dims.split(","))}, s.period AS period_start, e.period AS period_end, s.id AS id_start, e.id AS id_end, s.value AS value_start, e.value AS value_end,
e.value - s.value AS absolute_change, (e.value - s.value) / nullif(s.value, 0) * 100 AS percent_change, lower({labels}) AS label_text, s.value IS NULL AS alone
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_id, contents_code, {dims} ORDER BY CAST(period AS INT) DESC) AS nth FROM ({flat}) f) WHERE nth = 1) e
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_id, contents_code, {dims} ORDER BY CAST(period AS INT) DESC) AS nth FROM ({flat}) f) WHERE nth = 2) s USING (table_id, contents_code, {dims})"""


_REGIONAL_PAIRS = _pairs(X.REGIONAL, "region, education, field", "concat(e.region_label, ' ', e.education, ' ', e.field_label)")
_INDUSTRY_PAIRS = _pairs(X.INDUSTRY, "industry, education", "concat(e.industry, ' ', e.education)")

_REASON = """CASE WHEN alone THEN 'missing_prior' WHEN value_start = 0 THEN 'zero_baseline' WHEN label_text LIKE '%hele landet%' THEN 'total_category' WHEN value_start < 50 AND value_end < 50 THEN 'both_below_baseline'
WHEN label_text LIKE '%uoppgitt%' THEN 'unspecified_category' WHEN abs(absolute_change) < 5 THEN 'low_absolute_change' WHEN value_start < 50 THEN 'low_baseline' END"""

_UNSTABLE = "(abs(percent_change) >= 40 AND value_start < 250)"
_SCORE = f"(0.34 * least(value_start / 150, 1) + 0.22 * least(abs(absolute_change) / 25, 1) + 0.44) * CASE WHEN {_UNSTABLE} THEN 0.75 ELSE 1 END"
_DIRECTION = "CASE WHEN percent_change >= 5 THEN 'growth' WHEN percent_change <= -5 THEN 'decline' ELSE 'stable' END"


def _emitted(pairs: str, signal_type: str, dims: str) -> str:
    """Signals of pairs, their dimensions as JSON without time and measure."""
    names = ", ".join(f"'\"{d.split('=')[0]}\":\"', {d.split('=')[1]}, '\"'" + (", ','" if i < len(dims.split(",")) - 1 else "") for i, d in enumerate(x.strip() for x in dims.split(",")))
    slice_json = f"concat('{{', {names}, '}}')"
    return f"""SELECT '{signal_type}' AS signal_type, table_id, contents_code, concat(period_start, '→', period_end) AS periods_compared, value_start, value_end, absolute_change, round_even(percent_change, 6) AS percent_change, {_DIRECTION} AS direction_label,
concat(id_start, ',', id_end) AS source_observation_ids, round_even({_SCORE}, 4) AS signal_quality_score,
concat(CASE WHEN {_SCORE} < 0.55 THEN 'low_confidence_preview_only,' ELSE '' END, 'min_baseline_met(>=50),no_blocked_unspecified_phrase_in_labels,preview_not_product_ready,two_period_change', CASE WHEN {_UNSTABLE} THEN ',unstable_slice' ELSE '' END) AS flags,
sha256(concat('{{"period_end":"', period_end, '","period_start":"', period_start, '","signal_logic_version":"1","signal_type":"{signal_type}","slice_dims":', {slice_json}, ',"source_observation_ids":["', least(id_start, id_end), '","', greatest(id_start, id_end), '"]}}')) AS signal_deterministic_hash
FROM ({pairs}) p WHERE {_REASON} IS NULL"""


_REGIONAL_DIMS = "Fagfelt=field, Region=region, UtdNivaa=education"
_INDUSTRY_DIMS = "NACE2007=industry, UtdNivaa=education"
_EMPLOYMENT = _emitted(_REGIONAL_PAIRS, "employment_count_change", _REGIONAL_DIMS) + " UNION ALL " + _emitted(_INDUSTRY_PAIRS, "employment_count_change", _INDUSTRY_DIMS)
_REGIONAL = _emitted(_REGIONAL_PAIRS, "regional_education_employment_signal", _REGIONAL_DIMS)
_INDUSTRY = _emitted(_INDUSTRY_PAIRS, "industry_education_employment_signal", _INDUSTRY_DIMS)

SHOWN = ("signal_type", "table_id", "contents_code", "periods_compared", "value_start", "value_end", "absolute_change", "percent_change", "direction_label", "source_observation_ids", "signal_quality_score", "signal_deterministic_hash")


def shown(found: DataFrame) -> DataFrame:
    return found.select(*SHOWN, L.joined(F.col("quality_flags")).alias("flags"))


def both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.regional(spark, sf_dir).unionByName(X.industry(spark, sf_dir))


@query("employment_count_change", _EMPLOYMENT)
def _(spark, sf_dir):
    return shown(signals.employment_count_change(both(spark, sf_dir), CFG))


@query("regional_education_signal", _REGIONAL)
def regional_signals(spark, sf_dir):
    return shown(signals.regional_education_signal(X.regional(spark, sf_dir), CFG))


@query("industry_education_signal", _INDUSTRY)
def _(spark, sf_dir):
    return shown(signals.industry_education_signal(X.industry(spark, sf_dir), CFG))


@query("scan_observations", f"SELECT id, period, value FROM ({X.REGIONAL}) o WHERE contents_code = 'Orders' ORDER BY period, id LIMIT 100")
def _(spark, sf_dir):
    return signals.scan_observations(X.regional(spark, sf_dir), "11615", contents_code="Orders", limit=100).select("id", "period", "value")


@query("latest_two_periods", f"SELECT period, CAST(row_number() OVER (ORDER BY CAST(period AS INT) DESC) AS INT) AS nth FROM (SELECT DISTINCT period FROM ({X.INDUSTRY}) o ORDER BY period DESC LIMIT 2) p")
def _(spark, sf_dir):
    return signals.latest_two_periods(X.industry(spark, sf_dir), "12850")


@query("balanced_period_scan", f"SELECT id, period, value FROM (SELECT *, row_number() OVER (PARTITION BY period ORDER BY id) AS nth FROM ({X.REGIONAL}) o WHERE period IN ('2000', '2001')) b WHERE nth <= 40")
def _(spark, sf_dir):
    return signals.balanced_period_scan(X.regional(spark, sf_dir), "11615", 40).select("id", "period", "value")


@query("period_pairs", f"SELECT table_id, contents_code AS contents, region, education, field, period_start, period_end, value_start, value_end, absolute_change, percent_change FROM ({_REGIONAL_PAIRS}) p")
def _(spark, sf_dir):
    own = lambda c: F.col("end.dimensions")[c]
    return signals.period_pairs(X.regional(spark, sf_dir)).select("table_id", "contents", own("Region").alias("region"), own("UtdNivaa").alias("education"), own("Fagfelt").alias("field"), "period_start", "period_end", "value_start", "value_end", "absolute_change", "percent_change")


_CLASS = """CASE WHEN period IS NULL THEN 'unknown' WHEN regexp_full_match(period, '[0-9]{4}') THEN 'calendar_year' WHEN regexp_full_match(period, '[0-9]{4}[Kk][1-4]') THEN 'ssb_quarter' WHEN regexp_full_match(period, '[0-9]{6}') THEN 'year_month' ELSE 'other' END"""


@query("period_classify", f"SELECT kind, CASE kind WHEN 'calendar_year' THEN 'year' WHEN 'ssb_quarter' THEN 'quarter' WHEN 'year_month' THEN 'month' ELSE 'unknown' END AS granularity, count(*) AS n, min(period) AS least, max(period) AS most FROM (SELECT period, {_CLASS} AS kind FROM ({X.PERIODS}) p) c GROUP BY kind")
def _(spark, sf_dir):
    periods = X.view(spark, sf_dir, X.PERIODS)
    return periods.groupBy(L.period_type(F.col("period")).alias("kind"), L.period_granularity(F.col("period")).alias("granularity")).agg(F.count("*").alias("n"), F.min("period").alias("least"), F.max("period").alias("most"))


@query("period_sort_key", f"SELECT o_orderkey, period, CASE WHEN period IS NULL THEN 2 WHEN {_CLASS} = 'calendar_year' THEN 0 ELSE 1 END AS kind, CASE WHEN {_CLASS} = 'calendar_year' THEN CAST(period AS INT) END AS year FROM ({X.PERIODS}) p")
def _(spark, sf_dir):
    key = L.period_key(F.col("period"))
    return X.view(spark, sf_dir, X.PERIODS).select("o_orderkey", "period", key["kind"].alias("kind"), key["year"].alias("year"))


@query("period_pair_valid", f"SELECT valid, count(*) AS n FROM (SELECT a.kind = b.kind AND a.kind IN ('calendar_year', 'ssb_quarter', 'year_month') AS valid FROM (SELECT o_orderkey, {_CLASS} AS kind FROM ({X.PERIODS}) p) a JOIN (SELECT o_orderkey, {_CLASS} AS kind FROM ({X.PERIODS}) p) b ON b.o_orderkey = a.o_orderkey + 1) v GROUP BY valid")
def _(spark, sf_dir):
    a = X.view(spark, sf_dir, X.PERIODS)
    b = a.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("period").alias("next"))
    return a.join(b, "o_orderkey").groupBy(L.period_pair_valid(F.col("period"), F.col("next")).alias("valid")).agg(F.count("*").alias("n"))


@query("change_skip_counts", f"SELECT coalesce({_REASON}, 'emitted') AS outcome, count(*) AS n FROM ({_REGIONAL_PAIRS}) p GROUP BY 1")
def _(spark, sf_dir):
    return signals.change_skip_counts(signals.change_filters(signals.period_pairs(X.regional(spark, sf_dir)), CFG))


@query("change_filters", f"SELECT region, education, field, contents_code AS contents, {_REASON} AS reject_reason FROM ({_REGIONAL_PAIRS}) p")
def _(spark, sf_dir):
    own = lambda c: F.col("end.dimensions")[c]
    return signals.change_filters(signals.period_pairs(X.regional(spark, sf_dir)), CFG).select(own("Region").alias("region"), own("UtdNivaa").alias("education"), own("Fagfelt").alias("field"), "contents", "reject_reason")


@query("validation_violations", f"SELECT concat('unit_mismatch:', period_start, '|', period_end) AS message, region, education, field, contents_code AS contents FROM ({_REGIONAL_PAIRS}) p WHERE region = 'ASIA' AND NOT alone AND value_start <> 0 AND period_end = '2001'")
def _(spark, sf_dir):
    """Units of one region are spoilt for the newest period."""
    obs = X.regional(spark, sf_dir).withColumn("unit", F.when((F.col("dimensions")["Region"] == "ASIA") & (F.col("period") == "2001"), "other").otherwise(F.col("unit")))
    found = signals.validation_violations(signals.change_filters(signals.period_pairs(obs), CFG))
    own = lambda c: F.get_json_object("slice", f"$.{c}")
    return found.select("message", own("Region").alias("region"), own("UtdNivaa").alias("education"), own("Fagfelt").alias("field"), "contents")


@query("slice_guards", f"SELECT contents_code, count(*) AS n, count(DISTINCT concat(region, '|', education, '|', field)) AS slices FROM ({X.REGIONAL}) o GROUP BY contents_code")
def _(spark, sf_dir):
    return X.regional(spark, sf_dir).groupBy("contents_code").agg(F.count("*").alias("n"), F.countDistinct(F.to_json(signals.slice_dimensions(F.col("dimensions")))).alias("slices"))


@query("exclude_categories", f"SELECT region = 'TOT' AS total, field_label = 'Uoppgitt' AS unspecified, count(*) AS n FROM ({X.REGIONAL}) o GROUP BY 1, 2")
def _(spark, sf_dir):
    obs = X.regional(spark, sf_dir)
    return obs.groupBy(signals.is_total_like(F.col("dimensions"), F.col("labels")).alias("total"), signals.has_unspecified(F.col("labels")).alias("unspecified")).agg(F.count("*").alias("n"))


@query("contents_label", f"SELECT DISTINCT contents_code, CASE contents_code WHEN 'Orders' THEN 'Number of orders' ELSE contents_code END AS label, CASE contents_code WHEN 'Orders' THEN 'x — ContentsCode: Number of orders (Orders)' ELSE concat('x — ContentsCode: ', contents_code) END AS signal_label FROM ({X.REGIONAL}) o")
def _(spark, sf_dir):
    obs = X.regional(spark, sf_dir)
    labels = F.create_map(F.lit("ContentsCode"), F.when(F.col("contents_code") == "Orders", "Number of orders"))
    label = signals.contents_label(F.col("contents_code"), labels)
    return obs.select("contents_code", label.alias("label"), signals.signal_label(F.lit("x"), F.col("contents_code"), label).alias("signal_label")).distinct()


def _snapshot(flat: str, keys: str, signal_type: str) -> str:
    return f"""SELECT {keys}, max(period) AS period, sum(value) AS value_end, count(*) AS n_values, string_agg(id, ',' ORDER BY id) AS ids, round_even(least(1.0, 0.45 + 0.12 * least(count(*), 20) / 20 + CASE WHEN count(*) >= 3 THEN 0.43 ELSE 0 END), 4) AS score
FROM ({flat}) o WHERE period = (SELECT max(period) FROM ({flat}) m) GROUP BY {keys} HAVING count(DISTINCT contents_code) = 1 AND count(DISTINCT unit) = 1"""


@query("occupation_structure_signal", "SELECT period AS periods_compared, occupation, value_end, ids AS source_observation_ids, score AS signal_quality_score FROM (" + _snapshot(X.OCCUPATION, "occupation", "") + ") s")
def _(spark, sf_dir):
    return signals.occupation_structure_signal(X.occupation(spark, sf_dir), CFG).select("periods_compared", dim("Yrke").alias("occupation"), "value_end", "source_observation_ids", "signal_quality_score")


@query("education_workforce_signal", "SELECT period AS periods_compared, education, hours, value_end, ids AS source_observation_ids, score AS signal_quality_score FROM (" + _snapshot(X.WORKFORCE, "education, hours", "") + ") s")
def _(spark, sf_dir):
    return signals.education_workforce_signal(X.workforce(spark, sf_dir), CFG).select("periods_compared", dim("UtdNivaa").alias("education"), dim("HeltidDeltid").alias("hours"), "value_end", "source_observation_ids", "signal_quality_score")


@query("snapshot_bucket_guard", f"SELECT occupation, CASE WHEN count(DISTINCT contents_code) > 1 THEN 'invalid_aggregation' END AS reject_reason, count(*) AS n_values FROM ({X.OCCUPATION}) o WHERE period = (SELECT max(period) FROM ({X.OCCUPATION}) m) GROUP BY occupation")
def _(spark, sf_dir):
    return signals.snapshot_buckets(X.occupation(spark, sf_dir), "09793", ("Yrke",), CFG).select(F.col("Yrke").alias("occupation"), "reject_reason", "n_values")


@query("drop_missing_sources", f"SELECT signal_deterministic_hash FROM ({_REGIONAL}) s WHERE source_observation_ids NOT LIKE '%FURNITURE%'")
def _(spark, sf_dir):
    obs = X.regional(spark, sf_dir)
    found = signals.regional_education_signal(obs, CFG)
    return signals.drop_missing_sources(found, obs.filter(~F.col("id").contains("FURNITURE"))).select("signal_deterministic_hash")


@query("lineage_and_notes")
def _(spark, sf_dir):
    return signals.employment_count_change(both(spark, sf_dir), CFG).select("signal_deterministic_hash", "signal_label", "explainability_note", "explainability_summary_json", "lineage_json")


@query("change_quality_score", f"SELECT region, education, field, contents_code AS contents, round_even(({_SCORE}) * CASE WHEN label_text LIKE '%uoppgitt%' THEN 0.55 ELSE 1 END * CASE WHEN region = 'TOT' THEN 0.35 ELSE 1 END, 4) AS score FROM ({_REGIONAL_PAIRS}) p WHERE NOT alone AND value_start <> 0")
def _(spark, sf_dir):
    pairs = signals.period_pairs(X.regional(spark, sf_dir)).filter(F.col("status") == "pair")
    labels, dims = F.col("end.labels"), F.col("end.dimensions")
    parts = quality.change_quality(F.col("value_start"), F.col("percent_change"), F.col("absolute_change"), CFG, signals.has_unspecified(labels), signals.is_total_like(dims, labels), F.lit(True), F.lit(True))
    return pairs.select(dims["Region"].alias("region"), dims["UtdNivaa"].alias("education"), dims["Fagfelt"].alias("field"), "contents", parts["score"].alias("score"))


@query("signals_ordered", _EMPLOYMENT)
def _(spark, sf_dir):
    return shown(quality.signals_ordered(signals.employment_count_change(both(spark, sf_dir), CFG)))


_TOP = "SELECT '{0}' AS sample, source_observation_ids FROM (SELECT * FROM s ORDER BY {1}, source_observation_ids LIMIT 20) t"


@query("review_samples", f"WITH s AS ({_EMPLOYMENT}) " + " UNION ALL ".join(_TOP.format(*x) for x in (("top_growth", "percent_change DESC"), ("top_decline", "percent_change"), ("unstable", "abs(percent_change) DESC, value_start"), ("low_quality", "signal_quality_score"))))
def _(spark, sf_dir):
    found = None
    for name, sample in quality.review_samples(signals.employment_count_change(both(spark, sf_dir), CFG), cap=20).items():
        own = sample.select(F.lit(name).alias("sample"), "source_observation_ids")
        found = own if found is None else found.unionByName(own)
    return found


@query("quality_histogram", f"SELECT CASE WHEN signal_quality_score < 0.2 THEN '0.0-0.2' WHEN signal_quality_score < 0.4 THEN '0.2-0.4' WHEN signal_quality_score < 0.6 THEN '0.4-0.6' WHEN signal_quality_score < 0.8 THEN '0.6-0.8' ELSE '0.8-1.0' END AS bin, count(*) AS n FROM ({_EMPLOYMENT}) s GROUP BY 1")
def _(spark, sf_dir):
    return quality.quality_histogram(signals.employment_count_change(both(spark, sf_dir), CFG))


@query("signal_counts", f"WITH s AS ({_EMPLOYMENT}) SELECT 'signal_type' AS kind, signal_type AS name, count(*) AS n FROM s GROUP BY 2 UNION ALL SELECT 'direction_label', direction_label, count(*) FROM s GROUP BY 2 UNION ALL SELECT 'table_id', table_id, count(*) FROM s GROUP BY 2")
def _(spark, sf_dir):
    return quality.signal_counts(signals.employment_count_change(both(spark, sf_dir), CFG))


# Reviewers' decisions: by the first hexadecimal digit of the hash; repeated lines, of which the last counts, and unknown hashes.
_DECISION = "CASE WHEN substr(h, 1, 1) IN ('0', '1') THEN 'reject' WHEN substr(h, 1, 1) IN ('2', '3') THEN 'quarantine' WHEN substr(h, 1, 1) = '4' THEN 'needs_more_review' ELSE 'approve_for_persistence' END"


def decisions_of(found: DataFrame) -> DataFrame:
    first = F.substring("signal_deterministic_hash", 1, 1)
    decision = F.when(first.isin("0", "1"), "reject").when(first.isin("2", "3"), "quarantine").when(first == "4", "needs_more_review").otherwise("approve_for_persistence")
    return found.filter(first != "f").select("signal_deterministic_hash", decision.alias("review_decision"), F.when(first.isin("5", "6"), "").otherwise("anna").alias("reviewer_id"), F.lit("checked").alias("review_notes"))


_DECIDED = f"""SELECT s.*, CASE WHEN substr(signal_deterministic_hash, 1, 1) = 'f' THEN 'not_review_approved' WHEN substr(signal_deterministic_hash, 1, 1) IN ('0', '1') THEN 'review_rejected' WHEN substr(signal_deterministic_hash, 1, 1) IN ('2', '3') THEN 'review_quarantined'
WHEN substr(signal_deterministic_hash, 1, 1) = '4' THEN 'review_needs_more' WHEN signal_quality_score < 0.8 THEN 'signal_quality_score' WHEN flags LIKE '%unstable_slice%' THEN 'blocked_quality_flags:unstable_slice' END AS reject_reason FROM ({_REGIONAL}) s"""


def regional_full(spark, sf_dir) -> DataFrame:
    return signals.regional_education_signal(X.regional(spark, sf_dir), CFG)


def decided(spark, sf_dir) -> DataFrame:
    found = regional_full(spark, sf_dir)
    return promotion.promotion_reject_reason(found, decisions_of(found))


@query("promotion_reject_reason", f"SELECT signal_deterministic_hash, CASE WHEN signal_quality_score < 0.8 THEN 'signal_quality_score' WHEN flags LIKE '%unstable_slice%' THEN 'blocked_quality_flags:preview_not_product_ready,unstable_slice' ELSE 'blocked_quality_flags:preview_not_product_ready' END AS reject_reason FROM ({_REGIONAL}) s")
def _(spark, sf_dir):
    return promotion.promotion_reject_reason(regional_full(spark, sf_dir)).select("signal_deterministic_hash", "reject_reason")


@query("promotion_thresholds", f"SELECT signal_deterministic_hash, CAST(50 AS DOUBLE) AS least_start, CAST(5 AS DOUBLE) AS least_change FROM ({_REGIONAL}) s")
def _(spark, sf_dir):
    start, change = promotion.promotion_thresholds()
    return regional_full(spark, sf_dir).select("signal_deterministic_hash", start.alias("least_start"), change.alias("least_change"))


@query("apply_decisions", f"SELECT signal_deterministic_hash, reject_reason FROM ({_DECIDED}) d")
def _(spark, sf_dir):
    return decided(spark, sf_dir).select("signal_deterministic_hash", "reject_reason")


@query("orphan_decisions", f"SELECT concat('x', signal_deterministic_hash) AS signal_deterministic_hash FROM ({_REGIONAL}) s WHERE substr(signal_deterministic_hash, 1, 1) = 'a'")
def _(spark, sf_dir):
    found = regional_full(spark, sf_dir)
    known = decisions_of(found)
    unknown = known.filter(F.col("signal_deterministic_hash").startswith("a")).withColumn("signal_deterministic_hash", F.concat(F.lit("x"), "signal_deterministic_hash"))
    return promotion.orphan_decisions(known.unionByName(unknown), found).select("signal_deterministic_hash")


@query("decision_counts", f"SELECT {_DECISION} AS review_decision, count(*) AS n FROM (SELECT signal_deterministic_hash AS h FROM ({_REGIONAL}) s) x WHERE substr(h, 1, 1) <> 'f' GROUP BY 1")
def _(spark, sf_dir):
    return promotion.decision_counts(decisions_of(regional_full(spark, sf_dir)))


@query("promotion_limit", f"SELECT signal_deterministic_hash FROM ({_DECIDED}) d WHERE reject_reason IS NULL ORDER BY source_observation_ids, signal_deterministic_hash LIMIT 10")
def _(spark, sf_dir):
    return promotion.promotion_limit(decided(spark, sf_dir).filter(F.col("reject_reason").isNull()), 10).select("signal_deterministic_hash")


@query("skip_persisted_hashes", f"SELECT signal_deterministic_hash, CASE WHEN substr(signal_deterministic_hash, 64, 1) IN ('0', '1', '2') THEN 'duplicate_hash_already_persisted' END AS reject_reason FROM ({_DECIDED}) d WHERE reject_reason IS NULL")
def _(spark, sf_dir):
    own = decided(spark, sf_dir).filter(F.col("reject_reason").isNull()).drop("reject_reason")
    store = own.filter(F.substring("signal_deterministic_hash", 64, 1).isin("0", "1", "2"))
    kept, rejects = promotion.skip_persisted_hashes(own, store)
    return kept.select("signal_deterministic_hash", F.lit(None).cast("string").alias("reject_reason")).unionByName(rejects.select("signal_deterministic_hash", "reject_reason"))


@query("require_observations", f"SELECT signal_deterministic_hash, CASE WHEN source_observation_ids LIKE '%BUILDING%' THEN concat('missing_observations:', source_observation_ids) END AS reject_reason FROM ({_DECIDED}) d WHERE reject_reason IS NULL")
def _(spark, sf_dir):
    own = decided(spark, sf_dir).filter(F.col("reject_reason").isNull()).drop("reject_reason")
    kept, rejects = promotion.require_observations(own, X.regional(spark, sf_dir).filter(~F.col("id").contains("BUILDING")))
    return kept.select("signal_deterministic_hash", F.lit(None).cast("string").alias("reject_reason")).unionByName(rejects.select("signal_deterministic_hash", "reject_reason"))


@query("build_signal_rows", f"SELECT sha256(concat('b1|', signal_deterministic_hash)) AS id, signal_deterministic_hash, split_part(periods_compared, '→', 1) AS period_start, split_part(periods_compared, '→', 2) AS period_end, signal_quality_score AS score FROM ({_DECIDED}) d WHERE reject_reason IS NULL")
def _(spark, sf_dir):
    rows = promotion.build_signal_rows(decided(spark, sf_dir).filter(F.col("reject_reason").isNull()), "b1")
    return rows.select("id", "signal_deterministic_hash", "period_start", "period_end", F.col("signal_quality_score").cast("double").alias("score"))


@query("build_batch_row", f"SELECT 'b1' AS batch_id, count(*) AS signals, count(DISTINCT signal_type) AS types FROM ({_DECIDED}) d WHERE reject_reason IS NULL")
def _(spark, sf_dir):
    return promotion.build_batch_row(promotion.build_signal_rows(decided(spark, sf_dir).filter(F.col("reject_reason").isNull()), "b1"), "b1")


@query("build_signal_sources", f"SELECT signal_deterministic_hash, o.id AS observation_id, o.period AS period, o.value AS value FROM ({_DECIDED}) d JOIN ({X.REGIONAL}) o ON o.id IN (split_part(d.source_observation_ids, ',', 1), split_part(d.source_observation_ids, ',', 2)) WHERE reject_reason IS NULL")
def _(spark, sf_dir):
    own = decided(spark, sf_dir).filter(F.col("reject_reason").isNull())
    return promotion.build_signal_sources(own, X.regional(spark, sf_dir)).select("signal_deterministic_hash", "observation_id", "period", "value")


@query("build_review_rows", f"SELECT signal_deterministic_hash, 'approve_for_persistence' AS review_decision, CASE WHEN substr(signal_deterministic_hash, 1, 1) IN ('5', '6') THEN 'system' ELSE 'anna' END AS reviewer_id, 'checked' AS review_notes FROM ({_DECIDED}) d WHERE reject_reason IS NULL")
def _(spark, sf_dir):
    found = regional_full(spark, sf_dir)
    own = promotion.promotion_reject_reason(found, decisions_of(found)).filter(F.col("reject_reason").isNull())
    return promotion.build_review_rows(own, decisions_of(found), "system")


@query("reject_reason_counts", f"SELECT coalesce(reject_reason, 'promoted') AS reject_reason, count(*) AS n FROM ({_DECIDED}) d GROUP BY 1")
def _(spark, sf_dir):
    return promotion.reject_reason_counts(decided(spark, sf_dir).withColumn("reject_reason", F.coalesce("reject_reason", F.lit("promoted"))))

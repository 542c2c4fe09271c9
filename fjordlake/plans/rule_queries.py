"""Registered queries that show rules where they differ: guards that fail, thresholds that fall back, dimensions without roles, explanations field by field."""

from __future__ import annotations

from pyspark.sql import functions as F

from fjordlake.operators import cube, promotion, signals
from fjordlake.plans import fixtures as X
from fjordlake.plans.signal_queries import _DIRECTION, _REASON, _REGIONAL_PAIRS, CFG, regional_full

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, oracle
        return f

    return add


_UNIT = "CASE WHEN education = 'FURNITURE' THEN ' ' WHEN education = 'BUILDING' THEN concat(unit, ' ') ELSE unit END"
_SIDE = lambda year, unit: f"SELECT region, education, field, contents_code, {unit} AS unit FROM ({X.REGIONAL}) o WHERE period = '{year}'"


@query("slice_guards_between", f"""SELECT a.region AS region_a, b.region AS region_b, a.education, a.field, a.contents_code AS contents_a, b.contents_code AS contents_b, a.region = b.region AS same_slice, a.contents_code = b.contents_code AS same_contents, trim(a.unit) = trim(b.unit) AS same_unit
FROM ({_SIDE('1996', 'unit')}) a JOIN ({_SIDE('1997', _UNIT)}) b ON a.education = b.education AND a.field = b.field WHERE a.region = 'EUROPE'""")
def _(spark, sf_dir):
    """One region's observations of a year against all regions' of the next, so that each guard holds and fails."""
    obs = X.regional(spark, sf_dir)
    name = lambda side, d: F.col(f"{side}.dimensions")[d]
    education = F.col("dimensions")["UtdNivaa"]
    spoilt = obs.withColumn("unit", F.when(education == "FURNITURE", " ").when(education == "BUILDING", F.concat("unit", F.lit(" "))).otherwise(F.col("unit")))
    a = obs.filter((F.col("period") == "1996") & (F.col("dimensions")["Region"] == "EUROPE")).select(F.struct(*obs.columns).alias("start"))
    b = spoilt.filter(F.col("period") == "1997").select(F.struct(*obs.columns).alias("end"))
    pairs = a.join(b, (name("start", "UtdNivaa") == name("end", "UtdNivaa")) & (name("start", "Fagfelt") == name("end", "Fagfelt")))
    return pairs.select(
        name("start", "Region").alias("region_a"), name("end", "Region").alias("region_b"), name("start", "UtdNivaa").alias("education"), name("start", "Fagfelt").alias("field"), F.col("start.contents_code").alias("contents_a"), F.col("end.contents_code").alias("contents_b"),
        *(c.alias(k) for k, c in signals.slice_guards().items()),
    )


_AT = "source_observation_ids LIKE '%{}%'".format
_REGIONAL_SHORT = f"SELECT concat(id_start, ',', id_end) AS source_observation_ids FROM ({_REGIONAL_PAIRS}) p WHERE {_REASON} IS NULL"


@query("promotion_threshold_fallbacks", f"SELECT source_observation_ids, CAST(CASE WHEN {_AT('ASIA')} THEN 70 WHEN {_AT('EUROPE')} OR {_AT('AFRICA')} THEN 100 ELSE 50 END AS DOUBLE) AS least_start, CAST(CASE WHEN {_AT('ASIA')} OR {_AT('EUROPE')} OR {_AT('AFRICA')} THEN 10 ELSE 5 END AS DOUBLE) AS least_change FROM ({_REGIONAL_SHORT}) s")
def _(spark, sf_dir):
    """By region: the explanation's thresholds, the row's, and the fixed ones where the row's is missing or 0, or the explanation says no number."""
    at = lambda r: F.col("source_observation_ids").contains(r)
    rows = regional_full(spark, sf_dir).withColumns({
        "explainability_summary_json": F.when(at("ASIA"), "{}").when(at("EUROPE"), F.lit(None).cast("string")).when(at("AFRICA"), '{"thresholds_applied":{"min_baseline":"none","min_absolute_change":null}}').otherwise(F.col("explainability_summary_json")),
        "min_baseline": F.when(at("ASIA"), 70.0).when(at("EUROPE"), 0.0).otherwise(F.when(~at("AFRICA"), F.col("min_baseline"))),
    })
    start, change = promotion.promotion_thresholds()
    return rows.select("source_observation_ids", start.alias("least_start"), change.alias("least_change"))


_NTH = "o_orderkey % 5"


@query("dimensions_without_roles", f"SELECT o_orderkey, CASE {_NTH} WHEN 0 THEN 'When' WHEN 1 THEN 'TID' WHEN 2 THEN 'År' WHEN 3 THEN 'aar' END AS time, CASE {_NTH} WHEN 0 THEN 'ContentsCode' WHEN 1 THEN 'What' WHEN 2 THEN 'StatistikkVariabel' END AS metric FROM orders")
def _(spark, sf_dir):
    """Roles first, then known names in any case, then none."""
    key = F.col("o_orderkey") % 5
    names = lambda *n: F.array(*(F.lit(x) for x in n))
    ids = F.when(key == 0, names("Region", "When", "ContentsCode", "Tid")).when(key == 1, names("What", "TID", "aar")).when(key == 2, names("År", "StatistikkVariabel")).when(key == 3, names("aar", "Region")).otherwise(names("Region", "Year"))
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", ids.alias("id"), F.when(key == 0, names("When")).when(key == 1, F.array().cast("array<string>")).alias("role_time"), F.when(key == 1, names("What")).alias("role_metric"))
    return rows.select("o_orderkey", cube.time_dimension().alias("time"), cube.metric_dimension().alias("metric"))


@query("explanation_fields", f"SELECT concat(id_start, ',', id_end) AS source_observation_ids, period_start, period_end, 'Fagfelt,Region,UtdNivaa' AS dimensions, CAST(50 AS DOUBLE) AS min_baseline, CAST(5 AS DOUBLE) AS min_change, CAST(5 AS DOUBLE) AS growth, {_DIRECTION} AS direction, round_even(percent_change, 6) AS percent_change, concat('Direct two-period comparison ', period_start, '→', period_end, '.') AS note_begins FROM ({_REGIONAL_PAIRS}) p WHERE {_REASON} IS NULL")
def _(spark, sf_dir):
    part = lambda c: F.get_json_object("explainability_summary_json", f"$.{c}")
    return regional_full(spark, sf_dir).select(
        "source_observation_ids", part("periods.start").alias("period_start"), part("periods.end").alias("period_end"), F.array_join(F.from_json(part("dimensions_included"), "array<string>"), ",").alias("dimensions"),
        part("thresholds_applied.min_baseline").cast("double").alias("min_baseline"), part("thresholds_applied.min_absolute_change").cast("double").alias("min_change"), part("thresholds_applied.growth_pct_min").cast("double").alias("growth"),
        part("direction_result").alias("direction"), part("percent_change").cast("double").alias("percent_change"), F.substring_index("explainability_note", " Values", 1).alias("note_begins"),
    )

"""Registered queries of cubes, checks and the source registry, with their DuckDB forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjordlake.functions import columns as L
from fjordlake.operators import checks, cube, registry
from fjordlake.plans import fixtures as X
from fjordlake.sources import files

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


# Cells of a cube Region x UtdNivaa x ContentsCode x Tid; those of one region and year are missing.
_CELLS = f"SELECT region, education, contents_code, period, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM ({X.REGIONAL}) o WHERE NOT (region = 'ASIA' AND period = '1995') GROUP BY region, education, contents_code, period"
_FACTS = f"""SELECT *, sha256(concat('{{"contents_code":"', contents_code, '","dimensions":[["Region","', region, '"],["UtdNivaa","', education, '"],["ContentsCode","', contents_code, '"],["Tid","', period, '"]],"normalization_version":"n1","period":"', period, '","source_file":"11615.json","table_id":"11615"}}')) AS signature FROM ({_CELLS}) c"""
_AXES = {"Region": "region", "UtdNivaa": "education", "ContentsCode": "contents_code", "Tid": "period"}


def cubes(spark, sf_dir) -> DataFrame:
    """One cube made of the cells: codes by alphabet, a label for each, a unit for each measure."""
    cells = X.view(spark, sf_dir, _CELLS)
    every = cells.agg(*(F.collect_set(column).alias(column) for column in _AXES.values()))  # a few codes each
    for column in _AXES.values():
        every = every.withColumn(column, F.explode(column))
    placed = every.join(cells, list(_AXES.values()), "left")
    values = F.transform(F.array_sort(F.collect_list(F.struct(*_AXES.values(), "value"))), lambda x: x["value"])
    codes = {name: F.array_sort(F.collect_set(column)) for name, column in _AXES.items()}
    grouped = placed.agg(values.alias("value"), *(c.alias(f"codes_{n}") for n, c in codes.items()))
    label = {"Region": lambda c: F.when(c == "TOT", "Hele landet").otherwise(c), "UtdNivaa": F.lower, "ContentsCode": lambda c: F.concat(F.lit("Number of "), c), "Tid": lambda c: c}

    def dimension(name):
        own = F.col(f"codes_{name}")
        as_map = lambda f: F.map_from_entries(F.transform(own, lambda c, i: F.struct(c, f(c, i))))
        unit = as_map(lambda c, i: F.struct(F.when(c == "Orders", "pcs").alias("base"), F.when(c == "Revenue", "money").alias("label")))
        category = F.struct(as_map(lambda c, i: i).alias("index"), as_map(lambda c, i: label[name](c)).alias("label"), (unit if name == "ContentsCode" else F.lit(None).cast("map<string,struct<base:string,label:string>>")).alias("unit"))
        return F.struct(F.lit(name).alias("label"), category.alias("category"))

    return grouped.select(
        F.lit("11615").alias("table_id"), F.lit("11615.json").alias("source_file"), F.lit("Orders by region").alias("label"), F.array(*(F.lit(n) for n in _AXES)).alias("id"), F.array(*(F.size(f"codes_{n}") for n in _AXES)).alias("size"),
        F.array(F.lit("Tid")).alias("role_time"), F.lit(None).cast("array<string>").alias("role_metric"), F.create_map(*(x for n in _AXES for x in (F.lit(n), dimension(n)))).alias("dimension"), "value",
    )


def facts(spark, sf_dir) -> DataFrame:
    return cube.cube_flatten(cubes(spark, sf_dir))


def axes(frame: DataFrame, *more) -> DataFrame:
    return frame.select(*(F.col("dimensions")[n].alias(c) for n, c in _AXES.items()), *more)


@query("cube_flatten", f"SELECT region, education, contents_code, period, value, signature AS observation_signature, CASE contents_code WHEN 'Orders' THEN 'pcs' ELSE 'money' END AS unit FROM ({_FACTS}) f")
def _(spark, sf_dir):
    return axes(facts(spark, sf_dir), "value", "observation_signature", "unit")


_EVERY = f"(SELECT DISTINCT region FROM ({_CELLS}) a) CROSS JOIN (SELECT DISTINCT education FROM ({_CELLS}) b) CROSS JOIN (SELECT DISTINCT contents_code FROM ({_CELLS}) c) CROSS JOIN (SELECT DISTINCT period FROM ({_CELLS}) d)"


@query("cube_flatten_lenient", f"SELECT region, education, contents_code, period, value FROM {_EVERY} LEFT JOIN ({_CELLS}) v USING (region, education, contents_code, period)")
def _(spark, sf_dir):
    return axes(cube.cube_flatten(cubes(spark, sf_dir), lenient=True), "value")


@query("skipped_nulls", f"SELECT '11615' AS table_id, '11615.json' AS source_file, CAST((SELECT count(*) FROM {_EVERY}) - count(*) AS INT) AS skipped FROM ({_CELLS}) v")
def _(spark, sf_dir):
    return cube.skipped_nulls(cubes(spark, sf_dir))


@query("dimension_positions", f"SELECT region AS code, CAST(row_number() OVER (ORDER BY region) - 1 AS INT) AS place FROM (SELECT DISTINCT region FROM ({_CELLS}) c) r")
def _(spark, sf_dir):
    return cubes(spark, sf_dir).select(F.posexplode(cube.dimension_positions(F.col("dimension")["Region"])).alias("place", "code"))


@query("time_and_metric_dimension", "SELECT 'Tid' AS time, 'ContentsCode' AS metric")
def _(spark, sf_dir):
    return cubes(spark, sf_dir).select(cube.time_dimension().alias("time"), cube.metric_dimension().alias("metric"))


@query("unit_for_cell", f"SELECT DISTINCT contents_code, CASE contents_code WHEN 'Orders' THEN 'pcs' ELSE 'money' END AS unit FROM ({_CELLS}) c")
def _(spark, sf_dir):
    return facts(spark, sf_dir).select("contents_code", "unit").distinct()


@query("label_lookup", f"SELECT DISTINCT region, CASE region WHEN 'TOT' THEN 'Hele landet' ELSE region END AS label, lower(education) AS education_label FROM ({_CELLS}) c")
def _(spark, sf_dir):
    return facts(spark, sf_dir).select(F.col("dimensions")["Region"].alias("region"), F.col("labels")["Region"].alias("label"), F.col("labels")["UtdNivaa"].alias("education_label")).distinct()


@query("total_flag", f"SELECT region, region = 'TOT' AS is_total, count(*) AS n FROM ({_CELLS}) c GROUP BY region")
def _(spark, sf_dir):
    return facts(spark, sf_dir).groupBy(F.col("dimensions")["Region"].alias("region"), cube.total_flag(F.col("dimensions")["Region"], F.col("labels")["Region"]).alias("is_total")).agg(F.count("*").alias("n"))


@query("period_bounds", f"SELECT o_orderkey, CASE WHEN regexp_full_match(period, '[0-9]{{4}}') THEN make_date(CAST(period AS INT), 1, 1) END AS period_start, CASE WHEN regexp_full_match(period, '[0-9]{{4}}') THEN make_date(CAST(period AS INT), 12, 31) END AS period_end FROM ({X.PERIODS}) p")
def _(spark, sf_dir):
    start, end = cube.period_bounds(F.col("period"))
    return X.view(spark, sf_dir, X.PERIODS).select("o_orderkey", start.alias("period_start"), end.alias("period_end"))


@query("observation_signature", f"SELECT signature AS observation_signature FROM ({_FACTS}) f")
def _(spark, sf_dir):
    return facts(spark, sf_dir).select("observation_signature")


def _union(texts: list[str]) -> str:
    return " UNION ALL ".join(texts)


@query("dimension_catalog_values", _union([f"SELECT '{n.lower()}' AS dimension, code, CAST(row_number() OVER (ORDER BY code) - 1 AS INT) AS sort_order, code = 'TOT' AS is_total FROM (SELECT DISTINCT {c} AS code FROM ({_CELLS}) x) y" for n, c in _AXES.items()]))
def _(spark, sf_dir):
    return cube.dimension_catalog(cubes(spark, sf_dir))[1].select("dimension", "code", "sort_order", "is_total")


@query("dimension_catalog", _union([f"SELECT '{n.lower()}' AS slug, '{n}' AS name, '{n}' AS label" for n in _AXES]))
def _(spark, sf_dir):
    return cube.dimension_catalog(cubes(spark, sf_dir))[0]


@query("cube_profile", f"""SELECT '11615' AS table_id, e.n AS "rows", e.n - (SELECT count(*) FROM ({_CELLS}) v) AS missing_values, 'Region,UtdNivaa,ContentsCode,Tid' AS dimensions, concat('ContentsCode=', count(DISTINCT contents_code), ',Region=', count(DISTINCT region), ',Tid=', count(DISTINCT period), ',UtdNivaa=', count(DISTINCT education)) AS cardinality, true AS has_time, true AS fits_shared_model FROM ({_CELLS}) c, (SELECT count(*) AS n FROM {_EVERY}) e GROUP BY e.n""")
def _(spark, sf_dir):
    return cube.cube_profile(cubes(spark, sf_dir))


@query("combined_preview", f"SELECT table_id, period, contents_code, value, region AS dim_Region, CAST(NULL AS VARCHAR) AS dim_NACE2007, education AS dim_UtdNivaa FROM ({X.REGIONAL}) a UNION ALL SELECT table_id, period, contents_code, value, NULL, industry, education FROM ({X.INDUSTRY}) b")
def _(spark, sf_dir):
    return cube.combined_preview([X.regional(spark, sf_dir), X.industry(spark, sf_dir)], ["Region", "NACE2007", "UtdNivaa"])


@query("latest_periods_slice", f"SELECT id, period, value FROM ({X.REGIONAL}) o WHERE region = 'TOT' AND education = (SELECT min(education) FROM ({X.REGIONAL}) e) AND field = (SELECT min(field) FROM ({X.REGIONAL}) f) AND period IN (SELECT period FROM (SELECT DISTINCT period FROM ({X.REGIONAL}) q ORDER BY period DESC LIMIT 3) w)")
def _(spark, sf_dir):
    return cube.latest_periods_slice(X.regional(spark, sf_dir), 3).select("id", "period", "value")


@query("check_cartesian", f"SELECT '11615' AS table_id, '11615.json' AS source_file, n AS expected, n AS found, true AS matches FROM (SELECT count(*) AS n FROM {_EVERY}) e")
def _(spark, sf_dir):
    return cube.check_cartesian(cubes(spark, sf_dir))


# Facts with faults, by region and year: a blank label, an unknown code, no batch, a repeated signature.
_BLANK, _UNKNOWN, _NO_BATCH, _REPEATED = "region = 'AFRICA'", "region = 'EUROPE' AND period = '1996'", "region = 'ASIA' AND contents_code = 'Orders'", "region = 'AMERICA' AND period = '1997'"


def faulty(spark, sf_dir) -> DataFrame:
    found = facts(spark, sf_dir)
    region, period = F.col("dimensions")["Region"], F.col("period")
    marked = found.withColumn("labels", F.when(region == "AFRICA", F.map_concat(L.without_keys(F.col("labels"), ["Region"]), F.create_map(F.lit("Region"), F.lit(" ")))).otherwise(F.col("labels")))
    marked = marked.withColumn("ingestion_batch_id", F.when(~((region == "ASIA") & (F.col("contents_code") == "Orders")), F.col("ingestion_batch_id")))
    return marked.unionByName(marked.filter((region == "AMERICA") & (period == "1997")))


def catalog(spark, sf_dir) -> DataFrame:
    """Known values but for one region in one year, which the check finds by a key of both."""
    known = facts(spark, sf_dir).select("id", F.explode("dimensions").alias("dimension", "code")).select("dimension", "code").distinct()
    return known.filter(F.col("code") != "EUROPE")


_FAULTY = f"SELECT * FROM ({_FACTS}) f UNION ALL SELECT * FROM ({_FACTS}) g WHERE {_REPEATED}"
_FINDINGS = {
    "missing_labels": ("warning", f"SELECT count(*) AS n FROM ({_FAULTY}) x WHERE {_BLANK}"),
    "missing_dimension_ids": ("warning", f"SELECT count(DISTINCT signature) AS n FROM ({_FAULTY}) x WHERE region = 'EUROPE'"),
    "lineage_incomplete": ("warning", f"SELECT count(*) AS n FROM ({_FAULTY}) x WHERE {_NO_BATCH}"),
    "duplicate_signatures": ("hard_fail", f"SELECT count(*) AS n FROM ({_FACTS}) x WHERE {_REPEATED}"),
}


@query("check_missing_labels", f"SELECT '11615' AS table_id, n FROM ({_FINDINGS['missing_labels'][1]}) z")
def _(spark, sf_dir):
    return checks.check_missing_labels(faulty(spark, sf_dir))


@query("check_dimension_ids", f"SELECT '11615' AS table_id, n FROM ({_FINDINGS['missing_dimension_ids'][1]}) z")
def _(spark, sf_dir):
    return checks.check_dimension_ids(faulty(spark, sf_dir), catalog(spark, sf_dir))


@query("check_lineage", f"SELECT '11615' AS table_id, count(*) FILTER (WHERE NOT ({_NO_BATCH})) AS complete, count(*) FILTER (WHERE {_NO_BATCH}) AS incomplete FROM ({_FAULTY}) x")
def _(spark, sf_dir):
    return checks.check_lineage(faulty(spark, sf_dir))


@query("check_duplicate_signatures", f"SELECT '11615' AS table_id, n FROM ({_FINDINGS['duplicate_signatures'][1]}) z")
def _(spark, sf_dir):
    return checks.check_duplicate_signatures(faulty(spark, sf_dir))


@query("validation_report", _union([f"SELECT '11615' AS table_id, '{k}' AS finding, '{s}' AS severity, n, 'failed' AS status FROM ({sql}) z" for k, (s, sql) in _FINDINGS.items()]))
def _(spark, sf_dir):
    return checks.validation_report(faulty(spark, sf_dir), catalog(spark, sf_dir))


def store(spark, sf_dir) -> DataFrame:
    return facts(spark, sf_dir).filter(F.col("period") < "1997")


@query("existing_row_context", f"SELECT '11615' AS table_id, '11615.json' AS source_file, count(*) AS stored FROM ({_CELLS}) c WHERE period < '1997'")
def _(spark, sf_dir):
    return checks.existing_row_context(store(spark, sf_dir), facts(spark, sf_dir))


@query("skip_existing_signatures", f"SELECT signature AS observation_signature FROM ({_FACTS}) f WHERE period >= '1997'")
def _(spark, sf_dir):
    return checks.skip_existing_signatures(facts(spark, sf_dir), store(spark, sf_dir), skip=True)[0].select("observation_signature")


@query("existing_signatures_fail", f"SELECT '11615' AS table_id, 'existing_signatures' AS finding, 'hard_fail' AS severity, count(*) AS n FROM ({_CELLS}) c WHERE period < '1997'")
def _(spark, sf_dir):
    kept, findings = checks.skip_existing_signatures(facts(spark, sf_dir), store(spark, sf_dir), skip=False)
    return findings.join(kept, "table_id", "left_anti")


@query("backfill_signature", f"SELECT signature AS observation_signature, CASE WHEN region = 'ASIA' THEN signature WHEN region = 'EUROPE' THEN concat('m', period) WHEN region = 'AFRICA' THEN concat('r', period) END AS found FROM ({_FACTS}) f")
def _(spark, sf_dir):
    region = F.col("dimensions")["Region"]
    json = lambda c: F.to_json(F.struct(c.alias("observation_signature")))
    marked = facts(spark, sf_dir).withColumn("true_signature", F.col("observation_signature")).withColumn("metadata_json", F.when(region == "EUROPE", json(F.concat(F.lit("m"), "period"))).otherwise("{}")).withColumn("raw_observation_json", F.when(region == "AFRICA", json(F.concat(F.lit(" r"), "period"))))
    marked = marked.withColumn("observation_signature", F.when(region == "ASIA", F.col("observation_signature")).when(region == "EUROPE", " "))
    return marked.select(F.col("true_signature").alias("observation_signature"), checks.signature_of().alias("found"))


@query("review_decisions", f"""SELECT signal_deterministic_hash, max_by(review_decision, line) AS review_decision, max_by(reviewer_id, line) AS reviewer_id FROM (SELECT o_orderkey AS line, concat('h', o_custkey) AS signal_deterministic_hash, CASE o_orderkey % 4 WHEN 0 THEN 'reject' WHEN 1 THEN 'quarantine' WHEN 2 THEN 'approve_for_persistence' ELSE 'maybe' END AS review_decision, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('r', o_orderkey % 5) END AS reviewer_id FROM orders) d
WHERE review_decision <> 'maybe' AND NOT (review_decision = 'approve_for_persistence' AND reviewer_id = '') GROUP BY signal_deterministic_hash""")
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    decision = F.when(key % 4 == 0, "reject").when(key % 4 == 1, " quarantine ").when(key % 4 == 2, "approve_for_persistence").otherwise("maybe")
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(key.alias("line"), F.concat(F.lit(" h"), F.col("o_custkey").cast("string")).alias("signal_deterministic_hash"), decision.alias("review_decision"), F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("r"), (key % 5).cast("string"))).alias("reviewer_id"), F.lit("2024").alias("reviewed_at"), F.lit("").alias("review_notes"))
    return files.judged_decisions(rows)[0].select("signal_deterministic_hash", "review_decision", "reviewer_id")


@query("pick_columns", f"SELECT row_no, coalesce(name, sheet) AS picked, url AS address FROM ({X.SOURCES}) s")
def _(spark, sf_dir):
    rows = X.view(spark, sf_dir, X.SOURCES)
    sheet = rows.select("row_no", F.col("name").alias("Navn "), F.col("url").alias("Kilde URL"), F.col("sheet").alias("kort beskrivelse"))
    return sheet.select("row_no", registry.pick_columns(sheet.drop("row_no", "Kilde URL"), registry.NAME_KEYS).alias("picked"), registry.pick_columns(sheet, registry.URL_KEYS).alias("address"))


_DIGEST = """substr(sha256(concat('{"layer":"layer","row":{"name":', CASE WHEN name IS NULL THEN 'null' ELSE concat('"', name, '"') END, '},"sheet":"', sheet, '"}')), 1, 16)"""
_SLUG = f"CASE WHEN name IS NULL THEN concat('emp-demand-', sheet, '-', {_DIGEST}) ELSE concat('emp-demand-', replace(lower(name), ' ', '-'), '-', substr({_DIGEST}, 1, 8)) END"


def slugged(spark, sf_dir) -> DataFrame:
    rows = X.view(spark, sf_dir, X.SOURCES)
    digest = registry.content_hash(rows.select("name"), F.col("layer"), F.col("sheet"))
    return rows.withColumn("slug", registry.source_slug(F.col("name"), "emp-demand", F.col("sheet"), digest)).withColumn("kind", F.lit(None).cast("string"))


@query("source_slug", f"SELECT row_no, {_SLUG} AS slug FROM ({X.SOURCES}) s")
def _(spark, sf_dir):
    return slugged(spark, sf_dir).select("row_no", "slug")


_KNOWN = "row_no % 4 = 0"


def upserted(spark, sf_dir):
    rows = slugged(spark, sf_dir)
    known = rows.filter(F.col("row_no") % 4 == 0).groupBy("slug").agg(F.lit("old").alias("name"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("kind"))
    return registry.upsert_sources(rows.select("slug", "name", "url", "kind", "row_no"), known)


@query("upsert_sources", f"SELECT slug, max_by(coalesce(name, ''), row_no) AS name, max_by(url, row_no) AS url FROM (SELECT *, {_SLUG} AS slug FROM ({X.SOURCES}) s) t GROUP BY slug")
def _(spark, sf_dir):
    return upserted(spark, sf_dir)[0].select("slug", F.coalesce("name", F.lit("")).alias("name"), "url")


@query("upsert_sources_datasets", f"SELECT DISTINCT slug AS source_slug, concat(slug, '::primary') AS external_id, 'file' AS access_method, 'pending' AS ingestion_status FROM (SELECT *, {_SLUG} AS slug FROM ({X.SOURCES}) s) t")
def _(spark, sf_dir):
    return upserted(spark, sf_dir)[1].select("source_slug", "external_id", "access_method", "ingestion_status")


@query("upsert_sources_counts", f"SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN slug IN (SELECT {_SLUG} FROM ({X.SOURCES}) k WHERE {_KNOWN}) OR row_number() OVER (PARTITION BY slug ORDER BY row_no) > 1 THEN 'updated' ELSE 'inserted' END AS outcome FROM (SELECT *, {_SLUG} AS slug FROM ({X.SOURCES}) s) t) u GROUP BY outcome")
def _(spark, sf_dir):
    return upserted(spark, sf_dir)[2]


@query("dataset_upsert", "SELECT 'table-11615' AS slug, 'Orders by region' AS title, 'https://data.example/11615' AS access_url, 'ContentsCode,Region,Tid,UtdNivaa' AS names UNION ALL SELECT 'table-1', 'Other', 'https://data.example/1', NULL FROM (SELECT 1) x WHERE (SELECT count(*) FROM orders) > 0")
def _(spark, sf_dir):
    known = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.count("*").alias("n")).filter("n > 0").select(F.explode(F.array(F.struct(F.lit("table-1").alias("slug"), F.lit("Other").alias("title"), F.lit("https://data.example/1").alias("access_url")), F.struct(F.lit("table-11615").alias("slug"), F.lit("Old").alias("title"), F.lit("x").alias("access_url")))).alias("x")).select("x.*")
    return registry.dataset_upsert(cubes(spark, sf_dir), known, "https://data.example/").select("slug", "title", "access_url", F.array_join("dimension_names", ",").alias("names"))


@query("drop_blank_rows", f"SELECT count(*) AS n FROM ({X.SOURCES}) s WHERE name IS NOT NULL")
def _(spark, sf_dir):
    return registry.drop_blank_rows(X.view(spark, sf_dir, X.SOURCES).select("name", F.lit(" ").alias("note"))).agg(F.count("*").alias("n"))


@query("scalar_functions", """SELECT o_orderkey, nullif(trim(t), '') AS blank_null, TRY_CAST(CASE WHEN regexp_full_match(substr(trim(t), 1, 10), '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN substr(trim(t), 1, 10) END AS DATE) AS day, CAST(CASE WHEN t = '12.5' THEN 12.5 END AS DOUBLE) AS number,
CAST(least(pow(2, least(o_orderkey % 12, 8)), 360) AS INT) AS backoff, concat(t, ':UNKNOWN:unversioned') AS event_id, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey // 4 AS VARCHAR) ELSE CAST(o_orderkey / 4 AS VARCHAR) END AS whole FROM (
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN concat(strftime(o_orderdate, '%Y-%m-%d'), 'T00:00') WHEN 1 THEN '  ' WHEN 2 THEN 'x' WHEN 3 THEN '12.5' END AS t FROM orders) o WHERE t IS NOT NULL""")
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    text = F.when(key % 5 == 0, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00"))).when(key % 5 == 1, "  ").when(key % 5 == 2, "x").when(key % 5 == 3, "12.5")
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("t", text).filter(F.col("t").isNotNull())
    return rows.select("o_orderkey", L.blank_to_null(F.col("t")).alias("blank_null"), L.safe_date(F.col("t")).alias("day"), L.safe_decimal(F.col("t")).cast("double").alias("number"), L.backoff_minutes(key % 12).alias("backoff"), L.source_event_id(F.col("t"), F.lit(None), F.lit(None)).alias("event_id"), L.whole_number_text(key / 4).alias("whole"))

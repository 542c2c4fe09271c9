"""Views over the test tables, as SQL that Spark and DuckDB both read; the queries and their oracles share it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = "2024-02-01 00:00:00"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")

_ORDERS = """SELECT year(o_orderdate) AS y, r_name, c_mktsegment, o_orderpriority, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

# Each order counts for its region and for the whole, each cell for both measures; `view` turns the list's form into Spark's.
_PLACES = f"""SELECT y, CASE k WHEN 0 THEN r_name ELSE 'TOT' END AS region, CASE k WHEN 0 THEN r_name ELSE 'Hele landet' END AS region_label, c_mktsegment AS education, o_orderpriority AS field, price
FROM (SELECT a.*, unnest(list_value(0, 1)) AS k FROM ({_ORDERS}) AS a) AS b"""

_CELLS = f"""SELECT y, region, region_label, education, field, count(*) AS n, CAST(sum(price) AS DOUBLE) AS revenue FROM ({_PLACES}) AS p GROUP BY y, region, region_label, education, field"""

#: Observations of table 11615: one row for each region, education, field, year and measure.
REGIONAL = f"""SELECT concat('11615|', CAST(y AS STRING), '|', contents_code, '|', region, '|', education, '|', field) AS id, '11615' AS table_id, CAST(y AS STRING) AS period, contents_code, CASE contents_code WHEN 'Orders' THEN 'orders' ELSE 'money' END AS unit,
CASE contents_code WHEN 'Orders' THEN CAST(n AS DOUBLE) ELSE revenue END AS value, region, region_label, education, field, CASE WHEN field = '4-NOT SPECIFIED' THEN 'Uoppgitt' ELSE field END AS field_label
FROM (SELECT c.*, unnest(list_value('Orders', 'Revenue')) AS contents_code FROM ({_CELLS}) AS c) AS d"""

#: Table 12850: industries by education and year.
INDUSTRY = """SELECT concat('12850|', CAST(y AS STRING), '|Lines|', industry, '|', education) AS id, '12850' AS table_id, CAST(y AS STRING) AS period, 'Lines' AS contents_code, 'lines' AS unit, CAST(count(*) AS DOUBLE) AS value, industry, education
FROM (SELECT year(l_shipdate) AS y, l_returnflag AS industry, c_mktsegment AS education FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey) AS i GROUP BY y, industry, education"""

#: Table 09793: occupations by age class and year; one measure for most brands, two for brands that end in 5.
OCCUPATION = """SELECT concat('09793|', CAST(y AS STRING), '|', measure, '|', occupation, '|', age) AS id, '09793' AS table_id, CAST(y AS STRING) AS period, measure AS contents_code, 'lines' AS unit, CAST(count(*) AS DOUBLE) AS value, occupation, age
FROM (SELECT year(l_shipdate) AS y, p_brand AS occupation, l_linestatus AS age, CASE WHEN p_brand LIKE '%5' AND l_linenumber = 1 THEN 'First' ELSE 'Lines' END AS measure FROM lineitem JOIN part ON l_partkey = p_partkey) AS i GROUP BY y, occupation, age, measure"""

#: Table 08417: education by full or part time and year.
WORKFORCE = f"""SELECT concat('08417|', CAST(y AS STRING), '|Orders|', hours, '|', education) AS id, '08417' AS table_id, CAST(y AS STRING) AS period, 'Orders' AS contents_code, 'orders' AS unit, CAST(count(*) AS DOUBLE) AS value, hours, education
FROM (SELECT y, o_orderstatus AS hours, c_mktsegment AS education FROM ({_ORDERS}) AS o) AS w GROUP BY y, hours, education"""

#: Periods in every form, by a modulus of the order key.
PERIODS = """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CAST(year(o_orderdate) AS STRING) WHEN 1 THEN concat(CAST(year(o_orderdate) AS STRING), 'K', CAST(quarter(o_orderdate) AS STRING)) WHEN 2 THEN CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING) WHEN 3 THEN 'n/a' WHEN 4 THEN concat(CAST(year(o_orderdate) AS STRING), 'k', CAST(quarter(o_orderdate) + 3 AS STRING)) END AS period FROM orders"""

_EVENT = """SELECT concat('j', CAST(user_id * 10 + event_id % 10 AS STRING)) AS external_id, event_id * 2 AS seq, event_id,
CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 7 = 0 THEN CAST(ts AS TIMESTAMP) - INTERVAL 2 DAY ELSE CAST(ts AS TIMESTAMP) END AS version,
CASE WHEN event_type = 'error' THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('Title ', CAST(event_id % 17 AS STRING)) END AS title,
CASE WHEN event_id % 6 = 0 THEN NULL ELSE concat('Company ', CAST(user_id % 50 AS STRING)) END AS company_name,
CASE WHEN event_id % 4 = 0 THEN NULL ELSE concat('Place ', CAST(event_id % 5 AS STRING)) END AS location,
concat('/jobs/', CAST(user_id AS STRING)) AS url,
CASE WHEN event_type = 'signup' THEN CAST(ts AS TIMESTAMP) END AS published_at,
CASE WHEN event_id % 9 = 0 THEN CAST(ts AS TIMESTAMP) + INTERVAL 60 DAY END AS expires_at,
CASE WHEN event_type = 'purchase' THEN CAST(CAST(ts AS TIMESTAMP) + INTERVAL 30 DAY AS DATE) END AS application_due,
CASE WHEN event_id % 5 <> 0 THEN concat('d', CAST(event_id % 13 AS STRING)) END AS detail
FROM events"""

#: Feed events with late, unversioned and repeated ones; seq is the order of the feed.
EVENTS = f"""SELECT e.*, concat(external_id, ':', status, ':', coalesce(CAST(event_id AS STRING), 'unversioned')) AS source_event_id FROM (
{_EVENT} UNION ALL SELECT external_id, seq + 1 AS seq, event_id, version, status, title, company_name, location, url, published_at, expires_at, application_due, detail FROM ({_EVENT}) AS r WHERE event_id % 11 = 0) AS e"""

#: Scalars that a merge keeps, in a fixed order.
SCALARS = ("title", "company_name", "location", "url", "status", "published_at", "expires_at", "application_due", "detail")

#: A posting for each key: its newest event.
POSTINGS = f"""SELECT external_id, title, company_name, location, url, status, published_at, expires_at, application_due, detail, version AS source_event_version, source_event_id, seq, version AS event_modified_at, updated_at FROM (
SELECT e.*, version + INTERVAL 1 DAY AS updated_at, row_number() OVER (PARTITION BY external_id ORDER BY seq DESC) AS nth FROM ({EVENTS}) AS e) AS p WHERE nth = 1"""

RETRY = """SELECT concat('o', CAST(o_orderkey AS STRING)) AS external_id, CASE WHEN o_orderkey % 12 >= 10 THEN 'abandoned' WHEN o_orderkey % 5 = 0 THEN 'resolved' ELSE 'pending' END AS status, CAST(o_orderkey % 12 AS INT) AS attempt_count, CAST(o_orderdate AS TIMESTAMP) AS next_attempt_at FROM orders"""

RUNS = """SELECT o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 SECOND * (o_orderkey % 80000) AS started_at, CASE o_orderkey % 3 WHEN 0 THEN 'sync' WHEN 1 THEN 'retry' ELSE 'reconcile' END AS mode, CASE WHEN o_orderkey % 7 = 0 THEN 'failed' ELSE 'ok' END AS status, o_orderkey % 100 AS fetched_count, CASE WHEN o_orderkey % 7 = 0 THEN concat('error ', CAST(o_orderkey AS STRING)) END AS error FROM orders"""

SOURCES = """SELECT page_id AS row_no, CASE WHEN page_id % 10 = 0 THEN NULL ELSE concat('Source ', CAST(page_id % 40 AS STRING)) END AS name, url, 'layer' AS layer, concat('sheet', CAST(page_id % 3 AS STRING)) AS sheet FROM pages"""


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of one of the texts above over the tables of sf_dir."""
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    return spark.sql(sql.replace("unnest(list_value(", "explode(array("))


def observations(flat: DataFrame, dims: dict[str, str], labels: dict[str, str]) -> DataFrame:
    """Observations with dimension maps from a flat view: dimension name to column."""
    as_map = lambda d: F.create_map(*(x for k, c in d.items() for x in (F.lit(k), F.col(c))))
    return flat.select(
        "id", "table_id", "period", "contents_code", "unit", "value",
        as_map(dims | {"ContentsCode": "contents_code", "Tid": "period"}).alias("dimensions"),
        as_map(labels).alias("labels"),
        F.concat("table_id", F.lit(".json")).alias("source_file"), F.lit("n1").alias("normalization_version"), F.lit("t1").alias("transformation_version"), F.lit("batch").alias("ingestion_batch_id"),
        F.lit("dataset").alias("statistical_dataset_id"), F.lit("version").alias("dataset_version_id"),
    )


def regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(view(spark, sf_dir, REGIONAL), {"Region": "region", "UtdNivaa": "education", "Fagfelt": "field"}, {"Region": "region_label", "UtdNivaa": "education", "Fagfelt": "field_label", "ContentsCode": "contents_code"})


def industry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(view(spark, sf_dir, INDUSTRY), {"NACE2007": "industry", "UtdNivaa": "education"}, {"NACE2007": "industry", "UtdNivaa": "education", "ContentsCode": "contents_code"})


def occupation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(view(spark, sf_dir, OCCUPATION), {"Yrke": "occupation", "Alder": "age"}, {"Yrke": "occupation", "Alder": "age", "ContentsCode": "contents_code"})


def workforce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(view(spark, sf_dir, WORKFORCE), {"HeltidDeltid": "hours", "UtdNivaa": "education"}, {"HeltidDeltid": "hours", "UtdNivaa": "education", "ContentsCode": "contents_code"})

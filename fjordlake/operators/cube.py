"""Multi-dimensional cubes to one fact per row.

A cube row has table_id, source_file, id (dimension order), size, role_time, role_metric, dimension (map of name to label and
category with index, label and unit maps) and value. A cell's codes follow from its place by strides, so no join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordlake.functions import columns as L

CATEGORY = "struct<index:map<string,int>,label:map<string,string>,unit:map<string,struct<base:string,label:string>>>"
DIMENSION = f"map<string,struct<label:string,category:{CATEGORY}>>"
DATASET = f"class string, label string, id array<string>, size array<int>, role struct<time:array<string>,metric:array<string>>, dimension {DIMENSION}, value array<double>"

#: Names of time and measure dimensions, and what marks totals in a source.
TIME_NAMES = ("tid", "time", "år", "aar")
METRIC_NAMES = ("contentscode", "statistikkvariabel")
TOTAL_CODES = ("TOT", "0-9", "00-99")
TOTAL_PHRASES = ("i alt", "alle", "begge kjønn", "begge kjonn", "alle yrker", "alle næringer", "alle naeringer")


def dimension_positions(dimension: Column) -> Column:
    """Codes of one dimension in the order of their positions."""
    by_place = F.array_sort(F.transform(F.map_entries(dimension["category"]["index"]), lambda e: F.struct(e["value"].alias("place"), e["key"].alias("code"))))
    return F.transform(by_place, lambda e: e["code"])


def _named(role: Column, ids: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(F.get(role, F.lit(0)), F.get(F.filter(ids, lambda x: F.lower(x).isin(*names)), F.lit(0)))


def time_dimension() -> Column:
    return _named(F.col("role_time"), F.col("id"), TIME_NAMES)


def metric_dimension() -> Column:
    return _named(F.col("role_metric"), F.col("id"), METRIC_NAMES)


def unit_for_cell(dimension: Column, code: Column) -> Column:
    unit = dimension["category"]["unit"][code]
    return F.coalesce(F.nullif(unit["label"], F.lit("")), F.nullif(unit["base"], F.lit("")))


def total_flag(code: Column, label: Column) -> Column:
    return code.isin(*TOTAL_CODES) | L.contains_any(F.trim(label), TOTAL_PHRASES)


def period_bounds(period: Column) -> tuple[Column, Column]:
    """First and last day of a year; null for any other period."""
    year = F.when(period.rlike(r"^\d{4}$"), period.try_cast("int"))
    return F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.lit(12), F.lit(31))


def observation_signature(table: Column, file: Column, period: Column, contents: Column, pairs: Column, version: Column) -> Column:
    """Hash of a fact's identity; pairs: array of [dimension, code] in the cube's order."""
    return F.sha2(L.canonical_json(contents.alias("contents_code"), pairs.alias("dimensions"), version.alias("normalization_version"), period.alias("period"), file.alias("source_file"), table.alias("table_id")), 256)


def _with_codes(cubes: DataFrame) -> DataFrame:
    """codes: for each dimension in order its codes by place; strides: cells from one code to the next."""
    codes = F.transform("id", lambda d: dimension_positions(F.element_at(F.col("dimension"), d)))
    counted = cubes.withColumn("codes", codes).withColumn("sizes", F.transform("codes", lambda c: F.size(c).cast("long")))
    return counted.withColumn("strides", F.transform("id", lambda _, i: F.aggregate(F.slice("sizes", i + 2, F.size("sizes")), F.lit(1).cast("long"), lambda a, x: a * x)))


def check_cartesian(cubes: DataFrame) -> DataFrame:
    """Expected cells against values of each cube."""
    rows = _with_codes(cubes)
    expected = F.aggregate("sizes", F.lit(1).cast("long"), lambda a, x: a * x)
    found = F.size("value").cast("long")
    return rows.select("table_id", "source_file", expected.alias("expected"), found.alias("found"), (expected == found).alias("matches"))


#: Cells of a cube that one task flattens; a larger cube is dealt out in ranges of its values.
SLICE = 1 << 16


def _sliced(rows: DataFrame, cells: Column, slice_cells: int) -> DataFrame:
    """rows with their values in ranges: offset and part. Ranges of large cubes are dealt out to tasks before they are exploded."""
    starts = F.sequence(F.lit(0), F.greatest(F.least(F.size("value").cast("long"), cells) - 1, F.lit(0)).cast("int"), F.lit(slice_cells))
    parts = F.transform(starts, lambda at: F.struct(at.alias("offset"), F.slice("value", at + 1, slice_cells).alias("part")))
    cut = rows.select(*(c for c in rows.columns if c != "value"), F.explode(parts).alias("x")).select("*", "x.offset", "x.part").drop("x")
    return cut.repartition("table_id", "source_file", "offset")


def cube_flatten(cubes: DataFrame, version: str = "n1", batch_id: str = "batch", lenient: bool = False, slice_cells: int = SLICE) -> DataFrame:
    """Observations of all cells. Cells without a value go, and cubes whose values don't match their sizes give none.

    lenient: such cells stay, and surplus values beyond the last cell are cut off. A cube is read by one task, as its file is one
    JSON text; its cells are flattened by as many tasks as it has slices."""
    rows = _with_codes(cubes)
    cells = F.aggregate("sizes", F.lit(1).cast("long"), lambda a, x: a * x)
    if not lenient:
        rows = rows.filter(cells == F.size("value"))
    sliced = _sliced(rows.withColumn("time_name", time_dimension()).withColumn("metric_name", metric_dimension()).withColumn("cells", cells), cells, slice_cells)
    exploded = sliced.select("*", F.posexplode("part").alias("within", "cell")).withColumn("place", F.col("offset") + F.col("within"))
    exploded = exploded.filter(F.col("place") < F.col("cells")) if lenient else exploded.filter(F.col("cell").isNotNull())
    code = lambda d, i: F.get(F.get(F.col("codes"), i), ((F.col("place") / F.get(F.col("strides"), i)).cast("long") % F.get(F.col("sizes"), i)).cast("int"))
    coded = exploded.withColumn("pairs", F.transform("id", lambda d, i: F.array(d, code(d, i))))
    dims = F.map_from_entries(F.transform("pairs", lambda p: F.struct(p[0], p[1])))
    labels = F.map_from_entries(F.transform("pairs", lambda p: F.struct(p[0], F.element_at(F.col("dimension"), p[0])["category"]["label"][p[1]])))
    found = coded.withColumn("dimensions", dims).withColumn("labels", labels)
    found = found.withColumn("period", F.col("dimensions")[F.col("time_name")]).withColumn("contents_code", F.col("dimensions")[F.col("metric_name")])
    start, end = period_bounds(F.col("period"))
    signature = observation_signature(F.col("table_id"), F.col("source_file"), F.col("period"), F.col("contents_code"), F.col("pairs"), F.lit(version))
    return found.select(
        signature.alias("id"), signature.alias("observation_signature"), "table_id", "source_file", "period", start.alias("period_start"), end.alias("period_end"), F.col("cell").alias("value"),
        unit_for_cell(F.element_at("dimension", F.col("metric_name")), F.col("contents_code")).alias("unit"), "contents_code", "dimensions", "labels",
        F.transform("pairs", lambda p: F.concat_ws("|", F.col("table_id"), p[0], p[1])).alias("dimension_value_ids"),
        F.lit(version).alias("normalization_version"), F.lit("t1").alias("transformation_version"), F.lit(batch_id).alias("ingestion_batch_id"),
    )


def skipped_nulls(cubes: DataFrame) -> DataFrame:
    return cubes.select("table_id", "source_file", F.size(F.filter("value", lambda v: v.isNull())).alias("skipped"))


def dimension_catalog(cubes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dimensions (slug, name, label) and their values (dimension slug, code, label, order, total flag), each once."""
    named = cubes.select("table_id", F.explode("dimension").alias("name", "meta"))
    slug = L.slug(F.col("name"))
    dimensions = named.groupBy(slug.alias("slug"), "name").agg(F.min("meta.label").alias("label"))
    places = named.select(slug.alias("dimension"), "meta", F.explode("meta.category.index").alias("code", "sort_order"))
    label = F.element_at("meta.category.label", F.col("code"))
    values = places.groupBy("dimension", "code").agg(F.min(label).alias("label"), F.min("sort_order").alias("sort_order"))
    return dimensions, values.withColumn("is_total", total_flag(F.col("code"), F.col("label")))


def cube_profile(cubes: DataFrame) -> DataFrame:
    """Rows, missing values, dimensions with their sizes and whether the cube fits the shared model, by table."""
    rows = cubes.select("table_id", "id", F.size("value").cast("long").alias("n"), F.size(F.filter("value", lambda v: v.isNull())).cast("long").alias("missing"), time_dimension().alias("time"), F.array_sort(F.transform(F.map_entries("dimension"), lambda e: F.concat_ws("=", e["key"], F.size(e["value"]["category"]["index"]).cast("string")))).alias("cardinality"))
    return rows.groupBy("table_id").agg(F.sum("n").alias("rows"), F.sum("missing").alias("missing_values"), F.max(F.array_join("id", ",")).alias("dimensions"), F.max(F.array_join("cardinality", ",")).alias("cardinality"), F.max(F.col("time").isNotNull()).alias("has_time"), (F.max(F.col("time").isNotNull()) & (F.sum("n") > 0)).alias("fits_shared_model"))


def combined_preview(frames: list[DataFrame], names: list[str]) -> DataFrame:
    """Observations of several tables side by side, a column dim_* for each of the dimensions named."""
    out = None
    for frame in frames:
        wide = frame.select("table_id", "period", "contents_code", "value", *(F.col("dimensions")[n].alias(f"dim_{n}") for n in names))
        out = wide if out is None else out.unionByName(wide, allowMissingColumns=True)
    return out


def latest_periods_slice(obs: DataFrame, n: int, top_hints: str = "i alt|total|hele landet|alle|begge") -> DataFrame:
    """Rows of the n newest periods in which every other dimension has its top-level member: by label, else the first code."""
    entries = obs.select(F.explode("dimensions").alias("name", "code"), "labels").filter(~F.lower("name").isin(*TIME_NAMES, *METRIC_NAMES))
    is_top = L.contains_any(F.element_at("labels", F.col("name")), top_hints.split("|"))
    chosen = entries.groupBy("name").agg(F.coalesce(F.min(F.when(is_top, F.col("code"))), F.min("code")).alias("code"))  # one row for each dimension
    wanted = chosen.agg(F.map_from_entries(F.collect_list(F.struct("name", "code"))).alias("wanted"))
    periods = obs.filter(F.col("period").isNotNull()).select("period").distinct().orderBy(L.period_key(F.col("period")).desc()).limit(n)
    own = F.map_filter("dimensions", lambda k, _: ~F.lower(k).isin(*TIME_NAMES, *METRIC_NAMES))
    rows = obs.join(F.broadcast(periods), "period", "left_semi").crossJoin(F.broadcast(wanted))  # one row of chosen codes
    return rows.filter(F.forall(F.map_keys(own), lambda k: F.col("dimensions")[k] == F.col("wanted")[k])).drop("wanted")

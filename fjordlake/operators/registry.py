"""Registry of data sources from sheets with free headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjordlake.functions import columns as L

#: Header names by meaning, in order of preference.
NAME_KEYS = ("kilde", "kildenavn", "datakilde", "navn", "tittel", "title", "source", "dataset", "beskrivelse", "description", "organisasjon", "institusjon")
URL_KEYS = ("url", "lenke", "link", "nettside", "api", "api_url", "kilde_url")
KIND_KEYS = ("type", "kind", "format", "datatype", "leveranseform", "tilgang", "access")
OWNER_KEYS = ("eier", "owner", "ansvarlig", "team")
LICENSE_KEYS = ("lisens", "license", "notat", "notes", "merknad")
REFRESH_KEYS = ("frekvens", "refresh", "oppdatering", "kadence")


def pick_cell(cells: Column, candidates: tuple[str, ...]) -> Column:
    """pick_columns for a row's cells by header, whose headers may differ from row to row."""
    entries = F.map_entries(F.transform_keys(cells, lambda k, _: F.lower(F.trim(k))))
    named = lambda c: F.get(F.filter(entries, lambda e: (e["key"] == c) & L.blank_to_null(e["value"]).isNotNull()), F.lit(0))["value"]
    exact = [named(c) for c in candidates]
    holds = lambda e: F.lit(False) if not candidates else F.replace(e["key"], F.lit(" "), F.lit("_")).rlike("|".join(candidates))
    inside = F.get(F.filter(entries, lambda e: L.blank_to_null(e["value"]).isNotNull() & holds(e)), F.lit(0))["value"]
    return F.trim(F.coalesce(*exact, inside))


def source_rows(sheets: DataFrame, layer: str, prefix: str, workbook: str) -> DataFrame:
    """Registry rows of sheet rows (sheet, row_no, cells): slug, name, url, kind, owner, licence notes, refresh, metadata (JSON) and their order.

    A slug ends in all 16 digits of the row's digest: of a million rows some share a name and the first eight. Rows of equal cells and sheet share
    a slug. A row without a name is named by its sheet and row; cells of equal headers but for case or blanks at the ends fail the job."""
    cells = F.col("cells")
    name = pick_cell(cells, NAME_KEYS)
    digest = F.substring(F.sha2(L.canonical_json(F.lit(layer).alias("layer"), L.sorted_map(cells).alias("row"), F.col("sheet").alias("sheet")), 256), 1, 16)
    unnamed = F.format_string("Unnamed source (%s row %d)", "sheet", "row_no")
    metadata = L.canonical_json(F.lit(workbook).alias("source_map_workbook"), F.col("sheet").alias("sheet"), F.col("row_no").alias("sheet_row"), F.lit(layer).alias("intelligence_layer"), cells.alias("raw_row"))
    return sheets.select(
        source_slug(name, prefix, F.col("sheet"), digest, 16).alias("slug"), F.coalesce(name, unnamed).alias("name"), pick_cell(cells, URL_KEYS).alias("url"), F.coalesce(pick_cell(cells, KIND_KEYS), F.lit("file")).alias("kind"),
        pick_cell(cells, OWNER_KEYS).alias("owner_team"), pick_cell(cells, LICENSE_KEYS).alias("license_notes"), pick_cell(cells, REFRESH_KEYS).alias("default_refresh"), metadata.alias("metadata"), F.struct("sheet", "row_no").alias("row_no"),
    )


def pick_columns(df: DataFrame, candidates: tuple[str, ...]) -> Column:
    """The first filled column by exact name in order of the candidates, then the first whose name contains one."""
    by_name = {c.lower().strip(): c for c in df.columns}
    exact = [by_name[c] for c in candidates if c in by_name]
    inside = [c for c in df.columns if any(k in c.lower().strip().replace(" ", "_") for k in candidates)]
    ordered = list(dict.fromkeys([*exact, *inside]))
    return L.first_text(*(F.col(f"`{c}`").cast("string") for c in ordered)) if ordered else F.lit(None).cast("string")


def content_hash(df: DataFrame, layer: Column, sheet: Column) -> Column:
    row = F.struct(*(F.col(f"`{c}`").cast("string").alias(c) for c in sorted(df.columns)))
    return F.substring(F.sha2(L.canonical_json(layer.alias("layer"), row.alias("row"), sheet.alias("sheet")), 256), 1, 16)


def source_slug(name: Column, prefix: str, sheet: Column, digest: Column, digits: int = 8) -> Column:
    base = L.unicode_slug(F.concat(F.lit(f"{prefix}-"), name))
    return F.when(L.blank_to_null(name).isNotNull(), F.concat_ws("-", base, F.substring(digest, 1, digits))).otherwise(F.concat_ws("-", F.lit(prefix), F.substring(sheet, 1, 40), digest))


def drop_blank_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce(*(L.blank_to_null(F.col(f"`{c}`").cast("string")) for c in df.columns)).isNotNull())


def upsert_sources(rows: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The registry after the rows (slug, name, url, kind, row_no), datasets with a placeholder version, and counts.

    What else rows have, such as an owner, is kept with them. The last row of a slug counts; a slug that is known, or came earlier in the run, counts as an update."""
    nth = F.row_number().over(Window.partitionBy("slug").orderBy("row_no"))
    known = sources.select("slug").distinct().withColumn("known", F.lit(True))
    marked = rows.withColumn("nth", nth).join(known, "slug", "left").withColumn("outcome", F.when(F.col("known") | (F.col("nth") > 1), "updated").otherwise("inserted"))
    counts = marked.groupBy("outcome").agg(F.count("*").alias("n"))
    last = rows.groupBy("slug").agg(F.max_by(F.struct("name", "url", "kind", *(c for c in rows.columns if c not in ("slug", "name", "url", "kind", "row_no"))), F.col("row_no")).alias("x")).select("slug", "x.*")
    new = sources.join(last.select("slug"), "slug", "left_anti").unionByName(last, allowMissingColumns=True)
    datasets = last.select(F.col("slug").alias("source_slug"), F.concat("slug", F.lit("::primary")).alias("external_id"), F.substring("name", 1, 500).alias("title"), F.coalesce("kind", F.lit("file")).alias("access_method"), F.lit("source-map-placeholder").alias("version_label"), F.lit("pending").alias("ingestion_status"))
    return new, datasets, counts


def dataset_upsert(cubes: DataFrame, datasets: DataFrame, base_url: str) -> DataFrame:
    """Datasets (slug, title, access_url, dimension_names) with those of the cubes in place of equal slugs."""
    own = cubes.select(F.concat(F.lit("table-"), "table_id").alias("slug"), F.coalesce(L.blank_to_null(F.col("label")), F.concat(F.lit("Table "), "table_id")).alias("title"), F.concat(F.lit(base_url), "table_id").alias("access_url"), F.array_sort(F.map_keys("dimension")).alias("dimension_names")).dropDuplicates(["slug"])
    return datasets.join(own.select("slug"), "slug", "left_anti").unionByName(own, allowMissingColumns=True)

"""Readers and writers. Unreadable input becomes reject rows, never an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordlake.functions import columns as L
from fjordlake.operators.cube import DATASET
from fjordlake.operators.events import ITEM_SCHEMA

#: File name endings that hold no cube, and the columns of a signal file.
NOT_CUBES = ("_metadata", "_basic_metadata", "_sample_data")
SIGNAL_COLUMNS = (
    "signal_type", "signal_label", "table_id", "periods_compared", "period_type", "period_granularity", "value_start", "value_end", "absolute_change", "percent_change", "direction_label", "confidence_category", "confidence_score",
    "source_observation_ids", "source_table", "dimensions_json", "dimension_labels_json", "explainability_note", "explainability_summary_json", "lineage_json", "quality_flags", "signal_quality_score", "quality_reasoning_json",
    "signal_deterministic_hash", "min_baseline", "contents_code", "contents_code_label",
)
DECISIONS = ("approve_for_persistence", "reject", "quarantine", "needs_more_review")


def read_cube_files(spark: SparkSession, path: str, latest_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """Cubes (see operators.cube) and rejects (source_file, reason) from JSON files named `<table>...json`; of a table's files the last by name."""
    raw = spark.read.text(path, wholetext=True).select("value", F.element_at(F.split(F.input_file_name(), "/"), -1).alias("source_file"))
    stem = F.regexp_replace("source_file", r"\.json$", "")
    named = raw.filter(~F.lower(stem).rlike("(" + "|".join(NOT_CUBES) + ")$")).withColumn("table_id", F.regexp_extract("source_file", r"^(\d+)", 1))
    if latest_only:
        last = named.groupBy("table_id").agg(F.max("source_file").alias("source_file"))
        named = named.join(last, ["table_id", "source_file"], "left_semi")
    dataset = F.from_json("value", DATASET)
    wrapped = F.from_json("value", f"data struct<{DATASET.replace(' string', ':string').replace(' array', ':array').replace(' struct', ':struct').replace(' map', ':map')}>")
    found = named.withColumn("d", F.coalesce(F.when(dataset["class"] == "dataset", dataset), F.when(wrapped["data"]["class"] == "dataset", wrapped["data"])))
    reason = F.when(F.col("d").isNull(), "not a dataset").when(F.col("d.value").isNull() | F.col("d.id").isNull() | F.col("d.dimension").isNull(), "incomplete dataset")
    marked = found.withColumn("reason", reason)
    cubes = marked.filter(F.col("reason").isNull()).select("table_id", "source_file", "d.label", "d.id", "d.size", F.col("d.role.time").alias("role_time"), F.col("d.role.metric").alias("role_metric"), "d.dimension", "d.value")
    return cubes, marked.filter(F.col("reason").isNotNull()).select("source_file", "reason")


def read_feed_pages(spark: SparkSession, path: str, stream: bool = False, pages_per_batch: int = 10) -> DataFrame:
    """Items of feed pages with their page and place, the order of the feed; a page without an items list has none."""
    item = ITEM_SCHEMA.replace(" string", ":string").replace(" struct", ":struct")
    schema = f"feed_url string, next_url string, items array<struct<{item}>>"
    reader = (spark.readStream if stream else spark.read).schema(schema).option("multiLine", "true")
    if stream:
        reader = reader.option("maxFilesPerTrigger", pages_per_batch)
    pages = reader.json(path).withColumn("page", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return pages.select("page", F.posexplode("items").alias("place", "item")).select("page", "place", "item.*")


def read_signal_csv(spark: SparkSession, path: str) -> DataFrame:
    """Signals as text, but for numbers and the list of flags."""
    schema = ", ".join(f"{c} string" for c in SIGNAL_COLUMNS)
    rows = spark.read.schema(schema).csv(path, header=True, quote='"', escape='"', multiLine=True)
    numbers = ("value_start", "value_end", "absolute_change", "percent_change", "confidence_score", "signal_quality_score", "min_baseline")
    return rows.withColumns({c: L.blank_to_null(F.col(c)).try_cast("double") for c in numbers} | {"quality_flags": F.from_json("quality_flags", "array<string>")})


def write_signals_csv(signals: DataFrame, path: str) -> None:
    """Signals in the fixed column order; whole numbers without a fraction, lists as JSON."""
    kinds = dict(signals.dtypes)
    text = lambda c: F.lit(None).cast("string") if c not in kinds else F.to_json(c) if kinds[c].startswith("array") else L.whole_number_text(F.col(c)) if kinds[c] == "double" else F.col(c).cast("string")
    signals.select(*(text(c).alias(c) for c in SIGNAL_COLUMNS)).write.csv(path, header=True, quote='"', escape='"')


def judged_decisions(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decisions, of repeated hashes the last line, and rejected lines with a reason. rows: five text columns and line."""
    trimmed = rows.select("line", *(F.trim(c).alias(c) for c in ("signal_deterministic_hash", "review_decision", "reviewer_id", "reviewed_at", "review_notes")))
    filled = trimmed.filter(F.coalesce("signal_deterministic_hash", F.lit("")) != "")
    reason = F.when(~F.coalesce(F.col("review_decision").isin(*DECISIONS), F.lit(False)), "unknown decision").when((F.col("review_decision") == DECISIONS[0]) & (F.coalesce("reviewer_id", F.lit("")) == ""), "approval without reviewer")
    marked = filled.withColumn("reason", reason)
    own = ("review_decision", "reviewer_id", "reviewed_at", "review_notes")
    last = marked.filter(F.col("reason").isNull()).groupBy("signal_deterministic_hash").agg(F.max_by(F.struct(*own), F.col("line")).alias("x"))
    return last.select("signal_deterministic_hash", "x.*"), marked.filter(F.col("reason").isNotNull()).select("line", "signal_deterministic_hash", "reason")


def read_review_decisions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    schema = "signal_deterministic_hash string, review_decision string, reviewer_id string, reviewed_at string, review_notes string"
    rows = spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
    return judged_decisions(rows.withColumn("line", F.monotonically_increasing_id()))  # grows with a file's lines


def read_source_sheets(spark: SparkSession, path: str) -> DataFrame:
    """Rows of sheet exports: headers trimmed and lower-case, blank ones named by place, all-blank rows gone, with sheet and row number."""
    raw = spark.read.csv(path, header=True)
    names = [c.strip().lower() if c.strip() and not c.startswith("_c") else f"column_{i}" for i, c in enumerate(raw.columns)]
    rows = raw.toDF(*names)
    some = F.coalesce(*(L.blank_to_null(F.col(f"`{c}`")) for c in names)).isNotNull()
    return rows.withColumn("sheet", F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.csv$", "")).withColumn("row_no", F.monotonically_increasing_id()).filter(some)


def write_observations(obs: DataFrame, path: str) -> None:
    """Appends facts by table and period, so that reads of either touch only their files."""
    obs.write.mode("append").partitionBy("table_id", "period").parquet(path)


def run_summary(counts: DataFrame, config: dict[str, str]) -> DataFrame:
    """One row: counters (name, n) as a map, with the settings."""
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n")))).alias("counters")).select("counters", F.create_map(*(F.lit(x) for kv in sorted(config.items()) for x in kv)).alias("config"))

"""Checks of observations. Each returns rows or counts; none stops a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjordlake.functions import columns as L


def signature_of() -> Column:
    """The stored signature, else that inside the metadata, else that inside the raw observation."""
    inner = lambda c: L.blank_to_null(F.get_json_object(c, "$.observation_signature"))
    return F.coalesce(L.blank_to_null(F.col("observation_signature")), inner("metadata_json"), inner("raw_observation_json"))


def missing_labels() -> Column:
    """Number of a row's dimensions without a label."""
    return F.size(F.filter(F.map_keys("dimensions"), lambda d: F.coalesce(F.trim(F.element_at("labels", d)), F.lit("")) == ""))


def check_missing_labels(obs: DataFrame) -> DataFrame:
    return obs.groupBy("table_id").agg(F.sum(missing_labels()).alias("n"))


def check_dimension_ids(obs: DataFrame, values: DataFrame) -> DataFrame:
    """Rows by table of which some dimension value is not in the catalog (dimension, code)."""
    entries = obs.select("id", "table_id", F.explode("dimensions").alias("dimension", "code"))
    unknown = entries.join(values.select("dimension", "code"), ["dimension", "code"], "left_anti")
    return unknown.groupBy("table_id").agg(F.countDistinct("id").alias("n"))


def lineage_complete() -> Column:
    text = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) != ""
    whole = F.coalesce(F.size("dimension_value_ids") >= F.size("dimensions"), F.lit(False)) & (F.size("dimensions") > 0)
    return text("table_id") & text("source_file") & text("ingestion_batch_id") & text("normalization_version") & text("transformation_version") & text("observation_signature") & whole


def check_lineage(obs: DataFrame) -> DataFrame:
    return obs.groupBy("table_id").agg(F.count_if(lineage_complete()).alias("complete"), F.count_if(~lineage_complete()).alias("incomplete"))


def check_duplicate_signatures(obs: DataFrame) -> DataFrame:
    repeated = obs.filter(F.col("observation_signature").isNotNull()).groupBy("table_id", "observation_signature").agg(F.count("*").alias("c")).filter(F.col("c") > 1)
    return repeated.groupBy("table_id").agg(F.sum(F.col("c") - 1).alias("n"))


def validation_report(obs: DataFrame, values: DataFrame) -> DataFrame:
    """Findings by table and kind with a severity; a table with a hard fail has status failed in all its rows.

    All checks but that of the catalog come from one pass, which counts by signature first."""
    repeats = F.when(F.col("observation_signature").isNotNull(), F.col("rows") - 1).otherwise(0)
    by_signature = obs.groupBy("table_id", "observation_signature").agg(F.count("*").alias("rows"), F.sum(missing_labels()).alias("missing"), F.count_if(~lineage_complete()).alias("incomplete"))
    counts = by_signature.groupBy("table_id").agg(F.sum("missing").alias("missing_labels"), F.sum("incomplete").alias("lineage_incomplete"), F.sum(repeats).alias("duplicate_signatures"))
    each = F.array(*(F.struct(F.lit(k).alias("finding"), F.lit(severity).alias("severity"), F.col(k).cast("long").alias("n")) for k, severity in (("missing_labels", "warning"), ("lineage_incomplete", "warning"), ("duplicate_signatures", "hard_fail"))))
    found = counts.select("table_id", F.explode(each).alias("x")).select("table_id", "x.*")
    unknown = check_dimension_ids(obs, values).select("table_id", F.lit("missing_dimension_ids").alias("finding"), F.lit("warning").alias("severity"), F.col("n").cast("long").alias("n"))
    failed = F.max((F.col("severity") == "hard_fail").cast("int")).over(Window.partitionBy("table_id")) == 1
    return found.unionByName(unknown).filter(F.col("n") > 0).withColumn("status", F.when(failed, "failed").otherwise("ok"))


def existing_row_context(store: DataFrame, obs: DataFrame) -> DataFrame:
    """Rows already stored for each table and file of obs."""
    own = obs.select("table_id", "source_file").distinct()
    counts = store.groupBy("table_id", "source_file").agg(F.count("*").alias("stored"))
    return own.join(counts, ["table_id", "source_file"], "left").withColumn("stored", F.coalesce("stored", F.lit(0)))


def skip_existing_signatures(obs: DataFrame, store: DataFrame, skip: bool) -> tuple[DataFrame, DataFrame]:
    """Rows to insert and findings by table. Without an overlap all rows stay; with one, only new rows if `skip`, else none."""
    known = store.select("observation_signature").distinct()
    overlap = obs.join(known, "observation_signature", "left_semi").groupBy("table_id").agg(F.count("*").alias("n"))
    new = obs.join(known, "observation_signature", "left_anti")
    kept = new if skip else new.join(overlap.select("table_id"), "table_id", "left_anti")
    finding = "skipped_existing" if skip else "existing_signatures"
    return kept, overlap.select("table_id", F.lit(finding).alias("finding"), F.lit("info" if skip else "hard_fail").alias("severity"), "n")

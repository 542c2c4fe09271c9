"""Outputs written together with a summary whose counters are taken while they are written, and audit rows appended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def counts_by(column: str, values: tuple[str, ...]) -> dict[str, Column]:
    """A counter for each of the values of a column; a null counts for none."""
    return {f"{column}_{v}": F.count_if(F.col(column) == v) for v in values}


def write_with_summary(spark: SparkSession, outputs: dict[str, DataFrame], path: str, config: dict[str, str], metrics: dict[str, dict[str, Column]] | None = None, mode: str = "error") -> DataFrame:
    """Writes each output below path and, as JSON, one row: counters (output, then counter, to number) and config.

    Counters (`rows` and those of metrics, by output) are observed in the job that writes; nothing is read twice. Outputs are
    written one after another; one that fails leaves no summary."""
    counters: dict[str, dict[str, int]] = {}
    for name, frame in outputs.items():
        seen = Observation(name)
        own = (metrics or {}).get(name, {})
        frame.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in own.items())).write.mode(mode).parquet(f"{path}/{name}")
        counters[name] = {k: int(v or 0) for k, v in seen.get.items()}
    row = spark.createDataFrame([(counters, dict(sorted(config.items())))], "counters map<string,map<string,bigint>>, config map<string,string>")
    row.coalesce(1).write.mode(mode).json(f"{path}/summary")
    return row


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("counters map<string,map<string,bigint>>, config map<string,string>").json(f"{path}/summary")


def write_audit(audit: DataFrame, path: str, run_id: str, run_mode: str) -> None:
    """Appends audit rows with the run that made them, by run, so that a run's rows can be read, or written again, alone."""
    stamped = audit.withColumn("run_mode", F.lit(run_mode)).withColumn("run_id", F.lit(run_id))
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)

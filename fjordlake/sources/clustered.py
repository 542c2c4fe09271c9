"""The posting table clustered by the time of change, for pages behind a cursor.

Rows carry `changed_at` and lie in folders by its day, sorted within files that Spark cuts by ranges of (day, time, id), so a day with
very many rows is many files. A table of days with their numbers of rows, a few bytes a day, lies beside it. A page asks that table
how far it must read to be full; days outside are never listed, and within them row groups whose statistics end before the cursor
are skipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordlake.functions import columns as L
from fjordlake.operators import serving


def write_clustered(state: DataFrame, path: str, clocks: tuple[str, ...] = serving.CLOCKS, mode: str = "error") -> None:
    """Writes state by the latest of those clocks that it has; rows without any are left out, since no page can hold them."""
    own = [F.col(c) for c in clocks if c in state.columns]
    changed = F.greatest(*own) if len(own) > 1 else own[0]
    rows = state.withColumn("changed_at", changed).filter(F.col("changed_at").isNotNull()).withColumn("changed_day", F.to_date("changed_at"))
    rows.repartitionByRange("changed_day", "changed_at", "external_id").sortWithinPartitions("changed_day", "changed_at", "external_id").write.mode(mode).partitionBy("changed_day").parquet(f"{path}/rows")
    written = state.sparkSession.read.parquet(f"{path}/rows")
    written.groupBy("changed_day").agg(F.count("*").alias("n")).coalesce(1).write.mode(mode).parquet(f"{path}/days")


def page_of(spark: SparkSession, path: str, since: Column, after_id: str = "", limit: int | None = 500) -> DataFrame:
    """The next page behind the cursor (since, after_id), as `serving.list_since` gives it over the whole table."""
    most = L.clamp(limit, 500, 1000)
    days = spark.read.parquet(f"{path}/days")
    first = spark.range(1).select(since.alias("at"), F.to_date(since).alias("day")).first()
    ahead = days.filter(F.col("changed_day") >= F.lit(first["day"])).orderBy("changed_day").limit(most + 1).collect()  # each day has a row at least
    # the cursor's own day may hold nothing more, so that the days behind it must fill the page
    last, held = first["day"], 0
    for r in ahead:
        last = r["changed_day"]
        held += r["n"] if r["changed_day"] > first["day"] else 0
        if held >= most:
            break
    rows = spark.read.parquet(f"{path}/rows").filter(F.col("changed_day").between(F.lit(first["day"]), F.lit(last)) & (F.col("changed_at") >= F.lit(first["at"])))
    past = (F.col("changed_at") > F.lit(first["at"])) | (F.col("external_id") > F.lit(after_id))
    return rows.filter(past).orderBy("changed_at", "external_id").limit(most).drop("changed_day")

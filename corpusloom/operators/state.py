"""What runs leave for the next ones: markers, progress, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def since_marker(rows: DataFrame, markers: DataFrame, source: str = "source", time: str = "ts") -> DataFrame:
    """Rows from the day of their source's last fetch on, that day included; all rows of sources without one."""
    known = markers.select(F.col("source").alias(source), F.to_date("last_fetch").alias("__day"))
    return rows.join(known, source, "left").where("__day is null or to_date(%s) >= __day" % time).select(*rows.columns)


def advanced(markers: DataFrame, runs: DataFrame) -> DataFrame:
    """``source, last_fetch, papers_fetched`` after runs (``source, ts, fetched, errors``): counts add up, and the marker
    only moves with runs without errors."""
    new = runs.select("source", F.when(F.col("errors") == 0, F.col("ts")).alias("last_fetch"), F.when(F.col("errors") == 0, F.col("fetched")).otherwise(0).alias("papers_fetched"))
    return markers.select("source", "last_fetch", "papers_fetched").union(new).groupBy("source").agg(F.max("last_fetch").alias("last_fetch"), F.sum("papers_fetched").alias("papers_fetched"))


def progress(rows: DataFrame, total: int | None = None) -> DataFrame:
    """One row of a run's progress rows (``state``): completed, failed, remaining, percent."""
    counts = rows.agg(F.count_if(F.col("state") == "completed").alias("completed"), F.count_if(F.col("state") == "failed").alias("failed"), F.count("*").alias("__n"))
    whole = F.lit(total).cast("bigint") if total is not None else F.col("__n")
    return counts.select(
        "completed", "failed", F.greatest(F.lit(0).cast("bigint"), whole - F.col("completed")).alias("remaining"),
        F.when(whole > 0, F.round(100.0 * F.col("completed") / whole, 1)).otherwise(0.0).cast("double").alias("percent"),
    )


def latest(log: DataFrame, key: str = "source", time: str = "ts", tie: str = "id") -> DataFrame:
    """The latest entry of each key."""
    order = Window.partitionBy(key).orderBy(F.desc(time), F.desc(tie))
    return log.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")


def next_search_id(log: DataFrame) -> str:
    found = log.agg(F.max(F.regexp_extract("id", r"^search_(\d+)\z", 1).try_cast("int"))).first()[0]
    return f"search_{(found or 0) + 1:03d}"


def newest(rows: DataFrame, time: str, k: int, *ties: str) -> DataFrame:
    """The k latest rows, ties in order of ``ties``."""
    return rows.orderBy(F.desc(time), *ties).limit(k)

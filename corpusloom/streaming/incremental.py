"""Structured Streaming over what arrives: duplicates across runs, mirror updates, windows by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.ids import doi_key
from corpusloom.operators import graph
from corpusloom.operators.commits import CommitLog


def distinct_stream(stream: DataFrame, *keys: str, time: str | None = None, horizon: str = "30 days") -> DataFrame:
    """Each key's first row, across batches and restarts. With ``time`` state forgets keys that the watermark has left
    ``horizon`` behind, so it is bounded by what arrives in that span; without, it holds every key."""
    if time is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(time, horizon).dropDuplicatesWithinWatermark(list(keys))


def _index(spark: SparkSession, index_path: str, buckets: int) -> CommitLog:
    return CommitLog(spark, index_path, {"keys": "key string"}, keyed={"keys": ("key", buckets)})


def index_stream(stream: DataFrame, index_path: str, out_path: str, checkpoint: str, doi: str = "doi", buckets: int = 256) -> StreamingQuery:
    """Appends rows of DOIs that are new to ``out_path`` and their DOIs to the index; rows without a DOI always pass.

    The index is kept in hash buckets, of which a batch reads those of its own keys. Each batch writes to folders of its
    own number and is committed by one rename, so one that runs again writes the same and counts once."""

    def batch(df: DataFrame, n: int) -> None:
        spark, name = df.sparkSession, f"{n:012d}"
        index = _index(spark, index_path, buckets)
        if index.published(name):
            return
        keyed = graph._write(spark, df.withColumn("__key", doi_key(doi)).withColumn("__row", F.monotonically_increasing_id()))
        # Which row of a key stays is told by its number, and what is old by its key: both are the same whenever they are
        # computed again, in whatever order a shuffle brings the rows.
        told = keyed.where("__key is not null")
        first = told.groupBy("__key").agg(F.min("__row").alias("__row"))
        old = index.known("keys", first.select("__key"), "__key")
        new = first.join(old, "__key", "left_anti").select("__row")
        fresh = told.join(new, "__row", "left_semi").unionByName(keyed.where("__key is null"))
        fresh = fresh.drop("__key", "__row")
        fresh.write.mode("overwrite").parquet(f"{out_path}/batch={n}")
        written = spark.read.schema(fresh.schema).parquet(f"{out_path}/batch={n}")
        index.write(name, "keys", written.select(doi_key(doi).alias("key")).where("key is not null"))
        index.publish(name)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and their values by type and window of event time; what is later than ``late`` is left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))

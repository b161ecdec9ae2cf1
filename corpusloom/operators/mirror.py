"""Keeping a mirror of remote files: what is new, what is whole, what there is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.ids import filled


def updates(remote: DataFrame, manifest: DataFrame) -> DataFrame:
    """Remote files that the manifest lacks or has an older state of. Times are strings that sort as they read; both
    tables have ``accession_id``."""
    known = manifest.select("accession_id", F.col("source_updated").alias("__seen"))
    new = F.col("__seen").isNull() | (F.col("last_updated") > F.col("__seen"))
    return remote.join(known, "accession_id", "left").where(new).select(*remote.columns)


def verify(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """``accession_id, filename, state``: verified, missing or size_mismatch. ``files`` has ``filename, length``."""
    found = files.select("filename", F.col("length").alias("__length"))
    state = F.when(F.col("__length").isNull(), "missing").when(F.col("__length") != F.col("size_bytes"), "size_mismatch").otherwise("verified")
    return manifest.join(found, "filename", "left").select("accession_id", "filename", state.alias("state"))


def status(manifest: DataFrame) -> DataFrame:
    """Files and bytes of each subset, and of all as subset null."""
    subset = F.coalesce(filled("subset"), F.lit("unknown")).alias("subset")
    return manifest.select(subset, "size_bytes").rollup("subset").agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"))


def imported(files: DataFrame, remote: DataFrame) -> DataFrame:
    """Local files with the remote entry of their name, if any: ``filename, accession_id, matched``."""
    entries = remote.groupBy(F.regexp_extract("filename", r"([^/]+)\z", 1).alias("__name")).agg(F.min("accession_id").alias("accession_id"))
    named = files.withColumn("__name", F.regexp_extract("filename", r"([^/]+)\z", 1))
    return named.join(entries, "__name", "left").select("filename", "accession_id", F.col("accession_id").isNotNull().alias("matched"))


def merged(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """The manifest with the entries of ``done`` put in or replaced."""
    return manifest.join(done.select("accession_id").distinct(), "accession_id", "left_anti").unionByName(done)

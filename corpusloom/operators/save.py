"""Tables of articles and their manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.ids import safe_file_name
from corpusloom.functions.xml import BODY_MIN_CHARS, jats_validator
from corpusloom.operators.dedup import changed, unknown
from corpusloom.operators.stats import manifest as manifest_counts


def validated(articles: DataFrame, xml: str = "xml", body_min_chars: int = BODY_MIN_CHARS, found: Column | None = None) -> DataFrame:
    """With what the validator finds (or what it has ``found`` before), and the hash of the content."""
    v = articles.withColumn("__v", jats_validator(body_min_chars)(xml) if found is None else found)
    told = ("status", "has_title", "has_abstract", "has_body", "body_chars", "errors")
    kept = [c for c in articles.columns if c not in told]
    return v.select(*kept, *[F.col(f"__v.{c}").alias(c) for c in told], F.sha2(F.col(xml), 256).alias("sha256"))


def to_save(articles: DataFrame, manifest: DataFrame) -> DataFrame:
    """Articles whose id and content the manifest doesn't have, with the folder they go to. Invalid ones go to
    ``incomplete`` too but keep their status."""
    return changed(articles, manifest, "pmcid", "sha256").withColumn("folder", F.when(F.col("status") == "valid", "valid").otherwise("incomplete"))


def write(articles: DataFrame, path: str) -> None:
    articles.write.mode("append").partitionBy("folder").parquet(path)


def manifest_json(articles: DataFrame) -> DataFrame:
    """One row of JSON with the counts of the manifest."""
    return manifest_counts(articles).select(F.to_json(F.struct("*")).alias("json"))


def added(articles: DataFrame, index: DataFrame) -> DataFrame:
    """What a workspace takes: articles of new DOIs with their file names."""
    name = F.when(F.col("doi").isNotNull(), safe_file_name("source", "doi")).otherwise(F.concat("source", F.lit("_"), F.col("id").cast("string"), F.lit(".xml")))
    return unknown(articles, index).withColumn("file", name)


def metadata_csv(rows: DataFrame, path: str) -> None:
    """Metadata of converted files; lists of notes are joined."""
    rows.withColumn("notes", F.array_join("notes", ";")).write.mode("overwrite").csv(path, header=True)


def unified_manifest(outcomes: DataFrame, articles: DataFrame) -> DataFrame:
    """One row of JSON for a run over several sources: the counts of each and of all, and of the manifest."""
    by = F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", F.struct(*[c for c in outcomes.columns if c != "source"])))))
    counts = manifest_counts(articles).select(F.struct("*").alias("manifest"))
    return outcomes.agg(by.alias("sources")).join(F.broadcast(counts)).select(F.to_json(F.struct("sources", "manifest")).alias("json"))

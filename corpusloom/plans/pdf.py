"""PDF files to articles: a TEI service, its cache, metadata and JATS."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.ids import cache_key, path_stem
from corpusloom.functions.xml import jats_of_tei, tei_fields, validate_jats

#: The fixed columns of the metadata table.
COLUMNS = ("path", "sha1", "first_author", "year", "title", "journal", "DOI", "PMID", "PMCID", "source", "status", "notes")


def tei_of(files: DataFrame, service: Callable[[bytes, bool], "str | None"], cache: DataFrame | None = None) -> DataFrame:
    """``path, content`` to ``path, sha1, cache_key, tei, source``. The cache (``cache_key, tei``) is asked first; the
    service, which gets the bytes and whether the full text is wanted, is asked for the header alone if the full text
    fails. Write the result before using it twice: the service would be asked again."""
    keyed = files.select("path", "content", F.sha1("content").alias("sha1")).withColumn("cache_key", cache_key(path_stem("path"), "content"))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tei, source = [], []
            for body in b["content"].to_pylist():
                found, name = service(body, True), "grobid-fulltext"
                if found is None:
                    found, name = service(body, False), "grobid-header"
                tei.append(found)
                source.append(name if found is not None else "unknown")
            yield pa.record_batch({"path": b["path"], "sha1": b["sha1"], "cache_key": b["cache_key"], "tei": pa.array(tei, pa.string()), "source": pa.array(source, pa.string())})

    schema = "path string, sha1 string, cache_key string, tei string, source string"
    if cache is None:
        return keyed.mapInArrow(convert, schema)
    known = keyed.drop("content").join(cache.select("cache_key", "tei"), "cache_key").select("path", "sha1", "cache_key", "tei", F.lit("cache").alias("source"))
    return known.union(keyed.join(cache.select("cache_key"), "cache_key", "left_anti").select(keyed.columns).mapInArrow(convert, schema))


def articles(converted: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``path, sha1, source, metadata, jats, status, notes`` of converted files. ``ids`` (``doi, pmid, pmcid``) fills in
    what is known of a DOI."""
    rows = converted.withColumn("metadata", tei_fields("tei")).withColumn("jats", jats_of_tei("tei"))
    if ids is not None:
        known = ids.select(F.lower("doi").alias("__doi"), F.col("pmid").alias("__pmid"), F.col("pmcid").alias("__pmcid")).dropDuplicates(["__doi"])
        rows = rows.withColumn("__doi", F.lower(F.col("metadata")["DOI"])).join(known, "__doi", "left")
        new = F.map_filter(F.create_map(F.lit("PMID"), F.col("__pmid"), F.lit("PMCID"), F.col("__pmcid")), lambda k, v: v.isNotNull())
        rows = rows.withColumn("metadata", F.map_concat(F.map_filter("metadata", lambda k, v: ~F.map_contains_key(new, k)), new))
    v = rows.withColumn("v", validate_jats("jats"))
    notes = F.when(F.col("tei").isNull(), F.array(F.lit("no TEI"))).otherwise(F.col("v.errors"))
    return v.select("path", "sha1", "source", "metadata", "jats", F.when(F.col("tei").isNull(), "failed").otherwise(F.col("v.status")).alias("status"), notes.alias("notes"))


def metadata_table(rows: DataFrame) -> DataFrame:
    """One row a file, as for a CSV."""
    return rows.select(*[F.array_join("notes", ";").alias("notes") if c == "notes" else F.col(c) if c in ("path", "sha1", "source", "status") else F.col("metadata")[c].alias(c) for c in COLUMNS])

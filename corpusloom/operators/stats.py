"""Counts of what runs, manifests and packages hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTCOMES = ("fetched", "valid", "incomplete", "skipped", "duplicates", "errors", "resumed")
#: Mean size of an article in bytes, its compression, mean size of an open-access package, requests per second.
ARTICLE_BYTES, COMPRESSION, PACKAGE_BYTES, RATE, RATE_WITH_KEY = 150 * 1024, 10, 5 * 1024 * 1024, 2.0, 6.0


def outcomes(rows: DataFrame, source: str = "source", outcome: str = "outcome") -> DataFrame:
    """Rows found and of each outcome, by source."""
    return rows.groupBy(source).agg(F.count("*").alias("found"), *[F.count_if(F.col(outcome) == o).alias(o) for o in OUTCOMES])


def totals(rows: DataFrame, source: str = "source", outcome: str = "outcome") -> DataFrame:
    return rows.agg(F.count("*").alias("found"), *[F.count_if(F.col(outcome) == o).alias(o) for o in OUTCOMES], F.countDistinct(source).alias("sources"))


def manifest(rows: DataFrame, status: str = "status") -> DataFrame:
    n = lambda s: F.count_if(F.col(status) == s).alias(s)
    return rows.agg(F.count("*").alias("total"), n("valid"), n("incomplete"), n("invalid"))


def package(rows: DataFrame, source: str = "source", status: str = "status", size: str = "size") -> DataFrame:
    """Files, bytes and status counts of what a package holds, and its sources."""
    n = lambda s: F.count_if(F.col(status) == s).alias(s)
    return rows.agg(F.count("*").alias("files"), F.sum(size).alias("bytes"), n("valid"), n("incomplete"), F.array_join(F.sort_array(F.collect_set(source)), ",").alias("sources"))


def estimate(papers: Column | str, has_key: bool = False) -> list[Column]:
    """Bytes, compressed bytes and seconds that fetching so many papers takes."""
    n = F.col(papers) if isinstance(papers, str) else papers
    return [
        (n * ARTICLE_BYTES).cast("bigint").alias("bytes"),
        F.floor(n * ARTICLE_BYTES / COMPRESSION).cast("bigint").alias("compressed_bytes"),
        (n / (RATE_WITH_KEY if has_key else RATE)).cast("double").alias("seconds"),
        (n * PACKAGE_BYTES).cast("bigint").alias("package_bytes"),
    ]


def plan_total(*ids: DataFrame, key: str = "id") -> DataFrame:
    """``total``: how many different ids several plans hold together."""
    together = reduce(DataFrame.union, [x.select(key) for x in ids])
    return together.agg(F.countDistinct(key).alias("total"))

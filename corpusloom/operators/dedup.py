"""Duplicates within a run by priority, and against what is known already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.ids import col, doi_key
from corpusloom.functions.search import SOURCES


def source_priority(source: Column | str, order: tuple[str, ...] = SOURCES) -> Column:
    """The place of a source in the order; unknown sources come last."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for i, s in enumerate(order) for x in (s, i)]), col(source)), F.lit(len(order)))


def _ranked(articles: DataFrame, doi: str, source: str, path: str) -> DataFrame:
    keyed = articles.withColumn("__doi", doi_key(doi))
    order = [source_priority(source), F.col(path)]
    first = Window.partitionBy("__doi").orderBy(*order)
    return keyed.withColumn("__rank", F.row_number().over(first)).withColumn("__kept", F.first(path).over(first))


def winners(articles: DataFrame, doi: str = "doi", source: str = "source", path: str = "path") -> DataFrame:
    """One article of each DOI: that of the source that comes first, then of the least path. Articles without a DOI all
    stay and don't enter the window, so they make no hot key."""
    with_doi = doi_key(doi).isNotNull()
    best = _ranked(articles.where(with_doi), doi, source, path).where("__rank = 1").drop("__doi", "__rank", "__kept")
    return best.unionByName(articles.where(~with_doi))


def duplicates(articles: DataFrame, doi: str = "doi", source: str = "source", path: str = "path") -> DataFrame:
    """``doi, removed, kept``: the paths of what :func:`winners` leaves out."""
    ranked = _ranked(articles.where(doi_key(doi).isNotNull()), doi, source, path).where("__rank > 1")
    return ranked.select(F.col("__doi").alias("doi"), F.col(path).alias("removed"), F.col("__kept").alias("kept"))


def unknown(articles: DataFrame, index: DataFrame, doi: str = "doi", index_doi: str = "doi") -> DataFrame:
    """Articles whose DOI isn't in the index; those without a DOI always pass. Spark broadcasts the index if it is small."""
    keys = index.select(doi_key(index_doi).alias("__key")).where("__key is not null").distinct()
    return articles.withColumn("__key", doi_key(doi)).join(keys, "__key", "left_anti").select(*articles.columns)


def already_known(articles: DataFrame, index: DataFrame, doi: str = "doi", index_doi: str = "doi") -> DataFrame:
    keys = index.select(doi_key(index_doi).alias("__key")).where("__key is not null").distinct()
    return articles.withColumn("__key", doi_key(doi)).join(keys, "__key", "left_semi").select(*articles.columns)


def remaining(articles: DataFrame, progress: DataFrame, key: str = "id") -> DataFrame:
    """Articles that a run that was broken off hasn't completed; failed ones are tried again."""
    return articles.join(progress.where("state = 'completed'").select(key).distinct(), key, "left_anti").select(*articles.columns)


def changed(articles: DataFrame, manifest: DataFrame, *keys: str) -> DataFrame:
    """Articles of which the manifest has no row with the same keys, such as id and content hash."""
    return articles.join(manifest.select(*keys).distinct(), list(keys), "left_anti").select(*articles.columns)


def first_of_each(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__rank = 1").drop("__rank")


def distinct_in_order(df: DataFrame, key: str, order: str) -> DataFrame:
    """Each key once, with the place where it first occurs."""
    return df.groupBy(key).agg(F.min(order).alias(order))


def converted(asked: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """Each row of ``asked`` with the columns of its key's answer, null where there is none; of several answers one counts,
    the smallest."""
    others = [c for c in answers.columns if c != key]
    one = answers.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*others)).alias("__answer"))
    return asked.join(one, key, "left").select(*[asked[c] for c in asked.columns], *[F.col(f"__answer.{c}") for c in others])

"""Responses of the metadata services, parsed to article rows. Input: a column of JSON or XML pages; typed schemas, no
inference."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.ids import arxiv_link_doi, filled, normalize_pmcid
from corpusloom.functions.text import joined_names, split_names

_EPMC = """struct<hitCount: long, nextCursorMark: string, resultList: struct<result: array<struct<id: string, source: string, pmid: string,
 pmcid: string, doi: string, title: string, authorString: string, authorList: struct<author: array<struct<fullName: string, firstName: string, lastName: string>>>,
 abstractText: string, journalTitle: string, pubYear: string, firstPublicationDate: string, isOpenAccess: string, hasFullText: string>>>>"""
_BIORXIV = """struct<messages: array<struct<status: string, count: string, cursor: string, total: string>>, collection: array<struct<doi: string,
 title: string, authors: string, abstract: string, category: string, date: string, version: string, license: string, jatsxml: string, published: string, server: string>>>"""
_CHEMRXIV = """struct<totalCount: long, itemHits: array<struct<item: struct<id: string, doi: string, title: string,
 authors: array<struct<firstName: string, lastName: string>>, abstract: string, categories: array<struct<name: string>>, subjects: array<struct<name: string>>,
 publishedDate: string, version: string, license: struct<name: string>, asset: struct<original: struct<url: string>>>>>>"""
_LINK = "struct<id: string, source: string, title: string, doi: string, pmid: string, pmcid: string>"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def europepmc_articles(pages: DataFrame, column: str = "json") -> DataFrame:
    """Articles of search pages. Rows without an id go; malformed PMCIDs stay as they are; what can't be read as a date
    or a year is null."""
    r = pages.select(F.explode(F.from_json(column, _EPMC)["resultList"]["result"]).alias("r")).where(filled("r.id").isNotNull()).select("r.*")
    listed = F.filter(F.transform(F.col("authorList.author"), lambda a: F.coalesce(filled(a["fullName"]), F.trim(F.concat_ws(" ", a["firstName"], a["lastName"])))), lambda n: n != "")
    authors = F.when(F.size(listed) > 0, listed).otherwise(F.coalesce(split_names("authorString", ","), F.array().cast("array<string>")))
    return r.select(
        "id", _text(F.col("source")).alias("source"), filled("pmid").alias("pmid"), F.coalesce(normalize_pmcid("pmcid"), filled("pmcid")).alias("pmcid"), filled("doi").alias("doi"),
        _text(F.col("title")).alias("title"), authors.alias("authors"), _text(F.col("abstractText")).alias("abstract"), _text(F.col("journalTitle")).alias("journal"),
        F.col("pubYear").try_cast("int").alias("pub_year"), F.try_to_timestamp("firstPublicationDate", F.lit("yyyy-MM-dd")).cast("date").alias("first_publication_date"),
        (_text(F.col("isOpenAccess")) == "Y").alias("is_open_access"), ((_text(F.col("hasFullText")) == "Y") | (_text(F.col("source")) == "PMC")).alias("has_full_text"),
    )


def europepmc_records(pages: DataFrame, column: str = "json") -> DataFrame:
    """``page, at`` and the columns of a record (id, source, title, doi, pmid, pmcid) of search pages, as they are."""
    each = pages.select("page", F.posexplode(F.from_json(column, _EPMC)["resultList"]["result"]).alias("at", "r"))
    return each.where(filled("r.id").isNotNull()).select("page", "at", *[f"r.{c}" for c in ("id", "source", "title", "doi", "pmid", "pmcid")])


def europepmc_links(pages: DataFrame, kind: str, column: str = "json") -> DataFrame:
    """``src_source, src_id, kind, pos, record, complete`` of pages of a node's citations or references. One item may
    stand without a list; a count that can't be read is null, and the list then counts as complete."""
    outer, inner = ("citationList", "citation") if kind == "citations" else ("referenceList", "reference")
    items = F.get_json_object(column, f"$.{outer}.{inner}")
    rows = F.when(items.startswith("["), F.from_json(items, f"array<{_LINK}>")).when(items.startswith("{"), F.array(F.from_json(items, _LINK)))
    listed = pages.select("src_source", "src_id", "page", F.get_json_object(column, "$.hitCount").try_cast("long").alias("hits"), rows.alias("rows"))
    node = ["src_source", "src_id"]
    counts = listed.groupBy(*node).agg(F.max("hits").alias("hits"), F.sum(F.coalesce(F.size("rows"), F.lit(0))).alias("got"))
    each = listed.select(*node, "page", F.posexplode("rows").alias("at", "record")).withColumn("pos", (F.col("page") * 1000 + F.col("at")).cast("int"))
    return each.join(counts, node).select(*node, F.lit(kind).alias("kind"), "pos", "record", F.coalesce(F.col("got") >= F.col("hits"), F.lit(True)).alias("complete"))


def link_outcomes(pages: DataFrame, column: str = "json") -> DataFrame:
    """Each asked list's outcome, ``src_source, src_id, kind, pages, hits, got, error, complete``, of pages that may have
    failed (``json`` null, ``error`` given). A list is complete if no page failed and it holds as many as were told."""
    outer = lambda n: F.get_json_object(column, f"$.{n}")
    items = F.coalesce(outer("citationList.citation"), outer("referenceList.reference"))
    rows = F.when(items.startswith("["), F.size(F.from_json(items, f"array<{_LINK}>"))).when(items.startswith("{"), 1).otherwise(0)
    told = pages.withColumns({"__rows": rows, "__hits": outer("hitCount").try_cast("long")})
    by = told.groupBy("src_source", "src_id", "kind").agg(F.count(column).alias("pages"), F.max("__hits").alias("hits"), F.sum("__rows").alias("got"), F.max("error").alias("error"))
    return by.withColumn("complete", F.col("error").isNull() & (F.col("got") >= F.coalesce("hits", F.lit(0))))


def biorxiv_articles(pages: DataFrame, as_of: Column, column: str = "json") -> DataFrame:
    """Articles of either server; ``as_of`` stands for dates that can't be read."""
    r = pages.select(F.explode(F.from_json(column, _BIORXIV)["collection"]).alias("r")).where(filled("r.doi").isNotNull()).select("r.*")
    return r.select(
        "doi", _text(F.col("title")).alias("title"), F.coalesce(split_names("authors", ";"), F.array().cast("array<string>")).alias("authors"), _text(F.col("abstract")).alias("abstract"),
        _text(F.col("category")).alias("category"), F.coalesce(F.try_to_timestamp("date", F.lit("yyyy-MM-dd")).cast("date"), as_of.cast("date")).alias("date"),
        F.coalesce(F.col("version").try_cast("int"), F.lit(1)).alias("version"), filled("license").alias("license"), filled("jatsxml").alias("jatsxml_url"),
        F.lower(_text(F.col("server"))).alias("server"), F.nullif(filled("published"), F.lit("NA")).alias("published_doi"),
    )


def biorxiv_next(pages: DataFrame, column: str = "json") -> DataFrame:
    """``cursor, total, next_cursor``: the place after the page by its length, or null at the end."""
    page = F.from_json(column, _BIORXIV)
    m = pages.select(page["messages"][0].alias("m"), F.coalesce(F.size(page["collection"]), F.lit(0)).alias("n"))
    cursor, total = F.coalesce(F.col("m.cursor").try_cast("long"), F.lit(0)), F.col("m.total").try_cast("long")
    return m.select(cursor.alias("cursor"), total.alias("total"), F.when((F.col("n") > 0) & (cursor + F.col("n") < total), cursor + F.col("n")).alias("next_cursor"))


def chemrxiv_articles(pages: DataFrame, as_of: Column, column: str = "json") -> DataFrame:
    r = pages.select(F.explode(F.from_json(column, _CHEMRXIV)["itemHits"]).alias("h")).where(filled("h.item.id").isNotNull()).select("h.item.*")
    names = lambda c: F.coalesce(F.filter(F.transform(c, lambda x: x["name"]), lambda n: n != ""), F.array().cast("array<string>"))
    return r.select(
        F.col("id").alias("item_id"), _text(F.col("doi")).alias("doi"), _text(F.col("title")).alias("title"), F.coalesce(joined_names("authors"), F.array().cast("array<string>")).alias("authors"),
        _text(F.col("abstract")).alias("abstract"), names("categories").alias("categories"), names("subjects").alias("subjects"),
        F.coalesce(F.try_to_timestamp("publishedDate"), as_of.cast("timestamp")).alias("published_date"), F.coalesce(F.col("version").try_cast("int"), F.lit(1)).alias("version"),
        F.col("license.name").alias("license"), F.col("asset.original.url").alias("pdf_url"),
    )


ATOM, ARXIV = "{http://www.w3.org/2005/Atom}", "{http://arxiv.org/schemas/atom}"
_LISTS = ("authors", "categories")
_ENTRY = T.ArrayType(T.StructType([
    T.StructField(c, T.ArrayType(T.StringType()) if c in _LISTS else T.StringType())
    for c in ("arxiv_id", "title", "authors", "abstract", "categories", "published", "updated", "doi", "doi_link")
]))


def atom_entries(xml: str | None) -> list[dict]:
    """Entries of an Atom page; none of a page that can't be parsed. The primary category comes first."""
    try:
        root = ET.fromstring(xml or "")
    except (ET.ParseError, ValueError):
        return []
    squeezed = lambda e, tag: " ".join((e.findtext(tag) or "").split())
    out = []
    for e in root.iter(f"{ATOM}entry"):
        url = e.findtext(f"{ATOM}id") or ""
        if "/abs/" not in url:
            continue
        primary = e.find(f"{ARXIV}primary_category")
        cats = [c.get("term") for c in ([primary] if primary is not None else []) + e.findall(f"{ATOM}category")]
        links = [x.get("href") for x in e.findall(f"{ATOM}link") if x.get("title") == "doi"]
        out.append({
            "arxiv_id": url.partition("/abs/")[2], "title": squeezed(e, f"{ATOM}title"), "authors": [n for a in e.findall(f"{ATOM}author") if (n := squeezed(a, f"{ATOM}name"))],
            "abstract": squeezed(e, f"{ATOM}summary"), "categories": list(dict.fromkeys(c for c in cats if c)), "published": e.findtext(f"{ATOM}published"), "updated": e.findtext(f"{ATOM}updated"),
            "doi": e.findtext(f"{ARXIV}doi"), "doi_link": links[0] if links else None,
        })
    return out


@F.pandas_udf(_ENTRY)
def _entries(x: pd.Series) -> pd.Series:
    return x.map(atom_entries)


def arxiv_articles(pages: DataFrame, as_of: Column, column: str = "xml") -> DataFrame:
    e = pages.select(F.explode(_entries(column)).alias("e")).select("e.*")
    return e.select(
        "arxiv_id", "title", "authors", "abstract", "categories", F.coalesce(F.try_to_timestamp("published"), as_of.cast("timestamp")).alias("published"),
        F.try_to_timestamp("updated").alias("updated"), F.coalesce(filled("doi"), arxiv_link_doi("doi_link")).alias("doi"),
        F.concat(F.lit("https://arxiv.org/pdf/"), F.col("arxiv_id"), F.lit(".pdf")).alias("pdf_url"),
    )


def esearch_ids(pages: DataFrame, column: str = "json") -> DataFrame:
    found = F.from_json(column, "struct<esearchresult: struct<count: string, idlist: array<string>>>")["esearchresult"]
    return pages.select(found["count"].try_cast("long").alias("count"), F.explode(found["idlist"]).alias("pmid"))


def converted_ids(pages: DataFrame, column: str = "json") -> DataFrame:
    """``requested, pmid, pmcid, doi`` of id converter answers; numbers become strings, records in error go."""
    found = F.from_json(column, "struct<records: array<struct<pmid: string, pmcid: string, doi: string, `requested-id`: string, status: string>>>")["records"]
    r = pages.select(F.explode(found).alias("r")).select(F.col("r.requested-id").alias("requested"), "r.pmid", normalize_pmcid("r.pmcid").alias("pmcid"), "r.doi", "r.status")
    return r.where("status is null or status <> 'error'").select(F.coalesce("requested", "pmid", "pmcid", "doi").alias("requested"), "pmid", "pmcid", "doi")


def in_days(articles: DataFrame, date: str, as_of: Column, days: int = 30) -> DataFrame:
    """Articles of the last days."""
    return articles.where((F.col(date) >= F.date_sub(as_of, days)) & (F.col(date) <= as_of.cast("date")))

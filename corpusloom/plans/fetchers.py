"""Finders and fetchers of the six sources, for :mod:`corpusloom.plans.collect`."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.ids import filled, normalize_pmcid
from corpusloom.functions.search import Search, arxiv_since, pubmed_since
from corpusloom.functions import xml
from corpusloom.functions.xml import validate_jats
from corpusloom.operators import dedup, graph
from corpusloom.sources import feeds, services

#: Days that a preprint server is read for where a search has no dates.
DAYS = 30
#: Before the publication days of any article.
FIRST_DAY = date(1700, 1, 1)


def _article(source: str, id_: str, day: str, pmcid: Column | None = None, doi: Column | None = None) -> list[Column]:
    none = F.lit(None).cast("string")
    return [
        F.lit(source).alias("source"), F.col(id_).alias("id"), (none if pmcid is None else pmcid).alias("pmcid"),
        (none if doi is None else doi).alias("doi"), F.col("title"), F.col(day).cast("date").alias("first_date"),
        none.alias("xml"),
    ]


@dataclass
class Services:
    """How the services are reached: ``transport`` (``module:name``) for Spark's tasks and ``call`` for the driver, both
    over HTTP by default."""

    transport: str | None = None
    http: dict = field(default_factory=dict)
    call: services.Transport | None = None
    #: TEI of a PDF file's bytes (and whether the full text is wanted), for sources that have nothing else.
    pdf: Callable[[bytes, bool], "str | None"] | None = None

    def __post_init__(self):
        self.call = self.call or (services._loaded(self.transport) if self.transport else services.Http(**self.http))

    def pages(self, spark: SparkSession, service: str, params: dict, limit: int | None, column: str = "json", size: int = 100) -> DataFrame:
        found = services.pages(spark, service, params, self.transport, limit, size, http=self.http)
        return found.select("page", F.col("body").alias(column))

    # Finders.

    def find_europepmc(self, spark: SparkSession, search: Search, since: str | None) -> DataFrame:
        query = search.europepmc() + (f" AND FIRST_PDATE:[{since} TO *]" if since else "")
        limit = search._limit("europepmc")
        found = feeds.europepmc_articles(self.pages(spark, "europepmc", {"query": query}, limit, size=1000))
        with_id = found.where("pmcid is not null").withColumn("key", F.col("pmcid"))
        return with_id.select(_article("europepmc", "key", "first_publication_date", F.col("pmcid"), F.col("doi")))

    def find_pmc(self, spark: SparkSession, search: Search, since: str | None) -> DataFrame:
        """All that PubMed finds, by windows of days where one answer can't hold it; ids are converted by tasks."""
        query = pubmed_since(search.pubmed_by_category(), since) if since else search.pubmed_by_category()
        limit = search._limit("pmc")
        if limit and limit <= services.MOST_IDS:
            ids = spark.createDataFrame([(p,) for p in services.esearch(self.call, query, limit)], "id string")
        else:
            ids = services.search_ids(spark, self.call, query, FIRST_DAY, datetime.now(UTC).date() + timedelta(days=366)).select(F.col("pmid").alias("id"))
        found = services.convert_ids(ids, self.call).select(normalize_pmcid("pmcid").alias("pmcid"), "doi").where("pmcid is not null")
        found = found.withColumns({"title": F.lit(""), "day": F.lit(None).cast("date"), "key": F.col("pmcid")})
        return found.select(_article("pmc", "key", "day", F.col("pmcid"), F.col("doi")))

    def find_arxiv(self, spark: SparkSession, search: Search, since: str | None) -> DataFrame:
        query = arxiv_since(search.arxiv(), since) if since else search.arxiv()
        pages = self.pages(spark, "arxiv", {"search_query": query}, search._limit("arxiv"), "xml")
        found = feeds.arxiv_articles(pages, F.current_timestamp())
        if search.date_range:
            found = found.where(F.col("published").cast("date").between(search.date_range.iso("start"), search.date_range.iso("end")))
        return found.select(_article("arxiv", "arxiv_id", "published", doi=F.col("doi")))

    def find_preprints(self, server: str):
        def find(spark: SparkSession, search: Search, since: str | None) -> DataFrame:
            own, today = search.biorxiv(server), datetime.now(UTC).date()
            start = since or own.get("start_date") or (today - timedelta(days=DAYS)).isoformat()
            params = {"server": server, "interval": f"{start}/{own.get('end_date') or today.isoformat()}"}
            if own.get("category"):
                params["category"] = own["category"].replace(" ", "_")
            found = feeds.biorxiv_articles(self.pages(spark, "biorxiv", params, None), F.current_date())
            # The service has no search: the keywords are sought here. Of several versions the last counts.
            found = found.where(search.predicate("category", authors="authors"))
            latest = dedup.first_of_each(found, "doi", F.desc("version"), "title")
            return latest.withColumn("key", F.col("doi")).select(_article(server, "key", "date", doi=F.col("doi")))

        return find

    def find_chemrxiv(self, spark: SparkSession, search: Search, since: str | None) -> DataFrame:
        own = search.chemrxiv()
        names = {"term": "term", "date_from": "searchDateFrom", "date_to": "searchDateTo"}
        params = {names[k]: v for k, v in own.items() if k in names} | ({"searchDateFrom": since} if since else {})
        if own.get("category_ids"):
            params["categoryIds"] = ",".join(map(str, own["category_ids"]))
        found = feeds.chemrxiv_articles(self.pages(spark, "chemrxiv", params, own.get("max_results"), size=50), F.current_timestamp())
        return found.select(_article("chemrxiv", "item_id", "published_date", doi=F.nullif(F.col("doi"), F.lit(""))))

    def finders(self) -> dict:
        return {
            "europepmc": self.find_europepmc, "pmc": self.find_pmc, "arxiv": self.find_arxiv, "chemrxiv": self.find_chemrxiv,
            "biorxiv": self.find_preprints("biorxiv"), "medrxiv": self.find_preprints("medrxiv"),
        }

    # Full texts.

    def fetch_pmc(self, articles: DataFrame) -> DataFrame:
        return matching(services.fetch_texts(articles.select(F.col("id").alias("pmcid")), self.call))

    def fetch_europepmc(self, articles: DataFrame) -> DataFrame:
        return matching(services.fetch_texts(articles.select(F.col("id").alias("pmcid")), self.call, service="europepmc_text"))

    def fetch_preprints(self, server: str):
        return lambda articles: services.fetch_texts(articles.select("id"), PreprintText(self.call, server), "id", server)

    def fetch_pdfs(self, source: str):
        """Texts of a source that has PDF files only. Without a conversion there are none, which is an error of the
        source and not of its articles."""

        def fetch(articles: DataFrame) -> DataFrame:
            if self.pdf is None:
                raise ValueError(f"{source} has PDF files only: a conversion (pdf) is needed for their texts")
            return services.fetch_texts(articles.select("id"), PdfText(self.call, source, self.pdf), "id", source)

        return fetch

    def fetchers(self) -> dict:
        return {
            "pmc": self.fetch_pmc, "europepmc": self.fetch_europepmc, "arxiv": self.fetch_pdfs("arxiv"), "chemrxiv": self.fetch_pdfs("chemrxiv"),
            "biorxiv": self.fetch_preprints("biorxiv"), "medrxiv": self.fetch_preprints("medrxiv"),
        }

    def links(self, kinds: tuple[str, ...], limit: int | None = None):
        """Lists of nodes for :func:`corpusloom.operators.graph.expand`: asked once a hop, for that hop's nodes only."""

        def lists(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
            both = [edges_of(services.link_pages(nodes, self.call, k, limit), k) for k in kinds]
            edges, outcomes = both[0]
            for more, ends in both[1:]:
                edges, outcomes = edges.union(more), outcomes.union(ends)
            return edges, outcomes

        return lists


    def pmcids_of(self, spark: SparkSession, papers: DataFrame) -> DataFrame:
        """``pmid, pmcid`` of the articles that papers without a PMCID name by their PMID, as the converter knows them."""
        pmid = F.coalesce(filled("pmid"), F.when(F.col("source") == "MED", filled("id")))
        ids = papers.where(normalize_pmcid("pmcid").isNull()).select(pmid.alias("id")).where("id is not null").distinct()
        found = services.convert_ids(ids, self.call)
        return graph._write(spark, found.select(F.coalesce("pmid", "requested").alias("pmid"), "pmcid"))


@dataclass
class PreprintText:
    """The JATS text of a preprint by its DOI: the address is in its metadata."""

    call: services.Transport
    server: str

    def shared(self, readers: int, reader: int) -> PreprintText:
        return replace(self, call=services.share(self.call, readers, reader))

    def __call__(self, _: str, params: dict) -> str | None:
        told = self.call("biorxiv_doi", {"server": self.server, "doi": params["id"]})
        versions = (json.loads(told) if told else {}).get("collection") or []
        address = versions[-1].get("jatsxml") if versions else None
        found = services.body_of(self.call, address, "biorxiv", "jatsxml") if address else None
        return found.decode("utf-8", "replace") if isinstance(found, bytes) else found


@dataclass
class PdfText:
    """The text of an article that its source has as a PDF file, converted to JATS. ``pdf`` makes TEI of a file's bytes; it
    is told whether the full text is wanted, and asked for the header alone if that fails."""

    call: services.Transport
    source: str
    pdf: Callable[[bytes, bool], "str | None"]

    def shared(self, readers: int, reader: int) -> PdfText:
        return replace(self, call=services.share(self.call, readers, reader))

    def address(self, id_: str) -> str | None:
        if self.source == "arxiv":
            return f"https://arxiv.org/pdf/{id_}.pdf"
        told = self.call("chemrxiv_item", {"id": id_})
        return ((((json.loads(told) if told else {}).get("asset") or {}).get("original")) or {}).get("url")

    def __call__(self, _: str, params: dict) -> str | None:
        address = self.address(params["id"])
        body = services.body_of(self.call, address, self.source, "pdf") if address else None
        if body is None:
            return None
        data = body if isinstance(body, bytes) else body.encode()
        return xml.tei_to_jats(self.pdf(data, True) or self.pdf(data, False))


def matching(texts: DataFrame) -> DataFrame:
    """``pmcid, xml`` (and ``error``) to ``id, xml, error``: an answer for another article than was asked for is none. One
    that names no PMCID is taken."""
    told = normalize_pmcid(validate_jats("xml")["pmcid"])
    right = told.isNull() | (told == normalize_pmcid("pmcid"))
    before = F.col("error") if "error" in texts.columns else F.lit(None).cast("string")
    return texts.select(F.col("pmcid").alias("id"), F.when(right, F.col("xml")).alias("xml"), F.when(right, before).otherwise("another article").alias("error"))


def edges_of(pages: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Edges and outcomes of the pages of lists, which are written first: both read them."""
    written = graph._write(pages.sparkSession, pages)
    outcomes = feeds.link_outcomes(written)
    edges = feeds.europepmc_links(written.where("json is not null"), kind).drop("complete")
    ends = outcomes.select("src_source", "src_id", "complete")
    return edges.join(ends, ["src_source", "src_id"]).select("src_source", "src_id", "kind", "pos", "record", "complete"), outcomes


def links(call: services.Transport, spark: SparkSession, nodes: list[tuple[str, str]], kind: str, limit: int | None = None) -> DataFrame:
    """The citations or references of articles (source, id), as edges of :func:`corpusloom.operators.graph.expand`. A list
    that breaks off keeps what was read and is not complete."""
    asked = spark.createDataFrame(nodes, "src_source string, src_id string")
    return edges_of(services.link_pages(asked, call, kind, limit), kind)[0]


def recent(server: str, days: int, today: date | None = None) -> dict:
    """Parameters for a preprint server's last days."""
    end = today or datetime.now(UTC).date()
    return {"server": server, "interval": f"{(end - timedelta(days=days)).isoformat()}/{end.isoformat()}"}

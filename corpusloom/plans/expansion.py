"""Expansion as a user runs it: a search's seeds, their links hop by hop, ids resolved, a plan that is kept, its replay."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.ids import normalize_pmcid
from corpusloom.functions.search import Search
from corpusloom.operators import graph, stats
from corpusloom.operators.commits import CommitLog
from corpusloom.plans.collect import ARTICLE, Finder, Outcome, Workspace, collect_source
from corpusloom.plans.fetchers import Services
from corpusloom.sources import feeds, services

PLANS = {
    "plans": "plan string, ordinal bigint, pmcid string, role string",
    "outcomes": "plan string, kind string, total bigint, own bigint, by_source bigint, by_pmid bigint, none bigint",
    "failed": "plan string, node string",
}


@dataclass
class Planned:
    """A kept plan's name, and what led to it."""

    plan: str
    seeds: int
    invalid_seeds: int
    planned: int
    expansion: graph.Expansion


class Plans:
    """Plans by name in a commit log: a plan is there in whole or not at all, and the same plan is kept once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.log = spark, CommitLog(spark, f"{root.rstrip('/')}/expansions", PLANS)

    def keep(self, plan: DataFrame, resolution: DataFrame, failed: DataFrame) -> str:
        name = plan.select("plan").first()
        name = name.plan if name else "empty"
        if not self.log.published(name):
            tag = F.lit(name).alias("plan")
            self.log.commit(name, {"plans": plan, "outcomes": resolution.select(tag, "*"), "failed": failed.select(tag, "node")})
        return name

    def plan(self, name: str, limit: int | None = None) -> DataFrame:
        """The first ``limit`` rows of a plan in its order, or all."""
        if not self.log.published(name):
            raise ValueError(f"there is no plan {name}")
        rows = self.log.table("plans").where(F.col("plan") == name)
        return rows.where(F.col("ordinal") <= limit) if limit is not None else rows

    def estimate(self, name: str, limit: int | None = None) -> DataFrame:
        """One row: rows of the plan and what fetching them will take."""
        counted = self.plan(name, limit).agg(F.count("*").alias("n"))
        return counted.select("n", *stats.estimate("n"))


def seeds_of(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles that a search found (``position`` and the columns of a record) as seeds, and one row: ``found``, and
    ``invalid_pmcid``, those without a valid PMCID, which are left out."""
    counts = found.agg(F.count("*").alias("found"), F.count_if(normalize_pmcid("pmcid").isNull()).alias("invalid_pmcid"))
    return graph.prepared_seeds(found, "position"), counts


def expand_search(spark: SparkSession, reached: Services, search: Search, root: str) -> Planned:
    """Searches, follows the links of what is found as the search says, resolves PMCIDs and keeps the plan."""
    limit = search._limit("europepmc")
    pages = services.pages(spark, "europepmc", {"query": search.europepmc()}, reached.transport, limit, 1000, http=reached.http)
    rows = graph._write(spark, pages.select("page", F.col("body").alias("json")))
    position = F.col("page") * 1000 + F.col("at")
    found = feeds.europepmc_records(rows).withColumn("position", position.cast("bigint"))
    seeds, counts = seeds_of(graph._write(spark, found.orderBy("position").limit(limit) if limit else found))
    seeds = graph._write(spark, seeds)
    kinds = tuple(k for k, on in (("references", search.expand_references), ("citations", search.expand_citations)) if on)
    made = graph.expand(seeds, reached.links(kinds) if kinds else (lambda nodes: (_no_edges(spark), None)), kinds, search.expansion_depth, search.max_expansion)
    papers = graph._write(spark, made.papers)
    articles = reached.pmcids_of(spark, papers)
    told = graph.resolved(papers, articles)
    plan = graph._write(spark, graph.versioned(graph.plan(seeds, told)))
    name = Plans(spark, root).keep(plan, graph.resolution(papers, articles), made.failed)
    one = counts.first()
    return Planned(name, one.found - one.invalid_pmcid, one.invalid_pmcid, plan.count(), made)


def _no_edges(spark: SparkSession) -> DataFrame:
    record = ", ".join(f"{c}: string" for c in graph.RECORD)
    return spark.createDataFrame([], f"src_source string, src_id string, kind string, pos int, record struct<{record}>, complete boolean")


def finder(plans: Plans, name: str, limit: int | None = None) -> Finder:
    """A kept plan as what is found: its rows go through the collection like a search's, so what is done is left out and a
    run that was broken off goes on."""

    def find(spark: SparkSession, search: Search, since: str | None) -> DataFrame:
        none = F.lit(None).cast("string")
        columns = {"source": F.lit("pmc"), "id": F.col("pmcid"), "pmcid": F.col("pmcid"), "doi": none, "title": F.lit(""), "first_date": F.lit(None).cast("date"), "xml": none}
        return plans.plan(name, limit).select(*[columns[c.split()[0]].alias(c.split()[0]) for c in ARTICLE.split(", ")])

    return find


def given(pmcids: list[str]) -> Finder:
    """Ids that a user names as what is found. All of them have to be PMCIDs: one that isn't refuses the whole."""
    wrong = [p for p in pmcids if pmcid_of(p) is None]
    if wrong:
        raise ValueError(f"not a PMCID: {', '.join(wrong)}")

    def find(spark: SparkSession, search: Search, since: str | None) -> DataFrame:
        none, own = F.lit(None).cast("string"), spark.createDataFrame([(pmcid_of(p),) for p in pmcids], "pmcid string")
        return own.select(F.lit("pmc").alias("source"), F.col("pmcid").alias("id"), "pmcid", none.alias("doi"), F.lit("").alias("title"), F.lit(None).cast("date").alias("first_date"), none.alias("xml"))

    return find


def pmcid_of(text: str) -> str | None:
    """A PMCID as users write it, in its one form."""
    found = re.fullmatch(r"(?i)(?:PMC)?0*(\d+)", text.strip())
    return f"PMC{found[1]}" if found else None


def replay(workspace: Workspace, reached: Services, name: str, search: Search, limit: int | None = None, **how) -> Outcome:  # noqa: ANN003
    """Fetches what a kept plan names, all of it or its first ``limit`` rows. The progress of a plan is its own."""
    plans = Plans(workspace.spark, workspace.root)
    return collect_source(workspace, "pmc", replace(search, max_results_per_source=None), finder(plans, name, limit), reached.fetch_pmc, key=f"plan-{name}", **how)

"""Collecting a corpus: search, gates, full texts, validation, duplicates, manifest. And a workspace that remembers.

State is kept in tables of a :class:`corpusloom.operators.commits.CommitLog`: ``doi_index``, ``markers``, ``searches``,
``progress``, ``articles``. A source is read once, its articles are then dealt with in batches; what a batch did is seen in
all tables at once, so a run that is broken off anywhere goes on where its last batch ended.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.ids import doi_key, filled, normalize_pmcid, safe_file_name
from corpusloom.functions.search import SOURCES, Search
from corpusloom.functions.text import is_full_text
from corpusloom.functions.xml import jats_facts
from corpusloom.operators import dedup, graph, save, state, stats
from corpusloom.operators.commits import CommitLog
from corpusloom.operators.observed import Progress, reporter, small, written
from corpusloom.sources.archives import write_parts

ARTICLE = "source string, id string, pmcid string, doi string, title string, first_date date, xml string"
#: A source's articles for a search: DataFrame of ARTICLE; xml may be null if it has to be fetched.
Finder = Callable[[SparkSession, Search, "str | None"], DataFrame]
#: Articles without xml to ``id, xml`` and, if it can tell, ``error``: why there is none.
Fetcher = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Cadence:
    """A batch has ``items`` articles at first, then as many as lasted about ``seconds``, and never fewer: a run that is
    lost loses at most about that much work."""

    items: int = 10
    seconds: float = 30.0
    clock: Callable[[], float] = time.monotonic

    def next(self, size: int, took: float) -> int:
        return max(self.items, min(8 * size, int(size * self.seconds / max(took, 1e-3))))


class Workspace:
    """A corpus that grows over runs."""

    TABLES = {
        "doi_index": "doi string, file string, source string, search_id string, added timestamp",
        "markers": "source string, last_fetch timestamp, papers_fetched bigint",
        "searches": "id string, ts timestamp, source string, config string, statistics string",
        "progress": "source string, config_hash string, id string, state string, error string, ts timestamp",
        "articles": "source string, id string, pmcid string, doi string, title string, file string, status string, body_chars int, sha256 string, xml string, search_id string, folder string",
    }

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.log = CommitLog(spark, root, self.TABLES, keyed={"doi_index": ("doi", 64)})

    @classmethod
    def init(cls, spark: SparkSession, root: str) -> Workspace:
        """A new workspace; one that is there already is an error."""
        w = cls(spark, root)
        if w.is_workspace():
            raise ValueError(f"{root} is a workspace already")
        w.log.publish("init")
        return w

    def is_workspace(self) -> bool:
        return self.log.exists("commits")

    def path(self, name: str) -> str:
        return self.log.path(name)

    def table(self, name: str) -> DataFrame:
        return self.log.table(name)

    def append(self, name: str, rows: DataFrame) -> None:
        self.log.commit(f"{name}-{datetime.now(UTC):%Y%m%dT%H%M%S%f}", {name: rows})

    def clear(self, keep_history: bool = False) -> None:
        """Deletes the articles and the index; markers and searches too, unless history is kept."""
        for name in self.TABLES:
            if not (keep_history and name in ("markers", "searches")):
                self.log.delete(name)
        self.log.delete("staging")

    def searched(self, number: str, source: str, config: Search, statistics: dict) -> DataFrame:
        """The row of a search."""
        row = [(number, datetime.now(UTC).replace(tzinfo=None), source, json.dumps(config.to_dict(), sort_keys=True), json.dumps(statistics, sort_keys=True))]
        return self.spark.createDataFrame(row, self.TABLES["searches"])

    def record_search(self, source: str, config: Search, statistics: dict) -> str:
        number = self.log.reserve("search_", f"{source}-{config.config_hash()}")
        self.log.commit(f"{source}-{number}", {"searches": self.searched(number, source, config, statistics)})
        self.log.close(number)
        return number

    def history(self) -> DataFrame:
        return self.table("searches").orderBy(F.desc("ts"), F.desc("id"))

    def latest_configs(self) -> dict[str, Search]:
        """The last configuration of each source."""
        return {r.source: Search.from_json(r.config) for r in state.latest(self.table("searches")).collect()}

    def statistics(self) -> DataFrame:
        return stats.manifest(self.table("articles"))

    def build(self, uri: str, include_incomplete: bool = False, parts: int = 8) -> dict[str, int]:
        """Archives of the articles below ``uri``, written by tasks, with the workspace's history as a document in each.
        Returns how many files and bytes they hold, and how many of the files are valid."""
        rows = self.table("articles")
        rows = rows if include_incomplete else rows.where("status = 'valid'")
        history = [r.asDict() for r in self.history().select("id", "source", F.col("ts").cast("string").alias("ts"), "config", "statistics").limit(1000).collect()]
        named = rows.select(F.concat("folder", F.lit("/"), "file").alias("name"), F.col("xml").cast("binary").alias("body"))
        told = graph._write(self.spark, write_parts(named, uri, parts, {"searches": {"searches": history}}))
        held = told.agg(F.coalesce(F.sum("files"), F.lit(0)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
        by = {r.status: r["n"] for r in rows.groupBy("status").agg(F.count("*").alias("n")).collect()}
        return {"files": held.files, "bytes": held.bytes, "valid": by.get("valid", 0), "incomplete": by.get("incomplete", 0), "invalid": by.get("invalid", 0)}

    def last_day(self, source: str) -> str | None:
        day = self.table("markers").where(F.col("source") == source).agg(F.max(F.to_date("last_fetch")).cast("string")).first()[0]
        return day


@dataclass
class Outcome:
    """Counts of a source's run, or why it failed."""

    source: str
    counts: dict[str, int]
    error: str | None = None


def _staged(workspace: Workspace, source: str, search: Search, key: str, found: DataFrame, stage: str) -> tuple[DataFrame, dict[str, int]]:
    """What a source found, read once and written: (what is to be done, numbered from 1 in ``ordinal``; how many were
    found, how many are left after those done before, and how many of them are new)."""
    spark, own = workspace.spark, workspace.table("progress").where((F.col("source") == source) & (F.col("config_hash") == key))
    limit = search._limit(source)
    wanted = found.orderBy("id").limit(limit) if limit else found
    everything, counts = written(wanted.dropDuplicates(["id"]), f"{stage}/found", found=F.count(F.lit(1)))
    index = workspace.table("doi_index").select(doi_key("doi").alias("__key")).where("__key is not null").distinct().withColumn("__old", F.lit(True))
    todo = dedup.remaining(everything, own).withColumn("__key", doi_key("doi")).join(index, "__key", "left")
    new = F.col("__old").isNull()
    fresh, more = written(todo, f"{stage}/fresh", keep=new, left=F.count(F.lit(1)), new=F.count_if(new))
    numbered = graph._numbered(spark, fresh.select(*everything.columns, F.col("id").alias("at")), "ordinal")
    return written(numbered.select(*everything.columns, "ordinal"), f"{stage}/todo")[0], counts | more


def _batch(workspace: Workspace, source: str, key: str, number: str, rows: DataFrame, fetch: Fetcher | None, name: str, stage: str) -> dict[str, int]:
    """One batch: fetched, judged, written to all tables and published. Returns its counts."""
    log, now, none = workspace.log, F.current_timestamp(), F.lit(None).cast("string")
    asked = rows.withColumn("asked", F.col("xml").isNull())
    bodies = asked.where("not asked").select("id", "asked", "xml", none.alias("why"))
    if fetch is not None:
        got = fetch(rows.where("xml is null"))
        why = F.col("error") if "error" in got.columns else none
        bodies = bodies.union(got.select("id", F.lit(True), "xml", why))
    # Texts are fetched, parsed and written once, and read again only to be saved: all else is decided without them.
    parsed = bodies.withColumn("xml", F.when(is_full_text("xml"), F.col("xml"))).withColumn("facts", jats_facts("xml"))
    found = save.validated(parsed, found=F.col("facts")).select(
        "id", "asked", "why", "status", "body_chars", "sha256", "xml", F.col("xml").isNotNull().alias("usable"),
        F.col("facts.doi").alias("own_doi"), F.col("facts.pmcid").alias("own_pmcid"), F.monotonically_increasing_id().alias("body"),
    )
    texts, _ = written(found, f"{stage}/{name}")
    named = {"doi": F.coalesce(filled("doi"), F.col("own_doi")), "pmcid": F.coalesce(normalize_pmcid("pmcid"), F.col("own_pmcid")), "usable": F.coalesce("usable", F.lit(False))}
    told = asked.drop("xml").join(texts.drop("xml"), ["id", "asked"], "left").withColumns(named).withColumn("key", doi_key("doi"))
    told, seen = written(told.drop("own_doi", "own_pmcid"), f"{stage}/{name}-told", usable=F.count_if("usable"))
    # A DOI that only the text tells may be known, or come twice.
    old = log.known("doi_index", told.where("usable"), "key").select("id")
    judged = dedup.winners(told.where("usable").join(old, "id", "left_anti"), path="id")
    file = F.when(doi_key("doi").isNotNull(), safe_file_name("source", doi_key("doi"))).otherwise(F.concat("source", F.lit("_"), "id", F.lit(".xml")))
    folder = F.when(F.col("status") == "valid", "valid").otherwise("incomplete")
    saved = judged.select("source", "id", "pmcid", doi_key("doi").alias("doi"), "title", file.alias("file"), "status", "body_chars", "sha256", F.lit(number).alias("search_id"), folder.alias("folder"), "body")
    by = {k: F.count_if(F.col("status") == k) for k in ("valid", "incomplete", "invalid")}
    saved, counts = written(saved, f"{stage}/{name}-saved", fetched=F.count(F.lit(1)), **by)
    log.write(name, "articles", texts.select("body", "xml").join(small(saved, counts["fetched"]), "body"))
    log.write(name, "doi_index", saved.where("doi is not null").select("doi", "file", "source", "search_id", now.alias("added")))
    failed = F.when(~F.col("usable"), F.coalesce("why", F.lit("no full text")))
    done = told.select(F.lit(source).alias("source"), F.lit(key).alias("config_hash"), "id", F.when(F.col("usable"), "completed").otherwise("failed").alias("state"), failed.alias("error"), now.alias("ts"))
    _, ended = log.write(name, "progress", done, errors=F.count_if(F.col("state") == "failed"))
    log.publish(name)
    return counts | ended | {"duplicates": seen["usable"] - counts["fetched"]}


def collect_source(
    workspace: Workspace, source: str, search: Search, find: Finder, fetch: Fetcher | None = None, update: bool = False,
    on_progress: Callable[[Progress], None] | None = None, cadence: Cadence | None = None, key: str | None = None,
) -> Outcome:
    """One source: what is found, less what is done or known, fetched, validated and added, batch by batch.

    The source is read once; all counts are observed in the writes that the run makes anyway. Requested articles end as
    resumed, duplicates, errors, or valid, incomplete or invalid. Completed ids of the same configuration aren't fetched
    again, failed ones are. After each batch ``on_progress`` is told. The search's row and, if there is no error, the
    marker come with a last commit. ``key`` stands for the configuration by which progress is kept, if it is another than the
    search's."""
    cadence, report = cadence or Cadence(), reporter(on_progress, source)
    key, started = key or search.config_hash(), f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}"
    number, stage = workspace.log.reserve("search_", f"{source}-{key}"), workspace.path(f"staging/{source}-{started}")
    try:
        found = find(workspace.spark, search, workspace.last_day(source) if update else None)
        todo, told = _staged(workspace, source, search, key, found, stage)
        counts = {k: 0 for k in ("found", "resumed", "duplicates", "errors", "fetched", "valid", "incomplete", "invalid")}
        counts |= {"found": told["found"], "resumed": told["found"] - told["left"], "duplicates": told["left"] - told["new"]}
        done, size, k, known = 0, cadence.items, 0, told["new"]
        report(0, known, counts)
        while done < known:
            began = cadence.clock()
            rows = todo.where((F.col("ordinal") > done) & (F.col("ordinal") <= done + size)).drop("ordinal")
            new = _batch(workspace, source, key, number, rows, fetch, f"{source}-{started}-{k:06d}", stage)
            counts = {c: n + new.get(c, 0) for c, n in counts.items()}
            done, k = min(known, done + size), k + 1
            report(done, known, counts)
            size = cadence.next(size, cadence.clock() - began)
        last = {"searches": workspace.searched(number, source, search, counts)}
        if not counts["errors"]:
            # All articles of the source that no marker has counted: also those of a run that was broken off.
            before = workspace.table("markers").where(F.col("source") == source).agg(F.coalesce(F.sum("papers_fetched"), F.lit(0)).alias("before"))
            held = workspace.table("articles").where(F.col("source") == source).agg(F.count("*").alias("held"))
            fetched = F.greatest(F.col("held") - F.col("before"), F.lit(0)).cast("bigint")
            last["markers"] = held.crossJoin(before).select(F.lit(source).alias("source"), F.current_timestamp().alias("last_fetch"), fetched.alias("papers_fetched"))
        workspace.log.commit(f"{source}-{started}-last", last)
        workspace.log.close(number)
    finally:
        workspace.log.delete(f"staging/{source}-{started}")
    return Outcome(source, counts)


def _tried(workspace: Workspace, source: str, search: Search, finders: dict[str, Finder], fetchers: dict[str, Fetcher] | None, **how) -> Outcome:  # noqa: ANN003
    """A source's outcome, or why it failed: one that fails doesn't stop the others."""
    try:
        return collect_source(workspace, source, search, finders[source], (fetchers or {}).get(source), **how)
    except Exception as e:  # noqa: BLE001
        return Outcome(source, {}, next((line.strip() for line in str(e).splitlines() if line.strip()), type(e).__name__))


def collect(
    workspace: Workspace, search: Search, finders: dict[str, Finder], fetchers: dict[str, Fetcher] | None = None, update: bool = False,
    on_progress: Callable[[Progress], None] | None = None, cadence: Cadence | None = None,
) -> tuple[list[Outcome], dict[str, int]]:
    """Every source of the search, one after the other, in the order of priority; one that fails doesn't stop the others.
    Returns the outcomes and their sums."""
    order = sorted(search.sources or ("pmc",), key=lambda s: SOURCES.index(s) if s in SOURCES else len(SOURCES))
    outcomes = [_tried(workspace, s, search, finders, fetchers, update=update, on_progress=on_progress, cadence=cadence) for s in order]
    names = sorted({k for o in outcomes for k in o.counts})
    return outcomes, {k: sum(o.counts.get(k, 0) for o in outcomes) for k in names}


def refresh(workspace: Workspace, finders: dict[str, Finder], fetchers: dict[str, Fetcher] | None = None, on_progress: Callable[[Progress], None] | None = None) -> list[Outcome]:
    """Each source again with its last configuration, for what is new since its marker; one that fails doesn't stop the
    others."""
    known = sorted(workspace.latest_configs().items())
    return [_tried(workspace, s, c, finders, fetchers, update=True, on_progress=on_progress) for s, c in known if s in finders]


def expand_search(seeds: DataFrame, edges: DataFrame, search: Search, limit: int | None = None) -> DataFrame:
    """The expansion plan of a search's seeds: ``pmcid, role, ordinal``, of at most ``limit`` rows if given."""
    kinds = tuple(k for k, on in (("references", search.expand_references), ("citations", search.expand_citations)) if on)
    found = graph.expand(seeds, edges, kinds=kinds, depth=search.expansion_depth, budget=search.max_expansion)
    plan = graph.plan(seeds, found.papers)
    return plan.orderBy(F.desc("role"), "ordinal", "pmcid").limit(limit) if limit else plan

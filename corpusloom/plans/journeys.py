"""Registered queries over whole journeys: lists and their outcomes, plans, collections, tables that grow, archives, SQL.

The services' answers are made of the tables, so every query's work grows with them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import ids, search, sql, xml
from corpusloom.operators import checks, compare, graph, mirror, observed, save
from corpusloom.operators.commits import CommitLog, KeyedTable
from corpusloom.plans import collect, derive, expansion, fetchers, pdf
from corpusloom.plans.catalogue import query
from corpusloom.plans.derive import MIXED, PAPERS, mixed_id, papers, table
from corpusloom.sources import archives, feeds, files

# Lists of links and how asking for them ended.

#: Items on a page of a list.
PAGE = 3
_LINES = f"""l as (select l_orderkey as o, l_partkey as x, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) - 1 as i, count(*) over (partition by l_orderkey) as n from lineitem),
  a as (select *, i // {PAGE} as page, (n - 1) // {PAGE} as last_page from l)"""


def _link_pages(spark: SparkSession, d: str) -> DataFrame:
    """Answers to the question for the references of each order: its lines, some to a page. Orders of a number divisible
    by 7 are told to have one more; of those divisible by 13 the last page failed. A page of one item holds no list."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    line = table(spark, d, "lineitem").withColumn("i", F.row_number().over(order) - 1).withColumn("n", F.count("*").over(Window.partitionBy("l_orderkey")))
    item = F.struct(F.col("l_partkey").cast("string").alias("id"), F.lit("PRT").alias("source"))
    o = F.col("l_orderkey")
    # A page has at most PAGE items, and an order a few lines: no list grows with the table.
    held = line.groupBy("l_orderkey", F.floor(F.col("i") / PAGE).cast("int").alias("page")).agg(F.array_sort(F.collect_list(F.struct("i", item.alias("item")))).alias("rows"), F.max("n").alias("n"))
    items = F.transform("rows", lambda r: r["item"])
    inside = F.when((F.size("rows") == 1) & (o % 2 == 0), F.to_json(items[0])).otherwise(F.to_json(items))
    hits = F.col("n") + F.when(o % 7 == 0, 1).otherwise(0)
    body = F.concat(F.lit('{"hitCount": '), hits.cast("string"), F.lit(', "referenceList": {"reference": '), inside, F.lit("}}"))
    failed = (o % 13 == 0) & (F.col("page") == F.floor((F.col("n") - 1) / PAGE))
    return held.select(
        F.lit("ORD").alias("src_source"), o.cast("string").alias("src_id"), F.lit("references").alias("kind"), "page",
        F.when(~failed, body).alias("json"), F.when(failed, "HTTP 500").alias("error"),
    )


@query(f"""with {_LINES} select o::varchar as src_id, x::varchar as id, (page * 1000 + i % {PAGE})::int as pos, o % 7 <> 0 and o % 13 <> 0 as complete
  from a where not (o % 13 = 0 and page = last_page)""")
def q_link_edges(spark, d):
    edges, _ = fetchers.edges_of(_link_pages(spark, d), "references")
    return edges.select("src_id", F.col("record.id").alias("id"), "pos", "complete")


@query(f"""with {_LINES} select o::varchar as src_id, count(distinct page) filter (where o % 13 <> 0 or page < last_page) as pages,
  case when o % 13 <> 0 or any_value(last_page) > 0 then any_value(n) + (o % 7 = 0)::int end as hits, count(*) filter (where o % 13 <> 0 or page < last_page) as got,
  case when o % 13 = 0 then 'HTTP 500' end as error, o % 7 <> 0 and o % 13 <> 0 as complete from a group by o""")
def q_link_outcomes(spark, d):
    return feeds.link_outcomes(_link_pages(spark, d)).select("src_id", "pages", "hits", "got", "error", "complete")


@query("""with s as (select o_orderkey as o from orders where o_orderstatus = 'F')
  select 'ORD/' || o as node from s where (o % 7 = 0 or o % 13 = 0) and o in (select l_orderkey from lineitem)""")
def q_expand_failed(spark, d):
    """Seeds whose lists broke off or could not be had; some of these have no edge at all."""
    edges, outcomes = fetchers.edges_of(_link_pages(spark, d), "references")
    return graph.expand(derive.seeds(spark, d), edges, ("references",), outcomes=outcomes).failed


@query("select count(*) as seeds, 0::bigint as with_references, count(*) as with_neither, 0::bigint as found from orders where o_orderstatus = 'F'")
def q_expand_nowhere(spark, d):
    """Without a direction nothing is followed."""
    made = graph.expand(derive.seeds(spark, d), derive.edges(spark, d), kinds=())
    return made.coverage.crossJoin(made.stats).select("seeds", "with_references", "with_neither", F.col("total_unique").alias("found"))


# Resolution, plans and their replay.


def _accepted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Documents as accepted papers, a quarter with a PMCID, a quarter of PMC itself, the others with a PMID; and the
    articles of a third of the PMIDs."""
    i, none = F.col("doc_id"), F.lit(None).cast("string")
    p = papers(spark, d)
    rows = p.select(
        i.alias("ord"), F.when(i % 2 == 0, "references").otherwise("citations").alias("kind"), F.when(i % 4 == 1, "PMC").otherwise("MED").alias("source"),
        F.when(i % 4 == 1, F.col("raw_pmcid")).otherwise(F.col("pmid")).alias("id"), none.alias("title"), none.alias("doi"), none.alias("pmid"),
        F.when(i % 4 == 0, F.col("raw_pmcid")).alias("pmcid"),
    )
    return rows, p.where(i % 3 == 0).select("pmid", F.col("raw_pmcid").alias("pmcid"))


@query(f"with {PAPERS} select doc_id as ord, case when doc_id % 4 in (0, 1) or doc_id % 3 = 0 then pmcid end as pmcid from p")
def q_resolved_papers(spark, d):
    return graph.resolved(*_accepted(spark, d)).select("ord", "pmcid")


@query("""select case when doc_id % 2 = 0 then 'references' else 'citations' end as kind, count(*) as total, count(*) filter (where doc_id % 4 = 0) as own, count(*) filter (where doc_id % 4 = 1) as by_source,
  count(*) filter (where doc_id % 4 > 1 and doc_id % 3 = 0) as by_pmid, count(*) filter (where doc_id % 4 > 1 and doc_id % 3 <> 0) as none from documents group by 1""")
def q_resolution_counts(spark, d):
    return graph.resolution(*_accepted(spark, d))


_PLAN = f"""{PAPERS}, s as (select doc_id as ordinal, pmcid from p where doc_id % 5 = 0), n as (select doc_id as ordinal, pmcid from p where doc_id % 4 in (0, 1) or doc_id % 3 = 0),
  plan as (select pmcid, 'seed' as role, ordinal from s union all select pmcid, 'expanded', ordinal from n where pmcid not in (select pmcid from s)),
  numbered as (select pmcid, role, row_number() over (order by role desc, ordinal) as ordinal from plan)"""


def _plan(spark: SparkSession, d: str) -> DataFrame:
    seeds = papers(spark, d).where("doc_id % 5 = 0").select(F.col("doc_id").alias("ord"), F.col("raw_pmcid").alias("pmcid"))
    return graph.plan(seeds, graph.resolved(*_accepted(spark, d)))


@query(f"with {_PLAN} select pmcid, role, ordinal from plan")
def q_expansion_plan(spark, d):
    return _plan(spark, d)


@query(f"with {_PLAN}, half as (select * from numbered where ordinal <= (select count(*) // 2 from numbered)) select pmcid, role, ordinal from half where substr(pmcid, 4)::bigint % 3 <> 0")
def q_plan_replay(spark, d):
    """A kept plan's first half, less what is done: what a replay fetches."""
    plans = expansion.Plans(spark, graph.shared_folder(spark))
    plan = graph.versioned(_plan(spark, d))
    none = spark.createDataFrame([], ", ".join(c for c in expansion.PLANS["outcomes"].split(", ")[1:]))
    name = plans.keep(plan, none, spark.createDataFrame([], "node string"))
    half = plans.plan(name, plan.count() // 2)
    done = papers(spark, d).where("doc_id % 3 = 0").select(ids.normalize_pmcid("raw_pmcid").alias("pmcid"))
    return half.join(done, "pmcid", "left_anti").select("pmcid", "role", "ordinal")


@query("select count(*) as found, count(*) filter (where doc_id % 9 = 4) as invalid_pmcid from documents")
def q_invalid_pmcids(spark, d):
    return expansion.seeds_of(_seed_records(spark, d))[1]


def _seed_records(spark: SparkSession, d: str) -> DataFrame:
    """Documents as search hits; two of three name the same PMCID, some none that is one."""
    i, none = F.col("doc_id"), F.lit(None).cast("string")
    pmcid = F.when(i % 9 == 4, F.concat(F.lit("none-"), i.cast("string"))).otherwise(F.concat(F.lit("pmc"), (i - i % 3 + 1).cast("string")))
    return papers(spark, d).select(i.alias("position"), i.cast("string").alias("id"), F.lit("MED").alias("source"), "title", none.alias("doi"), "pmid", pmcid.alias("pmcid"))


@query("""select min(doc_id) as ord, 'PMC' || (doc_id - doc_id % 3 + 1) as pmcid from documents where doc_id % 9 <> 4 group by 2""")
def q_prepared_seeds(spark, d):
    return expansion.seeds_of(_seed_records(spark, d))[0].select("ord", "pmcid")


# Collections and tables that grow.


@query(f"""with {PAPERS}, a as (select *, doc_id % 7 = 0 as bad, row_number() over (partition by doi, doc_id % 7 = 0 order by pmcid) as n from p where doc_id % 8 <> 5)
  select pmcid as id, doi, case when bad then 'invalid' when n = 1 then 'valid' end as status, 'completed' as state, null::varchar as error from a
  union all select pmcid, doi, null, 'failed', 'not there' from p where doc_id % 8 = 5""")
def q_collect_workspace(spark, d):
    """A whole collection: what is found, texts fetched in batches, judged, without duplicates; an eighth has no text. DOIs are told by
    the texts, broken ones tell none."""
    p = papers(spark, d)
    there = derive.jats(p.where("doc_id % 8 <> 5")).select(F.concat(F.lit("PMC"), F.col("doc_id").cast("string")).alias("id"), "xml")
    # By ids, as batches come: each batch reads its own part and moves no other text.
    texts = graph._write(spark, there.repartitionByRange("id").sortWithinPartitions("id"))
    none = F.lit(None).cast("string")

    def find(session, wanted, since):
        known = p.select(F.lit("pmc").alias("source"), ids.normalize_pmcid("raw_pmcid").alias("id"), ids.normalize_pmcid("raw_pmcid").alias("pmcid"), none.alias("doi"), "title", F.col("pub_date").alias("first_date"), none.alias("xml"))
        return known

    def fetch(articles):
        wanted = articles.select("id")
        first, last, n = wanted.agg(F.min("id"), F.max("id"), F.count("*")).first()
        part = texts.where(F.col("id").between(first, last))
        absent = wanted.join(part.select("id"), "id", "left_anti").select("id", none.alias("xml"), F.lit("not there").alias("error"))
        return part.join(observed.small(wanted, n), "id").select("id", "xml", none.alias("error")).union(absent)

    w = collect.Workspace(spark, graph.shared_folder(spark))
    collect.collect_source(w, "pmc", search.Search(keywords=("k",)), find, fetch, cadence=collect.Cadence(items=1000))
    names = p.select(ids.normalize_pmcid("raw_pmcid").alias("id"), ids.doi_key("raw_doi").alias("doi"))
    saved = w.table("articles").select("id", "status")
    return w.table("progress").select("id", "state", "error").join(names, "id").join(saved, "id", "left").select("id", "doi", "status", "state", "error")


@query("select event_type, count(*) as n, max(event_id) as last from events where event_type <> 'error' group by 1")
def q_committed_batches(spark, d):
    """Events in one batch for each type, of which that of the errors was never committed; then merged."""
    e = table(spark, d, "events")
    log = CommitLog(spark, graph.shared_folder(spark), {"rows": "event_id bigint, event_type string"})
    types = [r.event_type for r in e.select("event_type").distinct().orderBy("event_type").collect()]
    for t in types:
        log.write(f"of-{t}", "rows", e.where(F.col("event_type") == t))
        if t != "error":
            log.publish(f"of-{t}")
    log.compact()
    return log.table("rows").groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))


@query(f"""with {PAPERS} select pmcid as accession_id, pub_date || ' 12:00:00' as source_updated, n_chars as size_bytes from p""")
def q_manifest_upsert(spark, d):
    """A manifest of three quarters of the files, some of an older state, after a sync has put in what was new or newer."""
    i = F.col("doc_id")
    remote = papers(spark, d).select(
        F.concat(F.lit("oa/"), F.col("path"), F.lit(".tar.gz")).alias("filename"), F.concat(F.lit("PMC"), i.cast("string")).alias("accession_id"),
        F.concat(F.col("pub_date").cast("string"), F.lit(" 12:00:00")).alias("last_updated"), F.col("n_chars").cast("bigint").alias("size_bytes"), "doc_id",
    )
    t = KeyedTable(spark, graph.shared_folder(spark), "accession_id string, filename string, size_bytes bigint, source_updated string", "accession_id", 64)
    old = F.when(i % 5 == 0, F.lit("2000-01-01 00:00:00")).otherwise(F.col("last_updated"))
    t.upsert(remote.where(i % 4 != 0).withColumn("source_updated", old))
    t.upsert(mirror.updates(remote, t.table()).withColumn("source_updated", F.col("last_updated")))
    return t.table().select("accession_id", "source_updated", "size_bytes")


# Files.


@query(f"with {PAPERS} select {MIXED.replace('raw_pmcid', 'pmcid')} as raw, count(*) as n from p where doc_id % 4 <> 3 group by 1")
def q_id_lists(spark, d):
    """Ids in text files, between comments and blank lines, read back."""
    i = F.col("doc_id")
    raw = mixed_id()
    line = F.when(i % 4 == 3, F.element_at(F.array(F.lit("# a comment"), F.lit(""), F.lit("   ")), (i % 3 + 1).cast("int"))).otherwise(F.concat(F.lit(" "), raw, F.lit("  ")))
    path = graph.shared_folder(spark)
    papers(spark, d).select(line.alias("value")).write.text(path)
    back = files.id_list(spark, path).select("id").join(papers(spark, d).where("doc_id % 4 <> 3").select(ids.normalize_id(raw).alias("id"), F.when(i % 4 == 0, ids.normalize_pmcid("raw_pmcid")).otherwise(raw).alias("raw")).distinct(), "id")
    return back.groupBy("raw").agg(F.count("*").alias("n"))


@query(f"with {PAPERS} select pmcid as accession_id, 'oa/' || path || '.tar.gz' as filename, 'J, ' || doc_id as citation, case when doc_id % 2 = 0 then 'comm' else 'noncomm' end as subset, case when doc_id % 3 <> 0 then pub_date::varchar end as day from p where doc_id % 6 <> 5")
def q_file_lists(spark, d):
    """Two subsets' lists as CSV files, with times that can't be read and rows without an accession, read together."""
    i = F.col("doc_id")
    rows = papers(spark, d).select(
        F.concat(F.lit("oa/"), F.col("path"), F.lit(".tar.gz")).alias("File"), F.concat(F.lit("J, "), i.cast("string")).alias("Article Citation"),
        F.when(i % 6 != 5, F.concat(F.lit("PMC"), i.cast("string"))).alias("Accession ID"), F.when(i % 3 == 0, "soon").otherwise(F.concat(F.col("pub_date").cast("string"), F.lit(" 12:00:00"))).alias("Last Updated (YYYY-MM-DD HH:MM:SS)"),
        F.col("pmid").alias("PMID"), F.lit("CC BY").alias("License"), "doc_id",
    )
    paths = {}
    for n, subset in enumerate(("comm", "noncomm")):
        paths[subset] = graph.shared_folder(spark)
        rows.where(i % 2 == n).drop("doc_id").write.csv(paths[subset], header=True, escape='"')
    found, _ = files.file_lists(spark, paths | {"gone": graph.shared_folder(spark)})
    return found.select("accession_id", "filename", "citation", "subset", F.date_format("last_updated_ts", "yyyy-MM-dd").alias("day"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text as an archive of one member and a provenance document; those of a number divisible by 5 end too early."""
    for rows in batched(archives.rows_of(batches), archives.SLICE):
        made = []
        for r in rows:
            members = [(f"valid/PMC{r['doc_id']}.xml", (r["text"] or "").encode()), (".provenance/run.json", json.dumps({"n": r["doc_id"]}).encode())]
            data = archives.packed(members, compressed=r["doc_id"] % 2 == 1)
            made.append(data if r["doc_id"] % 5 else data[: 300 if r["doc_id"] % 2 == 0 else 20])
        yield pa.record_batch({"path": pa.array([r["path"] for r in rows], pa.string()), "content": pa.array(made, pa.binary())})


@query(f"with {PAPERS} select path, case when doc_id % 5 <> 0 then 2 else 0 end as files, case when doc_id % 5 <> 0 then strlen(text) end as bytes, doc_id % 5 = 0 as broken from p")
def q_archive_members(spark, d):
    members = files.tar_members(papers(spark, d).select("doc_id", "path", "text").mapInArrow(_packed, "path string, content binary"))
    xmls = F.sum(F.when(F.col("name").endswith(".xml"), F.octet_length("body"))).cast("bigint")
    return members.groupBy("path").agg(F.count("name").cast("int").alias("files"), xmls.alias("bytes"), F.count_if(F.col("error").isNotNull()).cast("boolean").alias("broken"))


@query(f"""with {PAPERS} select path, 'run' as name, '{{"n": ' || doc_id || '}}' as json from p where doc_id % 5 <> 0""")
def q_archive_documents(spark, d):
    members = files.tar_members(papers(spark, d).select("doc_id", "path", "text").mapInArrow(_packed, "path string, content binary"))
    return files.archive_documents(members)


@query("select count(*) as files, sum(strlen(text))::bigint as bytes, count(distinct doc_id % 97) as folders from documents")
def q_archive_parts(spark, d):
    """All texts written to archives by tasks, which are then read back."""
    path = graph.shared_folder(spark)
    name = F.concat((F.col("doc_id") % 97).cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    rows = papers(spark, d).select(name.alias("name"), F.col("text").cast("binary").alias("body"))
    graph._write(spark, archives.write_parts(rows, path, 6, {"run": {"query": "q_archive_parts"}}))
    back = archives.members(spark, path, only=r"[.]txt\z")
    return back.agg(F.count("name").alias("files"), F.sum("size").alias("bytes"), F.countDistinct(F.substring_index("name", "/", 1)).alias("folders"))


@query("select count(*) as total_files, sum(strlen(text))::bigint as total_bytes, count(*) filter (where doc_id % 7 <> 0 and doc_id % 11 <> 3) as valid_count, count(*) filter (where doc_id % 7 = 0 or doc_id % 11 = 3) as invalid_count from documents")
def q_file_report(spark, d):
    """Article files, of which a seventh isn't well-formed and an eleventh isn't text."""
    p = papers(spark, d)
    xmls = derive.jats(p).join(p.select("doc_id", "path", F.octet_length("text").cast("bigint").alias("length")), "doc_id")
    content = F.when(F.col("doc_id") % 11 == 3, F.concat(F.unhex(F.lit("FF")), F.col("xml").cast("binary"))).otherwise(F.col("xml").cast("binary"))
    return checks.report_counts(checks.file_report(xmls.select("path", "length", content.alias("content"))))


@query(f"""with {PAPERS}, u as (
  select pmcid, doc_id, 'https://pmc.ncbi.nlm.nih.gov/pub/' || doc_id || '.pdf' as url, 0 as k, doc_id % 3 = 0 as here from p
  union all select pmcid, doc_id, 'https://example.org/pdf/a' || doc_id || '.pdf', 1, doc_id % 4 <> 1 from p
  union all select pmcid, doc_id, 'https://pmc.ncbi.nlm.nih.gov/articles/' || pmcid || '/pdf/suppl' || doc_id || '.pdf', 2, doc_id % 5 <> 2 from p),
  o as (select pmcid, url, k, row_number() over (partition by pmcid order by k)::int as ordinal from u where here)
  select pmcid, url, ordinal, ordinal = coalesce(min(ordinal) filter (where k = 1) over (partition by pmcid), 1) as is_primary from o""")
def q_pdf_addresses(spark, d):
    i, p = F.col("doc_id").cast("string"), papers(spark, d).withColumn("pmcid", ids.normalize_pmcid("raw_pmcid"))
    oa = F.concat(F.lit('<OA><link format="tgz" href="ftp://x/a.tar.gz"/>'), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('<link format="pdf" href="/pub/'), i, F.lit('.pdf"/>'))).otherwise(""), F.lit("</OA>"))
    meta = F.concat(F.lit("<head><meta name='other' content='x.pdf'>"), F.when(F.col("doc_id") % 4 != 1, F.concat(F.lit("<META name='citation_pdf_url' content='https://example.org/pdf/a"), i, F.lit(".pdf'>"))).otherwise(""))
    index = F.concat(F.lit('<a href="index.html">up</a>'), F.when(F.col("doc_id") % 5 != 2, F.concat(F.lit('<a class="x" href="suppl'), i, F.lit('.pdf">s</a><a href="suppl'), i, F.lit('.pdf">again</a>'))).otherwise(""))
    bodies = F.array(*[F.struct(F.lit(k).alias("kind"), b.alias("body")) for k, b in zip(checks.KINDS, (oa, meta, index), strict=True)])
    return checks.pdf_addresses(p.select("pmcid", F.explode(bodies).alias("b")).select("pmcid", "b.kind", "b.body"))


# Answers of services, gates, facts.


@query("select c_custkey::varchar as pmid, count(*) over (partition by c_nationkey) as count from customer")
def q_esearch_ids(spark, d):
    by = table(spark, d, "customer").withColumn("page", F.floor(F.col("c_custkey") / 500)).withColumn("all", F.count("*").over(Window.partitionBy("c_nationkey")))
    found = by.groupBy("c_nationkey", "page").agg(F.collect_list(F.col("c_custkey").cast("string")).alias("idlist"), F.max("all").cast("string").alias("count"))
    pages = found.select(F.to_json(F.struct(F.struct("count", "idlist").alias("esearchresult"))).alias("json"))
    return feeds.esearch_ids(pages).select("pmid", "count")


@query("""select c_custkey::varchar as requested, case when c_custkey % 2 = 0 then c_custkey::varchar end as pmid, 'PMC' || c_custkey as pmcid, case when c_custkey % 3 = 0 then '10.1/' || c_custkey end as doi
  from customer where c_acctbal >= 0""")
def q_converter_answers(spark, d):
    i, text = F.col("c_custkey"), F.col("c_custkey").cast("string")
    record = F.struct(
        F.when(i % 2 == 0, text).alias("pmid"), F.concat(F.lit("pmc"), text).alias("pmcid"), F.when(i % 3 == 0, F.concat(F.lit("10.1/"), text)).alias("doi"),
        text.alias("requested-id"), F.when(F.col("c_acctbal") < 0, "error").alias("status"),
    )
    batched = table(spark, d, "customer").groupBy(F.floor(i / 200).alias("batch")).agg(F.collect_list(record).alias("records"))
    return feeds.converted_ids(batched.select(F.to_json(F.struct("records")).alias("json")))


@query("""select cursor, total, case when n > 0 and cursor + n < total then cursor + n end as next_cursor
  from (select c_custkey as cursor, (select count(*) from customer) as total, c_custkey % 101 as n from customer)""")
def q_biorxiv_cursor(spark, d):
    i = F.col("c_custkey")
    c = table(spark, d, "customer")
    rows = c.crossJoin(F.broadcast(c.agg(F.count("*").cast("string").alias("total"))))
    message = F.struct(i.cast("string").alias("cursor"), "total")
    page = F.struct(F.array(message).alias("messages"), F.transform(F.sequence(F.lit(0), F.lit(100)), lambda k: F.struct(k.cast("string").alias("doi"))).alias("collection"))
    cut = page.withField("collection", F.slice(page["collection"], 1, (i % 101).cast("int")))
    return feeds.biorxiv_next(rows.select(F.to_json(cut).alias("json")))


@query(f"""with {PAPERS} select pmcid as id, case when doc_id % 3 = 0 and doc_id % 7 <> 0 then null else sha256('x' || doc_id) end as told, case when doc_id % 3 = 0 and doc_id % 7 <> 0 then 'another article' end as error from p""")
def q_right_article(spark, d):
    """Answers for another article than was asked for are none; broken ones name none and are judged later."""
    i = F.col("doc_id")
    own = derive.jats(papers(spark, d).withColumn("doc_id", F.when(i % 3 == 0, i * 7 + F.when(i % 7 == 0, 0).otherwise(1)).otherwise(i)))
    numbered = papers(spark, d).select("doc_id", F.when(i % 3 == 0, i * 7 + F.when(i % 7 == 0, 0).otherwise(1)).otherwise(i).alias("other"))
    texts = numbered.join(own.select(F.col("doc_id").alias("other"), "xml").dropDuplicates(["other"]), "other")
    judged = fetchers.matching(texts.select(F.concat(F.lit("PMC"), i.cast("string")).alias("pmcid"), "xml"))
    return judged.select("id", F.when(F.col("xml").isNotNull(), F.sha2(F.concat(F.lit("x"), F.substring("id", 4, 20)), 256)).alias("told"), "error")


@query(f"with {PAPERS} select doc_id, trim(raw_doi) as doi, case when doc_id % 3 = 0 then trim(raw_doi) end as exact, pmcid, {'length(trim(regexp_replace(text, ' + chr(39) + chr(92) + 's+' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')))::int'} as body_chars from p")
def q_article_facts(spark, d):
    """DOIs in elements of the exact type, of another spelling of it, and after an empty one; one parse for all facts."""
    i, doi = F.col("doc_id"), F.concat(F.trim("raw_doi"), F.lit("</article-id>"))
    head = F.when(i % 3 == 0, '<article-id pub-id-type="doi">').when(i % 3 == 1, '<article-id pub-id-type="DOI">').otherwise('<article-id pub-id-type="doi"/><article-id pub-id-type="doi">')
    body = F.concat(F.lit("<article><front>"), head, doi, F.lit('<article-id pub-id-type="PMCID"> PMC'), i.cast("string"), F.lit("</article-id></front><body>"), derive.escaped("text"), F.lit("</body></article>"))
    rows = papers(spark, d).select("doc_id", body.alias("xml")).withColumns({"f": xml.jats_facts("xml"), "exact": xml.jats_dedup_doi("xml")})
    return rows.select("doc_id", "f.doi", "exact", "f.pmcid", "f.body_chars")


@query(f"""with {PAPERS} select case when doc_id % 7 = 0 then 'invalid' else 'valid' end as status, count(*) as n,
  sum(case when doc_id % 7 = 0 then 0 else length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) end)::bigint as body_chars from p group by 1""")
def q_sql_functions(spark, d):
    """The same validator from the text of a query, by the table function whose schema follows its table."""
    sql.register(spark)
    view = f"articles_{graph.shared_folder(spark).rpartition('-')[2]}"
    derive.jats(papers(spark, d)).createOrReplaceTempView(view)
    try:
        return spark.sql(f"select status, count(*) as n, sum(body_chars) as body_chars from validate_with(table({view}), 'xml', '{sql.JATS}') group by status")
    finally:
        spark.catalog.dropTempView(view)


@query(f"with {PAPERS} select doc_id from p where (contains(lower(title), 'the') or contains(lower(abstract), 'the')) and lang = 'en'")
def q_open_access(spark, d):
    wanted = search.Search(keywords=("the",), open_access_only=True)
    return papers(spark, d).withColumn("open", F.col("lang") == "en").where(wanted.predicate("any", open_access="open")).select("doc_id")


@query(f"with {PAPERS} select doc_id from p where pub_date between date '2021-06-01' - 90 and date '2021-06-01'")
def q_last_days(spark, d):
    return feeds.in_days(papers(spark, d), "pub_date", F.lit("2021-06-01").cast("date"), 90).select("doc_id")


@query(f"""with {PAPERS} select path, sha1(text) is not null as hashed, 'S' || doc_id as first_author, strftime(pub_date, '%Y') as year, trim(raw_doi) as doi, case when doc_id % 3 = 0 then pmid end as pmid,
  case when doc_id % 4 = 0 then 'grobid-header' else 'grobid-fulltext' end as source, 'valid' as status from p""")
def q_pdf_metadata(spark, d):
    """Files converted by a service, the header alone where it can't read the full text, with what is known of their DOIs."""
    tei = derive.tei(papers(spark, d)).join(papers(spark, d).select("doc_id", "path"), "doc_id")
    given = tei.select("path", F.concat(F.when(F.col("doc_id") % 4 == 0, "H").otherwise("F"), "xml").cast("binary").alias("content"))
    made = graph._write(spark, pdf.tei_of(given, lambda body, full: body[1:].decode() if body[:1] == b"F" or not full else None))
    p = papers(spark, d)
    # Equal texts share a DOI here, so the PMID is that of the file itself: the DOI is made its own.
    rows = pdf.articles(made)
    known = p.select("path", F.when(F.col("doc_id") % 3 == 0, F.col("pmid")).alias("pmid"))
    return pdf.metadata_table(rows).join(known, "path").select("path", F.col("sha1").isNotNull().alias("hashed"), "first_author", "year", F.col("DOI").alias("doi"), known["pmid"], "source", "status")


@query(f"""with {PAPERS}, j as (select *, doc_id % 7 = 0 as bad from p) select pmcid, case when bad then 'incomplete' else 'valid' end as folder, case when bad then 'invalid' else 'valid' end as status from j where doc_id % 4 <> 2""")
def q_saved_articles(spark, d):
    """Articles whose id and content no manifest has, with the folder that they go to."""
    i = F.col("doc_id")
    judged = save.validated(derive.jats(papers(spark, d))).withColumn("pmcid", F.concat(F.lit("PMC"), i.cast("string")))
    known = judged.where(i % 2 == 0).select("pmcid", F.when(i % 4 == 2, F.col("sha256")).otherwise("other").alias("sha256"))
    return save.to_save(judged, known).select("pmcid", "folder", "status")


@query(f"""with {PAPERS}, m as (select source, count(*) as found, count(*) filter (where status = 'valid') as valid from p group by 1)
  select source, found, valid, (select count(*) from p) as total, (select count(*) filter (where status = 'incomplete') from p) as incomplete from m""")
def q_unified_manifest(spark, d):
    """The one row of JSON for a run over several sources, read back."""
    p = papers(spark, d)
    counts = p.groupBy("source").agg(F.count("*").alias("found"), F.count_if(F.col("status") == "valid").alias("valid"))
    one = F.from_json("json", "struct<sources: map<string, struct<found: bigint, valid: bigint>>, manifest: struct<total: bigint, incomplete: bigint>>")
    j = save.unified_manifest(counts, p).select(one.alias("j"))
    return j.select(F.explode("j.sources").alias("source", "c"), "j.manifest").select("source", "c.found", "c.valid", "manifest.total", "manifest.incomplete")


@query(f"""with {PAPERS}, known as (select doi from p where doc_id % 4 = 0) select doc_id, case when doc_id % 9 = 1 then source || '_' || doc_id || '.xml' else source || '_' || replace(doi, '/', '_') || '.xml' end as file
  from p where doc_id % 9 = 1 or doi not in (select doi from known)""")
def q_added_files(spark, d):
    i = F.col("doc_id")
    p = papers(spark, d).select("doc_id", i.alias("id"), "source", F.when(i % 9 != 1, ids.doi_key("raw_doi")).alias("doi"))
    index = papers(spark, d).where(i % 4 == 0).select(F.col("raw_doi").alias("doi"))
    return save.added(p, index).select("doc_id", "file")


@query(f"""with {PAPERS} select doc_id, case doc_id % 3 when 0 then doi when 1 then pmcid else upper(pmid) end as id_key from p""")
def q_converter_keys(spark, d):
    i = F.col("doc_id")
    value = F.when(i % 3 == 0, F.col("raw_doi")).when(i % 3 == 1, F.col("raw_pmcid")).otherwise(F.col("pmid"))
    kind = F.when(i % 3 == 0, "doi").when(i % 3 == 1, "pmcid").otherwise("pmid")
    return papers(spark, d).select("doc_id", ids.id_key(value, kind).alias("id_key"))


_NAMES = "['Cell Biology', 'Surgery', 'Plant-Biology', 'Alchemy', 'Public and Global Health', 'Epidemiology', 'pathology']"


@query(f"""with n as (select doc_id, ({_NAMES})[(doc_id % 7 + 1)::int] as name from documents)
  select doc_id, case when doc_id % 7 in (0, 2, 5, 6) then replace(replace(lower(name), ' ', '_'), '-', '_') end as biorxiv,
  case when doc_id % 7 in (1, 4, 5, 6) then replace(replace(lower(name), ' ', '_'), '-', '_') end as medrxiv from n""")
def q_preprint_categories(spark, d):
    names = F.array(*map(F.lit, ("Cell Biology", "Surgery", "Plant-Biology", "Alchemy", "Public and Global Health", "Epidemiology", "pathology")))
    name = F.element_at(names, (F.col("doc_id") % 7 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", *[search.preprint_category(name, s).alias(s) for s in ("biorxiv", "medrxiv")])


@query(f"""with {PAPERS}, r as (select distinct pmcid as id from p where doc_id % 2 = 0), c as (select distinct pmcid as id from p where doc_id % 3 = 0)
  select id, case when id in (select id from r) and id in (select id from c) then 'overlap' when id in (select id from r) then 'reference_only' else 'candidate_only' end as list
  from (select id from r union select id from c)""")
def q_compare_lists(spark, d):
    """The lists of a written comparison, read back."""
    path = graph.shared_folder(spark)
    of = lambda k: papers(spark, d).where(F.col("doc_id") % k == 0).select(ids.normalize_pmcid("raw_pmcid").alias("id"))
    compare.write_report(of(2), of(3), path)
    return spark.read.schema("value string, list string").text(f"{path}/ids").select(F.col("value").alias("id"), "list")

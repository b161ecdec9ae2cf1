"""Breadth-first expansion of seed papers over citations and references, with identity by any shared key and a budget.

A record is accepted if none of its keys occurs in a seed or in an earlier record, in the order of discovery: depth,
parent, references before citations, place in the list. The keys of every processed record count, accepted or not. So a
hop needs no closure: the first place of each key among the hop's records, and the keys seen in earlier hops.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.ids import best_id, identity_keys

RECORD = ("id", "source", "title", "doi", "pmid", "pmcid")
KINDS = ("references", "citations")
#: Nodes (``src_source, src_id``) to the edges of their lists and, if it can tell, each list's outcome.
Lists = Callable[[DataFrame], "tuple[DataFrame, DataFrame | None]"]


@dataclass
class Expansion:
    """``accepted``: records with kind and depth; ``papers``: the same with their order and parent, for which the last hop
    is numbered only when they are asked for; ``stats``: one row; ``failed``: nodes whose lists were partial or could not
    be had at all; ``coverage``: what lists the seeds have."""

    accepted: DataFrame
    numbered: Callable[[], DataFrame]
    stats: DataFrame
    failed: DataFrame
    coverage: DataFrame

    @cached_property
    def papers(self) -> DataFrame:
        return self.numbered()

    @property
    def layers(self) -> DataFrame:
        return self.accepted.groupBy("depth", "kind").agg(F.count("*").alias("n"))


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share; a local session (tests) that names
    none gets a temporary one, on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='corpusloom-')}")
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/corpusloom/graph-{uuid.uuid4().hex}"


def _write(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Cuts the lineage of a hop by a written table in the shared folder, which survives lost executors."""
    path, schema = shared_folder(spark), df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def _numbered(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name``, their number from 1 in the order of ``at``: ranges are numbered apart, each from the size of
    those before it. To the driver comes a number for each range."""
    dealt = _write(spark, rows.repartitionByRange("at").withColumn("__range", F.spark_partition_id()))
    sizes, before, offsets = sorted(dealt.groupBy("__range").count().collect()), 0, []
    for k, n in sizes:
        offsets.append((k, before))
        before += n
    begun = F.broadcast(spark.createDataFrame(offsets, "__range int, __before bigint"))
    own = F.row_number().over(Window.partitionBy("__range").orderBy("at"))
    return dealt.withColumn("__own", own).join(begun, "__range").withColumn(name, F.col("__before") + F.col("__own")).drop("__range", "__before", "__own")


def record_keys(prefix: str = "") -> Column:
    c = lambda n: F.col(f"{prefix}{n}")
    return identity_keys(c("source"), c("id"), c("doi"), c("pmid"), c("pmcid"))


def record_node(prefix: str = "") -> Column:
    c = lambda n: F.col(f"{prefix}{n}")
    return best_id(c("source"), c("id"), c("pmid"), c("pmcid"))


def prepared_seeds(papers: DataFrame, order: str) -> DataFrame:
    """Seeds with a valid PMCID, each once, in order: ``ord, pmcid`` and the columns of a record."""
    from corpusloom.functions.ids import normalize_pmcid

    valid = papers.withColumn("pmcid", normalize_pmcid("pmcid")).where("pmcid is not null")
    first = Window.partitionBy("pmcid").orderBy(order)
    return valid.withColumn("__r", F.row_number().over(first)).where("__r = 1").select(F.col(order).alias("ord"), *RECORD)


def expand(seeds: DataFrame, edges: DataFrame | Lists, kinds: tuple[str, ...] = KINDS, depth: int = 1, budget: int | None = None, outcomes: DataFrame | None = None) -> Expansion:
    """``seeds``: ``ord`` (unique) and the columns of RECORD. ``edges``: ``src_source, src_id, kind, pos, record,
    complete``; the lists of a node, or a function that gets a hop's nodes and asks for their lists. ``outcomes``
    (``src_source, src_id, complete``): how asking for a node's list ended, so that a node whose list could not be had at
    all, and so has no edge, is told as failed. ``kinds`` and their order are fixed: references, then citations."""
    spark = seeds.sparkSession
    kinds = tuple(k for k in KINDS if k in kinds)
    rank = F.when(F.col("kind") == KINDS[0], 0).otherwise(1)
    asked: Lists = edges if callable(edges) else lambda nodes: (edges, outcomes)
    of_seeds = None if callable(edges) else edges.where(F.col("kind").isin(*kinds)) if kinds else edges.limit(0)
    frontier = _write(spark, seeds.select(F.col("ord").cast("bigint").alias("parent"), record_node().alias("node")).where("node is not null"))
    seen = seeds.select(F.explode(record_keys()).alias("key")).distinct()
    accepted, papers, totals, failed, room = [], [], [], None, budget
    empty = spark.createDataFrame([], "ord bigint, parent bigint, depth int, kind string, id string, source string, title string, doi string, pmid string, pmcid string")
    for hop in range(1, depth + 1 if kinds else 1):
        nodes = frontier.select(F.col("node.source").alias("src_source"), F.col("node.id").alias("src_id"))
        own, ends = asked(nodes.distinct())
        own = own.where(F.col("kind").isin(*kinds))
        of_seeds = own if of_seeds is None else of_seeds
        lists = own.join(frontier.select("parent", F.col("node.source").alias("src_source"), F.col("node.id").alias("src_id")), ["src_source", "src_id"])
        rows = lists.select("parent", rank.alias("k"), "kind", "pos", "complete", "src_source", "src_id", *[F.col(f"record.{c}").alias(c) for c in RECORD])
        rows = _write(spark, rows.withColumn("keys", record_keys()).withColumn("at", F.struct("parent", "k", "pos")))
        keyed = rows.where("size(keys) > 0")
        by_key = keyed.select("at", F.explode("keys").alias("key"))
        first = by_key.groupBy("key").agg(F.min("at").alias("first"))
        old = seen.withColumn("old", F.lit(True))
        judged = by_key.join(first, "key").join(old, "key", "left").groupBy("at").agg(F.bool_and((F.col("at") == F.col("first")) & F.col("old").isNull()).alias("accepted"))
        candidates = keyed.join(judged, "at")
        if room is not None:
            # Only accepted rows are numbered. A list is read if fewer than `room` accepted rows come before it.
            ranked = _numbered(spark, candidates.where("accepted").select("at"), "nth")
            stop = ranked.where(F.col("nth") == room + 1).select(F.col("at").alias("stop"))
            last = ranked.where(F.col("nth") == room).select(F.col("at").alias("last"))
            limits = stop.select("stop", F.lit(None).cast(stop.schema["stop"].dataType).alias("last")).union(last.select(F.lit(None).cast(stop.schema["stop"].dataType), "last")).agg(F.max("stop").alias("stop"), F.max("last").alias("last"))
            one = limits.first()
            within = F.lit(True)
            if one["last"] is not None:  # later lists than that of the last accepted row aren't read
                within = F.struct("parent", "k") <= F.struct(F.lit(one["last"]["parent"]).cast("bigint").alias("parent"), F.lit(one["last"]["k"]).alias("k"))
            processed = candidates.where(within)
            if one["stop"] is not None:
                s = one["stop"]
                processed = processed.where(F.col("at") < F.struct(F.lit(s["parent"]).cast("bigint").alias("parent"), F.lit(s["k"]).alias("k"), F.lit(s["pos"]).cast(rows.schema["pos"].dataType).alias("pos")))
            read = rows.where(within)
        else:
            processed, read = candidates, rows
        processed = _write(spark, processed)
        counts = read.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in KINDS]).first()
        done = processed.agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("duplicates")).first()
        totals.append((counts[KINDS[0]], counts[KINDS[1]], done.accepted, done.duplicates))
        partial = read.where("not complete").select(F.concat_ws("/", "src_source", "src_id").alias("node")).distinct()
        if ends is not None:
            broken = ends.where("not complete").join(nodes.distinct(), ["src_source", "src_id"], "left_semi")
            partial = partial.union(broken.select(F.concat_ws("/", "src_source", "src_id").alias("node")).distinct())
        failed = partial if failed is None else failed.union(partial)
        accepted.append(processed.where("accepted").select(F.lit(hop).alias("depth"), "kind", *RECORD))

        def numbered(processed: DataFrame = processed, hop: int = hop, before: int = sum(t[2] for t in totals[:-1])) -> DataFrame:
            new = _numbered(spark, processed.where("accepted"), "ord").withColumn("ord", F.col("ord") + before)
            return _write(spark, new.select("ord", "parent", F.lit(hop).alias("depth"), "kind", *RECORD))

        if room is not None:
            room -= done.accepted
        if hop == depth or not done.accepted or room is not None and room <= 0:
            papers.append(numbered)
            break
        # Parents are numbered anew by the order of acceptance, which also orders the next hop.
        new = numbered()
        papers.append(lambda new=new: new)
        seen = _write(spark, seen.union(processed.select(F.explode("keys").alias("key"))).distinct())
        frontier = new.select(F.col("ord").alias("parent"), record_node().alias("node")).where("node is not null")
    failed = (failed if failed is not None else spark.createDataFrame([], "node string")).distinct()
    sums = [sum(t[i] for t in totals) for i in range(4)]
    stats = spark.createDataFrame([tuple(sums)], "references_found bigint, citations_found bigint, total_unique bigint, duplicates_skipped bigint")
    if of_seeds is None:
        of_seeds = spark.createDataFrame([], "src_source string, src_id string, kind string")
    every = reduce(DataFrame.union, accepted) if accepted else empty.select("depth", "kind", *RECORD)
    return Expansion(every, lambda: reduce(DataFrame.union, [p() for p in papers]) if papers else empty, stats, failed, coverage(seeds, of_seeds))


def coverage(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: how many seeds have citations, references, both, neither, in number and percent of all seeds."""
    nodes = seeds.select("ord", record_node().alias("node")).select("ord", F.col("node.source").alias("src_source"), F.col("node.id").alias("src_id"))
    # Only the seeds' own edges are counted; the others don't reach the aggregate.
    own = edges.join(nodes.select("src_source", "src_id").distinct(), ["src_source", "src_id"], "left_semi")
    has = own.groupBy("src_source", "src_id").agg(*[F.bool_or(F.col("kind") == k).alias(k) for k in KINDS])
    flags = nodes.join(has, ["src_source", "src_id"], "left").select(*[F.coalesce(k, F.lit(False)).alias(k) for k in KINDS])
    r, c = (F.col(k) for k in KINDS)
    counts = flags.agg(F.count("*").alias("seeds"), F.count_if(c).alias("with_citations"), F.count_if(r).alias("with_references"), F.count_if(c & r).alias("with_both"), F.count_if(~c & ~r).alias("with_neither"))
    percent = lambda n: F.when(F.col("seeds") > 0, F.round(100.0 * F.col(n) / F.col("seeds"), 1)).otherwise(0.0).cast("double").alias(f"{n}_percent")
    return counts.select("*", *[percent(n) for n in ("with_citations", "with_references")])


def plan(seeds: DataFrame, papers: DataFrame) -> DataFrame:
    """``pmcid, role, ordinal``: seeds, then accepted papers that carry a valid PMCID and aren't seeds, each once."""
    from corpusloom.functions.ids import normalize_pmcid

    own = seeds.select(normalize_pmcid("pmcid").alias("pmcid"), "ord").where("pmcid is not null").groupBy("pmcid").agg(F.min("ord").alias("ordinal"))
    new = papers.select(normalize_pmcid("pmcid").alias("pmcid"), "ord").where("pmcid is not null").groupBy("pmcid").agg(F.min("ord").alias("ordinal")).join(own, "pmcid", "left_anti")
    return own.select("pmcid", F.lit("seed").alias("role"), "ordinal").union(new.select("pmcid", F.lit("expanded"), "ordinal"))


def versioned(planned: DataFrame) -> DataFrame:
    """A plan to be kept: ``plan, ordinal, pmcid, role``, seeds first, numbered from 1. ``plan`` is a hash
    of what was planned, the same for the same papers in the same order: their hashes are added up, so it needs no sort."""
    spark = planned.sparkSession
    rows = _numbered(spark, planned.withColumn("at", F.struct(F.when(F.col("role") == "seed", 0).otherwise(1).alias("k"), F.col("ordinal").cast("bigint").alias("o"), "pmcid")).select("at", "pmcid", "role"), "ordinal")
    written = _write(spark, rows.select("ordinal", "pmcid", "role"))
    one = F.conv(F.substring(F.md5(F.concat_ws(" ", "ordinal", "pmcid", "role")), 1, 15), 16, 10).cast("decimal(38,0)")
    total = written.agg(F.coalesce(F.sum(one), F.lit(0)).cast("string").alias("sum"), F.count("*").cast("string").alias("n"))
    found = total.select(F.substring(F.sha2(F.concat_ws(" ", "sum", "n"), 256), 1, 16)).first()[0]
    return written.select(F.lit(found).alias("plan"), "ordinal", "pmcid", "role")


def resolution(papers: DataFrame, articles: DataFrame) -> DataFrame:
    """How accepted papers got their PMCID: ``kind, total, own, by_source, by_pmid, none``, one row for each kind."""
    from corpusloom.functions.ids import normalize_pmcid

    own, source = normalize_pmcid("__given").isNotNull(), (F.col("source") == "PMC") & normalize_pmcid("id").isNotNull()
    told = resolved(papers.withColumn("__given", F.col("pmcid")), articles)
    how = F.when(own, "own").when(source, "by_source").when(F.col("pmcid").isNotNull(), "by_pmid").otherwise("none")
    return told.withColumn("__how", how).groupBy("kind").agg(F.count("*").alias("total"), *[F.count_if(F.col("__how") == k).alias(k) for k in ("own", "by_source", "by_pmid", "none")])


def resolved(papers: DataFrame, articles: DataFrame) -> DataFrame:
    """Accepted papers with the PMCID they have: their own, their id if the source is PMC, or that of the article of
    their PMID (``pmid, pmcid``); ``pmcid`` is null if none."""
    from corpusloom.functions.ids import filled, normalize_pmcid

    pmid = F.coalesce(filled("pmid"), F.when(F.col("source") == "MED", filled("id")))
    known = articles.select(F.col("pmid").alias("__pmid"), normalize_pmcid("pmcid").alias("__found")).where("__found is not null").groupBy("__pmid").agg(F.min("__found").alias("__found"))
    own = F.coalesce(normalize_pmcid("pmcid"), F.when(F.col("source") == "PMC", normalize_pmcid("id")))
    return papers.withColumn("__own", own).withColumn("__pmid", pmid).join(known, "__pmid", "left").withColumn("pmcid", F.coalesce("__own", "__found")).drop("__own", "__pmid", "__found")

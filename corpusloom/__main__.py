"""Command line: settings, collecting from the sources, mirrors, archives, workspaces, searches, comparisons."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from corpusloom.functions.search import Search
from corpusloom.sources.services import ServiceError


def _spark():
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("corpusloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shown(rows) -> None:
    for r in rows:
        print(json.dumps(r.asDict(recursive=True), default=str))


def compare(args: argparse.Namespace) -> None:
    from corpusloom.operators import compare as c
    from corpusloom.sources.files import corpus_ids

    spark = _spark()
    reference, candidate = (corpus_ids(spark, p) for p in (args.reference, args.candidate))
    if args.out:
        _shown(c.write_report(reference, candidate, args.out).collect())
    elif args.full:
        print(c.report(reference, candidate).first().json)
    else:
        _shown(c.metrics(reference, candidate).collect())


def ids(args: argparse.Namespace) -> None:
    from corpusloom.sources.files import corpus_ids

    for r in corpus_ids(_spark(), args.path).distinct().orderBy("id").toLocalIterator():
        print(f"{r.id_type}\t{r.id}")


def search(args: argparse.Namespace) -> None:
    s = Search.from_json(Path(args.config).read_text())
    forms = {"pubmed": s.pubmed, "pubmed_by_category": s.pubmed_by_category, "europepmc": s.europepmc, "arxiv": s.arxiv, "biorxiv": s.biorxiv, "chemrxiv": s.chemrxiv}
    print(json.dumps({k: f() for k, f in forms.items()} | {"hash": s.config_hash(), "unknown_categories": s.unknown_categories()}, indent=2))


def workspace(args: argparse.Namespace) -> None:
    from corpusloom.plans.collect import Workspace

    w = Workspace(_spark(), args.root)
    if args.action == "status":
        _shown(w.statistics().collect())
    elif args.action == "searches":
        _shown(w.history().limit(args.n).collect())
    elif args.action == "init":
        Workspace.init(w.spark, args.root)
    elif args.action == "build":
        print(json.dumps(w.build(args.out or f"{args.root}/archives", args.include_incomplete)))
    elif args.action == "compact":
        print(json.dumps({"merged": w.log.compact(), "removed": w.log.vacuum()}))
    else:
        w.clear(keep_history=args.keep_history)


def settings(args: argparse.Namespace):
    from corpusloom import config

    return config.load({"email": args.email, "api_key": args.api_key})


def show_config(args: argparse.Namespace) -> None:
    print(json.dumps(settings(args).shown(), indent=2, ensure_ascii=False))


def _services(args: argparse.Namespace):
    from corpusloom.plans.fetchers import Services

    return Services(args.transport, settings(args).http())


def fetch(args: argparse.Namespace) -> None:
    """Collects from the sources of a search or what a plan names, or shows what would be collected."""
    from dataclasses import asdict, replace

    from corpusloom.plans.collect import Workspace, collect

    s = Search.from_json(Path(args.config).read_text())
    if args.plan:
        return _replayed(args, s)
    if args.pmcid:
        from corpusloom.plans import expansion
        from corpusloom.plans.collect import collect_source

        find = expansion.given(args.pmcid)  # before anything starts
        print(json.dumps(asdict(collect_source(Workspace(_spark(), args.root), "pmc", s, find, _services(args).fetch_pmc))))
        return
    if args.source:
        s = replace(s, sources=tuple(args.source))
    if args.max_results is not None:
        s = replace(s, max_results_per_source=args.max_results)
    reached, spark = _services(args), _spark()
    if args.dry_run:
        finders = reached.finders()
        for source in s.sources or ("pmc",):
            print(json.dumps({"source": source, "found": finders[source](spark, s, None).count()}))
        return
    outcomes, total = collect(Workspace(spark, args.root), s, reached.finders(), reached.fetchers(), args.update)
    for o in outcomes:
        print(json.dumps(asdict(o)))
    print(json.dumps({"source": "all", "counts": total}))


def expand(args: argparse.Namespace) -> None:
    """Search, links, resolution; keeps the plan and prints its name, what it will take and how it came about."""
    from corpusloom.plans import expansion

    s = Search.from_json(Path(args.config).read_text())
    spark = _spark()
    made = expansion.expand_search(spark, _services(args), s, args.root)
    plans = expansion.Plans(spark, args.root)
    print(json.dumps({"plan": made.plan, "seeds": made.seeds, "invalid_seeds": made.invalid_seeds, "planned": made.planned}))
    _shown(made.expansion.stats.collect())
    _shown(made.expansion.coverage.collect())
    _shown(plans.log.table("outcomes").where(f"plan = '{made.plan}'").drop("plan").orderBy("kind").collect())
    print(json.dumps({"failed": made.expansion.failed.count()}))
    _shown(plans.estimate(made.plan).collect())


def _replayed(args: argparse.Namespace, s: Search) -> None:
    from dataclasses import asdict

    from corpusloom.plans import expansion
    from corpusloom.plans.collect import Workspace

    spark = _spark()
    if args.dry_run:
        _shown(expansion.Plans(spark, args.root).estimate(args.plan, args.max_results).collect())
    else:
        print(json.dumps(asdict(expansion.replay(Workspace(spark, args.root), _services(args), args.plan, s, args.max_results))))


def update(args: argparse.Namespace) -> None:
    from dataclasses import asdict

    from corpusloom.plans.collect import Workspace, refresh

    reached = _services(args)
    for o in refresh(Workspace(_spark(), args.root), reached.finders(), reached.fetchers()):
        print(json.dumps(asdict(o)))


def mirror(args: argparse.Namespace) -> None:
    """A dry run unless ``--go``."""
    from corpusloom.plans.sync import Mirror
    from corpusloom.sources.files import file_list
    from corpusloom.sources.services import Http

    spark = _spark()
    m = Mirror(spark, args.root)
    if args.action == "status":
        _shown(m.status().collect())
    elif args.action == "verify":
        _shown(m.verify().where("state <> 'verified'").collect())
    elif args.action == "import":
        from pyspark.sql import functions as F

        known = m.take_in(file_list(spark, args.list, args.subset))
        _shown(known.agg(F.count("*").alias("scanned"), F.count_if("matched").alias("matched"), F.count_if(~F.col("matched")).alias("unmatched")).collect())
        _shown(known.where("not matched").select("filename").orderBy("filename").limit(10).collect())
    else:
        remote = file_list(spark, args.list, args.subset)
        if not args.go:
            print(json.dumps({"pending": m.pending(remote).count()}))
            return
        http = Http(**settings(args).http())
        done = m.sync(remote, lambda name: http.raw(f"{args.base.rstrip('/')}/{name}", "efetch"), args.n)
        print(json.dumps({"downloaded": done.downloaded, "bytes": done.bytes, "failed": done.failed}))


def pdf(args: argparse.Namespace) -> None:
    """Converts PDF files below a folder: articles as Parquet, metadata as CSV. Files of known content aren't sent again."""
    from pyspark.sql import functions as F

    from corpusloom.operators.save import metadata_csv
    from corpusloom.plans import pdf as conversion
    from corpusloom.sources.conversion import TeiService
    from corpusloom.sources.files import pdfs

    spark, service = _spark(), TeiService(args.service, args.ocr).checked()
    cache = spark.read.parquet(args.cache) if args.cache else None
    made = conversion.tei_of(pdfs(spark, args.folder, tuple(args.only or ())), service, cache)
    made.write.mode("overwrite").parquet(f"{args.out}/tei")
    rows = conversion.articles(spark.read.parquet(f"{args.out}/tei"))
    rows.write.mode("overwrite").parquet(f"{args.out}/articles")
    rows = spark.read.parquet(f"{args.out}/articles")
    table = conversion.metadata_table(rows)
    metadata_csv(table.withColumn("notes", F.split("notes", ";")), f"{args.out}/metadata")
    _shown(rows.groupBy("status", "source").agg(F.count("*").alias("n")).orderBy("status", "source").collect())


def check(args: argparse.Namespace) -> None:
    """Validates the article files below folders: counts, and the first files that are not valid."""
    from corpusloom.operators import checks, graph
    from corpusloom.sources.files import tree

    spark = _spark()
    report = graph._write(spark, checks.file_report(tree(spark, args.folders, include_incomplete=args.include_incomplete)))
    _shown(checks.report_counts(report).collect())
    _shown(report.where("status <> 'valid'").orderBy("path").limit(args.n).collect())


def archive(args: argparse.Namespace) -> None:
    from corpusloom.sources.files import archive_folder, embed_documents

    n = archive_folder(args.folder, args.path)
    if args.provenance:
        embed_documents(args.path, {"provenance": json.loads(Path(args.provenance).read_text())})
    print(json.dumps({"files": n, "archive": args.path}))


def _reaching(p: argparse.ArgumentParser) -> None:
    p.add_argument("--email")
    p.add_argument("--api-key")
    p.add_argument("--transport", help="module:name of another transport than HTTP")


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="corpusloom", description=__doc__)
    sub = top.add_subparsers(required=True)
    p = sub.add_parser("compare", help="overlap, recall and precision of two corpora (id lists or archives)")
    p.add_argument("reference")
    p.add_argument("candidate")
    p.add_argument("--full", action="store_true", help="with the ids of the differences")
    p.add_argument("--out", help="a folder for the numbers and the ids of overlap and differences, of corpora of any size")
    p.set_defaults(run=compare)
    p = sub.add_parser("ids", help="ids in an id list or an archive")
    p.add_argument("path")
    p.set_defaults(run=ids)
    p = sub.add_parser("search", help="a search in the languages of the services")
    p.add_argument("config")
    p.set_defaults(run=search)
    p = sub.add_parser("workspace", help="counts, searches, or clearing of a workspace")
    p.add_argument("action", choices=("init", "status", "searches", "build", "compact", "clear"))
    p.add_argument("root")
    p.add_argument("-n", type=int, default=5)
    p.add_argument("--keep-history", action="store_true")
    p.add_argument("--out", help="where build writes its archives")
    p.add_argument("--include-incomplete", action="store_true")
    p.set_defaults(run=workspace)
    p = sub.add_parser("config", help="the settings that hold, the key masked")
    _reaching(p)
    p.set_defaults(run=show_config)
    p = sub.add_parser("fetch", help="collect from sources into a workspace")
    p.add_argument("config")
    p.add_argument("root")
    p.add_argument("--source", action="append", choices=("pmc", "europepmc", "biorxiv", "medrxiv", "arxiv", "chemrxiv"))
    p.add_argument("--max-results", type=int)
    p.add_argument("--update", action="store_true", help="only what is new since the last run without errors")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--pmcid", action="append", help="fetch just this article, as often as needed")
    p.add_argument("--plan", help="the name of a kept expansion plan, whose articles are fetched")
    _reaching(p)
    p.set_defaults(run=fetch)
    p = sub.add_parser("expand", help="follow the citations or references of what a search finds; keeps a plan for fetch --plan")
    p.add_argument("config")
    p.add_argument("root")
    _reaching(p)
    p.set_defaults(run=expand)
    p = sub.add_parser("update", help="each source of a workspace again, for what is new")
    p.add_argument("root")
    _reaching(p)
    p.set_defaults(run=update)
    p = sub.add_parser("mirror", help="sync (dry unless --go), status or verification of a mirror, or import of files that are there")
    p.add_argument("action", choices=("sync", "status", "verify", "import"))
    p.add_argument("root")
    p.add_argument("--list", help="the remote list of files")
    p.add_argument("--subset", default="oa_comm")
    p.add_argument("--base", help="address before the names of files")
    p.add_argument("--go", action="store_true")
    p.add_argument("-n", type=int)
    _reaching(p)
    p.set_defaults(run=mirror)
    p = sub.add_parser("pdf", help="PDF files to articles by a conversion service")
    p.add_argument("folder")
    p.add_argument("out")
    p.add_argument("--service", default="http://localhost:8070")
    p.add_argument("--ocr", action="store_true", help="read scans too; refused where the service can't")
    p.add_argument("--cache", help="the TEI table of an earlier run")
    p.add_argument("--only", action="append", help="the name of a file, as often as needed")
    p.set_defaults(run=pdf)
    p = sub.add_parser("check", help="validate article files below folders")
    p.add_argument("folders", nargs="+")
    p.add_argument("--include-incomplete", action="store_true")
    p.add_argument("-n", type=int, default=20)
    p.set_defaults(run=check)
    p = sub.add_parser("archive", help="archive of a folder, with a document of provenance if given")
    p.add_argument("folder")
    p.add_argument("path")
    p.add_argument("--provenance")
    p.set_defaults(run=archive)
    args = top.parse_args(argv)
    try:
        args.run(args)
    except (ValueError, ServiceError) as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

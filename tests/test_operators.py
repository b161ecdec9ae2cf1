import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import compare, dedup, graph, mirror, state, stats
from corpusloom.sources import feeds, files, services

RECORD = "struct<id: string, source: string, title: string, doi: string, pmid: string, pmcid: string>"


def best(r):
    s, i, pmid, pmcid = r["source"], r["id"], r["pmid"], r["pmcid"]
    if s == "MED":
        return ("MED", pmid or i)
    if s == "PMC":
        return ("PMC", pmcid or i)
    return (s, i)


def keys(r):
    out = {f"doi:{r['doi']}"} if r["doi"] else set()
    out |= {f"pmcid:{x}" for x in (r["pmcid"], r["id"] if r["source"] == "PMC" else None) if x}
    out |= {f"pmid:{x}" for x in (r["pmid"], r["id"] if r["source"] == "MED" else None) if x}
    return out | ({f"{r['source']}:{r['id']}"} if r["source"] == "PPR" else set())


def sequential(seeds, lists, depth, budget):
    """The same search, record by record."""
    seen = set().union(*(keys(s) for s in seeds))
    queue, out, found, dup = [(best(s), 0) for s in seeds], [], {"references": 0, "citations": 0}, 0
    while queue:
        node, at = queue.pop(0)
        if at == depth:
            continue
        for kind in ("references", "citations"):
            if budget is not None and len(out) >= budget:
                return out, found, dup
            rows = lists.get((node, kind), [])
            found[kind] += len(rows)
            for r in rows:
                k = keys(r)
                if not k:
                    continue
                if k & seen:
                    dup += 1
                    seen |= k
                    continue
                if budget is not None and len(out) >= budget:
                    break
                seen |= k
                out.append((kind, at + 1, r["source"], r["id"]))
                queue.append((best(r), at + 1))
    return out, found, dup


def paper(rng, n=12):
    source, i = rng.choice(["MED", "PMC", "PPR"]), rng.randrange(n)
    ident = {"MED": f"{i}", "PMC": f"PMC{i}", "PPR": f"PPR{i}"}[source]
    extra = lambda p, v: v if rng.random() < p else None
    return {"id": ident, "source": source, "title": None, "doi": extra(0.2, f"10.1/{rng.randrange(n)}"), "pmid": extra(0.2, f"{rng.randrange(n)}"), "pmcid": extra(0.2, f"PMC{rng.randrange(n)}")}


@pytest.mark.parametrize(("seed", "depth", "budget"), [(1, 1, None), (2, 2, None), (3, 2, 4), (4, 3, 7), (5, 1, 1)])
def test_expansion_matches_the_sequential_search(spark, seed, depth, budget):
    rng = random.Random(seed)
    seeds = [paper(rng) for _ in range(3)]
    nodes = {best(s) for s in seeds} | {best(paper(rng)) for _ in range(12)}
    lists = {(n, k): [paper(rng) for _ in range(rng.randint(0, 4))] for n in nodes for k in ("references", "citations")}
    rows = [(n[0], n[1], k, i, tuple(r.values()), True) for (n, k), rs in lists.items() for i, r in enumerate(rs)]
    edges = spark.createDataFrame(rows, f"src_source string, src_id string, kind string, pos int, record {RECORD}, complete boolean")
    start = spark.createDataFrame([(i, *s.values()) for i, s in enumerate(seeds)], "ord long, id string, source string, title string, doi string, pmid string, pmcid string")
    e = graph.expand(start, edges, depth=depth, budget=budget)
    papers, found, dup = sequential(seeds, lists, depth, budget)
    assert [(r.kind, r.depth, r.source, r.id) for r in e.papers.orderBy("ord").collect()] == papers
    assert tuple(e.stats.first()) == (found["references"], found["citations"], len(papers), dup)


def test_hops_are_numbered_without_a_global_window(spark, monkeypatch):
    class Partitioned(graph.Window):
        @staticmethod
        def orderBy(*c):
            raise AssertionError("one task for a whole hop")

    monkeypatch.setattr(graph, "Window", Partitioned)
    rng = random.Random(5)
    start = spark.createDataFrame([(i, str(i), "ORD", None, None, None, None) for i in range(700)], f"ord long, {RECORD[7:-1].replace(':', '')}")
    rows = [("ORD", str(i), "references", j, (str(rng.randrange(900)), "PPR", None, None, None, None), True) for i in range(700) for j in range(3)]
    edges = spark.createDataFrame(rows, f"src_source string, src_id string, kind string, pos int, record {RECORD}, complete boolean").repartition(7)
    firsts = list(dict.fromkeys(r[4][0] for r in rows))
    for budget in (None, 250):
        found = sorted((r.ord, r.id) for r in graph.expand(start, edges, budget=budget).papers.collect())
        assert found == list(enumerate(firsts[:budget], 1))
    ids = spark.range(1000).select(F.struct((F.lit(5000) - F.col("id") * 3).alias("parent"), F.lit(0).alias("k"), F.lit(1).alias("pos")).alias("at"))
    assert [r.n for r in graph._numbered(spark, ids, "n").orderBy("at").collect()] == list(range(1, 1001))



def test_no_direction(spark):
    start = spark.createDataFrame([(0, "1", "MED", None, None, None, None)], "ord long, id string, source string, title string, doi string, pmid string, pmcid string")
    edges = spark.createDataFrame([], f"src_source string, src_id string, kind string, pos int, record {RECORD}, complete boolean")
    e = graph.expand(start, edges, kinds=())
    assert e.papers.count() == 0 and e.coverage.first().with_neither == 1 and tuple(e.stats.first()) == (0, 0, 0, 0)


def test_priority(spark):
    rows = [("arxiv", "c", "10.1/A "), ("pmc", "b", "10.1/a"), ("pmc", "a", "10.1/A"), ("x", "d", None), ("x", "e", ""), ("europepmc", "f", "10.2/b")]
    df = spark.createDataFrame(rows, "source string, path string, doi string")
    assert sorted(r.path for r in dedup.winners(df).collect()) == ["a", "d", "e", "f"]
    assert sorted(tuple(r) for r in dedup.duplicates(df).collect()) == [("10.1/a", "b", "a"), ("10.1/a", "c", "a")]
    again = dedup.winners(dedup.winners(df))
    assert again.count() == 4
    known = spark.createDataFrame([("10.2/B",)], "doi string")
    assert sorted(r.path for r in dedup.unknown(df, known).collect()) == ["a", "b", "c", "d", "e"]


def test_comparison(spark):
    lines = spark.createDataFrame([("PMC1",), ("pmc1 ",), ("# no",), ("",), ("10.1/X",), ("12345678",), ("zz",)], "value string")
    one = compare.parse_ids(lines)
    assert dict(tuple(r) for r in compare.type_counts(one).collect()) == {"pmcid": 2, "doi": 1, "pmid": 1, "unknown": 1}
    none = one.limit(0)
    m = compare.metrics(one, one).first()
    assert (m.jaccard, m.recall, m.precision, m.reference_count) == (1.0, 1.0, 1.0, 4)
    m = compare.metrics(none, none).first()
    assert (m.jaccard, m.recall, m.precision) == (0.0, 0.0, 0.0)
    two = compare.parse_ids(lines.where("value = '10.1/X'"))
    m = compare.metrics(one, two).first()
    assert m.precision == 1.0 and m.jaccard == 0.25 and m.jaccard <= min(m.recall, m.precision)
    assert json.loads(compare.report(one, two).first().json)["reference_only"] == ["12345678", "PMC1", "zz"]


def test_mirror(spark):
    remote = spark.createDataFrame([("a.tar.gz", "PMC1", "2024-01-02 00:00:00"), ("b.tar.gz", "PMC2", "2024-01-01 00:00:00"), ("c.tar.gz", "PMC3", "2024-01-01 00:00:00")], "filename string, accession_id string, last_updated string")
    manifest = spark.createDataFrame([("a.tar.gz", "PMC1", "2024-01-01 00:00:00", 5, ""), ("b.tar.gz", "PMC2", "2024-01-01 00:00:00", 6, "x")], "filename string, accession_id string, source_updated string, size_bytes long, subset string")
    assert sorted(r.accession_id for r in mirror.updates(remote, manifest).collect()) == ["PMC1", "PMC3"]
    there = spark.createDataFrame([("b.tar.gz", 7)], "filename string, length long")
    assert sorted(r.state for r in mirror.verify(manifest, there).collect()) == ["missing", "size_mismatch"]
    assert {tuple(r) for r in mirror.status(manifest).collect()} == {("unknown", 1, 5), ("x", 1, 6), (None, 2, 11)}
    assert sorted(r.matched for r in mirror.imported(spark.createDataFrame([("/d/a.tar.gz",), ("/d/z.tar.gz",)], "filename string"), remote).collect()) == [False, True]


def test_state(spark):
    p = spark.createDataFrame([("1", "completed"), ("2", "failed")], "id string, state string")
    assert tuple(state.progress(p, 4).first()) == (1, 1, 3, 25.0) and tuple(state.progress(p.limit(0), 0).first()) == (0, 0, 0, 0.0)
    todo = dedup.remaining(spark.createDataFrame([("1",), ("2",), ("3",)], "id string"), p)
    assert sorted(r.id for r in todo.collect()) == ["2", "3"]
    log = spark.createDataFrame([("search_001",), ("search_010",), ("odd",)], "id string")
    assert state.next_search_id(log) == "search_011" and state.next_search_id(log.limit(0)) == "search_001"


def archive(members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as tar:
        for name, body in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    return out.getvalue()


def test_archives(spark, tmp_path):
    manifests = [
        {"files": [{"pmcid": "pmc1", "doi": "10.1/x"}, {"doi": "10.1/Y"}, {"filename": "PMC3.xml"}, {"filename": "odd.xml"}]},
        {"articles": [{"pmcid": "PMC4", "filename": "x"}]},
        {"per_source": {"pmc": {"articles": [{"pmcid": "PMC5"}], "files": [{"path": "valid/PMC6.xml"}]}}},
    ]
    rows = [(str(i), archive({"corpus/manifest.json": json.dumps(m).encode(), "valid/PMC99.xml": b"<a/>"})) for i, m in enumerate(manifests)]
    rows += [("3", archive({"valid/PMC7.xml": b"<a/>", ".provenance/search.json": b"{}"})), ("4", b"no archive")]
    members = files.tar_members(spark.createDataFrame(rows, "path string, content binary"))
    assert sorted((r.path, r.id) for r in files.archive_ids(members).collect()) == [("0", "10.1/y"), ("0", "PMC1"), ("0", "PMC3"), ("1", "PMC4"), ("2", "PMC5"), ("2", "PMC6"), ("3", "PMC7")]
    assert [tuple(r) for r in files.archive_documents(members).collect()] == [("3", "search", "{}")]
    out = str(tmp_path / "c.tar.gz")
    named = spark.createDataFrame([("a.xml", bytearray(b"x")), ("a.xml", bytearray(b"yy"))], "name string, body binary")
    assert files.write_archive(named.toLocalIterator(), out, {"run": {"n": 2}}) == {"files": 2, "bytes": 3}
    with tarfile.open(out) as tar:
        assert sorted(tar.getnames()) == [".provenance/run.json", "a-1.xml", "a.xml"]
    assert sorted(r.id for r in files.corpus_ids(spark, out).collect()) == ["a", "a-1"]


def test_files(spark, tmp_path):
    (tmp_path / "incomplete").mkdir()
    for p in ("a.xml", "incomplete/b.xml", "c.txt"):
        (tmp_path / p).write_text("<a/>")
    assert files.tree(spark, [str(tmp_path), str(tmp_path / "none")]).count() == 1
    assert files.tree(spark, [str(tmp_path)], include_incomplete=True).count() == 2
    (tmp_path / "l.csv").write_text('File,Article Citation,Accession ID,Last Updated (YYYY-MM-DD HH:MM:SS),PMID,License\na.tar.gz,"J, 1",PMC1,2024-01-01 10:00:00,1,CC\n,x,PMC2,,,\n')
    found, failed = files.file_lists(spark, {"comm": str(tmp_path / "l.csv"), "gone": str(tmp_path / "none.csv")})
    assert [(r.accession_id, r.citation, r.subset) for r in found.collect()] == [("PMC1", "J, 1", "comm")] and list(failed) == ["gone"]
    (tmp_path / "ids.txt").write_text("# c\nPMC1\n\n10.1/X\n")
    assert files.corpus_ids(spark, str(tmp_path / "ids.txt")).count() == 2


def test_links_and_ids(spark):
    pages = [("MED", "1", 0, '{"hitCount": "3", "citationList": {"citation": [{"id": "2", "source": "MED"}, {"id": "3", "source": "MED"}]}}'), ("MED", "9", 0, '{"hitCount": null, "citationList": {"citation": {"id": "5", "source": "PPR"}}}'), ("MED", "8", 0, "{}")]
    links = feeds.europepmc_links(spark.createDataFrame(pages, "src_source string, src_id string, page int, json string"), "citations")
    assert sorted((r.src_id, r.record.id, r.complete) for r in links.collect()) == [("1", "2", False), ("1", "3", False), ("9", "5", True)]
    conv = spark.createDataFrame([('{"records": [{"pmid": 12, "pmcid": "pmc5", "requested-id": "12"}, {"pmid": "13", "status": "error"}]}',)], "json string")
    assert [tuple(r) for r in feeds.converted_ids(conv).collect()] == [("12", "12", "PMC5", None)]
    assert [r.pmid for r in feeds.esearch_ids(spark.createDataFrame([('{"esearchresult": {"count": "2", "idlist": ["1", "2"]}}',)], "json string")).collect()] == ["1", "2"]


def test_services(spark):
    slept = []
    limiter = services.Limiter(2.0, clock=lambda: 10.0 + sum(slept), sleep=slept.append)
    limiter.wait(), limiter.wait()
    assert slept == [2.0]
    assert services.batches(["a", "b", "a", "c"], 2) == [["a", "b"], ["c"]] and services.pmid_query(["1", "2"]) == "EXT_ID:(1 OR 2) AND SRC:MED"
    reader = services.LiteratureReader({"service": "chemrxiv", "total": "120", "pagesize": "50", "limit": "0"})
    assert [p.offset for p in reader.partitions()] == [0, 50, 100]


def test_counts(spark):
    rows = spark.createDataFrame([("pmc", "valid"), ("pmc", "errors"), ("arxiv", "skipped")], "source string, outcome string")
    assert stats.totals(rows).first().found == 3 and {r.source: r.errors for r in stats.outcomes(rows).collect()} == {"pmc": 1, "arxiv": 0}
    assert stats.package(spark.createDataFrame([], "source string, status string, size long")).first().files == 0

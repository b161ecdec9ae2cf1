import io
import json
import os
import tarfile
import urllib.error
from datetime import date, timedelta
from email.message import Message
from pathlib import Path

import fake_services
import pytest

from test_functions import TEI

from corpusloom import __main__, config
from corpusloom.functions.search import DateRange, Search, SourceOptions
from corpusloom.operators import graph
from corpusloom.plans import fetchers, sync
from corpusloom.plans.collect import Workspace, collect
from corpusloom.sources import files, services


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def sleep(self, s):
        self.slept.append(s)
        self.now += s


def http(answers, **more):
    """An Http whose answers come from a list: bytes, or a status."""
    clock, asked = Clock(), []

    def opened(url, timeout):
        asked.append(url)
        found = answers.pop(0)
        if isinstance(found, int):
            told = Message()
            if found == 429:
                told["Retry-After"] = "7"
            raise urllib.error.HTTPError(url, found, "", told, None)
        return io.BytesIO(found)

    return services.Http(open=opened, clock=lambda: clock.now, sleep=clock.sleep, **more), clock, asked


def test_the_rate_holds_over_calls_and_hosts():
    h, clock, asked = http([b"a", b"b", b"c", b"d"])
    assert [h("arxiv", {}), h("arxiv", {}), h("europepmc", {}), h("europepmc_text", {"id": "PMC1"})] == ["a", "b", "c", "d"]
    assert clock.slept == [3.0, pytest.approx(0.2)]
    assert asked[3].endswith("/rest/PMC1/fullTextXML")


def test_tries_again_and_raises_in_the_end():
    h, clock, _ = http([429, 503, b"ok"])
    assert h("chemrxiv", {"skip": 0}) == "ok" and clock.slept[0] == 7.0
    assert http([404])[0]("arxiv", {}) is None
    for answers in ([400], [500] * 5):
        with pytest.raises(services.ServiceError, match="HTTP"):
            http(answers)[0]("arxiv", {})


def test_ncbi_parameters_and_addresses():
    h, _, asked = http([b"{}"], email="a@b.c", api_key="k")
    h("esearch", {"term": "x"})
    assert "tool=corpusloom" in asked[0] and "email=a%40b.c" in asked[0] and "api_key=k" in asked[0] and h.interval("esearch") == 0.1
    assert services.address("biorxiv", {"server": "medrxiv", "interval": "2024-01-01/2024-01-31", "cursor": 30, "category": "x"}).endswith("/details/medrxiv/2024-01-01/2024-01-31/30/json?category=x")


def test_scans_end_or_raise_with_what_was_read():
    ask = fake_services.transport
    assert len(list(services.scan(ask, "europepmc", {"query": "q"}))) == 4
    assert len(list(services.scan(ask, "europepmc", {"query": "q"}, limit=3))) == 2
    assert len(list(services.scan(ask, "biorxiv", {"server": "biorxiv", "interval": "a/b"}))) == 2
    assert len(list(services.scan(ask, "chemrxiv", {}))) == 2 and len(list(services.scan(ask, "arxiv", {}))) == 2
    with pytest.raises(services.ServiceError) as e:
        list(services.scan(ask, "europepmc_links", {"source": "MED", "id": "1", "kind": "citations"}))
    assert len(e.value.pages) == 2


def test_lookups_and_batches():
    asked = []

    def ask(service, params):
        asked.append((service, params))
        return fake_services.transport(service, params | ({"cursorMark": "*"} if service == "europepmc" else {}))

    assert services.lookup(ask, "doi", "10.1/0")["pmcid"] == "PMC0" and asked[-1][1]["query"] == 'DOI:"10.1/0"'
    assert services.converted(ask, ["1", "2", "1"]) == {"1": {"pmid": "1", "pmcid": "PMC1", "doi": "10.1/1"}}
    found = services.fetch_batch(ask, ["pmc1", "PMC2", "PMC3"], 2)
    assert list(found) == ["pmc1", "PMC2", "PMC3"] and found["PMC3"] is None and "PMC1<" in found["pmc1"] and "PMC2<" in found["PMC2"]
    with pytest.raises(services.ServiceError, match="bad"):
        services.esearch(lambda s, p: '{"esearchresult": {"ERROR": "bad"}}', "q")


@pytest.fixture
def fakes(spark):
    spark.sparkContext.addPyFile(str(Path(__file__).with_name("fake_services.py")))
    return fetchers.Services("fake_services:transport")


def test_pages_through_spark(spark, fakes):
    found = services.pages(spark, "europepmc", {"query": "q"}, "fake_services:transport")
    assert [(r.page, r.error) for r in found.collect()] == [(i, None) for i in range(4)]
    params = {"source": "MED", "id": "1", "kind": "citations"}
    marked = services.pages(spark, "europepmc_links", params, "fake_services:transport", on_error="mark").collect()
    assert [r.error for r in marked] == [None, None, "HTTP 500"]
    with pytest.raises(Exception, match="HTTP 500"):
        services.pages(spark, "europepmc_links", params, "fake_services:transport").collect()
    assert services.pages(spark, "chemrxiv", {}, "fake_services:transport", total=3, size=2).count() == 2
    edges = fetchers.links(fakes.call, spark, [("MED", "1")], "citations").collect()
    assert len(edges) == 4 and not any(r.complete for r in edges)


def test_every_source_is_collected(spark, fakes, tmp_path):
    options = {"biorxiv": SourceOptions(), "chemrxiv": SourceOptions()}
    sources = ("pmc", "europepmc", "biorxiv", "medrxiv", "arxiv", "chemrxiv")
    search = Search(keywords=("virus",), sources=sources, source_options=options, date_range=DateRange("2024/01/01", "2024/12/31"))
    w, reached = Workspace(spark, str(tmp_path / "w")), fetchers.Services("fake_services:transport", pdf=conversion())
    outcomes, _ = collect(w, search, reached.finders(), reached.fetchers())
    by = {o.source: o for o in outcomes}
    assert not any(o.error for o in outcomes)
    assert by["pmc"].counts["valid"] == 1 and by["europepmc"].counts["found"] == 5
    assert by["europepmc"].counts["errors"] == 1  # another article than asked for
    assert by["biorxiv"].counts["found"] == 1 and by["arxiv"].counts["found"] == 3
    assert by["arxiv"].counts["valid"] == 3 and by["chemrxiv"].counts["valid"] == 3 and by["chemrxiv"].counts["errors"] == 0
    why = {r.error for r in w.table("progress").where("state = 'failed'").collect()}
    assert why == {"another article"}


def conversion():
    """One that tasks can take along: it reads headers only, so the full text is asked for in vain."""
    tei = TEI
    return lambda body, full: None if full or not body.startswith(b"%PDF") else tei


def test_a_source_of_pdf_files_needs_a_conversion(spark, fakes, tmp_path):
    outcomes, _ = collect(Workspace(spark, str(tmp_path / "w")), Search(keywords=("k",), sources=("arxiv",)), fakes.finders(), fakes.fetchers())
    assert "PDF" in outcomes[0].error and outcomes[0].counts == {}


def test_an_empty_page_is_asked_for_again_and_then_fails():
    def service(empty):
        left, asked = [empty], []

        def ask(name, params):
            asked.append(params["start"])
            if params["start"] == 2 and left[0]:
                left[0] -= 1
                return '<feed xmlns:o="x"><o:totalResults>3</o:totalResults></feed>'
            return fake_services.transport(name, params)

        return ask, asked

    ask, asked = service(2)
    assert len(list(services.scan(ask, "arxiv", {}))) == 2 and asked == [0, 2, 2, 2]
    with pytest.raises(services.ServiceError, match="empty page after 2 of 3") as e:
        list(services.scan(service(9)[0], "arxiv", {}))
    assert len(e.value.pages) == 1


def test_a_list_without_a_count_ends_at_a_short_page():
    def ask(_, params):
        n = 1000 if params["page"] < 3 else 7
        return json.dumps({"citationList": {"citation": [{"id": str(i)} for i in range(n)]}})

    node = {"source": "MED", "id": "1", "kind": "citations"}
    assert len(list(services.scan(ask, "europepmc_links", node, size=1000))) == 3
    endless = lambda _, params: ask(_, {"page": 1})
    assert len(list(services.scan(endless, "europepmc_links", node, size=1000))) == services.MOST_PAGES


def test_searches_beyond_one_answer(spark, monkeypatch):
    days = {date(2024, 1, 1) + timedelta(days=i): [f"{i}-{k}" for k in range(3)] for i in range(10)}

    def ask(_, params):
        read = lambda name: date.fromisoformat(params[name].replace("/", "-"))
        first, last = (read("mindate"), read("maxdate")) if "mindate" in params else (min(days), max(days))
        ids = [x for d, some in days.items() if first <= d <= last for x in some]
        return json.dumps({"esearchresult": {"count": str(len(ids)), "idlist": ids[: min(params["retmax"], 7)]}})

    monkeypatch.setattr(services, "MOST_IDS", 7)
    with pytest.raises(services.ServiceError, match="7 of 30"):
        services.esearch(ask, "q")
    assert len(services.esearch(ask, "q", 5)) == 5
    spans = services.windows(ask, "q", date(2023, 1, 1), date(2025, 1, 1))
    assert all(a <= b for a, b in spans) and sum(len(services.esearch(ask, "q", **services._days(a, b))) for a, b in spans) == 30
    monkeypatch.setattr(services, "MOST_IDS", 2)
    with pytest.raises(services.ServiceError, match="3 ids on"):
        services.windows(ask, "q", date(2024, 1, 1), date(2024, 1, 1))


def test_readers_share_the_rate():
    """Three readers that start at the same time, each with its own clock: together never faster than the host's rate."""
    times = []
    for i in range(3):
        h, clock, _ = http([b"x"] * 5)
        mine = h.shared(3, i)
        for _ in range(5):
            mine("arxiv", {})
            times.append(clock.now)
    times.sort()
    assert len(times) == 15 and min(b - a for a, b in zip(times, times[1:], strict=False)) >= 3.0 - 1e-9


def test_texts_are_fetched_by_several_tasks(spark, fakes):
    ids = spark.createDataFrame([(f"PMC{i}",) for i in range(12)] + [("pmc3",), ("x",), (None,)], "pmcid string").repartition(3)
    found = {r.pmcid: (r.xml is not None, r.error) for r in services.fetch_texts(ids, fakes.call).collect()}
    assert len(found) == 15 and found["PMC5"] == (True, None) and found["PMC3"] == found["pmc3"] == (False, "not there") and found["x"] == found[None] == (False, "not an id")
    assert services.fetch_texts(ids, fakes.call).rdd.getNumPartitions() == services.READERS
    away = lambda *_: (_ for _ in ()).throw(services.ServiceError("efetch", "HTTP 500"))
    assert {r.error for r in services.fetch_texts(ids.where("pmcid like 'PMC%'"), away).collect()} == {"efetch: HTTP 500"}


def test_articles_of_an_answer_are_told_by_their_own_id():
    xml = '<set><article><front><article-meta><related-article><pub-id pub-id-type="pmcid">PMC9</pub-id></related-article><article-id pub-id-type="pmcid">PMC7</article-id></article-meta></front></article></set>'
    assert list(services.split_articles(xml)) == ["7"]


def test_a_node_without_its_list_has_failed(spark):
    def ask(_, params):
        if params["id"] == "2":
            raise services.ServiceError("europepmc_links", "HTTP 500")
        return None if params["id"] == "3" else json.dumps({"hitCount": 1, "referenceList": {"reference": {"id": "9", "source": "MED"}}})

    nodes = spark.createDataFrame([("MED", str(i)) for i in (1, 2, 3, 1)], "src_source string, src_id string")
    edges, outcomes = fetchers.edges_of(services.link_pages(nodes, ask, "references"), "references")
    assert [(r.src_id, r.record.id, r.complete) for r in edges.collect()] == [("1", "9", True)]
    assert sorted((r.src_id, r.pages, r.got, r.error, r.complete) for r in outcomes.collect()) == [("1", 1, 1, None, True), ("2", 0, 0, "HTTP 500", False), ("3", 0, 0, None, True)]
    seeds = spark.createDataFrame([(i, str(i), "MED") + (None,) * 4 for i in (1, 2, 3)], "ord long, id string, source string, title string, doi string, pmid string, pmcid string")
    for given in ((edges, outcomes), (lambda asked: (edges, outcomes), None)):
        made = graph.expand(seeds, given[0], ("references",), outcomes=given[1])
        assert [r.node for r in made.failed.collect()] == ["MED/2"] and [r.id for r in made.papers.collect()] == ["9"]


STREAMED = """
import json, os
import fake_services
from corpusloom.sources.services import ServiceError
LOG, BROKEN = {log!r}, {broken!r}

def transport(service, params):
    with open(LOG, "a") as out:
        out.write(str(params["cursorMark"]) + chr(10))
    if params["cursorMark"] == "4" and os.path.exists(BROKEN):
        raise ServiceError(service, "HTTP 500")
    return fake_services.transport(service, params)
"""


def test_a_stream_asks_for_no_page_twice(spark, tmp_path):
    log, broken = tmp_path / "log", tmp_path / "broken"
    (tmp_path / "streamed_service.py").write_text(STREAMED.format(log=str(log), broken=str(broken)))
    for path in (tmp_path / "streamed_service.py", Path(__file__).with_name("fake_services.py")):
        spark.sparkContext.addPyFile(str(path))

    def run():
        pages = services.stream(spark, "europepmc", {"query": "q"}, f"file://{tmp_path}/spool", "streamed_service:transport", each=3)
        q = pages.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        q.awaitTermination()

    broken.write_text("")
    with pytest.raises(Exception, match="HTTP 500"):
        run()
    assert set(log.read_text().split()) == {"*", "2", "4"} and log.read_text().split().count("*") == 1
    broken.unlink()
    run()
    run()
    run()
    asked = log.read_text().split()
    assert asked.count("*") == asked.count("2") == asked.count("5") == 1
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.page for r in found.collect()) == [0, 1, 2, 3] and found.where("error is not null").count() == 0


def test_mirror_sync(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sync, "EVERY", 2)
    remote = [(f"PMC{i}", f"oa/{i}.tar.gz", "oa", "2024-01-01") for i in range(5)]
    schema = "accession_id string, filename string, subset string, last_updated string"
    m, got = sync.Mirror(spark, str(tmp_path / "m")), []

    def fetch(name):
        got.append(name)
        if name == "oa/3.tar.gz" and len(got) < 6:
            raise OSError("away")
        return name.encode()

    first = m.sync(spark.createDataFrame(remote, schema), fetch)
    assert (first.downloaded, first.failed) == (4, ("oa/3.tar.gz",)) and len(got) == 5
    remote[0] = ("PMC0", "oa/0.tar.gz", "oa", "2024-02-01")
    again = m.sync(spark.createDataFrame(remote, schema), fetch)
    assert again.downloaded == 2 and sorted(got[5:]) == ["oa/0.tar.gz", "oa/3.tar.gz"]
    assert {r.state for r in m.verify().collect()} == {"verified"} and m.manifest().count() == 5
    os.remove(tmp_path / "m/files/oa/1.tar.gz")
    assert sorted(r.state for r in m.verify().collect()).count("missing") == 1


def test_archives(tmp_path):
    for name in ("a.xml", "valid/b.xml", "x/c.xml"):
        (tmp_path / "c" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "c" / name).write_text(name)
    path = str(tmp_path / "c.tar.gz")
    assert files.archive_folder(str(tmp_path / "c"), path) == 2
    for n in (1, 2):
        assert files.embed_documents(path, {"run": {"n": n}}) == 2
    with tarfile.open(path) as tar:
        assert tar.getnames() == ["a.xml", "x/c.xml", ".provenance/run.json"] and b"2" in tar.extractfile(".provenance/run.json").read()


def test_settings(tmp_path, monkeypatch, capsys):
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "a" / config.FILE).write_text('email = "file@x"\nroot = "there"\nother = 1\n')
    path = config.find(tmp_path / "a/b", tmp_path)
    found = config.load({"email": ""}, {"CORPUSLOOM_EMAIL": "env@x", "CORPUSLOOM_API_KEY": "0123456789"}, path)
    assert (found.email, found.root, found.shown()["api_key"]) == ("env@x", "there", "…6789")
    assert config.load({"email": "flag@x"}, {"CORPUSLOOM_EMAIL": "env@x"}, path).email == "flag@x"
    (tmp_path / "bad.toml").write_text("= 1")
    with pytest.raises(ValueError, match="bad.toml"):
        config.load({}, {}, tmp_path / "bad.toml")
    assert __main__.main(["config", "--email", "me@x"]) == 0 and "me@x" in capsys.readouterr().out

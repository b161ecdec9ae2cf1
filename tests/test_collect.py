from pathlib import Path

from corpusloom.functions.search import Search
from corpusloom.operators.commits import CommitLog
from corpusloom.plans import fetchers
from corpusloom.plans.collect import ARTICLE, Cadence, Workspace, collect, collect_source, expand_search, refresh


def xml(doi, title="T"):
    return f"<article><front><article-meta><article-id pub-id-type='doi'>{doi}</article-id><title-group><article-title>{title}</article-title></title-group></article-meta></front><body>{'x ' * 60}</body></article>"


def test_runs_remember(spark, tmp_path):
    rows = {
        "pmc": [("pmc", "PMC1", "PMC1", "10.1/a", "A", None, xml("10.1/a")), ("pmc", "PMC2", "PMC2", None, "B", None, None), ("pmc", "PMC3", "PMC3", None, "C", None, None)],
        "arxiv": [("arxiv", "1v1", None, "10.1/A", "A", None, xml("10.1/a")), ("arxiv", "2v1", None, None, "D", None, xml("", " "))],
    }
    asked, since = [], []

    def finder(source):
        def find(session, search, day):
            since.append(day)
            return session.createDataFrame(rows[source], ARTICLE)

        return find

    texts = {"PMC2": xml("10.1/b"), "PMC3": None}

    def fetch(articles):
        asked.append(sorted(r.id for r in articles.select("id").collect()))
        return spark.createDataFrame([(i, texts[i]) for i in asked[-1]], "id string, xml string")

    def broken(session, search, day):
        raise OSError("away")

    w = Workspace(spark, str(tmp_path / "w"))
    s = Search(keywords=("k",), sources=("biorxiv", "arxiv", "pmc"))
    finders = {"pmc": finder("pmc"), "arxiv": finder("arxiv"), "biorxiv": broken}
    outcomes, total = collect(w, s, finders, {"pmc": fetch})
    by = {o.source: o for o in outcomes}
    assert [o.source for o in outcomes] == ["pmc", "biorxiv", "arxiv"] and by["biorxiv"].error == "away"
    assert by["pmc"].counts == {"found": 3, "resumed": 0, "duplicates": 0, "errors": 1, "fetched": 2, "valid": 2, "incomplete": 0, "invalid": 0}
    assert by["arxiv"].counts["duplicates"] == 1 and by["arxiv"].counts["incomplete"] == 1
    assert total["found"] == total["resumed"] + total["duplicates"] + total["errors"] + total["fetched"]
    assert sorted(r.doi for r in w.table("doi_index").collect()) == ["10.1/a", "10.1/b"]
    assert w.last_day("pmc") is None and w.last_day("arxiv") is not None  # errors keep the marker
    assert tuple(w.statistics().first()) == (3, 2, 1, 0)

    texts["PMC3"] = xml("10.1/c")
    again = {o.source: o.counts for o in refresh(w, finders, {"pmc": fetch})}
    assert asked == [["PMC2", "PMC3"], ["PMC3"]] and again["pmc"]["resumed"] == 2 and again["pmc"]["valid"] == 1
    assert again["arxiv"]["resumed"] == 1 and w.history().count() == 4 and since[-1] is None
    w.clear(keep_history=True)
    assert w.table("articles").count() == 0 and w.history().count() == 4


def test_plan(spark):
    record = "struct<id: string, source: string, title: string, doi: string, pmid: string, pmcid: string>"
    seeds = spark.createDataFrame([(0, "1", "MED", None, None, None, "PMC1")], "ord long, id string, source string, title string, doi string, pmid string, pmcid string")
    edges = spark.createDataFrame([("MED", "1", "references", i, (str(i + 5), "MED", None, None, None, p), True) for i, p in enumerate(["pmc7", None, "PMC8", "PMC1"])], f"src_source string, src_id string, kind string, pos int, record {record}, complete boolean")
    search = Search(keywords=("k",), expand_references=True)
    assert sorted((r.pmcid, r.role) for r in expand_search(seeds, edges, search).collect()) == [("PMC1", "seed"), ("PMC7", "expanded"), ("PMC8", "expanded")]
    assert [r.pmcid for r in expand_search(seeds, edges, search, 2).collect()] == ["PMC1", "PMC7"]


REQUESTS = """
import fake_services
LOG = {path!r}

def transport(service, params):
    with open(LOG, "a") as out:
        out.write(service + " " + str(params.get("cursorMark", params.get("start", params.get("id", "")))) + chr(10))
    return fake_services.transport(service, params)
"""


def counted(spark, tmp_path, name):
    """Services whose requests are written down, whichever process makes them."""
    (tmp_path / f"{name}.py").write_text(REQUESTS.format(path=str(tmp_path / "requests")))
    for path in (tmp_path / f"{name}.py", Path(__file__).with_name("fake_services.py")):
        spark.sparkContext.addPyFile(str(path))
    return fetchers.Services(f"{name}:transport")


def test_a_source_is_read_once(spark, tmp_path):
    services, told = counted(spark, tmp_path, "counted_once"), []
    w = Workspace(spark, str(tmp_path / "w"))
    outcome = collect_source(w, "europepmc", Search(keywords=("k",)), services.find_europepmc, services.fetch_europepmc, on_progress=told.append)
    asked = (tmp_path / "requests").read_text().split("\n")[:-1]
    assert [a for a in asked if a.startswith("europepmc ")] == ["europepmc *", "europepmc 2", "europepmc 4", "europepmc 5"]
    assert sorted(a for a in asked if a.startswith("europepmc_text")) == [f"europepmc_text PMC{i}" for i in range(5)]
    assert outcome.counts == {"found": 5, "resumed": 0, "duplicates": 0, "errors": 1, "fetched": 4, "valid": 4, "incomplete": 0, "invalid": 0}
    assert [(p.source, p.done, p.total) for p in told] == [("europepmc", 0, 5), ("europepmc", 5, 5)] and told[-1].counts == outcome.counts
    assert not list((tmp_path / "w/staging").iterdir())


def kept(w):
    """What the tables hold, but for times."""
    tables = {"articles": ("source", "id", "doi", "file", "status", "search_id"), "doi_index": ("doi", "file", "search_id"), "progress": ("source", "id", "state", "error"), "markers": ("source", "papers_fetched"), "searches": ("id", "source")}
    return {t: sorted(map(tuple, w.table(t).select(*c).collect()), key=repr) for t, c in tables.items()}


def test_a_run_broken_off_at_any_write_goes_on(spark, tmp_path):
    rows = [("pmc", f"PMC{i}", f"PMC{i}", None, "T", None, xml(f"10.1/{i % 4}")) for i in range(5)]
    find, search = lambda s, *_: s.createDataFrame(rows, ARTICLE), Search(keywords=("k",))
    cadence = Cadence(items=3, seconds=0.0)
    whole = Workspace(spark, str(tmp_path / "whole"))
    collect_source(whole, "pmc", search, find, cadence=cadence)
    expected = kept(whole)
    assert len(expected["articles"]) == 4 and len(expected["progress"]) == 5 and expected["markers"] == [("pmc", 4)]
    steps = 0
    while True:
        w, left = Workspace(spark, str(tmp_path / f"w{steps}")), [steps]

        def broken(f, left=left):
            def run(*args, **how):
                if left[0] == 0:
                    raise OSError("the power went")
                left[0] -= 1
                return f(*args, **how)

            return run

        w.log.write, w.log.publish = broken(w.log.write), broken(w.log.publish)
        try:
            collect_source(w, "pmc", search, find, cadence=cadence)
            break
        except OSError:
            again = Workspace(spark, w.root)
            before = kept(again)
            assert len(before["progress"]) in (0, 3, 5)  # whole batches only
            collect_source(again, "pmc", search, find, cadence=cadence)
            assert kept(again) == expected
        steps += 3 if steps else 1
    assert steps > 6


def test_batches_are_merged_and_numbers_are_taken_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), {"a": "k string, n int", "b": "n int"}, keyed={"a": ("k", 4)})
    rows = lambda *x: spark.createDataFrame([(str(i), i) for i in x], "k string, n int")
    log.commit("one", {"a": rows(1, 2), "b": rows(7).select("n")})
    log.commit("two", {"a": rows(3, 4)})
    log.write("lost", "a", rows(5))
    log.publish("one")
    both = [sorted(r.n for r in log.table("a").collect()), [r.n for r in log.table("b").collect()]]
    assert both == [[1, 2, 3, 4], [7]]
    asked = spark.createDataFrame([("2",), ("5",), ("9",), (None,)], "q string")
    assert [r.q for r in log.known("a", asked, "q").collect()] == ["2"]
    assert log.compact() and log.compact() is None and log.vacuum() == 4
    assert [sorted(r.n for r in log.table("a").collect()), [r.n for r in log.table("b").collect()]] == both
    assert [r.q for r in log.known("a", asked, "q").collect()] == ["2"]
    first, other = log.reserve("search_", "x-1"), log.reserve("search_", "y-1")
    assert (first, other, log.reserve("search_", "x-1")) == ("search_001", "search_002", "search_001")
    log.close(first)
    assert log.reserve("search_", "x-1") == "search_003"


def test_a_callback_that_fails_stops_nothing(spark, tmp_path):
    def fails(progress):
        raise ValueError("no")

    find = lambda s, *_: s.createDataFrame([], ARTICLE)
    outcome = collect_source(Workspace(spark, str(tmp_path / "w")), "pmc", Search(keywords=("k",)), find, on_progress=fails)
    assert set(outcome.counts.values()) == {0}


def test_texts_are_not_shuffled_by_batches(spark, tmp_path):
    """Each text is written where it was fetched and read from there, however many batches there are."""
    import random

    sc, draw = spark.sparkContext._jsc.sc(), random.Random(3)
    texts = {f"PMC{i}": xml(f"10.1/{i // 2}").replace("</body>", f"{draw.randbytes(50_000).hex()}</body>") for i in range(24)}
    rows = [("pmc", i, i, None, i, None, None) for i in [*texts, "PMC99"]]

    def shuffled():
        sc.listenerBus().waitUntilEmpty(60_000)
        return sc.statusStore().executorList(True).apply(0).totalShuffleWrite()

    def fetch(articles):
        return spark.createDataFrame([(r.id, texts.get(r.id)) for r in articles.select("id").collect()], "id string, xml string")

    w, before = Workspace(spark, str(tmp_path / "w")), shuffled()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = collect_source(w, "pmc", Search(keywords=("k",)), lambda *_: spark.createDataFrame(rows, ARTICLE), fetch, cadence=Cadence(items=9))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert told.counts["fetched"] == 12 and told.counts["duplicates"] == 12 and told.counts["errors"] == 1
    assert shuffled() - before < 600_000  # of 2.4 MB of texts, none
    assert {r.id: r.xml for r in w.table("articles").collect()} == {i: texts[i] for i in [r.id for r in w.table("articles").collect()]}
    assert {r.id: r.error for r in w.table("progress").where("state = 'failed'").collect()} == {"PMC99": "no full text"}

"""Search, links, resolution, plan and replay, over the fakes and through the command line."""

import json
from dataclasses import replace
from pathlib import Path

import pytest

from corpusloom import __main__
from corpusloom.functions.search import Search
from corpusloom.operators import graph
from corpusloom.plans import expansion, fetchers
from corpusloom.plans.collect import Cadence, Workspace

SEARCH = Search(keywords=("k",), expand_citations=True)


@pytest.fixture
def fakes(spark):
    spark.sparkContext.addPyFile(str(Path(__file__).with_name("fake_services.py")))
    return fetchers.Services("fake_services:transport")


def test_from_search_to_replay(spark, fakes, tmp_path):
    root = str(tmp_path / "w")
    made = expansion.expand_search(spark, fakes, SEARCH, root)
    assert (made.seeds, made.invalid_seeds, made.planned) == (5, 0, 7)
    assert sorted(r.node for r in made.expansion.failed.collect()) == [f"MED/{i}" for i in range(5)]  # every list breaks off
    plans = expansion.Plans(spark, root)
    rows = plans.plan(made.plan).orderBy("ordinal").collect()
    assert [(r.ordinal, r.pmcid, r.role) for r in rows] == [(i + 1, f"PMC{i}", "seed") for i in range(5)] + [(6, "PMC10", "expanded"), (7, "PMC20", "expanded")]
    told = plans.log.table("outcomes").collect()
    assert [(r.kind, r.total, r.own, r.by_source, r.by_pmid, r.none) for r in told] == [("citations", 4, 0, 0, 2, 2)]
    assert plans.estimate(made.plan, 3).first().n == 3
    assert expansion.expand_search(spark, fakes, SEARCH, root).plan == made.plan and plans.log.commits().count() == 1
    assert expansion.expand_search(spark, fakes, replace(SEARCH, max_results_per_source=2), root).plan != made.plan

    whole = Workspace(spark, str(tmp_path / "whole"))
    expansion.Plans(spark, whole.root).keep(plans.plan(made.plan), graph.resolution(made.expansion.papers, spark.createDataFrame([], "pmid string, pmcid string")), made.expansion.failed)
    all_at_once = expansion.replay(whole, fakes, made.plan, SEARCH)
    assert all_at_once.counts["found"] == 7 and all_at_once.counts["errors"] == 1 and all_at_once.counts["valid"] == 6
    parts = Workspace(spark, root)
    first = expansion.replay(parts, fakes, made.plan, SEARCH, 3)
    assert first.counts["found"] == first.counts["valid"] == 3
    rest = expansion.replay(parts, fakes, made.plan, SEARCH, cadence=Cadence(2, 0.0))
    assert rest.counts["resumed"] == 3 and rest.counts["valid"] == 3
    ids = lambda w: sorted((r.id, r.status, r.sha256) for r in w.table("articles").collect())
    assert ids(parts) == ids(whole)
    with pytest.raises(ValueError, match="no plan"):
        plans.plan("other")


def test_commands(spark, fakes, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(__main__, "_spark", lambda: spark)
    config, root = tmp_path / "s.json", str(tmp_path / "w")
    config.write_text(json.dumps(SEARCH.to_dict()))
    reach = ["--transport", "fake_services:transport"]
    run = lambda *args: (__main__.main(list(args)), [json.loads(x) for x in capsys.readouterr().out.splitlines()])
    assert run("workspace", "init", root) == (0, []) and __main__.main(["workspace", "init", root]) == 1
    status, out = run("expand", str(config), root, *reach)
    assert status == 0 and out[0]["planned"] == 7 and out[1]["citations_found"] == 20 and out[1]["total_unique"] == 4
    assert {"failed": 5} in out and out[-1]["n"] == 7
    status, out = run("fetch", str(config), root, "--plan", out[0]["plan"], "--max-results", "2", *reach)
    assert status == 0 and out[0]["counts"]["valid"] == 2
    status, out = run("workspace", "status", root)
    assert status == 0 and out[0]["total"] == 2
    status, out = run("workspace", "compact", root)
    assert status == 0 and out[0]["merged"] and run("workspace", "status", root)[1][0]["total"] == 2


def test_a_plan_is_named_by_what_it_plans(spark):
    seeds = spark.createDataFrame([(1, "PMC1"), (2, "PMC2")], "ord long, pmcid string")
    papers = spark.createDataFrame([(1, "PMC7", "citations"), (2, "pmc2", "citations"), (3, None, "citations")], "ord long, pmcid string, kind string")
    plan = graph.versioned(graph.plan(seeds, papers))
    assert [tuple(r)[1:] for r in plan.orderBy("ordinal").collect()] == [(1, "PMC1", "seed"), (2, "PMC2", "seed"), (3, "PMC7", "expanded")]
    same = graph.versioned(graph.plan(seeds.repartition(3), papers.repartition(5)))
    other = graph.versioned(graph.plan(seeds, papers.where("ord > 1")))
    assert same.first().plan == plan.first().plan != other.first().plan


def test_the_last_hop_is_numbered_only_when_asked_and_coverage_follows_no_link(spark, monkeypatch):
    from corpusloom.operators import graph
    from corpusloom.plans import registry

    calls, numbered = [], graph._numbered
    monkeypatch.setattr(graph, "_numbered", lambda *a: calls.append(1) or numbered(*a))
    tables = "/root/testdata/sf0.001"
    made = registry._expanded(spark, tables)
    assert made.layers.count() == 1 and not calls
    assert made.papers.select("id", "kind", "depth").exceptAll(made.accepted.select("id", "kind", "depth")).count() == 0 and len(calls) == 1
    monkeypatch.setattr(graph, "expand", None)
    assert registry.q_expand_coverage(spark, tables).exceptAll(made.coverage).count() == 0

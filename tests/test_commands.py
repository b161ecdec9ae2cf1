"""Commands over folders and fakes; the conversion service; archives in parts."""

import io
import json
import tarfile
import urllib.error
from pathlib import Path

import pytest
from test_functions import TEI

from corpusloom import __main__
from corpusloom.functions.search import Search, SourceOptions
from corpusloom.operators import checks
from corpusloom.plans import expansion
from corpusloom.sources import archives, conversion
from corpusloom.sources.services import ServiceError

ARTICLE = "<article><front><article-meta><article-title>T</article-title></article-meta></front><body>b</body></article>"


@pytest.fixture
def run(spark, monkeypatch, capsys):
    monkeypatch.setattr(__main__, "_spark", lambda: spark)
    spark.sparkContext.addPyFile(str(Path(__file__).with_name("fake_services.py")))

    def call(*args):
        status = __main__.main([str(a) for a in args])
        said = capsys.readouterr()
        return status, [json.loads(x) for x in said.out.splitlines()], said.err

    return call


def test_articles_by_their_ids_and_archives_of_them(run, tmp_path):
    config, root, reach = tmp_path / "s.json", tmp_path / "w", ("--transport", "fake_services:transport")
    config.write_text(json.dumps(Search(keywords=("k",)).to_dict()))
    status, _, err = run("fetch", config, root, "--pmcid", "PMC5", "--pmcid", "10.1/x", *reach)
    assert status == 1 and "10.1/x" in err and not root.exists()  # one that isn't a PMCID refuses the whole command
    status, out, _ = run("fetch", config, root, "--pmcid", "pmc5", "--pmcid", "PMC007", "--pmcid", "3", *reach)
    assert status == 0 and out[0]["counts"]["valid"] == 2 and out[0]["counts"]["errors"] == 1
    status, out, _ = run("workspace", "build", root, "--out", f"file://{tmp_path}/archives")
    assert status == 0 and out[0]["files"] == out[0]["valid"] == 2
    names = []
    for p in sorted((tmp_path / "archives").glob("*.tar.gz")):
        with tarfile.open(p) as tar:
            names += [n for n in tar.getnames() if not n.startswith(".provenance")]
            assert json.load(tar.extractfile(".provenance/searches.json"))["searches"][0]["source"] == "pmc"
    assert sorted(names) == ["valid/pmc_PMC5.xml", "valid/pmc_PMC7.xml"]
    assert [expansion.pmcid_of(x) for x in (" pmc012 ", "12", "PMC", "x12", "PMC1.2")] == ["PMC12", "PMC12", None, None, None]


def test_files_are_checked_and_taken_in(run, tmp_path):
    (tmp_path / "a/incomplete").mkdir(parents=True)
    for name, body in (("x.xml", ARTICLE.encode()), ("y.xml", b"<a"), ("z.xml", b"\xff\xfe<a/>"), ("incomplete/v.xml", ARTICLE.encode())):
        (tmp_path / "a" / name).write_bytes(body)
    status, out, _ = run("check", tmp_path / "a")
    assert status == 0 and (out[0]["total_files"], out[0]["valid_count"], out[0]["invalid_count"]) == (3, 1, 2)
    assert [(r["path"][-5:], r["status"]) for r in out[1:]] == [("y.xml", "invalid"), ("z.xml", "invalid")] and out[2]["errors"] == ["not UTF-8"]
    (tmp_path / "m/files").mkdir(parents=True)
    for name in ("PMC1.tar.gz", "x.tar.gz"):
        (tmp_path / "m/files" / name).write_bytes(b"12")
    (tmp_path / "l.csv").write_text("File,Accession ID,Last Updated (YYYY-MM-DD HH:MM:SS)\noa/PMC1.tar.gz,PMC1,2024-01-01 10:00:00\noa/PMC2.tar.gz,PMC2,2024-01-01 10:00:00\n")
    status, out, _ = run("mirror", "import", tmp_path / "m", "--list", tmp_path / "l.csv")
    assert status == 0 and out == [{"scanned": 2, "matched": 1, "unmatched": 1}, {"filename": "x.tar.gz"}]
    status, out, _ = run("mirror", "sync", tmp_path / "m", "--list", tmp_path / "l.csv")
    assert out == [{"pending": 1}]


def test_pdf_files_are_converted(run, tmp_path, monkeypatch):
    (tmp_path / "p").mkdir()
    for name in ("a.pdf", "B.PDF", "c.txt"):
        (tmp_path / "p" / name).write_bytes(b"%PDF " + name.encode())
    status, _, err = run("pdf", tmp_path / "p", tmp_path / "out", "--service", "http://127.0.0.1:9")
    assert status == 1 and "no service" in err
    tei = TEI
    monkeypatch.setattr(conversion.TeiService, "checked", lambda self: lambda body, full: tei if full and b"a.pdf" in body else None)
    status, out, _ = run("pdf", tmp_path / "p", tmp_path / "out")
    assert status == 0 and {(r["status"], r["source"], r["n"]) for r in out} == {("valid", "grobid-fulltext", 1), ("failed", "unknown", 1)}
    csv = "".join(p.read_text() for p in sorted((tmp_path / "out/metadata").glob("*.csv")))
    assert csv.startswith("path,sha1,first_author") and "no TEI" in csv


def served(answers):
    """Answers of a service by path: text, or a status."""
    asked = []

    class Answer(io.BytesIO):
        status = 200

    def opened(request, timeout):
        path = "/" + request.full_url.partition("://")[2].partition("/")[2]
        asked.append((path, request.data, request.get_header("Content-type")))
        found = answers.get(path)
        if not isinstance(found, str):
            raise urllib.error.HTTPError(request.full_url, found or 404, "", None, None)
        return Answer(found.encode())

    return opened, asked


def test_the_conversion_service_tells_what_it_can(monkeypatch):
    for version, properties, able in (("0.8-full", None, True), ("0.8", "x=1\nTesseract=yes", True), ("0.8", "no.ocr=1", False), ("0.8", "pdfalto.ocr=a", True), (None, "tesseract", False), ("0.8", None, False)):
        assert conversion.reads_scans(version, properties) is able
    slept = []
    opened, asked = served({conversion.ALIVE: "true", conversion.VERSION: "0.8", conversion.FULL: "<TEI/>", conversion.HEADER: 503})
    service = conversion.TeiService("http://x/", open=opened, clock=lambda: sum(slept), sleep=slept.append)
    assert service.checked() is service and service(b"%PDF", True) == "<TEI/>" and service(b"%PDF", False) is None and slept == [1.0]
    assert asked[-2][0] == conversion.FULL and b"%PDF" in asked[-2][1] and b'name="consolidateHeader"' in asked[-2][1] and asked[-2][2].startswith("multipart/form-data; boundary=")
    with pytest.raises(ServiceError, match="scans"):
        conversion.TeiService("http://x", ocr=True, open=opened).checked()
    with pytest.raises(ServiceError, match="no service"):
        conversion.TeiService("http://x", open=served({})[0]).checked()


def test_archives_in_parts(spark, tmp_path):
    rows = spark.createDataFrame([(f"d/{i % 7}.xml", bytearray(b"x" * i)) for i in range(20)] + [("plain", bytearray(b""))], "name string, body binary")
    for out in ("one", "two"):
        told = archives.write_parts(rows.repartition(3 if out == "one" else 5), f"file://{tmp_path}/{out}", 4, {"run": {"n": 1}}).collect()
        assert sum(r["files"] for r in told) == 21 and sum(r["bytes"] for r in told) == sum(range(20)) and len(told) == 4
    found = archives.members(spark, f"{tmp_path}/one")
    assert found.where("name like '.provenance%'").count() == 4 and found.where("error is not null").count() == 0
    names = sorted(r.name for r in found.where("name not like '.provenance%'").collect())
    assert len(set(names)) == 21 and "d/0-2.xml" in names and "plain" in names
    assert sorted(p.name for p in (tmp_path / "one").glob("[!.]*")) == [f"part-{i:05d}.tar.gz" for i in range(4)]


def test_addresses_of_pdf_files(spark):
    rows = [("PMC1", "index", '<a href="suppl/s.pdf">x</a><a href="main.pdf?x=1">m</a>'), ("PMC1", "meta", '<meta content="https://h/pdf/m.pdf" name="citation_pdf_url">'), ("PMC2", "oa", '<link format="PDF" href="ftp://h/suppl.pdf"/>'), ("PMC3", "oa", None)]
    found = sorted((r.pmcid, r.ordinal, r.url, r.is_primary) for r in checks.pdf_addresses(spark.createDataFrame(rows, "pmcid string, kind string, body string")).collect())
    at = "https://pmc.ncbi.nlm.nih.gov/articles/PMC1/pdf/"
    assert found == [("PMC1", 1, "https://h/pdf/m.pdf", True), ("PMC1", 2, f"{at}suppl/s.pdf", False), ("PMC1", 3, f"{at}main.pdf?x=1", False), ("PMC2", 1, "ftp://h/suppl.pdf", True)]


def test_comparisons_of_any_size(run, tmp_path):
    for name, some in (("a", range(10)), ("b", range(5, 25))):
        (tmp_path / name).write_text("".join(f"PMC{i}\n" for i in some))
    status, out, _ = run("compare", tmp_path / "a", tmp_path / "b", "--out", tmp_path / "out")
    assert status == 0 and (out[0]["overlap_count"], out[0]["reference_only_count"], out[0]["recall"], out[0]["jaccard"]) == (5, 5, 0.5, 0.2)
    of = lambda k: [x for p in sorted((tmp_path / f"out/ids/list={k}").glob("*.txt")) for x in p.read_text().split()]
    assert of("overlap") == [f"PMC{i}" for i in range(5, 10)] and of("reference_only") == [f"PMC{i}" for i in range(5)] and len(of("candidate_only")) == 15


def test_categories_that_a_source_does_not_have():
    options = {"biorxiv": SourceOptions(categories=("Cell Biology", "alchemy")), "chemrxiv": SourceOptions(categories=("Catalysis",)), "arxiv": SourceOptions(categories=("x",))}
    assert Search(keywords=("k",), source_options=options).unknown_categories() == {"biorxiv": ["alchemy"]}

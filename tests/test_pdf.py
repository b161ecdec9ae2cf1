import json

from test_functions import TEI

from corpusloom.__main__ import main
from corpusloom.plans import pdf


def test_conversion(spark):
    tei = TEI

    def service(body, full):
        return tei if body == b"whole" and full or body == b"head" and not full else None

    files = spark.createDataFrame([("/d/a.pdf", bytearray(b"whole")), ("/d/b.pdf", bytearray(b"head")), ("/d/c.pdf", bytearray(b"none"))], "path string, content binary")
    made = pdf.tei_of(files, service)
    assert sorted((r.path, r.source, r.tei is None) for r in made.collect()) == [("/d/a.pdf", "grobid-fulltext", False), ("/d/b.pdf", "grobid-header", False), ("/d/c.pdf", "unknown", True)]
    known = spark.createDataFrame([("10.1/T", "99", "PMC5")], "doi string, pmid string, pmcid string")
    rows = {r.path: r for r in pdf.metadata_table(pdf.articles(made, known)).collect()}
    assert (rows["/d/a.pdf"].DOI, rows["/d/a.pdf"].PMID, rows["/d/a.pdf"].PMCID, rows["/d/a.pdf"].status) == ("10.1/t", "99", "PMC5", "valid")
    assert rows["/d/c.pdf"].status == "failed" and rows["/d/c.pdf"].notes == "no TEI"
    again = pdf.tei_of(files.limit(1), lambda *_: 1 / 0, made.select("cache_key", "tei").where("tei is not null"))
    assert [r.source for r in again.collect()] == ["cache"]


def test_search_command(tmp_path, capsys):
    (tmp_path / "s.json").write_text(json.dumps({"keywords": ["x"]}))
    assert main(["search", str(tmp_path / "s.json")]) == 0 and json.loads(capsys.readouterr().out)["pubmed"] == '"x"[tiab]'
    (tmp_path / "s.json").write_text("{}")
    assert main(["search", str(tmp_path / "s.json")]) == 1

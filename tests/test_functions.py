import hashlib
import os
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import ids, search, text, xml
from corpusloom.functions.text import LETTERS
from corpusloom.plans import registry


def each(spark, column, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in df.select("i", column("x").alias("y")).orderBy("i").collect()]


def test_pmcids(spark):
    good = ["PMC12345", "pmc12345", "Pmc12345", "pMc12345", "12345", " PMC12345\n", "\x1f12345"]
    bad = ["PMCPMC1", "PMC", "", "  ", "PMC12a", "arxiv:2301.12345", "PMC 123", "٣٤٥", None]
    assert each(spark, ids.normalize_pmcid, good) == ["PMC12345"] * len(good)
    assert each(spark, ids.normalize_pmcid, bad) == [None] * len(bad)
    assert each(spark, ids.normalize_pmcid, ["007"]) == ["PMC007"]


def test_kinds_of_ids(spark):
    values = ["pmc1", "PMCx", "10.1/ABC", "1234567", "12345678", "123456", "abc", " pmc9 ", "PMC/1"]
    assert each(spark, ids.detect_id_type, values) == ["pmcid", "pmcid", "doi", "pmid", "pmid", "unknown", "unknown", "pmcid", "pmcid"]
    assert each(spark, ids.normalize_id, values) == ["PMC1", "PMCX", "10.1/abc", "1234567", "12345678", "123456", "abc", "PMC9", "PMC/1"]


def test_dois(spark):
    assert each(spark, ids.biorxiv_doi, ["https://doi.org/10.1/Ab", "doi:10.1/x", " http://doi.org/10.1/y ", "10.1/z"]) == ["10.1/Ab", "10.1/x", "10.1/y", "10.1/z"]
    assert each(spark, text.extract_doi, ["see 10.1234/ABC.d), and", "10.12/x", "doi:10.5555/q;", None]) == ["10.1234/ABC.d", None, "10.5555/q", None]
    assert each(spark, ids.doi_key, [" 10.1/X\t", "", "  ", None]) == ["10.1/x", None, None, None]
    assert each(spark, ids.chemrxiv_id, ["2024-abc123", "item_2024-abc123", "https://chemrxiv.org/engage/article/2024-abc123"]) == ["item_2024-abc123"] * 3


def test_best_id_and_keys(spark):
    rows = [("MED", "1", None, None, None), ("MED", "1", "2", "PMC3", "10.1/X"), ("PMC", "7", None, None, None), ("PMC", "x", None, None, None), ("PPR", "PPR9", None, "PMC1", None), ("", None, None, "4", None), (None, None, None, None, "10.1/X"), ("PPR", None, "5", None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, source string, id string, pmid string, pmcid string, doi string").orderBy("i")
    best = [tuple(r.b) if r.b else None for r in df.select(ids.best_id("source", "id", "pmid", "pmcid").alias("b")).collect()]
    assert best == [("MED", "1"), ("MED", "2"), ("PMC", "PMC7"), ("MED", "x"), ("PPR", "PPR9"), ("PMC", "PMC4"), None, ("MED", "5")]
    keys = [sorted(r.k) for r in df.select(ids.identity_keys("source", "id", "doi", "pmid", "pmcid").alias("k")).collect()]
    assert keys == [["pmid:1"], ["doi:10.1/x", "pmcid:PMC3", "pmid:1", "pmid:2"], ["pmcid:PMC7"], [], ["PPR:PPR9", "pmcid:PMC1"], ["pmcid:PMC4"], ["doi:10.1/x"], ["pmid:5"]]


def test_text(spark):
    assert each(spark, text.clean_spaces, [" a  b​c\n", None, ""]) == ["a bc", "", ""]
    assert each(spark, text.clean_text, ["ﬁ ＡＢ x", None]) == ["fi AB x", ""]
    assert each(spark, text.clean_ascii, ["Straße Ångström – œuvre"]) == ["Strasse Angstrom - oeuvre"]
    df = spark.createDataFrame([(45.0,), (61.0,), (3723.0,)], "s double")
    assert [r.d for r in df.select(text.duration("s").alias("d")).collect()] == ["45.0s", "1:01", "1:02:03"]


ARTICLE = "<article><front><article-meta><article-id pub-id-type='PMCID'> PMC1 </article-id><article-id pub-id-type='doi'>10.1/x</article-id><title-group><article-title>{t}</article-title></title-group>{a}</article-meta></front>{b}</article>"


@pytest.mark.parametrize(
    ("title", "abstract", "body", "status", "flags", "errors"),
    [
        ("T", "<abstract><p>A</p></abstract>", "<body><p>" + "x" * 900 + "</p></body>", "valid", (True, True, True), 0),
        ("T", "", "<body><p>" + "x" * 900 + "</p></body>", "valid", (True, False, True), 1),
        ("T", "<abstract>A</abstract>", "", "valid", (True, True, False), 1),
        (" ", "<abstract>A</abstract>", "<body>short</body>", "valid", (False, True, False), 2),
        ("", "", "<body>short</body>", "incomplete", (False, False, False), 3),
        ("<i>H<sub>2</sub>O</i>", "", "<body>" + "y " * 400 + "</body>", "valid", (True, False, False), 2),
    ],
)
def test_validation(title, abstract, body, status, flags, errors):
    v = xml.validate(ARTICLE.format(t=title, a=abstract, b=body))
    assert (v["status"], (v["has_title"], v["has_abstract"], v["has_body"]), len(v["errors"])) == (status, flags, errors)
    assert v["pmcid"] == "PMC1"


def test_validation_of_odd_input(spark):
    assert xml.validate("<article><p></article>")["status"] == xml.validate(None)["status"] == xml.validate("")["status"] == "invalid"
    assert xml.validate('<a xmlns="http://jats.nlm.nih.gov"><article-title>T</article-title><body>123456</body></a>', 5)["has_body"]
    assert xml.spaced_text(xml.ET.fromstring("<t>H<sub>2</sub>O</t>")) == "H 2 O"
    df = spark.createDataFrame([("<article><article-title>T</article-title></article>",), (None,)], "x string")
    assert [r.v.status for r in df.select(xml.validate_jats("x").alias("v")).collect()] == ["valid", "invalid"]
    assert xml.article_doi(ARTICLE.format(t="", a="", b="")) == "10.1/x" and xml.article_doi("<a><article-id pub-id-type='doi'/><article-id pub-id-type='doi'>1</article-id></a>", True) is None


TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>Whole</title></titleStmt><sourceDesc><biblStruct><analytic>
<author><persName><forename>Ann</forename><surname>Lee</surname></persName></author><title type="main">The title</title></analytic><monogr><title level="j">J. Tests</title>
<imprint><date when="2020-05-01"/></imprint></monogr><idno type="DOI">10.1/t</idno><idno type="PMID">11</idno></biblStruct></sourceDesc></fileDesc></teiHeader>
<text><body><div><head>Start</head><p>One <hi rend="italic">two</hi> <ref>three</ref><lb/>four</p></div></body></text></TEI>"""


def test_tei():
    assert xml.tei_metadata(TEI) == {"DOI": "10.1/t", "PMID": "11", "title": "The title", "journal": "J. Tests", "year": "2020", "first_author": "Lee"}
    assert xml.tei_metadata("<TEI") == {} and xml.tei_metadata("<TEI/>") == {}
    out = xml.ET.fromstring(xml.tei_to_jats(TEI))
    q = lambda t: next(out.iter(f"{{{xml.JATS_NS}}}{t}"))
    assert (q("article-title").text, q("surname").text, q("sec")[0].text, xml.spaced_text(q("p")), q("italic").text) == ("Whole", "Lee", "Start", "One two three four", "two")
    assert q("back") is not None and xml.tei_to_jats("<TEI") is None


def test_search_languages():
    s = search.Search(author="lee a", keywords=("x",), virus_keywords=("a", "b"), date_range=search.DateRange("2020/01/01", "2021/12/31"), open_access_only=True)
    assert s.pubmed() == 'lee a[au] AND ("x"[tiab] OR "a"[tiab] OR "b"[tiab]) AND 2020/01/01:2021/12/31[dp]'
    assert s.pubmed_by_category() == 'lee a[au] AND "x"[tiab] AND ("a"[tiab] OR "b"[tiab]) AND 2020/01/01:2021/12/31[dp]'
    assert s.europepmc() == 'AUTH:"lee a" AND "x" AND ("a" OR "b") AND FIRST_PDATE:[2020-01-01 TO 2021-12-31] AND OPEN_ACCESS:Y AND HAS_FT:Y'
    assert s.arxiv() == 'au:"lee a" AND (all:"x" OR all:"a" OR all:"b")'
    assert s.biorxiv() == {"max_results": None, "start_date": "2020-01-01", "end_date": "2021-12-31"}
    assert s.chemrxiv()["term"] == "x a b"
    assert search.europepmc_query(keywords=["k"], title=["t"], start="2020-01-01") == '("k") AND TITLE:"t" AND FIRST_PDATE:[2020-01-01 TO *]' and search.europepmc_query() == "*"
    assert search.chemrxiv_categories(["Organic Chemistry", "nope", "bio-chemistry"]) == [17]
    assert search.Search.from_dict(s.to_dict()) == s and len(s.config_hash()) == 16
    assert search.pubmed_since("q", "2024-01-02") == "(q) AND 2024/01/02:3000/12/31[dp]"
    for bad in (search.Search().pubmed, search.Search().arxiv, lambda: search.DateRange("2020-01-01", "2021/01/01"), lambda: search.Search.from_json("{")):
        with pytest.raises(search.SearchError):
            bad()


def test_predicate(spark):
    df = spark.createDataFrame([(1, "Ebola in X", None), (2, "a vaccine", "ebola"), (3, "none", "")], "i int, title string, abstract string")
    s = search.Search(virus_keywords=("EBOLA",), vaccine_keywords=("vaccine",))
    assert [[r.i for r in df.where(s.predicate(m)).orderBy("i").collect()] for m in ("any", "category")] == [[1, 2], [2]]
    assert df.where(search.in_dates(F.lit("2020-01-01").cast("date"), None, "2020-01-01")).count() == 3


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_cleaning_of_whole_tables(spark):
    """Against a plain version, text by text."""
    def cleaned(text):
        t = unicodedata.normalize("NFKC", text or "").replace("\u00a0", " ").replace("\u200b", "")
        return " ".join(t.split())

    def plain_ascii(text):
        t = "".join(LETTERS.get(c, c) for c in cleaned(text))
        t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
        return "".join(c for c in "".join(LETTERS.get(c, c) for c in t) if ord(c) < 128)

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for name, column, of in (("q_clean_nfkc", "cleaned", cleaned), ("q_transliterate", "ascii", plain_ascii)):
        found = {r.doc_id: r[column] for r in registry.QUERIES[name](spark, "/root/testdata/sf0.001").collect()}
        assert found == {i: sha(of(t)) for i, t in texts.items()}

"""Article XML: validation of JATS, metadata of TEI, TEI to JATS. Arrow UDFs, as Spark's XPath functions fail the job on
malformed documents. What is told of a JATS article is gathered in one pass of the parser, without a tree."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import _clean

JATS_NS, TEI_NS, XML_NS = "http://jats.nlm.nih.gov", "http://www.tei-c.org/ns/1.0", "http://www.w3.org/XML/1998/namespace"
BODY_MIN_CHARS = 800
# The validator's messages.
MISSING, SHORT, BROKEN = "Missing or empty <{}>", "Body too short: {} chars (minimum: {})", "XML parse error: {}"
VALIDATION = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("has_title", T.BooleanType()), T.StructField("has_abstract", T.BooleanType()), T.StructField("has_body", T.BooleanType()),
    T.StructField("body_chars", T.IntegerType()), T.StructField("errors", T.ArrayType(T.StringType())), T.StructField("pmcid", T.StringType()),
])
TEI_FIELDS = ("DOI", "PMID", "PMCID", "title", "journal", "year", "first_author")


def spaced_text(element: ET.Element) -> str:
    """All text in an element, its pieces joined by single spaces."""
    return " ".join(" ".join(element.itertext()).split())


#: Characters that the parser gets at once, and what stands for the place of an id of the exact type: no type can be it.
CHUNK, PLACE = 1 << 16, "\0"


class _Facts:
    """What a parser tells, event by event: words in titles, abstracts and bodies, and ids. Elements count by their name in
    no namespace or JATS's; ids in none."""

    def __init__(self) -> None:
        self.title = self.abstract = 0
        self.has_title = self.has_abstract = False
        #: Characters of bodies that are closed; words and their characters of those that are open.
        self.chars, self.bodies = 0, []
        self.ids: list[tuple[str, str]] = []
        #: Type of the id that is open, before its first child.
        self.kind: str | None = None
        self.pieces: list[str] = []

    def _piece(self) -> None:
        """The text between two tags is whole."""
        if self.pieces:
            text = "".join(self.pieces)
            self.pieces = []
            words = text.split() if self.title or self.abstract or self.bodies else ()
            self.has_title, self.has_abstract = self.has_title or bool(self.title and words), self.has_abstract or bool(self.abstract and words)
            for body in self.bodies:
                body[0] += len(words)
                body[1] += sum(map(len, words))
            if self.kind is not None:
                self.ids.append((self.kind, text))
        self.kind = None

    def start(self, tag: str, attributes: dict) -> None:
        self._piece()
        if tag == "article-id":
            self.kind = attributes.get("pub-id-type", "")
            if self.kind == "doi":
                self.ids.append((PLACE, ""))  # even if it stays empty
        name = tag.removeprefix(f"{{{JATS_NS}}}")
        self.title, self.abstract = self.title + (name == "article-title"), self.abstract + (name == "abstract")
        if name == "body":
            self.bodies.append([0, 0])

    def end(self, tag: str) -> None:
        self._piece()
        name = tag.removeprefix(f"{{{JATS_NS}}}")
        self.title, self.abstract = self.title - (name == "article-title"), self.abstract - (name == "abstract")
        if name == "body":
            words, chars = self.bodies.pop()
            self.chars += chars + max(0, words - 1)

    def data(self, text: str) -> None:
        if self.kind is not None or self.title or self.abstract or self.bodies:
            self.pieces.append(text)

    def close(self) -> _Facts:
        return self


def facts(xml: str | None, body_min_chars: int = BODY_MIN_CHARS) -> dict:
    """Status and what an article has, its PMCID and DOIs. It is valid with a title, an abstract or a body of that many
    characters. One pass, without a tree: beyond the text itself, memory doesn't grow with it."""
    parser, text = ET.XMLParser(target=_Facts()), xml or ""
    try:
        for i in range(0, len(text), CHUNK):
            parser.feed(text[i : i + CHUNK])
        f = parser.close()
    except (ET.ParseError, ValueError) as e:
        return {"status": "invalid", "has_title": False, "has_abstract": False, "has_body": False, "body_chars": 0, "errors": [BROKEN.format(e)], "pmcid": None, "doi": None, "exact_doi": None}
    body = f.chars >= body_min_chars
    errors = [MISSING.format(tag) for tag, there in (("article-title", f.has_title), ("abstract", f.has_abstract), ("body", body or f.chars)) if not there]
    if f.chars and not body:
        errors.append(SHORT.format(f.chars, body_min_chars))
    pmcid = next((t.strip() for k, t in f.ids if k.lower() == "pmcid"), None)
    doi = next((t.strip() for k, t in f.ids if k.lower() == "doi" and t.strip()), None)
    status = "valid" if f.has_title or f.has_abstract or body else "incomplete"
    return {"status": status, "has_title": f.has_title, "has_abstract": f.has_abstract, "has_body": body, "body_chars": f.chars, "errors": errors, "pmcid": pmcid, "doi": doi, "exact_doi": _exact(f.ids)}


def _exact(ids: list[tuple[str, str]]) -> str | None:
    """The first DOI of just that type: what follows its place, if anything does before the next one's."""
    at = next((i for i, (kind, _) in enumerate(ids) if kind == PLACE), None)
    if at is None or at + 1 == len(ids) or ids[at + 1][0] != "doi":
        return None
    return ids[at + 1][1].strip() or None


def validate(xml: str | None, body_min_chars: int = BODY_MIN_CHARS) -> dict:
    """:func:`facts` without DOIs."""
    found = facts(xml, body_min_chars)
    return {k: found[k] for k in VALIDATION.names}


#: Texts of a batch that are Python's strings at once, or whose results are.
SLICE = 64
_VALIDATION = pa.struct([
    ("status", pa.string()), ("has_title", pa.bool_()), ("has_abstract", pa.bool_()), ("has_body", pa.bool_()), ("body_chars", pa.int32()), ("errors", pa.list_(pa.string())), ("pmcid", pa.string()),
])


def _each(x: pa.Array, told: Callable[[str | None], Any], kind: pa.DataType) -> pa.Array:
    """What is told of each text. A text is a string of Python's only while it is looked at: a batch has thousands."""
    slices = [pa.array([told(t.as_py()) for t in x[i : i + SLICE]], kind) for i in range(0, len(x), SLICE)]
    return pa.concat_arrays(slices) if slices else pa.array([], kind)


def jats_validator(body_min_chars: int = BODY_MIN_CHARS):
    """A UDF from XML to a struct as in VALIDATION."""

    @F.arrow_udf(VALIDATION)
    def udf(x: pa.Array) -> pa.Array:
        return _each(x, lambda t: validate(t, body_min_chars), _VALIDATION)

    return udf


validate_jats = jats_validator()
FACTS = T.StructType([*VALIDATION.fields, T.StructField("doi", T.StringType())])


@F.arrow_udf(FACTS)
def jats_facts(x: pa.Array) -> pa.Array:
    """A struct as in FACTS: what the validator finds, with the DOI, of one parse."""
    return _each(x, facts, pa.struct([*_VALIDATION, ("doi", pa.string())]))


def article_doi(xml: str | None, exact: bool = False) -> str | None:
    """An article's DOI. ``exact``: that of the first element of just that type, even if it is empty."""
    return facts(xml)["exact_doi" if exact else "doi"]


@F.arrow_udf(T.StringType())
def jats_doi(x: pa.Array) -> pa.Array:
    return _each(x, article_doi, pa.string())


@F.arrow_udf(T.StringType())
def jats_dedup_doi(x: pa.Array) -> pa.Array:
    return _each(x, lambda t: article_doi(t, exact=True), pa.string())


def _t(tag: str) -> str:
    return f"{{{TEI_NS}}}{tag}"


def _path(tops: list[ET.Element], *steps: str) -> list[ET.Element]:
    for step in steps:
        tops = [c for t in tops for c in t if c.tag == _t(step)]
    return tops


def tei_metadata(xml: str | None, legacy: bool = False) -> dict[str, str]:
    """DOI, PMID, PMCID, title, journal, year and first author of a TEI header; what is empty is left out. ``legacy``
    looks for author, date and journal in more places."""
    try:
        root = ET.fromstring(xml or "")
    except (ET.ParseError, ValueError):
        return {}
    headers = list(root.iter(_t("teiHeader")))
    deep = lambda tag: [e for h in headers for e in h.iter(_t(tag))]
    own = lambda found: [t for e in found for t in [e.text, *(c.tail for c in e)] if t]
    first = lambda *lists: next((v for x in lists if x and (v := _clean(x[0], False))), "")
    idno = lambda kind: own([e for e in deep("idno") if e.get("type") == kind])
    bibl = deep("biblStruct")
    main = lambda part: own([e for e in _path(bibl, part, "title") if e.get("type") in (None, "main")])
    dates = _path(bibl, "monogr", "imprint", "date")
    author = lambda part: own([s for p in _path(bibl, part) for s in _path(_path([p], "author")[:1], "persName", "surname")])
    when = first([e.get("when") for e in dates if e.get("when")], own(dates), *([[e.get("when") for e in deep("date") if e.get("when")], own(deep("date"))] if legacy else []))
    year = re.search(r"(19|20|21)\d{2}", when)
    surnames = own(deep("surname"))
    found = {
        "DOI": first(idno("DOI"), [e.get("target") for e in deep("ptr") if e.get("type") == "DOI" and e.get("target")]),
        "PMID": first(idno("PMID")),
        "PMCID": first(idno("PMCID"), idno("PMC")),
        "title": first(main("analytic"), main("monogr"), own([t for s in deep("titleStmt") for t in _path([s], "title")])),
        "journal": first(own([e for e in _path(bibl, "monogr", "title") if e.get("level") == "j"]), *([own(_path(bibl, "series", "title"))] if legacy else [])),
        "year": year[0] if year else "",
        "first_author": first(author("analytic"), author("monogr"), surnames[:1], *([own(deep("name"))] if legacy else [])),
    }
    return {k: v for k, v in found.items() if v}


@F.arrow_udf(T.MapType(T.StringType(), T.StringType()))
def tei_fields(x: pa.Array) -> pa.Array:
    return _each(x, lambda t: list(tei_metadata(t).items()), pa.map_(pa.string(), pa.string()))


def tei_to_jats(xml: str | None) -> str | None:
    """An article in the JATS namespace: title, authors, abstract and body of a TEI document; the back is empty. Divisions
    become sections, heads titles, italic and bold highlights the like, line beginnings breaks; other elements of the
    text leave their content. Null if it can't be parsed."""
    try:
        root = ET.fromstring(xml or "")
    except (ET.ParseError, ValueError):
        return None
    new = lambda parent, tag, **a: ET.SubElement(parent, f"{{{JATS_NS}}}{tag}", {k.replace("_", "-"): v for k, v in a.items()})
    ET.register_namespace("", JATS_NS)
    article = ET.Element(f"{{{JATS_NS}}}article")
    meta = new(new(article, "front"), "article-meta")
    titles = [e for h in root.iter(_t("teiHeader")) for s in h.iter(_t("titleStmt")) for e in _path([s], "title")]
    new(new(meta, "title-group"), "article-title").text = spaced_text(titles[0]) if titles else ""
    people = [p for b in root.iter(_t("biblStruct")) for a in _path([b], "analytic", "author") for p in _path([a], "persName")]
    if people:
        group = new(meta, "contrib-group")
        for p in people:
            name = new(new(group, "contrib", contrib_type="author"), "name")
            for tag, source in (("surname", "surname"), ("given-names", "forename")):
                if text := " ".join(spaced_text(e) for e in _path([p], source)):
                    new(name, tag).text = text

    def put(parent: ET.Element, text: str | None) -> None:
        if text:
            if len(parent):
                parent[-1].tail = (parent[-1].tail or "") + text
            else:
                parent.text = (parent.text or "") + text

    def copy(source: ET.Element, parent: ET.Element, blocks: bool) -> None:
        if not blocks:
            put(parent, source.text)
        for child in source:
            tag = child.tag.rpartition("}")[2] if isinstance(child.tag, str) else ""
            if tag == "div":
                copy(child, new(parent, "sec"), True)
            elif tag == "head":
                copy(child, new(parent, "title"), False)
            elif tag == "p":
                copy(child, new(parent, "p"), False)
            elif tag == "hi" and child.get("rend") in ("italic", "bold"):
                copy(child, new(parent, child.get("rend")), False)
            elif tag == "lb":
                new(parent, "break")
            elif tag:
                copy(child, parent, False)
            if not blocks:
                put(parent, child.tail)

    for e in (e for h in root.iter(_t("teiHeader")) for e in h.iter(_t("abstract"))):
        copy(e, new(meta, "abstract"), not (e.text or "").strip())
        break
    body = new(article, "body")
    for e in (b for t in root.iter(_t("text")) for b in _path([t], "body")):
        copy(e, body, True)
        break
    new(article, "back")
    return ET.tostring(article, encoding="unicode")


@F.arrow_udf(T.StringType())
def jats_of_tei(x: pa.Array) -> pa.Array:
    return _each(x, tei_to_jats, pa.string())

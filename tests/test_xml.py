"""One pass of the parser against the tree, on random documents."""

import random
import xml.etree.ElementTree as ET

import pytest

from corpusloom.functions import xml

NS = xml.JATS_NS


def by_tree(text, least):
    """The same of a tree."""
    try:
        root = ET.fromstring(text or "")
    except (ET.ParseError, ValueError) as e:
        return "invalid", False, False, 0, None, None, None, xml.BROKEN.format(e)
    both = lambda tag: [*root.iter(tag), *root.iter(f"{{{NS}}}{tag}")]
    title, abstract = (any(xml.spaced_text(e) for e in both(tag)) for tag in ("article-title", "abstract"))
    chars = sum(len(xml.spaced_text(b)) for b in both("body"))
    ids = list(root.iter("article-id"))
    of = lambda kind, need: next((e.text.strip() for e in ids if e.get("pub-id-type", "").lower() == kind and need(e.text)), None)
    exact = next(((e.text or "").strip() or None for e in ids if e.get("pub-id-type") == "doi"), None)
    status = "valid" if title or abstract or chars >= least else "incomplete"
    return status, title, abstract, chars, of("pmcid", bool), of("doi", lambda t: t and t.strip()), exact, None


def piece(rng, depth=0):
    kind = rng.random()
    if depth > 4 or kind < 0.4:
        return rng.choice(["word", " two words ", "\n", "", "é&amp;x", "a<!-- c -->b", "<?pi x?>", "<![CDATA[<b>]]>", "&#160;"])
    tag = rng.choice(["p", "body", "article-title", "abstract", "article-id", "italic", "sec", "other"])
    attribute = rng.choice(["", ' pub-id-type="doi"', ' pub-id-type="DOI"', ' pub-id-type="pmcid"', ' pub-id-type=""', f' xmlns="{NS}"', ' xmlns="x"'])
    inside = "".join(piece(rng, depth + 1) for _ in range(rng.randint(0, 4)))
    end = f"</{tag}>" if rng.random() > 0.003 else ""
    return f"<{tag}{attribute}>{inside}{end}" if inside or rng.random() < 0.5 else f"<{tag}{attribute}/>"


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_one_pass_tells_what_the_tree_tells(monkeypatch, chunk):
    monkeypatch.setattr(xml, "CHUNK", chunk)
    rng, seen = random.Random(chunk), set()
    for _ in range(1500):
        text = f"<article>{''.join(piece(rng) for _ in range(6))}</article>"
        f = xml.facts(text, 12)
        expected = by_tree(text, 12)
        assert (f["status"], f["has_title"], f["has_abstract"], f["body_chars"], f["pmcid"], f["doi"], f["exact_doi"], f["errors"][0] if f["status"] == "invalid" else None) == expected
        seen.add(f["status"])
    assert seen == {"valid", "incomplete", "invalid"}


@pytest.mark.parametrize("text", [None, "", " ", "<a", "<a>&undefined;</a>", "<!DOCTYPE a SYSTEM 'x'><a>&undefined;</a>", "<a>\ud800</a>", "<a/><b/>", "<?xml version='1.0' encoding='latin-1'?><a>é</a>"])
def test_broken_documents(text):
    f = xml.facts(text)
    assert (f["status"] == "invalid", f["doi"]) == (by_tree(text, 800)[0] == "invalid", None)


def test_texts_of_a_batch_are_strings_one_at_a_time():
    """A batch's texts stay Arrow's: what Python allocates beside them doesn't grow with their sum."""
    import tracemalloc

    import pyarrow as pa

    texts = pa.array([f"<article><body>{i} {'x ' * 5000}</body></article>" for i in range(2000)] + [None])
    for f, told in ((xml.jats_facts, "body_chars"), (xml.validate_jats, "status"), (xml.jats_doi, None), (xml.jats_of_tei, None)):
        tracemalloc.start()
        try:
            found = f.func(texts)
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert isinstance(found, pa.Array) and len(found) == len(texts) and peak < 3_000_000  # the texts are 20 MB
        if told == "status":
            assert found.field("status").to_pylist() == ["valid"] * 2000 + ["invalid"]

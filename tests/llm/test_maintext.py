"""Main text of pages: planted layouts, broken markup, and every page of the smallest table."""

import html
import os
import re
import time

import pytest

from corpusloom.llm import maintext
from corpusloom.llm.queries import op13_main_text

DATA = "/root/testdata/sf0.001"
LONG = [f"Paragraph number {i} tells, at some length, what happened there; it has commas, and it ends with a point." for i in range(6)]
MENU = "<ul><li><a href=/a>Home</a><li><a href=/b>World news</a><li><a href=/c>Sport</a></ul>"
COMMENT = "I do not agree with any of this, and I have said so before, as everybody knows who reads these columns daily."


def paragraphs(texts=LONG, tag="p"):
    return "".join(f"<{tag}>{t}</{tag}>\n" for t in texts)


WANT = "A Title " + " ".join(LONG)
LAYOUTS = {
    "article": f"<html><head><title>T</title><style>p{{a:b}}</style></head><body><nav>{MENU}</nav><div class='ad'>Buy this now, it is cheap.</div>"
    f"<article><h1>A Title</h1>{paragraphs()}</article><aside>Other things, at length, beside.</aside><footer>&copy; 2020</footer></body></html>",
    "names": f"<body><div id='siteHeader'><h1>My Site</h1>Where we write, a lot.</div><div class='main-nav'>{MENU}</div><div class='post-content'><h1>A Title</h1>{paragraphs()}"
    f"<div class='share-buttons'>Share this, please.</div></div><div id='comments'><p>{COMMENT}</p><p>{COMMENT}</p></div><div class=site-footer>All rights, reserved.</div>",
    "bare": f"<body>{MENU}<div><h1>A Title</h1>{paragraphs()}</div><div><ul><li><a href=/x>About</a></li><li><a href=/y>Contact us, now</a></li></ul></div>",
    "table": f"<table><tr><td>{MENU}<td><h1>A Title</h1>{paragraphs()}</td></tr></table>",
    "main": f"<header><a href=/>Logo</a> A slogan.</header><main><article><header><h1>A Title</h1></header>{paragraphs()}<form><label>Your mail, please</label><input><button>Send</button></form>"
    f"</article><article class='comment'><p>{COMMENT}</p></article></main><div role='contentinfo'>Imprint, terms, privacy.</div>",
    "form around": f"<form id=aspnetForm><div class=navigation>{MENU}</div><article><h1>A Title</h1>{paragraphs()}</article></form>",
    "hidden": f"<article><h1>A Title</h1><p style='display: none'>Not seen, ever.</p><div hidden>Nor this, either.</div>{paragraphs()}<noscript>Turn on, please.</noscript></article>",
    "notice": f"<div class='cookie-notice'><p>We use cookies, as all do, to make money; click here, or there, to agree.</p></div><article><h1>A Title</h1>{paragraphs()}<div class='newsletter'>Read more, by mail.</div></article>",
    "sections": f"<div class='sidebar'><h3>Latest</h3><p>{COMMENT}</p></div><div id='content' class='article has-sidebar'><h1>A Title</h1><section>{paragraphs(LONG[:3])}</section><section>{paragraphs(LONG[3:])}</section></div>",
    "modifiers": f"<div class='menu-top'>{MENU}</div><article class='story has-comments no-sidebar'><h2>A Title</h2>{paragraphs()}</article><div class='reader_comments'><p>{COMMENT}</p></div>",
    "long comments": f"<article><h1>A Title</h1>{paragraphs()}</article><section><h2>What readers say</h2>{paragraphs([COMMENT] * 12)}</section>",
    "unclosed": "<body><article><h1>A Title</h1><p>" + "<p>".join(LONG) + "</article><footer>The end, at last.",
    "attributes": f"<article data-x='a>b' title=\"x < y\"><h1>A Title</h1><!-- <p>old, text</p> -->{paragraphs()}<script>if (a < b) document.write('</p><p>no</p>')</script></article>",
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_layouts(name):
    assert maintext.main_text(LAYOUTS[name]) == WANT


def test_blocks_and_references():
    page = "<article><p>a&nbsp;&amp;\n\t<b>b</b>c<i> d</i>  &#x27;e&#39; &eacute;&am &lt;p&gt;<br>f<p> g<ul><li>h<li>i</ul><pre> j\n k </pre><table><tr><td>l<td>m<tr><td>n</table><p></p>1 < 2 <3></article>"
    assert maintext.main_text(page) == "a & bc d 'e' é&am <p> f g h i j k l m n 1 < 2 <3>"


def test_short_blocks_of_the_article_stay():
    page = f"<body><div><a href=/>Top</a></div><div><h1>T</h1>{paragraphs()}<p>Of.</p><h2>Part</h2><blockquote>Said.</blockquote>{paragraphs()}<p>So.</p></div>"
    both = " ".join(LONG)
    assert maintext.main_text(page) == f"T {both} Of. Part Said. {both} So."


def test_broken_and_empty():
    for page in (None, "", "   ", "<", "<p", "<!--", "<script>", "</p>", "<a href='x", "<title>x", "&", "<html><head></head></html>"):
        assert maintext.main_text(page) in ("", "<", "&")
    assert maintext.main_text("plain text, no markup") == "plain text, no markup"
    assert maintext.main_text("<p>unclosed <b>bold <a href='q>quote") == "unclosed bold quote"  # a quote that never ends ends with its tag


@pytest.mark.parametrize("piece", ["<div>", "<div>a, b", "<div><h1>a", "<p>", "<b>", "<b><div></b>", "<p><table><tr><td><div>a", "</td><td><div></div></p>", "<ul><li>a", "<!--", "<a href=\"", "</p>", "<li>", "<table><tr><td>", "<script>", "x < y ", "<p>ab, c.</p>"])
def test_time_grows_with_the_page(piece):
    began = time.time()
    maintext.main_text(piece * 10_000)
    assert time.time() - began < 5


def test_table(spark):
    rows = [(1, "u", LAYOUTS["article"], 1), (1, None, LAYOUTS["article"], 2), (None, "v", None, 3), (4, "w", "", 4), (5, "x", f"<article><p>{'wort, ' * 200_000}</p></article>", 5)]
    given = spark.createDataFrame(rows, "page_id long, url string, html string, text int").repartition(3)
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in maintext.extract(given).collect()}
    assert found == {(1, "u"): (WANT, len(WANT)), (1, None): (WANT, len(WANT)), (None, "v"): ("", 0), (4, "w"): ("", 0), (5, "x"): (("wort, " * 200_000).strip(), 1_199_999)}
    assert maintext.extract(given.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_query_against_the_marked_article(spark):
    """These pages mark their article; its text by pattern, without the parser."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    found = op13_main_text(spark, DATA).collect()
    assert len(found) == len(pages)
    for r in found:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        spaced = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))
        assert r.text == " ".join(html.unescape(spaced).split())
        assert r.n_chars == len(r.text)

"""Main text of HTML pages, by ratios of text length and punctuation to tag paths."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.scratch import bound_batches, lean

# Elements of HTML by what they do to the text around them.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: Elements that hold no article text, whatever they are called.
NEVER = frozenset("aside audio button canvas datalist dialog footer form head map menu nav noscript object option select svg template video".split()) | RAW
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open paragraph, and what an open element of a kind ends at.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
REPLACES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
}
TABLE = frozenset("caption table tbody td tfoot th thead tr".split())
SCOPES = frozenset("button caption object td template th".split())
#: Names (of classes, ids and roles) of what surrounds articles, and of parts that name the article itself.
AROUND = frozenset(
    "ad ads adsense advert advertisement advertisements advertising adverts alert banner breadcrumb breadcrumbs comment commentary commentlist comments complementary consent contentinfo "
    "cookie cookies copyright disclaimer discussion disqus footer gdpr login menu menubar modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination "
    "popup promo promoted promotion recommended related replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola teaser toolbar topbar widget".split()
)
HEADER = frozenset("header masthead".split())
OWN = frozenset("article body content entry main post story text".split())
#: What ends or divides a sentence.
POINTS = re.compile("[,.;:!?…、。，；：！？]")

_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|</(?![a-zA-Z])[^>]*>?"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?|["'])*+)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_NAMED = re.compile(r"\b(?:class|id|role|hidden|style|aria-hidden)\b", re.I)
#: A name that tells what an element has beside or in it, not what it is.
_MODIFIER = re.compile(r"(?:^|(?<=\s))(?:has|is|js|no|show|supports|with|without)[-_]\S*")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_END_OF = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
#: Weights of the two neighbours on each side and of the node itself: a Gaussian of standard deviation 1.
SMOOTH = np.exp(-0.5 * np.arange(-2, 3) ** 2)
#: A path is content from this many standard deviations of the nodes' scores on.
THRESHOLD = 0.5
#: Share of the content from which the only marked article of a page is taken for it: unmarked comments may be longer.
ONLY = 0.2


class Element:
    """A block element: where it is, what it holds, and the inline elements open in it."""

    def __init__(self, tag: str, parent: Element | None, path: int, names: frozenset[str] = frozenset(), hidden: bool = False):
        self.tag, self.parent, self.path, self.names, self.hidden = tag, parent, path, names, hidden
        self.inline: list[tuple[str, bool]] = []
        self.holds: set[str] = set()
        #: Tags of articles that it is in, and whether it is in (or is) something dropped or the article's region.
        self.within: frozenset[str] = parent.within | {parent.tag} & {"article", "main"} if parent else frozenset()
        self.dropped = self.inside = False
        self.mass = 0.0


class Leaf:
    """A block's run of text."""

    def __init__(self, element: Element):
        self.element, self.text, self.linked = element, "", 0
        self.pieces: list[tuple[str, bool]] = []

    def close(self) -> bool:
        self.text = " ".join("".join(t for t, _ in self.pieces).split())
        self.linked = sum(len(" ".join(t.split())) for t, linked in self.pieces if linked)
        return bool(self.text)


def attributes(given: str) -> tuple[frozenset[str], bool]:
    """The words of an element's class, id and role, and whether it is hidden."""
    if not _NAMED.search(given):
        return frozenset(), False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(given)}
    names = _MODIFIER.sub(" ", " ".join(found.get(k, "") for k in ("class", "id", "role")))
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    return frozenset(w.lower() for w in _WORDS.findall(names)), hidden


def parsed(page: str) -> tuple[list[Leaf], list[Element]]:
    """Runs of text of all blocks in page order, and all block elements, parents first. Unclosed and misnested elements
    end where HTML ends them; inline elements don't cut a run, ``br`` is white space in it. Linear in the page."""
    paths: dict[tuple[int, str], int] = {}
    number = lambda parent, tag: paths.setdefault((parent, tag), len(paths))
    stack, out, at = [Element("html", None, number(-1, "html"))], [], 0
    elements = stack[:]
    # How often each tag is open: altogether, and since the innermost cell (or what else an end tag doesn't reach out of).
    opened: Counter[str] = Counter()
    scopes: list[Counter[str]] = [Counter()]
    leaf = Leaf(stack[0])

    def text(piece: str) -> None:
        inline = stack[-1].inline
        if piece and not any(dropped for _, dropped in inline):
            leaf.pieces.append((html.unescape(piece), any(tag == "a" for tag, _ in inline)))

    def turn() -> None:
        """The current run ends; the next belongs to the innermost element."""
        nonlocal leaf
        if leaf.close():
            out.append(leaf)
        leaf = Leaf(stack[-1])

    def pop(tags: set[str]) -> None:
        """Closes elements up to the innermost of ``tags``, one of which is open."""
        while len(stack) > 1:
            tag = stack.pop().tag
            opened[tag] -= 1
            if tag in SCOPES:
                scopes.pop()
            scopes[-1][tag] -= 1
            if tag in tags:
                return

    def push(tag: str, given: str) -> None:
        parent = stack[-1]
        element = Element(tag, parent, number(parent.path, tag), *attributes(given))
        if tag in ("article", "h1", "main"):
            for e in reversed(stack):
                if tag in e.holds:
                    break
                e.holds.add(tag)
        stack.append(element)
        elements.append(element)
        opened[tag] += 1
        scopes[-1][tag] += 1
        if tag in SCOPES:
            scopes.append(Counter())

    while m := _TOKEN.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, ends = m[2].lower(), bool(m[1])
        if tag in ("html", "body"):
            if not ends and opened["head"]:
                pop({"head"})
                turn()
        elif tag in INLINE:
            inline = stack[-1].inline
            if not ends:
                names, hidden = attributes(m[3])
                inline.append((tag, hidden or bool(names & AROUND)))
            elif any(t == tag for t, _ in inline):
                while inline.pop()[0] != tag:
                    pass
        elif tag in VOID:
            text(" ")
            if tag == "hr":
                turn()
        elif ends:
            if scopes[-1][tag] or tag in TABLE | SCOPES and opened[tag]:
                pop({tag})
            turn()
        elif tag in RAW:
            text(" " if tag in ("iframe", "textarea") else "")
            end = _END_OF[tag].search(page, at)
            at = end.start() if end else len(page)
        else:
            if tag in ENDS_P and scopes[-1]["p"]:
                pop({"p"})
            if tag in REPLACES:
                tags, stop = REPLACES[tag]
                for e in reversed(stack):
                    if e.tag in tags:
                        pop(tags)
                        break
                    if e.tag in stop or not any(opened[t] for t in tags):
                        break
            if opened["head"] and tag not in ("noscript", "template"):
                pop({"head"})
            push(tag, m[3])
            turn()
    text(page[at:])
    turn()
    return out, elements


def boilerplate(e: Element) -> bool:
    """Whether an element by itself tells that it is not of the article."""
    if e.hidden:
        return True
    if e.tag in NEVER:  # a form around the page is no form to fill in
        return not (e.tag == "form" and e.holds & {"article", "main", "h1"})
    if e.tag == "main" or e.tag == "body":
        return False
    if e.tag == "header" or e.names & HEADER and not e.names & OWN:
        return not e.within and not e.holds & {"article", "main"}
    return bool(e.names & AROUND) and not e.holds & {"main", "h1"}


def scores(found: list[Leaf]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each leaf's tag path, and whether each path is content.

    A path's ratios are plain (not linked) characters and points for each of its leaves. Every leaf takes its path's
    ratios; both sequences are smoothed in page order, related to their means and fused by their geometric mean. Paths
    whose leaves score on average less than ``THRESHOLD`` standard deviations are not content."""
    of = np.unique([x.element.path for x in found], return_inverse=True)[1]
    n = np.bincount(of)
    plain = np.array([max(0, len(x.text) - x.linked) for x in found], float)
    points = np.array([len(POINTS.findall(x.text)) if p else 0 for x, p in zip(found, plain, strict=True)], float)
    weight = np.convolve(np.ones(len(found)), SMOOTH)[2:-2]
    ratios = [np.convolve((np.bincount(of, v) / n)[of], SMOOTH)[2:-2] / weight for v in (plain, points + (plain > 0))]
    fused = np.sqrt(np.prod([r / r.mean() if r.any() else r for r in ratios], axis=0))
    score = np.bincount(of, fused) / n
    return of, (score >= THRESHOLD * fused.std()) & (np.bincount(of, plain) > 0)


def region(found: list[Leaf], elements: list[Element], mass: np.ndarray) -> tuple[Element, bool]:
    """The element that holds the article, and whether its tag says so: the outermost ``article``, or else ``main``,
    that has more than half of the content, or as the only one on the page more than ``ONLY`` of it; otherwise the
    innermost element that holds nine tenths of it."""
    for x, m in zip(found, mass.tolist(), strict=True):
        x.element.mass += m
    for e in reversed(elements):
        if e.parent:
            e.parent.mass += e.mass
    total = elements[0].mass
    for tag in ("article", "main"):
        outer = [e for e in elements if e.tag == tag and tag not in e.within and not e.dropped]
        large = [e for e in outer if e.mass > total * (ONLY if len(outer) == 1 else 0.5)]
        if large:
            return large[0], True
    best = elements[0]
    for e in elements:
        if e.parent is best and e.mass >= 0.9 * total and e.tag not in ("p", "li"):
            best = e
    return best, False


def main_text(page: str | None) -> str:
    """The article's blocks, each with its white space as one blank, joined by one blank."""
    found, elements = parsed(page or "")
    for e in elements:
        e.dropped = bool(e.parent and e.parent.dropped) or boilerplate(e)
    found = [x for x in found if not x.element.dropped]
    if not found:
        return ""
    of, content = scores(found)
    chosen = content[of]
    mass = np.where(chosen, [len(x.text) for x in found], 0)
    if not mass.sum():
        return ""
    root, told = region(found, elements, mass)
    for e in elements:
        e.inside = e is root or bool(e.parent and e.parent.inside)
    inside = np.array([x.element.inside for x in found])
    if told:
        return " ".join(x.text for x, i in zip(found, inside.tolist(), strict=True) if i)
    span = np.flatnonzero(chosen & inside)
    between = np.zeros(len(found), bool)
    between[span[0] : span[-1] + 1] = True
    titles = [i for i, x in enumerate(found) if x.element.tag == "h1"]
    if len(titles) == 1 and titles[0] < span[0]:
        between[titles[0]] = inside[titles[0]] = True
    while span[0] > 0 and found[span[0] - 1].element.tag in HEADINGS and inside[span[0] - 1]:
        span[0] -= 1
        between[span[0]] = True
    plain = np.array([2 * x.linked < len(x.text) for x in found])
    return " ".join(x.text for x, i in zip(found, (inside & (chosen | between & plain)).tolist(), strict=True) if i)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, html`` to ``page_id, url, text, n_chars``: the main text of each page, read whole; other columns
    are ignored.

    Elements that say by tag, name or role that they are no article go first (menus, page headers, footers, sidebars,
    notices, adverts, forms, reader comments, what is hidden). Of what is left the tag paths are scored by
    :func:`scores`, and the text is taken from the element that holds the content paths' text: all of it where that is
    the page's ``article`` or ``main``, else its content paths and what of other paths stands between them and isn't
    mostly links. Character references are decoded; white space is what ``str.split`` takes for it.

    A page's paths concern no other page, so pages are worked on where they are read, without a shuffle; memory is
    bounded by Arrow's batches and the longest page. Null and empty pages, and pages without text, give an empty text;
    null ids and urls stay; repeated rows each give theirs; an empty table gives no rows.
    """
    bound_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(x.as_py()) for x in batch["html"]]
            n = pa.array([len(t) for t in text], pa.int64())
            yield pa.record_batch({"page_id": batch["page_id"], "url": batch["url"], "text": pa.array(text, pa.string()), "n_chars": n})

    kinds = ", ".join(f"{k} {pages.schema[k].dataType.simpleString()}" for k in ("page_id", "url"))
    return pages.select("page_id", "url", "html").mapInArrow(lean(run), f"{kinds}, text string, n_chars bigint")

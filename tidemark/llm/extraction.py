"""Main text of web pages by tag-path ratios.

Every piece of text has a path of tags (with their classes) from the root. For
each path the text length and the punctuation are averaged over its pieces, the
two ratios are fused, smoothed along the page, and compared with the page's
length-weighted mean: pieces on paths above ``CUT`` of it are content.

What a page says of its elements counts beside that. Menus, page footers, hidden
elements and the like, told by tag or role, are left out. A class or id made of
such words alone (``cookie-notice``), or a form, leaves its element out unless
it is a frame: with a title or article in it, or all of the content. A name that
only has such a word in it (``related-work``) leaves its element out if the paths
agree, which they do where its text is no content or mostly links. So does a
list or block without a name if it is made of links. Names that say what else a
page has (``has-sidebar``) say nothing of their element.

The outermost article or main element around all content is the article; without
one it is the deepest element around all content, or the highest above it with
headings or paragraphs of its own, since short ones may be below the cut. All
other text of the article is kept, whatever its length.

Pages are parsed in one pass, in page order, one page at a time; unclosed and
misnested tags are closed as browsers close them.

Defined results: a null or empty html, or one without content, gives an empty
text. Repeated rows are extracted alike. Nothing is dropped from an article for
its length.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

CUT = 0.3
#: Weights of a piece's neighbours, by distance, when its ratio is smoothed.
SMOOTHING = (0.5, 0.2, 0.05)

# Fixed values of HTML: which tags have no content, raw content, lines of their own.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
CLOSED_BY = {
    "p": BLOCK, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}), "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}), "option": frozenset({"option", "optgroup"}),
    "head": frozenset({"body"}),
}
#: An open tag of these is closed no further up than this.
SCOPES = {"li": frozenset({"ul", "ol", "menu"}), "tr": frozenset({"table"}), "td": frozenset({"table"}), "th": frozenset({"table"}), "dt": frozenset({"dl"}), "dd": frozenset({"dl"})}

BOILERPLATE_TAGS = frozenset("head nav aside footer button select dialog menu template noscript object svg canvas audio video datalist".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice notices popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments "
    "disqus respond reply replies widget toolbar topbar pagination pager".split()
)
#: Words that may stand beside those in a name that means nothing else.
NEUTRAL = frozenset(
    "site page main top bottom left right upper lower side header primary secondary global inner outer box block area section "
    "container content wrapper wrap list item items row col column bar panel links link buttons button form field group "
    "widget thread user post posts article entry blog the and by for in of to fixed sticky floating text body title".split()
)
#: Words before what else the page has.
MODIFIERS = frozenset("has with without no is not hide show".split())
#: Blocks that are menus if they are made of links.
MENUS = frozenset("ul ol menu dl div section table p".split())
LINK_SHARE = 0.7
FRAME_SHARE = 0.5
#: What is never an article on its own, and what makes the element around it one.
PARTS = frozenset("p li td th pre blockquote h1 h2 h3 h4 h5 h6 ul ol dl dt dd menu table caption thead tbody tfoot tr".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 hgroup header".split())
#: Whose class says what else the page has, not what they are.
FRAMES = frozenset("html body main article".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")
_NAME_PART = re.compile(r"[a-z]+")


class Element:
    """An open or closed element: its parent, path, and what its tag and names say of it.

    ``left_out`` is settled by a tag, for all below as well. ``suspect`` is
    "named" if its name means boilerplate or it is a form, "hinted" if its name
    has such a word in it, and else empty.
    """

    __slots__ = ("parent", "tag", "path", "depth", "link", "left_out", "suspect", "in_article", "mass", "text", "links", "n_links", "framed")

    def __init__(self, parent: Element | None, tag: str, attributes: dict[str, str]) -> None:
        self.parent, self.tag, self.mass = parent, tag, 0.0
        self.depth = parent.depth + 1 if parent else 0
        self.link = self if tag == "a" else parent.link if parent else None
        self.text = self.links = self.n_links = 0
        self.framed = False
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
        self.path = (parent.path if parent else "") + f"/{tag}" + "".join(f".{n}" for n in sorted(names.split()))
        self.in_article = tag in ("article", "main") or bool(parent and parent.in_article)
        within = bool(parent and parent.in_article)
        self.left_out = bool(parent and parent.left_out) or _is_boilerplate(tag, attributes, within)
        self.suspect = "" if tag in FRAMES else "named" if tag == "form" else _suspicion(names, within)


def _is_boilerplate(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in FRAMES:
        return False
    if tag in BOILERPLATE_TAGS or tag == "header" and not in_article:
        return True
    if attributes.get("role", "").lower() in BOILERPLATE_ROLES or "hidden" in attributes:
        return True
    return bool(re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I))


def _suspicion(names: str, in_article: bool) -> str:
    """What the class and id words of an element make of it."""
    found = ""
    for name in names.split():
        parts = _NAME_PART.findall(name)
        known = [p in BOILERPLATE_WORDS or p == "header" and not in_article for p in parts]
        if any(known) and not MODIFIERS.intersection(parts):
            if all(k or p in NEUTRAL for k, p in zip(known, parts)):
                return "named"
            found = "hinted"
    return found


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(rest)}


def pieces(html: str) -> list[tuple[Element, str, int]]:
    """Element, raw text and block number of every piece of text, in page order."""
    root = Element(None, "", {})
    open_, found, block, at = [root], [], 0, 0

    def text(end: int) -> None:
        if end > at:
            found.append((open_[-1], unescape(html[at:end]), block))

    for token in iter(lambda: _TOKEN.search(html, at), None):
        text(token.start())
        at = token.end()
        tag = token["tag"] or token["tag2"]
        if tag is None:
            if token[0].startswith("<![CDATA["):
                found.append((open_[-1], token[0][9:].removesuffix("]]>"), block))
            continue
        tag, closing, rest = tag.lower(), token["end"] or token["end2"], token["rest"] or token["rest2"] or ""
        if tag in BLOCK:
            block += 1
        if closing:
            depth = next((i for i in range(len(open_) - 1, 0, -1) if open_[i].tag == tag), 0)
            if depth:
                if any(e.tag in BLOCK for e in open_[depth:]):
                    block += 1
                del open_[depth:]
            continue
        if tag == "br":
            found.append((open_[-1], " ", block))
        if tag in VOID:
            continue
        _close_implied(open_, tag)
        element = Element(open_[-1], tag, _attributes(rest))
        if tag in RAW:  # its content is no markup, and none of the page's text
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            at = end.start() if end else len(html)
            close = html.find(">", at)
            at = close + 1 if end and close >= 0 else len(html)
        else:
            open_.append(element)
    text(len(html))
    return found


def _close_implied(open_: list[Element], tag: str) -> None:
    """Close what the start of ``tag`` ends: an open paragraph, list item or cell."""
    for i in range(len(open_) - 1, 0, -1):
        own = open_[i].tag
        if tag in CLOSED_BY.get(own, ()):
            del open_[i:]
            return
        if own in BLOCK and own not in CLOSED_BY or own in SCOPES.get(tag, ()):
            return


def path_ratios(nodes: list[tuple[Element, str]]) -> list[float]:
    """The fused and smoothed ratio of each piece's path."""
    sums: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
    for element, text in nodes:
        own = sums[element.path]
        own[0] += 1
        own[1] += len(text)
        own[2] += len(_PUNCTUATION.findall(text))
    fused = [sums[e.path][1] / sums[e.path][0] * (1 + sums[e.path][2] / sums[e.path][0]) for e, _ in nodes]
    out = []
    for i in range(len(fused)):
        total = weight = 0.0
        for away in range(-len(SMOOTHING) + 1, len(SMOOTHING)):
            if 0 <= i + away < len(fused):
                total += SMOOTHING[abs(away)] * fused[i + away]
                weight += SMOOTHING[abs(away)]
        out.append(total / weight)
    means: dict[str, list[float]] = defaultdict(list)
    for (element, _), ratio in zip(nodes, out):
        means[element.path].append(ratio)
    return [sum(means[e.path]) / len(means[e.path]) for e, _ in nodes]


def _article(nodes: list[tuple[Element, str]], children: dict[Element, list[Element]], total: float) -> Element:
    """The element whose text is the page's; masses are of content, ``total`` in all."""
    article = nodes[0][0]
    while article.parent is not None:
        article = article.parent
    while inner := next((c for c in children[article] if c.tag in BLOCK and c.tag not in PARTS and c.mass == total), None):
        article = inner
    around = [article]
    while around[-1].parent is not None:
        around.append(around[-1].parent)
    named = [e for e in around if e.tag in ("article", "main")]
    if named:
        return named[-1]
    hosts, seen = set(), set()
    for element, _ in nodes:
        while element.parent is not None and element not in seen:
            seen.add(element)
            if element.tag in PROSE:
                hosts.add(element.parent)
            element = element.parent
    return next((e for e in reversed(around) if e in hosts), article)


def _inside_out(nodes: list[tuple[Element, str]]) -> list[Element]:
    """All elements around pieces of text, each after those in it."""
    seen: dict[Element, None] = {}
    for element, _ in nodes:
        while element is not None and element not in seen:
            seen[element] = None
            element = element.parent
    return sorted(seen, key=lambda e: -e.depth)


def _weigh(nodes: list[tuple[Element, str]]) -> tuple[float, list[Element]]:
    """Give every element the content below it, and all text and links; the content in all, and the elements."""
    ratios = path_ratios(nodes)
    lengths = [len(t) for _, t in nodes]
    level = sum(r * n for r, n in zip(ratios, lengths)) / sum(lengths)
    elements = _inside_out(nodes)
    for e in elements:
        e.mass, e.text, e.links, e.n_links, e.framed = 0.0, 0, 0, 0, False
    for (element, _), ratio, length in zip(nodes, ratios, lengths):
        element.mass += length if ratio >= CUT * level else 0
        element.text += length
        element.links += length if element.link else 0
    for e in elements:
        if e.tag == "a":
            e.n_links += 1
        if e.parent is not None:
            above = e.parent
            above.mass, above.text, above.links = above.mass + e.mass, above.text + e.text, above.links + e.links
            above.n_links += e.n_links
            above.framed = above.framed or e.framed or e.tag in ("h1", "article", "main")
    return elements[-1].mass, elements


def _goes(element: Element, total: float) -> bool:
    """Whether a weighed element's own tag, name and paths leave it out."""
    if element.suspect == "named":
        return not (element.mass == total or element.framed and element.mass >= FRAME_SHARE * total)
    mostly_links = element.links >= LINK_SHARE * element.text
    if element.suspect == "hinted":
        return element.mass < element.text / 2 or mostly_links
    return element.tag in MENUS and mostly_links and element.n_links > 2 and element.mass < element.text / 2


def _stays(elements: list[Element], total: float) -> dict[Element, bool]:
    """Whether each element stays, after those around it."""
    stay: dict[Element, bool] = {}
    for e in reversed(elements):
        stay[e] = e.parent is None or stay[e.parent] and not _goes(e, total)
    return stay


def main_text(html: str | None) -> str:
    """The article of one page: blocks in page order, one to a line."""
    found = [(e, t, b) for e, t, b in pieces(html or "") if not e.left_out]
    nodes = [(e, " ".join(t.split())) for e, t, _ in found if t.strip()]
    if not nodes:
        return ""
    total, elements = _weigh(nodes)
    stay = _stays(elements, total)
    nodes = [(e, t) for e, t in nodes if stay[e]]
    if not nodes:
        return ""
    # Without what went, the paths are weighed anew.
    total, elements = _weigh(nodes)
    children: dict[Element, list[Element]] = defaultdict(list)
    for e in elements:
        if e.parent is not None and e.mass:
            children[e.parent].append(e)
    article = _article(nodes, children, total)
    blocks: dict[int, list[str]] = defaultdict(list)
    inside = {article: True}
    for element, text, block in found:
        if not stay.get(element, True):
            continue
        way = []
        while element is not None and element not in inside:
            way.append(element)
            element = element.parent
        held = element is not None and inside[element]
        inside.update((e, held) for e in way)
        if held:
            blocks[block].append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of ``pages``."""

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column(2)]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(extracted, "page_id long, url string, text string, n_chars long")

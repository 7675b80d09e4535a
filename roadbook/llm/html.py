"""Main text of web pages by tree scoring.

Text blocks pass points to the elements around them: some for being there, one per comma, some for length,
less what links make of the block. The element with most points holds the article; its scored siblings count
as well. Menus, notices, forms and the like are left out wherever they stand, but a form or a part named like
one of these that holds most of the page's points is a wrapper of the article, of which only the controls go.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from roadbook.llm.frames import append_columns

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre search section summary table tbody tfoot thead tr ul caption".split()
)
CLOSES_P = BLOCK - {"dd", "dt", "li", "tr", "tbody", "thead", "tfoot", "caption", "html", "body"} | {"hr"}
#: Start tags that end an open element of the same kind, and the elements that this does not reach over.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
P_SCOPE = frozenset("html body article section div table td th li button blockquote aside nav main form".split())
#: Elements whose content is no part of an article.
DROPPED = frozenset(
    "head script style title iframe noembed noframes noscript xmp template svg annotation annotation-xml nav aside footer"
    " fieldset button select textarea dialog menu object audio video canvas search".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
#: Words in class or id of parts that are no part of an article.
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner banners sponsor sponsored promo"
    " promotion promoted cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription"
    " signup nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside widget widgets related recommended"
    " recommendations share sharing social comment comments commentlist respond replies reply disqus discussion footer"
    " masthead toolbar topbar pager pagination login search skip hidden alert alerts rail".split()
)
#: Of these, words of parts that are never a wrapper of the article.
NEVER_WRAPPERS = frozenset(
    "cookie cookies consent gdpr popup hidden comment comments commentlist respond replies reply disqus discussion".split()
)
#: Share of a page's points that a form or a part named like the above holds if it is a wrapper of the article.
WRAPPER_SHARE = 0.6
DROPPED_ENDINGS, DROPPED_BEGINNINGS = ("nav", "navbar", "menu"), ("advert", "sidebar", "cookie", "footer", "breadcrumb", "newsletter")
#: Words that turn a name into a remark on the page, as in no-sidebar; and those of a header that belongs to the article.
REMARKS = frozenset("no not has with without is".split())
OWN_HEADERS = frozenset("article post entry content story section".split())
KEPT_NAMES = frozenset("html body article main".split())
#: Points of a block: for being there, per comma, and per hundred characters up to a limit.
BASE_POINTS, LENGTH_UNIT, LENGTH_POINTS = 1.0, 100, 3.0
#: Share of points that the second element above gets; share of the best score that a sibling needs; share of
#: all points that an element marked as article or main needs.
SECOND_SHARE, SIBLING_SHARE, ARTICLE_SHARE = 0.5, 0.2, 1 / 3
SCORED = frozenset("p pre td blockquote".split())
CONTAINERS = frozenset("div section article main body html center td form".split())

_COMMENT = r"<!--(?:>|->|.*?--!?>|.*\Z)"
_CDATA, _OTHER = r"|<!\[CDATA\[.*?\]\]>", r"|<[!?][^>]*+>"
_QUOTED = r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
_PLAIN = r"|<(?P<slash>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>[^>]*+)>"
#: Tokens by whether a CDATA part can end, and whether quotes can. Where they cannot, looking for their end from each
#: place on would read the rest of the page again and again.
_TOKENS = {
    (cdata, quoted): re.compile(_COMMENT + _CDATA * cdata + _OTHER + _QUOTED * quoted + _PLAIN, re.DOTALL)
    for cdata in (False, True) for quoted in (False, True)
}
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    __slots__ = ("tag", "parent", "dropped", "wrapper", "held", "marked", "points", "total", "link")

    def __init__(self, tag: str, parent: Element | None, dropped: bool, wrapper: bool = False):
        self.tag, self.parent, self.dropped, self.points, self.total = tag, parent, dropped, 0.0, 0.0
        # the innermost part around that may be a wrapper; points in such a part, and those in an article of the page
        self.wrapper: Element | None = self if wrapper else parent and parent.wrapper
        self.held = self.marked = 0.0
        self.link = tag == "a" or (parent is not None and parent.link)


class Block:
    """A run of text between block borders, the block element it stands in, and characters in links."""

    __slots__ = ("element", "text", "linked")

    def __init__(self, element: Element, text: str, linked: int):
        self.element, self.text, self.linked = element, text, linked


STAYS, MAY_WRAP, GOES = range(3)


def _fate(tag: str, attributes: str, parent: Element | None) -> int:
    """Whether an element stays, goes, or goes unless it turns out to be a wrapper of the article."""
    if tag in DROPPED:
        return GOES
    if tag == "label" and _within(parent, ("form",)):
        return GOES
    if tag == "header":  # a heading of the article itself stays
        return STAYS if _within(parent, ("article", "main")) else GOES
    fate = MAY_WRAP if tag == "form" else STAYS
    if not attributes or tag in KEPT_NAMES or "=" not in attributes and "hidden" not in attributes:
        return fate
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name in ("class", "id"):
            fate = max(fate, *(_fate_of_name(token, parent) for token in value.split()), STAYS)
        elif name == "role" and value.strip().lower() in DROPPED_ROLES:
            return GOES
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return GOES
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return GOES
    return GOES if fate == MAY_WRAP and tag not in BLOCK else fate


def _fate_of_name(token: str, parent: Element | None) -> int:
    """The same by a class or id, which may name a part that is no part of an article."""
    parts = [part.lower() for part in _NAME.findall(token)]
    if not parts or parts[0] in REMARKS:
        return STAYS
    if NEVER_WRAPPERS.intersection(parts):
        return GOES
    if any(p in DROPPED_NAMES or p.endswith(DROPPED_ENDINGS) or p.startswith(DROPPED_BEGINNINGS) for p in parts):
        return MAY_WRAP
    if "header" in parts and not OWN_HEADERS.intersection(parts) and not _within(parent, ("article", "main")):
        return MAY_WRAP
    return STAYS


def _within(element: Element | None, tags: tuple[str, ...]) -> Element | None:
    while element is not None and element.tag not in tags:
        element = element.parent
    return element


class _Page:
    """Builds the tree of a page and gathers its blocks in order."""

    def __init__(self) -> None:
        self.root = Element("html", None, False)
        self.open, self.blocks = [self.root], []
        self.pieces: list[str] = []
        self.linked, self.owner = 0, self.root
        self.elements = [self.root]

    def text(self, raw: str) -> None:
        top = self.open[-1]
        if top.dropped or not raw:
            return
        piece = html.unescape(raw) if "&" in raw else raw
        self.pieces.append(piece)
        if top.link:
            self.linked += len(piece.strip())

    def border(self) -> None:
        """Ends the current block."""
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                owner = self.open[-1]
                while owner.tag not in BLOCK and owner.tag not in ("td", "th") and owner.parent is not None:
                    owner = owner.parent
                self.blocks.append(Block(owner, text, self.linked))
            self.pieces, self.linked = [], 0

    def close(self, tags: set[str] | frozenset[str], scope: set[str] | frozenset[str]) -> None:
        """Ends the innermost open element of these tags, unless one of ``scope`` is open within it."""
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in tags:
                if any(e.tag in BLOCK for e in self.open[k:]):
                    self.border()
                del self.open[k:]
                return
            if tag in scope:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag in ("td", "th", "img", "wbr"):
            if tag != "wbr" and not self.open[-1].dropped:
                self.pieces.append(" ")
        if tag in CLOSES_P:
            self.close({"p"}, P_SCOPE)
        if tag in SIBLINGS:
            self.close(*SIBLINGS[tag])
        if tag in BLOCK or tag == "hr":
            self.border()
        if tag in VOID:
            return
        if tag in ("html", "body") and any(e.tag == tag for e in self.open):
            return
        if tag == "body":
            self.close({"head"}, frozenset())
        parent = self.open[-1]
        fate = _fate(tag, attributes, parent)
        element = Element(tag, parent, parent.dropped or fate == GOES, fate == MAY_WRAP)
        self.open.append(element)
        self.elements.append(element)

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if any(e.tag == tag for e in self.open[1:]):
            self.close({tag}, frozenset({"table", "td", "article", "section", "div", "ul", "ol", "body"} - {tag}) if tag not in BLOCK else frozenset())


def _parse(source: str) -> _Page:
    page, at, quoted = _Page(), 0, True
    last, last_cdata = source.rfind(">"), source.rfind("]]>")
    while True:
        # behind the last ">" only a comment can begin, which then takes the rest
        found = _TOKENS[at <= last_cdata, quoted].search(source, at) if at <= last else None
        if not found:
            rest, _, _ = source[at:].partition("<!--")
            page.text(rest)
            break
        page.text(source[at : found.start()])
        at = found.end()
        if quoted and (name := found[2]):
            slash, attributes = found[1], found[3]
        elif name := found["name"]:
            # quotes that never close: from here on a tag ends at the first ">"
            slash, attributes, quoted = found["slash"], found["rest"], False
        else:
            continue
        name = name.lower()
        if slash:
            page.end(name)
            continue
        page.start(name, attributes)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(source, at)
            at = close.start() if close else len(source)
            page.open.pop()
            if close:
                at = source.find(">", at) + 1 or len(source)
    page.border()
    return page


def main_text(source: str | None) -> str:
    """The article of a page, its blocks in page order with an empty line between."""
    if not source:
        return ""
    page, total = _parse(source), 0.0
    points_of = list(map(_points, page.blocks))
    _drop_all_but_wrappers(page, points_of)
    blocks = [(block, points) for block, points in zip(page.blocks, points_of, strict=True) if not block.element.dropped]
    for block, points in blocks:
        element = block.element
        direct = element.tag not in SCORED
        if direct and element.tag not in CONTAINERS:
            continue
        total += points
        if named := _within(element, ("article", "main")):
            named.total += points
        near = element if direct else element.parent
        if near is not None:
            near.points += points
            if near.parent is not None:
                near.parent.points += SECOND_SHARE * points
    best = max((e for e in page.elements if not e.dropped), key=lambda e: e.points, default=page.root)
    if not best.points:
        best = next((e for e in page.elements if e.tag == "article" and not e.dropped), page.root)
    holder = _within(best, ("article",)) or _within(best, ("main",))
    if holder is None:  # an element that is marked as the article needs a share of all points only
        marked = max(page.elements, key=lambda e: e.total)
        holder = marked if marked.total > 0 and marked.total >= ARTICLE_SHARE * total else None
    kept = {id(holder or best)}
    if holder is None and best.parent is not None:
        limit = SIBLING_SHARE * best.points
        kept |= {id(e) for e in page.elements if e.parent is best.parent and not e.dropped and e.points >= limit}
        kept |= {id(b.element) for b, _ in blocks if b.element.parent is best.parent and _is_prose(b)}
    return "\n\n".join(b.text for b, _ in blocks if _inside(b.element, kept))


def _points(block: Block) -> float:
    """For being there, for commas and for length, less the share of links."""
    share = 1 - min(1.0, block.linked / len(block.text))
    return (BASE_POINTS + block.text.count(",") + min(len(block.text) / LENGTH_UNIT, LENGTH_POINTS)) * share


def _drop_all_but_wrappers(page: _Page, points_of: list[float]) -> None:
    """Marks what is in a form or a part named like a sidebar, unless most points and marked articles are in it.

    Where such parts stand in one another each is judged by itself.
    """
    parts = [e for e in page.elements if e.wrapper is e and not e.dropped]
    if not parts:
        return
    total = marked = 0.0
    for block, points in zip(page.blocks, points_of, strict=True):
        own = points if _within(block.element, ("article", "main")) else 0.0
        total, marked = total + points, marked + own
        if part := block.element.wrapper:
            part.held, part.marked = part.held + points, part.marked + own
    for part in reversed(parts):  # inner ones come behind outer ones
        if part.parent is not None and (outer := part.parent.wrapper):
            outer.held, outer.marked = outer.held + part.held, outer.marked + part.marked
    for part in parts:
        part.dropped = part.held < WRAPPER_SHARE * total or 2 * part.marked < marked or not part.held
    for element in page.elements:
        element.dropped = element.dropped or (element.parent is not None and element.parent.dropped)


def _is_prose(block: Block) -> bool:
    """A paragraph beside the container: long, or a sentence, and without many links."""
    share = block.linked / len(block.text)
    if block.element.tag != "p":
        return False
    return share < 0.25 if len(block.text) > 80 else share == 0 and block.text[-1:] in ".!?"


def _inside(element: Element | None, kept: set[int]) -> bool:
    while element is not None:
        if id(element) in kept:
            return True
        element = element.parent
    return False


_EXTRACTED = T.StructType([T.StructField("main_text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)])


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """Rows with ``main_text`` and ``n_chars`` (its code points), from the whole page.

    A null or empty page has an empty text, as has one without any block outside the dropped parts. Formulas
    keep their text. Tags whose quotes never close end at their first ">". Equal
    scores go to the element that begins first. Repeated rows are each extracted; input columns of these
    names are replaced.
    """

    def compute(sources: list[str | None]) -> list[pa.Array]:
        texts = [main_text(source) for source in sources]
        return [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]

    return append_columns(pages, html_column, _EXTRACTED, compute)

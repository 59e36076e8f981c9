"""Main text of web pages by tree scoring.

A page is read into a tree of its elements. Every block of text earns points for its length and its
commas and passes them to the elements around it: all to the nearest container, half to the next,
ever less further up. A container's points are discounted by the share of its text that lies in
links, and weigh more in an element that is named as the page's article. The best container is the
article; siblings that score well enough, or that are plainly
paragraphs, belong to it. Menus, forms, adverts, comments and the like take no part, unless what is
named so is a wrapper that holds the page's text.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField

from textmill.llm.arrow import add_columns, texts_of

# Element names of the HTML standard, by their part in the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
DROPPED = RAW | frozenset(
    "applet aside audio button canvas datalist dialog embed fieldset footer form head input label map menu nav "
    "object optgroup option picture progress select svg template video".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | frozenset("address caption dd dt figcaption legend li p pre summary td th".split())
# Start tags that close an open element of the same group, and the elements at which the search for it stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
P_SCOPE = frozenset("button caption html object table td template th".split())
# Words in class or id, and roles, that name what is not the article.
UNLIKELY = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies discussion discussions disqus dock footer gdpr header masthead menu modal nav navbar navigation newsletter notice notification "
    "outbrain pager pagination popup promo promoted promotion recommended related replies reply respond share sharing "
    "sidebar social sponsor sponsored subscribe subscription taboola toolbar widget".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search".split())
WRAPPERS = frozenset("fieldset form".split())  # of DROPPED, those that pages put around everything
SPARED = frozenset("article body html main".split())
NAMED = 10  # times that points count in the page's one article or main

_NAME = re.compile("<(/?)([a-zA-Z][^\\s/>]*+)")
_TAG_END = re.compile(r"""((?>"[^"]*"|'[^']*'|[^>])*+)>""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
# Words that name the top of a page, but also the place of a title within an article.
TITLES = frozenset("header masthead banner".split())
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_COMMA = re.compile("[,،、，]")
_SENTENCE = re.compile(r"[.!?。！？](?:\s|\Z)")


class Tags:
    """Finds tags, comments and the like from left to right, in time that follows the length of the page.

    What is missed once - the end of a tag, or of character data - is not looked for again. After a tag
    that has no end because of an open quote, quotes do not hide the end of a tag any more.
    """

    def __init__(self, page: str):
        self.page, self.quotes, self.data, self.ends = page, True, True, True

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start, end, slash, name and attributes of the next tag; the name is empty for what is no element."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(page), "", "", ""
            if self.data and page.startswith("<![CDATA[", at):
                end = page.find("]]>", at + 9)
                if end >= 0:
                    return at, end + 3, "", "", ""
                self.data = False
            if self.ends and page[at + 1 : at + 2] in ("!", "?"):
                end = page.find(">", at + 2)
                if end >= 0:
                    return at, end + 1, "", "", ""
                self.ends = False
            elif self.ends and (named := _NAME.match(page, at)):
                slash, name = named.groups()
                if self.quotes and (rest := _TAG_END.match(page, named.end())):
                    return at, rest.end(), slash, name, rest[1]
                self.quotes = False
                end = page.find(">", named.end())
                if end >= 0:
                    return at, end + 1, slash, name, page[named.end() : end]
                self.ends = False
            at += 1
        return None


class Element:
    __slots__ = ("name", "parent", "dropped", "points", "chars", "linked", "order", "chosen", "doubt", "loose", "block", "article")

    def __init__(self, name: str, parent: Element | None, dropped: bool, order: int):
        self.name, self.parent, self.dropped, self.order = name, parent, dropped, order
        self.points, self.chars, self.linked, self.chosen = 0.0, 0, 0, False
        self.doubt, self.loose = 0, 0  # what _unlikely says, and characters outside links, dropped ones too
        self.block = self if parent is None or name in BLOCKS else parent.block
        self.article = name in ("article", "main") or parent is not None and parent.article

    def density(self) -> float:
        return self.linked / self.chars if self.chars else 0.0


class Block:
    """Text between two block boundaries, and the element that holds it."""

    __slots__ = ("owner", "text", "linked")

    def __init__(self, owner: Element, text: str, linked: int):
        self.owner, self.text, self.linked = owner, text, linked


def _unlikely(name: str, attributes: str, inside: bool = False) -> int:
    """0: may be the article, 1: is not, unless it turns out to wrap it, 2: is not; ``inside`` an article titles are no page's header."""
    if name in DROPPED and name not in WRAPPERS:
        return 2
    if not attributes or name in SPARED:
        return int(name in WRAPPERS)
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    words = re.split(r"[^a-z0-9]+", f"{found.get('class', '')} {found.get('id', '')}".lower())
    hidden = "hidden" in found or "display:none" in re.sub(r"\s", "", found.get("style", "").lower())
    if hidden:
        return 2
    unlikely = UNLIKELY.intersection(words) - (TITLES if inside else frozenset())
    return int(name in WRAPPERS or found.get("role", "").lower() in ROLES or bool(unlikely))


def wrappers(elements: list[Element]) -> set[int]:
    """The places of elements that are dropped by name, class or role but wrap the page's text, and of those around them.

    Text outside links counts, without what is dropped within an element. A wrapper holds more of it
    than any other such element, and more than all that is dropped nowhere if it has a main heading,
    nine times as much if not and if no ``article`` or ``main`` with text is outside. So a long list of
    comments below a shorter article is no wrapper.
    """
    weight, main, hard = [e.loose for e in elements], [e.name in ("main", "h1") for e in elements], [False] * len(elements)
    for element in elements[1:]:
        hard[element.order] = hard[element.parent.order] or element.doubt == 2
    for element in reversed(elements[1:]):
        if not element.doubt:
            weight[element.parent.order] += weight[element.order]
            main[element.parent.order] |= main[element.order]
    clear = [True] * len(elements)
    for element in elements[1:]:
        clear[element.order] = clear[element.parent.order] and not element.doubt
    named = any(clear[e.order] and weight[e.order] for e in elements if e.name in ("article", "main"))
    found = [e for e in elements if e.doubt == 1 and weight[e.order] and not hard[e.order]]
    most = max((weight[e.order] for e in found), default=0)
    spared = set()
    for element in found:
        own = weight[element.order]
        if own == most and (main[element.order] and own > weight[0] or not named and own >= 9 * weight[0]):
            while element is not None and element.order not in spared:
                spared.add(element.order)
                element = element.parent
    return spared


def parse(page: str, spared: set[int] | frozenset[int] = frozenset()) -> tuple[list[Element], list[Block]]:
    """Elements in page order, each after its parent, and the blocks of those that are not dropped.

    ``spared`` are places in that order of elements that only a class, a role or a form would drop.
    """
    root = Element("html", None, False, 0)
    elements, blocks, stack = [root], [], [root]
    links, text, linked, owner = 0, [], 0, root
    opened: dict[str, list[int]] = {"html": [0]}  # the places in the stack of the open elements of each name

    def end_block() -> None:
        nonlocal text, linked
        if text:
            value = " ".join("".join(text).split())
            if value:
                blocks.append(Block(owner, value, min(linked, len(value))))
            text, linked = [], 0

    def add_text(value: str) -> None:
        nonlocal linked, owner
        if value and not links:
            stack[-1].loose += len(value.strip())
        if value and not stack[-1].dropped:
            if not text:
                owner = stack[-1].block
            value = html.unescape(value) if "&" in value else value
            text.append(value)
            if links:
                linked += len(value.strip())

    def close_to(at: int) -> None:
        nonlocal links
        while len(stack) > at:
            gone = stack.pop()
            opened[gone.name].pop()
            links -= gone.name == "a"
            if gone.name in BLOCKS:
                end_block()

    def close_open(names, stops) -> None:
        last = lambda chosen: max((opened[n][-1] for n in chosen if opened.get(n)), default=0)
        if (at := last(names)) and at >= last(stops):
            close_to(at)

    at, tags = 0, Tags(page)
    while (token := tags.after(at)) is not None:
        start, end, closing, name, attributes = token
        add_text(page[at:start])
        at = end
        if not name:
            continue
        name = name.lower()
        if closing:
            if name in BLOCKS or name == "a" or name not in VOID:
                close_open({name}, P_SCOPE if name not in ("table", "body", "html") and name not in P_SCOPE else ())
            continue
        if name == "html":
            continue
        if name == "br":
            add_text(" ")
            continue
        if name in CLOSES:
            close_open(*CLOSES[name])
        if name in BLOCKS:
            close_open({"p"}, P_SCOPE)
            if name in HEADINGS and stack[-1].name in HEADINGS:
                close_to(len(stack) - 1)
            end_block()
        if name == "a" and links:
            close_open({"a"}, P_SCOPE)
        inside = bool(opened.get("article"))
        doubt = 2 if name == "header" and not inside else _unlikely(name, attributes, inside)
        dropped = stack[-1].dropped or doubt == 2 or (doubt == 1 and len(elements) not in spared)
        element = Element(name, stack[-1], dropped, len(elements))
        element.doubt = doubt
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = page.find(">", end.end()) + 1 if end else 0
            if not at:
                at = len(page)
            continue
        elements.append(element)
        if name not in VOID:
            opened.setdefault(name, []).append(len(stack))
            stack.append(element)
            links += name == "a"
    add_text(page[at:])
    end_block()
    return elements, blocks


def _score(elements: list[Element], blocks: list[Block]) -> None:
    for block in blocks:
        size = len(block.text)
        block.owner.chars += size
        block.owner.linked += block.linked
        if block.owner.name in HEADINGS:
            continue
        points = (1 + len(_COMMA.findall(block.text)) + min(size / 100, 3)) * (1 - block.linked / size)
        above = block.owner.parent if block.owner.name in PARAGRAPHS else block.owner
        level = 0
        while above is not None and level < 5:
            above.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            above, level = above.parent, level + 1
    for element in reversed(elements[1:]):
        element.parent.chars += element.chars
        element.parent.linked += element.linked


def main_text(page: str) -> str:
    """The article of the page, its blocks joined by blank lines; empty if there is none."""
    elements, blocks = parse(page)
    if spared := wrappers(elements):
        elements, blocks = parse(page, spared)
    text = _article(elements, blocks)
    if not text and any(e.doubt == 1 and e.dropped for e in elements):
        # Nothing is left: names and forms do not tell the article of this page from the rest.
        text = _article(*parse(page, {e.order for e in elements if e.doubt == 1}))
    return text


def _article(elements: list[Element], blocks: list[Block]) -> str:
    if not blocks:
        return ""
    _score(elements, blocks)
    # A page that names its article once means it; several may be teasers.
    articles = [e for e in elements if e.name in ("article", "main") and not e.dropped and e.chars and not e.parent.article]
    trust = NAMED if len(articles) == 1 else 1
    best = max(elements, key=lambda e: (e.points * (1 - e.density()) * (trust if e.article else 1), -e.order))
    top = best.points * (1 - best.density())
    if top <= 0:
        return ""
    best.chosen = True
    first_texts = {}
    for block in blocks:
        first_texts.setdefault(block.owner.order, block.text)
    for other in elements:
        if other.parent is best.parent and other is not best and not other.dropped:
            density = other.density()
            own = first_texts.get(other.order, "")
            plain = other.name == "p" and (other.chars > 80 and density < 0.25 or not density and _SENTENCE.search(own))
            title = other.name in ("h1", "h2") and other.order < best.order
            apart = trust > 1 and best.article and not other.article
            other.chosen = bool(title or not apart and (plain or other.points * (1 - density) >= max(10.0, 0.2 * top)))
    for element in elements[1:]:
        if element.parent.chosen and not element.chosen:
            lists = element.name in ("div", "section", "ul", "ol", "dl", "table")
            # Lists of links beside the text are menus; within a named article they are its own.
            element.chosen = not (lists and element.density() > 0.5) or element.parent.article and trust > 1
    return "\n\n".join(b.text for b in blocks if b.owner.chosen)


def extract_main_text(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``df`` with the main text of the page in ``html``.

    Null or empty html has an empty text, as has a page without text outside links. Character
    references are decoded; white space within a block becomes one space. A column called ``text`` is
    replaced; all others stay. Rows are independent: no shuffle, whole pages.
    """

    def make():
        return lambda batch: [pa.array([main_text(p) for p in texts_of(batch.column(html))], pa.string())]

    return add_columns(df, [StructField(text, StringType(), False)], make)

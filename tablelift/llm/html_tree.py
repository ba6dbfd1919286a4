"""Web pages as trees of block elements and text blocks.

The reader is forgiving, as browsers are: missing end tags, stray ones, unquoted attributes, a page cut
off anywhere.  Inline markup dissolves into its block; scripts, styles, templates, frames, titles,
text fields and comments hold no text of the page and are skipped.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Elements by what they do to the text.
SKIPPED = frozenset("script style template iframe noembed noframes noscript title textarea xmp svg math object canvas head".split())
RAW = frozenset("script style template iframe noembed noframes noscript title textarea xmp".split())  # no markup inside
BLOCK = tuple(
    "html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption address header footer nav aside form fieldset legend details summary dialog hgroup "
    "menu search center button select option".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {  # an open element that a new one of the same family ends, and where the search for it stops
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
# Words in class, id and role that say what a part is for.
CUES = tuple(
    "nav navigation menu navbar breadcrumb breadcrumbs sidebar side widget aside footer foot header head masthead banner ad ads "
    "advert advertisement sponsor sponsored promo promoted cookie consent notice alert popup modal overlay comment comments "
    "respond reply discussion disqus share social follow related recommended more teaser form search login signup subscribe "
    "newsletter pagination pager tags meta author content article post entry story body main text page wrapper container copyright "
    "legal toolbar skip complementary contentinfo".split()
)
CUE_ID = {cue: i for i, cue in enumerate(CUES)}
BLOCK_ID = {tag: i for i, tag in enumerate(BLOCK)}

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z>][^>]*+(?:>|\Z)|</>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(>|\Z)",
    re.S,
)
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I | re.S)
PIECE = re.compile(r"[A-Za-z][a-z]*")


class Page(NamedTuple):
    """Nodes in page order; a parent comes before its children.  Text blocks have tag -1."""

    parent: list[int]
    tag: list[int]
    cues: list[tuple[int, ...]]
    text: list[str]  # of text blocks, white space already single
    linked: list[int]  # characters of a text block that stand in links


def cues_of(attributes: str) -> tuple[int, ...]:
    found = set()
    for match in NAMED.finditer(attributes):
        for piece in PIECE.findall(match[1] or match[2] or match[3] or ""):
            cue = CUE_ID.get(piece.lower())
            if cue is not None:
                found.add(cue)
    return tuple(sorted(found))


def read_page(source: str) -> Page:
    """The tree of one page; node 0 is the root."""
    page = Page([-1], [BLOCK_ID["html"]], [()], [""], [0])
    stack = [0]
    names = ["html"]
    opened: dict[str, int] = {}  # how often an element is open, the root aside
    words: list[str] = []  # pieces of the open text block
    linked = 0
    in_link = False

    def flush() -> None:
        nonlocal linked
        if words:
            text = " ".join("".join(words).split())
            if text:
                page.parent.append(stack[-1])
                page.tag.append(-1)
                page.cues.append(())
                page.text.append(text)
                page.linked.append(min(linked, len(text)))
            words.clear()
        linked = 0

    def pop_to(families: tuple[str, ...], stops: tuple[str, ...]) -> None:
        for depth in range(len(names) - 1, 0, -1):
            if names[depth] in families:
                for name in names[depth:]:
                    opened[name] -= 1
                del names[depth:], stack[depth:]
                return
            if names[depth] in stops:
                return

    at, end = 0, len(source)
    while at < end:
        token = TOKEN.search(source, at)
        if token is None or token.start() > at:
            piece = source[at : token.start() if token else end]
            if "&" in piece:
                piece = html.unescape(piece)
            words.append(piece)
            if in_link:
                linked += len(piece.strip())
            if token is None:
                break
        at = token.end()
        name = token[2]
        if name is None or not token[4]:  # a comment, a declaration, or a tag the page's end cuts off
            continue
        name = name.lower()
        if token[1]:
            if name == "a":
                in_link = False
            elif name in BLOCK_ID:
                if opened.get(name):
                    flush()
                    pop_to((name,), ())
                    in_link = False
            elif name == "br":
                words.append(" ")
            continue
        if name in RAW:
            if not token[3].endswith("/") or name not in ("svg", "math"):
                close = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I).search(source, at)
                at = end if close is None else close.start()
            continue
        if name in SKIPPED:
            if name == "head":
                continue  # what it holds is skipped by name
            close = re.compile(f"</{name}\\s*>", re.I).search(source, at)
            at = at if close is None or token[3].endswith("/") else close.end()
            continue
        if name == "a":
            in_link = True
        elif name == "hr":
            flush()
        elif name in VOID:
            words.append(" ")
        elif name in BLOCK_ID:
            flush()
            if name == "html" or (name == "body" and opened.get(name)):
                continue
            if names[-1] == "p" or (names[-1] in HEADINGS and name in HEADINGS):
                opened[names[-1]] -= 1
                del names[-1], stack[-1]
            if name in CLOSED_BY:
                pop_to(*CLOSED_BY[name])
            page.parent.append(stack[-1])
            page.tag.append(BLOCK_ID[name])
            page.cues.append(cues_of(token[3]) if "=" in token[3] else ())
            page.text.append("")
            page.linked.append(0)
            stack.append(len(page.parent) - 1)
            names.append(name)
            opened[name] = opened.get(name, 0) + 1
            in_link = False
    flush()
    return page

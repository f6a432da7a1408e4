"""Web pages as trees: elements, and the pieces of text below them in page order.

Follows the HTML rules that decide what text stands where: comments and raw
elements, quoted attributes, elements that close others, end tags that are
missing or stray.  Works in one pass with its own stack, so neither deep nor
broken pages take more than time in proportion to their length.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

_TAG = re.compile(
    r"""<([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))*+)>"""
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Fixed values of HTML: elements by how they are laid out and closed.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe noembed noframes xmp".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em embed font i img input ins kbd label map area mark meter nobr output "
    "picture progress q rp rt ruby s samp slot small source span strike strong sub sup time track tt u var wbr".split()
)
BLOCK = set(
    "address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav object ol optgroup option p pre search "
    "section select summary svg table tbody td template tfoot th thead tr ul audio video canvas math".split()
)
HEAD = set("base link meta title style script noscript template basefont bgsound".split())
_PARAGRAPH_ENDS = BLOCK - set("body button caption col colgroup head html legend object option optgroup select tbody td template tfoot th thead tr svg audio video canvas math".split())
_CELLS, _ROWS, _SECTIONS = {"td", "th"}, {"tr"}, {"tbody", "thead", "tfoot", "caption", "colgroup"}
#: What a start tag closes if it is open, and what it does not reach across.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": (_CELLS, {"table"}),
    "th": (_CELLS, {"table"}),
    "tr": (_CELLS | _ROWS, {"table"}),
    "tbody": (_CELLS | _ROWS | _SECTIONS, {"table"}),
    "thead": (_CELLS | _ROWS | _SECTIONS, {"table"}),
    "tfoot": (_CELLS | _ROWS | _SECTIONS, {"table"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
_SCOPE = {"table", "td", "th", "caption", "button", "object", "template", "html", "body"}

#: The attributes that mark the main parts of a labelled page, and other parts inside them.
MARK, OTHER = "data-main", "data-other"


@dataclass
class Page:
    """``parent``, ``tag`` and ``names`` (of class, id and role) of each node, the root first; pieces are (node, block, text, in a link)."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["html"])
    names: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    marked: list[bool] = field(default_factory=lambda: [False])
    pieces: list[tuple[int, int, str, bool]] = field(default_factory=list)


def _names(attributes: str) -> tuple[tuple[str, ...], bool | None]:
    """The parts of an element's names, and whether it is marked as main or as other."""
    found, marked = [], None
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role", "itemprop", "aria-label"):
            found += [part.lower() for part in _NAME_PART.findall(value[:2000])]
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            found.append("hidden")
        elif key == "style" and re.search(r"display\s*:\s*none", value):
            found.append("hidden")
        elif key in (MARK, OTHER):
            marked = key == MARK
    return tuple(dict.fromkeys(found)), marked


class _Builder:
    def __init__(self) -> None:
        self.page = Page()
        self.stack: list[tuple[str, int]] = [("html", 0)]  # element, its node or that of the element it is a part of
        self.open: Counter[str] = Counter()
        self.block = 0

    def pop(self) -> None:
        name, _ = self.stack.pop()
        self.open[name] -= 1
        if name not in INLINE:
            self.block += name in BLOCK

    def close(self, names: set[str], barriers: set[str]) -> None:
        """Close the outermost open element of ``names`` above the nearest barrier, with all it holds."""
        if not any(self.open[name] for name in names):
            return
        depth = None
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in names:
                depth = i
            elif self.stack[i][0] in barriers:
                break
        while depth is not None and len(self.stack) > depth:
            self.pop()

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.text("\n")
            return
        if self.open["head"] and name not in HEAD:
            self.close({"head"}, set())
        if self.stack[-1][0] == "html" and name not in HEAD and name not in ("html", "head", "body", "frameset"):
            self.start("body", "")
        if name in CLOSES:
            self.close(*CLOSES[name])
        if name in _PARAGRAPH_ENDS:
            self.close({"p"}, _SCOPE)
        names, marked = _names(attributes) if attributes else ((), None)
        if name == "html" or (name == "body" and self.open["body"]):
            return
        node = self.stack[-1][1]
        if name in BLOCK or names or marked is not None:
            page = self.page
            page.parent.append(node)
            page.tag.append(name)
            page.names.append(names)
            page.marked.append(page.marked[node] if marked is None else marked)
            node = len(page.tag) - 1
        self.block += name in BLOCK
        if name in VOID:
            self.block += name in BLOCK
            return
        self.stack.append((name, node))
        self.open[name] += 1

    def end(self, name: str) -> None:
        if name == "br":
            self.text("\n")
        if not self.open[name] or name in ("html", "body"):
            return
        if name in BLOCK:
            while self.stack[-1][0] != name:
                self.pop()
            self.pop()
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == name:
                while len(self.stack) > i:
                    self.pop()
                return
            if self.stack[i][0] in BLOCK:  # an inline end tag closes no block
                return

    def text(self, text: str) -> None:
        if self.stack[-1][0] == "html" and text.strip() and not self.open["body"]:
            self.start("body", "")
        if text:
            self.page.pieces.append((self.stack[-1][1], self.block, text, self.open["a"] > 0))


def parse(html: str) -> Page:
    """The tree of a whole page, however broken; every character reference is decoded."""
    builder, at, n = _Builder(), 0, len(html)
    while at < n:
        start = html.find("<", at)
        while 0 <= start < n - 1 and not (html[start + 1] in "!?/" or (html[start + 1].isascii() and html[start + 1].isalpha())):
            start = html.find("<", start + 1)
        if start < 0 or start == n - 1:
            builder.text(unescape(html[at:]))
            break
        builder.text(unescape(html[at:start]))
        if html.startswith("<!--", start):
            end = start + 4 if html.startswith(("<!-->", "<!--->"), start) else html.find("-->", start + 4)
            at = html.find(">", end) + 1 if end >= 0 else n
        elif html[start + 1] in "!?" or (html[start + 1] == "/" and not html[start + 2 : start + 3].isalpha()):
            at = html.find(">", start) + 1 or n
        elif html[start + 1] == "/":
            at = html.find(">", start) + 1 or n
            name = re.match(r"[^\s/>]*", html[start + 2 : min(at, start + 100)])[0]
            builder.end(name.lower())
        else:
            tag = _TAG.match(html, start)
            if tag is None:  # the page ends inside a tag
                break
            name = tag[1].lower()
            builder.start(name, tag[2])
            at = tag.end()
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(html, at)
                at = end.start() if end else n
    return builder.page

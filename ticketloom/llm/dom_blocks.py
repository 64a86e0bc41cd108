"""Leaf blocks of a web page: stretches of text that no block-level tag interrupts, with their features.

The reader takes any text: it never fails, closes what a page leaves open as browsers do for
paragraphs, list items and table cells, skips scripts, styles and comments, and its time grows with
the length of the page only.
"""

from __future__ import annotations

import re
import zlib
from html import unescape

SLOTS = 1 << 15

# Fixed values of HTML: tags within a line of text, tags without content, tags whose content is no markup.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base basefont br col embed hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
UNSEEN = frozenset("script style iframe noembed noframes template".split())
# An opening tag closes these if they are open, but not beyond the tags that hold them.
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
    "tbody": ("thead tbody tfoot tr td th", ("table",)), "thead": ("tbody tr td th", ("table",)),
    "tfoot": ("thead tbody tr td th", ("table",)), "option": ("option", ("select", "datalist")),
    "optgroup": ("option optgroup", ("select",)), "body": ("head", ()),
}
CLOSES = {tag: (frozenset(names.split()), frozenset(bounds)) for tag, (names, bounds) in CLOSES.items()}

_OPEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NAMED = frozenset(("class", "id", "role", "itemprop", "data-role"))
_SAYS = re.compile(
    r"©|\b(?:copyright|cookies?|subscri\w+|newsletter|sign (?:in|up)|log ?in|advert\w*|sponsor\w*|repl(?:y|ies)|"
    r"comments?|share|search|menu|related|read more|all rights reserved)\b", re.I)


def slot(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % SLOTS


class Node:
    """An open element: `features` are those of its ancestors and its own, `label` is inherited."""

    __slots__ = ("tag", "features", "near", "label")

    def __init__(self, tag: str, features: frozenset, near: tuple, label: int) -> None:
        self.tag, self.features, self.near, self.label = tag, features, near, label


class Block:
    """`parent` is the element that holds the text, so neighbours with one parent are known."""

    __slots__ = ("text", "features", "parent", "label")

    def __init__(self, text: str, features: tuple, parent: Node, label: int) -> None:
        self.text, self.features, self.parent, self.label = text, features, parent, label


_own: dict[tuple[str, str], tuple[frozenset, dict]] = {}


def _own_features(tag: str, attributes: str) -> tuple[frozenset, dict]:
    """Slots of an element's tag, classes and roles, and its attributes; remembered, as pages repeat them."""
    key = tag, attributes
    if key not in _own:
        if len(_own) > 20_000:
            _own.clear()
        named = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
        words = {w.lower() for k in _NAMED & named.keys() for w in _WORD.findall(named[k])}
        found = {slot("tag " + tag)} | {slot("name " + w) for w in words}
        if "hidden" in attributes.lower():
            found.add(slot("hidden"))
        _own[key] = frozenset(found), named
    return _own[key]


def _bucket(n: float, cuts: tuple) -> int:
    return sum(n >= c for c in cuts)


_LINE = {kind: [slot(f"{kind} {n}") for n in range(12)] for kind in ("words", "links", "length", "upper", "digits")}
_BIAS, _ENDS, _COMMA, _SAID = slot("bias"), slot("ends a sentence"), slot("has a comma"), slot("says")


def text_features(text: str, linked: int) -> tuple:
    """Slots of what can be seen of a block's own text."""
    words = text.count(" ") + 1
    out = [_BIAS, _LINE["words"][_bucket(words, (2, 3, 5, 9, 17, 33, 65, 129))],
           _LINE["links"][_bucket(linked / len(text), (0.01, 0.25, 0.5, 0.9))],
           _LINE["length"][_bucket(len(text) / words, (3, 5, 8, 14))]]
    if words < 65:
        out.append(_LINE["upper"][_bucket(sum(map(str.isupper, text)) / words, (0.1, 0.5, 0.9, 2))])
        out.append(_LINE["digits"][_bucket(sum(map(str.isdigit, text)) / len(text), (0.01, 0.1, 0.3))])
        if _SAYS.search(text):
            out.append(_SAID)
    if text.rstrip("\"'”’»)]")[-1:] in (".", "!", "?", "…", ":", "。"):
        out.append(_ENDS)
    if "," in text:
        out.append(_COMMA)
    return tuple(out)


class Reader:
    """Reads one page; `marked` names the attribute that holds a label, in training pages only."""

    def __init__(self, html: str, marked: str | None = None) -> None:
        self.html, self.marked = html, marked
        self.open = [Node("", frozenset(), (), 0)]
        self.pieces: list[str] = []
        self.linked: list[bool] = []
        self.links = 0
        self.parent = self.open[0]
        self.blocks: list[Block] = []
        self.unclosed: dict[str, int] = {}

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join(unescape("".join(self.pieces)).split())
            if text:
                linked = sum(len(p) for p, inside in zip(self.pieces, self.linked) if inside)
                node = self.parent
                self.blocks.append(Block(text, (*text_features(text, min(linked, len(text))), *node.features, *node.near), node, node.label))
            self.pieces, self.linked = [], []

    def _text(self, text: str) -> None:
        if not self.pieces:
            if text.isspace():
                return
            # the nearest element that is not within the line
            self.parent = next(n for n in reversed(self.open) if n.tag not in INLINE)
        self.pieces.append(text)
        self.linked.append(self.links > 0)

    def _end_of_tag(self, at: int) -> int:
        """Position after the tag's last character; quoted parts may hold one."""
        html = self.html
        while True:
            stop = _STOP.search(html, at)
            if stop is None:
                return len(html)
            quote, at = stop.group(), stop.end()
            if quote == ">":
                return at
            begins = html[at - 2] in "= \t\n\r\f"  # elsewhere a quote is a character of the value
            if begins and at < self.unclosed.get(quote, len(html) + 1):
                close = html.find(quote, at)
                if close < 0:
                    self.unclosed[quote] = at
                else:
                    at = close + 1

    def _pop_to(self, depth: int) -> None:
        self.links -= sum(n.tag == "a" for n in self.open[depth:])
        del self.open[depth:]

    def _close(self, names: frozenset, bounds: frozenset) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.open[depth].tag
            if tag in bounds:
                return
            if tag in names:
                self._pop_to(depth)
                if len(names) == 1:
                    return

    def _start(self, tag: str, attributes: str) -> None:
        inline = tag in INLINE
        if not inline:
            self._flush()
            if self.open[-1].tag in INLINE or self.open[-1].tag == "p":
                for depth in range(len(self.open) - 1, 0, -1):
                    if self.open[depth].tag == "p":
                        self._pop_to(depth)
                        break
                    if self.open[depth].tag not in INLINE:
                        break
            if tag in CLOSES:
                self._close(*CLOSES[tag])
        elif tag == "br":
            if self.pieces:
                self._text(" ")
            return
        if tag in VOID or attributes.endswith("/") and tag not in RAW and inline:
            return
        last = self.open[-1]
        if inline:
            self.open.append(Node(tag, last.features, last.near, last.label))
            self.links += tag == "a"
            return
        own, named = _own_features(tag, attributes)
        label = last.label
        if self.marked and self.marked in named:
            label = int(named[self.marked])
        holder = last.tag or "none"
        near = (slot(f"in {tag}"), slot(f"in {holder} {tag}"))
        features = last.features if own <= last.features else last.features | own
        self.open.append(Node(tag, features, near, label))

    def _end(self, tag: str) -> None:
        inline = tag in INLINE
        if not inline:
            self._flush()
        for depth in range(len(self.open) - 1, 0, -1):
            own = self.open[depth].tag
            if own == tag:
                if inline:
                    self.links -= tag == "a"
                    del self.open[depth]
                else:
                    self._pop_to(depth)
                return
            if inline and own not in INLINE:
                return

    def read(self) -> list[Block]:
        html, at, n = self.html, 0, len(self.html)
        while at < n:
            opening = _OPEN.search(html, at)
            if opening is None:
                self._text(html[at:])
                break
            if opening.start() > at:
                self._text(html[at : opening.start()])
            closing, name = opening.groups()
            if name is None:
                if html.startswith("<!--", opening.start()):
                    close = html.find("-->", opening.end() - 2)
                    at = n if close < 0 else close + 3
                else:
                    close = html.find(">", opening.end())
                    at = n if close < 0 else close + 1
                continue
            at = self._end_of_tag(opening.end())
            tag = name.lower()
            if closing:
                self._end(tag)
                continue
            attributes = html[opening.end() : at - 1].strip()
            self._start(tag, attributes)
            if tag in RAW or tag == "template":
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                end = n if close is None else close.start()
                if tag not in UNSEEN:
                    self._text(html[at:end])
                at = end
        self._flush()
        return self.blocks


def blocks_of(html: str, marked: str | None = None) -> list[Block]:
    return Reader(html, marked).read()

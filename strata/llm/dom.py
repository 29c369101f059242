"""A small, forgiving HTML reader: element trees and their text runs.  Its
time grows in proportion to the page, however broken that is."""

from __future__ import annotations

import re
from html import unescape

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)")
_SPECIAL = re.compile("[\"'>]")
_ATTR = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements whose text is never shown as running text.
UNSEEN = RAW | frozenset("head noscript template svg canvas audio video select option optgroup button datalist label "
                           "annotation annotation-xml".split())
#: Elements that run along within a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr img br label input button select object math mi mn mo ms mtext mspace mrow mfrac msqrt mroot "
                   "msup msub msubsup munder mover munderover mmultiscripts mtable mtr mtd mstyle mpadded merror menclose semantics "
                   "annotation annotation-xml".split())
#: Elements that hold the page; text that lies straight in them, with the
#: inline elements in it, becomes an element LOOSE, up to the next block.
FRAME = frozenset("#page html body".split())
LOOSE = "#text"
#: A start tag closes an open element of these kinds ..
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
#: .. up to one of these.
_SCOPE = frozenset("html body table ul ol dl div section article main aside nav header footer form td th select".split())


def _tags(html: str):
    """A function from a position to the next tag from there on: (start, end,
    slash, name, attributes), name None for comments and the like, or None."""
    n, last = len(html), html.rfind(">")
    ends: dict[int, int] = {}  # where a tag ends, by the first quote or > behind its name
    seen = [0, -1]  # a stretch without such up to its end

    def tag_end(pos):
        """The > that is in no quotes, or -1."""
        if not seen[0] <= pos <= seen[1]:
            m = _SPECIAL.search(html, pos)
            seen[:] = pos, m.start() if m else n
        j, way = seen[1], []
        while j < n and j not in ends:
            way.append(j)
            if html[j] == ">":
                ends[j] = j
                break
            close = html.find(html[j], j + 1)
            m = _SPECIAL.search(html, close + 1) if close >= 0 else None
            j = m.start() if m else n
        end = ends[j] if j < n else -1
        for p in way:
            ends[p] = end
        return end

    def following(pos):
        at = html.find("<", pos)
        while at >= 0:
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                return at, end + 3 if end >= 0 else n, "", None, ""
            if at < last:
                if html[at + 1] in "!?":
                    return at, html.find(">", at) + 1, "", None, ""
                m = _NAME.match(html, at)
                end = tag_end(m.end()) if m else -1
                if end >= 0:
                    return at, end + 1, m[1], m[2].lower(), html[m.end():end]
            at = html.find("<", at + 1)
        return None

    return following


class Page:
    """Elements in page order: tag, attrs (raw text), parent, depth, end (the
    element after the last descendant).  ``runs``: (element, text, block):
    text runs, character references decoded, with the number of their block."""

    def __init__(self, html: str):
        self.tag, self.attrs, self.parent, self.depth, self.end = ["#page"], [""], [-1], [0], [0]
        self.runs: list[tuple[int, str, int]] = []
        self._read(html)

    def _open(self, stack, tag, attrs):
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.parent.append(stack[-1])
        self.depth.append(len(stack))
        self.end.append(0)
        self.wall.append(len(stack) if tag == "p" or tag in _SCOPE else self.wall[-1])
        stack.append(len(self.tag) - 1)

    def _read(self, html: str) -> None:
        stack, at, block, n = [0], 0, 0, len(html)
        self.wall = [0]  # for each open element the innermost p or scope up to it, as a place in the stack
        counts: dict[str, int] = {}  # open elements by tag

        def close(k):
            for i in stack[k:]:
                self.end[i] = len(self.tag)
                counts[self.tag[i]] -= 1
            del stack[k:], self.wall[k:]

        def loose():
            if self.tag[stack[-1]] in FRAME:
                self._open(stack, LOOSE, "")
                counts[LOOSE] = counts.get(LOOSE, 0) + 1

        def text(s):
            if s:
                s = unescape(s) if "&" in s else s
                if s.strip():
                    loose()
                self.runs.append((stack[-1], s, block))

        following = _tags(html)
        while found := following(at):
            start, end, slash, tag, attrs = found
            text(html[at:start])
            at = end
            if tag is None:
                continue
            if slash:
                if counts.get(tag):
                    k = len(stack) - 1
                    while self.tag[stack[k]] != tag:
                        k -= 1
                    close(k)
                    block += tag not in INLINE
                continue
            if tag == "br":
                self.runs.append((stack[-1], " ", block))
                continue
            inline = tag in INLINE
            if inline and tag not in UNSEEN and tag not in VOID:
                loose()
            if not inline and tag not in UNSEEN:
                if counts.get(LOOSE) and not counts.get("a"):  # a block ends loose text, but a link may hold it
                    k = len(stack) - 1
                    while k and self.tag[stack[k]] != LOOSE and (self.tag[stack[k]] in INLINE):
                        k -= 1
                    if self.tag[stack[k]] == LOOSE:
                        close(k)
            if not inline:
                block += 1
                if counts.get("p"):  # a block ends an open paragraph
                    k = self.wall[-1]
                    if self.tag[stack[k]] == "p":
                        close(k)
                ended = _CLOSES.get(tag, ())
                if any(counts.get(x) for x in ended):
                    for k in range(len(stack) - 1, 0, -1):
                        own = self.tag[stack[k]]
                        if own in ended:
                            close(k)
                            break
                        if own in _SCOPE:
                            break
            self._open(stack, tag, attrs)
            counts[tag] = counts.get(tag, 0) + 1
            if tag in VOID or attrs.endswith("/") and tag in ("path", "circle", "rect", "use"):
                close(len(stack) - 1)
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                stop = end.start() if end else n
                at = html.find(">", stop) + 1 if end else n
                if end and at == 0:
                    at = n
                close(len(stack) - 1)
        text(html[at:])
        counts["#page"] = 1
        close(0)
        del self.wall


def attributes(raw: str) -> dict[str, str]:
    """The first value of each attribute, decoded."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out

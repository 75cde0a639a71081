"""A page's elements as a tree in document order, and its texts with the block and element they stand in.

Tags are read tolerantly: what a browser would close is closed, stray end tags are passed over, a tag that the end of the
page cuts is dropped. Scripts, styles and other elements that show no prose hold no texts.
"""

from __future__ import annotations

import html
import re
from collections import Counter

# HTML's elements by what a parser does with them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
SILENT = RAW | frozenset("template object svg math canvas select option datalist button audio video map applet head".split())
HEAD = frozenset("title meta link base style script noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rb rt rp s samp small span "
    "strike strong sub sup time tt u var wbr br input button select option optgroup textarea".split()
)
# What a start tag ends, up to the element that holds the list.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
SCOPE = frozenset("table td th caption template".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</[^A-Za-z][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^>]*+)(?P<close>>|\Z)",
    re.S,
)
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I) for tag in RAW}


class Page:
    """``tags``, ``attrs`` and ``parents`` by element, parents first; ``texts`` as (element, block, characters)."""

    def __init__(self, source: str):
        self.tags, self.attrs, self.parents, self.texts = ["#page"], [""], [-1], []
        self.stack, self.open, self.block = [0], Counter(), 0
        at = 0
        while found := TOKEN.search(source, at):
            self._text(source[at : found.start()])
            at = found.end()
            tag = found["tag"]
            if tag is None or not found["close"]:
                continue
            tag = tag.lower()
            if found["end"]:
                self._end(tag)
            else:
                self._start(tag, found["attrs"])
                if tag in RAW:
                    after = _RAW_END[tag].search(source, at)
                    at = after.start() if after else len(source)
        self._text(source[at:])
        del self.stack, self.open

    def _text(self, raw: str) -> None:
        if not raw:
            return
        if self.tags[self.stack[-1]] == "head" and not raw.isspace():
            self._pop(len(self.stack) - 1)
        if not any(self.open[tag] for tag in SILENT & self.open.keys()):
            self.texts.append((self.stack[-1], self.block, html.unescape(raw) if "&" in raw else raw))

    def _pop(self, at: int) -> None:
        for node in self.stack[at:]:
            tag = self.tags[node]
            self.open[tag] -= 1
            if not self.open[tag]:
                del self.open[tag]
        del self.stack[at:]

    def _close(self, tags: set, barriers: frozenset | set) -> None:
        """Ends the innermost open element of these tags that no barrier stands before."""
        if not any(self.open[tag] for tag in tags):
            return
        for at in range(len(self.stack) - 1, 0, -1):
            tag = self.tags[self.stack[at]]
            if tag in tags:
                return self._pop(at)
            if tag in barriers:
                return

    def _start(self, tag: str, attrs: str) -> None:
        if tag in ("html", "body") and tag in self.open:
            return
        if "head" in self.open and tag not in HEAD:
            self._close({"head"}, set())
        if tag == "br":
            self.texts.append((self.stack[-1], self.block, " "))
            return
        if tag not in INLINE and tag not in SILENT:
            self.block += 1
            self._close({"p"}, SCOPE)
        if tag in ENDS:
            self._close(*ENDS[tag])
        node = len(self.tags)
        self.tags.append(tag)
        self.attrs.append(attrs)
        self.parents.append(self.stack[-1])
        if tag not in VOID and not (attrs.endswith("/") and "svg" in self.open):
            self.stack.append(node)
            self.open[tag] += 1

    def _end(self, tag: str) -> None:
        if tag not in INLINE and tag not in SILENT:
            self.block += 1
        if tag in ("html", "body") or tag not in self.open:
            return
        if tag in INLINE:
            # an inline end tag does not reach beyond the block it stands in
            for at in range(len(self.stack) - 1, 0, -1):
                own = self.tags[self.stack[at]]
                if own == tag:
                    return self._pop(at)
                if own not in INLINE:
                    return
        else:
            self._close({tag}, SCOPE - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot") else {"template"})


def blocks(page: Page, kept) -> str:
    """The texts of the elements for which ``kept`` holds: white space is one space, blocks are lines."""
    lines, block, parts = [], None, []
    for node, number, text in page.texts:
        if number != block:
            if line := " ".join("".join(parts).split()):
                lines.append(line)
            block, parts = number, []
        if kept[node]:
            parts.append(text)
    if line := " ".join("".join(parts).split()):
        lines.append(line)
    return "\n".join(lines)

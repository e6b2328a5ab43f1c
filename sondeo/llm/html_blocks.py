"""Leaf blocks of HTML: their tag paths and texts, from markup as broken as it comes."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Elements that begin a block of their own.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead tr ul button label".split()
)
#: Elements whose content is no text of the page, up to their end tag.
RAW = frozenset("script style noscript template title textarea iframe noembed noframes xmp svg select object canvas audio video".split())
#: Of RAW, elements that hold plain characters: only their own end tag, or the page's end, ends them.
PLAIN = frozenset("script style title textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a new one of the same kind ends.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table menu select html body td th article section div".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Leaf:
    path: tuple[str, ...]
    text: str
    linked: int  # characters inside links


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    found = [tag]
    if attributes:
        for m in _NAMED.finditer(attributes):
            found += ["." + w for w in _WORDS.findall((m[1] or m[2] or m[3] or "").lower())]
    return tuple(found)


def _end_of(page: str, tag: str, at: int, parents: set[str]) -> int:
    """Where an element of RAW ends whose start tag ends at `at`: behind its end tag, or before that of a parent if this comes first."""
    if tag in PLAIN:
        end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
        return end.end() if end else len(page)
    inside = [tag]
    for m in iter(lambda: _TOKEN.search(page, at), None):
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name or name in VOID:
            continue
        if not (m[1] or m[4]):
            if name in PLAIN and name != tag:
                at = _end_of(page, name, at, parents)
            elif not (m[3] or m[6] or "").rstrip().endswith("/"):
                inside.append(name)
        elif name in inside:
            del inside[len(inside) - 1 - inside[::-1].index(name) :]
            if not inside:
                return at
        elif name in parents:
            return m.start()
    return len(page)


def leaves(page: str | None) -> list[Leaf]:
    """The blocks of text of a page in their order. Character references are decoded, white space inside a block becomes one space.

    Comments, scripts, styles and the head's title have no blocks; formulas are text inside their block. Unclosed elements
    end where a parent ends, scripts, styles, titles and text areas only with the page; an end tag without its start, and
    a tag cut off by the page's end, count for nothing.
    """
    page = page or ""
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    links = linked = 0
    path: tuple[str, ...] = ()
    inline: list[str] = []  # open elements inside the block

    def end_block() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Leaf(path, text, linked))
            pieces.clear()
        linked = 0

    def repath() -> None:
        nonlocal path
        path = tuple(x for _, names in stack for x in names)

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            pieces.append(page[at:])
            break
        if m.start() > at:
            pieces.append(page[at : m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if not closing and tag in RAW:
            if tag != "svg" or not attributes.rstrip().endswith("/"):
                at = _end_of(page, tag, at, {x for x, _ in stack} | set(inline))
            if tag in BLOCK:
                end_block()
            continue
        if tag == "br" or tag == "wbr":
            pieces.append(" " if tag == "br" else "")
            continue
        if tag not in BLOCK and tag not in VOID:
            if not closing and not attributes.rstrip().endswith("/"):
                inline.append(tag)
            elif closing and tag in inline:
                del inline[len(inline) - 1 - inline[::-1].index(tag) :]
        if tag == "a":
            links = max(0, links - 1) if closing else links + 1
            continue
        if tag not in BLOCK:
            continue
        end_block()
        inline.clear()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if stack[i][0] in ("html", "body") or (tag == "p" and stack[i][0] != "p"):
                    break
        elif tag not in VOID:
            if stack and stack[-1][0] == "p":  # no block stands inside a paragraph
                stack.pop()
            ends = SIBLINGS.get(tag)
            if ends:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        del stack[i:]
                        break
                    if stack[i][0] in SCOPE:
                        break
            if not attributes.rstrip().endswith("/") or tag in ("p", "div"):
                stack.append((tag, _names(tag, attributes)))
        links = 0
        repath()
    end_block()
    return out

"""Leaf blocks of a web page: the text of each block element with the elements around it."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

#: Elements whose content is no markup: all up to their end tag, or else to the end of the page, is dropped.
RAW = "script|style|title|iframe"

#: Elements with markup that is never shown. One that is left open everywhere further on hides nothing.
HIDDEN = frozenset({"template", "noscript"})

#: Drawings and formulas have their own elements, which never end a block; these of them are not shown.
FOREIGN = frozenset({"svg", "math"})
FOREIGN_HIDDEN = frozenset("title desc metadata style script annotation annotation-xml".split())

#: Elements of drawings and formulas with page elements inside, and page elements that end a drawing or formula.
PAGE_INSIDE = frozenset("foreignobject mi mn mo ms mtext".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)

#: Elements inside a line of text; any other element starts and ends a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr svg math mi mn mo ms mtext object noscript template".split()
)

#: Elements without content.
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: Opening one of these closes an open one of the group, unless a stop element lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

#: Elements that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)

MARK = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<raw>{RAW})(?=[\s/>])(?P<set>[^>]*)>"
    r"|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:[^'\">]|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S | re.I,
)
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I) for t in RAW.split("|")}
LAST_END = {t: re.compile(rf".*</{t}(?=[\s/>])", re.S | re.I) for t in HIDDEN}
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PART = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Block(NamedTuple):
    """``path`` has an entry per surrounding element: its tag, and the words of its class, id and role."""

    text: str
    path: tuple[tuple[str, ...], ...]
    linked: int


def element(tag: str, rest: str) -> tuple[str, ...]:
    words = [w.lower() for m in NAMES.finditer(rest) for w in PART.findall(m[1] or m[2] or m[3] or "")] if "=" in rest else []
    return (tag, *dict.fromkeys(words))


def blocks(page: str | None) -> list[Block]:
    """All blocks with text, in page order. White space is one space, character references are decoded.

    Ends that are missing, crossed or cut off are taken as browsers take them, roughly: an end tag closes the
    nearest open element of its name, a tag cut off by the end of the page is dropped. The shown text of drawings
    and formulas, and what stands in an ``object`` for a medium that cannot be loaded, is text of the page.
    """
    out: list[Block] = []
    stack: list[tuple[str, ...]] = []
    inside: list[tuple[bool, bool]] = []  # per open element: not shown, of a drawing or formula
    last_end: dict[str, int] = {}
    held: list[str] = []
    linked, links, at = 0, 0, 0
    page = page or ""

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(held)).split()) if held else ""
        if text:
            out.append(Block(text, tuple(stack), min(linked, len(text))))
        held.clear()
        linked = 0

    def close(i: int):
        nonlocal links
        links -= sum(e[0] == "a" for e in stack[i:])
        del stack[i:], inside[i:]

    def leave():
        """Close the drawing or formula."""
        i = len(inside)
        while i and inside[i - 1][1]:
            i -= 1
        close(i)

    def hides(tag: str) -> bool:
        if tag not in HIDDEN:
            return False
        if tag not in last_end:
            m = LAST_END[tag].match(page)
            last_end[tag] = m.end() if m else 0
        return at < last_end[tag]

    def hold(piece: str):
        nonlocal linked
        if piece and not (inside and inside[-1][0]):
            held.append(piece)
            if links:
                linked += len(piece)

    while m := MARK.search(page, at):
        hold(page[at : m.start()])
        at = m.end()
        tag, rest = m["tag"] or m["raw"], m["rest"] or m["set"] or ""
        if tag is None:
            continue
        tag = tag.lower()
        hidden, foreign = inside[-1] if inside else (False, False)
        if m["raw"] and not foreign:
            at = RAW_END[tag].search(page, at).end()
            continue
        if m["end"]:
            if foreign and tag in ("p", "br"):
                leave()
                foreign = False
            i = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if tag not in INLINE and not (foreign if i < 0 else tag not in PAGE_INSIDE and inside[i][1]):
                flush()
            elif tag == "text":
                hold(" ")
            if i >= 0:
                close(i)
            continue
        if foreign and tag in BREAKOUT:
            leave()
            hidden, foreign = inside[-1] if inside else (False, False)
        if tag == "br":
            hold(" ")
            continue
        if tag not in INLINE and (not foreign or tag == "foreignobject"):
            flush()
            closing, stops = CLOSES.get(tag, ((), ()))
            if tag in ENDS_P:
                closing, stops = {"p"}, {"table", "td", "th", "button", "object"}
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in closing:
                    close(i)
                    break
                if stack[i][0] in stops:
                    break
            hidden, foreign = inside[-1] if inside else (False, False)
        if tag not in EMPTY and not rest.endswith("/"):
            stack.append(element(tag, rest))
            inside.append((hidden or hides(tag) or foreign and tag in FOREIGN_HIDDEN, tag in FOREIGN or foreign and tag not in PAGE_INSIDE))
            links += tag == "a"
    hold(page[at:])
    flush()
    return out

"""Leaf blocks of a web page: runs of text that no block-level tag divides.

Open elements are found by name and by kind, never by a walk over all of them, so a
page whose tags are never closed takes time in proportion to its length.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?:(?P<quoted>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<plain>[^>]*+)(?:>|\Z))",
    re.S,
)
_NAMED = re.compile(r"(?:^|[\s\"'])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+|[0-9]+")

# Element kinds of HTML (fixed values).
RAW = {"script", "style", "title", "textarea", "template", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = set(
    "a abbr acronym audio b bdi bdo big br canvas cite code data del dfn em embed font i img ins kbd map mark "
    "object picture q ruby rb rp rt s samp small span strike strong sub sup svg time tt u var video wbr".split()
)
# A new element of the key ends an open one of these, up to the boundary.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Of a longer path a block keeps this many elements of either end, and this many
# words of a class, id or role are kept.
_PATH_END, _NAME_WORDS = 32, 12
_CLOSERS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}


@dataclass
class Block:
    text: str  # character references decoded, white space as single spaces
    path: tuple[str, ...]  # open block-level elements, outermost first, with the words of class, id and role
    linked: float  # share of the text inside links


def _element(name: str, attributes: str) -> str:
    words = [name]
    if attributes and "=" in attributes:
        for found in _NAMED.findall(attributes):
            words += _PART.findall("".join(found).lower())[:_NAME_WORDS]
    return " ".join(words)


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    names: list[str] = []
    path: list[str] = []  # elements of ``names`` with their words, inline ones empty
    solid: list[int] = []  # where the block-level ones are
    spots: dict[str, list[int]] = defaultdict(list)  # where those of a name are
    parts: list[str] = []
    links = linked = 0
    begun: tuple[str, ...] = ()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, begun, min(1.0, linked / max(1, sum(map(len, parts))))))
            parts.clear()
        linked = 0

    def text(value: str) -> None:
        nonlocal begun, linked
        if value:
            if not parts:
                if value.isspace():
                    return
                shown = solid if len(solid) <= 2 * _PATH_END else solid[:_PATH_END] + solid[-_PATH_END:]
                begun = tuple(path[i] for i in shown)
            parts.append(value)
            if links:
                linked += len(value)

    def pop_to(index: int) -> None:
        nonlocal links
        while len(names) > index:
            name = names.pop()
            spots[name].pop()
            links -= name == "a"
            if path.pop():
                solid.pop()

    at = 0
    while (tag := _TAG.search(page, at)) is not None:
        text(page[at : tag.start()])
        at = tag.end()
        name = tag["name"]
        if name is None:
            continue
        name = name.lower()
        if tag["close"]:
            if name not in INLINE:
                flush()
            own = spots[name]
            # an inline end tag does not reach beyond its block
            if own and (name not in INLINE or not solid or own[-1] > solid[-1]):
                pop_to(own[-1])
            continue
        if name == "br":
            text(" ")
            continue
        if name in RAW:
            end = _CLOSERS[name].search(page, at)
            at = end.start() if end else len(page)
            continue
        if name not in INLINE:
            flush()
            closes, until = ENDS.get(name, (set(), set()))
            boundary = max((spots[u][-1] for u in until if spots[u]), default=-1)
            ended = [spots[c][k] for c in closes if (k := bisect_right(spots[c], boundary)) < len(spots[c])]
            if ended:
                pop_to(min(ended))
            if solid and names[solid[-1]] == "p":
                pop_to(solid[-1])
        if name in VOID:
            continue
        spots[name].append(len(names))
        if name not in INLINE:
            solid.append(len(names))
        names.append(name)
        path.append("" if name in INLINE else _element(name, tag["quoted"] or tag["plain"] or ""))
        links += name == "a"
    text(page[at:])
    flush()
    return out

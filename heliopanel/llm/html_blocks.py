"""HTML to a sequence of leaf blocks, each with its tag path.

One regular expression walks the markup; it never backtracks over a tag and accepts broken
pages (unclosed tags, comments, quotes or scripts run to the end of the page at worst).
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Element names of the HTML standard by role.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "template", "noframes", "xmp")
#: an opening tag of a key closes an open element of its values, up to the nearest element in SCOPE
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"},
          "tr": {"td", "th", "tr"}, "option": {"option"}, "tbody": {"td", "th", "tr", "thead"}, "body": {"head"}}
SCOPE = frozenset("table ul ol dl select html body".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S | re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]       # features of the open elements, outermost first
    linked: int                 # code points inside links


def _element(name: str, rest: str) -> tuple[str, ...]:
    """An element's own features: its name and the words of its class, id and role."""
    out = [name]
    if "=" in rest:
        for m in _NAMES.finditer(rest):
            out += ["." + w for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower())]
    return tuple(out)


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order; texts decoded, white space collapsed, empty ones left out."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []      # open elements, inline ones left out
    parts: list[str] = []
    path: tuple[str, ...] | None = None                 # where the block's text began
    in_link, linked = False, 0

    def add(piece: str) -> None:
        nonlocal path, linked
        piece = html.unescape(piece)
        if path is None and piece.strip():
            path = tuple(f for _, features in stack for f in features)
        if in_link:
            linked += len(piece.strip())
        parts.append(piece)

    def flush() -> None:
        nonlocal path, linked
        if path is not None:
            text = " ".join("".join(parts).split())
            out.append(Block(text, path, min(linked, len(text))))
        parts.clear()
        path, linked = None, 0

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            parts.append(" ")
        elif name in INLINE:
            if name == "a":
                in_link = not m["close"]
        else:
            flush()
            in_link = False
            if m["close"]:
                open_names = [n for n, _ in stack]
                if name in open_names:
                    del stack[len(stack) - 1 - open_names[::-1].index(name):]
            else:
                _close_implied(stack, name)
                if name not in VOID and not m["rest"].endswith("/>"):
                    stack.append((name, _element(name, m["rest"])))
    if at < len(page):
        add(page[at:])
    flush()
    return out


def _close_implied(stack: list, name: str) -> None:
    """Close what an opening tag ends: an open paragraph, or its own kind up to the nearest list or table."""
    shut, cut = CLOSES.get(name, frozenset()), None
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == "p" or stack[i][0] in shut:
            cut = i
        elif stack[i][0] in SCOPE or not shut:
            break
    if cut is not None:
        del stack[cut:]

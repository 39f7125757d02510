"""Blocks of web pages: leaf texts in page order with the path of tags above them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Elements inside a line of text; every other tag ends a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose contents are no text of the page.
SILENT = "script|style|noscript|template|textarea|select|svg|math|iframe|object|canvas"
#: Those of them that may close themselves, and what a tag holds after its name: values in quotes may hold ``<`` and ``>``.
EMPTY = "svg|math"
ATTRS = r"""(?:=\s*+(?:"[^"]*+"|'[^']*+')|[^<>])*+"""
#: A tag that is not closed ends at the next one, or with the page. No part is read in two ways, so time is linear.
END = r"(?:>|(?=<)|\Z)"
#: A new element of the key ends an open one of the values, up to the nearest list, table or section.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIERS = frozenset("ul ol dl table tbody thead article section main div body td th".split())
ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?:{EMPTY})(?=[\s/>]){ATTRS}(?<=/)>|<(?P<silent>{SILENT})(?=[\s/>]){ATTRS}{END}.*?(?:</(?P=silent)\s*+>|\Z)|<[!?][^<>]*+{END}|</(?P<end>[a-zA-Z][^\s/<>]*+)[^<>]*+{END}|<(?P<start>[a-zA-Z][^\s/<>]*+)(?P<attrs>{ATTRS}){END}""",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PARTS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int


def _label(tag: str, attrs: str) -> str:
    """The tag and the words of its class, id and role: ``div ad top``."""
    if "=" not in attrs:
        return tag
    names = [w for m in NAMES.finditer(attrs) for w in PARTS.findall((m[1] or m[2] or m[3] or "").lower())]
    return " ".join([tag, *names]) if names else tag


def blocks(page: str | None) -> list[Block]:
    """All blocks with text: references decoded, white space made single blanks, ends trimmed."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    words: list[str] = []
    links = linked = 0
    at = 0
    page = page or ""

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(words)).split())
        if text:
            out.append(Block(text, tuple(label for _, label in stack), linked))
        words.clear()
        linked = 0

    def close(index: int) -> None:
        del stack[index:]

    for m in TOKEN.finditer(page):
        if m.start() > at:
            words.append(page[at : m.start()])
            linked += (m.start() - at) if links else 0
        at = m.end()
        if m["start"]:
            tag = m["start"].lower()
            if tag in INLINE:
                if tag == "a":
                    links = 1
                elif tag == "br":
                    words.append(" ")
                continue
            flush()
            links = 0
            if tag in ENDS_P:
                found = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"), None)
                if found is not None:
                    close(found)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in IMPLIED.get(tag, ()):
                    close(i)
                    break
                if stack[i][0] in BARRIERS:
                    break
            if tag not in VOID and not m["attrs"].endswith("/"):
                stack.append((tag, _label(tag, m["attrs"])))
        elif m["end"]:
            tag = m["end"].lower()
            if tag in INLINE:
                links = links if tag != "a" else 0
                continue
            flush()
            found = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if found is not None:
                close(found)
        elif not m["silent"]:
            continue
    words.append(page[at:])
    linked += len(page) - at if links else 0
    flush()
    return out

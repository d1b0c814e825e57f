"""Leaf blocks of HTML pages: runs of text between the edges of block elements, with their ancestors."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Elements by their role in the layout of a page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav noscript object ol optgroup option p pre search section select summary svg table tbody td template "
    "tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup and never shown as text of the page.
HIDDEN_TAGS = frozenset("script style title textarea iframe noembed noframes xmp".split())
#: An element of the first kind ends open ones of the second, up to one of the third.
_ITEM = frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})
_TERM = frozenset({"dd", "dt"}), frozenset({"dl"})
_CELL = frozenset({"td", "th"}), frozenset({"table", "tr"})
_ROW = frozenset({"tr", "td", "th"}), frozenset({"table", "tbody", "thead", "tfoot"})
_BODY = frozenset({"tbody", "thead", "tfoot", "tr", "td", "th"}), frozenset({"table"})
_CHOICE = frozenset({"option"}), frozenset({"select"})
ENDS = {"li": _ITEM, "dd": _TERM, "dt": _TERM, "td": _CELL, "th": _CELL, "tr": _ROW, "tbody": _BODY, "thead": _BODY,
        "tfoot": _BODY, "option": _CHOICE, "optgroup": _CHOICE}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Inside these, a paragraph outside stays open.
_SHIELDS = frozenset("button caption object table td th template select".split())
_NO_PARAGRAPH_END = frozenset("option optgroup select tr td th tbody thead tfoot caption button object".split())

_MARKUP = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)"
    r"|<(?P<slash>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?>[^'\">]|\"[^\"]*\"|'[^']*')*+>|[^>]*(?:>|\Z))"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
_CLOSERS = {tag: re.compile(f"</{tag}", re.I) for tag in HIDDEN_TAGS}
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_KEPT = frozenset({"class", "id", "role"})
#: Marks labelled pages: main text or not, the nearest ancestor with it decides.
LABEL = "data-main"


@dataclass(slots=True)
class Block:
    text: str
    #: (tag, class, id, role) of all ancestors, the outermost first.
    path: tuple[tuple[str, str, str, str], ...]
    #: Characters of the text inside links.
    linked: int
    label: bool


def _element(tag: str, rest: str) -> tuple[tuple[str, str, str, str], str | None]:
    found: dict[str, str] = {}
    if "=" in rest:
        for name, *values in _ATTRIBUTE.findall(rest):
            name = name.lower()
            if (name in _KEPT or name == LABEL) and name not in found:
                value = values[0] or values[1] or values[2]
                found[name] = html.unescape(value) if "&" in value else value
    return (tag, found.get("class", ""), found.get("id", ""), found.get("role", "")), found.get(LABEL)


def leaf_blocks(page: str) -> list[Block]:
    """The blocks of a page in order. White space inside a block is one space, ``br`` included;
    character references are decoded; blocks without text are left out. Markup that is cut off, badly
    nested or not closed is read as browsers do, in outline."""
    out: list[Block] = []
    open_tags: list[str] = []
    elements: list[tuple[str, str, str, str]] = []
    labels: list[str | None] = []
    links = linked = 0
    pieces: list[str] = []

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                label = next((x for x in reversed(labels) if x is not None), "0")
                out.append(Block(text, tuple(elements), min(linked, len(text)), label == "1"))
            pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if "&" in text:
            text = html.unescape(text)
        pieces.append(text)
        if links:
            linked += len(text)

    def cut(to: int) -> None:
        nonlocal links
        links -= open_tags[to:].count("a")
        del open_tags[to:], elements[to:], labels[to:]

    def end_open(some: frozenset[str], shields: frozenset[str]) -> None:
        for i in range(len(open_tags) - 1, -1, -1):
            if open_tags[i] in shields:
                return
            if open_tags[i] in some:
                cut(i)
                # A row also ends the cell in it: go on outwards.

    at, size = 0, len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["slash"]:
            if tag in BLOCK_TAGS:
                flush()
            if tag in _HEADINGS:  # ends an open heading of any rank
                tag = next((t for t in reversed(open_tags) if t in _HEADINGS), tag)
            if tag in open_tags:
                i = len(open_tags) - 1 - open_tags[::-1].index(tag)
                if tag in BLOCK_TAGS:
                    cut(i)
                else:  # an inline element may end inside a block that began in it
                    links -= tag == "a"
                    del open_tags[i], elements[i], labels[i]
            continue
        if tag in HIDDEN_TAGS:
            end = _CLOSERS[tag].search(page, at)
            at = end.start() if end else size
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
            if tag not in _NO_PARAGRAPH_END:
                end_open(frozenset({"p"}), _SHIELDS)
            if tag in ENDS:
                end_open(*ENDS[tag])
            if tag in _HEADINGS and open_tags and open_tags[-1] in _HEADINGS:
                cut(len(open_tags) - 1)
        if tag in VOID_TAGS:
            continue
        if tag == "a" and "a" in open_tags:  # links do not nest
            i = len(open_tags) - 1 - open_tags[::-1].index("a")
            links -= 1
            del open_tags[i], elements[i], labels[i]
        element, label = _element(tag, m["rest"])
        open_tags.append(tag)
        elements.append(element)
        labels.append(label)
        links += tag == "a"
    flush()
    return out

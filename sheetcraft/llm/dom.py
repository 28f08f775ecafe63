"""Block tree of an HTML page: elements that hold blocks, and the runs of
inline text between block boundaries as leaves."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Elements by their part in the block structure.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins del kbd label mark nobr q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr img picture source map area track object param"
    " math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt"
    " mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "script style template head title noscript textarea select svg iframe canvas audio video annotation annotation-xml".split()
)
IN_HEAD = frozenset("base link meta noscript script style template title head html".split())  # any other tag ends an open head
RAW = frozenset("script style textarea title iframe noscript".split())
CLOSES = {
    "p": frozenset(("p",)),
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
}
BARRIER = {
    "li": frozenset(("ul", "ol", "menu")),
    "dt": frozenset(("dl",)),
    "dd": frozenset(("dl",)),
    "tr": frozenset(("table",)),
    "td": frozenset(("table", "tr")),
    "th": frozenset(("table", "tr")),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())  # the end of one ends any
IN_P = frozenset("p button".split())  # a block closes a paragraph up to here

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|data-main)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}


@dataclass
class Node:
    parent: int
    tag: str  # "#run" for a run of text
    attributes: str = ""
    text: str = ""
    link_chars: int = 0
    pieces: list[str] = field(default_factory=list)


def block_tree(html: str) -> list[Node]:
    """Nodes in page order, parents first; node 0 stands for the page."""
    nodes = [Node(-1, "#page")]
    stack = [0]
    hidden: list[str] = []  # open elements whose text is not shown, and those in them
    run: Node | None = None
    in_link = False

    def end_run() -> None:
        nonlocal run
        if run is not None:
            run.text = " ".join("".join(run.pieces).split())
            run.pieces = []
            if run.text:
                nodes.append(run)
        run = None

    def add_text(raw: str) -> None:
        nonlocal run
        if hidden == ["head"] and raw.strip():
            hidden.clear()
        if hidden or not raw:
            return
        text = unescape(raw) if "&" in raw else raw
        if run is None:
            run = Node(stack[-1], "#run")
        run.pieces.append(text)
        if in_link:
            run.link_chars += len(text.strip())

    def close(to: int) -> None:
        del stack[to:]

    def nearest(tags: frozenset[str], barrier: frozenset[str] = frozenset()) -> int:
        for k in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[k]].tag
            if tag in tags:
                return k
            if tag in barrier:
                return 0
        return 0

    def after_raw(tag: str, at: int) -> int:
        """Where a raw element ends whose start tag ends at ``at``.  Without
        an end tag, scripts and styles take the rest of the page, a noscript
        nothing, others the text up to the next tag."""
        if end := _RAW_END[tag].search(html, at):
            return end.end()
        if tag == "noscript":
            return at
        following = -1 if tag in ("script", "style") else html.find("<", at)
        return len(html) if following < 0 else following

    at = 0
    while True:
        found = _TOKEN.search(html, at)
        if found is None:
            add_text(html[at:])
            break
        add_text(html[at : found.start()])
        at = found.end()
        ending, name, rest = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
        if not name:
            continue
        tag = name.lower()
        if hidden == ["head"] and not ending and tag not in IN_HEAD:
            hidden.clear()
        if hidden:
            if ending and tag in hidden:
                del hidden[len(hidden) - 1 - hidden[::-1].index(tag) :]
                continue
            if tag != "body" and not (ending and nearest(frozenset((tag,)))):
                if not ending and tag in RAW:
                    at = after_raw(tag, at)
                elif not ending and tag not in VOID and not rest.rstrip().endswith("/"):
                    hidden.append(tag)
                continue
            hidden.clear()  # <body> ends an open <head>, a parent's end what is open in it
        if tag == "br":
            add_text(" ")
        elif tag in INLINE:
            if tag == "a":
                in_link = not ending
        elif ending:
            k = nearest(HEADINGS if tag in HEADINGS else frozenset((tag,)))
            if k:
                end_run()
                in_link = False
                close(k)
        elif tag in UNSEEN:
            end_run()
            if tag in RAW:
                at = after_raw(tag, at)
            elif not rest.rstrip().endswith("/"):
                hidden.append(tag)
        else:
            end_run()
            in_link = False
            k = nearest(frozenset(("p",)), IN_P - {"p"})
            if k:
                close(k)
            if tag in CLOSES and (k := nearest(CLOSES[tag], BARRIER.get(tag, frozenset()))):
                close(k)
            nodes.append(Node(stack[-1], tag, rest))
            if tag not in VOID:
                stack.append(len(nodes) - 1)
    end_run()
    return nodes


def attribute_values(node: Node) -> list[tuple[str, str]]:
    return [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(node.attributes)]

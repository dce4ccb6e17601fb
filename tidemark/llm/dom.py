"""A page's element tree, read leniently: enough structure to tell branches apart and text in order.

Unclosed and stray tags are allowed as browsers allow them: a block closes an open paragraph, list items, cells and
options close their own kind, an end tag closes what is open inside it, and what is open at the end is closed there.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field


_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)>|<[!?/][^>]*>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
_CLOSES_P = BLOCKS - frozenset("br body html option tbody td tfoot th thead tr".split())
_OWN_KIND = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}


@dataclass
class Node:
    tag: str
    names: tuple[str, ...] = ()
    hidden: bool = False
    values: tuple[str, ...] = ()
    ids: tuple[str, ...] = ()
    children: list[Node | str] = field(default_factory=list)

    @property
    def label(self) -> str:
        return f"{self.tag}.{'.'.join(self.names)}"


def _names(attributes: str) -> tuple[tuple[str, ...], bool, tuple[str, ...], tuple[str, ...]]:
    """The words of class, id and role, whether the element is hidden, classes and roles as they stand, and ids."""
    if not attributes.strip():
        return (), False, (), ()
    names, hidden, values, ids = [], False, [], []
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role"):
            names += [t.lower() for t in _TOKENS.findall(value)]
            (ids if key == "id" else values).extend(value.split())
        hidden |= key == "hidden"
    return tuple(names), hidden, tuple(values), tuple(ids)


def words_of_value(value: str) -> list[str]:
    """The words of one class, id or role without numbers."""
    return [t.lower() for t in _TOKENS.findall(value) if not t.isdigit()]


def parse(html: str) -> Node:
    """The tree of a page below a root without a tag. Text is as written, character references included."""
    root = Node("")
    stack, at = [root], 0
    opened: Counter[str] = Counter()

    def cut(depth: int) -> None:
        opened.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    def close(tags: set[str] | frozenset[str], within: set[str] | frozenset[str]) -> None:
        left, lowest = sum(opened[t] for t in tags), 0
        for depth in range(len(stack) - 1, 0, -1):
            if not left or stack[depth].tag in within:
                break
            if stack[depth].tag in tags:
                left, lowest = left - 1, depth
        if lowest:
            cut(lowest)

    while at < len(html):
        m = _TOKEN.search(html, at)
        if m is None:
            stack[-1].children.append(html[at:])
            break
        if m.start() > at:
            stack[-1].children.append(html[at : m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if not opened[tag]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    cut(depth)
                    break
            continue
        if tag in _CLOSES_P:
            close({"p"}, {"table", "td", "th", "li", "div", "section", "article", "blockquote", "button"})
        if tag in _OWN_KIND:
            close(*_OWN_KIND[tag])
        node = Node(tag, *_names(m[3]))
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            node.children.append(html[at : end.start() if end else len(html)])
            at = end.end() if end else len(html)
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            stack.append(node)
            opened[tag] += 1
    return root

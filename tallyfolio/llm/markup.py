"""HTML as a token stream, and a page's tree folded from it.

A page becomes a tree whose siblings of one kind that follow one another, or runs of up to ``PERIOD``
kinds that repeat, are one repeated node; a node's own texts are its slot. Two trees are aligned by the
longest common subsequence of their children's kinds; what one of them lacks is optional. Trees are walked
without Python's call stack, so they may be of any depth.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Callable, Generator

PERIOD = 3

# Names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr del img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section summary table ul".split()
)
CLOSES_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Open elements that a tag ends, unless one of the others was opened in them.
ENDS = {t: (CLOSES_SAME[t], ("ul", "ol", "dl", "table", "select")) for t in CLOSES_SAME}
ENDS |= {t: (("p",), ("table", "td", "th", "button")) for t in CLOSES_P}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|[^<]+|<", re.S
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMED = frozenset(("class", "id", "role", "itemprop"))
_NAME = re.compile(r"[a-z]+(?:[-_]+[a-z]+)*")


class Node:
    """A folded element. ``kind`` is its tag and the names of its class, id and role, each up to its first
    digit, and ``[hidden]`` if it says so; ``texts`` are the places in the page's list of texts that its slot holds."""

    __slots__ = ("kind", "children", "texts")

    def __init__(self, kind: str):
        self.kind, self.children, self.texts = kind, [], []


def _kind(tag: str, attributes: str) -> str:
    if not attributes or not attributes.strip(" /"):
        return tag
    found = []
    for m in _ATTRIBUTE.finditer(attributes):
        key = m[1].lower()
        if key in _NAMED:
            found += [n[0] for n in map(_NAME.match, (m[2] or m[3] or m[4] or "").lower().split()) if n]
        elif key == "hidden" or (key == "aria-hidden" and "true" in m[0].lower()):
            found.append("[hidden]")
    return " ".join([tag, *sorted(set(found))])


def looped(step: Callable[..., Generator], *args):
    """``step(*args)``, a function that yields the arguments of each call of itself and is sent its result."""
    calls, value = [step(*args)], None
    while calls:
        try:
            deeper = calls[-1].send(value)
        except StopIteration as done:
            calls.pop()
            value = done.value
        else:
            calls.append(step(*deeper))
            value = None
    return value


def parse(page: str) -> tuple[Node, list[tuple[str, int]]]:
    """The page's tree, not folded yet, and its texts in page order with the number of their block."""
    root = Node("")
    stack, texts, block, skip_to = [(root, "")], [], 0, 0
    places: dict[str, list[int]] = defaultdict(list)  # where in the stack a tag is open

    def last(tags: tuple) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close(place: int) -> None:
        for _, tag in stack[place:]:
            places[tag].pop()
        del stack[place:]

    for m in _TOKEN.finditer(page):
        if m.start() < skip_to:
            continue
        token = m[0]
        if token[0] != "<" or token == "<":
            node = stack[-1][0]
            node.texts.append(len(texts))
            texts.append((token, block))
            continue
        tag = m[2] or m[5]
        if not tag or token[-1] != ">":  # comments, declarations, and a tag that the page's end cuts off
            continue
        tag = tag.lower()
        if tag not in INLINE:
            block += 1
        if m[1] or m[4]:
            if last((tag,)):
                close(last((tag,)))
            continue
        ended, within = ENDS.get(tag, ((), ()))
        if last(ended) > last(within):
            close(last(ended))
        node = Node(_kind(tag, m[3] or m[6] or ""))
        stack[-1][0].children.append(node)
        if tag in RAW:
            end = re.compile(f"</{tag}[^>]*>", re.I).search(page, m.end())
            skip_to = end.end() if end else len(page)
        elif tag not in VOID and not token.endswith("/>"):
            places[tag].append(len(stack))
            stack.append((node, tag))
    return root, texts


def fold(node: Node) -> Node:
    """Makes repeated children one, at every level. Kinds of children are compared, and what stands below
    them is aligned."""
    todo = [node]
    while todo:
        one = todo.pop()
        one.children = _runs(one.children)
        todo += one.children
    return node


def _runs(children: list[Node]) -> list[Node]:
    period = 1
    while period <= PERIOD and len(children) > period:
        out, i = children[:period], period
        while i < len(children):
            part = children[i : i + period]
            if len(part) == period and all(a.kind == b.kind for a, b in zip(out[-period:], part, strict=False)):
                for a, b in zip(out[-period:], part, strict=False):
                    a.texts += b.texts
                    a.children += b.children
                i += period
            else:
                out.append(children[i])
                i += 1
        period = 1 if len(out) < len(children) and period > 1 else period + 1
        children = out
    return children


def aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of a longest common subsequence."""
    if a == b:
        return [(i, i) for i in range(len(a))]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(m - 1, -1, -1):
            row[j] = below[j + 1] + 1 if a[i] == b[j] else max(below[j], row[j + 1])
    pairs, i, j = [], 0, 0
    while i < n and j < m:
        if a[i] == b[j] and best[i][j] == best[i + 1][j + 1] + 1:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def shape(node: Node, slot: Callable[[Node], str]) -> list:
    """[kind, slot, children] of a folded tree, to be sent around."""

    def step(node: Node) -> Generator:
        children = []
        for c in node.children:
            children.append((yield (c,)))
        return [node.kind, slot(node), children]

    return looped(step, node)


def joined(texts: list[tuple[str, int]], wanted: list[int]) -> str:
    """The wanted texts in page order: references decoded, white space of a block as one space, blocks
    apart by one space."""
    parts, last = [], None
    for i in wanted:
        text, block = texts[i]
        if last is not None and (block != last[1] or i != last[0] + 1):
            parts.append(" ")
        parts.append(text)
        last = (i, block)
    return " ".join(html.unescape("".join(parts)).split())

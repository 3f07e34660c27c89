"""Main text of web pages by wrappers inferred per host: union-free regular expressions over tags.

Each page is folded to a tree of kinds (see ``markup``). A host's wrapper is the alignment of all its
pages: where pages differ, a node is optional or repeated, and a slot's text is either a constant of the
template or a field. Pages of one shape are counted in the task that reads them and sent as that shape
once, so a host with a third of all pages sends little; shapes are aligned in two rounds, by host and
salt and then by host, as a stream. A wrapper grows with the variety of a host's template and not with
its pages.

The wrapper then says which slots hold main text. Menus, headers, footers, asides, forms, scripts,
adverts, notices and comments are known by tag, or by a whole name of class, id or role, its first or its
last word; html, body and main are never barred by such names, an article only where it is a comment's or a related
one's. A page with an article (or main) gives its slots, all of them, and no others; a page without gives
what is left of the body, without lists of links, whatever other pages of its host have. There constants of
the template are left out beside fields, if ``CONSTANT_PAGES`` pages and all that have the element around
them have that text. Pages meet their
host's wrapper in a join that can be split, are aligned with it, and give the texts of its main slots.

Null html gives empty text; a null or odd URL belongs to the host ''. Rows that repeat an id are pages
each. Long pages are read whole. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Generator, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfolio.llm.common import batches, join_groups, text_of, written
from tallyfolio.llm.markup import INLINE, Node, aligned, fold, joined, looped, parse, shape

SHAPES = 2000
SALTS = 16
CONSTANT_PAGES = 20

# Tags and words of class, id or role that mark what isn't main text.
ASIDE_TAGS = frozenset("head script style noscript template nav aside footer form button select option textarea iframe svg canvas object dialog menu input".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted cookie cookies consent gdpr notice alert popup "
    "modal overlay newsletter subscribe subscription signup sidebar side aside menu nav navbar navigation breadcrumb breadcrumbs "
    "footer pagination pager toolbar comment comments respond reply replies disqus share sharing social related recommended "
    "widget login search hidden contentinfo complementary dialog skip".split()
)
# Words that say what kind of box an aside's name is of.
BOX_WORDS = frozenset(
    "left right top bottom center main primary secondary upper lower fixed sticky mobile desktop header heading title body wrapper wrap container "
    "content box block list item items inner outer area section bar rail column col row group panel slot unit form field button buttons link links "
    "icon icons image text message messages policy now this media posts articles stories thread count small large big new inline".split()
)
OTHER_ARTICLES = frozenset("comment comments respond reply replies related recommended".split())
"""Names of article elements that are not the article."""
MODIFIERS = frozenset("has with without no not is are hide show format category cat tag type status layout template theme page".split())
MAIN_TAGS = ("article", "main")
NEVER_ASIDE = frozenset(("html", "body", *MAIN_TAGS))
FIELD = "*"


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(text_of(url), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


# A wrapper is [kind, slot, children, pages, same]: slot is "" without text, a hash of a constant, or FIELD;
# same is the number of pages that have a constant's text.


def _slot(texts: list[tuple[str, int]], node: Node) -> str:
    own = " ".join("".join(texts[i][0] for i in node.texts).split())
    return hashlib.blake2b(own.encode("utf-8", "replace"), digest_size=8).hexdigest() if own else ""


def _same_slot(a: list, b: list) -> tuple[str, int]:
    if a[1] == b[1]:
        return a[1], a[4] + b[4]
    return (FIELD, 0) if a[1] and b[1] else (a[1] or b[1], a[4] + b[4])


def weighed(tree: list, pages: int) -> list:

    def step(tree: list) -> Generator:
        children = []
        for c in tree[2]:
            children.append((yield (c,)))
        return [tree[0], tree[1], children, pages, pages if tree[1] else 0]

    return looped(step, tree)


def merged(a: list, b: list) -> list:
    """The wrapper of both: aligned children are merged, the others are kept, fewer pages marking them
    as optional."""
    return looped(_merging, a, b)


def _merging(a: list, b: list) -> Generator:
    children, i, j = [], 0, 0
    pairs = aligned([c[0] for c in a[2]], [c[0] for c in b[2]])
    for x, y in [*pairs, (len(a[2]), len(b[2]))]:
        children += a[2][i:x] + b[2][j:y]
        if x < len(a[2]):
            children.append((yield a[2][x], b[2][y]))
        i, j = x + 1, y + 1
    out: list = []
    for child in children:  # neighbours of one kind, as unmatched children can leave, are one repeated node
        if out and out[-1][0] == child[0]:
            same = max(out[-1][4], child[4])  # they may be of the same pages
            out[-1] = yield out[-1], child
            out[-1][4] = same
        else:
            out.append(child)
    slot, same = _same_slot(a, b)
    return [a[0], slot, out, a[3] + b[3], same]


def dumped(tree: list) -> str:
    """A wrapper as JSON of its nodes from the top, each with its number of children in their place."""
    out, todo = [], [tree]
    while todo:
        kind, slot, children, *counts = todo.pop()
        out.append([kind, slot, len(children), *counts])
        todo += reversed(children)
    return json.dumps(out)


def loaded(text: str) -> list:
    done: list = []
    for kind, slot, n, *counts in reversed(json.loads(text)):
        done.append([kind, slot, [done.pop() for _ in range(n)], *counts])
    return done[0]


def _aside(name: str) -> bool:
    """A name of class, id or role is an aside's by itself, by its last word unless the first only says how the
    element looks or what stands beside it (``has-sidebar``), or by its first if all others say what box it is:
    ``ad-slot-2`` is one, ``share-price-report`` and ``side-effects`` are not."""
    first, *rest = re.split("[-_]+", name)
    if name in ASIDE_WORDS or (rest and first not in MODIFIERS and rest[-1] in ASIDE_WORDS):
        return True
    return first in ASIDE_WORDS and all(w in ASIDE_WORDS or w in BOX_WORDS or any(c.isdigit() for c in w) for w in rest)


@lru_cache(maxsize=1 << 14)
def _barred(kind: str, in_main: bool) -> bool:
    tag, *names = kind.split(" ")
    if tag in ASIDE_TAGS or (tag == "header" and not in_main):
        return True
    if "[hidden]" in names and tag not in ("html", "body"):
        return True
    if tag == "article" and not OTHER_ARTICLES.isdisjoint(names):
        return True
    return tag not in NEVER_ASIDE and any(map(_aside, names))


def _has_main(node: Node) -> bool:
    """Whether a page has an article or main of its own."""
    todo = [node]
    while todo:
        one = todo.pop()
        if _barred(one.kind, False):
            continue
        if _is_main(one.kind):
            return True
        todo += one.children
    return False


def marked(wrapper: list, need_main: bool) -> list:
    """[kind, main, children, constant]: which nodes are in main text, and a slot text that is none of it, for
    the pages of the host with an article or main (``need_main``) or for those without. A barred node is None in its
    place of main."""

    def fields() -> bool:
        todo = [(wrapper, not need_main)]
        while todo:
            node, inside = todo.pop()
            inside = inside or _is_main(node[0])
            if _barred(node[0], inside):
                continue
            if inside and node[1] == FIELD:
                return True
            todo += [(c, inside) for c in node[2]]
        return False

    varied = fields()

    def links(node: list) -> bool:
        return node[0].split(" ")[0] in ("ul", "ol") and bool(node[2]) and all(not c[1] and [g[0].split(" ")[0] for g in c[2]] == ["a"] for c in node[2])

    def inline(node: list) -> bool:
        """Part of the text around it, and so no constant by itself."""
        return node[0].split(" ")[0] in INLINE

    def mark(node: list, inside: bool, pages: int) -> Generator:
        inside = inside or _is_main(node[0])
        if _barred(node[0], inside) or (not need_main and links(node)):
            return [node[0], None, [], ""]
        # a text that only some pages have may be one article's copies, and is no constant of the template
        constant = not need_main and node[1] not in ("", FIELD) and node[4] >= max(CONSTANT_PAGES, pages) and varied and not inline(node)
        children = []
        for c in node[2]:
            children.append((yield c, inside, node[3]))
        return [node[0], inside, children, node[1] if inside and constant else ""]

    return looped(mark, wrapper, not need_main, wrapper[3])


def _is_main(kind: str) -> bool:
    tag, *names = kind.split(" ")
    return tag in MAIN_TAGS or (tag == "div" and "main" in re.split("[-_ ]+", " ".join(names)))


def marks_of(wrapper: list) -> dict[bool, list]:
    return {need_main: marked(wrapper, need_main) for need_main in (False, True)}


def extract(page: str, marks: dict[bool, list]) -> str:
    """The texts of a page in the main slots of its host's wrapper, as marked for pages like it. Elements the alignment pairs with nothing
    are judged by themselves, as part of what is around them, so no text depends on which of several equal
    kinds it picks; a paired slot is left out as a constant only if it has the constant's text."""
    root, texts = parse(page)
    wanted: list[int] = []
    tree = fold(root)
    need_main = _has_main(tree)

    def links(node: Node) -> bool:
        return (
            node.kind.split(" ")[0] in ("ul", "ol") and bool(node.children)
            and all(not _slot(texts, c) and [g.kind.split(" ")[0] for g in c.children] == ["a"] for c in node.children)
        )

    todo: list = [(tree, marks[need_main], False)]
    while todo:
        node, mark, inside = todo.pop()
        if mark is None:
            inside = inside or _is_main(node.kind)
            if _barred(node.kind, inside) or (not need_main and links(node)):
                continue
            if inside:
                wanted.extend(node.texts)
            todo += [(child, None, inside) for child in node.children]
        elif mark[1] is not None:
            if mark[1] and not (mark[3] and _slot(texts, node) == mark[3]):
                wanted.extend(node.texts)
            paired = dict(aligned([c.kind for c in node.children], [c[0] for c in mark[2]]))
            todo += [(child, mark[2][paired[i]] if i in paired else None, mark[1]) for i, child in enumerate(node.children)]
    return joined(texts, sorted(wanted))


# ---- Spark ----


def _shapes(pages: DataFrame) -> DataFrame:
    """(host, wrapper): each distinct shape of a host in a task, with its pages."""

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], list] = {}

        def rows() -> pa.RecordBatch:
            out = [{"host": k[0], "wrapper": dumped(v)} for k, v in found.items()]
            found.clear()
            return pa.RecordBatch.from_pylist(out, pa.schema([("host", pa.string()), ("wrapper", pa.string())]))

        for frame in batches(frames, "html"):
            for host, page in zip(frame.column("host").to_pylist(), frame.column("html").to_pylist(), strict=True):
                root, texts = parse(page)
                tree = shape(fold(root), lambda node, texts=texts: _slot(texts, node))
                key = host, _kinds(tree)
                one = weighed(tree, 1)
                found[key] = merged(found[key], one) if key in found else one
            if len(found) > SHAPES:
                yield rows()
        yield rows()

    return pages.select("host", "html").mapInArrow(read, "host string, wrapper string")


def _kinds(tree: list) -> str:
    out, todo = [], [tree]
    while todo:
        node = todo.pop()
        out.append([node[0], len(node[2])])
        todo += reversed(node[2])
    return json.dumps(out)


def _aligned(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers of one host follow one another; each host's become one."""
    schema = pa.schema([("host", pa.string()), ("wrapper", pa.string())])
    host, held = None, None
    for frame in frames:
        out = []
        for h, w in zip(frame.column("host").to_pylist(), frame.column("wrapper").to_pylist(), strict=True):
            if h == host:
                held = merged(held, loaded(w))
                continue
            if held is not None:
                out.append({"host": host, "wrapper": dumped(held)})
            host, held = h, loaded(w)
        yield pa.RecordBatch.from_pylist(out, schema)
    if held is not None:
        yield pa.RecordBatch.from_pylist([{"host": host, "wrapper": dumped(held)}], schema)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) from pages (host, html), as a table in the shared folder."""
    salted = _shapes(pages).withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    some = salted.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper").select("host", "wrapper")
    some = some.mapInArrow(_aligned, "host string, wrapper string")
    whole = some.repartition("host").sortWithinPartitions("host", "wrapper")
    return written(whole.mapInArrow(_aligned, "host string, wrapper string"), "wrappers")


def main_text(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: id, url and ``text``, the main text, empty if there is none."""
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), host_of(url).alias("host"), text_of(html).alias("html"))

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks: dict[str, dict] = {}
        for frame in batches(frames, "html"):
            texts = []
            for page, wrapper in zip(frame.column("html").to_pylist(), frame.column("wrapper").to_pylist(), strict=True):
                if wrapper not in marks:
                    if len(marks) > SHAPES:
                        marks.clear()
                    marks[wrapper] = marks_of(loaded(wrapper))
                texts.append(extract(page, marks[wrapper]))
            yield pa.RecordBatch.from_arrays([frame.column("id"), frame.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])

    found = join_groups(rows, wrappers(rows), ["host"], "inner").select("id", "url", "html", "wrapper")
    kind = pages.select(F.col(id).alias("id")).schema["id"].dataType.simpleString()
    return found.mapInArrow(read, f"id {kind}, url string, text string").withColumnRenamed("id", id).withColumnRenamed("url", url)

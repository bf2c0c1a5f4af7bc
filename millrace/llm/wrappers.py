"""Main text of web pages by wrapper induction: aligned trees of same-host pages.

Every page is aligned with two other pages of its host by simple tree matching:
two nodes of one tag match, and their children are matched in order so that the
number of matched pairs is largest. Nodes that both have with equal text are
template, all others are slots: a passage that happens to be in one of them isn't. Pages of equal
markup tell nothing about each other and never meet; a host of only one
markup has slots only, and so has a page whose every node is template.

The content is the container that the slots' text leads to: from the page down to the
child that holds most of it, as long as no block of slot text stands beside that child. A
lone article or main element is taken at once if it holds most of the slots' text.
Within the content, menus, notices, forms and the like are left out by their
tags, names and roles, and template nodes too, unless the page marks the
container as its article.

A host's reference pages are three fixed ones; all pages of a host stream past them,
whatever their number. Pages of a large host are dealt into parts, each of which gets the references.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import one
from millrace.llm.url_filters import url_host
from millrace.session import stage

MAX_REFERENCES = 200_000  # keys of reference pages, and large hosts, broadcast up to this number
REFERENCES = 3  # pages of a host that the others are aligned with
HOST_PART = 500  # pages of a host dealt to one part
MATCH_CELLS = 1_000_000  # cells kept of a table of children; of a larger one they are computed again on the way back
WIDE = 32  # children from which on a row of the matching is computed by numpy, with the same numbers

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img br".split()
)
_CONTAINERS = frozenset("html body div section article main center table tbody tr td".split())
_ARTICLE = frozenset(("article", "main"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_DROPPED = _RAW | frozenset(
    "head nav footer aside form button select option input menu dialog svg canvas object audio video map math".split()
)
_DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle banner sponsor sponsored sponsors promo promotion "
    "cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social sidebar side menu nav navbar navigation breadcrumb breadcrumbs header footer masthead "
    "topbar toolbar comment comments disqus reply replies respond related recommended recommendations widget widgets "
    "search pagination pager copyright disclaimer skip".split()
)
# Parts of names that go with those above: ``site-header``, ``ad-slot``, ``nav-main``. A name with any
# other part (``has-sidebar``, ``header-image``) names something else.
_NAME_FILL = frozenset(
    "site main top bottom left right global primary secondary sub box bar wrap wrapper container list block area slot links inner outer".split()
)
_NEVER_NAMED = frozenset("#page html body article main".split())
_PARAGRAPHS = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote ul ol dl table figure".split())
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
# Start tags that end an open paragraph, and those that end an open sibling of their own kind.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
_SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tbody", "thead", "tr"), "thead": ("tbody",), "tfoot": ("tbody", "thead", "tr"),
}
_SCOPE = frozenset("html body table td th ul ol dl div section article main aside nav header footer form blockquote".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>?", re.S
)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?<![\w-])(?:hidden(?![\w-])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_PARTS = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "items", "kids", "dropped", "named", "own", "size", "shape", "digest")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag = tag
        self.items: list[Node | str] = []  # in page order
        self.kids: list[Node] = []
        self.dropped = tag in _DROPPED
        self.named = bool(attributes) and tag not in _NEVER_NAMED and _boilerplate(attributes)
        self.own = ""
        self.size = 1
        self.shape = 0
        self.digest = 0

    def add(self, node: Node) -> None:
        self.items.append(node)
        self.kids.append(node)


def _boilerplate(attributes: str) -> bool:
    for kind, *values in _NAMES.findall(attributes):
        value = "".join(values).lower()
        if kind.lower() == "role":
            if value.strip() in _DROPPED_ROLES:
                return True
        elif any(map(_names_boilerplate, value.split())):
            return True
    return bool(_HIDDEN.search(attributes))


def _names_boilerplate(name: str) -> bool:
    parts = _PARTS.findall(name)
    return not _DROPPED_NAMES.isdisjoint(parts) and all(p in _DROPPED_NAMES or p in _NAME_FILL for p in parts)


def parse(html: str) -> Node:
    """Element tree of a page, however broken: unknown ends are ignored, open elements end with the page."""
    root = Node("#page")
    stack, opened = [root], Counter()
    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            stack[-1].items.append(unescape(html[at:]))
            break
        if lt > at:
            stack[-1].items.append(unescape(html[at:lt]))
        m = _MARKUP.match(html, lt)
        if not m:
            stack[-1].items.append("<")
            at = lt + 1
            continue
        at = m.end()
        if m[1]:
            if opened[m[1].lower()]:
                _close(stack, m[1].lower(), opened)
        elif m[2]:
            tag = m[2].lower()
            if tag in _ENDS_P and opened["p"]:
                _implied(stack, ("p",), opened)
            if tag in _SIBLINGS and any(opened[t] for t in _SIBLINGS[tag]):
                _implied(stack, _SIBLINGS[tag], opened)
            node = Node(tag, m[3])
            stack[-1].add(node)
            if tag in _RAW:
                end = re.compile(f"</{tag}", re.I).search(html, at)
                at = n if end is None else end.start()
                if end is not None:
                    close = html.find(">", at)
                    at = n if close < 0 else close + 1
            elif tag not in _VOID:
                stack.append(node)
                opened[tag] += 1
    _summarise(root)
    return root


def _cut(stack: list[Node], at: int, opened: Counter) -> None:
    for node in stack[at:]:
        opened[node.tag] -= 1
    del stack[at:]


def _implied(stack: list[Node], tags: tuple[str, ...], opened: Counter) -> None:
    """Close the open elements of the tags, if no scope lies between."""
    i = len(stack) - 1
    while i:
        if stack[i].tag in tags:
            _cut(stack, i, opened)
            if "p" in tags or stack[-1].tag not in tags:
                return
            i = len(stack)
        elif stack[i].tag in _SCOPE:
            return
        i -= 1


def _close(stack: list[Node], tag: str, opened: Counter) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            return _cut(stack, i, opened)
        if tag in _INLINE and stack[i].tag not in _INLINE:
            return


def _postorder(root: Node) -> list[Node]:
    """All nodes, children before their parent; a loop, as pages may be nested to any depth."""
    out, open_nodes = [], [root]
    while open_nodes:
        node = open_nodes.pop()
        out.append(node)
        open_nodes.extend(node.kids)
    return out[::-1]


def _summarise(root: Node) -> None:
    nodes, text, paragraphs = _postorder(root), {}, {}
    for node in nodes:
        node.own = " ".join("".join(x if isinstance(x, str) else " " for x in node.items).split())
        node.size = 1 + sum(k.size for k in node.kids)
        node.shape = hash((node.tag, *[k.shape for k in node.kids]))
        node.digest = hash((node.tag, node.own, tuple(k.digest for k in node.kids)))
        text[id(node)] = 0 if node.dropped else len(node.own) + sum(text[id(k)] for k in node.kids)
        paragraphs[id(node)] = not node.dropped and (node.tag in _PARAGRAPHS or any(paragraphs[id(k)] for k in node.kids))
    for node in nodes:  # a name is no reason to leave out most of the page
        most = node.named and 2 * text[id(node)] > text[id(root)] and paragraphs[id(node)]
        node.dropped = node.dropped or node.named and not most


def align(a: Node, b: Node, constant: set[int]) -> int:
    """Simple tree matching of two nodes of one tag; ids of a's nodes that are equal in b go to ``constant``."""
    pairs = _matching(a, b)
    for x, y in pairs:
        if x.own == y.own:
            constant.add(id(x))
    return len(pairs)


def _ends(a: Node, b: Node) -> tuple[int, int]:
    """How many children are equal at both ends. They match each other: no matching is larger without them."""
    n = min(len(a.kids), len(b.kids))
    head = next((i for i in range(n) if a.kids[i].digest != b.kids[i].digest), n)
    tail = next((i for i in range(n - head) if a.kids[-1 - i].digest != b.kids[-1 - i].digest), n - head)
    return head, tail


def _alike(xs: list[Node], ys: list[Node]) -> int:
    """How many nodes at the start have equal shapes, in order: the way back through the table pairs them too."""
    n = min(len(xs), len(ys))
    return next((i for i in range(n) if xs[i].shape != ys[i].shape), n)


def _weights(a: Node, b: Node) -> dict[tuple[int, int], int]:
    """Sizes of the largest matchings of all pairs of shapes below (a, b) that can meet, smaller shapes first.

    A size depends on the two shapes only, however many nodes have them.
    """
    sizes: dict[tuple[int, int], int] = {}
    found, open_pairs, seen = [], [(a, b)], set()
    while open_pairs:
        x, y = open_pairs.pop()
        found.append((x, y))
        for pair in _met(x, y):
            key = pair[0].shape, pair[1].shape
            if key not in seen:
                seen.add(key)
                open_pairs.append(pair)
    found.sort(key=lambda pair: pair[0].size + pair[1].size)
    for x, y in found[:-1]:  # the last is (a, b) itself
        head = _alike(x.kids, y.kids)
        for row in _rows(x.kids[head:], y.kids[head:], sizes):
            most = int(row[-1])
        sizes[x.shape, y.shape] = 1 + sum(k.size for k in x.kids[:head]) + most
    return sizes


def _met(x: Node, y: Node) -> Iterator[tuple[Node, Node]]:
    """One pair of children with children for each two unequal shapes of one tag."""
    head = _alike(x.kids, y.kids)
    xs, ys = x.kids[head:], y.kids[head:]
    by_tag: dict[str, dict[int, Node]] = {}
    for q in ys:
        if q.kids:
            by_tag.setdefault(q.tag, {})[q.shape] = q
    for p in {p.shape: p for p in xs if p.kids}.values():
        yield from ((p, q) for q in by_tag.get(p.tag, {}).values() if q.shape != p.shape)


def _weight(x: Node, y: Node, sizes: dict[tuple[int, int], int]) -> int:
    if x.shape == y.shape:
        return x.size
    if x.tag != y.tag:
        return 0
    return sizes[x.shape, y.shape] if x.kids and y.kids else 1


def _rows(xs: list[Node], ys: list[Node], sizes: dict, above: Sequence[int] | None = None) -> Iterator[Sequence[int]]:
    """Rows of the table of largest matchings of the first i of ``xs`` with the first j of ``ys``, from
    ``above`` on (the row of no child)."""
    if len(ys) < WIDE:
        above = above or [0] * (len(ys) + 1)
        yield above
        for p in xs:
            row, best = [0], 0
            for j, q in enumerate(ys):
                w = above[j] + _weight(p, q, sizes) if p.tag == q.tag else 0
                if above[j + 1] > best:
                    best = above[j + 1]
                if w > best:
                    best = w
                row.append(best)
            yield row
            above = row
        return
    above = np.zeros(len(ys) + 1, np.int32) if above is None else above
    yield above
    places: dict[int, int] = {}
    shape_of = np.array([places.setdefault(q.shape, len(places)) for q in ys])
    kinds = list({q.shape: q for q in reversed(ys)}.values())
    kinds.sort(key=lambda q: places[q.shape])
    last, weights = None, None
    for p in xs:
        if p.shape != last:
            last, weights = p.shape, np.array([_weight(p, q, sizes) for q in kinds], np.int32)[shape_of]
        row = np.zeros_like(above)
        np.maximum.accumulate(np.maximum(above[1:], above[:-1] + weights), out=row[1:])
        yield row
        above = row


def _in_order(xs: list[Node], ys: list[Node], sizes: dict) -> Iterator[tuple[Node, Node]]:
    """The pairs of the largest matching of two lists of children, last first.

    Of a large table every ``step``-th row is kept, and those between are computed again on the way
    back: memory grows with the root of its height, and two lists of any length are matched exactly.
    """
    i, j = len(xs), len(ys)
    if not i or not j:
        return
    if i * j <= MATCH_CELLS:
        start, rows = 0, list(_rows(xs, ys, sizes))
    else:
        start, rows, step = i, [], math.isqrt(i)
        kept = [row for k, row in enumerate(_rows(xs, ys, sizes)) if k % step == 0]
    while i and j:
        if i - 1 < start:
            start = (i - 1) // step * step
            rows = list(_rows(xs[start:i], ys, sizes, kept[start // step]))
        here, above = rows[i - start], rows[i - 1 - start]
        if here[j] == above[j]:
            i -= 1
        elif here[j] == here[j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            yield xs[i], ys[j]


def _matching(a: Node, b: Node) -> list[tuple[Node, Node]]:
    sizes = _weights(a, b)
    pairs, open_pairs = [], [(a, b)]
    while open_pairs:
        x, y = open_pairs.pop()
        pairs.append((x, y))
        if x.kids and y.kids:
            head, tail = _ends(x, y)
            xs, ys = x.kids[head : len(x.kids) - tail], y.kids[head : len(y.kids) - tail]
            open_pairs.extend(zip(x.kids[len(x.kids) - tail :], y.kids[len(y.kids) - tail :]))
            head += (alike := _alike(xs, ys))
            open_pairs.extend(zip(x.kids[:head], y.kids[:head]))
            open_pairs.extend(_in_order(xs[alike:], ys[alike:], sizes))
    return pairs


def _slot_text(page: Node, constant: set[int]) -> dict[int, int]:
    """Characters of every subtree that are in slots."""
    sums: dict[int, int] = {}
    for node in _postorder(page):
        own = 0 if id(node) in constant else len(node.own)
        sums[id(node)] = 0 if node.dropped else own + sum(sums[id(k)] for k in node.kids)
    return sums


def content_root(page: Node, constant: set[int], share: float = 0.8) -> Node:
    """The container that most of the slots' text leads to; never inside an article.

    The way ends where the slots' text is in several children, or where blocks of it (a title, a
    lead, a part of the same tag) stand beside the child that holds most.
    """
    sums = _slot_text(page, constant)
    marked = [n for n in _outermost(page) if sums[id(n)]]
    if len(marked) == 1 and 2 * sums[id(marked[0])] >= sums[id(page)]:
        return marked[0]
    node = page
    while node.tag not in _ARTICLE:
        best = max((k for k in node.kids if k.tag in _CONTAINERS), key=lambda k: sums[id(k)], default=None)
        if best is None or not sums[id(best)] or sums[id(best)] < share * sums[id(node)]:
            break
        beside = [k for k in node.kids if k is not best and sums[id(k)]]
        if any(k.tag in _PARAGRAPHS or k.tag == best.tag == "section" for k in beside):
            break
        node = best
    return node


def _outermost(root: Node) -> Iterator[Node]:
    open_nodes = [root]
    while open_nodes:
        node = open_nodes.pop()
        for kid in node.kids:
            if not kid.dropped:
                if kid.tag in _ARTICLE:
                    yield kid
                else:
                    open_nodes.append(kid)


def blocks(root: Node, constant: set[int]) -> list[str]:
    """Text blocks of the content, white space collapsed, in page order."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    # What is left to do, last first: a text, a node with whether it is in an article, or a block's end.
    todo: list = [(root, root.tag in _ARTICLE)]
    while todo:
        step = todo.pop()
        if step is None:
            flush()
        elif isinstance(step, str):
            line.append(step)
        else:
            node, article = step
            template = not article and id(node) in constant
            after: list = []
            for x in node.items:
                if isinstance(x, str):
                    if not template:
                        after.append(x)
                elif x.tag == "br":
                    after.append(" ")
                elif x.dropped:
                    if x.tag not in _INLINE:
                        after.append(None)
                elif x.tag == "header":
                    after.append(None)
                    for kid in x.kids:
                        if article and kid.tag in _HEADINGS:
                            after += [(kid, article), None]
                elif x.tag in _INLINE:
                    after.append((x, article))
                else:
                    after += [None, (x, article or x.tag in _ARTICLE), None]
            todo.extend(reversed(after))
    flush()
    return out


def main_text(html: str, references: list[Node]) -> str:
    """The text of a page's content, given the trees of other pages of its host."""
    page = parse(html)
    shared: list[set[int]] = []
    for reference in references:
        shared.append(set())
        align(page, reference, shared[-1])
    constant = set.intersection(*shared) if shared else set()
    if not _slot_text(page, constant)[id(page)]:
        constant = set()
    return "\n\n".join(blocks(content_root(page, constant), constant))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every row. A NULL or empty page has an empty text; pages
    without a host are aligned with each other; repeated rows are extracted each."""
    own = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")
    ).withColumn("host", url_host(F.coalesce(F.col("url"), F.lit("")))).withColumn("key", F.xxhash64("html"))
    order = Window.partitionBy("host").orderBy("key")
    chosen = own.filter("html <> ''").select("host", "key").distinct().withColumn("place", F.row_number().over(order))
    chosen = _small(stage(chosen.filter(F.col("place") <= REFERENCES).drop("place"), "chosen"))
    found = own.select("host", "key", "html").join(chosen, ["host", "key"]).dropDuplicates(["host", "key"])
    # Parts of a host: one for most, and as many as its pages need for a large one.
    parts = own.groupBy("host").agg((F.count(F.lit(1)) / HOST_PART).cast("int").alias("parts")).filter("parts > 0")
    parts = _small(stage(parts, "hosts"))
    n = F.coalesce("parts", F.lit(0)) + 1
    refs = found.groupBy("host").agg(F.collect_list(F.struct("key", "html")).alias("references")).join(parts, "host", "left")
    refs = refs.select("host", F.explode(F.sequence(F.lit(0), n - 1)).alias("part"), "references")
    dealt = own.join(parts, "host", "left").withColumn("part", F.pmod(F.xxhash64("page_id", "url", "key"), n).cast("int"))
    joined = dealt.join(refs, ["host", "part"], "left").select(
        "page_id", "url", "html", F.slice(F.filter("references", lambda r: r["key"] != F.col("key")), 1, REFERENCES - 1)["html"].alias("references")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, Node] = {}  # of the few pages next to each other
        for batch in batches:
            out = []
            for html, references in zip(one(batch.column("html")).to_pylist(), one(batch.column("references")).to_pylist()):
                for reference in references or ():
                    if reference not in last:
                        if len(last) > 5:
                            last.clear()
                        last[reference] = parse(reference)
                out.append(main_text(html, [last[r] if r in last else parse(r) for r in references or ()]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    types = dict(own.dtypes)
    return joined.mapInArrow(extract, f"page_id {types['page_id']}, url {types['url']}, text string")


def _small(staged: DataFrame) -> DataFrame:
    """A staged table to be broadcast, if it has few rows."""
    return F.broadcast(staged) if staged.limit(MAX_REFERENCES + 1).count() <= MAX_REFERENCES else staged

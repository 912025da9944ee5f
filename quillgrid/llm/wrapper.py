"""Main text of web pages by wrapper induction.

Pages of a host come from the same templates. Its different pages are read in
*chunks* of near-equal size, at most ``CHUNK``; in each, every page's tree of block elements is
aligned with that of a reference page by simple tree matching. Text that stands
at the same node in most of the pages is template; slots whose text varies are
content. What elements and their names declare to be menus, adverts, comments
and the like is no content either, and where a page marks its article, content
is sought there alone.

The pages move once, by host. A host is one task's work unless its different pages
are more than ``1 / HOT`` of all; such hosts, at most ``HOT`` of them, are salted.
Of a page with many copies one is read, and the copies get its text by a join.
Tasks read their pages as a stream and hold one chunk.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quillgrid.llm.common import checkpointed, own_names

CHUNK, HOT = 200, 2000
COPIES, MANY = 10, 20_000
"""Copies of a page that may move with it: up to COPIES, or a MANYth of all pages."""
CONSTANT, LEAST_PAGES = 0.8, 4
"""Share of aligned pages, and their number, from which a text at a node is template."""
CELLS = 40_000
"""Pairs of children up to which two lists are aligned in one table; longer ones are halved first."""
BETWEEN = "\n\n"
"""What stands between two blocks of text."""
KNOWN = 1_000_000
"""Pairs of forms that are remembered from page to page."""

# Elements of HTML, fixed values.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - set("body html caption tbody td tfoot th thead tr legend".split())
NOT_P = BLOCK - {"p"}
SIBLINGS = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "td": "tr table", "th": "tr table", "tr": "table", "option": "select"}
NO_TEXT = set(
    "head script style noscript template iframe object svg math canvas audio video select option button textarea input nav aside footer form menu search dialog".split()
)
# Names that mark what is no article, fixed words; parts of class, id and role.
NO_CONTENT = set(
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent notice alert popup modal nav navbar"
    " navigation menu breadcrumb breadcrumbs sidebar aside widget footer masthead header comment comments disqus reply replies share sharing"
    " social related recommended newsletter subscribe signup login search pagination pager toolbar complementary contentinfo".split()
)
# Words that such a name may hold beside them and still mark the same, fixed words.
STRUCTURE = set(
    "area articles bar bars block box button buttons container form group icons inner item items label left link links list outer panel posts"
    " right section slot stories text title top bottom unit wrap wrapper".split()
)
PARTS = re.compile(r"[a-z]+")
ARTICLE = {"article", "main"}
PROSE = set("p blockquote pre h1 h2 h3 h4 h5 h6".split())


class Node:
    """A block element: its block children and its own stretches of text, in order."""

    __slots__ = ("tag", "skip", "items", "kids", "buffer", "linked", "links")

    def __init__(self, tag: str, skip: bool) -> None:
        self.tag, self.skip = tag, skip
        self.items: list = []  # Node, or (text, share of it in links)
        self.kids: list[Node] = []
        self.buffer: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.items.append((text, min(1.0, self.linked / len(text))))
            self.buffer, self.linked = [], 0

    def blocks(self) -> list[tuple[str, float]]:
        return [x for x in self.items if not isinstance(x, Node)]


def is_skipped(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether an element is declared to hold no article text."""
    if tag in NO_TEXT or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body") or tag in ARTICLE and not in_article:
        return any(k == "hidden" for k, _ in attrs)
    told = [PARTS.findall(w) for k, v in attrs if k in ("class", "id", "role") and v for w in v.lower().split()]
    if in_article:
        # A name counts as a whole here: social-history and related-work may well be prose.
        told = [parts for parts in told if parts != ["header"] and all(w in NO_CONTENT or w in STRUCTURE for w in parts)]
    return any(w in NO_CONTENT for parts in told for w in parts) or any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)


class Page(HTMLParser):
    """Builds the tree of block elements, as forgiving as browsers are."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", False)
        self.open: list[tuple[str, Node]] = [("html", self.root)]  # inline elements share their block's node
        self.links = 0
        self.count: Counter = Counter()  # open elements by name: deep pages are not searched for what is not open
        self.feed(html)
        self.close()
        for _, node in self.open:
            node.flush()

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in CLOSES_P:
            self._close("p", stop=NOT_P)
        if tag in SIBLINGS:
            same = {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}
            for other in same:
                self._close(other, stop=set(SIBLINGS[tag].split()))
        top = self.open[-1][1]
        if tag in VOID:
            if tag in ("br", "hr"):
                top.buffer.append("\n")
            if tag == "hr":
                top.flush()
            return
        if tag == "html":
            return
        in_article = any(self.count[t] for t in ARTICLE)
        skip = top.skip or is_skipped(tag, attrs, in_article)
        if tag in BLOCK or skip != top.skip:
            if tag in BLOCK:
                top.flush()
            node = Node(tag, skip)
            top.items.append(node)
            top.kids.append(node)
            self.open.append((tag, node))
        else:
            self.open.append((tag, top))
        self.count[tag] += 1
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in ("html", "body"):
            self._close(tag, stop=set())

    def _close(self, tag: str, stop: set[str]) -> None:
        if not self.count[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i][0]
            if name == tag:
                for closed, node in self.open[i:]:
                    self.links -= closed == "a"
                    self.count[closed] -= 1
                    node.flush()
                del self.open[i:]
                return
            if name in stop:
                return

    def handle_data(self, data: str) -> None:
        node = self.open[-1][1]
        node.buffer.append(data)
        if self.links:
            node.linked += len(data.strip())


# ---- simple tree matching --------------------------------------------------

class Matcher:
    """Aligns trees. Nodes of the same form, in elements alone, have one number, and
    what two forms have in common is told once."""

    def __init__(self) -> None:
        self.forms: dict[tuple, int] = {}
        self.kids: list[tuple[int, ...]] = []
        self.roots: list[tuple[str, bool]] = []
        self.nodes: list[int] = []
        self.known: dict[tuple[int, int], int] = {}

    def form(self, tree: Node) -> dict[int, int]:
        """The form of each node of a tree, by its id; leaves first."""
        order, stack = [], [tree]
        while stack:
            node = stack.pop()
            order.append(node)
            stack += node.kids
        found: dict[int, int] = {}
        for node in reversed(order):
            key = (node.tag, node.skip, tuple(found[id(k)] for k in node.kids))
            number = self.forms.get(key)
            if number is None:
                number = self.forms[key] = len(self.kids)
                self.kids.append(key[2])
                self.roots.append(key[:2])
                self.nodes.append(1 + sum(self.nodes[k] for k in key[2]))
            found[id(node)] = number
        return found

    def weight(self, a: int, b: int) -> int | None:
        """The size of the alignment of two forms, None if it has to be found first."""
        if a == b:
            return self.nodes[a]
        if self.roots[a] != self.roots[b]:
            return 0
        if not self.kids[a] or not self.kids[b]:
            return 1
        return self.known.get((a, b))

    def learn(self, a: int, b: int) -> int:
        """``weight``, found from the leaves."""
        stack = [(a, b)]
        while stack:
            x, y = stack[-1]
            if self.weight(x, y) is None:
                front, left, right = self._middle(x, y)
                open_ = [(u, v) for u in set(left) for v in set(right) if self.weight(u, v) is None]
                if open_:
                    stack += open_
                    continue
                back = self.kids[x][front + len(left) :]
                ends = sum(self.nodes[k] for k in (*self.kids[x][:front], *back))
                self.known[x, y] = 1 + ends + (int(self._scores(left, right)[-1]) if left and right else 0)
            stack.pop()
        return self.weight(a, b)

    def _middle(self, a: int, b: int) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
        """How many children of the same form two nodes begin with, and what is left
        when those they end with are taken off, too. Some largest alignment has both."""
        x, y = self.kids[a], self.kids[b]
        n = min(len(x), len(y))
        front = back = 0
        while front < n and x[front] == y[front]:
            front += 1
        while back < n - front and x[-1 - back] == y[-1 - back]:
            back += 1
        return front, x[front : len(x) - back], y[front : len(y) - back]

    def _rows(self, left: tuple[int, ...], right: tuple[int, ...]) -> Iterator[np.ndarray]:
        """Weights of each of the left forms with all right ones."""
        different, place = np.unique(np.array(right), return_inverse=True)
        kept: dict[int, np.ndarray] = {}
        for a in left:
            row = kept.get(a)
            if row is None:
                row = np.array([self.weight(a, int(b)) for b in different])[place]
                if len(kept) * len(right) < CELLS:
                    kept[a] = row
            yield row

    def _scores(self, left: tuple[int, ...], right: tuple[int, ...]) -> np.ndarray:
        """Sizes of the alignments of the left forms with the first 0, 1, ... right ones."""
        best = np.zeros(len(right) + 1, np.int64)
        for row in self._rows(left, right):
            best[1:] = np.maximum(best[1:], best[:-1] + row)
            np.maximum.accumulate(best, out=best)
        return best

    def align(self, a: int, b: int) -> list[tuple[int, int]]:
        """Places of the children of two forms that are aligned. Long lists are halved
        where the sizes of both halves are largest together, so that memory is linear."""
        front, left, right = self._middle(a, b)
        back = len(self.kids[a]) - front - len(left)
        pairs = [(i, i) for i in range(front)]
        stack = [(0, len(left), 0, len(right))]
        while stack:
            i0, i1, j0, j1 = stack.pop()
            if i0 == i1 or j0 == j1:
                continue
            xs, ys = left[i0:i1], right[j0:j1]
            if len(xs) > 1 and len(xs) * len(ys) > CELLS:
                half = len(xs) // 2
                both = self._scores(xs[:half], ys) + self._scores(xs[half:][::-1], ys[::-1])[::-1]
                cut = int(both.argmax())
                stack += [(i0 + half, i1, j0 + cut, j1), (i0, i0 + half, j0, j0 + cut)]
                continue
            table = [np.zeros(len(ys) + 1, np.int64)]
            for row in self._rows(xs, ys):
                here = table[-1].copy()
                here[1:] = np.maximum(here[1:], table[-1][:-1] + row)
                table.append(np.maximum.accumulate(here))
            best, i, j = [row.tolist() for row in table], len(xs), len(ys)
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((front + i0 + i, front + j0 + j))
        return pairs + [(-k, -k) for k in range(back, 0, -1)]

    def match(self, a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
        if len(self.known) > KNOWN:
            self.known.clear()
        here, there = self.form(a), self.form(b)
        size = self.learn(here[id(a)], there[id(b)])
        pairs, stack = [], [(a, b)] if size else []
        while stack:
            x, y = stack.pop()
            pairs.append((x, y))
            u, v = here[id(x)], there[id(y)]
            if u == v:
                stack += zip(x.kids, y.kids)
            elif x.kids and y.kids:
                self.learn_kids(u, v)
                stack += [(x.kids[i], y.kids[j]) for i, j in self.align(u, v)]
        return size, pairs

    def learn_kids(self, a: int, b: int) -> None:
        """Weights that ``align`` asks for."""
        _, left, right = self._middle(a, b)
        for x in set(left):
            for y in set(right):
                self.learn(x, y)


def match(a: Node, b: Node, matcher: Matcher | None = None) -> tuple[int, list[tuple[Node, Node]]]:
    """The size of the largest alignment of two trees that keeps order and
    ancestors, and its pairs of nodes; trees whose roots differ have none."""
    return (matcher or Matcher()).match(a, b)


# ---- wrappers --------------------------------------------------------------

def count_nodes(node: Node) -> int:
    n, stack = 0, [node]
    while stack:
        n += 1
        stack += stack.pop().kids
    return n


def texts_of(node: Node) -> tuple[str, ...]:
    """The texts of a page that are not declared to be no content, in order."""
    return tuple(text for text, *_ in _blocks(node))


def template_slots(trees: list[Node]) -> list[set[tuple[int, int]]]:
    """For each of some pages of a host, its slots ``(id of the node, number of
    the text)`` that are template: the same text at the same node of most pages.
    Pages whose texts are all the same count once."""
    first: dict[tuple[str, ...], int] = {}
    for i, tree in enumerate(trees):
        first.setdefault(texts_of(tree), i)
    if len(first) < LEAST_PAGES:
        return [set() for _ in trees]
    counted = set(first.values())
    ordered = sorted(counted, key=lambda i: count_nodes(trees[i]))
    reference = trees[ordered[len(ordered) // 2]]
    texts: dict[tuple[int, int], Counter] = {}
    slots: list[list[tuple[tuple[int, int], tuple[int, int], str]]] = []
    matcher = Matcher()
    for i, tree in enumerate(trees):
        own = []
        for r, node in match(reference, tree, matcher)[1]:
            for k, (text, _) in enumerate(node.blocks()):
                own.append(((id(r), k), (id(node), k), text))
                if i in counted:
                    texts.setdefault((id(r), k), Counter())[text] += 1
        slots.append(own)
    fixed = {}
    for slot, seen in texts.items():
        text, n = seen.most_common(1)[0]
        if sum(seen.values()) >= LEAST_PAGES and n >= CONSTANT * sum(seen.values()):
            fixed[slot] = text
    return [{node for slot, node, text in own if fixed.get(slot) == text} for own in slots]


def _blocks(tree: Node) -> list[tuple[str, float, Node, int, bool]]:
    """Texts of a tree in order, each with the share of it in links, its node, its
    number there, and whether it lies in an article. What is skipped is left out."""
    found = []
    stack = [(tree, iter(tree.items), tree.tag in ARTICLE, [0])]
    while stack:
        node, items, inside, number = stack[-1]
        for item in items:
            if isinstance(item, Node):
                if not item.skip:
                    stack.append((item, iter(item.items), inside or item.tag in ARTICLE, [0]))
                    break
            else:
                found.append((*item, node, number[0], inside))
                number[0] += 1
        else:
            stack.pop()
    return found


def main_text(tree: Node, template: set[tuple[int, int]]) -> str:
    """The text blocks of a page that are content, with an empty line between them. Where no article is
    marked, text that is mostly links is content in paragraphs and headings only."""
    blocks = _blocks(tree)
    marked = _has_article(tree)
    found = [
        (text, (id(node), number) in template)
        for text, linked, node, number, inside in blocks
        if (inside if marked else linked <= 0.5 or node.tag in PROSE)
    ]
    # A page on which nothing varies has no slot to tell content by: then all of it is content.
    if all(constant for _, constant in found):
        return BETWEEN.join(t for t, _ in found)
    return BETWEEN.join(t for t, constant in found if not constant)


def _has_article(tree: Node) -> bool:
    stack = [tree]
    while stack:
        for kid in stack.pop().kids:
            if not kid.skip:
                if kid.tag in ARTICLE:
                    return True
                stack.append(kid)
    return False


def extract_chunk(pages: list[str]) -> list[str]:
    """The main texts of some pages of one host."""
    different = {html: Page(html).root for html in pages}
    slots = template_slots(list(different.values())) if len(different) >= LEAST_PAGES else [set()] * len(different)
    made = {html: main_text(tree, own) for (html, tree), own in zip(different.items(), slots)}
    return [made[html] for html in pages]


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Add ``text_col``, the main text of each page, to the columns of ``pages``
    (``html_col`` goes, a column of the new name is replaced).

    Character references are decoded, white space in a block is one space, blocks
    are joined by two line ends. NULL and empty pages have an empty text. Pages
    without an address count as one host. Rows that repeat are read alike. An
    empty table gives an empty one.
    """
    host = F.coalesce(F.lower(F.regexp_extract(url_col, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    kept = [c for c in pages.columns if c not in (html_col, text_col)]
    own, new, old = own_names(pages.select(*[F.col(f"`{c}`") for c in kept]))
    renamed = pages.select(
        *[F.col(f"`{c}`").alias(new[c]) for c in kept], F.coalesce(F.col(html_col), F.lit("")).alias("_html"), host.alias("_host")
    )
    keys = ["_host", "_order", "_twin"]
    renamed = renamed.withColumn("_order", F.xxhash64("_html")).withColumn("_twin", F.xxhash64(F.lit(1), "_html"))
    seen = checkpointed(renamed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    total = seen.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    share, most = max(CHUNK, total // HOT), max(COPIES, total // MANY)
    hot = seen.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages")).where(F.col("_pages") > share)  # fewer than HOT rows
    many = seen.where(F.col("_n") > most)  # fewer than MANY rows
    any_many = bool(many.take(1))

    def salted(rows: DataFrame) -> DataFrame:
        salt = F.pmod("_order", F.coalesce(F.ceil(F.col("_pages") / share), F.lit(1)))
        return rows.join(F.broadcast(hot), "_host", "left").withColumn("_salt", salt).drop("_pages")

    names = list(new.values())
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in own.schema.fields]
    # Before the pages of each host and salt comes a row with the number of different ones.
    place = ["_host", "_salt"]
    heads = salted(seen).groupBy(*place).agg(F.count(F.lit(1)).alias("_size"))
    nil = F.lit(None).cast("long")
    heads = heads.select(*none, *place, nil.alias("_order"), nil.alias("_twin"), "_size", F.lit(None).cast("string").alias("_html"), F.lit(False).alias("_shown"))
    marked = renamed.join(F.broadcast(many), keys, "left") if any_many else renamed.withColumn("_n", nil)
    columns = [*place, "_order", "_twin", nil.alias("_size"), "_html"]
    stream = heads.unionByName(salted(marked.where("_n IS NULL")).select(*names, *columns, F.lit(True).alias("_shown")))
    if any_many:
        one = salted(marked.where("_n IS NOT NULL").groupBy(*keys).agg(F.first("_html").alias("_html")))
        stream = stream.unionByName(one.select(*none, *columns, F.lit(False).alias("_shown")))
    added = [T.StructField(c, t) for c, t in zip([*keys, "_shown", "_text"], [T.StringType(), T.LongType(), T.LongType(), T.BooleanType(), T.StringType()])]
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in own.schema.fields], *added])
    arrow, passed = to_arrow_schema(schema), [*names, *keys, "_shown"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        htmls: list[list[str]] = []
        last = None
        size = rank = chunk = 0

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                rows = pa.Table.from_batches(held).combine_chunks()
                texts = extract_chunk([html for part in htmls for html in part])
                made = [*(rows.column(n) for n in passed), pa.chunked_array([pa.array(texts, pa.string())])]
                yield from pa.Table.from_arrays([a.cast(t) for a, t in zip(made, arrow.types)], schema=arrow).to_batches()

        for batch in batches:
            hosts, salts, orders, twins, sizes, pages = (batch.column(c).to_pylist() for c in [*place, "_order", "_twin", "_size", "_html"])
            kept = batch.select(passed)
            start = 0

            def hold(end: int) -> None:
                if end > start:
                    held.append(kept.slice(start, end - start))
                    htmls.append(pages[start:end])

            for i in range(len(hosts)):
                if sizes[i] is not None:
                    hold(i)
                    yield from done()
                    held, htmls, start, size, rank, chunk, last = [], [], i + 1, sizes[i], -1, 0, None
                    continue
                if (orders[i], twins[i]) != last:
                    last, rank = (orders[i], twins[i]), rank + 1
                    own_chunk = rank * -(-size // CHUNK) // size
                    if own_chunk != chunk:
                        hold(i)
                        yield from done()
                        held, htmls, start, chunk = [], [], i, own_chunk
            hold(len(hosts))
        yield from done()

    def made(rows: DataFrame) -> DataFrame:
        dealt = rows.repartition(*place).sortWithinPartitions(*place, F.col("_size").desc_nulls_last(), "_order", "_twin")
        return dealt.mapInArrow(run, schema)

    out = made(stream).where("_shown").select(*names, "_text")
    if any_many:
        # Pages with many copies are read once beside the others of their host, and their
        # texts brought back to the copies, in pieces so that no page makes a task hot.
        there = salted(many).select(*place).distinct()
        texts = made(stream.join(F.broadcast(there), place, "left_semi")).where(~F.col("_shown")).select(*keys, "_text")
        pieces = F.ceil(F.col("_n") / share)
        texts = texts.join(F.broadcast(many), keys).withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))).drop("_n")
        copies = marked.where("_n IS NOT NULL").drop("_html").withColumn("_piece", F.pmod(F.monotonically_increasing_id(), pieces))
        out = out.unionByName(copies.join(texts, [*keys, "_piece"]).select(*names, "_text"))
    return out.select(*old, F.col("_text").alias(text_col))

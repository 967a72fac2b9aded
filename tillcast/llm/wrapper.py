"""Main text of web pages by wrapper induction.

Pages are parsed to trees of block elements. Pages of a host that have the same
layout (the same structural elements and classes before their first paragraph) share a wrapper.
One page of a layout is its model; every other page is aligned with the model by simple
tree matching (the largest order-preserving set of node pairs with equal labels), and
the pages that have the model's text at a node are counted over all pages of the layout. A
node with one text on all of them is constant and belongs to the template; a node
whose text varies is a slot. The wrapper is the model with these marks and the node
that holds the varying text. Each page is aligned with its wrapper; the content is
what lies in the page's counterpart of that node, without the blocks that the
template fills (headings stay with what they head).

Regions that are no main text whatever they hold (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments) are known
by element name, role, or a class that names them as a whole, and never become content. A word
of such a kind inside a compound class is a hint only: it keeps a node from being
chosen as content, but inside the content the marks decide, and an id decides nothing.
An ``article`` or ``main`` element is the content node where there is one. A
page that does not fit its wrapper is judged by its own tree alone, and marks need
``least_pages`` different pages of a layout, so a host with a single page needs no wrapper.

Matching is exact for any number of children. Equal subtrees at the ends are paired first,
which loses nothing; the table of the rest is worked on row by row, and of a long one only
every few rows are kept, so its memory grows with the blocks times the square root of them.

Edge cases: null and empty html give an empty text; unclosed, misnested and
truncated markup is read like a browser reads it as far as blocks go; very long pages
are read whole; a null url shares the empty host; copies of a page count once in the marks
and give equal rows; ties between models go to the least hash; other columns are
carried; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.linkgraph import host
from tillcast.llm.store import carried, fresh, materialize
from tillcast.llm.wordhash import each_text

LEAST_PAGES = 3      # different pages of a layout that a mark needs
TABLE = 4096         # cells of an alignment's table that are worked on at once
SIZES_HELD = 1 << 16  # sizes of matched subtrees that are kept; others are made again
KINDS_HELD = 4096    # kinds of elements that a worker keeps
NODE = 1 << 20       # weight of a matched node; an equal text weighs one
BROADCAST_BYTES = 8 << 20
MODELS_HELD = 64     # parsed models that a task keeps
MAX_DEPTH = 200  # deeper elements still separate blocks, but hang on the deepest open one

# fixed values: elements of HTML by their part in this operator
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section "
                   "summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head title script style noscript template iframe object svg math canvas audio video select textarea".split())
NOT_MAIN = frozenset("nav aside footer form button menu dialog".split())
NOT_MAIN_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar toolbar".split())
NOT_MAIN_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
                           "consent gdpr notice notices alert newsletter subscribe subscription signup popup modal overlay paywall sidebar "
                           "sidenav nav navbar navigation navigate menu breadcrumb breadcrumbs footer masthead topbar toolbar comment "
                           "comments disqus replies respond related recommended share sharing social widget login search pagination "
                           "pager skip".split())
# compound classes with one of these words hold no main text even where their text varies
REGION_WORDS = frozenset("advert adverts advertisement advertising sponsored cookie cookies consent gdpr newsletter breadcrumb breadcrumbs "
                         "sidebar comment comments disqus replies respond related recommended".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup caption figcaption dt".split())  # stay with what they head
STRUCTURAL = frozenset("article aside body div footer form header html main nav section table tbody tr td ul ol".split())
# an open element of the key is closed by the start of one of the values
CLOSED_BY = {"p": BLOCKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
             "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}


class Node:
    """A block element: its label, children (nodes and text runs in page order) and part: ``skip`` if it is no
    main text by its name, ``hint`` if only a word of its class or id says so."""

    __slots__ = ("code", "full", "hint", "inner", "kids", "label", "said", "shape", "skip", "tag", "whole", "words")

    def __init__(self, tag: str, label: str, skip: bool, hint: bool = False):
        self.tag, self.label, self.skip, self.hint = tag, label, skip, hint
        self.kids: list[Node | str] = []
        self.code = self.full = self.said = self.shape = self.whole = 0
        self.inner: list[Node] | None = None
        self.words: str | None = None

    def nodes(self) -> list[Node]:
        """Child nodes; asked for when the page is read to its end, like the text."""
        if self.inner is None:
            self.inner = [k for k in self.kids if isinstance(k, Node)]
        return self.inner

    def text(self) -> str:
        if self.words is None:
            self.words = " ".join("".join(k for k in self.kids if isinstance(k, str)).split())
        return self.words


@lru_cache(KINDS_HELD)
def kind(tag: str, role: str, classes: str, name: str, hidden: bool, inside: bool) -> tuple[str, bool, bool]:
    """(label, skip, hint) of an element by its attributes and whether it is inside an article or main element."""
    split = lambda x: re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", x).lower())
    names, words = set(classes.lower().split()), set(split(classes))
    skip = (tag in NOT_MAIN or role.lower() in NOT_MAIN_ROLES or not NOT_MAIN_WORDS.isdisjoint(names)
            or not REGION_WORDS.isdisjoint(words) or hidden or (tag == "header" and not inside) or ("header" in names and not inside))
    hint = not NOT_MAIN_WORDS.isdisjoint(words | set(split(name))) or ("header" in words and not inside)
    if tag in ("article", "main", "body", "html"):
        skip = skip and tag in ("article", "main") and bool({"comment", "comments", "related", "recommended"} & words)
        hint = False
    return " ".join([tag, *sorted(words)]), skip, hint


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#", "#", False)
        self.stack = [self.root]
        self.silent: list[str] = []

    def handle_starttag(self, tag, attrs):
        if self.silent:
            if tag == self.silent[-1] and tag not in VOID:
                self.silent.append(tag)
            elif self.silent[-1] == "head" and tag in BLOCKS:
                self.silent.pop()  # an unclosed head ends where the body's blocks begin
                self.handle_starttag(tag, attrs)
            return
        if tag in SILENT:
            self.silent.append(tag)
            return
        if tag not in BLOCKS:
            if tag in ("br", "img"):
                self.handle_data(" ")
            return
        while len(self.stack) > 1 and tag in CLOSED_BY.get(self.stack[-1].tag, ()):
            self.stack.pop()
        given = {k: (v or "") for k, v in attrs}
        inside = any(n.tag in ("article", "main") for n in self.stack)
        label, skip, hint = kind(tag, given.get("role", ""), given.get("class", ""), given.get("id", ""), "hidden" in given, inside)
        node = Node(tag, label, skip, hint)
        self.stack[-1].kids.append(node)
        if tag not in VOID and len(self.stack) < MAX_DEPTH:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS and self.silent and self.silent[-1] == tag:
            self.silent.pop()

    def handle_endtag(self, tag):
        if self.silent:
            if tag == self.silent[-1]:
                self.silent.pop()
            return
        if tag in BLOCKS:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag == tag:
                    del self.stack[k:]
                    break

    def handle_data(self, data):
        if not self.silent:
            self.stack[-1].kids.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def shape(node: Node) -> int:
    """Digest of the labels under a node; kept in the nodes, with one of each node's own text (0 if it has none),
    one of all that is under it and the weight of a match with an equal subtree."""
    order, todo = [], [] if node.shape else [node]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += n.nodes()
    for n in reversed(order):
        n.code = hash(n.label)
        n.shape = hash((n.label, *[k.shape for k in n.nodes()])) or 1
        text = n.text()
        n.said = hash(text) or 1 if text else 0
        n.whole = hash((n.label, n.said, *[k.whole for k in n.nodes()]))
        n.full = NODE + (n.said != 0) + sum(k.full for k in n.nodes())
    return node.shape


def _texts(node: Node) -> list[int]:
    return [n.said for n in numbered(node)]


class Side(NamedTuple):
    nodes: list[Node]
    code: np.ndarray
    said: np.ndarray
    shapes: dict[int, list[int]]
    texts: dict[int, np.ndarray]


def match(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching: pairs of aligned nodes, the roots first (none if their labels differ). Of the largest
    matchings one with most equal texts is taken."""
    sizes: dict[tuple[int, int], int] = {}
    for root in (a, b):
        shape(root)

    def head(xs: list[Node], ys: list[Node]) -> int:
        """Number of equal subtrees at the start: pairing them loses nothing, as no subtree has a better partner."""
        k = 0
        while k < len(xs) and k < len(ys) and xs[k].shape == ys[k].shape and xs[k].whole == ys[k].whole:
            k += 1
        return k

    def known(ns: list[Node]) -> Side:
        """Nodes, their labels and texts, the places of those with children by shape, and the texts under these."""
        shapes: dict[int, list[int]] = {}
        for k, n in enumerate(ns):
            if n.nodes():
                shapes.setdefault(n.shape, []).append(k)
        return Side(ns, np.array([n.code for n in ns], np.int64), np.array([n.said for n in ns], np.int64), shapes,
                    {s: np.array([_texts(ns[k]) for k in at], np.int64) for s, at in shapes.items()})

    def weights(x: Side, y: Side) -> np.ndarray:
        """Largest matching of every pair."""
        same = x.code[:, None] == y.code
        out = same * NODE + (same & (x.said[:, None] == y.said) & (y.said != 0))
        for sx, rows in x.shapes.items():
            for sy, columns in y.shapes.items():
                if sx == sy:  # every node is matched only where equal places are paired
                    vx, vy = x.texts[sx], y.texts[sx]
                    out[np.ix_(rows, columns)] = NODE * vx.shape[1] + sum((vx[:, [k]] == vy[:, k]) & (vy[:, k] != 0) for k in range(vx.shape[1]))
                elif x.code[rows[0]] == y.code[columns[0]]:
                    for i in rows:
                        for j in columns:
                            pair = id(x.nodes[i]), id(y.nodes[j])
                            if pair not in sizes:
                                under = total(x.nodes[i].nodes(), y.nodes[j].nodes())
                                if len(sizes) >= SIZES_HELD:
                                    sizes.clear()
                                sizes[pair] = under
                            out[i, j] += sizes[pair]
        return out

    def below(row: np.ndarray, weight: np.ndarray) -> np.ndarray:
        best = row.copy()
        np.maximum(best[1:], row[:-1] + weight, out=best[1:])
        return np.maximum.accumulate(best)

    def total(xs: list[Node], ys: list[Node]) -> int:
        """Weight of the best alignment of two lists of children."""
        first = head(xs, ys)
        found, xs, ys = sum(x.full for x in xs[:first]), xs[first:], ys[first:]
        last = head(xs[::-1], ys[::-1])
        found, xs, ys = found + sum(x.full for x in xs[len(xs) - last:]), xs[:len(xs) - last], ys[:len(ys) - last]
        if not xs or not ys:
            return found
        row, columns = np.zeros(len(ys) + 1, np.int64), known(ys)
        step = max(64, TABLE // len(row))
        for at in range(0, len(xs), step):
            for weight in weights(known(xs[at:at + step]), columns):
                row = below(row, weight)
        return found + int(row[-1])

    def paired(xs: list[Node], ys: list[Node]) -> list[tuple[Node, Node]]:
        """Pairs of the best alignment: of a long table the first row of each of some blocks is kept, and a block's
        rows are made again on the way back, so memory grows with the square root of the rows."""
        first = head(xs, ys)
        out, xs, ys = [*zip(xs[:first], ys[:first])], xs[first:], ys[first:]
        if not xs or not ys:
            return out
        lx, ly = {x.label: x for x in xs}, {y.label: y for y in ys}
        common = [k for k in lx if k in ly]
        if len(lx) == len(xs) and len(ly) == len(ys) and common == [k for k in ly if k in lx]:
            return out + [(lx[k], ly[k]) for k in common]  # each has one partner at most, and all go together
        step = max(1, len(xs))
        if len(xs) * len(ys) > TABLE:
            last = head(xs[::-1], ys[::-1])
            out += zip(xs[len(xs) - last:], ys[len(ys) - last:])
            xs, ys = xs[:len(xs) - last], ys[:len(ys) - last]
            step = math.isqrt(len(xs)) + 1
        starts, row, columns = [], np.zeros(len(ys) + 1, np.int64), known(ys)
        for at in range(0, len(xs) if ys else 0, step):
            starts.append(row)
            if at + step < len(xs):
                for weight in weights(known(xs[at:at + step]), columns):
                    row = below(row, weight)
        j = len(ys)
        for block in reversed(range(len(starts))):
            rows = [starts[block]]
            for weight in weights(known(xs[block * step:(block + 1) * step]), columns):
                rows.append(below(rows[-1], weight))
            i = len(rows) - 1
            while i and j:
                here = rows[i][j]
                if here == rows[i - 1][j]:
                    i -= 1
                elif here == rows[i][j - 1]:
                    j -= 1
                else:
                    out.append((xs[block * step + i - 1], ys[j - 1]))
                    i, j = i - 1, j - 1
        return out

    pairs: list[tuple[Node, Node]] = []
    todo = [(a, b)] if a.label == b.label else []
    while todo:
        x, y = todo.pop()
        pairs.append((x, y))
        todo += zip(x.nodes(), y.nodes()) if x.shape == y.shape else paired(x.nodes(), y.nodes())
    return pairs


def _mass(node: Node, own) -> int:
    """Characters under a node, without skipped regions; ``own`` weighs a node's own text."""
    total, todo = 0, [node]
    while todo:
        n = todo.pop()
        if not (n.skip or n.hint):
            total += own(n)
            todo += n.nodes()
    return total


def content_node(root: Node, own=lambda n: len(n.text())) -> Node:
    """The article or main element with most text; else the deepest node that
    still holds nearly all of the text outside skipped regions."""
    named, todo = [], [root]
    while todo:
        n = todo.pop()
        if not (n.skip or n.hint):
            if n.tag in ("article", "main"):
                named.append(n)
            todo += n.nodes()
    if named:
        return max(reversed(named), key=lambda n: (n.tag == "article", _mass(n, own)))
    node = root
    while True:
        kids = [(k, _mass(k, own)) for k in node.nodes() if not (k.skip or k.hint)]
        best = max(kids, key=lambda x: x[1], default=None)
        if best is None or best[1] < 0.9 * _mass(node, own) or best[1] == 0 or not best[0].nodes():
            return node
        node = best[0]


def numbered(root: Node) -> list[Node]:
    """All nodes in page order; a node's number in its model is its place."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += reversed(n.nodes())
    return out


class Wrapper:
    """The model page of a layout, its constant nodes and the node that holds the varying text."""

    def __init__(self, html: str, constant: list[int]):
        self.root = parse(html)
        nodes = numbered(self.root)
        self.constant = {id(nodes[k]) for k in constant if nodes[k].text()}
        varying = lambda n: 0 if id(n) in self.constant else len(n.text())
        self.slot = content_node(self.root, varying)

    def applied(self, page: Node) -> tuple[Node | None, set[int]]:
        """The page's counterpart of the slot, and its nodes that the template fills."""
        slot, fixed = None, set()
        for a, b in match(self.root, page):
            if a is self.slot:
                slot = b
            if id(a) in self.constant and b.tag not in HEADINGS and a.text() == b.text():
                fixed.add(id(b))
        return slot, fixed


def blocks(node: Node, fixed: set[int] = frozenset()) -> list[str]:
    """Text blocks under a node in page order, without skipped regions and the own texts of ``fixed`` nodes."""
    out: list[str] = []
    todo: list = [(node, 0, [])]  # node, next child, open text run
    while todo:
        n, at, run = todo.pop()
        while at < len(n.kids) and isinstance(n.kids[at], str):
            if id(n) not in fixed:
                run.append(n.kids[at])
            at += 1
        out.append(" ".join("".join(run).split()))
        if at < len(n.kids):
            todo.append((n, at + 1, []))
            if not n.kids[at].skip:
                todo.append((n.kids[at], 0, []))
    return [b for b in out if b]


def main_text(html: str | None, wrapper: Wrapper | None) -> str:
    tree = parse(html)
    node, fixed = wrapper.applied(tree) if wrapper else (None, frozenset())
    own = content_node(tree)
    if node is None or (own.tag in ("article", "main") and node.tag not in ("article", "main")):
        node = own
    return "\n\n".join(blocks(node, fixed))


def layout_column(html: Column) -> Column:
    """Layout of each page (JVM side): the structural elements with their classes before the first paragraph, article or main element."""
    head = F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)^(.*?)(?:<(?:p|article|main)\b|$)", 1)
    tags = F.regexp_extract_all(head, F.lit(rf"(?is)(<(?:{'|'.join(sorted(STRUCTURAL))})\b[^>]*)"), F.lit(1))
    named = F.transform(tags, lambda t: F.concat_ws(" ", F.regexp_extract(t, r"^<(\w+)", 1), F.regexp_extract(t, r"(?i)\bclass\s*=\s*[\"']?([^\"'>]*)", 1)))
    return F.lower(F.hex(F.xxhash64(F.lower(F.array_join(F.array_sort(F.array_distinct(named)), "/")))))


def same_column(html: Column, model: Column) -> Column:
    """Numbers of the model's nodes at which each page, aligned with it, has the model's text."""
    known: dict[str, tuple[Node, dict[int, int]]] = {}

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def aligned(html_: pa.Array, model_: pa.Array) -> pa.Array:
        out = []
        for h, m in zip(each_text(html_), each_text(model_)):
            if m not in known:
                if len(known) >= MODELS_HELD:
                    known.clear()
                root = parse(m)
                known[m] = root, {id(n): k for k, n in enumerate(numbered(root))}
            root, number = known[m]
            out.append([number[id(a)] for a, b in match(root, parse(h)) if a.said and a.said == b.said])
        return pa.array(out, pa.list_(pa.int32()))
    return aligned(html, model)


def extract_column(html: Column, model: Column, constant: Column) -> Column:
    """Main text of each page given its layout's model (or null) and constant nodes."""
    known: dict[str, Wrapper] = {}

    @F.arrow_udf(T.StringType())
    def extract(html_: pa.Array, model_: pa.Array, constant_: pa.Array) -> pa.Array:
        out = []
        for k, (h, m) in enumerate(zip(each_text(html_), each_text(model_))):
            if m is not None and m not in known:
                if len(known) >= MODELS_HELD:
                    known.clear()
                known[m] = Wrapper(m, constant_[k].as_py() or [])
            out.append(main_text(h, known[m] if m is not None else None))
        return pa.array(out, pa.string())
    return extract(html, model, constant)


def wrappers(pages: DataFrame, site: str, form: str, html: str, least_pages: int = LEAST_PAGES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(host, layout, model, constant) of every layout with ``least_pages`` different pages: the marks come from all of them."""
    some = pages.filter(F.col(html).isNotNull()).select(F.col(site).alias("host"), F.col(form).alias("layout"), F.xxhash64(html).alias("hash"), F.col(html).alias("html"))
    different = some.groupBy("host", "layout", "hash").agg(F.count(F.lit(1)).alias("copies"))
    chosen = materialize(different.groupBy("host", "layout").agg(F.min("hash").alias("hash"), F.count(F.lit(1)).alias("pages"), F.sum("copies").alias("rows"))
                         .filter(F.col("pages") >= least_pages), "wrapper-chosen")
    models = some.join(_small(chosen, 128, broadcast_bytes), ["host", "layout", "hash"]).groupBy("host", "layout", "rows").agg(F.min("html").alias("model"))
    models = materialize(models, "wrapper-models")
    beside = _small(models, F.octet_length("model") + F.octet_length("host") + 64, broadcast_bytes)
    met = some.join(beside, ["host", "layout"]).select("host", "layout", "rows", F.explode(same_column(F.col("html"), F.col("model"))).alias("node"))
    told = met.groupBy("host", "layout", "rows", "node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == F.col("rows"))
    constant = told.groupBy("host", "layout").agg(F.sort_array(F.collect_list("node")).alias("constant"))  # at most the nodes of a page
    return models.select("host", "layout", "model").join(constant, ["host", "layout"], "left")


def _small(table: DataFrame, width, most: int) -> DataFrame:
    """``table`` for a broadcast if its bytes, counted, are at most ``most``."""
    size = table.agg(F.sum(F.lit(width) if isinstance(width, int) else width)).first()[0] or 0
    return F.broadcast(table) if size <= most else table


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", least_pages: int = LEAST_PAGES,
            broadcast_bytes: int = BROADCAST_BYTES, out: str = "main_text") -> DataFrame:
    """``pages`` plus the column ``out`` (a column of that name is replaced)."""
    name = fresh("_site", pages.columns)
    tagged = pages.withColumn(name, host(F.col(f"`{url_col}`"))).withColumn(f"{name}l", layout_column(F.col(f"`{html_col}`")))
    found = materialize(wrappers(tagged, name, f"{name}l", f"`{html_col}`", least_pages, broadcast_bytes), "wrapper-hosts")
    side = _small(found, F.octet_length("model") + F.octet_length("host") + 64, broadcast_bytes)
    side = side.select(F.col("host").alias(f"{name}h"), F.col("layout").alias(f"{name}o"), F.col("model").alias(f"{name}m"), F.col("constant").alias(f"{name}c"))
    joined = tagged.join(side, (F.col(name) == F.col(f"{name}h")) & (F.col(f"{name}l") == F.col(f"{name}o")), "left")
    return joined.select(*carried(pages.columns, out),
                         extract_column(F.col(f"`{html_col}`"), F.col(f"{name}m"), F.col(f"{name}c")).alias(out))

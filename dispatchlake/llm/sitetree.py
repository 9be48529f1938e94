"""Main text of web pages by site style trees.

Pages of one host are merged into a tree. An element node is known by its place: the node above it, the style
that node shows there (the sequence of its children's elements, classes and ids, a run of equal ones as one) and its
index in that style. Pages with the same article count once in the tree, whatever surrounds it.

A node's importance is the entropy of its styles over the pages that have it, or, for a node without children,
one minus the mean entropy of its text blocks over these pages: text that is the same everywhere matters least. The
composite importance adds up what lies below, as each style's share of pages times the mean of its children,
damped by ``GAMMA`` for each style. Branches below ``THRESHOLD`` go, if ``MIN_PAGES`` pages or more show them.

A host with one or two pages says nothing about its template, and a repeated article is still the article. So elements
whose name, role, class or id says what they are do not depend on the entropy: navigation, adverts, forms, comments and
the like always go; of a page with article or main elements only these count, and of what they hold only
unnamed parts (div, section) can go by importance. On other pages blocks that consist of links go too.

The tree is one aggregate over hashed rows of all pages: a hot host is summed in parts before any shuffle, and no
host or page list is gathered. Nodes that few pages share are left out of the table of branches that go; it is sent
to all tasks up to ``BROADCAST_KEYS`` rows, and joined with the pages' nodes beyond.

Defined results: a null or empty page, or one without an article's text, has the empty text; a page without a host
belongs to the site of all such pages; a null id stays null; repeated rows each give a row; an empty table gives no
rows; elements deeper than ``DEPTH`` count as content of the one above for the importance, their text stays; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispatchlake.llm import dom
from dispatchlake.session import settle

GAMMA = 0.9
THRESHOLD = 0.3
MIN_PAGES = 3
DEPTH = 24
LINK_SHARE, LINKED_BLOCK = 0.6, 2  # a block of links: so much of its text, in so many of them
BROADCAST_KEYS = 1_000_000  # 8 MB
UNNAMED = {"div", "section", "table"}  # elements that stand for any part of a page, so a run of them is no list
PAGES = 64  # pages whose trees are in memory together

HOST = re.compile(r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)")
ROWS_SQL = "key long, kind int, feature long, n int, parent long, children int, depth int, removable boolean, page long"

Batches = Iterator[pa.RecordBatch]


def digest(*parts: object) -> int:
    raw = "\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def host(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


class Roles:
    """What the names of a page's elements say: which parts are the article, noise, or open."""

    def __init__(self, page: dom.Page) -> None:
        n = len(page.tag)
        under = [False] * n  # below noise
        for i in range(1, n):
            under[i] = under[page.parent[i]] or page.noise[i]
        marks = page.article if any(page.article) else page.main
        chosen = [i for i in range(n) if marks[i] and not under[i]]
        if not chosen:
            chosen = [i for i in range(n) if page.main[i] and not under[i]]
        if not chosen:  # noise that was never closed holds the article
            chosen = [i for i in range(n) if marks[i]]
        if not chosen:
            chosen = self._marked(page, under)
        top = set(chosen)
        self.holds = [False] * n  # an article is somewhere below
        for i in top:
            at = page.parent[i]
            while at >= 0 and not self.holds[at]:
                self.holds[at] = True
                at = page.parent[at]
        self.inside = [False] * n
        self.noise = [False] * n  # names say that it goes, or something above it
        for i in range(n):
            above = page.parent[i]
            inside_above = above >= 0 and self.inside[above]
            self.inside[i] = inside_above or i in top
            free = i in top and not inside_above
            own = page.noise[i] and not self.holds[i]
            self.noise[i] = not free and (own or (above >= 0 and self.noise[above]))
        self.top, self.has_article = top, bool(top)

    def kept(self, page: dom.Page, node: int) -> bool:
        """Not to be removed by importance: an article, what holds one, and all but unnamed parts of it."""
        return node in self.top or self.holds[node] or (self.inside[node] and page.tag[node] not in UNNAMED)

    @staticmethod
    def _marked(page: dom.Page, under: list[bool]) -> list[int]:
        """Outermost blocks with an article's class or id, if they hold most of the text."""
        top, held = [], [False] * len(page.tag)
        for i in range(1, len(page.tag)):
            held[i] = held[page.parent[i]] or (page.marked[i] and not under[i])
            if held[i] and not held[page.parent[i]]:
                top.append(i)
        size = [0, 0]
        for node, text in page.events:
            if text and not under[node]:
                size[held[node]] += len(text.strip())
        return top if size[1] > size[0] else []


def _menus(page: dom.Page, roles: Roles) -> list[bool]:
    """Blocks outside of articles whose text is mostly links."""
    n = len(page.tag)
    total, linked, items = [0] * n, list(page.linked), [int(x > 0) for x in page.linked]
    for node, text in page.events:
        if text:
            total[node] += len(text.strip())
    for i in range(n - 1, 0, -1):
        above = page.parent[i]
        total[above] += total[i]
        linked[above] += linked[i]
        items[above] += items[i]
    return [
        not roles.inside[i] and i > 0 and items[i] >= LINKED_BLOCK and linked[i] >= LINK_SHARE * total[i] > 0 for i in range(n)
    ]


def blocks(events: list[tuple[int, str | None]], wanted: Callable[[int], bool]) -> Iterator[tuple[int, str]]:
    """Text blocks of wanted nodes: (node where the block ends, text with single spaces)."""
    held, last = [], 0
    for node, text in events:
        if text is None:
            if held:
                joined = " ".join("".join(held).split())
                if joined:
                    yield last, joined
                held = []
        elif wanted(node):
            held.append(text)
            last = node
    joined = " ".join("".join(held).split())
    if joined:
        yield last, joined


class Tree:
    """The style tree of one page: keys of its element nodes, runs of equal siblings as one node."""

    def __init__(self, page: dom.Page, roles: Roles, site: str) -> None:
        n = len(page.tag)
        children: list[list[int]] = [[] for _ in range(n)]
        for i in range(1, n):
            if not page.unread[i]:
                children[page.parent[i]].append(i)
        direct = [False] * n
        for node, text in page.events:
            if text and not text.isspace():
                direct[node] = True
        self.key_of: list[int | None] = [None] * n  # of the deepest node of the tree that holds the element
        self.removable = [False] * n
        self.rows: list[tuple[int, int, int, int, int, bool]] = []  # key, style, parent, children, depth, may it go
        self.leaf: dict[int, int] = {}  # element: key, of nodes without children below
        work: list[tuple[int, int, int, list[int], int]] = [(digest(site), 0, 1, [0], 0)]
        while work:
            key, parent, count, run, depth = work.pop()
            first = run[0]
            stop = roles.noise[first] or depth >= DEPTH or (roles.inside[first] and page.tag[first] in dom.LEAF_TAGS)
            groups: list[tuple[str, list[int]]] = []
            if not stop:
                for node in run:
                    below = children[node]
                    if below and direct[node]:
                        groups.append(("#text", [node]))
                    for child in below:
                        if groups and groups[-1][0] == page.label[child] and page.label[child] not in UNNAMED:
                            groups[-1][1].append(child)
                        else:
                            groups.append((page.label[child], [child]))
            style = digest(*(label for label, _ in groups)) if groups else 0
            may_go = depth > 0 and not roles.noise[first] and not any(roles.kept(page, i) for i in run)
            for node in run:
                self.key_of[node], self.removable[node] = key, may_go
                if not groups:
                    self.leaf[node] = key
            self.rows.append((key, style, parent, count, depth, may_go))
            for index, (label, nodes) in enumerate(groups):
                below = digest(key, style, index)
                if label == "#text":
                    for node in nodes:
                        self.leaf[node] = below
                    self.rows.append((below, 0, key, len(groups), depth + 1, False))
                else:
                    work.append((below, key, len(groups), nodes, depth + 1))


def _leaf_keys(page: dom.Page, tree: Tree) -> list[int | None]:
    """For each element the node of the tree that its text belongs to."""
    keys: list[int | None] = []
    for i in range(len(page.tag)):
        own = tree.leaf.get(i)
        if own is None and i and tree.key_of[i] is None:
            own = keys[page.parent[i]]
        keys.append(own)
    return keys


def _pages(batches: Batches) -> Iterator[tuple[pa.RecordBatch, list[tuple[str | None, str | None]]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, PAGES):
            part = batch.slice(at, PAGES)
            yield part, list(zip(part.column("url").to_pylist(), part.column("html").to_pylist()))


def _tree_rows(batches: Batches) -> Batches:
    """Presence rows (kind 0, the style as feature) and content rows (kind 1, a text block) of all pages."""
    for _, pages in _pages(batches):
        rows = []
        for url, html in pages:
            if not html:
                continue
            page = dom.read(html)
            roles = Roles(page)
            tree = Tree(page, roles, host(url))
            keys = _leaf_keys(page, tree)
            content: Counter[tuple[int, int]] = Counter()
            article = hashlib.blake2b(digest_size=8)
            for node, text in blocks(page.events, lambda i: True):
                if not roles.noise[node] and (roles.inside[node] or not roles.has_article):
                    article.update(text.encode("utf-8", "surrogatepass") + b"\x00")
                if keys[node] is not None and not (roles.inside[node] and not tree.removable[node]):
                    content[(keys[node], digest(text))] += 1
            seen = int.from_bytes(article.digest(), "little", signed=True)
            for key, style, *place in tree.rows:
                rows.append((key, 0, style, 1, *place, seen))
            for (key, feature), n in content.items():
                rows.append((key, 1, feature, n, None, None, None, None, seen))
        if rows:
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()]
            names = [c.split()[0] for c in ROWS_SQL.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def importance(pages: DataFrame) -> DataFrame:
    """Nodes that ``MIN_PAGES`` pages share: key, parent, depth, share of the parent, styles, importance, removable."""
    rows = pages.mapInArrow(_tree_rows, ROWS_SQL)
    once = rows.groupBy("key", "kind", "feature", "page").agg(
        F.max("n").alias("n"), *[F.max(c).alias(c) for c in ("parent", "children", "depth", "removable")]
    )
    features = once.groupBy("key", "kind", "feature").agg(
        F.sum("n").cast("double").alias("total"),
        F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("spread"),
        *[F.max(c).alias(c) for c in ("parent", "children", "depth", "removable")],
    )
    style, text = F.col("kind") == 0, F.col("kind") == 1
    nodes = features.groupBy("key").agg(
        F.sum(F.when(style, F.col("total"))).alias("pages"),
        F.count(F.when(style, 1)).alias("styles"),
        F.sum(F.when(style, F.col("total") * F.log("total"))).alias("style_spread"),
        F.count(F.when(text, 1)).alias("texts"),
        F.sum(F.when(text, F.log("total") - F.col("spread") / F.col("total"))).alias("text_entropy"),
        F.max(F.when(style & (F.col("feature") != 0), 1)).isNotNull().alias("inner"),
        *[F.max(c).alias(c) for c in ("parent", "children", "depth", "removable")],
    )
    nodes = nodes.filter(F.col("pages") >= MIN_PAGES)
    unit = F.log("pages")
    by_style = (unit - F.col("style_spread") / F.col("pages")) / unit
    by_text = F.lit(1.0) - F.coalesce(F.col("text_entropy") / F.col("texts"), F.lit(0.0)) / unit
    own = F.when(F.col("inner"), by_style).otherwise(by_text)
    return nodes.select("key", "parent", "depth", "children", "pages", "styles", "inner", "removable", own.alias("own"))


def composite(nodes: DataFrame) -> DataFrame:
    """key, removable, lost: one minus the composite importance, from the deepest nodes up.

    Each level is an aggregate of the one below it, over nodes that pages share, not over pages.
    """
    nodes = settle(nodes, "sitetree-nodes")
    levels = [r["depth"] for r in nodes.filter("inner and depth > 0").select("depth").distinct().collect()]
    done = nodes.filter("not inner").select("key", "removable", (F.lit(1.0) - F.col("own")).alias("lost"))
    shares = nodes.join(
        nodes.select(F.col("key").alias("parent"), F.col("pages").alias("around")), "parent"
    ).select("key", "parent", (F.col("pages") / F.col("around") / F.col("children")).alias("share"))
    for level in sorted(levels, reverse=True):
        below = done.join(shares, "key").groupBy("parent").agg(F.sum(F.col("share") * F.col("lost")).alias("below"))
        damp = F.pow(F.lit(GAMMA), F.col("styles"))
        here = (
            nodes.filter((F.col("depth") == level) & F.col("inner"))
            .join(below.withColumnRenamed("parent", "key"), "key", "left")
            .select(
                "key",
                "removable",
                ((F.lit(1.0) - damp) * (F.lit(1.0) - F.col("own")) + damp * F.coalesce("below", F.lit(0.0))).alias("lost"),
            )
        )
        done = settle(done.union(here), "sitetree-levels")
    return done


def extract_text(url: str | None, html: str | None, goes: Callable[[int], bool]) -> str:
    """The main text of a page; ``goes`` tells which keys of its site's tree are removed."""
    if not html:
        return ""
    page = dom.read(html)
    roles = Roles(page)
    tree = Tree(page, roles, host(url))
    menus = _menus(page, roles) if not roles.has_article else None
    gone = []
    for i in range(len(page.tag)):
        above = page.parent[i]
        key = tree.key_of[i]
        out = roles.noise[i] or (above >= 0 and gone[above] and not (roles.inside[i] and not roles.inside[above]))
        out = out or bool(menus and menus[i]) or (tree.removable[i] and key is not None and goes(key))
        gone.append(out)
    found = [t for _, t in blocks(page.events, lambda i: not gone[i] and (roles.inside[i] or not roles.has_article))]
    return " ".join(found)


def _named(url: str | None, html: str | None) -> list[int]:
    """Keys of a page's branches that may go."""
    if not html:
        return []
    page = dom.read(html)
    tree = Tree(page, Roles(page), host(url))
    return sorted({k for k, may_go in zip(tree.key_of, tree.removable) if may_go and k is not None})


def _node_rows(batches: Batches) -> Batches:
    for part, pages in _pages(batches):
        keys = [_named(url, html) for url, html in pages]
        yield pa.RecordBatch.from_arrays(
            [part.column("k1"), part.column("k2"), pa.array(keys, pa.list_(pa.int64()))], names=["k1", "k2", "keys"]
        )


def _extractor(gone: np.ndarray | None) -> Callable[[Batches], Batches]:
    """Texts of pages; the keys that go are sorted in ``gone``, or else in a column of each page."""

    def run(batches: Batches) -> Batches:
        everywhere = set(gone.tolist()) if gone is not None else set()
        for part, pages in _pages(batches):
            own = part.column("gone").to_pylist() if gone is None else [None] * len(pages)
            texts = [
                extract_text(url, html, (set(mine) if mine else everywhere).__contains__)
                for (url, html), mine in zip(pages, own)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return run


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    lost = composite(importance(narrow.select("url", "html")))
    goes = settle(lost.filter(F.col("removable") & (F.col("lost") > 1 - THRESHOLD)).select("key"), "sitetree-gone")
    out = "page_id long, url string, text string, n_chars long"
    if goes.count() <= BROADCAST_KEYS:
        gone = np.array([r["key"] for r in goes.collect()], dtype=np.int64)
        return narrow.mapInArrow(_extractor(gone), out)
    named = narrow.withColumn("k1", F.xxhash64("url", "html")).withColumn("k2", F.xxhash64(F.lit(7), "url", "html"))
    nodes = named.mapInArrow(_node_rows, "k1 long, k2 long, keys array<long>").select("k1", "k2", F.explode("keys").alias("key"))
    mine = nodes.distinct().join(goes, "key").groupBy("k1", "k2").agg(F.collect_list("key").alias("gone"))
    return named.join(mine, ["k1", "k2"], "left").mapInArrow(_extractor(None), out)

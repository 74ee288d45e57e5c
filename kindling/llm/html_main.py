"""HTML main text by wrapper induction.

1. Every page becomes a tree of its block elements with its runs of text as leaves.
2. Trees of pages of one host are aligned by simple tree matching: the largest order-preserving
   matching of children with equal labels, found by dynamic programming at each matched pair. Every page
   of a bundle is aligned with the merged tree of those before it and then becomes part of it, so no page
   is the reference of the others. A text leaf aligned with an equal one is constant. Leaves that only
   one page of the bundle has are left out before. Pages of a host are dealt into bundles of about
   ``bundle_pages``, so a host with a third of all pages is many small tasks; a layout (the containers
   near the root) of fewer pages lies in one bundle; votes of all bundles are summed.
3. Text constant on ``min_share`` of the different pages of a host or of one of its layouts, and on
   ``min_pages`` of them, is template. Copies of a page count once, so a page that was copied often
   stays content.
4. A page's varying text is its slots. Slots of regions that are never an article (menus, headers,
   footers, sidebars, notices, adverts, forms, comments, scripts) are left out; if the page has an
   article or main element, only slots inside it count. A region that only a class or id names so
   ('has-sidebar', 'comments-open') is left out if there is an article or main elsewhere; else it counts
   if it holds more of one than there is other varying text, or most of the page's varying text.

White space of a block becomes one space; blocks are joined by one newline in page order. ``br`` and
table cells end no block. Only the tree of tags is aligned, not what a browser would compute from styles.

Defined cases: null and empty html give an empty text; markup that never ends runs to the page's end;
pages without host form a host of their own; repeated rows each get their row; other columns are not
read. Subtrees without equal text have nothing constant; their elements are merged in order.
"""
from __future__ import annotations

import html as references
import re
import sys
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.llm.common import thin, written

BUNDLE_PAGES = 64
MIN_SHARE, MIN_PAGES = 0.5, 5
#: Depth (html is 0) down to which a page's containers make its layout.
LAYOUT_DEPTH = 3
#: Templates up to this size are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 8 << 20

# Elements and names, by their meaning in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option "
    "p pre section select summary table tbody template tfoot thead tr ul".split())
NEVER = frozenset("head nav header footer aside form button select dialog menu noscript template svg object canvas".split())
NEVER_NAMES = frozenset(
    "ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo promotion related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe "
    "toolbar widget".split())
COMMENT_NAMES = frozenset("comment comments reply replies respond".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
MAIN = frozenset(("article", "main"))
CONTAINERS = frozenset("article aside body div footer form frameset header html main nav section table".split())
#: An element of the first kind ends an open one of the second, looked for up to the third.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)>", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile(r"[a-z0-9]+")


def _hash(x: str) -> int:
    return xxhash.xxh3_64_intdigest(x.encode("utf-8", "replace")) >> 1


class Page:
    """Blocks and text leaves of one page. Leaves: (node, text, in main, never article by itself or a name)."""

    def __init__(self, source: str | None):
        self.labels, self.depths, self.parents = [], [], []
        self.leaves: list[tuple[int, str, bool, bool]] = []
        self.named: list[int] = []   # elements rejected by a name only: the one around each
        self.states: list[tuple[bool, int]] = []  # of each leaf: never article, innermost named element
        self.mains: list[int] = []   # innermost named element of each article and main
        self._open: list[tuple[str, int, bool, bool, int]] = [("", -1, False, False, -1)]  # tag, node, main, never, named
        self._run: list[str] = []
        self._parse(source or "")

    def _node(self, label: str, parent: int) -> int:
        self.labels.append(label)
        self.parents.append(parent)
        self.depths.append(self.depths[parent] + 1 if parent >= 0 else 0)
        return len(self.labels) - 1

    def _flush(self):
        if self._run:
            for state in sorted({x for _, x in self._run}):
                text = " ".join("".join(t for t, x in self._run if x == state).split())
                if text:
                    _, parent, main, _, _ = next(x for x in reversed(self._open) if x[0] in BLOCK or not x[0])
                    self.leaves.append((self._node("#text", parent), text, main, state[0] or state[1] >= 0))
                    self.states.append(state)
            self._run = []

    def _text(self, raw: str):
        if raw:
            self._run.append((references.unescape(raw) if "&" in raw else raw, self._open[-1][3:]))

    def _pop_to(self, k: int):
        if any(x[0] in BLOCK for x in self._open[k:]):
            self._flush()
        del self._open[k:]

    def _close(self, tags, until=()):
        for k in range(len(self._open) - 1, 0, -1):
            tag = self._open[k][0]
            if tag in tags:
                return self._pop_to(k)
            if tag in until:
                return None
        return None

    def _start(self, tag: str, attributes: str):
        if tag == "br" or tag in ("td", "th"):
            self._run.append((" ", self._open[-1][3:]))
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        names, whole, roles, label = set(), set(), set(), tag
        if "=" in attributes:
            for key, *value in ATTRIBUTE.findall(attributes):
                value = "".join(value).lower()
                if key.lower() == "role":
                    roles.update(value.split())
                else:
                    names.update(NAME.findall(value))
                    whole.update(value.split())
                if key.lower() == "class":
                    label = f"{tag}.{value}"
        if tag in BLOCK:
            self._close(("p",), ("table", "td", "th", "button", "object"))
        if tag in ENDS:
            self._close(*ENDS[tag])
        _, parent, main, never, within = self._open[-1]
        own_main = tag in MAIN or "main" in roles
        if tag in ("html", "body", "main"):
            bad = named = False
        elif tag == "article":
            bad = not COMMENT_NAMES.isdisjoint(whole)
            named = False  # 'comments-open' is said of articles
        else:
            bad = tag in NEVER or not NEVER_ROLES.isdisjoint(roles)
            named = "main" not in roles and not NEVER_NAMES.isdisjoint(names)
        never = never or bad
        if named and not never:
            self.named.append(within)
            within = len(self.named) - 1
        if own_main and not never:
            main = True
            self.mains.append(within)
        if tag in BLOCK:
            self._flush()
            parent = self._node(label, parent)
        self._open.append((tag, parent, main, never, within))

    def _end(self, tag: str):
        for k in range(len(self._open) - 1, 0, -1):
            open_tag = self._open[k][0]
            if open_tag == tag:
                return self._pop_to(k)
            if tag not in BLOCK and open_tag in BLOCK:
                return None  # an inline end never closes a block
        return None

    def _parse(self, source: str):
        at = 0
        while m := TOKEN.search(source, at):
            self._text(source[at: m.start()])
            at = m.end()
            tag = m[2] and m[2].lower()
            if not tag:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"))
            elif m[1]:
                self._end(tag)
            elif tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else len(source)
            else:
                self._start(tag, m[3])
        self._text(source[at:])
        self._flush()

    def paths(self) -> list[int]:
        """A hash of the labels from the root to each node."""
        out: list[int] = []
        for label, parent in zip(self.labels, self.parents):
            out.append(_hash(f"{out[parent] if parent >= 0 else 0}/{label}"))
        return out

    def layout(self, paths: list[int]) -> int:
        """A hash of the set of containers near the root."""
        return _hash(" ".join(map(str, sorted({
            path for path, label, depth in zip(paths, self.labels, self.depths)
            if depth <= LAYOUT_DEPTH and label.split(".", 1)[0] in CONTAINERS}))))

    def content(self, template=frozenset()) -> list[str]:
        """Slots of the article, less the template. Named elements are let in from the outside inwards, as
        long as no article or main is in."""
        paths = self.paths() if template else None
        slots = [(text, main, within) for (node, text, main, _), (never, within) in zip(self.leaves, self.states)
                 if not never and not (template and (paths[node], _hash(text)) in template)]
        total, free = sum(len(x[0]) for x in slots), sum(len(x[0]) for x in slots if x[2] < 0)
        own, held, article = ([0] * len(self.named) for _ in range(3))
        for text, main, within in slots:
            if within >= 0:
                own[within] += len(text)
                held[within] += len(text)
                article[within] += len(text) * main
        inside: dict[int, list[int]] = {}
        for k in range(len(self.named) - 1, -1, -1):
            around = self.named[k]
            inside.setdefault(around, []).append(k)
            if around >= 0:
                held[around] += held[k]
                article[around] += article[k]
        shown, mains = {-1}, set(self.mains)
        edge = inside.get(-1, [])
        while edge and mains.isdisjoint(shown):
            found = [k for k in edge if 2 * held[k] > total or article[k] > free]
            if not found:
                break
            shown.update(found)
            free += sum(own[k] for k in found)
            edge = [k for k in edge if k not in shown] + [x for k in found for x in inside.get(k, ())]
        has_main = not mains.isdisjoint(shown)
        return [text for text, main, within in slots if within in shown and main >= has_main]


def main_text(source: str | None, template=frozenset()) -> str:
    """The article of a page: slots less the host's template, given as (path, text) hashes."""
    return "\n".join(Page(source).content(template))


class Tree:
    """Children, labels and text hashes of a skeleton."""

    def __init__(self, parents, labels, texts):
        self.labels, self.texts = labels, texts
        self.kids: list[list[int]] = [[] for _ in labels]
        self.parents = parents
        for k, p in enumerate(parents):
            if p >= 0:
                self.kids[p].append(k)
        self.roots = [k for k, p in enumerate(parents) if p < 0]
        self.known = {t for t in texts if t}

    def live(self, common: set) -> set:
        """Nodes with a text of ``common`` in or under them."""
        out = set()
        for k in range(len(self.labels) - 1, -1, -1):
            if k in out or self.texts[k] in common:
                out.add(k)
                if self.parents[k] >= 0:
                    out.add(self.parents[k])
        return out


def matching(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Pairs of nodes that simple tree matching aligns; only pairs over equal texts are followed down."""
    common = a.known & b.known
    if not common:
        return []
    live_a, live_b = a.live(common), b.live(common)

    def pair(i, j):
        if a.labels[i] != b.labels[j]:
            return 0, ()
        if a.texts[i]:
            return 1 + (a.texts[i] == b.texts[j]), ()
        if i not in live_a or j not in live_b:
            return 1, ()
        score, found = children(a.kids[i], b.kids[j])
        return 1 + score, found

    def children(x, y):
        cells = {}
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for p, i in enumerate(x):
            above, row = best[p], best[p + 1]
            for q, j in enumerate(y):
                got = pair(i, j)
                if got[1]:
                    cells[p, q] = got[1]
                row[q + 1] = max(above[q + 1], row[q], above[q] + got[0])
        found, p, q = [], len(x), len(y)
        while p and q:
            if best[p][q] == best[p - 1][q]:
                p -= 1
            elif best[p][q] == best[p][q - 1]:
                q -= 1
            else:
                p, q = p - 1, q - 1
                found.append((x[p], y[q]))
                found += cells.get((p, q), ())
        return best[len(x)][len(y)], found

    return children(a.roots, b.roots)[1]


def align(a: Tree, b: Tree) -> list[int]:
    """Text leaves of ``a`` that simple tree matching aligns with an equal leaf of ``b``."""
    return [i for i, j in matching(a, b) if a.texts[i] and a.texts[i] == b.texts[j]]


class Merged(Tree):
    """Tree of the pages merged so far, with the pages of every text leaf."""

    def __init__(self):
        super().__init__([], [], [])
        self.pages: list[list[int]] = []

    def _grow(self, parent: int, label: int, text: int) -> int:
        self.parents.append(parent)
        self.labels.append(label)
        self.texts.append(text)
        self.kids.append([])
        self.pages.append([])
        if text:
            self.known.add(text)
        return len(self.labels) - 1

    def merge(self, a: Tree, page: int):
        pairs = matching(a, self)
        known = {i: j for i, j in pairs if a.texts[i] == self.texts[j]}
        followed = {a.parents[i] for i, _ in pairs}
        todo = [(a.roots, -1, bool(pairs))]
        while todo:
            x, at, aligned = todo.pop()
            y, out, q = self.kids[at] if at >= 0 else self.roots, [], 0
            for i in x:
                to = known.get(i)
                if to is None and not aligned and not a.texts[i]:  # nothing equal under it: the next element of its label
                    to = next((y[t] for t in range(q, len(y)) if self.labels[y[t]] == a.labels[i] and not self.texts[y[t]]), None)
                if to is None:
                    to = self._grow(at, a.labels[i], a.texts[i])
                    out.append(to)
                else:
                    upto = y.index(to, q) + 1
                    out += y[q:upto]
                    q = upto
                if a.texts[i]:
                    self.pages[to].append(page)
                else:
                    todo.append((a.kids[i], to, i in followed))
            out += y[q:]
            if at >= 0:
                self.kids[at] = out
            else:
                self.roots = out


def _skeletons(batches):
    seen = set()
    for batch in batches:
        rows = [], [], [], [], [], []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(source)
            texts = [0] * len(page.labels)
            for node, text, _, _ in page.leaves:
                texts[node] = _hash(text) or 1
            sig = _hash(" ".join(map(str, texts)))
            if (host, sig) in seen:
                continue  # copies of a page meet in the task already
            if len(seen) >= 1_000_000:
                seen.clear()
            seen.add((host, sig))
            paths = page.paths()
            for column, value in zip(rows, (host, sig, page.layout(paths), page.parents, texts, paths)):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()),
             pa.array(rows[3], pa.list_(pa.int32())), *[pa.array(r, pa.list_(pa.int64())) for r in rows[4:]]],
            ["host", "sig", "layout", "parents", "texts", "paths"])


def _pruned(parents, paths, texts, shared) -> Tree:
    """The nodes over leaves of ``shared``. Under one parent, equal paths are equal labels."""
    keep = [False] * len(parents)
    for k in range(len(parents) - 1, -1, -1):
        keep[k] = keep[k] or (texts[k] != 0 and (paths[k], texts[k]) in shared)
        if keep[k] and parents[k] >= 0:
            keep[parents[k]] = True
    place, old = {-1: -1}, [k for k, kept in enumerate(keep) if kept]
    for new, k in enumerate(old):
        place[k] = new
    return Tree([place[parents[k]] for k in old], [paths[k] for k in old], [texts[k] for k in old])


def constant(pages: list[tuple]) -> dict:
    """(path, text) -> the pages of a bundle on which it is constant under alignment, from (parents, paths, texts)."""
    count: dict = {}
    for _, paths, texts in pages:
        for key in {k for k in zip(paths, texts) if k[1]}:
            count[key] = count.get(key, 0) + 1
    shared = {key for key, n in count.items() if n > 1}
    merged, out = Merged(), {}
    limit = sys.getrecursionlimit()
    try:
        for k, (parents, paths, texts) in enumerate(pages):
            tree = _pruned(parents, paths, texts, shared)
            sys.setrecursionlimit(max(limit, 2 * len(tree.labels) + 1000))  # two calls a level
            merged.merge(tree, k)
    finally:
        sys.setrecursionlimit(limit)
    for path, text, seen in zip(merged.labels, merged.texts, merged.pages):
        if text and len(set(seen)) > 1:
            out.setdefault((path, text), set()).update(seen)
    return out


def _votes(table: pa.Table) -> pa.Table:
    """Votes of a bundle: how many of its different pages have a text constant under alignment, by
    layout and (group null) in all. Path 0 has the number of pages."""
    pages = {r["sig"]: r for r in table.to_pylist()}
    ordered = [pages[s] for s in sorted(pages)]
    host, votes = ordered[0]["host"], {}

    def vote(page, path, text):
        for group in (None, ordered[page]["layout"]):
            votes[group, path, text] = votes.get((group, path, text), 0) + 1

    for k in range(len(ordered)):
        vote(k, 0, 0)
    for (path, text), seen in constant([(r["parents"], r["paths"], r["texts"]) for r in ordered]).items():
        for k in seen:
            vote(k, path, text)
    return pa.table({"host": pa.array([host] * len(votes), pa.string()), "layout": pa.array([k[0] for k in votes], pa.int64()),
                     "path": pa.array([k[1] for k in votes], pa.int64()), "text": pa.array([k[2] for k in votes], pa.int64()),
                     "n": pa.array(list(votes.values()), pa.int64())})


def templates(pages: DataFrame, bundle_pages: int = BUNDLE_PAGES, min_share: float = MIN_SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, template): (path, text) hashes of each host with constant text, from (host, html)."""
    trees = written(pages.select("host", "html").mapInArrow(
        _skeletons, "host string, sig long, layout long, parents array<int>, texts array<long>, paths array<long>"), "wrapper-trees")
    layouts = trees.groupBy("host", "layout").agg(F.count(F.lit(1)).alias("n"))
    # layouts of few pages share bundles, each whole in one; a larger one has bundles of its own
    few = F.col("n") < bundle_pages
    rest = layouts.where(few).groupBy("host").agg(F.ceil(F.sum("n") / bundle_pages).alias("rest"))
    layouts = layouts.join(rest, "host", "left").select(
        "host", "layout", F.when(few, F.lit(None)).otherwise(F.col("layout")).alias("own"),
        F.when(few, F.col("rest")).otherwise(F.ceil(F.col("n") / bundle_pages)).alias("bundles"))
    layouts = written(layouts, "wrapper-layouts")  # a join over a written table can split a large host
    dealt = trees.join(layouts, ["host", "layout"]).withColumn(
        "bundle", F.pmod(F.when(F.col("own").isNull(), F.col("layout")).otherwise(F.col("sig")), "bundles")).drop("bundles")
    dealt = dealt.repartition("host", "own", "bundle")  # the join's dealing by host alone would keep a host's bundles together
    votes = (dealt.groupBy("host", "own", "bundle").applyInArrow(_votes, "host string, layout long, path long, text long, n long")
             .groupBy("host", "layout", "path", "text").agg(F.sum("n").alias("n")))
    votes = written(votes, "wrapper-votes")
    total = votes.where("path = 0").select(F.col("host").alias("h"), F.col("layout").alias("of"), F.col("n").alias("total"))
    return (votes.where((F.col("path") != 0) & (F.col("n") >= min_pages))
            .join(total, (F.col("host") == F.col("h")) & F.col("layout").eqNullSafe(F.col("of")))
            .where(F.col("n") >= min_share * F.col("total"))
            .groupBy("host").agg(F.collect_set(F.struct("path", "text")).alias("template")))


def _extract(batches):
    for batch in batches:
        found = []
        for source, template in zip(batch.column(2), batch.column(3)):
            known = frozenset((x["path"], x["text"]) for x in template.as_py() or ())
            found.append(main_text(source.as_py(), known))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **kw) -> DataFrame:
    """(page_id, url, text) of every row."""
    src = thin(pages, page_id=id_col, url=url_col, html=html_col).select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    src = src.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)))
    known = written(templates(src.select("host", "html"), **kw), "wrapper-templates")
    size = known.agg(F.coalesce(F.sum(F.size("template") * 24 + F.octet_length("host") + 48), F.lit(0))).first()[0]
    known = F.broadcast(known) if size <= BROADCAST_BYTES else known
    return src.join(known, "host", "left").select("page_id", "url", "html", "template").mapInArrow(
        _extract, "page_id long, url string, text string")


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole pages table."""
    from kindling.sources.tables import table
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))

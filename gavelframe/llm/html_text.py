"""HTML main-text extraction with site style trees.

All pages of a host are merged into one style tree. A node is a path of block elements (tag, id and classes,
numbers in them made alike) from the root; runs of text that stand directly in it are a child of their own, a
leaf. Over the pages that have a node, its presentations are the sequences of its children; a leaf's contents
are its text blocks, link targets and image sources. Both are compared by entropy to the base of the number of pages
m, so that 0 is "always the same" and 1 "always another":

* presentation(E) = -sum p log_m p over E's presentations;
* redundancy(leaf) = the mean of log_m(pages that share it) over the leaf's contents (the entropy of a content
  that n pages share alike);
* redundancy(E) = (1 - presentation(E)) * the mean of its children's, each by its share in E's presentations;
* importance(E) = 1 - redundancy(E) * (1 - 1/m): a branch counts as important until pages speak against it.

So a branch is unimportant if neither its looks nor its contents differ from page to page, from the leaves up; one page alone
proves nothing, and there is no least number of pages. Paths lead from each leaf to all of its ancestors at
once, hence redundancies are a sum over the leaves below, one grouping whatever the depth.

Each page is then read again without its low branches: those of an importance of LOW at most, and outside articles and
main elements also those whose redundancy is REDUNDANT at least and RATIO times that of the page's main branch (the one
with most important text of its own: characters times importance). What holds the main branch stays. What the tree can't tell (pages without a host, reader comments and teasers that differ from page to page) goes by tags, roles
and whole class names of menus, headers, footers, sidebars, notices, adverts, forms and reader comments; such a name never removes
what holds all articles and main elements of the page, nor (but for comments) what holds half of its text. The text is that of the main element, else of the articles in page order (not of mere
teasers, of which more than half is link text), else of what is left of the body.

Near copies of a page count once together: a page weighs 1 / the number of pages on its host that share the block
in the middle of its text when blocks are ordered by that number.

A page is read in time linear in its size; blocks nested deeper than the parameter depth count as part of their ancestor at that
depth in the tree (each leaf has a row for each level above it). A host's low branches go to its pages as a list; those of a host with more than LISTED go page by page.

Defined cases: null html counts as empty and gives an empty text; a null url or one without a host takes part in no
tree and loses no branch by it; repeated pages of one host count once in its tree; repeated rows are each returned;
an empty table gives no rows; other columns are ignored; unclosed, misplaced and deeply nested tags are tolerated.
"""

from __future__ import annotations

import html
import re
from array import array
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import ARROW_ROWS, materialize, release, table

LOW = 0.25
REDUNDANT, RATIO = 0.1, 4.0
DEPTH = 32
LISTED = 10_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption summary".split())
#: Elements whose content is never text of the page.
MARKUP = frozenset("script style noscript template iframe object button select textarea svg canvas title video audio".split())
#: Elements that usually stand beside the article.
BESIDE = frozenset("nav footer aside form menu dialog".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
#: Whole class names, ids and roles of such elements.
SCRAP_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments comment-list complementary consent contentinfo cookie cookie-banner cookie-consent cookie-notice"
    " cookies discussion disqus disqus_thread footer gdpr menu modal nav navbar navigation newsletter notice notices popup promo promotion related related-articles related-posts replies reply search"
    " share sharing sidebar site-footer social sponsor sponsored subscribe subscription toolbar user-comments widget".split()
)
#: Of these, reader comments, which may be longer than the article.
COMMENTS = frozenset("comment comments comment-list discussion disqus disqus_thread replies reply user-comments".split())
SCRAP_OUTSIDE = frozenset("header masthead topbar site-header".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|href|src)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
#: An open item that a new one closes, unless one of the other elements stands between: by family of tags.
FAMILIES = (("li", "ul", "ol", "menu"), ("dt", "dd", "dl"), ("tr", "table"), ("td", "th", "tr", "table"))
ITEMS = {"li": (0, {"li"}), "dt": (1, {"dt", "dd"}), "dd": (1, {"dt", "dd"}), "tr": (2, {"tr"}), "td": (3, {"td", "th"}), "th": (3, {"td", "th"})}


#: The families that a tag belongs to.
FAMILY_OF = {tag: [k for k, family in enumerate(FAMILIES) if tag in family] for family in FAMILIES for tag in family}


def _key(data: str, seed: int = 0) -> int:
    """A 63-bit name of a label below the node of that name."""
    return xxh3_64_intdigest(data.encode("utf-8", "surrogatepass"), seed) >> 1


class Node:
    """An element. own: the node of the style tree that it belongs to, itself unless it is inline or too deep."""

    __slots__ = ("tag", "label", "parent", "scrap", "article", "main", "link", "own", "key", "depth", "kids", "found", "block", "nearest", "parts", "every", "limit", "soft")

    def __init__(self, tag: str, label: str, parent: Node | None, scrap: bool, soft: bool | None = False, limit: int = DEPTH) -> None:
        """scrap: markup, never text. soft: by its tag or names it stands beside the article; None if it does even with most of the text. limit: DEPTH of the page."""
        self.tag, self.label, self.parent, self.scrap, self.soft = tag, label, parent, scrap, soft
        self.limit = limit if parent is None else parent.limit
        self.parts: list[str | Node | None] = []  # text, child, or None between two blocks
        if parent is None:
            self.article = self.main = self.link = False
            self.block, self.nearest, self.every = self, [None] * len(FAMILIES), [self]  # every: the style tree's nodes of the page
            self.own, self.depth, self.key = self, 0, _key(label)
        else:
            inline = tag in INLINE
            self.article, self.main, self.link = parent.article or tag == "article", parent.main or tag == "main", tag == "a" or (inline and parent.link)
            self.block, self.nearest, self.every = parent.block if inline else self, parent.nearest, parent.every
            if tag in FAMILY_OF:
                self.nearest = self.nearest.copy()
                for k in FAMILY_OF[tag]:
                    self.nearest[k] = self
            own = parent.own
            if inline or own.depth >= self.limit:
                self.own = own
                return
            self.own, self.depth, self.key = self, own.depth + 1, _key(label, own.key)
            own.kids.append(self.key)
            self.every.append(self)
        self.kids: list[int] = []  # names of the children in page order; texts of one place are one child
        self.found: list[int] = []  # names of its leaf's contents


def parse(source: str, depth: int = DEPTH) -> Node:
    """A tolerant tree of the page; text stands in parts in page order, with None at the borders of blocks. depth: of the style tree."""
    top = node = Node("html", "html", None, False, limit=depth)
    open_: Counter[str] = Counter()
    some_soft = False
    at, size, last = 0, len(source), source.rfind(">") + 1

    def leave(to: Node) -> None:
        nonlocal node
        while node is not to:
            open_[node.tag] -= 1
            node = node.parent

    while at < size:
        match = TOKEN.search(source, at, last)
        if match is None:
            node.parts.append(source[at:])
            break
        if match.start() > at:
            node.parts.append(source[at : match.start()])
        at = match.end()
        closing, tag, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if tag in ("html", "body", "head"):  # their own content is void, raw or belongs to the body
            continue
        if closing:
            if open_[tag]:
                up = node
                while up.tag != tag:
                    up = up.parent
                leave(up.parent)
                if tag not in INLINE:
                    node.parts.append(None)
            continue
        if tag == "br":
            node.parts.append(" ")
            continue
        if tag in RAW:
            end = ENDS[tag].search(source, at)
            at = end.end() if end else size
            node.parts.append(None)
            continue
        names, label = (), tag
        if attributes and "=" in attributes:
            names = []
            for kind, *values in ATTRIBUTE.findall(attributes):
                value = next((v for v in values if v), "")
                if kind.lower() in ("href", "src"):
                    if tag in ("a", "img"):
                        node.own.found.append(_key(value, LINK))
                    continue
                value = value.lower()
                names += value.split()
                if kind.lower() != "role":
                    label += ("#" if kind.lower() == "id" else ".") + ".".join(sorted(re.sub(r"[0-9]+", "0", value).split()))
        if tag in VOID:
            if tag not in INLINE:
                node.parts.append(None)
            continue
        if tag not in INLINE:
            if node.block.tag == "p":
                leave(node.block.parent)
                node.parts.append(None)
            if tag in ITEMS:
                family, same = ITEMS[tag]
                item = node.nearest[family]
                if item is not None and item.tag in same:
                    leave(item.parent)
                    node.parts.append(None)
        outside = not (node.article or node.main)
        soft = tag in BESIDE or not SCRAP_NAMES.isdisjoint(names) or (outside and (tag == "header" or not SCRAP_OUTSIDE.isdisjoint(names)))
        child = Node(tag, label, node, node.scrap or tag in MARKUP, None if soft and not COMMENTS.isdisjoint(names) else soft)
        some_soft = some_soft or soft
        open_[tag] += 1
        if tag not in INLINE:
            node.parts.append(None)
        node.parts.append(child)
        node = child
    if some_soft:
        _judge(top)
    return top


def _judge(top: Node) -> None:
    """Which of the soft elements are scrap: those that don't hold all articles and main elements of the page (themselves included), and (but for reader comments) less than half of its text."""
    nodes = list(_walk(top))
    size, roots = {}, {}
    for n in reversed(nodes):  # children before their parents
        inner = [p for p in n.parts if isinstance(p, Node)]
        roots[n] = 0 if n.scrap else (n.tag in ("article", "main")) + sum(roots[c] for c in inner)
        size[n] = 0 if n.scrap else sum(len(p.strip()) for p in n.parts if isinstance(p, str)) + sum(size[c] for c in inner)
    half, every = size[top] / 2, roots[top]
    for n in nodes:
        soft = n.soft is not False and not (every and roots[n] == every) and (n.soft is None or size[n] < half)
        n.scrap = n.scrap or soft or (n.parent is not None and n.parent.scrap)


def _below(node: Node, keep=lambda child: True) -> Iterator[tuple[str | None, Node]]:
    """The texts below a node in page order, None between blocks, and the element that holds each; without children that keep() refuses."""
    stack = [(node, iter(node.parts))]
    while stack:
        holder, parts = stack[-1]
        part = next(parts, stack)
        if part is stack:
            stack.pop()
        elif not isinstance(part, Node):
            yield part, holder
        elif keep(part):
            stack.append((part, iter(part.parts)))


def _walk(top: Node) -> Iterator[Node]:
    """All nodes from top on, before their children."""
    stack = [top]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))


def _blocks(node: Node, keep=lambda child: True) -> Iterator[tuple[str, Node, int]]:
    """Each text block with the element that it began in, and how much of it is link text."""
    run: list[str] = []
    holder, linked = node, 0
    for part, at in [*_below(node, keep), (None, node)]:
        if part is not None:
            holder = holder if run else at
            run.append(part)
            linked += len(part) if at.link else 0
        elif run:
            if text := " ".join(html.unescape("".join(run)).split()):
                yield text, holder, linked
            run, linked = [], 0


def _article(top: Node, keep) -> list[str]:
    """The blocks of the main element, or of the articles but for teasers; empty if the page has neither."""
    roots = [n for n in _walk(top) if n.tag in ("article", "main") and not n.scrap]
    mains = [n for n in roots if n.tag == "main" and not n.parent.main]
    if mains:
        return [text for n in mains for text, *_ in _blocks(n, keep)]
    parts = [list(_blocks(n, keep)) for n in roots if n.tag == "article" and not n.parent.article]
    teasers = [2 * sum(linked for *_, linked in p) > sum(len(text) for text, *_ in p) for p in parts]
    return [text for p, teaser in zip(parts, teasers, strict=True) if not teaser or all(teasers) for text, *_ in p]


def kept_blocks(top: Node, redundancy: Mapping[int, float], low: float = LOW) -> list[str]:
    """The blocks of one page; redundancy: of its host's nodes in the style tree (those below REDUNDANT / RATIO may be missing)."""
    main, path = 0.0, set()
    if redundancy:
        size: Counter[int] = Counter()
        at: dict[int, Node] = {}
        for text, holder, _ in _blocks(top):
            own = holder.own
            while own.tag in TEXTUAL and own.parent is not None:
                own = own.parent.own
            if not holder.scrap:
                size[own.key] += len(text)
                at[own.key] = own
        if size:
            most = max(size, key=lambda k: size[k] * (1 - redundancy.get(k, 0.0)))
            main, up = redundancy.get(most, REDUNDANT / RATIO), at[most]
            while up is not None:  # what holds the main branch stays
                path.add(up.own.key)
                up = up.own.parent

    def keep(node: Node) -> bool:
        if node.scrap:
            return False
        if node.own is not node or node.tag in TEXTUAL or node.key in path:
            return True
        r = redundancy.get(node.key, 0.0)
        return not (r >= 1 - low or (r >= REDUNDANT and r >= RATIO * main and not (node.article or node.main)))

    return _article(top, keep) or [text for text, *_ in _blocks(top, keep)]


PRESENTATION, CHILD, CONTENT, CHAIN, BLOCK = range(5)
#: Seeds that part names of texts and links.
TEXT, LINK = 1, 2


def style_rows(top: Node) -> Iterator[tuple[int, int, int, float, list[int] | None]]:
    """(node, kind, value, n, above) of a page for the style tree.

    PRESENTATION: a sequence of children and its share in the node's occurrences; CHILD: a child and its share
    in the node's presentations; CONTENT: a content of a leaf and its share there; CHAIN: a leaf and the nodes
    from the root down to it; BLOCK: a block of the page's text (of its article, if it has one) and its characters.
    """
    inside: dict[int, int] = {}
    outside: dict[int, int] = {}
    for text, holder, _ in _blocks(top):
        name = _key(text, TEXT)
        holder.own.found.append(name)
        if not holder.scrap:
            of = inside if holder.article or holder.main else outside
            of[name] = of.get(name, 0) + len(text)
    by_key: dict[int, list[Node]] = {}
    for n in top.every:
        if n.found:
            n.kids.append(_key("#text", n.key))
        by_key.setdefault(n.key, []).append(n)
    for key, same in by_key.items():
        looks: dict[int, float] = {}
        children: dict[int, float] = {}
        contents: dict[int, int] = {}
        part = 1 / len(same)
        for n in same:
            look = xxh3_64_intdigest(array("q", n.kids).tobytes()) >> 1
            looks[look] = looks.get(look, 0) + part
            for kid in n.kids:
                children[kid] = children.get(kid, 0) + part / len(n.kids)
            for content in n.found:
                contents[content] = contents.get(content, 0) + 1
        for look, share in looks.items():
            yield key, PRESENTATION, look, share, None
        for kid, share in children.items():
            yield key, CHILD, kid, share, None
        if contents:
            leaf, total = _key("#text", key), sum(contents.values())
            for content, times in contents.items():
                yield leaf, CONTENT, content, times / total, None
            above, up = [leaf], same[0]
            while up is not None:
                above.append(up.own.key)
                up = up.own.parent
            yield leaf, CHAIN, 0, 0.0, above[::-1]
    for name, size in (inside or outside).items():
        yield 0, BLOCK, name, float(size), None


HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"


def host(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), HOST, 1))


def style_nodes(pages: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The rows of style_rows() for every page of every host, with host, page (a hash of the html) and times, how often the host has the page."""
    names = ["host", "page", "times", "node", "kind", "value", "n", "above"]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.float64(), pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for site, page, times, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = list(style_rows(parse(source, depth)))
                for column, value in zip(out, (site, page, times), strict=False):
                    column += [value] * len(rows)
                for column, values in zip(out[3:], zip(*rows, strict=True), strict=True):
                    column += values
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    keyed = pages.select(host().alias("host"), F.xxhash64(body).alias("page"), body.alias("html")).where(F.col("host") != "")
    several = keyed.groupBy("host", "page").agg(F.count("*").alias("times")).where("times > 1")
    several = materialize(several, "repeated-pages")
    if several.isEmpty():
        rows = keyed.select("host", "page", F.lit(1).cast("long").alias("times"), "html")
    else:
        rows = keyed.join(several, ["host", "page"], "left").select("host", "page", F.coalesce("times", F.lit(1)).alias("times"), "html")
    return materialize(rows.mapInArrow(run, "host string, page long, times long, node long, kind byte, value long, n double, above array<long>"), "style-nodes", ARROW_ROWS)


def style_tree(every: DataFrame) -> DataFrame:
    """host, node, n_pages (near copies count once) and redundancy (1 - importance) of every node of style_nodes()."""
    blocks = every.where(F.col("kind") == BLOCK).select("host", "page", "times", "value", "n")
    shared = materialize(blocks.groupBy("host", "value").agg(F.round(F.sum(1 / F.col("times"))).alias("pages")).where("pages > 1"), "shared")
    # of pages that are the same, all blocks are the same as well
    weights = blocks.join(shared, ["host", "value"], "left").groupBy("host", "page").agg(F.expr("1 / percentile(coalesce(pages, 1), 0.5, cast(n AS long))").alias("w"))
    weights = materialize(weights.where("w < 1"), "weights")
    rows = every.where(F.col("kind").isin(PRESENTATION, CHILD, CONTENT)).drop("above").join(weights, ["host", "page"], "left").withColumn("w", F.coalesce("w", F.lit(1.0)) / F.col("times"))
    # one row per (host, node, kind, value): counts before any group of a host meets
    values = materialize(rows.groupBy("host", "node", "kind", "value").agg(F.sum(F.col("w") * F.col("n")).alias("mass"), F.sum("w").alias("pages")), "values")
    of = lambda kind: values.where(F.col("kind") == kind)
    several = F.col("m") > 1 + 1e-9
    looks = of(PRESENTATION).groupBy("host", "node").agg(F.sum("mass").alias("m"), F.sum(F.col("mass") * F.log("mass")).alias("mlogm"))
    looks = looks.select("host", "node", "m", F.when(several, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("mlogm") / F.col("m") / F.log("m")))).otherwise(0.0).alias("alike"))
    looks = materialize(looks, "looks")
    leaves = of(CONTENT).groupBy("host", "node").agg(F.sum("mass").alias("m"), F.sum(F.col("mass") * F.log(F.greatest("pages", F.lit(1.0)))).alias("shared"))
    leaves = leaves.select("host", F.col("node").alias("leaf"), "m", F.when(several, F.least(F.lit(1.0), F.col("shared") / F.col("m") / F.log("m"))).otherwise(0.0).alias("own"))
    # (1 - presentation) * share of each step from a node to a child
    steps = of(CHILD).join(looks, ["host", "node"]).select("host", "node", F.col("value").alias("child"), (F.col("alike") * F.col("mass") / F.col("m")).alias("factor"))
    steps = materialize(steps.where("factor > 0"), "steps")
    chains = every.where(F.col("kind") == CHAIN).groupBy("host", F.col("node").alias("leaf")).agg(F.max("above").alias("above"))
    paths = materialize(leaves.join(chains, ["host", "leaf"]), "paths")
    walked = paths.where("own > 0").select("host", "leaf", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("above") - 2), lambda k: F.struct(F.col("above")[k].alias("node"), F.col("above")[k + 1].alias("child")))).alias("k", "step"))
    factors = walked.select("host", "leaf", "k", "step.node", "step.child").join(steps, ["host", "node", "child"])
    factors = factors.groupBy("host", "leaf").agg(F.sort_array(F.collect_list(F.struct("k", "factor"))).alias("f"))  # DEPTH + 1 at most
    joined = paths.join(factors, ["host", "leaf"])
    depth = F.size("above") - 1
    # from a node in place i down to the leaf; steps without a factor leave nothing to their ancestors
    ancestors = joined.select("host", "leaf", "own", "above", "f", depth.alias("d"), F.explode(F.sequence(F.lit(0), depth - 1)).alias("i"))
    below = F.filter("f", lambda x: x["k"] >= F.col("i"))
    product = F.aggregate(below, F.lit(1.0), lambda p, x: p * x["factor"])
    parts = ancestors.where(F.size(below) == F.col("d") - F.col("i")).select("host", F.col("above")[F.col("i")].alias("node"), (product * F.col("own")).alias("r"))
    sums = parts.groupBy("host", "node").agg(F.sum("r").alias("r"))
    redundancy = F.coalesce(F.col("r"), F.lit(0.0)) * (1 - 1 / F.greatest("m", F.lit(1.0)))
    return looks.join(sums, ["host", "node"], "left").select("host", "node", F.round("m", 6).alias("n_pages"), F.round(redundancy, 9).alias("redundancy"))


def extract(pages: DataFrame, low: float = LOW, depth: int = DEPTH) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    every = style_nodes(pages, depth)
    found = materialize(style_tree(every).where(F.col("redundancy") >= REDUNDANT / RATIO).select("host", "node", "redundancy"), "style-tree")
    sizes = materialize(found.groupBy("host").agg(F.count("*").alias("size")), "sizes")
    rule = F.collect_list(F.struct("node", "redundancy"))
    listed = materialize(found.join(sizes.where(F.col("size") <= LISTED), "host").groupBy("host").agg(rule.alias("rules")), "rules")
    many = sizes.where(F.col("size") > LISTED).select("host")
    body = F.col("html").cast("string")
    joined = pages.select("page_id", "url", body.alias("html"), host().alias("host")).join(listed, "host", "left")
    if not many.isEmpty():
        there = every.where(F.col("kind") == PRESENTATION).select("host", "page", "node").distinct().join(many, "host", "left_semi")
        single = materialize(there.join(found, ["host", "node"]).groupBy("host", "page").agg(rule.alias("own_rules")), "page-rules")  # a page's own nodes
        joined = joined.withColumn("page", F.xxhash64(F.coalesce("html", F.lit("")))).join(single, ["host", "page"], "left").withColumn("rules", F.coalesce("rules", "own_rules"))
    joined = joined.select("page_id", "url", "html", F.col("rules.node").alias("nodes"), F.col("rules.redundancy").alias("redundancy"))
    kinds = [joined.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                "\n".join(kept_blocks(parse(source or "", depth), dict(zip(nodes or (), values or (), strict=True)), low))
                for source, nodes, values in zip(*(batch.column(c).to_pylist() for c in ("html", "nodes", "redundancy")), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    out = materialize(joined.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long"), "texts", ARROW_ROWS)
    release(every, found, sizes, listed)
    return out


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))

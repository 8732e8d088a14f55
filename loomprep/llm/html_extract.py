"""HTML extraction with a site style tree.

The pages of one host are merged into a style tree: a node is a path of
elements, each with its tag and its class and id words.  For every node the
pages' distribution over presentations (the sequence of child elements) and,
where text stands directly in it, over contents is counted.  A node's own
importance is the entropy of its distribution relative to the entropy if every
page differed: 0 if all pages show the same, 1 if none repeats.  Importance of
a branch mixes its own entropy with that of the nodes below it.  Branches of
low importance are removed from every page of the host; so are elements whose
tag or names say that they are menus, footers, sidebars, notices, adverts,
forms or comments, but never by a name alone what holds the main part of the
page.  If a page marks an article (or else a main part) that is not a small
share of what is left, only what stands there is kept.  Equal pages count once, so that copies of an
article do not make it look like a template, and nodes seen on fewer than
``MIN_PAGES`` different pages of a host are not judged.

Counts are summed by (host, node, content) on the map side first, then by
(host, node).  Importance goes up the tree level by level: the nodes of a level
are joined to the weighted sums of their children, which are summed by (host,
parent) on the map side, so a host with a third of all pages is spread by its
nodes.  Only what lies under one node at ``LEVELS`` + 1 elements below the top is
judged in one task.  The low nodes without a low parent are a short list for each
host that is joined to the pages by Spark's own choice of join.

Defined cases: null and empty html give an empty text; broken markup is read
as browsers do (unclosed paragraphs and items end at the next one, closing
tags close what is open inside, an unfinished tag at the end is dropped); a
null url has the host ''; repeated rows give repeated results; other columns
are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from functools import lru_cache, reduce
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ..session import materialize
from ..sources.tables import table

LOW, MIN_PAGES, OWN_SHARE = 0.3, 8, 0.5
SMALL, MOST = 0.25, 0.5  # shares of a page's text
LEVELS = 12              # levels of the style tree that are judged one by one

#: Elements and name words by their role.
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd
    label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("""area base br col embed hr img input link meta param source track wbr""".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
DROP_TAGS = frozenset("""script style noscript template iframe object embed svg canvas math head
    title nav aside footer form button select option textarea input dialog menu audio video""".split())
DROP_NAMES = frozenset("""ad ads advert adverts advertisement advertising adsense banner banners
    sponsor sponsored sponsors promo promos promotion menu menus nav navbar navigation breadcrumb
    breadcrumbs footer foot footnav header masthead topbar toolbar sidebar sidebars aside rail
    notice notices alert cookie cookies consent gdpr popup modal overlay newsletter subscribe
    subscription signup login form comment comments commentlist respond reply replies disqus
    discussion feedback share sharing social related recommended recommendations teaser teasers
    widget widgets skip copyright legal disclaimer pagination pager outbrain taboola""".split())
DROP_ROLES = frozenset("""navigation banner contentinfo complementary search dialog alert
    alertdialog menu menubar form""".split())
MAIN_NAMES = frozenset("article main content post entry story articlebody".split())
#: Names that start so tell of something else than the element itself.
ABOUT = frozenset("has no with without category tag".split())
#: An opening tag on the left ends an open element on the right, up to the scope.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
        "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}

_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAG_STOP = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"[ \t\n\r\f\v\x1c-\x1f\x85\xa0  -     　]+")
_NAME = re.compile(r"[a-z]+")
_ZEROS, _HUGE = re.compile("&#0+(?=[0-9])"), re.compile("&#[0-9]{8,};?")


class Scanner:
    """Markup of a source from left to right, in linear time.

    A tag ends at the first ``>`` outside quotes.  Where a quote is never closed
    there is no tag, and its ``<`` is text; such quotes are remembered, so that
    no later tag runs into them again."""

    def __init__(self, source: str):
        self.source = source
        self.last = source.rfind(">")
        self.open_quotes: set[int] = set()      # quotes from which no tag end is reached
        self.free = (0, 0)                      # a stretch without > and quotes

    def _stop(self, at: int) -> int:
        """Place of the next > or quote; the length of the source if there is none."""
        lo, hi = self.free
        if not lo <= at <= hi:
            m = _TAG_STOP.search(self.source, at)
            lo, hi = self.free = at, m.start() if m else len(self.source)
        return hi

    def _tag_end(self, at: int) -> int:
        """Place of the > that ends a tag whose attributes start at ``at``, or -1."""
        source, passed = self.source, []
        k = self._stop(at)
        while k < len(source) and k not in self.open_quotes:
            if source[k] == ">":
                return k
            passed.append(k)
            close = source.find(source[k], k + 1)
            m = _TAG_STOP.search(source, close + 1) if close >= 0 else None
            if m is None:
                break
            k = m.start()
        self.open_quotes.update(passed)
        return -1

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """The next markup: start, end, tag ('' for comments and the like), whether it
        closes, attributes."""
        source = self.source
        while (start := source.find("<", at)) >= 0:
            at = start + 1
            if source.startswith("!--", at):
                end = source.find("-->", at + 3)
                return start, len(source) if end < 0 else end + 3, "", False, ""
            closes = source.startswith("/", at)
            name = _TAG_NAME.match(source, at + closes)
            if name:
                end = self._tag_end(name.end())
                if end >= 0:
                    return start, end + 1, name[0].lower(), closes, source[name.end():end]
            if source[at:at + 1] in ("!", "?", "/") or name and start > self.last:
                end = source.find(">", at + 1)
                return start, len(source) if end < 0 or start > self.last else end + 1, "", False, ""
        return None


def decoded(text: str) -> str:
    """Text with its character references decoded, however long their numbers."""
    if "&#" in text:
        text = _HUGE.sub("\ufffd", _ZEROS.sub("&#", text))
    return html_lib.unescape(text)


@lru_cache(maxsize=20_000)
def _traits(tag: str, attributes: str) -> tuple[int, bool, bool, bool, str]:
    """What an element says by itself: its rank as main part, whether part of a name
    marks one, whether it is dropped, whether a name drops it, its style."""
    found: dict = {}
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    kind, name = found.get("class", ""), found.get("id", "")
    names = [_NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", n).lower())
             for n in f"{kind} {name}".split()]
    role = found.get("role", "").lower()
    main = 0
    if tag == "article" or role == "article":
        main = 3
    elif tag == "main" or role == "main":
        main = 2
    elif any(len(n) == 1 and n[0] in MAIN_NAMES or "".join(n) == "articlebody" for n in names):
        main = 1
    marked = any(w in MAIN_NAMES for n in names for w in n)
    drop = tag in DROP_TAGS or role in DROP_ROLES or "hidden" in found
    allowed = ("header", "related") if tag in ("article", "main") else ()
    by_name = tag not in ("html", "body") and any(
        w in DROP_NAMES and w not in allowed for n in names if n[:1] and not (
            len(n) > 1 and n[0] in ABOUT) for w in n)
    # running numbers in names do not make another node
    kind, name = re.sub("[0-9]{3,}", "0", kind), re.sub("[0-9]+", "0", name)
    return main, marked, drop, by_name, f"{tag} {kind}#{name}"


class Element:
    """An open element: its node in the style tree and what its names say.

    ``level``: its distance from the top; ``branch``: the node of the element around it,
    or itself, that is ``LEVELS`` + 1 below the top; ``block``: the nearest element, this one included, that is not inline, at place
    ``depth`` of the open elements; ``named`` and ``marked``: the nearest element, this
    one included, whose names say that it is dropped or the main part."""

    __slots__ = ("tag", "node", "drop", "parent", "block", "depth", "named", "named_above",
                 "main", "marked", "marked_above", "children", "level", "branch")

    def __init__(self, tag: str, attributes: str, parent: Element | None, depth: int):
        traits = _traits if len(attributes) <= 200 else _traits.__wrapped__   # only short ones are kept
        main, marked, drop, by_name, style = traits(tag, attributes)
        self.tag, self.parent = tag, parent
        if tag in INLINE:
            self.block, self.depth = parent.block, parent.depth
        else:
            self.block, self.depth = self, depth
        self.main = max(parent.main, main) if parent else 0
        # part of a name marks the main part only where most of the text stands
        self.marked_above = parent.marked if parent else None
        self.marked = self if marked else self.marked_above
        self.drop = bool(parent and parent.drop) or drop or tag == "header" and self.main < 2
        self.named_above = parent.named if parent else None
        self.named = self if by_name else self.named_above
        self.node = xxh3_64_intdigest(f"{parent.node if parent else 0}>{style}") >> 1
        self.level = parent.level + 1 if parent else 0
        self.branch = parent.branch if self.level > LEVELS + 1 else self.node
        self.children: list[str] = []

    @property
    def apart(self) -> bool:
        return self.drop or self.named is not None


def _above(blocks, first: str, onward: str) -> list[Element]:
    """The elements that blocks stand under by the links, outer ones first."""
    known: dict = {}
    for b in blocks:
        chain, e = [], getattr(b[2], first)
        while e is not None and e not in known:
            chain.append(e)
            e = getattr(e, onward)
        known.update(dict.fromkeys(reversed(chain)))
    return list(known)


class Page:
    """Text blocks in page order, and every element of a page."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, bool, Element]] = []      # text, drop, innermost element
        self.elements: list[Element] = []
        self.root = Element("#page", "", None, 0)
        self.stack = [self.root]
        self.open_tags: dict[str, int] = {}
        self.text: list[str] = []
        self._read(source)
        while self.stack:
            self._close()
        self._spare()

    def _spare(self) -> None:
        """Blocks under a dropping name go, unless what it names holds the main part."""
        open_blocks = [b for b in self.blocks if not b[1]]
        if any(b[2].named for b in open_blocks):
            total = sum(len(b[0]) for b in open_blocks)
            plain = [(b[2].main, len(b[0])) for b in open_blocks if b[2].main >= 2 and not b[2].named]
            above = _above(self.blocks, "named", "named_above")
            held = {e: [0] * 4 for e in above}              # text by the main part that it stands in
            for text, _, at in open_blocks:
                if at.named:
                    held[at.named][at.main] += len(text)
            for e in reversed(above):
                if e.named_above:
                    outer = held[e.named_above]
                    outer[:] = [x + y for x, y in zip(outer, held[e])]
            article = any(main == 3 for main, _ in plain)
            kept = sum(n for _, n in plain) >= SMALL * total
            gone: dict = {}
            for e in above:
                n, part = sum(held[e]), sum(held[e][max(e.main, 1) + 1:])   # in all, further in
                spared = not kept and (n > MOST * total and not article
                                       or part and part >= SMALL * total)
                gone[e] = not spared or gone.get(e.named_above, False)
            self.blocks = [(t, drop or gone.get(at.named, False), at) for t, drop, at in self.blocks]

    def _flush(self) -> None:
        if self.text:
            block = _SPACE.sub(" ", decoded("".join(self.text))).strip(" ")
            self.text = []
            if block:
                self.blocks.append((block, self.stack[-1].drop, self.stack[-1]))

    def _close(self) -> None:
        top = self.stack[-1]
        if top.tag not in INLINE or top.apart:
            self._flush()
        self.stack.pop()
        self.open_tags[top.tag] = self.open_tags.get(top.tag, 0) - 1
        if top.tag not in INLINE:
            self.elements.append(top)

    def _open(self, tag: str, attributes: str) -> None:
        if tag in ENDS or tag not in INLINE:
            ended, scope = ENDS.get(tag, ((), ()))
            while (k := self.stack[-1].depth) > 0:      # inline elements end with what holds them
                t = self.stack[k].tag
                if t not in ended and t != "p":
                    break
                while len(self.stack) > k:
                    self._close()
                if t != "p":
                    break
        if tag == "br":
            self.text.append(" ")
            return
        element = Element(tag, attributes, self.stack[-1], len(self.stack))
        if tag not in INLINE or element.apart and not self.stack[-1].apart:
            self._flush()
            self.stack[-1].block.children.append(tag)
        if tag not in VOID:
            self.stack.append(element)
            self.open_tags[tag] = self.open_tags.get(tag, 0) + 1

    def _read(self, source: str) -> None:
        at, scanner = 0, Scanner(source)
        while found := scanner.next(at):
            start, end, tag, closes, attributes = found
            self.text.append(source[at:start])
            at = end
            if not tag:
                continue
            if closes:
                if tag == "br":
                    self.text.append(" ")
                elif self.open_tags.get(tag):
                    while self.stack[-1].tag != tag:
                        self._close()
                    self._close()
                continue
            if tag in RAW:
                stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I).search(source, at)
                at = stop.end()
                if tag == "textarea" and not self.stack[-1].apart:
                    self._flush()
                continue
            self._open(tag, attributes)
        self.text.append(source[at:])

    def main_text(self, low=frozenset()) -> str:
        branch: dict = {None: False}            # element: whether it is in a low branch
        if low:
            for e in _above(self.blocks, "block", "parent"):
                branch[e] = branch[e.parent] or e.node in low
        kept = [(t, at) for t, drop, at in self.blocks if not drop and not branch.get(at.block)]
        total = sum(len(t) for t, _ in kept)
        above = _above(self.blocks, "marked", "marked_above")
        held = dict.fromkeys(above, 0)
        for t, at in kept:
            if at.marked:
                held[at.marked] += len(t)
        for e in reversed(above):
            if e.marked_above:
                held[e.marked_above] += held[e]
        # what an element holds stands in those around it too: the outermost one decides
        most: dict = {None: False}
        for e in above:
            most[e] = most[e.marked_above] or held[e] > MOST * total
        levels = [at.main or int(most[at.marked]) for _, at in kept]
        size = [sum(len(t) for (t, _), level in zip(kept, levels) if level >= k) for k in range(4)]
        # articles that hold less than what else stands in a main part are cards in it
        best = 3 if size[3] and size[3] >= max(SMALL * total, MOST * size[2]) else next(
            (k for k in (2, 1) if size[k] and size[k] >= SMALL * total), 0)
        return "\n\n".join(t for (t, _), level in zip(kept, levels) if level >= best)


def _observe(batches):
    """(host, node, parent, level, branch, kind, value): what each different page shows at
    its nodes; kind 0: child elements, 1: text."""
    for batch in batches:
        hosts, sources = batch.column("host").to_pylist(), batch.column("html").to_pylist()
        rows: list[list] = [[] for _ in range(8)]
        for host, source in zip(hosts, sources):
            page = Page(source or "")
            shown = xxh3_64_intdigest("\0".join(b[0] for b in page.blocks if not b[1])) >> 1
            values = [(e, 0, " ".join(e.children)) for e in page.elements]
            values += [(at.block, 1, text) for text, _, at in page.blocks]
            for e, kind, value in values:
                parent = e.parent.node if e.parent else 0
                for column, x in zip(rows, (host, e.node, parent, e.level, e.branch, kind,
                                            xxh3_64_intdigest(value) >> 1, shown)):
                    column.append(x)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(),
                 pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(rows, kinds)],
            names=["host", "node", "parent", "level", "branch", "kind", "value", "page"])


def _mixed(own: float | None, content: float | None, below: float | None) -> float:
    """Importance of a branch by its node's presentation and content and what is below."""
    parts = [x for x in (content, below) if x is not None]
    if not parts:                                     # no text here or below: presentation only
        return 1.0 if own is None else own
    inner = max(parts)
    return inner if own is None else max(inner, OWN_SHARE * own + (1 - OWN_SHARE) * inner)


def _mixed_column() -> Column:
    """``_mixed`` of the columns own, content and below."""
    inner = F.greatest("content", "below")            # nulls are left out
    return F.when(inner.isNull(), F.coalesce("own", F.lit(1.0))).when(
        F.col("own").isNull(), inner).otherwise(
        F.greatest(inner, OWN_SHARE * F.col("own") + (1 - OWN_SHARE) * inner))


def _deep(key, rows):
    """Importance of the nodes under one branch, from the leaves up."""
    at = {c: rows[c].to_pylist() for c in ("node", "parent", "level", "own", "content", "pages")}
    sums: dict = {}                                   # parent: weighted importance, weight
    total = [0.0] * rows.num_rows
    for i in sorted(range(rows.num_rows), key=lambda i: (-at["level"][i], at["node"][i])):
        weighted, weight = sums.get(at["node"][i], (0.0, 0))
        total[i] = _mixed(at["own"][i], at["content"][i], weighted / weight if weight else None)
        weighted, weight = sums.get(at["parent"][i], (0.0, 0))
        pages = at["pages"][i]
        sums[at["parent"][i]] = weighted + total[i] * pages, weight + pages
    return pa.table({**{c: rows[c] for c in ("host", "node", "parent", "level", "pages")},
                     "total": pa.array(total, pa.float64())})


def host_of(url: str = "url") -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1),
                              F.lit("")))


def importance(pages: DataFrame) -> DataFrame:
    """host, node, parent, level, pages, total (importance of the branch)."""
    seen = pages.select(host_of().alias("host"), "html").mapInArrow(
        _observe, "host string, node long, parent long, level int, branch long, kind int, "
                  "value long, page long").distinct()
    path = ["host", "node", "parent", "level", "branch"]
    contents = seen.groupBy(*path, "kind", "value").agg(F.count("*").alias("n"))
    shown = contents.groupBy(*path, "kind").agg(
        F.sum("n").alias("shown"), F.sum(F.col("n") * F.log("n")).alias("repeats"))
    entropy = (F.log("shown") - F.col("repeats") / F.col("shown")) / F.log("shown")
    shown = shown.withColumn("own", F.when(F.col("shown") > 1, F.least(F.lit(1.0), F.greatest(
        F.lit(0.0), entropy))))
    nodes = materialize(shown.groupBy(*path).agg(
        F.max(F.when(F.col("kind") == 0, F.col("own"))).alias("own"),
        F.max(F.when(F.col("kind") == 1, F.col("own"))).alias("content"),
        F.max("shown").alias("pages")), "style-nodes")

    names = ["host", "node", "parent", "level", "pages", "total"]
    deepest = nodes.agg(F.max("level")).first()[0] or 0
    rated = [materialize(nodes.where(F.col("level") > LEVELS).groupBy("host", "branch").applyInArrow(
        _deep, "host string, node long, parent long, level int, pages long, total double"
    ).select(names), "style-deep")] if deepest > LEVELS else []
    for level in range(min(deepest, LEVELS), -1, -1):
        here = nodes.where(F.col("level") == level)
        if rated:
            below = rated[-1].where(F.col("level") == level + 1).groupBy(
                F.col("host").alias("up_host"), F.col("parent").alias("up")).agg(
                (F.sum(F.col("total") * F.col("pages")) / F.sum("pages")).alias("below"))
            here = here.join(below, (F.col("host") == F.col("up_host")) & (F.col("node") == F.col("up")),
                             "left")
        else:
            here = here.withColumn("below", F.lit(None).cast("double"))
        rated.append(materialize(here.withColumn("total", _mixed_column()).select(names), "style-level"))
    return reduce(DataFrame.unionByName, rated)


def low_branches(pages: DataFrame) -> DataFrame:
    """host, low (nodes of low importance whose parents are not); hosts without any are left out."""
    low = importance(pages).where((F.col("total") < LOW) & (F.col("pages") >= MIN_PAGES))
    above = low.select(F.col("host").alias("up_host"), F.col("node").alias("up"))
    top = low.join(above, (F.col("host") == F.col("up_host")) & (F.col("parent") == F.col("up")),
                   "left_anti")
    return materialize(top.groupBy("host").agg(F.collect_list("node").alias("low")), "low-branches")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text; one row for each input row."""
    low = low_branches(pages).withColumnRenamed("host", "low_host")

    @F.arrow_udf("string")
    def main_text(sources: pa.Array, low: pa.Array) -> pa.Array:
        known: dict = {}
        out = []
        for source, nodes in zip(sources.to_pylist(), low.to_pylist()):
            at = tuple(nodes or ())
            out.append(Page(source or "").main_text(known.setdefault(at, frozenset(at))))
        return pa.array(out, pa.string())

    joined = pages.select("page_id", "url", "html").join(
        low, host_of() == F.col("low_host"), "left")
    return joined.select("page_id", "url", main_text("html", "low").alias("text"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged: elements with the same chain of tags, classes and ids are one node. A node's
importance is built from entropies over the pages it occurs on. Presentation counts when pages show different sequences
of children there; content counts when its texts are spread over few pages each. Branches whose importance is low
against the best of their host are removed from each page, besides the elements that by their meaning are no main text
(menus, headers, footers, sidebars, notices, adverts, forms, comments). Paragraphs, headings and list items
are never removed by themselves: only the branch that holds them is judged.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import units
from vigil.llm.components import sized
from vigil.session import written

GAMMA = 0.9  # weight that presentation loses with every further style, as in the composite importance of style trees
LOW = 0.5  # a branch below this part of its host's best importance is removed
LEAST_PAGES = 8  # a host must show a branch on so many pages before it is judged

# Element names and words by which pages mark what is no main text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup"
    " time tt u var wbr".split()
)
RAW = set("script style textarea title noscript iframe template svg xmp".split())
DROPPED = set("head nav header footer aside form script style textarea title noscript iframe template svg xmp button select dialog menu object".split())
PLAIN = set("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr figcaption caption".split())
HINTS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer"
    " header masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promotion related share sharing"
    " sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
CLOSED_BY_ITSELF = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
BEFORE = set("has have no not non with without hide hides hidden show shows".split())  # has-sidebar is no sidebar
AFTER = set("open closed off on enabled disabled free less".split())  # comments-open are no comments
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


class Element:
    """An open element: its style node (0 for none), whether it is dropped or in the article, its children's styles.

    ``hinted`` are the elements from it upwards that are dropped by a form or a hint, unless they turn out to hold the
    article (``holds``) of the page.
    """

    __slots__ = ("tag", "node", "nodes", "dropped", "article", "children", "hinted", "holds")

    def __init__(self, tag, node, nodes, dropped, article, hinted=(), holds=False):
        self.tag, self.node, self.nodes, self.dropped, self.article, self.children = tag, node, nodes, dropped, article, []
        self.hinted, self.holds = hinted, holds


def hinted(value: str) -> bool:
    """Whether a class or id says that its element is no main text."""
    for token in value.split():
        said = [w.lower() for w in _WORD.findall(token)]
        for k, w in enumerate(said):
            if w in HINTS and not BEFORE.intersection(said[:k]) and not AFTER.intersection(said[k + 1:]):
                return True
    return False


def parse(text: str) -> tuple[list[tuple[str, tuple[int, ...], bool, bool]], list[tuple[int, int]]]:
    """The blocks and styles of ``parsed``."""
    return parsed(text)[:2]


def parsed(text: str) -> tuple[list[tuple[str, tuple[int, ...], bool, bool]], list[tuple[int, int]], set[int]]:
    """(blocks, styles, holders) of a page, whatever its markup is like.

    A block is (text, style nodes above it, dropped, in the article); styles are (style node, hash of its children);
    holders are the style nodes that hold the only article of the page, and those of its html, body and main elements.
    A hint drops an element that is no article or main element and holds none; one that does, and a form, are dropped
    only if there is text outside of them (in an article, if some is).
    """
    blocks, styles, parts, holders, articles = [], [], [], set(), []
    stack = [Element("", 0, (), False, False)]

    def flush():
        if parts:
            found = " ".join("".join(parts).split())
            if found:
                top = stack[-1]
                blocks.append((found, top.nodes, top.dropped, top.article, top.hinted))
            parts.clear()

    def close(depth: int):
        while len(stack) > depth:
            e = stack.pop()
            if e.node and not e.dropped:
                styles.append((e.node, xxhash.xxh3_64_intdigest(" ".join(e.children)), e.hinted))

    def depth_of(tags, stop=()):
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                return k
            if stack[k].tag in stop:
                break
        return 0

    at, end = 0, len(text)
    while at < end:
        m = _TAG.search(text, at)
        upto = m.start() if m else end
        if upto > at and not stack[-1].dropped:
            part = text[at:upto]
            parts.append(entities.unescape(part) if "&" in part else part)
        if not m:
            break
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        inline = tag in INLINE
        if m.group(1):
            k = depth_of({tag})
            if k:
                if not inline:
                    flush()
                close(k)
            continue
        if tag in VOID:
            if tag not in INLINE:
                parts.append(" ") if tag == "br" else flush()
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(text, at)
            at = stop.end() if stop else end
            continue
        if not inline:
            flush()
            for k in range(len(stack) - 1, 0, -1):  # an open paragraph ends where a block begins
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag not in INLINE:
                    break
            if tag in CLOSED_BY_ITSELF:
                k = depth_of({tag}, CLOSED_BY_ITSELF[tag])
                if k:
                    close(k)
            if tag in ("article", "main", "body"):  # menus and headers that were left open end here
                k = depth_of({"nav", "header", "head"})
                if k:
                    close(k)
        parent = stack[-1]
        dropped, label, main = parent.dropped or tag in DROPPED and tag != "form" and not (tag == "header" and parent.article), tag, tag in ("article", "main")
        hint = False
        if m.group(3) and not m.group(3).isspace():
            for name, value in _ATTRIBUTE.findall(m.group(3)):
                name, value = name.lower(), value.strip("\"'")
                if name in ("class", "id"):
                    label += f" {name}={value}"
                    hint = hint or tag not in ("html", "body") and hinted(value)
                elif name == "role":
                    dropped, main = dropped or value.lower() in ROLES and (tag, value.lower()) != ("form", "form"), main or value.lower() == "main"
                elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value.lower()):
                    dropped = True
        if not inline:
            parent.children += [label] if parent.children[-1:] != [label] else []
        if inline or tag in PLAIN:
            e = Element(tag, 0, parent.nodes, dropped or inline and hint, parent.article, parent.hinted)
        else:
            node = xxhash.xxh3_64_intdigest(label, seed=parent.nodes[-1] if parent.nodes else 0)
            e = Element(tag, node, (*parent.nodes, node), dropped, parent.article or main, parent.hinted, main or tag == "form")
        if not inline and (hint or tag == "form") and not dropped:
            e.hinted = (*parent.hinted, e)
        if main and not dropped:
            for above in parent.hinted:
                above.holds = True
            if tag == "article":
                articles.append(e.nodes)
            else:
                holders.update(e.nodes)
        elif tag in ("html", "body"):
            holders.update(e.nodes)
        stack.append(e)
    flush()
    close(1)
    if len(articles) == 1:
        holders.update(articles[0])

    def out(dropped, above):
        return dropped or any(not e.holds for e in above)

    left = [(article, len(above)) for _, _, dropped, article, above in blocks if not out(dropped, above)]
    some = any(article for article, _ in left)
    least = min((depth for article, depth in left if article or not some), default=0)
    return (
        [(t, nodes, out(dropped, above) or len(above) > least, article) for t, nodes, dropped, article, above in blocks],
        [(node, children) for node, children, above in styles if not out(False, above) and len(above) <= least], holders,
    )


def _main(blocks: list) -> list:
    """The blocks of the article (of the body if it has none) outside dropped branches."""
    kept = [b for b in blocks if not b[2]]
    return [b for b in kept if b[3]] or kept


def extract(text: str | None, low: set[int] = frozenset()) -> str:
    """The main text of a page: the blocks of its article (of its body if it has none) outside dropped and low branches.

    A branch that holds the only article, main or body text of the page is not removed for being low.
    """
    blocks, _, holders = parsed(text or "")
    blocks, low = _main(blocks), low - holders
    return " ".join(b[0] for b in [b for b in blocks if low.isdisjoint(b[1])] or blocks)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _features(rows):
    """(host, page, order, features) of distinct pages: (node, kind, feature) for pages (0), sequences of children (1)
    and texts (2) of style nodes. ``page`` tells the main text, so copies share it; the least ``order`` stands for them."""
    known = set()
    for batch in units.batches(rows, "html"):
        out = ([], [], [], [])
        for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            blocks, styles = parse(text or "")
            mine = {(node, 1, children) for node, children in styles}
            for t, nodes, dropped, _ in blocks:
                if not dropped:
                    content = xxhash.xxh3_64_intdigest(t)
                    mine.update((node, 2, content) for node in nodes)
            mine |= {(node, 0, 0) for node, _, _ in mine}
            flat = np.array(sorted(mine), dtype=np.uint64).reshape(-1, 3).astype(np.int64)
            order = _signed(xxhash.xxh3_64_intdigest(flat.tobytes()))
            said = " ".join(b[0] for b in _main(blocks))
            page = _signed(xxhash.xxh3_64_intdigest(said)) if said else order
            if (host, page, order) not in known:
                known.add((host, page, order))
                for column, x in zip(out, (host, page, order, flat.ravel())):
                    column.append(x)
        yield pa.record_batch(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.list_(pa.int64()))],
            ["host", "page", "order", "features"],
        )


def _listed(rows):
    """The features of each page as rows (host, node, kind, feature)."""
    for batch in rows:
        counts = np.diff(batch.column(1).offsets.to_numpy()) // 3
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, 3)
        host = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), counts)))
        yield pa.record_batch([host, pa.array(flat[:, 0]), pa.array(flat[:, 1].astype(np.int32)), pa.array(flat[:, 2])], ["host", "node", "kind", "feature"])


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, pages, importance) of every style node of the merged pages (host, html).

    With m pages and l sequences of children, presentation is -sum p log_m p over the sequences, content is 1 minus the
    mean of log_m of the pages on which each text below the node occurs; together (1 - g^l) presentation + g^l content.
    Pages of one main text count as one. Counts are aggregated on the map side, so a host may have any number of pages.
    """
    found = pages.mapInArrow(_features, "host string, page long, order long, features array<long>")
    distinct = found.groupBy("host", "page").agg(F.min_by("features", "order").alias("features")).select("host", "features")
    seen = distinct.mapInArrow(_listed, "host string, node long, kind int, feature long")
    counts = seen.groupBy("host", "node", "kind", "feature").agg(F.count("*").alias("n"))
    sums = counts.groupBy("host", "node").agg(
        F.max(F.expr("if(kind = 0, n, NULL)")).alias("pages"),
        F.sum(F.expr("if(kind = 1, n * ln(n), 0D)")).alias("spread"), F.sum(F.expr("if(kind = 1, n, 0L)")).alias("shown"),
        F.count(F.expr("if(kind = 1, 1, NULL)")).alias("styles"), F.avg(F.expr("if(kind = 2, ln(n), NULL)")).alias("shared"),
    )
    presentation = "coalesce(1 - try_divide(spread, shown * ln(shown)), 1D)"
    content = "coalesce(1 - try_divide(shared, ln(pages)), 1D)"
    return sums.select("host", "node", "pages", F.expr(
        f"if(pages > 1, (1 - pow({GAMMA}D, styles)) * if(styles > 1, {presentation}, 0D) + pow({GAMMA}D, styles) * {content}, 1D)"
    ).alias("importance"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html; other columns are not read).

    Null html is an empty page; a page without main text gives the empty string. A null or odd url belongs to a host of
    its own kind (the empty one). Repeated rows give repeated results, and count as one page of their host. An empty table
    gives an empty result. Nothing is cut: the text is whole, whatever its length.
    """
    hosted = pages.select("page_id", "url", "html", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1)).alias("host"))
    tree = written(style_tree(hosted.select("host", "html")), "mainhtml")
    best = tree.filter("pages > 1").groupBy("host").agg(F.max("importance").alias("best"))  # of one page importance says nothing
    low = tree.join(best, "host").filter(f"pages >= {LEAST_PAGES} AND importance < {LOW} * best")
    low = written(low.groupBy("host").agg(F.collect_list("node").alias("low")), "mainhtml")

    def run(rows):
        for batch in units.batches(rows, "html"):
            lows = {}
            texts = []
            for host, text, low_nodes in zip(*(batch.column(i).to_pylist() for i in (3, 2, 4))):
                if host not in lows:
                    lows[host] = {x & ((1 << 64) - 1) for x in low_nodes or ()}
                texts.append(extract(text, lows[host]))
            n = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(n)], ["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    joined = hosted.join(sized(low), "host", "left").select("page_id", "url", "html", "host", "low")
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")

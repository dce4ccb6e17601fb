"""Main text of pages by site style trees.

The element trees of a host's pages are merged: elements with the same path of tags and names are one style node.
A style node's presentation importance is the entropy of the child sequences that pages show below it, and the
content importance of the text in its branch is one less the entropy of each text's spread over the pages: text that
recurs on every page of the host weighs nothing, text of one page weighs most. Branches of low importance are
templates and are cut from each page.

What a page itself says comes first: navigation, forms, asides, adverts and the like, by tag or by a whole class or role,
are never main text unless they are named so and hold a ``main`` or ``article`` element. Ids count as such names outside of
these elements only, as inside them they are anchors. Main elements are never cut as templates, but an innermost block
inside them is if its text stands at the same path on half of the host's pages or more, whatever the size of the host; a
text that fewer pages share is theirs. Headings are never cut by themselves. Only pages that differ are counted, and what
leaves less than half of the main text is taken for a copy, not cut.
"""

from __future__ import annotations

import html as html_references
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Batches, stored
from tidemark.llm.dom import BLOCKS, RAW, Node, parse, words_of_value

#: A branch below this importance is a template, if enough pages of the host show it.
LEAST_IMPORTANCE = 0.3
LEAST_PAGES = 4
#: Share of the host's pages on which a block inside a main element recurs before it is cut.
MAIN_SHARE = 0.5
#: Parts of the keys of (host, path) when templates are looked up, so that a large host is no hot key.
PARTS = 32
DECAY = 0.9
#: Style nodes and their ancestors that a task hands over at once.
BATCH_NODES = 1 << 20

#: Elements and names that never hold main text.
_NOISE_TAGS = frozenset(
    "nav footer aside form script style noscript template button select textarea iframe object svg canvas dialog menu head "
    "title input audio video map".split()
)
_NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs masthead topbar footer sidebar aside widget cookie cookies consent gdpr notice notices alert "
    "newsletter subscribe signup popup modal overlay comment comments disqus reply replies respond share sharing social "
    "related recommended recommendations pagination pager toolbar login search form skip copyright contentinfo "
    "complementary".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MAIN = frozenset(("main", "article"))


def _hash(text: str) -> int:
    raw = text.encode("utf-8", "surrogatepass")
    return (zlib.crc32(raw) << 31) ^ zlib.adler32(raw) ^ len(raw) << 20


def _below(path: int, node: Node) -> int:
    """The path of a node from the path around it; 0 is the root's."""
    return _hash(f"{path}>{node.label}")


def _innermost(node: Node) -> str:
    """The text of a block without blocks in it, white space single; empty for other elements."""
    if node.tag not in BLOCKS:
        return ""
    texts, stack = [], [iter(node.children)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif isinstance(child, str):
            texts.append(child)
        elif child.tag in BLOCKS and child.tag not in ("br", "hr"):
            return ""
        elif child.tag not in RAW:
            stack.append(iter(child.children))
    return " ".join("".join(texts).split())


def _block_key(path: int, text: str) -> int:
    return _hash(f"{path}#{text}")


def _is_main(node: Node) -> bool:
    return node.tag in _MAIN or (node.tag in ("div", "section") and node.names == ("main",))


def _named(value: str) -> bool:
    """Whether a class, id or role says nothing but that it is a part beside the main text."""
    words = words_of_value(value)
    return bool(words) and (value.lower() in _NOISE_NAMES or _NOISE_NAMES.issuperset(words))


def _by_tag(node: Node, in_main: bool) -> bool:
    return node.tag in _NOISE_TAGS or node.hidden or (node.tag == "header" and not in_main)


def _by_name(node: Node, in_main: bool) -> bool:
    if node.tag in ("html", "body", "main"):
        return False
    if not in_main and node.tag not in _HEADINGS and any(v.lower() == "header" for v in node.values):
        return True
    return any(map(_named, node.values)) or (not in_main and node.tag not in _HEADINGS and any(map(_named, node.ids)))


def is_noise(node: Node, in_main: bool) -> bool:
    """Whether an element says of itself that it is no main text: by its tag, by a whole class or role, or outside of main
    elements by its id."""
    return _by_tag(node, in_main) or _by_name(node, in_main)


def style_nodes(page: str) -> Iterator[tuple[int, int, int, int, list[int]]]:
    """``path, kind, value, size, above`` for each style node of a page once.

    Kind 0 has the hash of the child sequence and the number of children, kind 1 the hash and the length of each
    distinct text that stands right below the node, kind 2 of each distinct whole text if the node is an innermost block.
    ``above`` are the paths of the node and of all nodes around it, for kind 1 only.
    """
    shapes: dict[int, list[str]] = {}
    texts: dict[int, set[str]] = {}
    wholes: dict[int, set[str]] = {}
    around: dict[int, int] = {}
    stack = [(0, iter(parse(page).children))]
    while stack:
        path, children = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            continue
        if isinstance(child, str):
            if child.strip() and path:
                texts.setdefault(path, set()).add(child.strip())
            continue
        if path:
            shapes.setdefault(path, []).append(child.label)
        if child.tag in RAW or child.tag in BLOCKS or child.children:
            key = _below(path, child)
            shapes.setdefault(key, [])
            around.setdefault(key, path)
            if child.tag not in RAW:
                stack.append((key, iter(child.children)))
            if text := _innermost(child):
                wholes.setdefault(key, set()).add(text)
    for key, labels in shapes.items():
        runs = [x for i, x in enumerate(labels) if not i or labels[i - 1] != x]
        yield key, 0, _hash(" ".join(runs)), len(runs), []
        if key in texts:
            above, up = [], key
            while up:
                above.append(up)
                up = around[up]
            for value, size in {_hash(text): len(text) for text in texts[key]}.items():
                yield key, 1, value, size, above
        for value, size in {_block_key(key, text): len(text) for text in wholes.get(key, ())}.items():
            yield key, 2, value, size, []


def main_text(page: str, templates: frozenset[int] = frozenset()) -> str:
    """The main text of a page: blocks in order, white space inside them single, joined by a space.

    ``templates`` has paths of branches, which are cut outside of main elements, and keys of innermost blocks, which are cut
    inside them. Headings stay unless the branch around them goes. If that leaves no text, or less than half of the main elements' text, as
    in near copies of a page, nothing is cut as a template.
    """
    root = parse(page)
    mains: list[tuple[Node, int]] = []
    doubtful: list[tuple[Node, int]] = []
    # names never end the search: what is named like a part may be the layout around the main element
    stack = [(0, iter(root.children))]
    while stack:
        path, children = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
        elif isinstance(child, Node) and (child.tag == "form" and not child.hidden or not _by_tag(child, False)):
            key = _below(path, child)
            if _is_main(child):
                (doubtful if _by_name(child, False) else mains).append((child, key))
            else:
                stack.append((key, iter(child.children)))

    def template(node: Node, key: int, in_main: bool) -> bool:
        if node.tag in _HEADINGS:
            return False
        if in_main:
            return node.tag in BLOCKS and not _is_main(node) and _block_key(key, _innermost(node)) in templates
        return key in templates

    def blocks_of(node: Node, start: int, in_main: bool, cut: bool) -> list[str]:
        blocks: list[str] = []
        open_: list[str] = []

        def flush() -> None:
            text = " ".join(html_references.unescape("".join(open_)).split())
            open_.clear()
            if text:
                blocks.append(text)

        stack = [(node, start, iter(node.children))]
        while stack:
            at, path, children = stack[-1]
            child = next(children, None)
            if child is None:
                stack.pop()
                if at.tag in BLOCKS:
                    flush()
            elif isinstance(child, str):
                open_.append(child)
            else:
                key = _below(path, child)
                noise = is_noise(child, in_main) or (cut and template(child, key, in_main))
                if child.tag in BLOCKS or (noise and child.tag in RAW):
                    flush()
                if not noise:
                    stack.append((child, key, iter(child.children)))
        flush()
        return blocks

    mains = mains or doubtful
    if mains:
        whole = " ".join(b for m, key in mains for b in blocks_of(m, key, True, False))
        kept = " ".join(b for m, key in mains for b in blocks_of(m, key, True, True)) if templates else whole
        return kept if 2 * len(kept) >= len(whole) else whole
    kept = blocks_of(root, 0, False, bool(templates)) or (blocks_of(root, 0, False, False) if templates else [])
    return " ".join(kept)


def host_of(url):
    """The host part of a URL column in lower case, without user and port; empty where there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def page_nodes(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """``host, k1, k2`` and the columns of ``style_nodes``; ``k1, k2`` tell a page's html. Of a page's copies on its host
    one is taken; a row of kind 3 stands for each page."""
    k1, k2 = _page_keys(F.col("html"))
    picked = pages.select(host_of(F.col(url)).alias("host"), F.col(html).cast("string").alias("html")).where("host <> '' AND html IS NOT NULL")
    picked = picked.select("host", "html", k1.alias("k1"), k2.alias("k2"))

    def rows(batches: Batches) -> Batches:
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        names = ["host", "k1", "k2", "row", "path", "kind", "value", "size", "above"]
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            owners, columns, length = [], ([], [], [], [], []), 0

            def built() -> pa.RecordBatch:
                of = [batch.column(c).take(pa.array(owners, pa.int64())) for c in ("host", "k1", "k2")]
                of.append(pa.array(np.array(owners, dtype=np.int64) + row))
                return pa.RecordBatch.from_arrays([*of, *[pa.array(c, t) for c, t in zip(columns, types)]], names=names)

            for i, page in enumerate(batch.column("html").to_pylist()):
                for values in ((0, 3, 0, 0, []), *style_nodes(page)):
                    owners.append(i)
                    for column, value in zip(columns, values):
                        column.append(value)
                    length += 1 + len(values[4])
                    if length >= BATCH_NODES:
                        yield built()
                        owners, columns, length = [], ([], [], [], [], []), 0
            yield built()
            row += len(batch)

    fields = "host string, k1 bigint, k2 bigint, row bigint, path bigint, kind int, value bigint, size bigint, above array<bigint>"
    nodes = stored(picked.mapInArrow(rows, fields), "style-nodes")
    each = nodes.where("kind = 3").select("host", "k1", "k2", "row")
    copies = each.join(each.groupBy("host", "k1", "k2").agg(F.min("row").alias("row")).select("row"), "row", "left_anti").select("row")
    return nodes.join(copies, "row", "left_anti")


def _page_keys(html: Column) -> tuple[Column, Column]:
    return F.xxhash64(html), F.xxhash64(F.lit("second"), html)


def site_templates(nodes: DataFrame) -> DataFrame:
    """``host, path``: for each host the paths of its style nodes of low importance, and the keys of its innermost blocks
    whose text recurs.

    Pages without a host belong to none and have no templates. Counts are taken over all pages that differ. A host with few
    pages has no template, as nothing can be said of it. A block is told by its text and path, and recurs if ``MAIN_SHARE`` of
    all the host's pages have it, a share that is the same for hosts of every size.
    """
    kinds = nodes.where("kind < 3").groupBy("host", "path", "kind", "value").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("size").alias("size"), F.first("above").alias("above")
    )
    kinds = stored(kinds, "style-kinds")

    shown = kinds.where("kind = 0").groupBy("host", "path")
    share = F.col("pages") * F.log(F.col("pages").cast("double"))
    shown = shown.agg(F.sum("pages").alias("m"), F.sum(share).alias("mass"), F.sum("size").alias("kids"))
    several = F.col("m") > 1
    presentation = F.when(several, 1 - F.col("mass") / (F.col("m") * F.log(F.col("m").cast("double")))).otherwise(1.0)
    shown = shown.select("host", "path", "m", presentation.alias("presentation"), (F.col("kids") / F.col("m")).alias("children"))

    # how far each text of a node spreads over the pages that show the node, told to all nodes around it; the number of
    # pages is the same for all texts of a node, so texts are summed, map side first, before it is looked up
    logs = F.log(F.col("pages").cast("double"))
    text = kinds.where("kind = 1").groupBy("host", "path").agg(F.sum("size").alias("size"), F.sum(logs * F.col("size")).alias("logs"), F.first("above").alias("above"))
    known = shown.select(F.col("host").alias("h"), F.col("path").alias("p"), "m")
    text = text.join(known, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")))
    spread = F.when(F.col("m") > 1, F.col("logs") / F.log(F.col("m").cast("double"))).otherwise(0.0)
    text = text.withColumn("spread", spread)
    around = text.select("host", F.explode("above").alias("path"), "size", "spread").groupBy("host", "path")
    around = around.agg((1 - F.sum("spread") / F.sum("size")).alias("content"))
    around = around.select(F.col("host").alias("h"), F.col("path").alias("p"), "content")

    weight = F.pow(F.lit(DECAY), F.col("children"))
    judged = shown.join(around, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")))
    judged = judged.withColumn("importance", (1 - weight) * F.col("presentation") + weight * F.col("content"))
    low = judged.where((F.col("importance") < LEAST_IMPORTANCE) & (F.col("m") >= LEAST_PAGES)).select("host", "path")

    hosts = nodes.where("kind = 3").groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    hosts = hosts.select("host", "all", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    blocks = kinds.where("kind = 2").where(F.col("pages") >= LEAST_PAGES).select("host", "value", "pages")
    blocks = blocks.withColumn("part", F.pmod("value", F.lit(PARTS)).cast("int")).join(hosts, ["host", "part"])
    blocks = blocks.where(F.col("pages") >= MAIN_SHARE * F.col("all"))
    return low.unionByName(blocks.select("host", F.col("value").alias("path")))


def page_templates(nodes: DataFrame) -> DataFrame:
    """``site, p1, p2, templates``: which of a page's own paths are templates of its host, for pages that have some."""
    low = site_templates(nodes).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    own = nodes.where("kind IN (0, 2)").withColumn("path", F.when(F.col("kind") == 0, F.col("path")).otherwise(F.col("value")))
    own = own.select("host", "k1", "k2", "path", F.pmod("k1", F.lit(PARTS)).cast("int").alias("part"))
    found = own.join(low, ["host", "path", "part"], "left_semi").groupBy("host", "k1", "k2").agg(F.collect_set("path").alias("templates"))
    return found.select(F.col("host").alias("site"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), "templates")


def extract(pages: DataFrame, *, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``; ``n_chars`` counts the text's code points.

    NULL and empty html give an empty text. A NULL or odd url has no host and no templates. Rows that repeat are
    each extracted. No rows: no rows.
    """
    templates = stored(page_templates(page_nodes(pages, url=url, html=html)), "style-templates")
    picked = pages.select(
        F.col(page).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html")
    )
    k1, k2 = _page_keys(F.col("html"))
    same = (host_of(F.col("url")) == F.col("site")) & (k1 == F.col("p1")) & (k2 == F.col("p2"))
    joined = picked.join(templates, same, "left").drop("site", "p1", "p2")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = [
                main_text(page, frozenset(cut or ()))
                for page, cut in zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist())
            ]
            sizes = pa.array(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    kind = picked.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")

"""Main text of HTML pages by wrapper induction: the trees of a host's pages are aligned by simple tree matching.

1. A few different pages of each host, those with the smallest hashes, are merged into
   one template tree: matched nodes become one, others join as further nodes. A text
   node keeps the text that most of these pages have there.
2. Every page of the host is aligned with the template, and each node's matches, equal
   texts and characters are summed over all of them. A text node that has the same
   text in nearly all pages of the host is constant and part of the template; the rest
   are slots. The content root is the deepest structural node that holds nearly all
   characters of the slots.
3. Every page is aligned again. Its article is its article or main element; without one,
   what is matched with the content root or below it. Constant nodes there go, and the slots'
   texts are the content. If constant texts are the larger part of an article, it is a
   copy that many pages of the host hold, and stays whole.

Step 1 takes a bounded number of pages a host (`Induction.samples`); it only offers
places to look at, and whether a text is constant is counted over all pages. Pages without a host, or on
a host with fewer than `Induction.pages` pages, have no template; of them the article element
is taken, or the whole body. What is no prose by tag, role or name never enters a tree (dom.py).

Templates are joined to the pages; a hot host is no bottleneck, since its templates are
broadcast while their counted bytes are few, and its rows are routed around the shuffle beyond that.

Edge cases: a null or empty page has an empty text, as a page without any article
text. A null URL, or one without a host, means no host. Repeated rows and ids each
give a row. Texts are those of blocks in page order, joined by an empty line.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.dom import STRUCTURE, Matching, Node, parse, seal
from starloom.llm.frames import keep_ids, map_batches, prepare
from starloom.operators.lookup import attach_by_key
from starloom.session import stage


@dataclass(frozen=True)
class Induction:
    samples: int = 6
    # A template needs so many pages, and its constant texts so large a share of them.
    pages: int = 3
    constant: float = 0.8
    # The content root holds this share of the slots' characters at least.
    root: float = 0.8
    # Constant texts above this share of an article are a copied article.
    copied: float = 0.5
    # Templates of so many bytes in all are broadcast.
    broadcast_bytes: int = 64 << 20
    # Hosts whose sums one task holds before it hands them on.
    open_hosts: int = 2000


def host_of(url: str) -> Column:
    """The host of a URL column in lower case; null where there is none."""
    host = F.lower(F.regexp_extract(F.col(url), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\s]+)", 1))
    return F.when(host != "", host)


def pack(root: Node) -> str:
    """A tree as JSON: signs, parents' places, and the hashes of texts."""
    parents = {kid.place: node.place for node in root.walk() for kid in node.children}
    return json.dumps(list(zip(*((n.sign, parents.get(n.place, -1), n.mark) for n in root.walk()))))


def unpack(packed: str) -> Node:
    nodes: list[Node] = []
    for sign, parent, mark in zip(*json.loads(packed)):
        nodes.append(Node(sign, mark=mark))
        if parent >= 0:
            nodes[parent].children.append(nodes[-1])
    return seal(nodes[0])


def induce(trees: list[Node]) -> Node:
    """One template from trees, merged in the order given; a text is known by the hash that most of them have there."""
    template = trees[0]
    votes = {id(node): {node.mark: 1} for node in template.walk() if node.mark}
    for tree in trees[1:]:
        matched = Matching().align(tree, template)
        for node in list(tree.walk()):
            into = matched.get(node.place)
            if into is None:
                continue
            if node.mark:
                counts = votes.setdefault(id(into), {})
                counts[node.mark] = counts.get(node.mark, 0) + 1
            place = 0
            for kid in node.children:
                if kid.place in matched:
                    place = into.children.index(matched[kid.place], place) + 1
                else:
                    into.children.insert(place, kid)
                    place += 1
                    votes.update({id(n): {n.mark: 1} for n in kid.walk() if n.mark})
        for node in template.walk():
            if counts := votes.get(id(node)):
                node.mark = max(counts, key=lambda mark, counts=counts: (counts[mark], mark))
        seal(template)
    return template


def _templates(pages: DataFrame, how: Induction) -> DataFrame:
    """(host, n_pages, template) of every host with enough pages."""
    drawn = pages.filter("_host is not null").select("_host", "_key")
    sizes = drawn.groupBy("_host").agg(F.count("*").alias("n_pages")).filter(F.col("n_pages") >= how.pages)
    samples = drawn.withColumn("_bucket", F.pmod("_key", F.lit(how.samples))).groupBy("_host", "_bucket").agg(F.min("_key").alias("_chosen"))
    chosen = samples.join(sizes, "_host").select(F.col("_chosen").alias("_key"))
    shown = keep_ids(pages, chosen, "_key")

    def tree(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [pack(parse(html)) for html in batch.column("_html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("_host"), batch.column("_key"), pa.array(packed, pa.string())], ["_host", "_key", "tree"])

    trees = map_batches(shown.select("_host", "_key", "_html"), tree, "_host string, _key long, tree string")
    # Copies of a page have one key and one tree.
    trees = trees.groupBy("_host", "_key").agg(F.min("tree").alias("tree")).groupBy("_host")
    trees = trees.agg(F.array_sort(F.collect_list(F.struct("_key", "tree"))).alias("trees"))

    def merge(batch: pa.RecordBatch) -> pa.RecordBatch:
        merged = [pack(induce([unpack(t["tree"]) for t in trees])) for trees in batch.column("trees").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("_host"), pa.array(merged, pa.string())], ["_host", "template"])

    return stage(map_batches(trees, merge, "_host string, template string").join(sizes, "_host"), "templates")


def _attached(pages: DataFrame, lookup: DataFrame, how: Induction) -> DataFrame:
    """Pages with the columns of their host, or nulls."""
    size = lookup.agg(F.count("*"), F.sum(F.length("template"))).first()
    fits = (size[1] or 0) <= how.broadcast_bytes
    return attach_by_key(pages, lookup, "_host", F.col("_key"), size[0], limit=size[0] if fits else 0)


class _Unpacked:
    """Templates a worker has seen lately."""

    def __init__(self, room: int = 200):
        self._room, self._held = room, {}

    def __call__(self, host: str, packed: str) -> Node:
        if host not in self._held:
            for old in list(self._held)[: len(self._held) // 2] if len(self._held) >= self._room else ():
                del self._held[old]
            self._held[host] = unpack(packed)
        return self._held[host]


def _sums(batches: Iterator[pa.RecordBatch], how: Induction) -> Iterator[pa.RecordBatch]:
    """(host, place, equal, chars) for each node of the template, summed over this task's pages of the host."""
    templates, held = _Unpacked(), {}

    def release():
        rows = [(host, place, *sums) for host, nodes in held.items() for place, sums in enumerate(nodes) if any(sums)]
        held.clear()
        columns = zip(*rows) if rows else ((),) * 4
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["_host", "place", "equal", "chars"])

    for batch in batches:
        for host, html, packed in zip(*(batch.column(name).to_pylist() for name in ("_host", "_html", "template"))):
            if packed is None:
                continue
            template = templates(host, packed)
            sums = held.setdefault(host, [[0, 0] for _ in range(template.size)])
            tree = parse(html)
            matched = Matching().align(tree, template)
            above: dict[int, Node] = {}
            for node in tree.walk():
                into = matched.get(node.place) or above[node.place]
                above.update((kid.place, into) for kid in node.children)
                if node.mark:
                    same = node.place in matched and into.mark == node.mark
                    sums[into.place][0 if same else 1] += 1 if same else len(node.text)
        if len(held) >= how.open_hosts:
            yield release()
    yield release()


def _decided(rows: list[dict], template: Node, n_pages: int, how: Induction) -> tuple[list[int], int]:
    """Places of the constant texts, and of the content root."""
    equal, chars = {r["place"]: r["equal"] for r in rows}, {r["place"]: r["chars"] for r in rows}
    constant = [place for place, n in equal.items() if n >= max(how.pages, how.constant * n_pages)]
    nodes = list(template.walk())
    mass = [chars.get(n.place, 0) for n in nodes]
    for node in reversed(nodes):
        mass[node.place] += sum(mass[kid.place] for kid in node.children)
    root = template
    while mass[root.place]:
        inner = [k for k in root.children if k.tag in STRUCTURE and mass[k.place] >= how.root * mass[root.place]]
        if not inner:
            break
        root = inner[0]
    return sorted(constant), root.place


def _wrappers(pages: DataFrame, how: Induction) -> DataFrame:
    """(host, template, constant, root): what the extraction needs of each host."""
    templates = _templates(pages, how)
    joined = _attached(pages, templates.select("_host", "template"), how).filter("template is not null")
    kept = how

    def count(batches):
        yield from _sums(batches, kept)

    sums = joined.select("_host", "_html", "template").mapInArrow(count, "_host string, place int, equal long, chars long")
    sums = sums.groupBy("_host", "place").agg(F.sum("equal").alias("equal"), F.sum("chars").alias("chars"))
    sums = sums.groupBy("_host").agg(F.collect_list(F.struct("place", "equal", "chars")).alias("sums"))

    def decide(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(*(batch.column(name).to_pylist() for name in ("sums", "template", "n_pages")))
        found = [_decided(sums, unpack(template), n, kept) for sums, template, n in rows]
        constant, root = ([f[k] for f in found] for k in range(2))
        columns = [batch.column("_host"), batch.column("template"), pa.array(constant, pa.list_(pa.int32())), pa.array(root, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["_host", "template", "constant", "root"])

    return stage(map_batches(sums.join(templates, "_host"), decide, "_host string, template string, constant array<int>, root int"), "wrappers")


def _articles(tree: Node) -> list[Node]:
    """The outermost article elements (inside the main element, if there is one) that are not far smaller than the largest."""

    def outermost(tops: list[Node], tag: str) -> list[Node]:
        found, open_ = [], list(tops)
        while open_:
            node = open_.pop()
            if node.tag == tag:
                found.append(node)
            else:
                open_ += node.children
        return sorted(found, key=lambda n: n.place)

    mains = outermost([tree], "main")
    found = outermost(mains or [tree], "article") or mains
    sizes = [sum(len(n.text) for n in node.walk() if n.mark) for node in found]
    return [node for node, size in zip(found, sizes) if 4 * size >= max(sizes)]


def content(tree: Node, template: Node | None, constant: set[int], root: int, how: Induction = Induction()) -> list[str]:
    """The blocks of the main text of a page."""
    matched = Matching().align(tree, template) if template else {}
    tops = _articles(tree)
    if not tops and template:
        tops = [node for node in tree.walk() if node.place in matched and matched[node.place].place == root]
    blocks = [node for top in tops or [tree] for node in top.walk() if node.mark]
    fixed = [node for node in blocks if node.place in matched and matched[node.place].place in constant and matched[node.place].mark == node.mark]
    if sum(len(n.text) for n in fixed) > how.copied * sum(len(n.text) for n in blocks):
        fixed = []
    gone = {node.place for node in fixed}
    return [node.text for node in blocks if node.place not in gone]


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", how: Induction = Induction()) -> DataFrame:
    """One row per page: key, url, text (its blocks joined by an empty line), n_chars."""
    prepare(pages.sparkSession)
    body = F.coalesce(F.col(html), F.lit(""))
    source = pages.select(F.col(key).alias("_id"), F.col(url).alias("_url"), host_of(url).alias("_host"), body.alias("_html"))
    source = source.withColumn("_key", F.xxhash64("_host", "_html"))
    wrapped = _attached(source, _wrappers(source, how), how)
    templates = _Unpacked()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for host, page, packed, constant, root in zip(*(batch.column(n).to_pylist() for n in ("_host", "_html", "template", "constant", "root"))):
            template = templates(host, packed) if packed is not None else None
            texts.append("\n\n".join(content(parse(page), template, set(constant or ()), root, how)))
        columns = [batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, [key, "url", "text", "n_chars"])

    needed = wrapped.select("_id", "_url", "_host", "_html", "template", "constant", "root")
    return map_batches(needed, work, f"`{key}` {pages.schema[key].dataType.simpleString()}, url string, text string, n_chars long")

"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements, with the stretches of text between them as leaves.
Every node is content or not.  Its own evidence is a weighted sum of features, a potential
between parent and child says how their labels go together, and sum-product messages, first
upward and then downward, give every node's marginal.  The text of a page is that of its leaves
with a marginal of a half or more.  Weights and potentials are trained on labelled pages.

A page that marks its article by tag or name is read by such marks, whose weights have a strong
prior.  On a page without them, other evidence counts: how much of the page's text lies where, in
what pieces, how much of it is linked.  Its weights are learned from nothing: from pages that mark
their article, with the marks hidden.
"""

from __future__ import annotations

import html as references
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, pieces

#: Pages that the model is trained on at most, and the nodes of their copies: no further page once
#: reached.
SAMPLE, SAMPLE_NODES = 300, 100_000
#: Gradient steps, their size, and the weight of the prior; that of evidence without a prior mean.
STEPS, RATE, PRIOR, WEAK_PRIOR = 100, 0.5, 0.02, 0.003

#: Elements without text of their own for a reader.
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video head "
                   "title textarea select datalist".split())
#: Elements inside a line of text; all others separate blocks.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label "
                   "mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag on the left ends an open element on the right.
CLOSES = {tag: frozenset({"p"}) for tag in
          "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
          "header hr main nav ol p pre section table ul".split()}
CLOSES |= {"li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}),
           "dd": frozenset({"dt", "dd", "p"}), "tr": frozenset({"tr", "td", "th", "p"}),
           "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}),
           "option": frozenset({"option"})}
#: Such an element is left only from inside: an open one beyond it stays open.
FENCES = frozenset("table ul ol dl body html article section div main aside nav td th".split())

#: Elements whose names tell of the page or of what else it has.
NAMELESS = frozenset("html body article main".split())

_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*>|/([a-zA-Z][^\s/>]*)[^>]*>"
                  r"|([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>)", re.S)
_NAMES = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")
#: Names that tell what an element is beside or without, such as ``no-ads`` or ``with-sidebar``.
_BESIDE = re.compile(r"\b(?:no|non|has|with|without)[-_][a-z]+")

GOOD_TAGS, BAD_TAGS = frozenset({"article", "main"}), frozenset(
    "nav aside footer header form dialog menu button fieldset input".split())
GOOD_NAMES = frozenset("article articlebody content entry main post story text".split())
BAD_NAMES = frozenset("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments "
                      "consent contentinfo cookie cookies disclaimer disqus footer form header "
                      "links login masthead menu meta nav navbar navigation newsletter notice "
                      "notices notification pagination popup privacy promo promoted promotion "
                      "related reply replies respond search share sharing sidebar signup social "
                      "sponsor sponsored subscribe tags toolbar widget".split())

#: Features of a node and the prior mean of their weights.
FEATURES = {"bias": 0.0, "good_tag": 8.0, "bad_tag": -9.0, "good_name": 4.0, "bad_name": -9.0,
            "text": 0.5, "heading": 0.5, "paragraph": 1.0, "list": -0.5, "long": 1.0,
            "links": -3.0, "sentence": 0.5, "mark": -3.0}
#: Evidence on pages without a mark: of a leaf, of an element, and of both (the share of the page's text
#: in the largest element beside the node that has several stretches).
BARE = ("bare_text", "bare_long", "bare_links", "bare_sentence", "bare_mark", "bare_share", "bare_around",
        "bare_element", "bare_area", "bare_fan", "bare_linked", "bare_beside")
FEATURES |= dict.fromkeys(BARE, 0.0)
#: What the copies of a training page hide: nothing, the marks of its article, all tags and names.
COPIES = ("", "good", "all")
_AT = {name: k for k, name in enumerate(FEATURES)}
_GOOD = [_AT["good_tag"], _AT["good_name"]]
_MARKS = [*_GOOD, *(_AT[name] for name in ("bad_tag", "bad_name", "heading", "paragraph", "list"))]
#: Prior mean of the potential between the labels of parent (row) and child (column).
COUPLING = ((0.0, -8.0), (0.0, 1.0))


@dataclass
class Tree:
    """Nodes in page order, a parent before its children.  ``text`` is None for elements."""

    parent: list[int] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    names: list[frozenset[str]] = field(default_factory=list)
    linked: list[float] = field(default_factory=list)

    def add(self, parent: int, tag: str, names: frozenset[str], text: str | None,
            linked: float = 0.0) -> int:
        for column, value in zip((self.parent, self.tag, self.names, self.text, self.linked),
                                 (parent, tag, names, text, linked)):
            column.append(value)
        return len(self.parent) - 1


def parse(page: str) -> Tree:
    """The tree of a page.  Unclosed and stray tags are mended as browsers do in simple cases;
    comments, scripts, styles and the like leave no trace."""
    tree = Tree()
    stack = [("", tree.add(-1, "", frozenset(), None))]
    parts: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                tree.add(stack[-1][1], "#text", frozenset(), text, linked / len(text))
        parts, linked = [], 0

    at, size = 0, len(page)
    while at < size:
        tag = _TAG.search(page, at)
        end = tag.start() if tag else size
        if end > at:
            parts.append(page[at:end])
            if links:
                linked += end - at
        if not tag:
            break
        at = tag.end()
        closed, opened = tag.group(1), tag.group(2)
        if closed:
            name = closed.lower()
            if name == "a":
                links = max(0, links - 1)
            elif name in INLINE:
                continue
            else:
                flush()
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == name:
                        del stack[depth:]
                        break
                    if stack[depth][0] in FENCES and name not in FENCES:
                        break
        elif opened:
            name = opened.lower()
            if name in SILENT:
                if not tag.group(0).endswith("/>"):
                    if name == "head":
                        stop = re.compile(r"</head\s*>|(?=<body\b)", re.I).search(page, at)
                    else:
                        stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                    at = stop.end() if stop else size
                parts.append(" ")
            elif name == "a":
                links += 1
            elif name == "br":
                parts.append(" ")
            elif name not in INLINE:
                flush()
                links = 0
                ends = CLOSES.get(name)
                if ends:
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][0] in ends:
                            del stack[depth:]
                            break
                        if stack[depth][0] in FENCES:
                            break
                if name not in VOID:
                    found = _NAMES.findall(tag.group(3)) if tag.group(3) and name not in NAMELESS else ()
                    named = _BESIDE.sub(" ", " ".join(map("".join, found)).lower())
                    names = frozenset(_PART.findall(named))
                    stack.append((name, tree.add(stack[-1][1], name, names, None)))
    flush()
    return tree


def features(tree: Tree, hidden: str = "") -> np.ndarray:
    """One row of evidence for each node, without that of ``hidden`` marks (see ``COPIES``)."""
    out = np.zeros((len(tree.parent), len(FEATURES)))
    out[:, _AT["bias"]] = 1
    for k, (parent, tag, names, text, linked) in enumerate(zip(
            tree.parent, tree.tag, tree.names, tree.text, tree.linked)):
        row = out[k]
        if text is not None:
            above = tree.tag[parent]
            row[_AT["text"]] = 1
            row[_AT["long"]] = min(len(text), 200) / 200
            row[_AT["links"]] = min(linked, 1.0)
            row[_AT["sentence"]] = text[-1] in ".!?…\"'”»"
            row[_AT["mark"]] = "©" in text
            row[_AT["heading"]] = len(above) == 2 and above[0] == "h" and above[1].isdigit()
            row[_AT["paragraph"]] = above == "p"
            row[_AT["list"]] = above in ("li", "td", "th", "dt", "dd")
        elif tag:
            row[_AT["good_tag"]] = tag in GOOD_TAGS
            row[_AT["bad_tag"]] = tag in BAD_TAGS
            row[_AT["good_name"]] = not names.isdisjoint(GOOD_NAMES) and names.isdisjoint(BAD_NAMES)
            row[_AT["bad_name"]] = not names.isdisjoint(BAD_NAMES)
    if hidden:
        out[:, _GOOD if hidden == "good" else _MARKS] = 0
    if not out[:, _GOOD].any():
        _bare(tree, out)
    return out


def _bare(tree: Tree, out: np.ndarray) -> None:
    """Fill in the evidence of a page without marks."""
    n = len(tree.parent)
    size, linked, leaves = np.zeros(n), np.zeros(n), np.zeros(n)
    for k in range(n - 1, 0, -1):
        if tree.text[k] is not None:
            size[k], leaves[k] = len(tree.text[k]), 1
            linked[k] = size[k] * min(tree.linked[k], 1.0)
        for column in (size, linked, leaves):
            column[tree.parent[k]] += column[k]
    free = size - linked
    area = free / max(free[0], 1.0)
    first, second = np.zeros(n), np.zeros(n)  # largest areas among a node's children
    for k in range(1, n):
        if leaves[k] > 1:
            up, own = tree.parent[k], area[k]
            first[up], second[up] = max(first[up], own), max(second[up], min(first[up], own))
    above = np.array(tree.parent)
    largest = (leaves > 1) & (area == first[above])
    out[1:, _AT["bare_beside"]] = np.where(largest, second[above], first[above])[1:]
    leaf = np.array([text is not None for text in tree.text])
    longest = max(size[leaf].max(initial=0), 1.0)
    for name, base in (("bare_long", "long"), ("bare_links", "links"), ("bare_sentence", "sentence")):
        out[leaf, _AT[name]] = out[leaf, _AT[base]]
    out[leaf, _AT["bare_text"]] = 1
    out[leaf, _AT["bare_mark"]] = ["©" in t or "all rights reserved" in t.lower()
                                   for t in tree.text if t is not None]
    out[leaf, _AT["bare_share"]] = size[leaf] / longest
    out[leaf, _AT["bare_around"]] = area[above[leaf]]
    element = ~leaf
    element[0] = False
    out[element, _AT["bare_element"]] = 1
    out[element, _AT["bare_area"]] = area[element]
    out[element, _AT["bare_fan"]] = np.minimum(leaves[element], 10) / 10
    out[element, _AT["bare_linked"]] = linked[element] / np.maximum(size[element], 1.0)


@dataclass
class Model:
    weight: np.ndarray
    coupling: np.ndarray

    def beliefs(self, parent: list[int], unary: list[float]) -> tuple[list[float], np.ndarray]:
        """Marginal of content for each node, and the expected number of each label pair.

        Messages are log odds of content.  Upward a node sends its parent what its subtree says,
        downward the parent answers with all that did not come from that child.
        """
        (e00, e01), (e10, e11) = np.exp(self.coupling - self.coupling.max()).tolist()
        n, exp, log = len(parent), math.exp, math.log
        up, sent = list(unary), [0.0] * n

        def squeeze(x):
            return 30.0 if x > 30 else -30.0 if x < -30 else x

        for k in range(n - 1, 0, -1):
            odds = exp(squeeze(up[k]))
            sent[k] = log((e10 + e11 * odds) / (e00 + e01 * odds))
            up[parent[k]] += sent[k]
        full, pairs = up[:], np.zeros((2, 2))
        p00 = p01 = p10 = p11 = 0.0
        for k in range(1, n):
            over = exp(squeeze(full[parent[k]] - sent[k]))
            under = exp(squeeze(up[k]))
            a, b, c, d = e00, e01 * under, e10 * over, e11 * over * under
            total = a + b + c + d
            p00 += a / total
            p01 += b / total
            p10 += c / total
            p11 += d / total
            full[k] = up[k] + log((e01 + e11 * over) / (e00 + e10 * over))
        pairs[:] = ((p00, p01), (p10, p11))
        return [1 / (1 + exp(-squeeze(x))) for x in full], pairs

    def marginals(self, tree: Tree) -> list[float]:
        return self.beliefs(tree.parent, (features(tree) @ self.weight).tolist())[0]

    def extract(self, page: str) -> str:
        tree = parse(page)
        return "\n".join(text for text, p in zip(tree.text, self.marginals(tree))
                         if text is not None and p >= 0.5)


def labels(tree: Tree) -> list[int] | None:
    """Labels of a page that marks its article itself, None for others.

    Text inside article or main is content unless an element that is plainly something else
    stands between; an element is content if any text in it is.
    """
    if not any(tag in GOOD_TAGS for tag in tree.tag):
        return None
    inside, out = [False] * len(tree.parent), [0] * len(tree.parent)
    for k in range(1, len(tree.parent)):
        tag, names = tree.tag[k], tree.names[k]
        plain = tag in BAD_TAGS or not names.isdisjoint(BAD_NAMES)
        inside[k] = not plain and (inside[tree.parent[k]] or tag in GOOD_TAGS)
    for k in range(len(tree.parent) - 1, 0, -1):
        if tree.text[k] is not None:
            out[k] = int(inside[k])
        if out[k]:
            out[tree.parent[k]] = 1
    return out


def fit(pages: list[str]) -> Model:
    """Maximum a posteriori weights and potentials on pages that ``labels`` can label."""
    return fit_trees([(tree.parent, np.stack([features(tree, hidden) for hidden in COPIES]), out)
                      for tree in map(parse, pages) if (out := labels(tree)) is not None])


def fit_trees(known: list[tuple[list[int], np.ndarray, list[int]]]) -> Model:
    """The same on parents, features (of each copy) and labels of the nodes of pages."""
    known = [(parent, x, out) for parent, copies, out in known for x in copies]
    prior = np.array(list(FEATURES.values())), np.array(COUPLING)
    model = Model(prior[0].copy(), prior[1].copy())
    if not known:
        return model
    truth = [np.array(out, dtype=float) for *_, out in known]
    seen = np.zeros((2, 2))
    for parent, _, out in known:
        for k in range(1, len(out)):
            seen[out[parent[k]], out[k]] += 1
    n = sum(map(len, truth))
    # Steps for evidence without a prior mean are as large as its own nodes say, not all nodes.
    learned = np.array([name in BARE for name in FEATURES])
    active = np.maximum(sum((x * x).sum(axis=0) for _, x, _ in known), 1.0)
    share, pull = np.where(learned, active, n), np.where(learned, WEAK_PRIOR, PRIOR)
    for _ in range(STEPS):
        slope, pairs = np.zeros(len(FEATURES)), np.zeros((2, 2))
        for (parent, x, _), y in zip(known, truth):
            p, expected = model.beliefs(parent, (x @ model.weight).tolist())
            slope += x.T @ (y - np.array(p))
            pairs += expected
        model.weight += RATE * (slope / share - pull * (model.weight - prior[0]))
        model.coupling += RATE * ((seen - pairs) / n - PRIOR * (model.coupling - prior[1]))
    return model


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parents, features and labels of the nodes of the pages that ``labels`` can label."""
    for batch in pieces(batches, "html"):
        for page_id, code, page in zip(*(batch.column(c).to_pylist() for c in ("page_id", "code", "html"))):
            tree = parse(page)
            if (out := labels(tree)) is not None:
                yield pa.RecordBatch.from_pylist([{
                    "page_id": page_id, "code": code, "n": len(COPIES) * len(out),
                    "parent": np.array(tree.parent, dtype=np.int64).tobytes(),
                    "features": b"".join(features(tree, hidden).tobytes() for hidden in COPIES),
                    "labels": np.array(out, dtype=np.int64).tobytes()}])


def learn(pages: DataFrame) -> Model:
    """Fit on at most ``SAMPLE`` pages, those with the smallest hash of their id; null ids and
    pages are left out, and of several pages of an id that with the smallest hash is used.  Whole pages are parsed in tasks, and in the order of the hash pages are
    taken until they have ``SAMPLE_NODES`` nodes, the one that reaches it as well."""
    usable = pages.filter(F.col("page_id").isNotNull() & F.col("html").isNotNull())
    chosen = usable.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE)
    read = (usable.join(F.broadcast(chosen), "page_id")
            .groupBy("page_id").agg(F.min(F.struct(F.xxhash64("html").alias("code"), "html")).alias("p"))
            .select("page_id", "p.html", "p.code"))
    parsed = Scratch(pages.sparkSession, "html").keep(read.mapInArrow(
        _nodes, "page_id long, code long, n long, parent binary, features binary, labels binary"), "nodes")
    order = [F.xxhash64("page_id"), F.col("page_id"), F.col("code")]
    left, taken = SAMPLE_NODES, []
    for row in parsed.orderBy(*order).select("page_id", "code", "n").collect():
        if left > 0:
            taken.append((row.page_id, row.code))
            left -= row.n
    some = pages.sparkSession.createDataFrame(taken, "page_id long, code long")
    rows = parsed.join(F.broadcast(some), ["page_id", "code"]).orderBy("page_id", "code").collect()
    return fit_trees([(np.frombuffer(r.parent, np.int64).tolist(),
                       np.frombuffer(r.features).reshape(len(COPIES), -1, len(FEATURES)),
                       np.frombuffer(r.labels, np.int64).tolist()) for r in rows])


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text for every row of ``pages``; only page_id, url and html are read.

    Blocks are joined by a line feed in page order; inside a block character references are
    decoded and white space becomes one space.  A null or empty page, or one without content,
    has the empty text.  A very long page is read whole, as one tree.  Repeated rows come out as
    often as they come in.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            found = [model.extract(h or "") for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())],
                names=["page_id", "url", "text"])

    return pages.select("page_id", "url", "html").mapInArrow(
        work, "page_id long, url string, text string")

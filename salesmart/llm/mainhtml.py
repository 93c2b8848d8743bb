"""Main text of web pages by a tree-structured graphical model.

A tolerant parser turns a page into a tree of block elements and text blocks.
Each node is outside (it only holds others), content or boilerplate.  Its
features (tag, words of class and id, length, share of links, end mark) give it
a potential, parent and child share one more.  Messages passed up the tree and
down again give each node's exact marginals; the text blocks whose likeliest
state is content are the main text.

Potentials are trained by counting on labelled pages.  Pages have no labels of
their own, so a page is labelled by its one `article` or `main` element, where
it has one; words that are common in page templates (fixed values below) have
potentials of their own besides.

Defined results: null html is empty; a page without content blocks has an empty
text; unclosed or misplaced tags are closed where HTML closes them; an unclosed
comment or script runs to the end; a drawing, template or control without an end
tag ends at the next block, an empty drawing at its slash; formulas and the
fallback of embedded objects are text like any other; repeated rows are extracted alike; an empty
table gives an empty frame.  Only `page_id`, `url` and `html` are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import hashed_sample, text_slices

#: Bound of the sample of pages that the model learns from.
TRAIN_PAGES = 400
OUTSIDE, CONTENT, BOILERPLATE = range(3)

# HTML's elements without an end tag, with raw text, and inside a line of text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe"}
# Elements whose text is no page text: controls, drawings, and what is not shown.
MUTE = {"template", "svg", "select", "button"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "object",
          "math", "mi", "mo", "mn", "ms", "mtext", "mrow", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup", "munder", "mover",
          "munderover", "mspace", "mstyle", "mtable", "mtr", "mtd", "mpadded", "mphantom", "menclose", "semantics", "annotation"}
# Which open elements a start tag closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr"}, "tbody": {"tr", "thead"}, "tfoot": {"tr", "tbody"}}
# Words of tags, classes and ids that page templates commonly use, and what they stand for.
COMMON = {
    CONTENT: "article main post entry story articlebody".split(),
    BOILERPLATE: """nav header footer aside form menu sidebar ad ads advert advertisement sponsor promo banner cookie consent
        notice alert comment comments reply respond disqus share social related breadcrumb breadcrumbs pagination newsletter
        subscribe popup modal widget toolbar login signup dialog hidden masthead copyright""".split(),
}
#: Log-potentials (outside, content, boilerplate) of the common words, and the most that a learned feature counts.
PRIOR = {CONTENT: np.array([-2.0, 2.0, -4.0]), BOILERPLATE: np.array([-3.0, -40.0, 1.0])}
LIMIT = 2.0
#: Least probability of each change of state from parent to child: boilerplate holds no content.
LEAST = np.array([[0.004, 0.004, 0.004], [0.004, 0.004, 0.01], [0.004, 1e-6, 0.004]])

# a quote delimits a value only where the value begins; elsewhere it is a character like any other
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"""
                  r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+)(?:>|\Z)""", re.S)
_NAME = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_PART = re.compile(r"[a-z]+|[0-9]+")
_END = {s: re.compile(rf"</{s}\s*>|\Z", re.I) for s in RAW}


@dataclass
class Page:
    """Nodes in document order: parent's number, features, and a block's text."""
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    names: list[tuple[str, ...]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    links: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, names: tuple[str, ...], text: str | None = None, links: int = 0) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.links.append(links)
        return len(self.parent) - 1


def _names(attrs: str) -> tuple[str, ...]:
    if "=" not in attrs:
        return ()
    out = [w for m in _NAME.finditer(attrs) for w in _PART.findall((m[1] or m[2] or m[3] or "").lower())]
    return tuple(dict.fromkeys(out))


def mute_end(source: str, at: int, name: str, ends: bool) -> int:
    """Where a muted element that begins before `at` ends: after its end tag, or,
    if it has none, before the next tag of a block.  Controls do not nest: another
    one of the kind shows that this one has no end tag.  `ends`: whether an end
    tag of the kind follows at all."""
    depth, after, block = 1, at, None
    while m := _TAG.search(source, after):
        after = m.end()
        own = (m[2] or "").lower()
        if own in RAW and not m[1]:
            after = _END[own].search(source, after).end()
        elif own == name:
            if m[1]:
                depth -= 1
                if depth == 0:
                    return m.end()
            elif name in ("select", "button"):
                return m.start() if block is None else block
            elif not m[3].rstrip().endswith("/"):
                depth += 1
        elif own and block is None and own not in INLINE and own not in VOID and own not in MUTE and own not in ("option", "optgroup"):
            block = m.start()
            if name == "select" or not ends:      # it holds only options
                break
    return len(source) if block is None else block


def parse(source: str) -> Page:
    page = Page()
    stack: list[tuple[str, int]] = [("", page.add(-1, "", ()))]   # (tag, node of its block element)
    held: list[str] = []
    last_end: dict[str, int] = {}     # where the last end tag of a muted element stands
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            page.add(stack[-1][1], "#text", (), text, min(linked, len(text)))
        held.clear()
        linked = 0

    def close(upto: int) -> None:
        if any(t not in INLINE for t, _ in stack[upto:]):
            flush()
        del stack[upto:]

    at, anchors = 0, 0
    while at < len(source):
        m = _TAG.search(source, at)
        end = m.start() if m else len(source)
        if end > at:
            held.append(source[at:end])
            if anchors:
                linked += end - at
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        name, closing, attrs = m[2].lower(), m[1], m[3]
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    close(i)
                    break
                if name in INLINE and stack[i][0] not in INLINE:
                    break
            if name == "a":
                anchors = max(0, anchors - 1)
            continue
        if name in RAW:
            e = _END[name].search(source, at)
            at = e.end()
            continue
        if name in MUTE:
            if not (name == "svg" and attrs.rstrip().endswith("/")):
                if name not in last_end:
                    last_end[name] = max((e.start() for e in re.finditer(rf"</{name}", source, re.I)), default=-1)
                at = mute_end(source, at, name, last_end[name] >= at)
            held.append(" " if name in ("select", "button") else "")
            continue
        if name in VOID:
            held.append(" ")
            if name == "hr":
                flush()
            continue
        if name in INLINE:
            if not attrs.rstrip().endswith("/"):
                stack.append((name, stack[-1][1]))
                anchors += name == "a"
            continue
        flush()
        anchors = 0
        shut = CLOSES.get(name, set()) | {"p"}      # a block closes an open paragraph
        scope = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "td", "main"} - shut
        i = len(stack) - 1
        while i > 0 and stack[i][0] not in scope:
            if stack[i][0] in shut:
                del stack[i:]
            i -= 1
        stack.append((name, page.add(stack[-1][1], name, _names(attrs))))
    flush()
    return page


def features(page: Page, i: int) -> tuple[str, ...]:
    """What a node's potential depends on."""
    text = page.text[i]
    if text is None:
        return (f"tag {page.tag[i]}", *(f"name {w}" for w in page.names[i]))
    size = len(text)
    return (f"in {page.tag[page.parent[i]]}", f"size {min(size.bit_length(), 10)}",
            f"links {4 * page.links[i] // max(size, 1)}", f"ends {text[-1] in '.!?…。'}")


def labels(page: Page) -> list[int] | None:
    """States of a page's nodes by its one article or main element; None without it."""
    own = [i for i, t in enumerate(page.tag) if t in ("article", "main")]
    own = [i for i in own if t_parent(page, i, "article") is None]
    if len(own) != 1:
        return None
    state = [BOILERPLATE] * len(page.parent)
    i = own[0]
    while i >= 0:
        state[i] = OUTSIDE
        i = page.parent[i]
    bad = set(COMMON[BOILERPLATE])
    state[own[0]] = CONTENT
    for i in range(own[0] + 1, len(state)):
        if state[page.parent[i]] == CONTENT and page.tag[i] not in bad and not bad.intersection(page.names[i]):
            state[i] = CONTENT
    for i, t in enumerate(page.tag):
        if t in ("html", "body", "head"):
            state[i] = OUTSIDE
    return state


def t_parent(page: Page, i: int, tag: str) -> int | None:
    i = page.parent[i]
    while i >= 0:
        if page.tag[i] == tag:
            return i
        i = page.parent[i]
    return None


@dataclass
class Model:
    feature: dict[str, np.ndarray]   # log-potentials of the three states
    edge: np.ndarray                 # (parent state, child state)
    root: np.ndarray

    def node(self, f: tuple[str, ...]) -> np.ndarray:
        return sum((self.feature[x] for x in f if x in self.feature), np.zeros(3))


def train(sources: list[str]) -> Model:
    """Count states, features and parent-child states on the labelled pages."""
    seen: dict[str, np.ndarray] = {}
    total, edge, root = np.ones(3), np.ones((3, 3)), np.ones(3)
    for source in sources:
        page = parse(source)
        state = labels(page)
        if state is None:
            continue
        root[state[0]] += 1
        for i, s in enumerate(state):
            total[s] += 1
            if i:
                edge[state[page.parent[i]], s] += 1
            for f in features(page, i):
                seen.setdefault(f, np.zeros(3))[s] += 1
    share = total / total.sum()
    # potential of a feature: how much likelier a state is with it than without knowing it
    potential = {f: np.clip(np.log((n + 2 * share) / (n.sum() + 2) / share), -LIMIT, LIMIT) for f, n in seen.items()}
    for state, words in COMMON.items():
        for w in words:
            for f in (f"tag {w}", f"name {w}"):
                potential[f] = potential.get(f, 0) + PRIOR[state]
    edge = np.maximum(edge / edge.sum(1, keepdims=True), LEAST)
    return Model(potential, np.log(edge / share), np.log(root / root.sum()))


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def marginals(parent: np.ndarray, depth: np.ndarray, node: np.ndarray, model: Model) -> np.ndarray:
    """Log-marginals of all nodes of a forest: messages go up level by level,
    then down; `parent` is -1 for roots."""
    up = np.zeros_like(node)             # product of the messages from children
    sent = np.zeros_like(node)           # each node's message to its parent
    levels = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)]
    for at in levels[:0:-1]:
        sent[at] = _sum_exp(model.edge[None] + (node[at] + up[at])[:, None, :], 2)
        np.add.at(up, parent[at], sent[at])
    down = np.zeros_like(node)
    down[levels[0]] = model.root
    for at in levels[1:]:
        p = parent[at]
        rest = node[p] + down[p] + up[p] - sent[at]
        down[at] = _sum_exp(model.edge[None] + rest[:, :, None], 1)
    out = node + up + down
    return out - _sum_exp(out, 1)[:, None]


def _extract(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, ...], int] = {}
        table: list[np.ndarray] = []
        for batch in batches:
            for a, b, _, _ in text_slices(batch, column="html"):
                if len(known) > 200_000:
                    known.clear()
                    table.clear()
                pages = [parse(s or "") for s in batch.column(2).slice(a, b - a).to_pylist()]
                rows, parent, depth, base = [], [], [], 0
                for p in pages:
                    for i in range(len(p.parent)):
                        f = features(p, i)
                        k = known.get(f)
                        if k is None:
                            k = known[f] = len(table)
                            table.append(model.node(f))
                        rows.append(k)
                    parent += [x + base if x >= 0 else -1 for x in p.parent]
                    depth += p.depth
                    base += len(p.parent)
                node = np.array(table)[np.array(rows, int)]
                best = marginals(np.array(parent), np.array(depth), node, model).argmax(1)
                texts, base = [], 0
                for p in pages:
                    texts.append("\n\n".join(t for i, t in enumerate(p.text) if t is not None and best[base + i] == CONTENT))
                    base += len(p.parent)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return run


def learn(pages: DataFrame, bound: int = TRAIN_PAGES) -> Model:
    """A model of about `bound` pages, chosen by a hash of their id."""
    own = pages.where(F.col("html").isNotNull()).select("page_id", F.col("html").cast("string").alias("html"))
    rows = hashed_sample(own, ["page_id"], bound, own.select("page_id").count()).collect()
    return train([r["html"] for r in rows])


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.col("html").cast("string").alias("html"))
    return own.mapInArrow(_extract(model), "page_id long, url string, text string, n_chars long")

"""Main-text extraction by a tree-structured graphical model over the DOM.

Every block-level element, and every run of text beside blocks, is a variable with three states: boilerplate, content, and
mixed (a wrapper of both). Node potentials come from what a node shows: tag, attribute words, amount and kind of text, share
of links, controls, place on the page, headings over it. Parent-child potentials say how states nest. Both are estimated on
labelled pages (default: ``html_pages.labelled_pages``): node potentials by a log-linear classifier whose class priors are
divided out, nesting by counts. One upward and one downward sum-product pass give every node's exact marginal; the text
blocks whose content marginal is over one half make up the result.
"""

from __future__ import annotations

import functools
import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.llm import common
from heronlake.llm.html_pages import labelled_pages

STATES = "bcm"  # boilerplate, content, mixed
B, C, M = range(3)
_BLOCK = frozenset(
    "html body div section article main header footer nav aside form fieldset ul ol li dl dt dd table caption thead tbody tfoot tr td th p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption address details summary menu dialog center hgroup search".split()
)
_LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption summary pre address blockquote".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_PART = frozenset("article section main aside header footer nav form table ul ol dl td li figure blockquote".split())
_RAW = frozenset("script style textarea title noscript iframe template svg xmp select button object".split())
_CONTROL = frozenset("input button select textarea label".split())
#: Tags whose start closes an open element of the second kind; the search for it passes only over the third kind.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_OPEN = frozenset("p li dt dd td th tr".split())
_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[(.*?)(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+(?=>|\Z)|[^>]*+)(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label|data-y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+[a-z]*")
_TOKEN = re.compile(r"[^\W\d_]+")
_ENDS = re.compile(r"[.!?\u2026\u3002\uff01\uff1f:][\"'\u201d\u2019)\]]*$")
_DATE = re.compile(r"\b(?:19|20)\d\d\b|\b\d{1,2}[./]\d{1,2}\b")
_LEGAL = re.compile(r"\u00a9|\(c\)|copyright|all rights reserved", re.I)


@dataclass
class Node:
    tag: str
    parent: int
    names: tuple[str, ...] = ()
    label: str = ""
    chars: int = 0
    linked: int = 0
    controls: int = 0
    text: list[str] = field(default_factory=list)
    end: bool = False


def parse(page: str) -> list[Node]:
    """Nodes in document order, parents first; node 0 is the page. Unclosed and stray tags are allowed, as browsers do.

    Linear in the page: a closing tag looks for its element only where one is open, and then closes all that it passes.
    """
    nodes = [Node("html", -1)]
    stack = [0]  # open block nodes
    open_tags: Counter = Counter()
    run = -1  # the text node that takes text now
    link_at = 0  # open blocks where the open link began; 0: no link is open
    at = 0
    found = _TAG.search(page, 0)
    lower = None
    has_body = False

    def put(text: str) -> None:
        nonlocal run
        if not text:
            return
        if "&" in text:
            text = html_lib.unescape(text)
        if run < 0:
            if text.isspace():
                return
            top = stack[-1]
            if nodes[top].tag in _LEAF and not nodes[top].end:
                run = top
            else:
                nodes.append(Node("#text", top, label=nodes[top].label))
                run = len(nodes) - 1
        own = nodes[run]
        own.text.append(text)
        n = len(text)
        own.chars += n
        if link_at:
            own.linked += n

    def flush() -> None:
        nonlocal run
        if run >= 0:
            nodes[run].end = True
        run = -1

    def cut(i: int) -> None:
        """Close the open blocks from place i of the stack on."""
        nonlocal link_at
        for k in stack[i:]:
            open_tags[nodes[k].tag] -= 1
        del stack[i:]
        if link_at > i:
            link_at = 0

    while found:
        put(page[at : found.start()])
        at = found.end()
        cdata, closing, tag, attributes = found.groups()
        if cdata is not None:
            put(cdata)
        elif tag:
            tag = tag.lower()
            if tag in _CONTROL and not closing:
                nodes[stack[-1]].controls += 1
            if tag in _RAW or tag == "head":
                if not closing and not attributes.rstrip().endswith("/"):
                    if lower is None:
                        lower = page.lower()
                        if len(lower) != len(page):  # a letter that lower-cases to two
                            lower = "".join(c.lower() if c.isascii() else c for c in page)
                    close = lower.find(f"</{tag}", at)
                    if tag == "head" and (body := lower.find("<body", at)) >= 0 and (close < 0 or body < close):
                        at = body
                    elif close >= 0:
                        at = (page.find(">", close) + 1) or len(page)
                    elif tag != "head":
                        at = len(page)
            elif tag in _BLOCK:
                flush()
                if closing:
                    if open_tags[tag]:
                        i = len(stack) - 1
                        while nodes[stack[i]].tag != tag:
                            i -= 1
                        cut(i)
                elif tag not in ("html", "body") or not has_body:
                    has_body = has_body or tag == "body"
                    shut = _CLOSES.get(tag)
                    top = nodes[stack[-1]].tag
                    if top == "p" or top in _HEADING and tag in _HEADING:
                        cut(len(stack) - 1)
                    if shut and any(open_tags[t] for t in shut):
                        for i in range(len(stack) - 1, 0, -1):
                            t = nodes[stack[i]].tag
                            if t in shut:
                                cut(i)
                                if tag != "tr" or t == "tr":
                                    break
                            elif t not in _OPEN:
                                break
                    names, label = _names(attributes) if "=" in attributes else ((), "")
                    if tag == "html":
                        nodes[0].label = label
                    else:
                        nodes[stack[-1]].end = True
                        nodes.append(Node(tag, stack[-1], names, label or nodes[stack[-1]].label))
                        stack.append(len(nodes) - 1)
                        open_tags[tag] += 1
            elif tag == "br":
                if run >= 0:
                    nodes[run].text.append(" ")
            elif tag == "hr":
                flush()
                nodes[stack[-1]].end = True
                if nodes[stack[-1]].tag == "p":
                    cut(len(stack) - 1)
            elif tag == "a":
                link_at = 0 if closing else len(stack)
        found = _TAG.search(page, at)
    put(page[at:])
    return nodes


def _names(attributes: str) -> tuple[tuple[str, ...], str]:
    words: list[str] = []
    label = ""
    for kind, a, b, c in _ATTRIBUTE.findall(attributes):
        if kind == "data-y":
            label = a
        else:
            words += [w.lower() for w in _WORD.findall(a or b or c)]
    return tuple(dict.fromkeys(words[:24])), label


def _share(part: float, whole: float) -> int:
    """0: none, 1 to 4: up to a quarter, ..., all but a tenth, 5: nearly all."""
    return 0 if not part else 1 + min(3, int(4 * part / whole)) + (part >= 0.9 * whole)


def features(nodes: list[Node]) -> list[list[str]]:
    """What each node shows; see the module's first lines. One pass up and one down."""
    n = len(nodes)
    chars, linked, controls = [x.chars for x in nodes], [x.linked for x in nodes], [x.controls for x in nodes]
    said, blocks, last, heads = [0] * n, [0] * n, list(range(n)), [0] * n
    lead: list[tuple[str, ...]] = [()] * n
    own_text: list[str] = [""] * n
    counts = [0] * n
    for i in range(n - 1, -1, -1):
        x = nodes[i]
        if x.text:
            own_text[i] = text = " ".join("".join(x.text).split())
            if text:
                counts[i] = k = text.count(" ") + 1
                blocks[i] += 1
                heads[i] += x.tag in _HEADING
                if k > 4 and _ENDS.search(text[-6:]):
                    said[i] += x.chars
                if k <= 7:
                    lead[i] = tuple(w.lower() for w in _TOKEN.findall(text) if len(w) > 3)
        if i:
            p = x.parent
            chars[p] += chars[i]
            linked[p] += linked[i]
            controls[p] += controls[i]
            said[p] += said[i]
            blocks[p] += blocks[i]
            heads[p] += heads[i]
            last[p] = max(last[p], last[i])
            if chars[i]:
                lead[p] = lead[i]
    mates: dict[tuple, list[int]] = {}  # what siblings of one tag and name hold together
    for i in range(1, n):
        own_mates = mates.setdefault((nodes[i].parent, nodes[i].tag, nodes[i].names), [0, 0, 0, 0])
        for k, value in enumerate((chars[i], linked[i], said[i], 1)):
            own_mates[k] += value
    total = chars[0] or 1
    title = next((i for i, x in enumerate(nodes) if x.tag == "h1" and x.text), None) or next((i for i, x in enumerate(nodes) if x.tag in ("h2", "h3") and x.text), None)
    page_size = min(8, int(math.log(total + 1, 3)))
    wrappers = sum(1 for x in nodes if x.tag in ("div", "section", "article", "main", "nav", "aside", "header", "footer", "td"))
    flat = f"flat={min(wrappers, 3)}"
    over: list[tuple[str, ...]] = [()] * n
    heading_of: dict[int, tuple[str, ...]] = {}
    inside: list[str] = [""] * n
    before = 0
    out = []
    for i, x in enumerate(nodes):
        if i:
            p = x.parent
            over[i] = heading_of.get(p, over[p])
            inside[i] = inside[p]
            if nodes[p].tag in _PART:
                inside[i] = f"{inside[p].rpartition('+')[2]}+{nodes[p].tag}" if inside[p] else nodes[p].tag
        c = chars[i]
        leaf = x.tag in _LEAF or x.tag == "#text"
        g = "t" if leaf else "w"
        size = 0 if not c else min(7, 1 + int(math.log(c, 3)))
        links = _share(linked[i], c)
        place = int(10 * before / total) if 0.05 * total < before < 0.95 * total else -1 if before < 0.05 * total else 10
        where = "no" if title is None else "pre" if last[i] < title else "post" if i > title else "has"
        own = ["bias", f"tag={x.tag}", f"{g}links={links}", f"{g}size={size}", f"tag={x.tag}/links={links}", f"{g}place={place}", f"{g}h1={where}", f"page={page_size}/{g}", f"{g}{flat}", f"{g}said={_share(said[i], c)}", f"{g}said={_share(said[i], c)}/size={size}", f"{g}in={inside[i]}"]
        if i:
            a, b, d, k = mates[x.parent, x.tag, x.names]
            a, b, d = a - c, b - linked[i], d - said[i]
            own.append(f"{g}mates={min(7, 1 + int(math.log(a, 3)))}/{_share(b, a)}/{bool(2 * d > a)}" if k > 1 and a else f"{g}mates={min(k, 2)}")
        if x.tag == "#text":
            own += [f"in name={w}" for w in nodes[x.parent].names]
        if x.names:
            own += [f"name={w}" for w in x.names]
            if len(x.names) > 1:
                own += [f"name={a}-{b}" for a, b in zip(x.names, x.names[1:])]
        else:
            own.append(f"unnamed={x.tag}")
        if leaf and c:
            text, k = own_text[i], counts[i]
            own.append(f"words={min(k, 4) if k < 5 else 5 + min(4, k // 10)}/ends={bool(_ENDS.search(text[-6:]))}")
            own.append(f"in={inside[i]}/ends={k > 4 and bool(_ENDS.search(text[-6:]))}")
            if c < 400 and _LEGAL.search(text):
                own.append("legal")
            if k < 12 and _DATE.search(text):
                own.append("date")
        if not leaf:
            own.append(f"blocks={min(6, int(math.log2(blocks[i] + 1)))}/links={links}")
            own.append(f"heads={min(2, heads[i])}/said={_share(said[i], c)}")
            if controls[i]:
                own.append(f"controls={min(3, controls[i])}")
                own.append(f"controls/size={size}")
            if c < 400 and any(_LEGAL.search(t) for t in own_text[i : last[i] + 1] if t):
                own.append("wlegal")
        own += [f"says={w}" for w in lead[i]]
        own += [f"over={w}" for w in over[i]]
        if i and (x.tag in _HEADING or x.tag in ("strong", "b")) and counts[i]:
            heading_of[x.parent] = lead[i]
        before += x.chars
        out.append(list(dict.fromkeys(own)))
    return out


def states(nodes: list[Node]) -> list[int]:
    """The state of each node of a labelled page: text by its mark, a wrapper by the texts in it; -1 where there is none."""
    seen = [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        if nodes[i].text and not "".join(nodes[i].text).isspace():
            seen[i] |= 2 if nodes[i].label == "c" else 1
        if i:
            seen[nodes[i].parent] |= seen[i]
    return [(-1, B, C, M)[s] for s in seen]


def _classifier(rows: list[list[int]], y: np.ndarray, width: int, weight: np.ndarray, rounds: int, ridge: float) -> np.ndarray:
    """Log-linear weights (width, 3) by full-batch gradient steps with a step size for each weight."""
    index = np.concatenate([np.array(r, np.int64) for r in rows])
    size = np.array([len(r) for r in rows])
    start = np.r_[0, np.cumsum(size)[:-1]]
    w, m, v = (np.zeros((width, 3)) for _ in range(3))
    target = np.eye(3)[y]
    for t in range(1, rounds + 1):
        z = np.add.reduceat(w[index], start)
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        d = np.repeat((p - target) * weight[:, None], size, axis=0)
        g = np.stack([np.bincount(index, d[:, k], width) for k in range(3)], 1) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8) / (1 + t / 40)
    return w


@dataclass
class Model:
    """Log potentials: emit[feature][state], prior[state] of the page, move[parent state][state] as probabilities."""

    emit: dict[str, tuple[float, float, float]]
    prior: tuple[float, ...]
    move: tuple[tuple[float, ...], ...]

    @staticmethod
    def train(pages: list[str], smooth: float = 0.5, least: int = 4, rounds: int = 90, ridge: float = 0.3, trust: float = 0.8) -> Model:
        """From pages whose elements carry their state in data-y (inherited by children).

        least: times that a feature must occur. trust: power of the node potentials, under one because neighbouring nodes
        show much the same. An empty list gives potentials that prefer nothing.
        """
        moves = [[smooth] * 3 for _ in range(3)]
        prior = [smooth] * 3
        found: Counter = Counter()
        for page in pages:
            nodes = parse(page)
            y = states(nodes)
            for i, own in enumerate(features(nodes)):
                if y[i] < 0:
                    continue
                found[tuple(own), y[i]] += 1
                if i:
                    moves[y[nodes[i].parent]][y[i]] += 1
                else:
                    prior[y[i]] += 1
        seen = Counter(f for own, _ in found for f in own)
        vocabulary = {f: k for k, f in enumerate(f for f, n in seen.items() if n >= least)}
        emit: dict[str, tuple[float, float, float]] = {"bias": (0.0, 0.0, 0.0)}
        if found:
            vocabulary.setdefault("bias", len(vocabulary))
            y, weight = np.array([k for _, k in found]), np.array(list(found.values()), float)
            w = _classifier([[vocabulary[f] for f in own if f in vocabulary] for own, _ in found], y, len(vocabulary), weight, rounds, ridge)
            w[vocabulary["bias"]] -= np.log((np.bincount(y, weight, 3) + smooth) / weight.sum())
            emit = {f: tuple((trust * w[k]).tolist()) for f, k in vocabulary.items()}
        return Model(emit, tuple(p / sum(prior) for p in prior), tuple(tuple(x / sum(r) for x in r) for r in moves))

    def marginals(self, nodes: list[Node]) -> list[tuple[float, float, float]]:
        """Exact marginals of every node by sum-product message passing."""
        emit, move = self.emit, self.move
        belief: list[list[float]] = []
        for own in features(nodes):
            e = [0.0, 0.0, 0.0]
            for f in own:
                if p := emit.get(f):
                    e[0] += p[0]
                    e[1] += p[1]
                    e[2] += p[2]
            top = max(e)
            belief.append([max(math.exp(x - top), 1e-30) for x in e])
        up: list[list[float]] = [[1.0] * 3 for _ in nodes]
        for i in range(len(nodes) - 1, 0, -1):
            b = belief[i]
            m = [r[0] * b[0] + r[1] * b[1] + r[2] * b[2] for r in move]
            top = max(m)
            up[i] = m = [max(x / top, 1e-30) for x in m]
            p = belief[nodes[i].parent]
            p[0] *= m[0]
            p[1] *= m[1]
            p[2] *= m[2]
            top = max(p)
            if top < 1e-100:
                for k in range(3):
                    p[k] = max(p[k] / top, 1e-30)
        out: list[tuple[float, float, float]] = []
        for i, n in enumerate(nodes):
            if i:
                parent, m = out[n.parent], up[i]
                rest = (parent[0] / m[0], parent[1] / m[1], parent[2] / m[2])
                down = [rest[0] * move[0][k] + rest[1] * move[1][k] + rest[2] * move[2][k] for k in range(3)]
            else:
                down = list(self.prior)
            b = belief[i]
            q = [down[k] * b[k] for k in range(3)]
            total = sum(q) or 1.0
            out.append((q[0] / total, q[1] / total, q[2] / total))
        return out


def extract(page: str | None, model: Model, least: float = 0.5) -> str:
    """The main text of a page, blocks joined by line ends; null, empty or without content: empty."""
    if not page:
        return ""
    nodes = parse(page)
    if not any(n.text for n in nodes):
        return ""
    blocks = []
    for n, p in zip(nodes, model.marginals(nodes)):
        if n.text and p[C] > least:
            block = " ".join("".join(n.text).split())
            if block:
                blocks.append(block)
    return "\n".join(blocks)


@functools.cache
def default_model() -> Model:
    """The model of the query, trained on labelled_pages()."""
    return Model.train(labelled_pages())


def extract_pages(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row; the model (default: trained on labelled_pages) is of fixed size.

    Null and empty pages give an empty text. Rows repeat as they came, null ids and urls pass through, an empty table gives
    no rows and other columns are ignored. Pages are read whole, in time linear in their length, however deep they nest.
    """
    spark = pages.sparkSession
    held = spark.sparkContext.broadcast(model or default_model())
    schema = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.parts(batches):
            texts = [extract(h, held.value) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`"), F.col(f"`{html_col}`")).mapInArrow(run, schema)

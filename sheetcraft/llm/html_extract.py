"""Operator 5: main text by a tree-structured graphical model.

A node of a page's block tree is content, frame (it holds content) or other.
A parent-child potential holds how often a child takes each state under each
state of its parent;
a node potential holds its tag, the words of its class, id, role and itemprop,
and for runs of text their length, link share and ending.  All come from
counts over labelled pages.  Sum-product messages up and down the tree give
exact marginals; runs with a content marginal over one half are the text.

Labelled pages: built from layout parts below with known labels (parameter
``layouts``), and a bounded sample of the table's own pages that hold exactly
one ``article`` element, labelled by it.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetcraft.llm.common import once_a_worker, prepare
from sheetcraft.llm.dom import Node, attribute_values, block_tree

_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_STOPS = (".", "!", "?", ":", "…", '"', "”", "。")


# Elements that tell what holds a block where none of its ancestors is named.
_SECTIONS = ("article", "main", "section", "aside", "nav", "header", "footer", "form")


NOWHERE = ["near -"]


def node_features(nodes: list[Node]) -> list[list[str]]:
    """Tag and names, or length, links and end of a run; and for both the names
    (or the section tag) of the nearest ancestor that has some, so that every
    paragraph inside a part bears witness to what the part is called.  That there
    is no such ancestor tells something of a run alone."""
    out, marks = [], []
    for node in nodes:
        near = marks[node.parent] if node.parent >= 0 else NOWHERE
        mark = near
        if node.tag != "#run":
            own = ["tag " + node.tag]
            if node.attributes:
                words = {w.lower() for key, value in attribute_values(node) if key != "data-main" for w in _WORDS.findall(value)}
                own.extend("word " + w for w in sorted(words))
                mark = ["near " + w for w in sorted(words)] or mark
            if mark is near and node.tag in _SECTIONS:
                mark = ["near <" + node.tag]
        else:
            n = node.text.count(" ") + 1
            size = 0 if n < 3 else 1 if n < 6 else 2 if n < 13 else 3 if n < 31 else 4
            share = node.link_chars / len(node.text)
            stop = node.text.endswith(_STOPS)
            own = [f"run {size} {0 if share == 0 else 1 if share < 0.5 else 2} {stop}"]
        if node.tag == "#run" or near != NOWHERE:
            own.extend(near)
        out.append(own)
        marks.append(mark)
    return out


FRAME, CONTENT, OTHER = range(3)
UNSEEN = 0.05  # counted for a feature that a state never showed
STATES = range(3)


class TreeModel:
    """Counts of labelled trees, and marginals of others."""

    def __init__(self) -> None:
        self.features: dict[str, list[float]] = {}
        self.kinds: dict[str, list[float]] = {}
        # From an element to an element, and to a run of text.
        self.steps = {kind: [[0.5] * 3 for _ in STATES] for kind in (False, True)}
        self.weights: dict[str, tuple[float, float, float]] = {}

    def add(self, nodes: list[Node], labels: list[int]) -> None:
        for node, label, own in zip(nodes, labels, node_features(nodes)):
            if node.parent >= 0:
                self.steps[node.tag == "#run"][labels[node.parent]][label] += 1
            for f in own:
                self.features.setdefault(f, [0.0] * 3)[label] += 1
                self.kinds.setdefault(f.split(" ")[0], [0.0] * 3)[label] += 1

    def finish(self) -> None:
        sizes = Counter(f.split(" ")[0] for f in self.features)
        for f, counts in self.features.items():
            kind = f.split(" ")[0]
            self.weights[f] = tuple(
                math.log((counts[y] + UNSEEN) / (self.kinds[kind][y] + UNSEEN * sizes[kind])) for y in STATES
            )
        self.steps = {kind: [[x / sum(row) for x in row] for row in rows] for kind, rows in self.steps.items()}

    def node_potential(self, own: list[str]) -> list[float]:
        logs = [0.0] * 3
        for f in own:
            if f in self.weights:
                logs = [x + w for x, w in zip(logs, self.weights[f])]
        top = max(logs)
        return [math.exp(max(x - top, -60.0)) for x in logs]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content of every node; the page itself is frame."""
        n, tables = len(nodes), [self.steps[node.tag == "#run"] for node in nodes]
        below = [self.node_potential(own) for own in node_features(nodes)]
        to_parent: list[list[float]] = [[]] * n
        # Upward: what a node's subtree says about the node, then, through the
        # potential, about its parent; scaled, so deep pages do not underflow.
        for i in range(n - 1, 0, -1):
            own = below[i] = _scaled(below[i])
            message = to_parent[i] = _scaled([sum(step[y] * own[y] for y in STATES) for step in tables[i]])
            p = nodes[i].parent
            below[p] = [x * m for x, m in zip(below[p], message)]
            if max(below[p]) < 1e-150:
                below[p] = _scaled(below[p])
        # Downward: the parent's belief without this subtree's own message.
        belief = [[1.0, 0.0, 0.0]] * n
        for i in range(1, n):
            rest = [x / m for x, m in zip(belief[nodes[i].parent], to_parent[i])]
            down = [sum(r * step[y] for r, step in zip(rest, tables[i])) for y in STATES]
            belief[i] = _scaled([x * d for x, d in zip(below[i], down)])
        return [x[CONTENT] for x in belief]


def _scaled(values: list[float]) -> list[float]:
    total = sum(values)
    return [x / total + 1e-100 for x in values]


def main_text(model: TreeModel, html: str | None) -> str:
    nodes = block_tree(html or "")
    return "\n".join(n.text for n, p in zip(nodes, model.marginals(nodes)) if n.tag == "#run" and p > 0.5)


# ---------------------------------------------------------------------------
# Labelled pages.  Fixed values: names that sites commonly give to page parts.
PARTS = {
    "nav": (("nav", "div", "ul"), "nav menu navbar navigation topnav breadcrumb breadcrumbs toc links pagination pager tabs skip"),
    "head": (("header", "div"), "header masthead banner top site logo brand branding tagline topbar hero toolbar"),
    "foot": (("footer", "div"), "footer foot bottom copyright legal colophon credits imprint"),
    "side": (("aside", "div", "section"), "sidebar side rail aside widget column secondary related recommended popular trending teaser more"),
    "note": (("div", "section", "p", "aside"), "notice cookie cookies consent gdpr alert message popup modal overlay banner privacy warning disclaimer toast"),
    "ad": (("div", "aside", "section", "ins", "p"), "ad ads advert advertisement adbox sponsor sponsored promo promotion banner outbrain"),
    "form": (("form", "div"), "form newsletter subscribe signup login search contact subscription register"),
    "talk": (("section", "div", "ol", "ul"), "comments comment replies reply respond discussion responses disqus thread commentlist feedback"),
    "share": (("div", "ul", "p"), "share social sharing follow tags meta byline author print tools"),
}
COMMENTS = {"comments", "comment", "commentlist", "replies", "disqus"}
BODIES = (("article", "main", "div", "section"), "article content post entry story body text main single blog news articlebody postcontent entrycontent")
CHAPTERS = "introduction background methods results discussion summary conclusion chapter feedback responses thread more"
WRAPS = "wrapper container page row col layout outer inner grid root app shell"
_LETTERS = "etaoinshrdlu"


def _sentence(rng: random.Random, lo: int, hi: int, stop: bool = True) -> str:
    words = ["".join(rng.choices(_LETTERS, k=rng.randint(2, 8))) for _ in range(rng.randint(lo, hi))]
    return " ".join(words).capitalize() + ("." if stop else "")


def _named(rng: random.Random, names: str) -> str:
    if rng.random() < 0.2:
        return ""
    own = "-".join(rng.sample(names.split(), rng.choice((1, 1, 2))))
    return f' {rng.choice(("class", "class", "id", "role"))}="{own}"'


def _links(rng: random.Random, n: int) -> str:
    return "".join(f'<li><a href="/x">{_sentence(rng, 1, 3, False)}</a></li>' for _ in range(n))


def _part(rng: random.Random, kind: str) -> str:
    tags, names = PARTS[kind]
    tag = rng.choice(tags)
    name = _named(rng, names)
    if not name and tag in ("div", "p", "section", "ul", "ol", "ins"):  # nothing else would tell what it is
        name = f' class="{rng.choice(names.split())}"'
    if kind in ("nav", "share"):
        inner = _links(rng, rng.randint(2, 8)) if tag in ("ul", "ol") else f"<ul>{_links(rng, rng.randint(2, 8))}</ul>"
        if tag == "p":
            inner = f'<a href="/s">{_sentence(rng, 1, 3, False)}</a> {_sentence(rng, 1, 3, False)}'
    elif kind == "head":
        inner = rng.choice(("<h1>{}</h1>", "<div>{}</div>", "<p>{}</p>", '<a href="/">{}</a>')).format(_sentence(rng, 1, 6, rng.random() < 0.3))
    elif kind == "foot":
        inner = rng.choice(("<p>&copy; {}</p>", "&copy; {}", "{}", "<ul><li>{}</li></ul>")).format(_sentence(rng, 2, 14, rng.random() < 0.5))
    elif kind == "side":
        inner = f"<h3>{_sentence(rng, 1, 4, False)}</h3>" + rng.choice(("<ul>" + _links(rng, 4) + "</ul>", f"<p>{_sentence(rng, 5, 25)}</p>"))
    elif kind == "form":
        inner = f"<label>{_sentence(rng, 1, 6, False)}</label><input name=q><button>{_sentence(rng, 1, 2, False)}</button>"
        if rng.random() < 0.5:
            inner = f"<p>{_sentence(rng, 4, 16)}</p>" + inner
    elif kind == "talk":
        item = "li" if tag in ("ol", "ul") else rng.choice(("div", "p", "article"))
        inner = "" if item == "li" else f"<h3>{_sentence(rng, 1, 3, False)}</h3>"
        for _ in range(rng.randint(1, 6)):
            own = f' class="{rng.choice(names.split()[:4])}"' if rng.random() < 0.5 else ""
            said = " ".join(_sentence(rng, 1, 20) for _ in range(rng.randint(1, 4)))
            if item == "p":
                inner += f"<p{own}>{said}</p>"
            else:
                inner += f"<{item}{own}>{_sentence(rng, 1, 2, False)}<p>{said}</p></{item}>"
    else:
        inner = rng.choice(("{}", "{}", "<p>{}</p>", "<span>{}</span> <a href='/y'>more</a>")).format(_sentence(rng, 4, 30))
    return f"<{tag}{name}>{inner}</{tag}>"


def _article(rng: random.Random) -> str:
    tag = rng.choice(("article", "article") + BODIES[0])
    name = _named(rng, BODIES[1])
    out = [f"<h1>{_sentence(rng, 2, 14, rng.random() < 0.3)}</h1>"]
    for _ in range(rng.randint(1, 9)):
        kind = rng.random()
        text = " ".join(_sentence(rng, 1, 20) for _ in range(rng.randint(1, 5)))
        if kind < 0.72:
            out.append(f"<p>{text}</p>")
        elif kind < 0.78:
            out.append("<{0}>{1}</{0}>".format(rng.choice(("h2", "h3")), _sentence(rng, 1, 6, False)))
        elif kind < 0.84:
            out.append("<ul>" + "".join(f"<li>{_sentence(rng, 1, 12)}</li>" for _ in range(3)) + "</ul>")
        elif kind < 0.88:
            out.append(f"<blockquote>{text}</blockquote>")
        elif kind < 0.92:
            out.append(f'<p>{text} <a href="/z">{_sentence(rng, 1, 3, False)}</a> {text}</p>')
        elif kind < 0.94:
            out.append(f"<pre>{text}</pre><table><tr><td>{text}</td><td>{_sentence(rng, 1, 3, False)}</td></tr></table>")
        elif kind < 0.95:
            out.append(f"<div>{text}</div>")
        elif kind < 0.965:
            out.append(f'<section id="{rng.choice(CHAPTERS.split())}"><h2>{_sentence(rng, 1, 4, False)}</h2><p>{text}</p></section>')
        else:
            part = _part(rng, rng.choice(("ad", "note", "share", "form", "side", "nav")))
            out.append(part.replace(">", ' data-main="0">', 1))
    if rng.random() < 0.2:  # readers' comments inside the article
        out.append(_part(rng, "talk").replace(">", ' data-main="0">', 1))
    elif rng.random() < 0.3:  # and without a part around them
        item, own = rng.choice(("article", "div", "li")), rng.choice(("comment", "comment", "reply", "comment-body"))
        for _ in range(rng.randint(1, 12)):
            said = " ".join(_sentence(rng, 1, 20) for _ in range(rng.randint(1, 4)))
            out.append(f'<{item} class="{own}" data-main="0"><p>{said}</p></{item}>')
    return f'<{tag}{name} data-main="1">{"".join(out)}</{tag}>'


def layout_page(seed: int) -> str:
    """A page of random parts; ``data-main`` marks content (1) and parts that
    are none (0) inside it."""
    rng = random.Random(seed)
    before = [_part(rng, k) for k in ("head", "nav", "note", "ad", "form", "side") if rng.random() < 0.5]
    after = [_part(rng, k) for k in ("share", "side", "talk", "ad", "nav", "form", "note", "foot") if rng.random() < 0.5]
    body = _article(rng)
    for _ in range(rng.randint(0, 3)):
        body = f"<div{_named(rng, WRAPS)}>{body}</div>"
    return f"<html><head><title>{_sentence(rng, 2, 8)}</title></head><body>{''.join(before)}{body}{''.join(after)}</body></html>"


def with_frame(nodes: list[Node], content: list[bool], other: list[bool]) -> list[int]:
    """States from content and parts known to be none: what else holds
    content is frame, and the rest is other."""
    labels = [CONTENT if c else OTHER for c in content]
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        if labels[i] != OTHER and not content[p] and not other[p]:
            labels[p] = FRAME
    return labels


def marked_labels(nodes: list[Node]) -> list[int]:
    content, other = [], []
    for node in nodes:
        mark = dict(attribute_values(node)).get("data-main") if node.attributes else None
        content.append(mark == "1" or (mark is None and node.parent >= 0 and content[node.parent]))
        other.append(mark == "0" or (node.parent >= 0 and other[node.parent]))
    return with_frame(nodes, content, other)


def article_labels(nodes: list[Node]) -> list[int] | None:
    """Labels by the page's only article element that is no comment, without
    parts and comments inside it; None if there is not one."""
    content, other, articles = [], [], 0
    for node in nodes:
        inside, out = node.parent >= 0 and content[node.parent], node.parent >= 0 and other[node.parent]
        names = {w.lower() for _, value in attribute_values(node) for w in _WORDS.findall(value)} if node.attributes else set()
        out = out or bool(names & COMMENTS) or (inside and node.tag in ("nav", "aside", "form", "footer", "header"))
        articles += node.tag == "article" and not out
        content.append(not out and (inside or node.tag == "article"))
        other.append(out)
    return with_frame(nodes, content, other) if articles == 1 else None


def train_model(sample: Iterable[str], layouts: int) -> TreeModel:
    model = TreeModel()
    for seed in range(layouts):
        nodes = block_tree(layout_page(seed))
        model.add(nodes, marked_labels(nodes))
    for html in sample:
        nodes = block_tree(html)
        if labels := article_labels(nodes):
            model.add(nodes, labels)
    model.finish()
    return model


def _model(sample: list[str], layouts: int) -> TreeModel:
    key = ("pages", zlib.crc32("\0".join(sample).encode("utf-8", "surrogatepass")), layouts)
    return once_a_worker(key, lambda: train_model(sample, layouts))


def extract_main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    layouts: int = 400,
    sample_pages: int = 100,
    sample_chars: int = 20_000,
) -> DataFrame:
    """``(id_col, url_col, text, n_chars)``, a row a page row, in one pass.

    Blocks are runs of inline text between block boundaries, references
    decoded, white space made one blank, joined by line feeds; nothing else is
    dropped or cut.  The model learns from ``layouts`` built pages and at most
    ``sample_pages`` of the table's pages of up to ``sample_chars`` characters
    (those of the smallest text hash).  A null or empty page, and one without
    content, has an empty text; so has a page of text without any element that
    could be told from its frame.  Repeated rows keep their rows; other columns
    are not read."""
    prepare(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    short = rows.where((F.length("html") <= sample_chars) & F.col("html").contains("<article"))
    # Of each partition only the smallest hashes are shuffled; the pages
    # themselves are then fetched by hash.
    keyed = short.select(F.xxhash64("html").alias("key"), "html")
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("key"))
    chosen = keyed.select("key").withColumn("rank", rank).where(F.col("rank") <= sample_pages).select("key").distinct()
    found = keyed.join(F.broadcast(chosen), "key").groupBy("key").agg(F.min("html").alias("html")).orderBy("key").collect()
    sample = [r["html"] for r in found]

    def run(batches):
        model = _model(sample, layouts)
        for batch in batches:
            texts = [main_text(model, html) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, f"{id_col} long, {url_col} string, text string, n_chars long")

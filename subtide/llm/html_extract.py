"""Main text of web pages by a tree-structured graphical model.

Every element of the page is a variable: content or not. Its tag, names and text give it a
potential, and so does each edge from parent to child. Messages go up the tree and down
again (sum-product, exact on a tree), all pages of a batch at once, level by level. The
weights are fitted to labelled pages by their likelihood.
"""

from __future__ import annotations

import html as html_module
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.llm.labelled_pages import LABEL, labelled_pages
from subtide.llm.pieces import text_slices

#: A quote delimits a value only straight after "=", elsewhere it is a character like others.
#: A tag without an end goes on to the end of the page, as browsers have it.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>]*+))*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(rf"\b(class|id|role|{LABEL})\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: Fixed values of HTML.
RAW = {"script", "style", "noscript", "iframe", "title", "textarea"}
FALLBACK = {"object", "canvas", "template"}  # may hold blocks; without an end tag they end before the next one
DROPPED = FALLBACK | {"svg", "math", "select", "option"}  # their text is never main text
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var".split())
CLOSES = {  # an opening tag ends open elements of these kinds, up to the barrier
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "body": ({"head"}, set()),
}
ENDS_PARAGRAPH = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
PARAGRAPH_BARRIER = {"div", "section", "article", "td", "th", "li", "blockquote", "body", "main", "aside", "table", "button"}
LEAVES = set("p h1 h2 h3 h4 h5 h6 li dd dt td th tr tbody pre blockquote ul ol dl table figure figcaption caption".split())
NOWHERE = -1


@dataclass
class Page:
    """Elements in page order (parent before child), and the pieces of text with their
    element and block."""

    tags: list[str]
    parents: list[int]
    names: list[tuple[str, ...]]
    labels: list[int]
    pieces: list[tuple[int, int, str]]
    linked: list[int]  # characters of links, by element


def parse(page: str | None, labelled: bool = False) -> Page:
    """Elements that only style text are part of the element around them, unless named.
    Whatever is not closed ends with its parent; an unmatched end tag ends nothing. Elements
    whose text is dropped have no variable, nor has what stands in them."""
    out = Page(["#"], [NOWHERE], [()], [0], [], [0])
    if not page:
        return out
    stack: list[tuple[str, int]] = [("#", 0)]  # open tags and their elements
    where: dict[str, list[int]] = {}  # for each tag the depths at which it is open
    blocks: list[int] = [0]  # depths of open tags that are not inline
    fences: list[int] = [0]  # depths of open tags that blocks and end tags stay inside
    block = links = at = dropped = 0
    ended_at: dict[str, set[int]] = {}

    def text(until: int) -> None:
        if until > at and not dropped:
            raw = page[at:until]
            if not raw.isspace():
                out.linked[stack[-1][1]] += len(raw) * (links > 0)
            out.pieces.append((stack[-1][1], block, raw))

    def close(depth: int) -> None:
        nonlocal block, links, dropped
        for tag, _ in reversed(stack[depth:]):
            links -= tag == "a"
            block += not dropped and tag not in INLINE
            dropped -= tag in DROPPED
            where[tag].pop()
        del stack[depth:]
        for depths in (blocks, fences):
            while depths[-1] >= depth:
                depths.pop()

    def innermost(tags: set[str]) -> int:
        """The depth of the innermost open tag of these; 0 if none is open."""
        return max((where[t][-1] for t in tags if where.get(t)), default=0)

    def has_end(tag: str, start: int) -> bool:
        """Whether the element that starts there has an end tag of its own."""
        if tag not in ended_at:
            ended_at[tag], starts = set(), []
            for m in TAG.finditer(page):
                if m[2] is not None and m[2].lower() == tag and not m[3].endswith("/"):
                    if not m[1]:
                        starts.append(m.start())
                    elif starts:
                        ended_at[tag].add(starts.pop())
        return start in ended_at[tag]

    while (match := TAG.search(page, at)) is not None:
        text(match.start())
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if match[1]:
            depth = innermost({tag})
            if depth and depth >= fences[-1] and (tag not in INLINE or depth >= blocks[-1]):
                close(depth)
            continue
        if tag in ENDS_PARAGRAPH:
            if dropped and tag not in VOID:
                while (depth := innermost(DROPPED)) > max(fences[-1], innermost({"foreignobject"})):
                    close(depth)
            depth = innermost({"p"})
            if depth > max(fences[-1], innermost(PARAGRAPH_BARRIER)):
                close(depth)
        if tag in CLOSES:
            ended, barrier = CLOSES[tag]
            while (depth := innermost(ended)) > max(fences[-1], innermost(barrier)):
                close(depth)
        if tag in VOID:
            block += not dropped and tag in ("br", "hr")
            continue
        names: list[str] = []
        label = None
        if match[3]:
            for kind, *values in ATTRIBUTE.findall(match[3]):
                value = next((v for v in values if v), "")
                if kind.lower() == LABEL:
                    label = int(value) if labelled else None
                else:
                    mark = "role=" if kind.lower() == "role" else ""
                    names += [mark + p.lower() for p in NAME_PART.findall(value)]
        if tag in RAW and not match[3].endswith("/"):
            # raw text ends at its own end tag, whatever stands in it
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        node = stack[-1][1]
        if not dropped and tag not in DROPPED and (tag not in INLINE or names):
            block += tag not in INLINE
            node = len(out.tags)
            out.tags.append(tag)
            out.parents.append(stack[-1][1])
            out.names.append(tuple(names))
            out.labels.append(out.labels[stack[-1][1]] if label is None else label)
            out.linked.append(0)
        links += tag == "a"
        if not match[3].endswith("/") or tag in INLINE or tag in ENDS_PARAGRAPH:
            depth = len(stack)
            stack.append((tag, node))
            where.setdefault(tag, []).append(depth)
            if tag not in INLINE:
                blocks.append(depth)
            if tag in FALLBACK and has_end(tag, match.start()):
                fences.append(depth)
            dropped += tag in DROPPED
    text(len(page))
    return out


def _features(page: Page) -> list[list[str]]:
    n = len(page.tags)
    chars, stops = [0] * n, [0] * n
    for node, _, raw in page.pieces:
        chars[node] += len(raw.strip())
        stops[node] += raw.count(". ") + raw.count(", ") + raw.rstrip().endswith(".")
    paragraphs = [0] * n
    for node in range(n - 1, 0, -1):
        if page.tags[node] in ("p", "h1", "h2", "h3", "pre"):
            paragraphs[page.parents[node]] += 1
    out = []
    for node in range(n):
        tag, parent = page.tags[node], page.parents[node]
        own = ["bias", "tag=" + tag, *("name=" + x for x in page.names[node])]
        if parent >= 0:
            own.append(f"in={page.tags[parent]}>{tag}")
        size = chars[node]
        own.append("chars=0" if not size else f"chars={min(size.bit_length() // 2, 5)}")
        if size:
            own += [f"links={min(3, 4 * page.linked[node] // size)}", f"stops={min(stops[node], 3)}"]
        own.append(f"paragraphs={min(paragraphs[node], 4)}>{'body' if tag == 'body' else 'other'}")
        out.append(own)
    return out


@dataclass
class Forest:
    """The elements of many pages: feature numbers (row by row), parents, edge kinds and
    levels."""

    rows: np.ndarray
    columns: np.ndarray
    parents: np.ndarray
    kinds: np.ndarray
    levels: list[np.ndarray]

    @staticmethod
    def of(pages: list[Page], vocabulary: dict[str, int], learn: bool = False) -> "Forest":
        rows, columns, parents, kinds, depths = [], [], [], [], []
        start = 0
        for page in pages:
            for i, features in enumerate(_features(page)):
                for f in features:
                    number = vocabulary.setdefault(f, len(vocabulary)) if learn else vocabulary.get(f)
                    if number is not None:
                        rows.append(start + i)
                        columns.append(number)
            depth: list[int] = []
            for tag, parent in zip(page.tags, page.parents):
                depth.append(0 if parent < 0 else depth[parent] + 1)
                parents.append(parent if parent < 0 else parent + start)
                kinds.append(int(tag in LEAVES or tag in INLINE))
            depths += depth
            start += len(page.tags)
        deep = np.array(depths)
        order = np.argsort(deep, kind="stable")
        levels = np.split(order, np.cumsum(np.bincount(deep))[:-1]) if len(deep) else []
        return Forest(np.array(rows, dtype=np.int64), np.array(columns, dtype=np.int64), np.array(parents, dtype=np.int64), np.array(kinds, dtype=np.int64), levels)


def _total(x: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp(*np.moveaxis(x, axis, 0))


def sum_product(score: np.ndarray, edges: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of content, joint marginals of parent and child (zero for roots), and the
    logarithm of the partition function. score: of content against not, by element; edges:
    [kind, parent's label, child's label]."""
    n = len(score)
    below = np.column_stack([np.zeros(n), score])  # with the messages from the children
    up = np.zeros((n, 2))
    for level in reversed(forest.levels[1:]):
        up[level] = _total(edges[forest.kinds[level]] + below[level][:, None, :], 2)
        np.add.at(below, forest.parents[level], up[level])
    above, joint = np.zeros((n, 2)), np.zeros((n, 2, 2))
    for level in forest.levels[1:]:
        parent = forest.parents[level]
        rest = above[parent] + below[parent] - up[level]  # all of the parent but this child
        pair = rest[:, :, None] + edges[forest.kinds[level]]
        above[level] = _total(pair, 1)
        pair = pair + below[level][:, None, :]
        pair -= pair.max(axis=(1, 2), keepdims=True)
        joint[level] = np.exp(pair) / np.exp(pair).sum(axis=(1, 2), keepdims=True)
    both = above + below
    roots = forest.levels[0] if forest.levels else np.empty(0, dtype=np.int64)
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700))), joint, float(_total(below[roots], 1).sum())


@dataclass
class Model:
    vocabulary: dict[str, int]
    weights: np.ndarray
    edges: np.ndarray

    def content(self, pages: list[Page]) -> np.ndarray:
        forest = Forest.of(pages, self.vocabulary)
        score = np.bincount(forest.rows, self.weights[forest.columns], minlength=len(forest.parents))
        return sum_product(score, self.edges, forest)[0]


def train(pages: list[str] | None = None, rounds: int = 150, ridge: float = 0.02) -> Model:
    """Fits the potentials to labelled pages (by default the built-in ones) by gradient
    steps on the penalised likelihood, with the exact expectations of sum-product."""
    parsed = [parse(p, labelled=True) for p in (labelled_pages() if pages is None else pages)]
    vocabulary: dict[str, int] = {}
    forest = Forest.of(parsed, vocabulary, learn=True)
    label = np.array([y for p in parsed for y in p.labels])
    child = np.flatnonzero(forest.parents >= 0)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (forest.kinds[child], label[forest.parents[child]], label[child]), 1)
    theta = np.zeros(len(vocabulary) + 8)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        weights, edges = theta[:-8], theta[-8:].reshape(2, 2, 2)
        p, joint, _ = sum_product(np.bincount(forest.rows, weights[forest.columns], minlength=len(label)), edges, forest)
        slope = np.bincount(forest.columns, (label - p)[forest.rows], minlength=len(vocabulary))
        expected = np.stack([joint[child][forest.kinds[child] == k].sum(axis=0) for k in (0, 1)])
        gradient = np.concatenate([slope, (seen - expected).ravel()]) - ridge * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta = theta + 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(vocabulary, theta[:-8], theta[-8:].reshape(2, 2, 2))


def main_texts(pages: list[str | None], model: Model) -> list[str]:
    parsed = [parse(p) for p in pages]
    content = model.content(parsed) >= 0.5
    out, start = [], 0
    for page in parsed:
        blocks: dict[int, list[str]] = {}
        for node, block, raw in page.pieces:
            if content[start + node]:
                blocks.setdefault(block, []).append(html_module.unescape(raw))
        start += len(page.tags)
        out.append(" ".join(t for b in blocks.values() if (t := " ".join("".join(b).split()))))
    return out


def extract(pages: DataFrame, model: Model | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for each row of pages; nothing is shuffled. A null or empty
    page, or one without content, has an empty text; pages of any length are read whole, in
    time proportional to it; an empty table gives no row."""
    shared = pages.sparkSession.sparkContext.broadcast(model or train())  # a weight for each feature of the labelled pages
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            texts = main_texts(batch.column("html").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    found = rows.mapInArrow(run, f"page_id {kinds[key]}, url {kinds[url]}, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))

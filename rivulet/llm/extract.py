"""Main-text extraction with a tree-structured graphical model (operator 4).

The block elements of a page are the variables: content or not. Each has a unary
potential from a logistic model of its tag, class words, text and links, and each
pair of parent and child a potential by the child's kind. As the graph is the tree
of blocks, two passes of sum-product messages, upward by depth and downward again,
give exact marginals; blocks that are more likely content than not give their text.
Messages of all pages of a batch travel together, one step a depth.

The potentials are trained, on the driver, from the small set of labelled pages in
``labelled_pages`` (or others of the same form).

Defined results: a null or empty page has the empty text, as has one without content;
unclosed, crossing and cut-off tags, comments and references are read as browsers
read them; scripts, styles, templates and form fields are never text; repeated rows
are each answered; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import labelled_pages

# --------------------------------------------------- fixed values: HTML vocabulary

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("script style template noscript iframe object svg annotation annotation-xml canvas audio video select textarea button head title datalist option".split())
#: What can stand in a head; any other start tag ends it.
IN_HEAD = frozenset("head base basefont bgsound link meta title noscript noframes style script template html".split())
#: Of the silent ones, those whose content is not markup.
RAW = frozenset("script style textarea title iframe noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table caption tbody td tfoot th thead tr ul label".split()
)
#: An open element of the value is closed by a start tag of the key.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}, "thead": {"tbody"}}
#: Where looking for an element to close ends.
SCOPES = frozenset("table ul ol dl article section aside main nav header footer div body html td th blockquote form".split())
KEEP_P = BLOCKS - {"tbody", "td", "tfoot", "th", "thead", "tr", "caption", "label", "legend", "body", "html"}

KINDS = {t: i for i, group in enumerate(["p", "h1", "h2 h3 h4 h5 h6 hgroup", "li", "ul ol menu dir", "div center", "section", "article", "main", "nav", "header", "footer", "aside", "form fieldset label legend", "table tbody thead tfoot tr caption", "td th", "blockquote", "pre", "figure figcaption", "dl dt dd", "address details summary dialog hr", "body html"]) for t in group.split()}
N_KINDS = len(set(KINDS.values()))
#: Kinds of elements that colour all that they hold.
CONTEXTS = ["article main", "nav", "header", "footer", "aside", "form"]
#: Words of class, id and role that tell content from the rest.
HINTS = [
    "article|content|main|post|entry|story|body|text|page",
    "nav|menu|breadcrumb|pagination|pager|tabs|toc|skip",
    "header|masthead|logo|banner|topbar|tagline",
    "footer|copyright|contentinfo|imprint|legal",
    "sidebar|aside|complementary|widget|related|recommended|more|popular|tags|author|bio",
    "ad|ads|advert|advertisement|sponsor|sponsored|promo|promotion|adslot|dfp",
    "comment|comments|respond|reply|replies|disqus|discussion|thread|feedback|review|reviews",
    "cookie|consent|notice|alert|message|popup|modal|gdpr|warning|overlay|announcement",
    "form|search|login|signup|register|subscribe|newsletter|share|social|follow",
]
_HINT = [re.compile(rf"(?:^|[^a-z])(?:{h})(?:$|[^a-z])") for h in HINTS]

_TOKEN = re.compile(r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<other>[!?][^>]*(?:>|\Z))|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]|=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))|=(?!\s*["']))*)(?P<close>>|\Z)|/[^>]*(?:>|\Z))""", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)""", re.I)
_SPACE = re.compile(r"\s+")


class Page:
    """Block tree of a page: per node its parent, depth, kind, hints, and sizes; runs of text in page order."""

    __slots__ = ("depth", "hints", "kinds", "label", "links", "own", "parent", "punct", "runs")

    def __init__(self, source: str, labels: bool = False):
        self.parent, self.depth, self.kinds, self.hints = [-1], [0], [N_KINDS - 1], [0]
        self.own, self.links, self.punct, self.label = [0], [0], [0], [0]
        self.runs: list[tuple[int, str]] = []
        self._build(source, labels)

    def _node(self, tag: str, attrs: str, above: int, labels: bool) -> int:
        hints = 0
        if attrs and ("=" in attrs):
            words = " ".join(m.group(2).strip("\"'") for m in _ATTR.finditer(attrs))
            if words:
                hints = _hints(words)
        self.parent.append(above)
        self.depth.append(self.depth[above] + 1)
        self.kinds.append(KINDS[tag])
        self.hints.append(hints)
        self.own.append(0)
        self.links.append(0)
        self.punct.append(0)
        label = self.label[above]
        if labels:
            label = 0 if "x-not" in attrs else 1 if "x-main" in attrs else label
        self.label.append(label)
        return len(self.parent) - 1

    def _build(self, source: str, labels: bool) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]  # open elements with the block that they are in
        buffer: list[str] = []
        in_link, at, silent, depth_of = 0, 0, 0, {}

        def flush():
            if not buffer:
                return
            raw = "".join(buffer)
            buffer.clear()
            text = _SPACE.sub(" ", html.unescape(raw) if "&" in raw else raw).strip()
            if text:
                node = stack[-1][1]
                self.own[node] += len(text)
                self.punct[node] += text.count(".") + text.count(",")
                self.runs.append((node, text))

        def pop():
            nonlocal in_link, silent
            tag, _ = stack.pop()
            depth_of[tag] -= 1
            if tag == "a":
                in_link -= 1
            if tag in SILENT:
                silent -= 1

        while m := _TOKEN.search(source, at):  # from where a raw element ends, whatever it holds
            if stack[-1][0] == "head" and source[at : m.start()].strip():
                pop()  # text ends a head
            if m.start() > at and not silent:
                piece = source[at : m.start()]
                buffer.append(piece)
                if in_link:
                    self.links[stack[-1][1]] += len(piece)
            at = m.end()
            tag = m.group("tag")
            if tag is None:
                continue
            tag = tag.lower()
            if not m.group("close"):
                continue  # cut off within a tag
            if m.group("end"):
                if depth_of.get(tag):
                    if tag in BLOCKS:
                        flush()
                    elif next(t for t, _ in reversed(stack) if t == tag or t in BLOCKS) != tag:
                        continue  # the end of an inline element closes no block
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                continue
            if stack[-1][0] == "head" and tag not in IN_HEAD:
                pop()
            if tag == "br" or tag in ("img", "input", "wbr"):
                if not silent and tag != "wbr":
                    buffer.append(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            attrs = m.group("attrs")
            if attrs.endswith("/") and tag in ("svg", "math", "path", "annotation", "annotation-xml"):
                continue
            block = tag in BLOCKS
            if tag in ("html", "body"):  # the root stands for both
                self.label[0] |= labels and "x-main" in attrs
                continue
            if block:
                flush()
                closes = CLOSED_BY.get(tag)
                if closes:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] in closes:
                            while len(stack) > k:
                                pop()
                            break
                        if stack[k][0] in SCOPES:
                            break
                if tag in KEEP_P and depth_of.get("p"):
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == "p":
                            while len(stack) > k:
                                pop()
                            break
                        if stack[k][0] in SCOPES:
                            break
            elif tag == "a" and in_link:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "a":
                        del stack[k]
                        depth_of["a"] -= 1
                        in_link -= 1
                        break
            node = self._node(tag, attrs, stack[-1][1], labels) if block and not silent else stack[-1][1]
            stack.append((tag, node))
            depth_of[tag] = depth_of.get(tag, 0) + 1
            if tag == "a":
                in_link += 1
            if tag in SILENT:
                silent += 1
                if tag in RAW:
                    end = _end_of(tag).search(source, at)
                    at = end.start() if end else len(source)
        if stack[-1][0] == "head" and source[at:].strip():
            pop()
        if at < len(source) and not silent:
            buffer.append(source[at:])
        flush()


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])", re.I)


@lru_cache(maxsize=100_000)
def _hints(words: str) -> int:
    words = re.sub(r"([a-z])([A-Z])", r"\1 \2", words).lower()
    return sum(1 << i for i, h in enumerate(_HINT) if h.search(words))


class Forest:
    """The trees of many pages as arrays; features and messages are computed for all at once."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.parent) for p in pages], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        flat = lambda name: np.fromiter((x for p in pages for x in getattr(p, name)), dtype=np.int64, count=int(sizes.sum()))
        base = np.repeat(self.first[:-1], sizes)
        parent = flat("parent")
        self.parent = np.where(parent < 0, -1, parent + base)
        self.depth, self.kinds, self.hints, self.label = flat("depth"), flat("kinds"), flat("hints"), flat("label")
        self.own, self.links, self.punct = flat("own"), flat("links"), flat("punct")
        self.page = np.repeat(np.arange(len(pages)), sizes)
        order = np.argsort(self.depth, kind="stable")
        cuts = np.searchsorted(self.depth[order], np.arange(int(self.depth.max()) + 2 if len(order) else 1))
        self.levels = [order[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _below(self, values: np.ndarray) -> np.ndarray:
        total = values.astype(np.float64)
        for level in self.levels[:0:-1]:
            np.add.at(total, self.parent[level], total[level])
        return total

    def _above(self, marks: np.ndarray) -> np.ndarray:
        """Whether an ancestor of each node is marked."""
        out = np.zeros(len(marks), dtype=bool)
        for level in self.levels[1:]:
            up = self.parent[level]
            out[level] = out[up] | marks[up]
        return out

    def features(self) -> np.ndarray:
        text, links, punct = self._below(self.own), self._below(self.links), self._below(self.punct)
        up = np.maximum(self.parent, 0)
        top = np.maximum(text[self.first[:-1]], 1)[self.page] if len(self.page) else text
        x = np.zeros((len(self.kinds), N_KINDS + 2 * len(HINTS) + 6 + len(CONTEXTS)))
        x[np.arange(len(x)), self.kinds] = 1
        for i in range(len(HINTS)):
            x[:, N_KINDS + i] = (self.hints >> i) & 1
            x[:, N_KINDS + len(HINTS) + i] = np.where(self.parent >= 0, (self.hints[up] >> i) & 1, 0)
        tail = N_KINDS + 2 * len(HINTS)
        x[:, tail] = np.log1p(text) / 8
        x[:, tail + 1] = np.minimum(links / np.maximum(text, 1), 1)
        x[:, tail + 2] = np.minimum(20 * punct / np.maximum(text, 20), 1)
        x[:, tail + 3] = text / top
        x[:, tail + 4] = text == 0
        x[:, tail + 5] = np.log1p(self.own) / 8
        for i, tags in enumerate(CONTEXTS):
            x[:, tail + 6 + i] = self._above(np.isin(self.kinds, [KINDS[t] for t in tags.split()]))
        return x


class Model:
    """Unary weights, and log potentials of (parent label, child label) by the child's kind."""

    def __init__(self, weights: np.ndarray, pair: np.ndarray, root: np.ndarray):
        self.weights, self.pair, self.root = weights, pair, root

    @classmethod
    def train(cls, pages: list[str], penalty: float = 0.3, strength: float = 1.0) -> Model:
        """Penalised logistic unaries; pair potentials from counts of labels along edges, smoothed, and
        divided by the child's label rate, which the unaries hold already."""
        forest = Forest([Page(p, labels=True) for p in pages])
        x, y = forest.features(), forest.label.astype(np.float64)
        x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        w, ridge = np.zeros(x.shape[1]), penalty * np.eye(x.shape[1])
        ridge[-1, -1] = 1e-3
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ w))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
            w += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        inner = forest.parent >= 0
        counts = np.full((N_KINDS, 2, 2), 0.5)
        every = np.full((2, 2), 0.5)
        np.add.at(counts, (forest.kinds[inner], forest.label[forest.parent[inner]], forest.label[inner]), 1)
        np.add.at(every, (forest.label[forest.parent[inner]], forest.label[inner]), 1)
        counts += 4 * (every / every.sum(axis=1, keepdims=True))[None]
        rate = np.array([1 - y[inner].mean(), y[inner].mean()])
        pair = np.log(counts / counts.sum(axis=2, keepdims=True)) - np.log(rate)[None, None, :]
        return cls(w, strength * pair, np.zeros(2))

    def marginals(self, forest: Forest) -> np.ndarray:
        """P(content) of each block, by sum-product up and down the trees."""
        n = len(forest.kinds)
        if not n:
            return np.zeros(0)
        unary = np.zeros((n, 2))
        unary[:, 1] = forest.features() @ self.weights[:-1] + self.weights[-1]
        roots = forest.parent < 0
        unary[roots] += self.root
        below = unary.copy()  # unary and all messages from children
        sent = np.zeros((n, 2))
        for level in forest.levels[:0:-1]:
            sent[level] = np.logaddexp.reduce(self.pair[forest.kinds[level]] + below[level][:, None, :], axis=2)
            np.add.at(below, forest.parent[level], sent[level])
        belief = below.copy()
        for level in forest.levels[1:]:
            rest = belief[forest.parent[level]] - sent[level]  # what the parent holds without this child
            belief[level] += np.logaddexp.reduce(self.pair[forest.kinds[level]] + rest[:, :, None], axis=1)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50)))


@lru_cache(maxsize=1)
def default_model() -> Model:
    return Model.train(labelled_pages.PAGES)


def main_texts(sources: list[str | None], model: Model) -> list[str]:
    pages = [Page(s or "") for s in sources]
    forest = Forest(pages)
    content = model.marginals(forest) > 0.5
    return [" ".join(text for node, text in page.runs if content[base + node]) for page, base in zip(pages, forest.first, strict=False)]


def extract(pages: DataFrame, source: str = "html", keep: tuple[str, ...] = ("page_id", "url"), model: Model | None = None) -> DataFrame:
    """The columns ``keep`` of ``pages``, and text, the main text of each."""
    model = model or default_model()
    columns = [pages.schema[c] for c in keep]

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                texts = main_texts(part.column(len(columns)).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(columns)], pa.array(texts, pa.string())], names=[*keep, "text"])

    schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in columns) + ", text string"
    return pages.select(*keep, F.col(source).cast("string").alias("__source")).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: the main text of every page."""
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))

"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, with the tags, classes and ids above them. Each block
is described by ancestor and text features; a chain model with labels *main* and *other* is trained on labelled pages by
maximum likelihood (forward-backward, Adam), and Viterbi decoding labels the blocks of every page.

Labelled pages are (a) the pages of ``page_labels`` and (b) pages of the table itself whose markup names its
article (``article``, ``main``, ``itemprop=articleBody``): their blocks inside are main unless a menu, notice, form or the like
lies between. At most ``sample`` pages of the table (the first by hash of page_id) are used for training; every page is decoded.

Elements without text of the page (scripts, forms' options, drawings) are skipped up to their own end tag. Where that is left out, or lies beyond the end
of the element around them, what they hide ends at the next block or at the end of the element around them; only script, style, textarea and title go on to
the end of the page. A head has no extent of its own: what it may hold has no text.

Defined cases: null or empty html gives an empty text. Markup that is cut off ends where the page ends. Repeated pages are decoded one by one
and get equal texts. An empty table is an empty result; the model then rests on the labelled pages alone.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunfleet.llm.page_labels import LABELLED_PAGES

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"']|[\"'])*+)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style|data-label)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
RAW = frozenset("script style noscript template textarea title svg iframe object select option button canvas audio video annotation annotation-xml".split())
#: Those that only their own end tag ends.
ENDLESS = frozenset("script style textarea title".split())
#: Those whose markup does not end an element around them.
CLOSED = ENDLESS | frozenset("noscript template iframe object".split())
#: Elements inside a line of text; all others begin and end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mi mo mn ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mtable mtr mtd mstyle mspace mpadded mphantom menclose mfenced mmultiscripts mprescripts semantics".split()
)
#: Start tags that end an open element of the same kind.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "p": {"p"},
}
#: Elements that bound the search of an implied end.
SCOPES = frozenset("table ul ol dl body article section main div td th".split())

MAIN_TAGS = frozenset(("article", "main"))
OTHER_TAGS = frozenset(("nav", "aside", "footer", "header", "form", "fieldset", "dialog", "menu"))
OTHER_WORDS = frozenset(
    "ad ads advert advertisement sponsored promo banner cookie consent notice alert newsletter subscribe signup login search menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar widget related share sharing social footer header masthead comment comments reply replies respond disqus pagination pager tags copyright".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus".split())


@dataclass
class Block:
    text: str
    #: Kinds of the block-level elements around it, and the innermost one.
    tags: frozenset[str]
    parent: str
    #: Words in the attributes of all elements around it.
    words: frozenset[str]
    linked: int
    inline: frozenset[str]
    label: int | None = None
    #: Whether an article is around it, and whether a menu, notice or the like lies between.
    inside: bool = False
    between: bool = False


@dataclass
class _Open:
    tag: str
    words: tuple[str, ...] = ()
    label: int | None = None
    hidden: bool = False
    at: int = -1


@dataclass
class _Run:
    """Text between two block-level tags."""

    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    inline: set[str] = field(default_factory=set)


def _opened(tag: str, attributes: str) -> _Open:
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return _Open(tag)
    words: list[str] = []
    label, hidden = None, False
    for name, *value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(value)
        if name == "data-label":
            label = int(value)
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
        elif name != "style":
            words += [w.lower() for w in PART.findall(value)]
    return _Open(tag, tuple(words), label, hidden)


class _Stack:
    """Open elements, with what blocks ask of all of them kept up to date, so that deep nesting costs no more than shallow."""

    def __init__(self) -> None:
        self.elements: list[_Open] = []
        # per element: innermost block-level kind, label in force, and what _place needs of the elements up to it
        self.states: list[tuple] = [("", None, False, False, False, False)]
        self.kinds: Counter[str] = Counter()
        self.words: Counter[str] = Counter()
        self.hidden = 0
        self._inline: frozenset[str] | None = frozenset()
        self._blocks: tuple[frozenset[str], frozenset[str]] | None = None

    def _state(self, element: _Open) -> tuple:
        parent, label, inside, below, commented, settled = self.states[-1]
        parent = parent if element.tag in INLINE else element.tag
        label = label if element.label is None else element.label
        comment = any(w in COMMENT_WORDS for w in element.words)
        if element.tag in MAIN_TAGS or "articlebody" in "".join(element.words):
            # an article in an article is a comment if it or what is between says so
            commented = inside and (commented or comment)
            inside, below, settled = True, False, commented
        elif inside:
            below = below or element.tag in OTHER_TAGS or any(w in OTHER_WORDS for w in element.words)
            commented = commented or comment
        return parent, label, inside, below, commented, settled

    def push(self, element: _Open) -> None:
        self.states.append(self._state(element))
        self.elements.append(element)
        self._count(element, 1)

    def pop(self) -> None:
        self.states.pop()
        self._count(self.elements.pop(), -1)

    def remove(self, place: int) -> None:
        """Take out one element; those above it stay."""
        above = self.elements[place + 1:]
        while len(self.elements) > place:
            self.pop()
        for element in above:
            self.push(element)

    def cut(self, place: int) -> None:
        while len(self.elements) > place:
            self.pop()

    def _count(self, element: _Open, n: int) -> None:
        for counts, names in ((self.kinds, (element.tag,)), (self.words, element.words)):
            for name in names:
                counts[name] += n
                if not counts[name]:
                    del counts[name]
        self.hidden += n * element.hidden
        self._blocks = self._inline = None

    def inline(self) -> frozenset[str]:
        """Kinds of the open elements inside a line."""
        if self._inline is None:
            self._inline = frozenset(k for k in self.kinds if k in INLINE)
        return self._inline

    def around(self) -> tuple[frozenset[str], frozenset[str]]:
        """Kinds of the block-level elements and words of all."""
        if self._blocks is None:
            self._blocks = frozenset(k for k in self.kinds if k not in INLINE), frozenset(self.words)
        return self._blocks


def _ends(page: str, tag: str) -> dict[int, tuple[int, int]]:
    """Where each element of a kind ends: start of its start tag to the extent of its own end tag."""
    ends: dict[int, tuple[int, int]] = {}
    opened: list[int] = []
    for found in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", page, re.I):
        if not found.group(1):
            if not found.group().endswith("/>"):
                opened.append(found.start())
        elif opened:
            ends[opened.pop()] = found.span()
    return ends


def leaf_blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order; blank ones are left out."""
    page = page or ""
    stack = _Stack()
    blocks: list[Block] = []
    run = _Run()
    at = 0
    ends: dict[str, dict[int, tuple[int, int]]] = {}

    def end_of(tag: str, start: int) -> tuple[int, int] | None:
        if tag not in ends:
            ends[tag] = _ends(page, tag)
        return ends[tag].get(start)

    def flush() -> None:
        nonlocal run
        if run.pieces:
            text = " ".join(html.unescape("".join(run.pieces)).split())
            if text and not stack.hidden:
                parent, label, inside, below, _, settled = stack.states[-1]
                tags, words = stack.around()
                blocks.append(Block(text, tags, parent, words, run.linked, frozenset(run.inline), label, inside, below or settled))
            run = _Run()

    concealed: int | None = None  # open elements around a skipped one that has no end of its own

    def add(piece: str) -> None:
        if piece and concealed is None:
            run.pieces.append(piece)
            if stack.kinds["a"]:
                run.linked += len(piece.strip())
            if piece.strip():
                run.inline |= stack.inline()

    size = len(page)
    while at < size:
        found = TAG.search(page, at)
        if found is None:
            add(page[at:])
            break
        add(page[at: found.start()])
        at = found.end()
        tag = found.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if found.group(1):
            if tag == "br" or tag == "p" and "p" not in stack.kinds:
                flush()
                continue
            if tag in RAW:
                concealed = None
                continue
            if tag in stack.kinds:
                opened = stack.elements
                if tag not in INLINE:
                    concealed = None
                    flush()
                    while opened[-1].tag != tag:
                        stack.pop()
                    stack.pop()
                else:  # an inline end never closes a block
                    for k in range(len(opened) - 1, -1, -1):
                        if opened[k].tag == tag:
                            concealed = None if concealed is not None and k < concealed else concealed
                            stack.remove(k)
                            break
                        if opened[k].tag not in INLINE:
                            break
            continue
        if tag == "head":
            continue
        if tag in RAW:
            if found.group(3).rstrip().endswith("/"):
                continue
            if tag in ENDLESS:
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = size if end is None else end.end()
                continue
            own = end_of(tag, found.start())
            around = next((end_of(e.tag, e.at) for e in reversed(stack.elements) if e.tag not in INLINE), None)
            # an option begins the next one
            nested = tag in ("option", "button") and own and re.compile(rf"<{tag}\b", re.I).search(page, at, own[0])
            if own and not nested and (tag in CLOSED or around is None or own[0] < around[0]):
                at = own[1]
            else:
                concealed = len(stack.elements)
            continue
        if tag not in INLINE:
            concealed = None
            flush()
            ended = CLOSES.get(tag, frozenset()) | {"p"}
            # nothing to look for, most times
            for k in range(len(stack.elements) - 1, -1, -1) if any(t in stack.kinds for t in ended) else ():
                if stack.elements[k].tag in ended:
                    stack.cut(k)
                    break
                if stack.elements[k].tag in SCOPES:
                    break
        if tag not in VOID and not found.group(3).rstrip().endswith("/"):
            element = _opened(tag, found.group(3))
            element.at = found.start()
            stack.push(element)
    flush()
    return blocks


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that hold for each block."""
    out = []
    for block in blocks:
        text, size = block.text, len(block.text)
        n_words = text.count(" ") + 1
        marks = text.count(".") + text.count(",") + text.count("!") + text.count("?")
        names = ["bias", f"parent={block.parent}", f"words={min(7, n_words.bit_length())}"]
        names += [f"in={t}" for t in sorted(block.tags)]
        names += [f"name={w}" for w in sorted(block.words)]
        names += [f"named={w in OTHER_WORDS}" for w in block.words if w in OTHER_WORDS][:1]
        names.append(f"links={min(4, int(4 * block.linked / max(size, 1) + 0.5))}")
        names.append(f"marks={min(4, int(20 * marks / n_words))}")
        if text[-1] in ".!?\"”»…":
            names.append("sentence")
        if "©" in text or "(c)" in text:
            names.append("copyright")
        if text.isupper():
            names.append("upper")
        names += [f"inline={t}" for t in sorted(block.inline)]
        out.append(names)
    return out


def markup_labels(blocks: list[Block]) -> list[int] | None:
    """Labels from markup that names the article, or None if the page has none."""
    labels = [int(b.inside and not b.between) for b in blocks]
    named = any(b.inside for b in blocks)
    return labels if named else None


@dataclass
class Chain:
    """Weights of a two-label chain: per feature, per transition, and of the first label."""

    index: dict[str, int]
    weights: np.ndarray  # features x 2
    moves: np.ndarray  # 2 x 2
    first: np.ndarray  # 2

    def label(self, names: list[list[str]]) -> list[int]:
        """Viterbi decoding."""
        if not names:
            return []
        w0, w1 = self.weights[:, 0].tolist(), self.weights[:, 1].tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        index, back = self.index, []
        s0, s1 = self.first.tolist()
        for k, block in enumerate(names):
            found = [index[n] for n in block if n in index]
            if k:
                from0, from1 = s1 + m10 > s0 + m00, s1 + m11 > s0 + m01
                back.append((from0, from1))
                s0, s1 = (s1 + m10 if from0 else s0 + m00), (s1 + m11 if from1 else s0 + m01)
            for f in found:
                s0 += w0[f]
                s1 += w1[f]
        label = int(s1 > s0)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], epochs: int = 150, rate: float = 0.1, decay: float = 0.002, common: int = 2) -> Chain:
    """Fit a chain to (feature names per block, labels) by penalised maximum likelihood."""
    pages = [p for p in pages if p[0]]
    count: dict[str, int] = {}
    for names, _ in pages:
        for block in names:
            for n in block:
                count[n] = count.get(n, 0) + 1
    index = {n: i for i, n in enumerate(sorted(n for n, c in count.items() if c >= common))}
    chain = Chain(index, np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2))
    if not pages or not index:
        return chain
    longest = max(len(p[0]) for p in pages)
    n = len(pages)
    gold = np.zeros((n, longest), dtype=np.int64)
    mask = np.zeros((n, longest), dtype=bool)
    rows, columns = [], []
    for i, (names, labels) in enumerate(pages):
        mask[i, : len(names)], gold[i, : len(names)] = True, labels
        for t, block in enumerate(names):
            for f in block:
                if f in index:
                    rows.append(i * longest + t)
                    columns.append(index[f])
    rows, columns = np.array(rows), np.array(columns)
    parameters = [chain.weights, chain.moves, chain.first]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    onehot = np.eye(2)[gold] * mask[..., None]
    pair_gold = np.einsum("nta,ntb->ab", onehot[:, :-1], onehot[:, 1:])
    for epoch in range(1, epochs + 1):
        scores = np.zeros((n * longest, 2))
        np.add.at(scores, rows, chain.weights[columns])
        scores = scores.reshape(n, longest, 2)
        ahead = np.zeros((n, longest, 2))
        ahead[:, 0] = chain.first + scores[:, 0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + chain.moves, axis=1) + scores[:, t]
            ahead[:, t] = np.where(mask[:, t, None], step, ahead[:, t - 1])
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        behind = np.zeros((n, longest, 2))
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(chain.moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(mask[:, t + 1, None], step, 0)
        chance = np.exp(ahead + behind - total[:, None, None]) * mask[..., None]
        pairs = np.exp(ahead[:, :-1, :, None] + chain.moves + (scores + behind)[:, 1:, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
        residual = (onehot - chance).reshape(-1, 2)
        slope = np.zeros_like(chain.weights)
        np.add.at(slope, columns, residual[rows])
        slopes = [slope, pair_gold - pairs.sum(axis=(0, 1)), (onehot - chance)[:, 0].sum(axis=0)]
        for p, s, (m, v) in zip(parameters, slopes, moments):
            s = s / n - decay * p
            m += 0.1 * (s - m)
            v += 0.01 * (s * s - v)
            p += rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
    return chain


def training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature names and labels of pages whose markup names their article."""
    for batch in batches:
        found = []
        for page in batch.column("html").to_pylist():
            blocks = leaf_blocks(page)
            labels = markup_labels(blocks)
            if labels is not None:
                found.append({"names": features(blocks), "labels": labels})
        kind = pa.schema([("names", pa.list_(pa.list_(pa.string()))), ("labels", pa.list_(pa.int32()))])
        yield pa.RecordBatch.from_pylist(found, schema=kind)


def fit(pages: DataFrame, sample: int = 250, id_column: str = "page_id", html_column: str = "html") -> Chain:
    """Train on the labelled pages and on at most ``sample`` pages of the table."""
    chosen = pages.select(F.col(html_column).cast("string").alias("html"), F.xxhash64(id_column).alias("h")).filter("html is not null").orderBy("h", F.octet_length("html")).limit(sample)
    rows = chosen.select("html").mapInArrow(training_rows, "names array<array<string>>, labels array<int>").collect()
    known = [(features(b), [x.label or 0 for x in b]) for b in map(leaf_blocks, LABELLED_PAGES)]
    # the labelled pages are few and varied: they weigh as much as the sample together
    times = max(1, len(rows) // len(known))
    return train([(r["names"], r["labels"]) for r in rows] + known * times)


def decode(chain: Chain) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replace the html in the last column by the main text and its number of characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page in batch.column(batch.num_columns - 1):
                blocks = leaf_blocks(page.as_py())
                labels = chain.label(features(blocks))
                texts.append(" ".join(b.text for b, y in zip(blocks, labels) if y))
            columns = [*batch.columns[:-1], pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    return run


def main_text(pages: DataFrame, chain: Chain | None = None, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", sample: int = 250) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages``."""
    chain = chain or fit(pages, sample, id_column, html_column)
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).cast("string").alias("html"))
    kinds = ", ".join(f"{c} {k}" for c, k in rows.dtypes[:2])
    return rows.mapInArrow(decode(chain), f"{kinds}, text string, n_chars long")
